"""Secret scans: parts of credentials found by pattern and linked within scopes.

Base parts stand alone: assigned secrets, access identifiers and hex runs.  Weak
parts (short access identifiers, account names, mixed long tokens, endpoints) are
reported only when the complementary part lies in the same scope, that is begins at
most ``scope`` code points away in the same text, and shares no code point with it: an identifier or an
endpoint needs a secret, a token needs an identifier.  A token within an endpoint or an account is
part of that and no secret.  The link is an interval join: parts are
dealt by (row, bucket of ``scope`` code points), a weak part looks into its own and
the two neighbouring buckets, each of which holds few parts, as those of a kind do not overlap.

DataFrame functions only.  Matches are located by splitting the text at the
pattern: the lengths of the gaps and of the matches, summed up by a window over a
row's matches, give the offsets.  Only lengths leave the scan, never texts.

Defined results: a null or empty text has no parts.  Rows are handled one by one, so
repeated rows and null ids give one result row each.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SCOPE = 200

#: The keywords of assigned secrets and of account names.
SECRET_WORDS = ["password", "passwd", "secret", "token", "api_?key"]
ACCOUNT_WORDS = ["client_id", "username", "user", "login", "account"]

#: Kinds in the order that ties of start take.
KINDS = ["assign", "access", "hex", "short_access", "account", "mixed_token", "endpoint"]
BASE = KINDS[:3]
#: What each kind is a part of.
PART = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "short_access": "identifier",
    "account": "identifier",
    "mixed_token": "secret",
    "endpoint": "endpoint",
}
#: What a weak kind needs in its scope.
NEEDS = {"short_access": "secret", "account": "secret", "mixed_token": "identifier", "endpoint": "secret"}


def either_case(words: list[str]) -> str:
    """The words as alternatives whose ASCII letters match in either case."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


ASSIGN = "(" + either_case(SECRET_WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "(AKIA)([A-Z0-9]+)"
HEX = "()([0-9a-f]{16,})"
ACCOUNT = "(" + either_case(ACCOUNT_WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
MIXED = "()([A-Za-z0-9+/]{24,})"
ENDPOINT = r"""(https?://|s3://)([A-Za-z0-9._:/-]+)"""

#: kind -> (pattern, least length of group 2, most)
PATTERNS = {
    "assign": (ASSIGN, 12, None),
    "access": (ACCESS, 14, None),
    "hex": (HEX, 16, None),
    "short_access": (ACCESS, 8, 13),
    "account": (ACCOUNT, 3, None),
    "mixed_token": (MIXED, 24, None),
    "endpoint": (ENDPOINT, 4, None),
}


def _lengths(text: Column, kind: str) -> list[Column]:
    """Lengths of the gaps before, between and after matches, of the matches, and of group 2 (0: too plain)."""
    pattern = F.lit(PATTERNS[kind][0])
    value = F.regexp_extract_all(text, pattern, F.lit(2))
    if kind == "mixed_token":  # upper case, lower case and digits together
        plain = lambda v: ~(v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]"))
        sized = F.transform(value, lambda v: F.when(plain(v), 0).otherwise(F.length(v)))
    else:
        sized = F.transform(value, F.length)
    # split takes the pattern as a string literal; a negative limit keeps the last gap
    gaps = F.transform(F.split(text, PATTERNS[kind][0], -1), F.length)
    return [gaps, F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length), sized]


def scan_parts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: the other columns and ``__row``; parts: ``__row``, kind, start, end)."""
    body = F.coalesce(F.col(text), F.lit(""))
    identified = body.rlike("AKIA[A-Z0-9]{8}") | body.rlike(ACCOUNT)
    columns = []
    for kind in KINDS:
        if kind == "short_access":
            continue  # found by the pattern of access
        least = {"hex": "[0-9a-f]{16}", "access": "AKIA[A-Z0-9]"}.get(kind, PATTERNS[kind][0])
        asked = body.rlike(least)
        if kind == "mixed_token":  # of no use without an identifier or an endpoint
            asked = (identified | body.rlike(ENDPOINT)) & asked
        columns.append(F.when(asked, F.arrays_zip(*[c.alias(n) for c, n in zip(_lengths(body, kind), ("gap", "len", "value"))])).alias(f"__{kind}"))
    others = [c for c in docs.columns if c != text]
    scanned = materialize(docs.select(*others, F.monotonically_increasing_id().alias("__row"), *columns), "secret-parts")

    by_row = Window.partitionBy("__row", "pattern").orderBy("at")
    found = [
        scanned.where(F.col(f"__{kind}").isNotNull()).select("__row", F.lit(kind).alias("pattern"), F.posexplode(f"__{kind}").alias("at", "m"))
        for kind in KINDS
        if kind != "short_access"
    ]
    # a match starts after all gaps up to it and all earlier matches
    before = F.coalesce(F.lag("m.len").over(by_row), F.lit(0))
    placed = reduce(DataFrame.unionAll, found).withColumn("step", F.col("m.gap") + before).select(
        "__row", "pattern", F.sum("step").over(by_row).cast("bigint").alias("start"), F.col("m.len").alias("len"), F.col("m.value").alias("value")
    )
    kind = F.when((F.col("pattern") == "access") & (F.col("value") < PATTERNS["access"][1]), "short_access").otherwise(F.col("pattern"))
    least = F.create_map(*[F.lit(x) for k in KINDS for x in (k, PATTERNS[k][1])])
    parts = (
        placed.where("len IS NOT NULL")
        .select("__row", kind.alias("kind"), "start", (F.col("start") + F.col("len")).alias("end"), "value")
        .where(F.col("value") >= least[F.col("kind")])
        .drop("value")
    )
    return scanned.select(*others, "__row"), parts


def _free(parts: DataFrame) -> DataFrame:
    """``parts`` without the tokens that lie within an endpoint or an account: of those that begin before a token, the
    one that ends last holds it if any does."""
    so_far = Window.partitionBy("__row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(F.col("kind").isin("endpoint", "account"), F.col("end"))).over(so_far)
    return parts.withColumn("reach", reach).where((F.col("kind") != "mixed_token") | F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach")


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base parts, and the weak ones with a complement within ``scope`` that shares no code point with them."""
    parts = _free(parts)
    base = F.col("kind").isin(BASE)
    part = F.create_map(*[F.lit(x) for k in KINDS for x in (k, PART[k])])
    needs = F.create_map(*[F.lit(x) for k, v in NEEDS.items() for x in (k, v)])
    bucket = F.floor(F.col("start") / F.lit(scope))
    weak = parts.where(~base).select(
        "*", needs[F.col("kind")].alias("needs"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")
    )
    complements = parts.where(F.col("kind") != "endpoint").select(
        "__row", bucket.alias("bucket"), part[F.col("kind")].alias("needs"), F.col("start").alias("from"), F.col("end").alias("to")
    )
    near = (F.abs(F.col("start") - F.col("from")) <= scope) & ((F.col("to") <= F.col("start")) | (F.col("from") >= F.col("end")))
    linked = weak.join(complements, ["__row", "bucket", "needs"]).where(near).select("__row", "kind", "start", "end").distinct()
    return parts.where(base).unionByName(linked)


def find_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """The columns of ``docs`` but the text, with ``__spans``: array of (start, rank of kind, end, kind)."""
    rows, parts = scan_parts(docs, text)
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    span = F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind")
    by_row = link_parts(parts, scope).groupBy("__row").agg(F.sort_array(F.collect_list(span)).alias("__spans"))
    return rows.join(by_row, "__row", "left").drop("__row")


def mask_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span but those of endpoints replaced by ``mask`` (overlapping spans by one), and ``__spans``:
    what was masked, else null.  An endpoint near a secret is reported by ``find_secrets``, but is none itself.

    Rows meet their spans by 128 bits of hashes of the text, so equal texts share them.  Texts travel only where
    there are spans: those rows are joined, all others pass.
    """
    key = F.md5(F.col(text).cast("binary")).alias("__key")
    spans = F.filter("__spans", lambda s: s["kind"] != "endpoint")
    found = find_secrets(docs.select(F.col(text), key), text, scope).withColumn("__spans", spans).where("size(__spans) > 0")
    found = materialize(found.dropDuplicates(["__key"]), "secret-spans")
    keyed = docs.withColumn("__key", key)
    met = keyed.join(found, "__key", "left")
    # spans in ascending order: what stands between them, and one mask for each run that overlaps
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        gap = F.substring(F.col(text), (state["at"] + 1).cast("int"), F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        joined = F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"])
        return F.struct(joined.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    def finish(state):
        return F.concat(state["out"], F.substring(F.col(text), (state["at"] + 1).cast("int"), F.lit(2147483647)))

    masked = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.aggregate("__spans", start, step, finish))
    return met.select(*[masked.alias(c) if c == text else F.col(c) for c in docs.columns], "__spans")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the spans."""
    word = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.coalesce(F.array_join(F.transform(spans, word), ","), F.lit(""))
