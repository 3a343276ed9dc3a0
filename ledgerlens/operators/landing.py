"""Clean landed manual transactions.

Input is the raw landing frame as read from files (all columns strings, one
column per header name, plus optional lineage columns).  Output is a typed
frame and a rejects frame with a reason per row; nothing stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header names of the landing sheets -> output names (positional in
# the original job: Date, Account ID, Product, Amount, Source).
DEFAULT_MAPPING = {
    "Date": "date_created",
    "Account ID": "account_id",
    "Product": "product",
    "Amount": "total",
    "Source - Tableau (additional item)": "source",
}
#: Column that tells the header a row came under (see ``sources.io.read_landing``).
HEADER = "_header"
_TIME = r"[t ,]+\d{1,2}(:\d{2}(:\d{2}([.,]\d+)?)?( ?[ap]\.?m\.?)?| ?[ap]\.?m\.?)( ?(z|utc|gmt|[+-]\d{2}:?\d{2}))?$"
# Words that say nothing about the day: weekdays, ordinal endings, "of"
_FILLER = r"^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[., ]+|(?<=\d)(st|nd|rd|th)\b|\bof\b"
#: Shapes of a day -> the order of its parts.  0 stands for a number, a for a word; marks stay.
SHAPES = {
    "numbers": ("0-0-0", "0/0/0", "0.0.0", "0 0 0"),
    "digits": ("0",),
    "number first": ("0-a-0", "0/a/0", "0.a.0", "0 a 0", "0a0", "0 a. 0", "0. a 0"),
    "word first": ("a 0 0", "a-0-0", "a/0/0", "a. 0 0", "a0 0"),
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Two-digit years from here on are of the last century.
PIVOT = 75


def _with(body, **values: Column) -> Column:
    """``body`` of ``values``, each of which is written out once.  (As columns of a projection they would be
    put in for every mention of them when a filter on the result is pushed down, and grow without bound.)"""
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(bound, body), F.lit(0))


def parse_date(c, pivot: int = PIVOT) -> Column:
    """the day of a text, leniently; a time of day after it is ignored; unparsable -> NULL.

    The text is reduced to its shape, the shape gives the order of its parts, and the parts are
    put together once: no layout is tried in vain.

    * three numbers: year first if the first has four digits or is over 31, else month, day, year;
      the two change places where the month's is over 12 (``13/01/2024`` is 13 January)
    * eight digits: year, month, day; six: the same with a two-digit year
    * a month by name (three letters or more): before, behind or between day and year
    * two-digit years below ``pivot`` are 20xx, others 19xx
    * weekdays, ordinal endings and commas are skipped
    """

    def timed(x):  # most texts are plain days: the other expressions run only where there is something to cut
        cut = F.when(x["text"].contains(" ") | x["text"].contains("t"), F.regexp_replace(x["text"], _TIME, ""))
        return _with(plain, timed=cut.otherwise(x["text"]))

    def plain(x):
        worded = F.regexp_replace(F.regexp_replace(x["timed"], _FILLER, " "), r"[, ]+", " ")
        return _with(shaped, day=F.when(x["timed"].rlike("[a-z, ]"), F.trim(worded)).otherwise(x["timed"]))

    def shaped(x):
        day = x["day"]
        shape = F.regexp_replace(F.regexp_replace(day, "[0-9]+", "0"), "[a-z]+", "a")
        return _with(ordered, day=day, shape=shape, size=F.length(day), parts=F.regexp_extract_all(day, F.lit("([0-9]+|[a-z]+)"), F.lit(1)))

    def ordered(x):
        order = F.lit(None).cast("int")
        for i, shapes in enumerate(SHAPES.values(), 1):
            order = F.when(x["shape"].isin(*shapes), i).otherwise(order)
        return F.when(x["shape"].isin(*[s for shapes in SHAPES.values() for s in shapes]), _with(lambda o: divided(x, o), order=order))

    def divided(x, o):  # eight or six digits hold their parts by place
        digits, size = o["order"] == 2, x["size"]
        place = lambda i, start, n: F.when(digits, F.substring(x["day"], start, n)).otherwise(F.get(x["parts"], F.lit(i)))
        parts = {"first": place(0, F.lit(1), size - 4), "second": place(1, size - 3, F.lit(2)), "third": place(2, size - 1, F.lit(2))}
        return F.when(~digits | size.isin(6, 8), _with(lambda p: numbered(o, p), **parts))

    def numbered(o, p):
        numbers = {f"n{i}": p[c].try_cast("int") for i, c in enumerate(("first", "second", "third"), 1)}
        return _with(lambda n: placed(o, p, n), **numbers, word=F.when(o["order"] == 3, p["second"]).otherwise(p["first"]))

    def placed(o, p, n):
        year_first = (F.length(p["first"]) == 4) | (n["n1"] > 31) | (o["order"] == 2)
        return _with(lambda y: turned(o, p, n, y), year_first=F.coalesce(year_first, F.lit(False)))

    def turned(o, p, n, y):
        first = y["year_first"]
        months = F.lit(" january february march april may june july august september october november december")
        named = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(n["word"], 1, 3)).cast("int")
        named = F.when((F.length(n["word"]) >= 3) & months.contains(F.concat(F.lit(" "), n["word"])), named)
        a, b = F.when(first, n["n2"]).otherwise(n["n1"]), F.when(first, n["n3"]).otherwise(n["n2"])
        of_named = F.when(o["order"] == 4, n["n2"]).when(first, n["n3"]).otherwise(n["n1"])
        year = F.when(first & (o["order"] <= 3), p["first"]).otherwise(p["third"])
        return _with(lambda z: dated(o, z), named=named, a=a, b=b, of_named=of_named, year=year)

    def dated(o, z):
        turn, by_name, year = (z["a"] > 12) & (z["b"] <= 12), o["order"] > 2, z["year"].try_cast("int")
        month = F.when(by_name, z["named"]).when(turn, z["b"]).otherwise(z["a"])
        of_month = F.when(by_name, z["of_named"]).when(turn, z["a"]).otherwise(z["b"])
        century = F.when(year < pivot, 2000).otherwise(1900)
        full = F.when(F.length(z["year"]) == 4, year).when(F.length(z["year"]) == 2, year + century)
        return _with(whole, year=full, month=month, of_month=of_month)

    def whole(d):
        valid = d["year"].between(1, 9999) & d["month"].between(1, 12) & d["of_month"].between(1, 31)
        return F.when(valid, F.format_string("%04d-%02d-%02d", d["year"], d["month"], d["of_month"]).try_cast("date"))

    return _with(timed, text=F.lower(F.trim(F.col(c) if isinstance(c, str) else c)))


def parse_int_id(c):
    """integer id from text such as ``123`` or ``123.0`` (fraction truncated,
    like ``int(float)``); non-numeric text -> NULL."""
    col = F.trim(F.col(c) if isinstance(c, str) else c)
    return col.try_cast("decimal(38,10)").cast("bigint")


def clean_landing(
    raw: DataFrame,
    mapping: dict[str, str] = DEFAULT_MAPPING,
    key: str = "account_id",
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects).

    * rows empty in every mapped column are dropped (blank sheet rows)
    * the mapped columns are renamed; ``keep`` lineage columns pass through
    * ``date_created`` parsed leniently, ``account_id`` to bigint, ``total``
      to double; text that does not parse goes to rejects
    * rows with no ``account_id`` are rejected as ``null_account_id``
      (dropped silently in the original job)
    * rows that came under a header without one of the mapped names are
      rejected as ``missing_column``
    """
    absent = [c for c in mapping if c not in raw.columns]
    raw = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])
    if HEADER in raw.columns:
        incomplete = ~F.forall(F.array(*map(F.lit, mapping)), lambda c: F.array_contains(HEADER, c))
    else:
        incomplete = F.lit(bool(absent))
    keep = [c for c in (keep or []) if c in raw.columns]
    cols = [F.nullif(F.trim(F.col(f"`{src}`")), F.lit("")).alias(dst) for src, dst in mapping.items()]
    df = raw.select(*cols, *keep, incomplete.alias("_incomplete")).na.drop(how="all", subset=list(mapping.values()))
    parsed = df.select(
        "*",
        parse_date("date_created").alias("_date"),
        parse_int_id(key).alias("_id"),
        F.col("total").try_cast("double").alias("_total"),
    )
    reason = (
        F.when(F.col("_incomplete"), F.lit("missing_column"))
        .when(F.col(key).isNull(), F.lit("null_account_id"))
        .when(F.col("_id").isNull(), F.lit("bad_account_id"))
        .when(F.col("date_created").isNotNull() & F.col("_date").isNull(), F.lit("bad_date"))
        .when(F.col("total").isNotNull() & F.col("_total").isNull(), F.lit("bad_amount"))
    )
    tagged = parsed.withColumn("reason", reason)
    good = tagged.where(F.col("reason").isNull()).select(
        F.col("_date").alias("date_created"),
        F.col("_id").alias(key),
        "product",
        F.col("_total").alias("total"),
        "source",
        *keep,
    )
    rejects = tagged.where(F.col("reason").isNotNull()).select(
        *mapping.values(), *keep, "reason"
    )
    return good, rejects
