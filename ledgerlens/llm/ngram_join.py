"""N-gram Jaccard join with token-combination prefixes.

A text's set holds the hashes of its distinct five-word shingles.  Two sets are linked
when 100 * |intersection| >= 80 * |union|.  Equal sets are one node from the start; the
join finds the links between different sets:

1. Frequency classes.  Frequent tokens come last in the global order (else the order of
   the hashes), so boilerplate enters a prefix only where a text has little else.  They are
   found by lossy counting: each task counts its sets exactly in chunks and passes on what
   occurs twice or more, the sums decide.  A token is frequent with at least ``FREQUENT``
   of all tokens, so there are at most 1 / FREQUENT of them whatever the size of the input;
   classes steer the work only, never the result.
2. Prefixes.  A set of n may miss e = n - ceil(0.8 n) tokens of a partner.  Rare tokens are
   indexed one by one; frequent ones as pairs within a subclass (token modulo a
   number that follows the length), the prefix being extended by one token for
   each subclass: with weight sum(rare) + sum(max(0, n_subclass - 1)) = e + 1, partners
   share a rare token or a pair in their prefixes.  Pairs carry a length class; each set
   is indexed under its own and the next, where all its partners are met.
3. Candidates.  First every set meets up to three pivots of its posting lists (the extremes of three
   orders, of each the one it shares most lists with); verified links join components.  From
   then on only sets of one list whose components differ are compared: short lists by a self
   join, long ones in blocks of at most ``BLOCK`` sets a side, which give no pairs but those that
   their sketches leave (see 4).  The blocks are compared twice: first each set's nearest other
   component is verified and joined, then all pairs that are left between components.  Lists of
   rare tokens are bounded by the class, so a window over the list finds them with one shuffle;
   lists of pairs, which may be as long as the table, are counted first and joined back.
4. Verification first bounds the difference of two sets from below: the parity sketch of a set
   (bit i: is the number of its tokens that fall on i odd) is linear, so the sketches of
   two sets differ in no more bits than the sets in tokens; pairs that differ in more than a link
   allows are out, by a small sketch and then by a larger one.  The rest compare the whole sets.  The texts of candidate sets are picked from the table by a
   bitmap of fixed size (exactly, by a join, after it) and travel instead of the larger token lists.

Components are found on the linked nodes (see components.py).

Defined results: a null or empty text, or one without words, has an empty set, is linked with
nothing and is its own component.  With fewer than five words the whole sequence is one
shingle.  Rows are handled one by one: repeated rows are equal sets; the component's id is the
smallest id of its rows, null if all are null.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, raw_texts, slices, with_text_columns
from .components import components

WORDS = 5
PERCENT = 80
#: Share of all tokens from which a token counts as frequent; bounds the broadcast to 1 / FREQUENT tokens.
FREQUENT = 1e-7
#: A token in fewer sets is never frequent.
LEAST_FREQUENT = 8
#: Tokens counted at a time within a task.
CHUNK = 4_000_000
_MEMO = 1_000_000
#: Stands for a null id in keys.
_NO_ID = -(1 << 63)
#: Size of the bitmap that thins the table before candidate texts are shuffled.
_BITS = 1 << 23
#: Lists longer than SHORT are compared in blocks of BLOCK sets.
SHORT, BLOCK = 16, 512
_STEP = 1.26  # of length classes; partners' lengths differ by 1.25 at most

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_PLACES = _mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class WordHashes(dict):
    """Word -> 64-bit hash, kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(raw: bytes | None, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text."""
    # bytes.lower and bytes.split treat A-Z and the six ASCII blanks only
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(w))
    total = w[: len(w) - n + 1] * _PLACES[0]
    for j in range(1, n):
        total = total + w[j : len(w) - n + 1 + j] * _PLACES[j]
    return np.unique(_mix(total + np.uint64(n)))


def body_hash(text):
    """64 bits of a text, to tell the rows of one id apart."""
    return F.xxhash64(text.cast("string"))


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes(), len(tokens)) - (1 << 63) if len(tokens) else 0


def errors(n: int) -> int:
    return n - -(-PERCENT * n // 100)


def length_class(n: int) -> int:
    return int(np.log(n) / np.log(_STEP))


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix's rare tokens, and the pairs of its frequent ones, hashed."""
    n = len(tokens)
    need = errors(n) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
        rare = tokens[~often]
    else:
        rare = tokens
    if len(rare) >= need:
        return rare[:need], rare[:0]
    common, found = tokens[often], [rare[:0]]
    need -= len(rare)
    own = length_class(n)
    for level in (own, own + 1):
        parts = max(1, errors(int(_STEP**level)) // 4)
        sub = (common % np.uint64(parts)).astype(np.int64)
        # a token adds to the weight unless it is the first of its subclass
        first = np.zeros(len(common), bool)
        first[np.unique(sub, return_index=True)[1]] = True
        weight = np.cumsum(~first)
        end = int(np.searchsorted(weight, need)) + 1
        prefix, sub = common[:end], sub[:end]
        order = np.argsort(sub, kind="stable")
        prefix, sub = prefix[order], sub[order]
        salt = _mix(np.uint64([level + 1]))[0]
        for gap in range(1, len(prefix)):
            same = sub[gap:] == sub[:-gap]
            if not same.any():
                break
            found.append(_mix(_mix(prefix[:-gap][same] + salt) + prefix[gap:][same]))
    return rare, np.concatenate(found)


def parity_sketches(tokens: np.ndarray) -> tuple[bytes, bytes]:
    """The small and the large parity sketch of a set: about one and four bits a token."""
    if not len(tokens):
        return b"", b""
    bits = max(1024, 1 << int(2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    small = odd.reshape(4, bits // 4).sum(axis=0) & 1
    return np.packbits(small).tobytes(), np.packbits(odd).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of tokens that are in one of two sets only."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):  # the halves of the longer one make a sketch of half the length
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _frequent_tokens(docs: DataFrame, text: str, share: float, floor: int) -> np.ndarray:
    """Sorted tokens that hold at least ``share`` of all tokens."""

    def run(batches):
        memo, sets, seen, size, total = WordHashes(), [], set(), 0, 0

        def counted():
            values, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, int))
            values, counts = values[counts > 1].view(np.int64), counts[counts > 1]
            # null: the number of all tokens
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *values.tolist()], pa.int64()), pa.array([total, *counts.tolist()], pa.int64())], names=["token", "n"]
            )

        for part in slices(batches):
            for raw in raw_texts(part.column(0)):
                tokens = shingles(raw, memo)
                total += len(tokens)
                key = set_key(tokens)
                if key not in seen:  # copies in a chunk count once
                    seen.add(key)
                    sets.append(tokens)
                    size += len(tokens)
                if size >= CHUNK:
                    yield counted()
                    sets, seen, size, total = [], set(), 0, 0
        yield counted()

    counts = materialize(docs.select(text).mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")), "token-counts")
    total = counts.where("token IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(float(floor), share * total)
    found = counts.where((F.col("n") >= least) & F.col("token").isNotNull()).select("token").toPandas()["token"].to_numpy(np.int64)
    discard(counts)
    return np.sort(found.view(np.uint64))


def with_sets(docs: DataFrame, text: str, frequent: np.ndarray | None, drop_text: bool = True) -> DataFrame:
    """``docs`` with ``__n`` (set size), ``__set`` (its key) and, given the classes, ``__rare``,
    ``__pairs`` and the sketches ``__small`` and ``__large``."""
    shared = None if frequent is None else docs.sparkSession.sparkContext.broadcast(frequent)

    def make():
        memo = WordHashes()

        def compute(raws):
            sets = [shingles(raw, memo) for raw in raws]
            out = [[len(s) for s in sets], [set_key(s) for s in sets]]
            if shared is not None:
                signed = [signatures(s, shared.value) if len(s) else (s, s) for s in sets]
                out += [[r.view(np.int64) for r, _ in signed], [p.view(np.int64) for _, p in signed]]
                out += map(list, zip(*map(parity_sketches, sets), strict=True)) if sets else [[], []]
            return out

        return compute

    fields = [("__n", "bigint", pa.int64()), ("__set", "bigint", pa.int64())]
    if shared is not None:
        fields += [(c, "array<bigint>", pa.list_(pa.int64())) for c in ("__rare", "__pairs")]
        fields += [(c, "binary", pa.binary()) for c in ("__small", "__large")]
    return with_text_columns(docs, text, make, fields, drop_text=drop_text)


def _one_row_a_set(rows: DataFrame) -> DataFrame:
    """``rows`` without those whose set an earlier row has: a group of copies, however large, is one entry in its lists.

    Only the sets that occur twice or more are joined back; they are written first, so the join sees their size
    and, where they are too many to broadcast, can split a hot one."""
    several = rows.where("__n > 0").groupBy("__set").agg(F.min("__row").alias("first"), F.count(F.lit(1)).alias("m"))
    several = materialize(several.where("m > 1").select(F.col("__set").alias("copied"), "first"), "copied-sets")
    met = rows.join(several, F.col("__set") == F.col("copied"), "left")
    return met.where("__n > 0 AND (first IS NULL OR first = __row)").drop("copied", "first")


def _posting_lists(rows: DataFrame) -> DataFrame:
    """(sig, node, low, high, middle, n) of the lists that hold two different sets at least: the smallest
    and largest node, the one that is smallest in a third order, and the length of the list.  ``rows`` has each
    set once."""
    third = F.col("node").bitwiseXOR(F.lit(0x2545F4914F6CDD1D))
    ends = [F.min("node").alias("low"), F.max("node").alias("high"), F.min(third).alias("middle"), F.count(F.lit(1)).alias("n")]
    rare = rows.select(F.explode("__rare").alias("sig"), F.col("__set").alias("node"))
    lists = Window.partitionBy("sig")
    rare = rare.select(
        "sig", "node", F.min("node").over(lists).alias("low"), F.max("node").over(lists).alias("high"),
        F.min(third).over(lists).alias("middle"), F.count(F.lit(1)).over(lists).alias("n"),
    ).where("low <> high")
    pairs = rows.select(F.explode("__pairs").alias("sig"), F.col("__set").alias("node")).distinct()
    known = pairs.groupBy("sig").agg(*ends).where("low <> high")
    every = rare.unionAll(pairs.join(known, "sig").select(*rare.columns))
    return every.withColumn("middle", F.col("middle").bitwiseXOR(F.lit(0x2545F4914F6CDD1D)))


def _picked_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) for ``nodes`` (node, __key and __body: id and text hash of a row that has that set) from
    ``docs`` (__key, __body, text).

    A bitmap of fixed size, made of the hashes of the ids, thins the table before the texts are
    shuffled; the join is exact.
    """
    bit = F.pmod(F.xxhash64("__key"), F.lit(_BITS))
    cells = nodes.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 32).cast("int"))).alias("bits")
    )
    bitmap = np.zeros(_BITS // 32, np.int64)
    found = cells.toPandas()  # at most _BITS / 32 rows
    bitmap[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def thin(batches):
        for part in batches:
            bits = part.column(3).to_numpy()
            yield part.filter(pa.array((shared.value[bits // 32] >> (bits % 32)) & 1 == 1)).select([0, 1, 2])

    likely = docs.select("__key", "__body", "text", bit.alias("bit")).mapInArrow(thin, "__key bigint, __body bigint, text string")
    return likely.join(nodes, ["__key", "__body"]).select("node", "text").dropDuplicates(["node"])  # rows may repeat id and text


def _not_too_different(pairs: DataFrame, nodes: DataFrame, sketch: str) -> DataFrame:
    """``pairs`` (u, v) without those whose sketches rule a link out: |difference| > (|u| + |v|) / 9."""

    def run(batches):
        for part in slices(batches, 4096):
            columns = [part.column(i).to_pylist() for i in range(2, 6)]
            keep = [9 * least_difference(a, b) <= n + m for n, a, m, b in zip(*columns, strict=True)]
            yield part.filter(pa.array(keep, pa.bool_())).select([0, 1])

    one = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col(sketch).alias(f"s{c}"))
    met = pairs.join(one("u"), "u").join(one("v"), "v").where(F.lit(100) * F.least("nu", "nv") >= F.lit(PERCENT) * F.greatest("nu", "nv"))
    return met.select("u", "v", "nu", "su", "nv", "sv").mapInArrow(run, "u bigint, v bigint")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) that are linked."""
    for sketch in ("small", "large"):
        pairs = _not_too_different(pairs, nodes, sketch)

    def run(batches):
        memo, last, held = WordHashes(), None, None
        for part in slices(batches):
            keep = []
            v = part.column(1).to_pylist()
            for other, a, b in zip(v, raw_texts(part.column(2)), raw_texts(part.column(3)), strict=True):
                if other != last:
                    last, held = other, shingles(b, memo)
                own = shingles(a, memo)
                common = len(np.intersect1d(own, held, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(own) + len(held) - common))
            yield part.filter(pa.array(keep, pa.bool_())).select([0, 1])

    one = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}"))
    met = pairs.join(one("u"), "u").join(one("v"), "v").select("u", "v", "tu", "tv")
    return met.mapInArrow(run, "u bigint, v bigint")


def _star_pairs(lists: DataFrame) -> DataFrame:
    """(u, v): each node with the pivots it shares most lists with, one of each order."""
    kinds = F.explode(F.create_map(*[x for k in ("low", "high", "middle") for x in (F.lit(k), F.col(k))])).alias("kind", "pivot")
    shares = lists.select("node", kinds).where("node <> pivot").groupBy("node", "kind", "pivot").agg(F.count(F.lit(1)).alias("n"))
    nearest = shares.groupBy("node", "kind").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot"))
    return nearest.select(*_ordered(F.col("node"), F.col("pivot"))).distinct()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of differing bits between the rows of two arrays of 64-bit words."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, 2_000_000 // max(1, b.size))
    for at in range(0, len(a), step):
        out[at : at + step] = np.bitwise_count(a[at : at + step, None, :] ^ b[None, :, :]).sum(axis=2)
    return out


def near_in_block(side: np.ndarray, node: np.ndarray, root: np.ndarray, n: np.ndarray, sketch: list[bytes], last: bool) -> np.ndarray:
    """Pairs (rows of positions) of different components that the sketches leave; unless ``last``, of each
    position only the nearest.  ``side``: 0 and 1 for two blocks, all 0 for one block with itself."""
    sizes = np.array([len(x) for x in sketch])
    found = []
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        words = np.frombuffer(b"".join(sketch[i] for i in mine), np.uint64).reshape(len(mine), size // 8)
        double = np.flatnonzero(sizes == 2 * size)  # folded to this size
        wide = np.frombuffer(b"".join(sketch[i] for i in double), np.uint64).reshape(len(double), size // 4)
        half = wide.shape[1] // 2
        for other, theirs in ((mine, words), (double, wide[:, :half] ^ wide[:, half:])):
            if not len(other):
                continue
            apart = _distances(words, theirs)
            n1, n2 = n[mine][:, None], n[other][None, :]
            may = (9 * apart <= n1 + n2) & (100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2))
            may &= root[mine][:, None] != root[other][None, :]
            if (side != 0).any():
                may &= side[mine][:, None] != side[other][None, :]
            i, j = np.nonzero(may)
            found.append(np.column_stack([mine[i], other[j], apart[i, j]]))
    pairs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    if not last and len(pairs):
        both = np.concatenate([pairs, pairs[:, [1, 0, 2]]])
        both = both[np.lexsort((both[:, 1], both[:, 2], both[:, 0]))]
        pairs = both[np.concatenate(([True], both[1:, 0] != both[:-1, 0]))]
    return pairs[:, :2]


def _in_blocks(lists: DataFrame, nodes: DataFrame, last: bool) -> DataFrame:
    """(u, v) of long lists (sig, node, root, n: length), block by block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = lists.select("sig", "node", "root", blocks.alias("blocks")).withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block meets itself and every other one once: its rows go to as many groups as there are blocks
    dealt = own.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
        "sig", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), (F.col("b") > F.col("o")).cast("int").alias("side"), "node", "root"
    )
    full = dealt.join(nodes.select("node", F.col("n").alias("size"), "large"), "node").select("sig", "b1", "b2", "side", "node", "root", "size", "large")
    full = full.repartition("sig", "b1", "b2").sortWithinPartitions("sig", "b1", "b2")

    def run(batches):
        names = ["sig", "b1", "b2", "side", "node", "root", "size", "large"]
        held: list[pa.Table] = []

        def compared(group: pa.Table) -> pa.RecordBatch:
            side, node, root, size = (group.column(c).to_numpy() for c in ("side", "node", "root", "size"))
            pairs = near_in_block(side, node, root, size, group.column("large").to_pylist(), last)
            a, b = node[pairs[:, 0]], node[pairs[:, 1]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

        for batch in batches:
            part = pa.Table.from_batches([batch]).select(names)
            keys = np.column_stack([part.column(c).to_numpy() for c in names[:3]])
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if held:
                key = [held[0].column(c)[0].as_py() for c in names[:3]]
                if list(keys[0]) != key:
                    yield compared(pa.concat_tables(held))
                    held = []
            starts = [0, *ends.tolist(), len(keys)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                held.append(part.slice(a, b - a))
                if b < len(keys):  # the last group may go on in the next batch
                    yield compared(pa.concat_tables(held))
                    held = []
        if held:
            yield compared(pa.concat_tables(held))

    return full.mapInArrow(run, "u bigint, v bigint")


def _open_pairs(lists: DataFrame, roots: DataFrame, nodes: DataFrame, seen: DataFrame, last: bool) -> DataFrame:
    """Distinct (u, v) that share a list, belong to different components and are not in ``seen``."""
    placed = lists.select("sig", "node", "n").join(roots, "node", "left").select("sig", "node", "n", F.coalesce("root", "node").alias("root"))
    ends = placed.groupBy("sig").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("sig")
    still = materialize(placed.join(ends, "sig"), "open-lists")
    short = still.where(F.col("n") <= SHORT)
    other = short.select("sig", F.col("node").alias("b"), F.col("root").alias("rb"))
    pairs = short.select("sig", F.col("node").alias("a"), F.col("root").alias("ra")).join(other, "sig").where("ra <> rb AND a > b")
    long = still.where(F.col("n") > SHORT)
    if not last:  # the nearest of the longest list of each node will do
        longest = long.groupBy("node").agg(F.max_by("sig", F.struct("n", "sig")).alias("sig"))
        long = long.join(longest, ["sig", "node"])
    every = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(_in_blocks(long, nodes, last)).distinct()
    out = materialize(every.join(seen, ["u", "v"], "left_anti"), "more-pairs")
    discard(still)
    return out


def _ordered(a, b) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def join_sets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: float = FREQUENT, least_frequent: int = LEAST_FREQUENT
) -> tuple[DataFrame, DataFrame]:
    """(rows, links): rows have doc_id, ``__n``, ``__set``, ``__root`` (the component's smallest
    node, null for empty sets) and ``__component`` (its smallest doc_id); links are pairs (u, v) of different sets, verified, that connect each component."""
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), body_hash(F.col(text)).alias("__body"))
    rows = with_sets(body, "text", _frequent_tokens(body, "text", frequent, least_frequent))
    whole = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "sets")
    key = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    once = materialize(_one_row_a_set(whole), "sets-once")
    rows = materialize(whole.select("doc_id", "__body", "__n", "__set"), "set-keys")
    discard(whole)
    lists = materialize(_posting_lists(once), "postings")
    starred = materialize(_star_pairs(lists), "star-pairs")
    own = once.select(F.col("__set").alias("node"), key.alias("__key"), "__body", F.col("__n").alias("n"), F.col("__small").alias("small"), F.col("__large").alias("large"))
    nodes = materialize(own.join(lists.select("node").distinct(), "node"), "nodes")
    texts = _picked_texts(body.withColumn("__key", key), nodes.select("node", "__key", "__body"))
    texts = materialize(texts, "candidate-texts")
    discard(once)
    links = materialize(_verified(starred, nodes, texts), "star-links")

    seen, roots = starred, components(links)
    for last in (False, True):
        more = _open_pairs(lists, roots, nodes, seen, last)
        found = materialize(_verified(more, nodes, texts), "more-links")
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(found))
        links, seen = links.unionAll(found), seen.unionAll(more)
    discard(lists, texts, nodes)

    root = F.coalesce("root", "node")
    placed_rows = rows.select("doc_id", "__n", F.col("__set").alias("node"), "__body")
    full = placed_rows.where("__n > 0").join(roots, "node", "left").select("doc_id", "__n", "node", "__body", root.alias("root"))
    least = materialize(full.groupBy("root").agg(F.min("doc_id").alias("__component")), "least-ids")
    out = full.join(least, "root").select("doc_id", "__n", F.col("node").alias("__set"), F.col("root").alias("__root"), "__component", "__body")
    empty = placed_rows.where("__n = 0").select(
        "doc_id", "__n", F.col("node").alias("__set"), F.lit(None).cast("bigint").alias("__root"), F.col("doc_id").alias("__component"), "__body"
    )
    return out.unionAll(empty), links


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null counts as smallest of all), of rows
    that share it the one with the smallest hash of the text.

    Rows without words all stay, however they repeat; rows that repeat id and text stay once.
    """
    rows, _ = join_sets(docs, doc_id, text)
    key = F.coalesce(F.col(doc_id), F.lit(_NO_ID))
    placed = rows.where("__n > 0").select("__root", F.coalesce("doc_id", F.lit(_NO_ID)).alias("__key"), "__body")
    first = placed.groupBy("__root").agg(F.min(F.struct("__key", "__body")).alias("f")).select("f.__key", "f.__body")
    wordless = rows.where("__n = 0").select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("__key"), "__body").distinct()
    # which rows stay is known by id and text hash alone: no text is read again for it
    kept = materialize(first.select("*", F.lit(True).alias("__once")).unionAll(wordless.select("*", F.lit(False).alias("__once"))), "kept-rows")
    met = docs.withColumns({"__key": key, "__body": body_hash(F.col(text))}).join(kept, ["__key", "__body"])
    once = met.where("__once").dropDuplicates(["__key", "__body"])
    return once.unionAll(met.where("NOT __once")).select(*docs.columns)
