"""Spelling variant grouping by a variable-length gram index.

Words are counted over all texts.  Two words are near if one code point is inserted, deleted or replaced
between them.  Near words are found as follows, for words between two marks on either side:

1. Gram dictionary: grams of 2 to 4 code points; a gram that occurs more often than ``frequent`` times in the
   words is too common to tell words apart, so it is extended by the next code point.  Only the frequent grams
   are kept, the dictionary's inner nodes and its commonest leaves: fewer than ``total / frequent`` a length,
   and ``frequent`` is at least a 65,536th of all, so at most 196,608 grams are broadcast.
2. Decomposition: from each place the shortest gram that is not frequent, or the longest; a gram within an
   earlier one is left out.  Where a gram ends depends on its own code points alone.
3. Affected grams: for each word the most grams that any one edit can change.  A gram that ends before the edit
   stays; one that begins after it stays if no gram across the edit can reach over it.  Two marks
   leave every word at least one gram that stays.
4. Lists: near words share all their grams but those affected, so of the rarest (affected + 1) grams of each
   they share one, at the same place from the left or from the right.  These grams go into lists by gram, place
   and length, together with those of the next length; each list is sorted together and merged with itself.
5. Lists of more than ``long_list`` words: words that share a one-deletion form are met by (list, form) instead, one
   small group a form.
   No pair is lost and none is listed twice over.
6. All pairs met are verified: first by the letters that stand an odd number of times, then by edit distance.

Forms are followed to the root by doubling; counts at least double along forms, so few rounds do.

Defined results: a null or empty text has no words.  With a null id no run is changed.  Repeated rows
count as often as they stand.  Ties of forms go to the smallest word in code-point order.  An empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, raw_texts, slices

MIN_LETTERS = 5
MIN_COUNT = 3
#: One run in so many loses a code point.
THINNED = 97

SHORTEST, LONGEST = 2, 4
MARKS = LONGEST - 2
FREQUENT = 100
LONG_LIST = 4096
#: Lists of up to so many words are compared all at once; larger ones by so many cells at a time.
_FEW, _CELLS = 16, 1 << 20
#: At most so many frequent grams of one length.
_GRAMS = 1 << 16
#: Distinct runs, and their bytes, that a task counts before it hands them on.
_COUNTED = 200_000
_COUNTED_BYTES = 32 << 20

_LEFT, _RIGHT = "\u0002", "\u0003"


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, thinned: int = THINNED) -> DataFrame:
    """(word, n): the runs of letters of all texts, lower-cased in A-Z, one in ``thinned`` without a code point,
    of at least ``min_letters`` code points and ``min_count`` occurrences."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_letters)

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        held = 0
        for part in slices(batches):
            ids = part.column(0).to_pylist()
            for name, raw in zip(ids, raw_texts(part.column(1)), strict=True):
                if not raw:
                    continue
                seed = None if name is None else zlib.crc32(name.encode() + b":")
                # only A-Z change in the lower-cased bytes
                for word, n in Counter(runs.findall(raw.lower().decode())).items():
                    if seed is not None:
                        h = zlib.crc32(word.encode(), seed)
                        if h % thinned == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_letters:
                                continue
                    if word not in counts:
                        held += len(word)
                    counts[word] += n
                if len(counts) > _COUNTED or held > _COUNTED_BYTES:
                    yield emit(counts)
                    counts, held = Counter(), 0
        if counts:
            yield emit(counts)

    found = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, frequent: int = FREQUENT) -> dict[str, int]:
    """Grams of 2 to 4 code points of the marked words that occur more than ``frequent`` times, or a 65,536th of
    all places if that is more, with their counts; longer ones below frequent ones only."""
    marked = words.select(F.concat(F.lit(_LEFT * MARKS), "word", F.lit(_RIGHT * MARKS)).alias("w"))
    total = marked.agg(F.sum(F.length("w"))).first()[0] or 0
    limit = max(frequent, -(-total // _GRAMS))
    found: dict[str, int] = {}
    for size in range(SHORTEST, LONGEST + 1):
        above = set(found)
        wanted = None if size == SHORTEST else words.sparkSession.sparkContext.broadcast(above)

        def count(batches: Iterator[pa.RecordBatch], size=size, wanted=wanted) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for part in slices(batches, 4096):
                for w in part.column(0).to_pylist():
                    grams = (w[i : i + size] for i in range(len(w) - size + 1))
                    seen.update(grams if wanted is None else (g for g in grams if g[:-1] in wanted.value))
                if len(seen) > _COUNTED:
                    yield _gram_batch(seen)
                    seen = Counter()
            if seen:
                yield _gram_batch(seen)

        counts = marked.mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        found.update((r["gram"], r["n"]) for r in counts.where(F.col("n") > limit).collect())  # fewer than 65,536
    return found


def _gram_batch(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["gram", "n"])


def decompose(marked: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """[start, end) of the variable-length grams of a marked word; both grow along the list."""
    spans, reached, size = [], 0, len(marked)
    for start in range(size - SHORTEST + 1):
        end = start + SHORTEST
        while end < size and end - start < LONGEST and marked[start:end] in frequent:
            end += 1
        if end > reached:
            spans.append((start, end))
            reached = end
    return spans


def affected(size: int, spans: list[tuple[int, int]]) -> int:
    """The most grams of a marked word of ``size`` code points that one edit can change.

    An edit leaves the code points before ``a`` and from ``b`` on.  Grams that end by ``a`` stay.  Of those that
    begin from ``b`` on, one stays if it ends beyond the reach of grams that begin before ``b``."""
    starts, ends = [s for s, _ in spans], [e for _, e in spans]
    most = 0
    for a in range(MARKS, size - MARKS + 1):
        for b in (a, a + 1):  # inserted at a; deleted or replaced at a
            if b > size - MARKS:
                continue
            left = bisect_right(ends, a)
            right = len(spans) - max(bisect_left(starts, b), bisect_right(ends, b + LONGEST - 1))
            most = max(most, len(spans) - left - right)
    return most


def list_keys(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(list, part) of a word: part 0 in lists of words of one length; parts 1 and 2, the shorter and the longer
    word, in lists of two lengths."""
    marked = _LEFT * MARKS + word + _RIGHT * MARKS
    size = len(marked)
    spans = decompose(marked, frequent)
    rarest = sorted(spans, key=lambda s: (frequent.get(marked[s[0] : s[1]], 0), marked[s[0] : s[1]], s[0]))
    rows = set()
    for start, end in rarest[: affected(size, spans) + 1]:
        gram = marked[start:end]
        rows.add((_key(0, gram, start, size), 0))
        # a gram before the edit has its place from the left, one behind it its place from the right
        for side, place in ((1, start), (2, size - start)):
            rows.add((_key(side, gram, place, size + 1), 1))
            rows.add((_key(side, gram, place, size), 2))
    return sorted(rows)


def _key(side: int, gram: str, place: int, size: int) -> int:
    return xxhash.xxh64_intdigest(f"{side} {place} {size} {gram}") - (1 << 63)


_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A3C5E7


def one_deletion_keys(word: str, part: int) -> list[int]:
    """Keys of a word by which its near words of the other part meet it: of equal lengths by the form without
    one code point and its place; else the shorter by itself, the longer by its forms without one.

    Polynomial hashes, so all forms take one pass; equal keys only propose a pair."""
    if part == 1:
        return [_fold(word) + 1]
    heads, power = [0], [1]
    for c in word:
        heads.append((heads[-1] * _BASE + ord(c)) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    size = len(word)
    keys = []
    for i in range(size):
        rest = size - i - 1
        tail = (heads[size] - heads[i + 1] * power[rest]) % _PRIME
        form = (heads[i] * power[rest] + tail) % _PRIME
        keys.append((form * 31 + i + 1) % _PRIME if part == 0 else form + 1)
    return keys if part == 0 else sorted(set(keys))


def _fold(word: str) -> int:
    h = 0
    for c in word:
        h = (h * _BASE + ord(c)) % _PRIME
    return h


def odd_letters(words: pa.Array) -> np.ndarray:
    """64 bits for each word: which letters (by the last six bits of their last byte) stand an odd number of times.
    One edit turns two at most."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    last = np.append((data[1:] & 0xC0) != 0x80, True)[: len(data)]  # the byte that ends a character
    bits = np.where(last, np.uint64(1) << (data & np.uint8(63)).astype(np.uint64), np.uint64(0))
    return np.bitwise_xor.reduceat(bits, ends[:-1] - ends[0]) if len(words) else np.empty(0, np.uint64)


def one_edit(a: str, b: str) -> bool:
    """Whether words of equal length, or a word and one that is longer by one, differ by one edit."""
    i, size = 0, len(a)
    while i < size and a[i] == b[i]:
        i += 1
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(b) == size else a[i:] == b[i + 1 :])


def _alike(odd: np.ndarray, part: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) in the list [low, high) that the odd letters leave, block by block."""
    found_i, found_j = [], []
    step = max(1, _CELLS // (high - low))
    for at in range(low, high, step):
        end = min(high, at + step)
        may = np.bitwise_count(odd[at:end, None] ^ odd[None, at:high]) <= 2
        may &= (part[at:end, None] == 0) | (part[at:end, None] + part[None, at:high] == 3)
        i, j = np.nonzero(np.triu(may, 1))
        found_i.append(i + at)
        found_j.append(j + at)
    return np.concatenate(found_i), np.concatenate(found_j)


def _near_in_lists(key: np.ndarray, part: np.ndarray, words: pa.Array) -> list[tuple[str, str]]:
    """The near pairs of whole lists, sorted by key."""
    odd = odd_letters(words)
    bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(bounds)
    wide = sizes > _FEW
    pairs = [_alike(odd, part, bounds[g], bounds[g + 1]) for g in np.flatnonzero(wide)]
    # the small lists all at once: each row with the next, the next but one and so on
    small = np.repeat(~wide, sizes)
    for gap in range(1, _FEW):
        i = np.flatnonzero((key[gap:] == key[:-gap]) & small[gap:])
        if not len(i):
            break
        j = i + gap
        i, j = i[(may := (np.bitwise_count(odd[i] ^ odd[j]) <= 2) & ((part[i] == 0) | (part[i] + part[j] == 3)))], j[may]
        pairs.append((i, j))
    if not pairs:
        return []
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    turn = part[i] == 2  # the shorter word first
    i, j = np.where(turn, j, i), np.where(turn, i, j)
    own = words.to_pylist()
    met = ((own[x], own[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True))
    return [(min(u, v), max(u, v)) if len(u) == len(v) else (u, v) for u, v in met if one_edit(u, v)]


_LISTED = "key bigint, part int, word string"
_MET = "u string, v string, key bigint, part int"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_LIST_ROWS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("word", pa.string())])
_MET_ROWS = pa.schema([("u", pa.string()), ("v", pa.string()), ("key", pa.int64()), ("part", pa.int32())])


def _lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            yield _batch([(key, role, w) for w in part.column(0).to_pylist() for key, role in list_keys(w, shared.value)], _LIST_ROWS)

    return words.select("word").mapInArrow(run, _LISTED)


def _forms(key: np.ndarray, part: np.ndarray, words: list[str]) -> pa.RecordBatch:
    """Rows of a long list by (list, one-deletion form), as rows that are still to be met."""
    rows = [
        (w, None, (k * 0x9E3779B97F4A7C15 + form) % (1 << 64) - (1 << 63), role)
        for k, role, w in zip(key.tolist(), part.tolist(), words, strict=True)
        for form in one_deletion_keys(w, role)
    ]
    return _batch(rows, _MET_ROWS)


def _merged(lists: DataFrame, long_list: int | None) -> DataFrame:
    """(u, v, key, part): the near pairs among the words of each list (key null), and the rows of lists of more than
    ``long_list`` words by their forms (v null).  A task goes through its lists in order and holds one at a time,
    of a long one no more than ``long_list`` rows."""
    dealt = lists.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        spilled = None  # the long list that goes on

        def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            key, part = rows.column("key").to_numpy(), rows.column("part").to_numpy()
            words = rows.column("word").combine_chunks()
            if long_list is not None:
                size = np.diff(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))))
                long = np.repeat(size > long_list, size)
                if long.any():
                    yield _forms(key[long], part[long], words.filter(pa.array(long)).to_pylist())
                    key, part, words = key[~long], part[~long], words.filter(pa.array(~long))
            found = sorted(set(_near_in_lists(key, part, words)))
            if found:
                yield _batch([(u, v, None, None) for u, v in found], _MET_ROWS)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            key = rows.column("key").to_numpy()
            if spilled is not None:
                more = int(np.searchsorted(key, spilled, side="right"))
                if more:
                    gone = rows.slice(0, more)
                    yield _forms(key[:more], gone.column("part").to_numpy(), gone.column("word").to_pylist())
                    rows, key = rows.slice(more), key[more:]
                if not len(key):
                    continue
                spilled = None
            if held is not None:
                rows = pa.concat_tables([held, rows])
                key = rows.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last list may go on
            if last:
                yield from done(rows.slice(0, last))
            held = rows.slice(last)
            if long_list is not None and held.num_rows > long_list:
                yield from done(held)
                held, spilled = None, int(key[-1])
        if held is not None:
            yield from done(held)

    return dealt.mapInArrow(run, _MET)


def near_pairs(words: DataFrame, frequent: int = FREQUENT, long_list: int = LONG_LIST) -> DataFrame:
    """(u, un, v, vn): the pairs of ``words`` (word, n) at one edit, each once."""
    first = materialize(_merged(_lists(words, frequent_grams(words, frequent)), long_list), "merged-lists")
    # lists by form are short: of a form with a letter more, at one place or anywhere
    split = _merged(first.where("v IS NULL").select("key", "part", F.col("u").alias("word")), None)
    found = first.where("v IS NOT NULL").select("u", "v").unionAll(split.select("u", "v")).distinct()
    one = lambda c: words.select(F.col("word").alias(c), F.col("n").alias(f"{c}n"))
    return found.join(one("u"), "u").join(one("v"), "v").select("u", "un", "v", "vn")


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", frequent: int = FREQUENT, long_list: int = LONG_LIST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs``; see the module."""
    words = materialize(count_words(docs, text, doc_id), "words")
    return group_variants(words, near_pairs(words, frequent, long_list))


def group_variants(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n) with near ``pairs`` (u, un, v, vn)."""
    pairs = materialize(pairs, "near")
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("near"), F.col("vn").alias("near_n")).unionAll(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("near"), F.col("un").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left")
    counts = F.coalesce(-F.col("best.less") >= 2 * F.col("n"), F.lit(False))
    judged = materialize(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(counts, F.col("best.near")).alias("form"), F.when(counts, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # follow the forms: every round doubles the steps
    steps = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return judged.join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
