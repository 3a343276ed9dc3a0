"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash of a byte position, h = (h << 1) + gear[byte], covers the last 16 bytes (of
16 bits, older bytes are shifted out).  A chunk ends where the hash is the smallest of
all within ``RADIUS`` bytes on either side, so cuts depend on nearby bytes only, chunks have
more than ``RADIUS`` bytes, and an insertion moves the cuts near it and no others.  Chunks are
compared by a 128-bit digest; one that stands in two documents or more is repeated.

Repeated chunks that follow each other in a document form a run.  The chunks at the two
ends of a shared passage also hold bytes from outside of it, so a run is shorter than the passage
by about 90 bytes.  A run is therefore a seed, however short: on either side it is extended over its
neighbouring chunks as far as the text equals that of the smallest or the largest document that has the
chunk at this end (whichever agrees further; a document isn't compared with itself).
Extended passages of ``MIN_WORDS`` words or more are reported; a word that a passage ends within
counts only if a chunk of the run holds its beginning.  A passage is missed only if no whole chunk lies in
it.

What may be removed is told by the parts of a passage.  A part is a stretch of chunks whose smallest document, the
keeper, is the same and has them in the same sequence, with those ends of the passage that agree with it; so its whole
text stands in the keeper.  Where the keeper is the document itself the part stays.  The removed text of a
document thus always stands in a smaller one, and what is removed there in a smaller one still:
``remove_repeats`` takes out whole words only, and no word is lost everywhere.

Digest lists are never gathered: counts are aggregated by digest and written, then joined back, so the join sees their
size and a chunk in a third of all documents spreads over tasks.

Defined results: null and empty texts have no chunks.  A text without a cut is one chunk.
Rows with a null id take no part.  Rows that repeat an id count as one document, so a
passage that only they share is not repeated; each distinct run is reported once, and where their texts differ
nothing is removed from them.  A chunk that stands
in the compared document several times is taken where it stands first.  Extra columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, raw_texts, slices

RADIUS = 20
MIN_WORDS = 25
_BLANK = re.compile("[ \\t\\n\\v\\f\\r]")
#: Neighbouring chunks that are compared.  Texts that agree over a whole chunk and the 36 bytes of hash window and
#: radius beyond have the same cuts there, so the run would go on; two more chunks are longer.
_NEIGHBOURS = 3

#: 256 gear values from a rule: the digests of the bytes.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)
_CHUNKS = pa.schema(
    [("doc_id", pa.int64()), ("place", pa.int32()), ("digest", pa.binary()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())]
)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, by doubling: h_2n[t] = h_n[t] + (h_n[t - n] << n)."""
    h = GEAR[data]
    for n in (1, 2, 4, 8):
        h[n:] += h[:-n] << np.uint16(n)
    return h


def cut_ends(data: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text; the last is its length."""
    size = len(data)
    if size <= 2 * radius + 1:
        return np.array([size])
    h = gear_hashes(data)
    # ties of the hash go to the later byte: compare (hash, -position) by position-aware minima
    width = 2 * radius + 1
    least, span = h, 1
    while span * 2 <= width:
        least = np.minimum(least[span:], least[:-span])
        span *= 2
    rest = width - span
    least = np.minimum(least[rest:], least[: len(least) - rest]) if rest else least
    middle = h[radius : size - radius]
    at = np.flatnonzero(middle == least) + radius
    if len(at) > 1:  # equal minima within the radius: the first stays
        gaps = np.diff(at)
        if (gaps <= radius).any():
            kept = [at[0]]
            for p in at[1:]:
                if p - kept[-1] > radius:
                    kept.append(p)
            at = np.array(kept)
    ends = at + 1
    return ends if len(ends) and ends[-1] == size else np.append(ends, size)


def _chunk_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the chunks of a text."""
    data = np.frombuffer(raw, np.uint8)
    ends = cut_ends(data)
    return data, np.concatenate(([0], ends[:-1])), ends


def _digest(part) -> bytes:
    return xxhash.xxh128_digest(part)


def _words_begun(data: np.ndarray) -> np.ndarray:
    """Where words begin."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    return ~blank & np.concatenate(([True], blank[:-1]))


def chunk_rows(raw: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(digests, starts, ends, words begun) of the chunks of a text; offsets in code points."""
    data, starts, ends = _chunk_bounds(raw)
    view = memoryview(raw)
    digests = [_digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    begun = np.concatenate(([0], np.cumsum(_words_begun(data))))
    if raw.isascii():
        points = np.arange(len(data) + 1)
    else:
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return digests, points[starts], points[ends], begun[ends] - begun[starts]


def contexts(raw: bytes, places: list[tuple[int, bytes]]) -> list[tuple[int, bytes, bytes, bytes]]:
    """(place, digest, bytes before, bytes after) of the chunks of a text that stand at ``places`` with their digests."""
    _, starts, ends = _chunk_bounds(raw)
    out = []
    for place, digest in places:
        if place < len(ends) and _digest(raw[starts[place] : ends[place]]) == digest:
            first, last = max(0, place - _NEIGHBOURS), min(len(ends) - 1, place + _NEIGHBOURS)
            # a byte more at either end tells whether a word begins or goes on there
            out.append((place, digest, raw[max(0, starts[first] - 1) : starts[place]], raw[ends[place] - 1 : ends[last] + 1]))
    return out


def extension(own: bytes, other: bytes, before: bool) -> tuple[int, int]:
    """(code points, words) by which a passage goes on before or after a chunk: the part common to both contexts."""
    a, b = (own[::-1], other[::-1]) if before else (own, other)
    size = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a[:size], np.uint8) != np.frombuffer(b[:size], np.uint8))
    n = int(differ[0]) if len(differ) else size
    data = np.frombuffer(own, np.uint8)
    begun, points = _words_begun(data), (data & 0xC0) != 0x80
    if before:
        return int(points[len(own) - n :].sum()), int(begun[len(own) - n :].sum())
    while 0 < n < len(own) and not points[n]:  # no part of a character
        n -= 1
    words = int(begun[1:n].sum())  # the first byte is the chunk's last
    if words and n < len(own) and not begun[n] and not own[n - 1 : n].isspace() and not own[n : n + 1].isspace():
        words -= 1  # its last word goes on
    return int(points[1:n].sum()), words


def chunk_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, place, digest, start, end, words), a row for each chunk."""

    def run(batches):
        for part in slices(batches):
            ids, columns = [], [[], [], [], [], []]
            for own, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1)), strict=True):
                if raw:
                    digests, starts, ends, words = chunk_rows(raw)
                    ids.append(np.full(len(digests), own, np.int64))
                    for c, values in zip(columns, (np.arange(len(digests)), np.array(digests, object), starts, ends, words), strict=True):
                        c.append(np.asarray(values))
            cells = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (ids, *columns)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, _CHUNKS, strict=True)], schema=_CHUNKS)

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, place int, digest binary, start int, end int, words int")


def _context_table(docs: DataFrame, places: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, place, digest, before, after) of the chunks in ``places`` (doc_id, place, digest)."""
    own = places.groupBy("doc_id").agg(F.collect_list(F.struct("place", "digest")).alias("places"))  # of one document
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).join(own, "doc_id")

    def run(batches):
        for part in slices(batches):
            out = []
            for own, raw, wanted in zip(part.column(0).to_pylist(), raw_texts(part.column(1)), part.column(2).to_pylist(), strict=True):
                if raw:
                    out += [(own, *x) for x in contexts(raw, [(w["place"], w["digest"]) for w in wanted])]
            cells = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["doc_id", "place", "digest", "before", "after"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=names)

    found = rows.select("doc_id", "text", "places").mapInArrow(run, "doc_id bigint, place int, digest binary, before binary, after binary")
    # rows that repeat an id may have other texts around the chunk
    return found.groupBy("doc_id", "place", "digest").agg(F.min("before").alias("before"), F.min("after").alias("after"))


def _extensions(pairs: DataFrame) -> DataFrame:
    """(doc_id, run, front, keeper, points, words) of pairs (doc_id, run, front, keeper, own, other)."""

    def run(batches):
        for part in slices(batches):
            ids, runs, front, keeper, own, other = (c.to_pylist() for c in part.columns)
            found = [extension(a, b, f) for a, b, f in zip(own, other, front, strict=True)]
            cells = [ids, runs, front, keeper, [p for p, _ in found], [w for _, w in found]]
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32())
            names = ["doc_id", "run", "front", "keeper", "points", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=names)

    kind = "doc_id bigint, run int, front boolean, keeper boolean, points int, words int"
    return pairs.select("doc_id", "run", "front", "keeper", "own", "other").mapInArrow(run, kind)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of repeated chunks, extended: doc_id, start, end (code points), n_chunks, n_words, first_doc_id (the keeper
    of the first chunk) and parts, an array of (start, end, keeper) in order."""
    chunks = chunk_table(docs, doc_id, text)
    repeated = chunks.groupBy("digest").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("high"))
    repeated = repeated.select("digest", F.col("first.doc_id").alias("low"), F.col("first.place").alias("low_place"), "high").where("low <> high")
    repeated = materialize(repeated, "repeated-digests")
    found = materialize(chunks.join(repeated, "digest"), "repeated-chunks")
    discard(repeated)
    by_doc = Window.partitionBy("doc_id").orderBy("place")
    edge = F.struct("place", "digest", "low", "high")
    placed = found.distinct().withColumn("run", F.col("place") - F.row_number().over(by_doc))
    # stretches of a run that one keeper has in the same sequence
    along = F.col("place") - F.col("low_place")
    stretch = F.col("place") - F.row_number().over(Window.partitionBy("doc_id", "run", "low", along).orderBy("place"))
    placed = placed.withColumn("stretch", stretch).withColumn("along", along)
    stretches = placed.groupBy("doc_id", "run", "low", "along", "stretch").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_chunks"), F.sum("words").alias("n_words"),
        F.min(edge).alias("first"), F.max(edge).alias("last"),
    )
    part = F.struct("start", "end", F.col("low").alias("keeper"))
    runs = stretches.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_chunks").alias("n_chunks"), F.sum("n_words").alias("n_words"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.sort_array(F.collect_list(part)).alias("parts"),  # of one document
    )
    runs = materialize(runs, "chunk-runs")
    sides = F.array(F.struct(F.lit(True).alias("front"), F.col("first").alias("edge")), F.struct(F.lit(False).alias("front"), F.col("last").alias("edge")))
    ends = runs.select("doc_id", "run", F.explode(sides).alias("side")).select("doc_id", "run", "side.front", "side.edge.*")
    others = F.explode(F.array("low", "high")).alias("partner")
    # where the compared documents have the chunk first
    partners = ends.select("digest", others).distinct()
    first = found.select("digest", F.col("doc_id").alias("partner"), "place").join(partners, ["digest", "partner"])
    first = first.groupBy("digest", "partner").agg(F.min("place").alias("place")).select(F.col("partner").alias("doc_id"), "place", "digest")
    first = materialize(first, "first-places")
    places = ends.select("doc_id", "place", "digest").union(first).distinct()
    known = materialize(_context_table(docs, places, doc_id, text), "chunk-contexts")
    side = F.when(F.col("front"), F.col("before")).otherwise(F.col("after"))
    own = ends.join(known, ["doc_id", "place", "digest"]).select("doc_id", "run", "front", "digest", "low", "high", side.alias("own"))
    own = own.select("doc_id", "run", "front", "digest", "low", "own", others).where("partner <> doc_id")
    other = known.join(first, ["doc_id", "place", "digest"]).select("digest", F.col("doc_id").alias("partner"), "before", "after")
    pairs = own.join(other, ["digest", "partner"]).select(
        "doc_id", "run", "front", (F.col("partner") == F.col("low")).alias("keeper"), "own", side.alias("other")
    )
    most = lambda column, front, of: F.coalesce(F.max(F.when((F.col("front") == front) & of, F.col(column))), F.lit(0))
    longer = _extensions(pairs).groupBy("doc_id", "run").agg(
        *[most(c, f, F.lit(True)).alias(f"{c}_{f}") for c in ("points", "words") for f in (True, False)],
        *[most("points", f, F.col("keeper")).alias(f"kept_{f}") for f in (True, False)],
    )
    longer = materialize(longer, "extensions")
    discard(found, first, known)
    added = lambda column: F.coalesce(F.col(column), F.lit(0))
    n = F.size("parts")

    def grown(p, i):
        start = F.when(i == 0, p["start"] - added("kept_True")).otherwise(p["start"])
        end = F.when(i == n - 1, p["end"] + added("kept_False")).otherwise(p["end"])
        return F.struct(start.alias("start"), end.alias("end"), p["keeper"].alias("keeper"))

    return (
        runs.join(longer, ["doc_id", "run"], "left")
        .select(
            "doc_id",
            (F.col("start") - added("points_True")).alias("start"),
            (F.col("end") + added("points_False")).alias("end"),
            "n_chunks",
            (F.col("n_words") + added("words_True") + added("words_False")).alias("n_words"),
            F.col("first.low").alias("first_doc_id"),
            F.transform("parts", grown).alias("parts"),
        )
        .where(F.col("n_words") >= min_words)
    )


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the whole words of each span: from behind its first blank to before its last one, so that
    the words next to its ends stay."""
    out, at = [], 0
    for start, end in spans:
        blanks = [m.start() for m in _BLANK.finditer(text, max(start, at), end)]
        if len(blanks) > 1:
            out.append(text[at : blanks[0] + 1])
            at = blanks[-1] + 1
    return "".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removable parts of their ``passages`` taken out of the text.

    Rows whose id stands with several texts stay as they are, and so do those without id or passages."""
    parts = passages.select(F.col("doc_id").alias("__id"), F.explode("parts").alias("p")).where("p.keeper <> __id")
    cuts = parts.groupBy("__id").agg(F.sort_array(F.collect_list(F.struct("p.start", "p.end"))).alias("__cuts"))  # of one document
    texts = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("__id")).agg(F.count_distinct(F.xxhash64(text)).alias("n"))
    cuts = materialize(cuts.join(texts.where("n = 1"), "__id").select("__id", "__cuts"), "cuts")
    met = docs.join(cuts, F.col(doc_id).cast("bigint") == F.col("__id"), "left").select(*docs.columns, "__cuts")
    names = docs.columns

    def run(batches):
        for part in slices(batches):
            place = names.index(text)
            body = part.column(place)
            if part.column(len(names)).null_count < part.num_rows:
                both = zip(body.to_pylist(), part.column(len(names)).to_pylist(), strict=True)
                body = pa.array([without_words(t, [(c["start"], c["end"]) for c in cuts]) if t and cuts else t for t, cuts in both], body.type)
            columns = [body if i == place else part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return met.mapInArrow(run, docs.schema)
