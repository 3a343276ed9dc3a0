"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Text is lower-cased (A-Z) and cut into words of letters, digits and all
characters beyond ASCII.  A window is ``window`` consecutive words of an item (a
shorter item is one window).  The distinct windows become the patterns of one
automaton, each document is scanned once, and hit words are mapped back to code
point offsets of the original text.

The patterns are broadcast.  Their bytes are summed first; windows beyond
``block_bytes`` are dealt by hash into as many automata as needed, each applied
in a pass of its own, so no pattern is left out and no broadcast passes the bound.  The hit words of
all passes are joined, so the result is the same for any number of automata.

Defined results: a null or empty text, or one without words, has no words and no
hits.  Items without words (or without id) are never found.  Items that repeat
count once.  Rows are handled one by one: repeated rows and null ids give one
result row each.  Extra columns of the documents pass through, those of the items are ignored; a column of
the documents with the name of a result is an error.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, slices, with_text_columns

WINDOW = 10
#: Bound on the bytes of the patterns of one broadcast automaton.
BLOCK_BYTES = 8 << 20

#: Word bytes stay (A-Z in lower case), all other bytes become spaces.
_WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

#: The automata this Python worker has built, by digest of their patterns.
_built: dict[str, ahocorasick.Automaton] = {}


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (pattern, n_words, items) of all items."""

    def run(batches):
        for part in slices(batches):
            ids, raws = part.column(0).to_pylist(), raw_texts(part.column(1))
            rows = set()
            for item, raw in zip(ids, raws, strict=True):
                words = normal_words(raw) if raw is not None and item is not None else []
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    piece = words[at : at + window]
                    rows.add((b" " + b" ".join(piece) + b" ", len(piece), item))
            found = sorted(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in found], pa.binary()),
                    pa.array([r[1] for r in found], pa.int32()),
                    pa.array([r[2] for r in found], pa.string()),
                ],
                names=["pattern", "n_words", "item"],
            )

    windows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return (
        windows.mapInArrow(run, "pattern binary, n_words int, item string")
        .groupBy("pattern", "n_words")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _automaton(digest: str, patterns: list[tuple[bytes, int, list[str]]]) -> ahocorasick.Automaton:
    if digest not in _built:
        _built.clear()  # one at a time
        automaton = ahocorasick.Automaton()
        for pattern, n_words, items in patterns:
            automaton.add_word(pattern.decode("latin-1"), (n_words, items))
        automaton.make_automaton()
        _built[digest] = automaton
    return _built[digest]


def _spans(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code point offsets (end exclusive) of the original text."""
    word = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b]])} for a, b in zip(first, last, strict=True)]


def scan_text(raw: bytes | None, automaton) -> tuple[int, int, list[str], list[dict], list[int]]:
    """(words, hit words, items, spans, numbers of the hit words) of one text."""
    words = normal_words(raw) if raw else []
    if not words:
        return 0, 0, [], [], []
    line = b" " + b" ".join(words) + b" "
    found = list(automaton.iter(line.decode("latin-1")))
    if not found:
        return len(words), 0, [], [], []
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    after = np.searchsorted(gaps, [end for end, _ in found])
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, after - [n for _, (n, _) in found], 1)
    np.add.at(cover, after, -1)
    hit = np.cumsum(cover)[:-1] > 0
    items = sorted({i for _, (_, own) in found for i in own})
    return len(words), int(hit.sum()), items, _spans(raw, hit), np.flatnonzero(hit).tolist()


_HITS = ("__n_words", "__n_hit", "__items", "__spans", "__hits")


def _scan(docs: DataFrame, text: str, patterns: list, keep_text: bool, whole: bool) -> DataFrame:
    digest = hashlib.sha256(repr(patterns).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def make():
        automaton = _automaton(digest, shared.value) if shared.value else None

        def compute(raws):
            rows = [scan_text(raw, automaton) if automaton is not None else (len(normal_words(raw or b"")), 0, [], [], []) for raw in raws]
            columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], [], []]
            return columns if whole else columns[:4]

        return compute

    fields = [
        ("__n_words", "bigint", pa.int64()),
        ("__n_hit", "bigint", pa.int64()),
        ("__items", "array<string>", pa.list_(pa.string())),
        ("__spans", "array<struct<start:int,end:int>>", _SPANS),
    ]
    if whole:
        fields.append(("__hits", "array<int>", pa.list_(pa.int32())))
    return with_text_columns(docs, text, make, fields, drop_text=not keep_text)


def _spans_of_hits(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__spans`` made anew from the text and all of its ``__hits``."""
    names = docs.columns

    def run(batches):
        for part in slices(batches):
            texts = raw_texts(part.column(names.index(text)))
            rows = []
            for raw, found in zip(texts, part.column(names.index("__hits")).to_pylist(), strict=True):
                hit = np.zeros(len(normal_words(raw)) if raw else 0, bool)
                hit[found] = True
                rows.append(_spans(raw, hit) if found else [])
            yield part.set_column(names.index("__spans"), "__spans", pa.array(rows, _SPANS))

    return docs.mapInArrow(run, docs.schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_hit``, ``__items`` and ``__spans`` (code points)."""
    taken = [c for c in docs.columns if c in _HITS or c.startswith("__seen")]
    if taken:
        raise ValueError(f"columns {taken} have names of the results")
    windows = item_windows(benchmark, item_id, item_text, window)
    total = windows.agg(F.sum(F.length("pattern") + F.lit(64) * F.size("items"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))

    def patterns(block: int) -> list:
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block)
        return sorted((bytes(r["pattern"]), r["n_words"], list(r["items"])) for r in part.collect())

    if blocks == 1:
        return _scan(docs, text, patterns(0), keep_text, whole=False)
    # several automata: hit words and items of a row are joined over the passes, its spans are made of all hits
    out = docs
    for block in range(blocks):
        held = {c: f"__seen{c}" for c in ("__items", "__hits")} if block else {}
        out = _scan(out.withColumnsRenamed(held), text, patterns(block), True, whole=True)
        if block:
            both = {c: F.array_sort(F.array_union(c, f"__seen{c}")) for c in held}
            out = out.withColumns(both).drop(*held.values())
        out = out.select(*docs.columns, *(_HITS if block == blocks - 1 else ("__items", "__hits")))
    out = _spans_of_hits(out, text).withColumn("__n_hit", F.size("__hits").cast("bigint"))
    return out.select(*[c for c in docs.columns if keep_text or c != text], *_HITS[:4])
