"""Conversation prefix trie: subtree totals by time-forward processing.

Every distinct sequence of the first d turns (role, text) of a conversation is a node of depth d; the
root is the textless node.  Totals flow from the leaves to the root: the nodes are sorted externally by
reverse level order, and each passes its total to its parent through a priority queue keyed by
the parent's place in that order; when the sweep reaches the parent, its messages are at the head of the
queue.  The queue spills sorted runs and merges them, so its memory is bounded.

1. Turns are numbered by ranges of (conversation, turn), so a huge conversation spreads over the ranges.
2. A node is known by its depth and two 64-bit xors over its turns, each hashed with its place (the turn
   itself by 120 bits of its md5): a prefix xor, summed by blocks of turns and then over blocks.
3. Nodes are grouped into runs: nodes of one chain with equal members.  A run has one total to receive, and
   the totals of its nodes follow from their place in it, so long conversations are one row each.
4. Shards: a run is heavy if it has more than a ``shards``-th of all memberships (a conversation is a member of
   each node on its path) as members, or all conversations.  So there are at most ``shards`` heavy runs and that
   of the root, however large the input.  Below them hang light subtrees; each goes to the shard of its
   topmost node.  The shards are swept, then their roots' totals, summed by heavy parent, go through one
   sweep over the heavy runs: across the shard roots.

Defined results: rows of a conversation are ordered by turn (null first), then role, then text; null role
or text is empty.  Rows without conv_id belong to no conversation.  Repeated rows are turns of their own.
An empty table has no nodes, not even the root.  Extra columns are ignored.  Column names that begin with ``__`` are the operator's own.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, slices

SHARDS = 64
#: Messages that a queue holds in memory, and runs it keeps before it merges them.
QUEUE_ROWS = 200_000
QUEUE_RUNS = 16

_ROW_BITS = 33
#: Turns a block in the prefix sums; conversation ids a block in the digests of ends.
_TURNS = 1024
_ENDS = 8192


class SpillingQueue:
    """A priority queue of (key, value, ...) tuples with bounded memory.

    Beyond ``rows`` tuples the heap is sorted, messages of one key are added up, and the run goes to an
    unnamed scratch file of this task (gone with the task, rebuilt when the task runs again); more than
    ``runs`` runs are merged into one.  ``pop(key)`` adds up all messages of ``key``, the smallest there is."""

    def __init__(self, rows: int = QUEUE_ROWS, runs: int = QUEUE_RUNS):
        self.rows, self.max_runs, self.heap, self.runs, self.spills = rows, runs, [], [], 0

    def push(self, key: tuple, values: tuple) -> None:
        heapq.heappush(self.heap, (key, values))
        if len(self.heap) > self.rows:
            self._spill(_added(iter(sorted(self.heap))))
            self.heap = []
            if len(self.runs) > self.max_runs:
                merged = _added(heapq.merge(*[_chain(r) for r in self.runs]))
                self.runs = []
                self._spill(merged)

    def _spill(self, messages: Iterator[tuple]) -> None:
        file = tempfile.TemporaryFile()
        for m in messages:
            pickle.dump(m, file, protocol=pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self.spills += 1
        run = _read(file)
        head = next(run, None)
        if head is not None:
            self.runs.append([head, run])

    def pop(self, key: tuple) -> tuple | None:
        """The sum of the messages of ``key``, or None without any."""
        total = None
        while self.heap and self.heap[0][0] == key:
            total = _plus(total, heapq.heappop(self.heap)[1])
        for run in self.runs:
            while run[0] is not None and run[0][0] == key:
                total = _plus(total, run[0][1])
                run[0] = next(run[1], None)
        self.runs = [r for r in self.runs if r[0] is not None]
        return total


def _plus(a: tuple | None, b: tuple) -> tuple:
    return b if a is None else tuple(x + y for x, y in zip(a, b, strict=True))


def _read(file) -> Iterator[tuple]:
    with file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def _chain(run: list) -> Iterator[tuple]:
    yield run[0]
    yield from run[1]


def _added(messages: Iterator[tuple]) -> Iterator[tuple]:
    last, total = None, None
    for key, values in messages:
        if last is not None and key != last:
            yield last, total
            total = None
        last, total = key, _plus(total, values)
    if last is not None:
        yield last, total


def sweep(runs: Iterator[dict], most: int | None = None, queue_rows: int = QUEUE_ROWS) -> Iterator[tuple[int, int, int]]:
    """(children, leaves, saved below) of every run, given in reverse level order: by ``bottom`` descending,
    then ``conv_id``, then ``n_convs``.  ``children``, ``leaves`` and ``below`` of a run are what it got from other
    sweeps.  Parents with more than ``most`` members are not in this sweep and get no message."""
    queue = SpillingQueue(queue_rows)
    for r in runs:
        got = queue.pop((-r["bottom"], r["conv_id"], r["n_convs"])) or (0, 0, 0)
        children, leaves, below = r["children"] + got[0], r["leaves"] + got[1], r["below"] + got[2]
        if not children:
            leaves = 1
        yield children, leaves, below
        if r["parent_conv_id"] is not None and (most is None or r["parent_n_convs"] <= most):
            parent = (1 - r["top"], r["parent_conv_id"], r["parent_n_convs"])
            queue.push(parent, (1, leaves, below + (r["n_convs"] - 1) * r["bytes"]))


_TOTALS = ["children", "leaves", "below"]


def _sweep_shards(runs: DataFrame, most: int | None, queue_rows: int) -> DataFrame:
    """``runs``, dealt and sorted within their partitions, with their totals."""
    names = runs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def rows() -> Iterator[dict]:
            for part in slices(batches, 8192):
                waiting.append(part)
                yield from part.to_pylist()

        totals: list[tuple] = []
        for t in sweep(rows(), most, queue_rows):
            totals.append(t)
            if len(totals) == waiting[0].num_rows:
                yield _with_totals(waiting.pop(0), totals, names)
                totals = []

    return runs.mapInArrow(run, runs.schema)


def _with_totals(part: pa.RecordBatch, totals: list[tuple], names: list[str]) -> pa.RecordBatch:
    new = dict(zip(_TOTALS, (pa.array(c, pa.int64()) for c in zip(*totals, strict=True)), strict=True))
    return pa.RecordBatch.from_arrays([new.get(n, part.column(i)) for i, n in enumerate(names)], names=names)


def _bits(hex_text: Column, at: int) -> Column:
    """60 bits of an md5 as a number."""
    return F.conv(F.substring(hex_text, at, 15), 16, 10).cast("bigint")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, a, b, bytes): the turns in order; a and b are 120 bits of the turn's md5, bytes
    those of its text.  Written once, so places stay as they are."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # the length of the role tells where it ends
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text").cast("binary"))
    kept = sorted_turns.select(
        "conv_id", F.monotonically_increasing_id().alias("row"), digest.alias("digest"), F.octet_length("text").cast("bigint").alias("bytes")
    ).select("conv_id", "row", _bits(F.col("digest"), 1).alias("a"), _bits(F.col("digest"), 17).alias("b"), "bytes")
    kept = materialize(kept, "turns").withColumn("part", F.shiftright("row", _ROW_BITS))
    # a conversation has rows in one range, or in a few next to each other
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(by_part), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return kept.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("row") + F.col("shift")).alias("pos"), "a", "b", "bytes")


def rebuild(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation c took over the first h turns of conversation c - c % family
    for its own first h, h = crc32 of decimal c % most.  Conversations: conv_id, length (0 for a turnless one)."""
    turns = materialize(turns, "numbered")
    lead = F.col("conv_id") - F.col("conv_id") % family
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("lead")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("head")  # fewer than ``most`` turns
    )
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h")
    convs = own.select("conv_id", "own", h, lead.alias("lead")).join(heads, "lead", "left")
    head = F.coalesce(F.filter("head", lambda t: t["pos"] <= F.col("h")), F.array())
    convs = convs.select("conv_id", "h", head.alias("head"), F.size(head).alias("n_head"),
                         (F.size(head) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("bigint").alias("length"))
    convs = materialize(convs, "rebuilt")
    taken = convs.select("conv_id", F.explode("head").alias("t"), "length").select(
        "conv_id", "t.pos", "t.a", "t.b", "t.bytes", "length"
    )
    rest = turns.join(convs.select("conv_id", "h", "n_head", "length").where("length > n_head"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), "a", "b", "bytes", "length"
    )
    return taken.unionByName(rest), convs.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with p, q (the prefix's key), its parent's key and ``upto``, the bytes of the prefix."""
    block = F.floor((F.col("pos") - 1) / _TURNS)
    hashed = turns.select(
        "conv_id", "pos", "bytes", "length", block.alias("block"),
        F.xxhash64(F.lit(1), "pos", "a", "b").alias("x"), F.xxhash64(F.lit(2), "pos", "b", "a").alias("y"),
    )
    here = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = hashed.select(
        "*", F.expr("bit_xor(x)").over(here).alias("p"), F.expr("bit_xor(y)").over(here).alias("q"), F.sum("bytes").over(here).alias("upto")
    )
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.where(F.col("length") > _TURNS).groupBy("conv_id", "block").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("bytes").alias("n")
    )
    before = sums.select("conv_id", "block", *[F.expr(e).over(ahead).alias(n) for e, n in (("bit_xor(x)", "bx"), ("bit_xor(y)", "by"), ("sum(n)", "bn"))])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    p, q = F.col("p").bitwiseXOR(zero("bx")), F.col("q").bitwiseXOR(zero("by"))
    return local.join(before.where("block > 0"), ["conv_id", "block"], "left").select(
        "conv_id", "pos", "length", "bytes", p.alias("p"), q.alias("q"),
        p.bitwiseXOR(F.col("x")).alias("pp"), q.bitwiseXOR(F.col("y")).alias("pq"), (F.col("upto") + zero("bn")).alias("upto"),
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, p, q, ends_sha256): the ids that end at a node, ascending, comma-joined and hashed.

    Ids are joined by blocks of the id line, then a node's blocks run through one hash in order."""
    blocks = ends.groupBy("depth", "p", "q", F.floor(F.col("conv_id") / _ENDS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    key = ["depth", "p", "q"]
    dealt = blocks.repartition(*key).sortWithinPartitions(*key, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for part in slices(batches, 8192):
            columns = [part.column(part.schema.get_field_index(n)).to_pylist() for n in (*key, "ids")]
            for *node, ids in zip(*columns, strict=True):
                if node == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(ids.encode())
            if done:
                yield _digest_batch(done)
                done = []
        if now is not None:
            yield _digest_batch([(*now, digest.hexdigest())])

    return dealt.mapInArrow(run, "depth bigint, p bigint, q bigint, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["depth", "p", "q", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame, shards: int = SHARDS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, pos, a, b, bytes, length) of ``convs`` (conv_id, length):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes (of the
    subtree: bytes of a node's last text times its members but one) and ends_sha256."""
    paths = materialize(_prefixes(turns), "paths")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        *[F.lit(0).cast("bigint").alias(n) for n in ("depth", "p", "q")], *[F.lit(None).cast("bigint").alias(n) for n in ("pp", "pq")],
        "n_convs", "conv_id", *[F.lit(0).cast("bigint").alias(n) for n in ("bytes", "upto")],
    )
    inner = paths.groupBy(F.col("pos").cast("bigint").alias("depth"), "p", "q").agg(
        F.min("pp").alias("pp"), F.min("pq").alias("pq"), F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("bytes").alias("bytes"), F.min("upto").alias("upto"),
    )
    nodes = materialize(inner.unionByName(root), "nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p").alias("pp"), F.col("q").alias("pq"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n_convs"),
    )
    nodes = materialize(nodes.join(parents, ["depth", "pp", "pq"], "left"), "linked")

    # nodes of one chain with equal members: one run
    lead = F.min(F.struct("depth", "parent_conv_id", "parent_n_convs", (F.col("upto") - F.col("bytes")).alias("before")))
    runs = nodes.groupBy("conv_id", "n_convs").agg(lead.alias("lead"), F.max("depth").alias("bottom"), F.max("upto").alias("upto")).select(
        "conv_id", "n_convs", F.col("lead.depth").alias("top"), "bottom", "upto", (F.col("upto") - F.col("lead.before")).alias("bytes"),
        "lead.parent_conv_id", "lead.parent_n_convs", *[F.lit(0).cast("bigint").alias(n) for n in _TOTALS],
    )
    runs = materialize(runs, "runs")
    sums = nodes.agg(F.sum("n_convs").alias("members"), F.max("n_convs").alias("convs")).first()
    light = min(-(-(sums["members"] or 0) // shards), (sums["convs"] or 1) - 1)
    # a light subtree is known by its topmost node, the first light one on the path of any member
    heavy_nodes = nodes.where(F.col("n_convs") > light).select(F.col("depth").alias("pos"), "p", "q", F.lit(True).alias("heavy"))
    tops = paths.join(heavy_nodes, ["pos", "p", "q"], "left").where("heavy IS NULL").groupBy("conv_id").agg(
        F.min(F.struct("pos", "p", "q")).alias("top_node")
    )
    order = [F.col("bottom").desc(), F.col("conv_id").asc(), F.col("n_convs").asc()]
    below = runs.where(F.col("n_convs") <= light).join(tops, "conv_id", "left")
    dealt = below.repartition(shards, F.col("top_node.p"), F.col("top_node.q")).sortWithinPartitions(*order).select(*runs.columns)
    swept = materialize(_sweep_shards(dealt, light, queue_rows), "shards")

    from_roots = swept.where(F.col("parent_n_convs") > light).groupBy(
        F.col("parent_conv_id").alias("conv_id"), F.col("parent_n_convs").alias("n_convs")
    ).agg(
        F.count(F.lit(1)).alias("c"), F.sum("leaves").alias("l"), F.sum(F.col("below") + (F.col("n_convs") - 1) * F.col("bytes")).alias("s")
    )
    above = runs.where(F.col("n_convs") > light).drop(*_TOTALS).join(from_roots, ["conv_id", "n_convs"], "left").select(
        *runs.columns[: -len(_TOTALS)], *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(n) for c, n in zip("cls", _TOTALS, strict=True)]
    )
    # at most ``shards`` rows and the root's
    crown = _sweep_shards(above.repartition(1).sortWithinPartitions(*order).select(*runs.columns), None, queue_rows)

    done = swept.unionByName(crown).select("conv_id", "n_convs", "bottom", F.col("upto").alias("run_upto"), *_TOTALS)
    ends = paths.where("pos = length").select(F.col("pos").cast("bigint").alias("depth"), "p", "q", "conv_id").unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("bigint").alias(n) for n in ("depth", "p", "q")], "conv_id")
    )
    inside = F.col("depth") < F.col("bottom")
    return nodes.join(done, ["conv_id", "n_convs"]).join(_end_digests(ends), ["depth", "p", "q"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.when(inside, F.lit(1)).otherwise(F.col("children")).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("run_upto") - F.col("upto") + F.col("bytes"))).alias("saved_bytes"),
        F.coalesce(F.col("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, shards: int = SHARDS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """``prefix_trie`` of the rebuilt ``conversations`` (conv_id, turn, role, text)."""
    turns, convs = rebuild(ordered_turns(conversations))
    return prefix_trie(turns, convs, shards, queue_rows)
