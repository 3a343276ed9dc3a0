"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the sources, by code point and null last, take the weights in turn and share ``budget`` of
all words; a target stops at ``most`` times its source's words and the excess is shared again by
weight until none is above.  All sums behind a target are whole numbers, so reruns agree.

Blocks: the documents of a source are laid end to end in an order shuffled by the md5 of their id,
and this stream is cut into blocks of equally many words; a block ends and begins inside documents.

Schedule: slot i takes the van der Corput point of i (its bits reversed) through the cumulative
targets to a source, so every stretch of the mix is near the weights.  Slots are ranked per source,
and the r-th slot of a source takes its block r, in a second round over the stream from its start
again.  The last slot of a source is cut where its target is met; slots beyond are dropped, and a source
that has fewer slots than blocks to take (the points miss a share by about the logarithm of their number)
gets its last blocks behind the schedule.  So a source gives its target, cut to whole words.

Scale: ranks and positions are sums over chunks of slots or buckets of the shuffle order, each of
bounded size, plus the sums before; the hottest source spreads over its buckets.  Sources may be many:
they are ranked by ranges and met by intervals of the unit line, never collected.

Defined results: a null or blank text has 0 words and is never taken (it has a row in
``document_shares``).  Null sources are one source, the last.  Null ids and repeated rows are documents
of their own.  An empty table, or one without words, has no slots.  Extra columns are ignored.
Column names that begin with ``__`` are the operator's own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ordering import with_position
from .common import materialize

WEIGHTS = (3, 1, 2)
#: Shared words as a fraction of all words, and the most of a source's words that its target may be.
BUDGET = (3, 2)
MOST = 2
BLOCK_WORDS = 8192

_WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"
#: Slots a chunk when slots are ranked; documents a bucket, about, when positions are summed.
_CHUNK = 4096
_BUCKET = 1024


@dataclass(frozen=True)
class Mix:
    """``documents``: one row per document with its place in its source's stream (``__low``, ``__high``
    in words); ``sources``: ``__source``, ``__words``, ``__target``; ``slots``: ``__slot``, ``__source``,
    ``__round``, ``__block``, ``__from``, ``__to`` (words of the stream), in the order of ``__slot``."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int


def count_words(text: str) -> Column:
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '{_WORD}')"), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: tuple[int, int] = BUDGET, most: int = MOST) -> DataFrame:
    """(__source, __words, __target, __place) from (__source, __words).

    Each round shares what is left by weight among the sources below their limit, as one aggregate; it ends
    when the share takes no further source above its limit."""
    placed = with_position(sizes, F.col("__source").asc_nulls_last(), name="__place")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("__place") - 1) % len(weights) + 1).cast("int"))
    rows = materialize(placed.withColumn("__weight", weight.cast("bigint")), "sources")
    limit = F.col("__words") * most
    total = rows.agg(F.sum("__words")).first()[0] or 0
    above, below = budget
    # a share of one weight is left / (below * weights of the open sources), both whole numbers
    left, share, open_weight = total * above, None, None
    wide = lambda c: c.cast("decimal(38,0)")
    while total:
        is_open = F.lit(True) if share is None else wide(F.col("__weight")) * F.lit(share) < wide(limit) * F.lit(open_weight * below)
        seen = rows.agg(
            F.sum(F.when(is_open, F.col("__weight"))).alias("w"), F.sum(F.when(~is_open, wide(limit))).alias("capped")
        ).first()
        if not seen["w"]:
            break
        now = (left - int(seen["capped"] or 0) * below, int(seen["w"]))
        if now == (share, open_weight):
            break
        share, open_weight = now
    if not total or share is None:
        target = F.lit(0.0)
    else:
        target = F.least(
            (F.col("__weight") * F.lit(share)).cast("double") / F.lit(float(open_weight * below)), limit.cast("double")
        )
    return rows.select("__source", "__words", target.alias("__target"), "__place")


def _streams(docs: DataFrame, bucket_digits: int, keys: list[str]) -> DataFrame:
    """``docs`` (with __source, __size, __key) with [__low, __high): their words in the shuffled stream of
    their source."""
    bucket = F.substring("__key", 1, bucket_digits)
    bucketed = docs.withColumn("__bucket", bucket)
    here = Window.partitionBy("__source", "__bucket").orderBy("__key", *keys)
    upto = F.sum("__size").over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    by_source = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        bucketed.groupBy("__source", "__bucket").agg(F.sum("__size").alias("n"))
        .select("__source", "__bucket", F.coalesce(F.sum("n").over(by_source), F.lit(0)).alias("__before"))
    )
    local = bucketed.withColumn("__upto", upto).withColumnsRenamed({"__source": "__s", "__bucket": "__b"})
    met = local.join(before, F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__b") == F.col("__bucket")))
    high = F.col("__before") + F.col("__upto")
    return met.drop("__s", "__b").withColumn("__low", high - F.col("__size")).withColumn("__high", high).drop(
        "__before", "__upto", "__bucket"
    )


def van_der_corput(slot: Column, bits: int) -> Column:
    """The ``bits`` bits of ``slot`` reversed: the point of ``slot`` as a whole number below 2^bits."""
    return F.conv(F.rpad(F.reverse(F.conv(slot.cast("string"), 10, 2)), bits, "0"), 2, 10).cast("bigint")


def _schedule(sources: DataFrame, n_slots: int, n_sources: int, block_words: int) -> DataFrame:
    """(__slot, __source, __rank): the slots below ``n_slots`` with their sources, ranked from 0 per source."""
    bits = max(1, (n_slots - 1).bit_length())
    points = 1 << bits
    # cumulative words as whole points of the line: the same whole number gives the same edge on both its sides
    upto = F.sum("__due").over(Window.partitionBy("__group").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    grouped = sources.withColumn("__group", F.floor(F.col("__place") / _CHUNK))
    groups = grouped.groupBy("__group").agg(F.sum("__due").alias("n"))
    total = groups.agg(F.sum("n")).first()[0]
    # one row per 4,096 sources
    ahead = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("__group", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__offset"))
    summed = grouped.withColumn("__upto", upto).join(offsets, "__group")
    edge = lambda c: F.round(c / F.lit(total) * F.lit(float(points))).cast("bigint")
    right = F.col("__offset") + F.col("__upto")
    lines = summed.select(
        "__source", edge(right - F.col("__due")).alias("__left"), edge(right).alias("__right")
    ).where("__left < __right")
    # the line in cells, of which few sources share one: an interval join on the cell
    cells_bits = min(bits, max(12, n_sources.bit_length() + 1))
    width = points >> cells_bits
    last = F.floor((F.col("__right") - 1) / width)
    cells = lines.withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__left") / width), last)))
    point = van_der_corput(F.col("id"), bits)
    slots = sources.sparkSession.range(n_slots).select(F.col("id").alias("__slot"), point.alias("__point"))
    dealt = (
        slots.withColumn("__cell", F.floor(F.col("__point") / width))
        .join(cells, "__cell")
        .where("__point >= __left AND __point < __right")
        .select("__slot", "__source", F.floor(F.col("__slot") / _CHUNK).alias("__chunk"))
    )
    dealt = materialize(dealt, "slots")
    ahead = Window.partitionBy("__source").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("__source", "__chunk").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("__source").alias("__s"), F.col("__chunk").alias("__c"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__before"))
    )
    rank = F.row_number().over(Window.partitionBy("__source", "__chunk").orderBy("__slot"))
    return (
        dealt.withColumn("__rank", rank)
        .join(before, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__chunk") == F.col("__c")))
        .select("__slot", "__source", (F.col("__before") + F.col("__rank") - 1).alias("__rank"))
    )


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """The mix of ``docs``; ``pieces`` and ``document_shares`` read it."""
    name = F.col(doc_id)
    sized = docs.select(
        name.alias("__id"),
        F.col(source).alias("__source"),
        count_words(text).alias("__size"),
        F.md5(F.concat(F.coalesce(name.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary")).alias("__key"),
    )
    sized = materialize(sized, "sizes")
    sources = materialize(source_targets(sized.groupBy("__source").agg(F.sum("__size").alias("__words")), weights, budget, most), "targets")
    # the stream of a source: whole hex digits of the shuffle key make its buckets
    n_docs = sized.count()
    digits = max(0, -(-max(0, (n_docs // _BUCKET).bit_length()) // 4))
    documents = materialize(_streams(sized, digits, ["__size"]), "streams")

    due = F.floor("__target").cast("bigint")  # whole words
    per_round = F.ceil(F.col("__words") / block_words)  # blocks of one pass, the last one shorter
    rounds = F.floor(due / F.col("__words"))
    rest = due - rounds * F.col("__words")
    needed = rounds * per_round + F.ceil(rest / block_words)
    plan = materialize(
        sources.where("__words > 0 AND __target >= 1").select(
            "__source", "__words", "__place", due.alias("__due"), per_round.alias("__blocks"),
            rounds.alias("__rounds"), rest.alias("__rest"), needed.alias("__needed"),
        ),
        "plan",
    )
    sums = plan.agg(F.sum("__needed").alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    n_slots = int(sums["slots"] or 0)
    spark = docs.sparkSession
    if not n_slots:
        kind = sized.schema["__source"].dataType.simpleString()
        empty = spark.createDataFrame([], f"__slot bigint, __source {kind}, __round bigint, __block bigint, __from bigint, __to bigint")
        return Mix(documents, sources, empty, block_words)

    ranked = _schedule(plan, n_slots, int(sums["sources"]), block_words)
    given = ranked.groupBy("__source").agg(F.count(F.lit(1)).alias("__given")).withColumnRenamed("__source", "__s")
    due_rows = plan.join(given, F.col("__source").eqNullSafe(F.col("__s")), "left")
    # the blocks that the schedule left out, behind it
    behind = due_rows.where("coalesce(__given, 0) < __needed").select(
        "__source", F.explode(F.sequence(F.coalesce("__given", F.lit(0)), F.col("__needed") - 1)).alias("__rank"), "__place"
    )
    behind = with_position(behind, F.col("__rank").asc(), F.col("__place").asc(), name="__late")
    behind = behind.select((F.col("__late") + n_slots - 1).alias("__slot"), "__source", F.col("__rank").cast("bigint").alias("__rank"))
    slots = ranked.unionByName(behind).withColumnRenamed("__source", "__s").join(
        plan, F.col("__s").eqNullSafe(F.col("__source"))
    ).where("__rank < __needed")
    turn = F.floor(F.col("__rank") / F.col("__blocks"))
    block = F.col("__rank") - turn * F.col("__blocks")
    end = F.least((block + 1) * block_words, F.when(turn < F.col("__rounds"), F.col("__words")).otherwise(F.col("__rest")))
    slots = slots.select(
        "__slot", "__source", turn.cast("bigint").alias("__round"), block.cast("bigint").alias("__block"),
        (block * block_words).cast("bigint").alias("__from"), end.cast("bigint").alias("__to"),
    )
    return Mix(documents, sources, materialize(slots, "schedule"), block_words)


def pieces(mix: Mix) -> DataFrame:
    """The mix as rows: __slot, __source, __round, __block, __id, __low (the document's first word in its
    source's stream) and [__first, __end), the words of the document that the slot takes."""
    last = F.floor((F.col("__high") - 1) / mix.block_words)
    spread = mix.documents.where("__size > 0").withColumn(
        "__block", F.explode(F.sequence(F.floor(F.col("__low") / mix.block_words), last))
    )
    slots = mix.slots.withColumnsRenamed({"__source": "__s", "__block": "__b"})
    met = spread.join(slots, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")))
    first, end = F.greatest("__low", "__from"), F.least("__high", "__to")
    return met.where(first < end).select(
        "__slot", "__source", "__round", F.col("__block").cast("bigint").alias("__block"), "__id", "__low",
        (first - F.col("__low")).alias("__first"), (end - F.col("__low")).alias("__end"),
    )


def document_shares(mix: Mix) -> DataFrame:
    """One row per document: __id, __source, __size, __words and __target of its source, __taken (words that
    the mix takes, repeats counted) and __pieces."""
    taken = pieces(mix).groupBy(F.col("__source").alias("__s"), F.col("__low").alias("__l")).agg(
        F.sum(F.col("__end") - F.col("__first")).alias("__taken"), F.count(F.lit(1)).alias("__pieces")
    )
    # a document with words is known by its source and first word; one without takes part in no piece
    whole = mix.documents.join(
        taken, (F.col("__size") > 0) & F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__low") == F.col("__l")), "left"
    )
    of = mix.sources.select(F.col("__source").alias("__of"), "__words", "__target")
    return whole.join(of, F.col("__source").eqNullSafe(F.col("__of"))).select(
        "__id", "__source", "__size", "__words", "__target",
        F.coalesce("__taken", F.lit(0)).cast("bigint").alias("__taken"), F.coalesce("__pieces", F.lit(0)).cast("bigint").alias("__pieces"),
    )


def piece_texts(docs: DataFrame, mix: Mix, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``pieces`` with __text, the taken words joined by blanks.  Needs ids that are unique and not null."""
    words = docs.select(F.col(doc_id).alias("__doc"), F.expr(f"regexp_extract_all(`{text}`, '({_WORD})', 1)").alias("__ws"))
    return pieces(mix).join(words, F.col("__id") == F.col("__doc")).withColumn(
        "__text", F.array_join(F.slice("__ws", (F.col("__first") + 1).cast("int"), (F.col("__end") - F.col("__first")).cast("int")), " ")
    ).drop("__ws", "__doc")
