"""Corpus pipeline: quality, near duplicates, decontamination, secrets, piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's ``docs``.  All but the last return the columns of ``documents``:

1. ``quality``: documents that the co-trained classifier scores below 0.5 go.
2. ``near_duplicates``: of each component of the n-gram Jaccard join one document stays, the one
   with the smallest id (rows without words all stay, however they repeat).
3. ``decontaminate``: documents that hold a window of a benchmark item go.
4. ``secrets``: all spans that the secret scan reports, but endpoints, are replaced by ``[SECRET]`` in the text,
   and ``n_chars`` follows; no document goes.
5. ``piece_ids``: doc_id, lang, source, the ids of the best segmentation, their number, its score
   and that of the second best.

Defined results: null and empty texts pass stages 2 to 4 unchanged and have no ids (null for
null).  Rows with a null id are handled like others in stages 1, 3, 4 and 5; in stage 2 null is the
smallest id.  Extra columns of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, ngram_join, pieces, quality, secrets
from ledgerlens.llm.common import materialize, table
from ledgerlens.llm.parameters import PIECE_MODEL

MASK = "[SECRET]"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score_quality(docs, model).where(F.col("__score") >= quality.KEEP).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col("__n_hit") == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.mask_secrets(docs, mask=MASK)
    if "n_chars" in docs.columns:
        changed = F.col("__spans").isNotNull()
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def to_piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.Pieces(pieces.read_model(PIECE_MODEL))
    encoded = pieces.encode_texts(docs.select("doc_id", "lang", "source", F.col("text").cast("string").alias("text")), model, n=2, keep_text=False)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.col("__ids").alias("piece_ids"),
        F.size("__ids").cast("bigint").alias("n_pieces"),
        F.col("__score").alias("score"),
        F.get("__scores", F.lit(1)).alias("second_score"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontaminate", keep_uncontaminated),
    ("secrets", mask_secrets),
    ("piece_ids", to_piece_ids),
]

#: The classifier, the components and the lattice search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
