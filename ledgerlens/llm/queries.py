"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, decontaminate, licenses, mixing, ngram_join, pieces, prefix_trie, quality, secrets, spelling, topk, toxicity, urls
from .common import table
from .oracle_sql import ORACLE_SQL  # noqa: F401
from .parameters import PIECE_MODEL, URL_RULES

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text")))
    of = lambda *kinds: F.coalesce(F.filter("__spans", lambda s: s["kind"].isin(*kinds)), F.array())
    base = F.filter("__spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("__spans")).alias("spans"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    model = pieces.Pieces(pieces.read_model(PIECE_MODEL))
    encoded = pieces.encode_texts(docs, model, n=2, packed=True)
    both = F.concat(F.array("__ids"), "__next_ids").alias("__both")
    decoded = pieces.decode_ids(encoded.select("doc_id", "text", "__score", "__scores", both), model, "__both")
    ids, text = (lambda k: F.get("__both", F.lit(k))), (lambda k: F.get("__decoded", F.lit(k)))
    second = F.get("__scores", F.lit(1))
    return decoded.select(
        "doc_id",
        (F.octet_length(ids(0)) / 4).cast("bigint").alias("n_pieces"),
        F.sha2(ids(0), 256).alias("ids_sha256"),
        F.col("__score").alias("score"),
        second.alias("second_score"),
        F.sha2(ids(1), 256).alias("second_ids_sha256"),
        F.col("text").eqNullSafe(text(0)).alias("round_trip"),
        (F.octet_length(ids(1)) / 4).cast("bigint").alias("second_n_pieces"),
        F.when(second.isNotNull(), F.col("text").eqNullSafe(text(1))).alias("second_round_trip"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score_quality(docs, model, keep_text=False).select(
        "doc_id",
        F.col("__score").alias("score"),
        F.col("__p_text").alias("p_text"),
        F.col("__p_meta").alias("p_meta"),
        (F.col("__score") >= quality.KEEP).alias("keep"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = chunks.repeated_passages(table(spark, sf_dir, "documents"))
    line = lambda p: F.concat_ws(":", p["start"].cast("string"), p["end"].cast("string"), p["keeper"].cast("string"))
    return passages.withColumn("parts", F.array_join(F.transform("parts", line), ","))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ngram_join.join_sets(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("__n").alias("n_shingles"), F.col("__component").alias("component_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    lexicon = toxicity.fit_lexicon(docs, labels.where(remainder != 2))
    return toxicity.score_toxicity(docs, lexicon, keep_text=False).select(
        "doc_id",
        F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.3).cast("int").alias("predicted"),
        F.col("__hits").alias("n_lexicon_hits"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").cast("string").alias("url"))
    judged = urls.judge_urls(pages, URL_RULES)
    return judged.select(
        "page_id",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.col("__verdict").alias("verdict"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs, licenses.fit_licenses(docs))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.whole_steps("embedding").alias("vector"))
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").cast("string").alias("text"))
    return mixing.document_shares(mixing.mix_sources(docs)).select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__words").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256"
    )


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality": op3_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_license_scan": op8_license_scan,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_decontamination": op10_decontamination,
    "op11_source_mix": op11_source_mix,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}
