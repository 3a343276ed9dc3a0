"""Edge rows for every operator: nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import chunks, decontaminate, licenses, ngram_join, pieces, quality, secrets, topk, toxicity, urls
from ledgerlens.llm.parameters import PIECE_MODEL

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # clash with names that the operators or their results use
        T.StructField("node", T.StringType()),
        T.StructField("sig", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("start", T.LongType()),
    ]
)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


LONG = words(20_000, 1)
ROWS = [
    (1, words(80, 2)),
    (2, words(80, 2)),  # a copy
    (2, words(80, 2)),  # a repeated row
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "two words"),
    (7, "Two  WORDS"),
    (None, words(60, 3)),
    (None, None),
    (8, LONG),
    (9, LONG + " more"),
    (10, "日本語のテキスト 😀 " + words(30, 4)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 3 else "en", "s", None if t is None else len(t), "x", 7, "k", 0.5, 3) for i, t in ROWS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def test_secrets(docs, none):
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["__spans"] is None for r in rows)
    assert secrets.find_secrets(none).count() == 0
    assert secrets.mask_secrets(docs).count() == len(ROWS)


def test_secrets_in_edge_rows(spark):
    """Secrets under null, repeated and equal ids, and behind long texts: one result row for each row."""
    strong, weak = "password=abcdefghijkl99", "user=bob"
    rows = [(None, strong), (None, strong), (1, f"{weak} {strong}"), (1, f"{weak} {strong}"), (1, weak), (2, LONG + strong), (3, None), (4, "")]
    frame = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id bigint, text string, kind string, start bigint").repartition(3)
    found = secrets.find_secrets(frame).collect()
    assert len(found) == len(rows) and all(r["kind"] == "k" and r["start"] == 1 for r in found)
    spans = sorted(str((r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["__spans"] or []])) for r in found)
    both = [("account", 0, 8), ("assign", 9, 32)]
    want = [(None, [("assign", 0, 23)])] * 2 + [(1, both)] * 2 + [(1, []), (2, [("assign", len(LONG), len(LONG) + 23)]), (3, []), (4, [])]
    assert spans == sorted(map(str, want))
    masked = sorted(str((r["doc_id"], r["text"][-30:] if r["text"] else r["text"])) for r in secrets.mask_secrets(frame).collect())
    assert masked == sorted(map(str, [(None, "[SECRET]")] * 2 + [(1, "[SECRET] [SECRET]")] * 2 + [(1, weak), (2, (LONG + "[SECRET]")[-30:]), (3, None), (4, "")]))


def test_pieces(docs, none):
    model = pieces.Pieces(pieces.read_model(PIECE_MODEL))
    rows = pieces.decode_ids(pieces.encode_texts(docs, model, packed=True), model).collect()
    assert sorted(str((r["text"], r["node"])) for r in rows) == sorted(str((t, "x")) for _, t in ROWS)
    assert all(r["__decoded"] == r["text"] for r in rows)
    assert {r["__score"] for r in rows if r["text"] == ""} == {0.0}
    assert all(r["__ids"] is None for r in rows if r["text"] is None)
    assert pieces.encode_texts(none, model).count() == 0


def test_quality(docs, none, labels):
    model = quality.fit_quality(docs, labels)
    assert {r["__score"] for r in quality.score_quality(docs, model).collect()} == {1.0}
    marked = labels.unionAll(docs.sparkSession.createDataFrame([(i, i % 2, 0) for i in range(11)] + [(None, 1, 0), (99, 1, 0), (1, None, 0)], labels.schema))
    model = quality.fit_quality(docs, marked)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["__score"] <= 1 and r["node"] == "x" for r in rows)
    assert quality.score_quality(none, quality.fit_quality(none, marked)).count() == 0


def test_chunks(docs, none):
    rows = chunks.repeated_passages(docs).collect()
    found = {r["doc_id"] for r in rows}
    assert found == {1, 2, 8, 9}
    assert {r["first_doc_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert sum(r["doc_id"] == 2 for r in rows) == 1  # repeated rows give a run once
    assert chunks.repeated_passages(none).count() == 0


def test_ngram_join(docs, none):
    rows, _ = ngram_join.join_sets(docs)
    rows = rows.collect()
    assert len(rows) == len(ROWS)
    component = {r["doc_id"]: r["__component"] for r in rows if r["doc_id"] is not None}
    assert component == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10}
    sizes = {r["doc_id"]: r["__n"] for r in rows}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[6] == sizes[7] == 1
    assert ngram_join.join_sets(none)[0].count() == 0
    kept = ngram_join.drop_near_duplicates(docs).collect()
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 8, 10]
    assert ids.count(None) == 2 and kept[0].__fields__ == DOCS.names
    assert ngram_join.drop_near_duplicates(none).count() == 0


def test_rows_without_words_all_stay(spark):
    rows = [(None, None), (None, None), (None, ""), (None, " "), (7, ""), (7, " \n"), (7, "a b c d e f g"), (7, "a b c d e f g"), (7, "A b c d e f g"), (3, "a B c d e f g")]
    frame = spark.createDataFrame([(i, t, j) for j, (i, t) in enumerate(rows)], "doc_id bigint, text string, n bigint").repartition(4)
    kept = ngram_join.drop_near_duplicates(frame).collect()
    assert sorted(r["n"] for r in kept) == [0, 1, 2, 3, 4, 5, 9]
    # of rows that share the smallest id and the set, one by the hash of its text, whatever the partitions
    same = spark.createDataFrame([(1, "x y z w v u"), (1, "X y z w v u"), (1, "x Y z w v u")], "doc_id bigint, text string")
    assert len({ngram_join.drop_near_duplicates(same.repartition(p)).first()["text"] for p in (1, 2, 3)}) == 1


def test_toxicity(docs, none, labels):
    lexicon = toxicity.fit_lexicon(docs, labels)
    rows = toxicity.score_toxicity(docs, lexicon).collect()
    assert len(rows) == len(ROWS) and all(r["__score"] < 1e-6 for r in rows)
    assert toxicity.score_toxicity(none, lexicon).count() == 0


def test_toxicity_with_a_lexicon_in_edge_rows(docs, none, spark):
    """Entries of any length and frequency; null, empty, long and repeated rows are scored one by one."""
    rude = "q" * 60
    rows = [(100 + i, f"{words(20, i)} {rude if i % 2 else ''} {words(5, i + 50)}") for i in range(40)]
    marked = spark.createDataFrame([(i, None, i % 2) for i, _ in rows] + [(None, None, 1), (100, None, None), (999, None, 1)], "doc_id bigint, quality int, toxic int")
    texts = docs.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id bigint, text string"))
    lexicon = toxicity.fit_lexicon(texts, marked)
    assert f"{rude}$" in lexicon.weights
    scored = toxicity.score_toxicity(texts, lexicon).collect()
    assert len(scored) == len(ROWS) + len(rows)
    high = {r["doc_id"] for r in scored if r["__score"] >= 0.5}
    assert high == {i for i, _ in rows if i % 2}


def test_licenses(docs, none):
    model = licenses.fit_licenses(docs)
    assert licenses.scan_licenses(docs, model).count() == 0
    assert licenses.scan_licenses(none, licenses.fit_licenses(none)).count() == 0


def test_licenses_in_edge_rows(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(None, notice), (1, notice), (1, notice), (2, f"{LONG} {notice}"), (3, None), (4, "\n\n"), (5, f"x\n{notice}\r\n{notice}")]
    frame = spark.createDataFrame([(i, t, "s", 0.5) for i, t in rows], "doc_id bigint, text string, start string, chance double").repartition(2)
    model = licenses.fit_licenses(frame)
    found = licenses.scan_licenses(frame, model).where("confirmed").collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "5", "5", "None"]
    assert {r["family"] for r in found} == {"apache-2.0"}


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame([(1, "two words", 5), (1, "two words", 6), (2, None, 7), (None, "zzz", 8), (3, "", 9), (4, "日本語のテキスト", 1)], "item_id bigint, text string, doc_id bigint")
    rows = decontaminate.decontaminate(docs, items).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r["__items"] for r in rows if r["__n_hit"]}
    assert found == {6: ["1"], 7: ["1"], 10: ["4"]}
    empty = items.limit(0)
    assert decontaminate.decontaminate(docs, empty).where("__n_hit > 0").count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0


def test_decontamination_by_several_automata(docs, none, spark):
    """Edge rows and clashing names: the same result for any number of automata; result names are refused."""
    items = [(i, w) for i, (_, t) in enumerate(ROWS) if t for w in (" ".join(t.split()[3:20]), " ".join(t.split()[:2])) if w]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    named = docs.withColumns({"__mine": F.lit(7), "__o__items": F.lit("x")})
    one, many = (decontaminate.decontaminate(named, bench, block_bytes=b) for b in (1 << 20, 300))
    assert one.columns == many.columns == [*named.columns, *decontaminate._HITS[:4]]
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert {r["__mine"] for r in many.collect()} == {7} and many.where("__n_hit > 0").count() >= 5
    assert "text" not in decontaminate.decontaminate(named, bench, block_bytes=300, keep_text=False).columns
    assert decontaminate.decontaminate(none, bench, block_bytes=300).count() == 0
    with pytest.raises(ValueError, match="__spans"):
        decontaminate.decontaminate(docs.withColumn("__spans", F.lit(1)), bench)


def test_urls(spark):
    kind = "page_id bigint, url string, host string, __verdicts string"
    rows = [(1, None, "h", "v"), (2, "", "h", "v"), (3, "no scheme", "h", "v"), (1, None, "h", "v"), (None, "http://A.net/x" + "y" * 50_000, "h", "v")]
    judged = urls.judge_urls(spark.createDataFrame(rows, kind), [("block", "net", "/")]).collect()
    assert len(judged) == 5
    assert {(r["__host"], r["__path"][:2], r["__rule"], r["__verdict"]) for r in judged} == {("", "", None, "allow"), ("a.net", "/x", "net/", "block")}
    assert urls.judge_urls(spark.createDataFrame([], kind), []).count() == 0


def test_top_k(spark):
    kind = "vec_id bigint, embedding array<float>, label int, score int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1, 1), (0, [1.0, 0.5], 1, 1), (1, [1.0], 1, 1), (2, [1.0, 0.0], 1, 1), (3, None, 1, 1), (4, [None, 1.0], 1, 1), (5, [nan, 1.0], 1, 1), (6, [inf], 1, 1), (None, [9.0, 9.0], 1, 1), (50, [], 1, 1)]
    vectors = spark.createDataFrame(rows, kind).select("vec_id", topk.whole_steps("embedding").alias("vector"))
    got = topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0")).collect()
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)  # the repeated row takes two places
    assert found == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, 0), (50, 1, 0, 0), (50, 2, 0, 0), (50, 3, 1, 0), (50, 4, 2, 0)]
    assert topk.exact_top_k(vectors.limit(0), vectors.limit(0)).count() == 0
