"""The pipeline's stages, each against a plain version of its decision."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.parameters import PIECE_MODEL
from test_llm_brute import brute_components

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        new = stage(spark, docs, DIR)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert new.columns == columns
        new = new.cache()
        out.append((docs.collect(), new.collect()))
        docs = new
    return out


def test_quality_keeps_good_documents(spark, steps):
    before, after = steps[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    good = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 1]
    bad = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_one_of_each_component_stays(steps):
    before, after = steps[1]
    before = sorted(before, key=lambda r: r["doc_id"])
    found = brute_components([r["text"] for r in before])
    want = {before[i]["doc_id"] for i, (_, root) in found.items() if i == root}
    assert {r["doc_id"] for r in after} == want and len(after) == len(want)


def test_no_benchmark_window_is_left(spark, steps):
    before, after = steps[2]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    windows = set()
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    hit = {r["doc_id"] for r in before for w in [words(r["text"])] if any(tuple(w[i : i + 10]) in windows for i in range(len(w)))}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - hit


def test_secrets_are_masked(steps):
    before, after = steps[3]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    old = {r["doc_id"]: r for r in before}
    for r in after:
        text = old[r["doc_id"]]["text"]
        if r["text"] == text:
            assert r["n_chars"] == old[r["doc_id"]]["n_chars"]
        else:
            assert "[SECRET]" in r["text"] and r["n_chars"] == len(r["text"])
        assert not re.search("[0-9a-f]{16}|AKIA[A-Z0-9]{14}", r["text"])


def test_piece_ids_spell_the_text(steps):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    before, after = steps[4]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    for r in after:
        assert model.decode(list(r["piece_ids"])) == texts[r["doc_id"]] and r["n_pieces"] == len(r["piece_ids"])


def test_run_gives_the_last_stage(spark, steps):
    rows = corpus_pipeline.run(spark, DIR).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in steps[4][1]}


def test_edge_rows_through_the_pipeline(spark, scratch):
    """Null, empty, blank and long texts, null and repeated ids, repeated rows, an extra column with a clashing name."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    secret = "password=abcdefghijkl99 https://h.example/x"
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").first()["text"]
    plain = docs.orderBy("doc_id").where("lang = 'en' AND n_chars > 600").first()["text"]
    edge = [(None, None), (None, None), (None, ""), (90_001, " \n "), (90_001, " \n "), (90_002, plain + " quite new words here"), (90_002, plain + " quite new words here"),
            (None, f"{plain[:400]} {secret} other words at the end"), (90_003, f"some words {item} and more"), (90_004, "w " * 30_000)]
    frame = spark.createDataFrame([(i, t, "en", "src1", None if t is None else len(t)) for i, t in edge], docs.schema)
    both = docs.unionByName(frame).withColumn("start", F.lit("kept"))
    both.write.parquet(f"{scratch}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    rows = corpus_pipeline.run(spark, scratch).collect()
    assert len({str((r["doc_id"], r["piece_ids"])) for r in rows if r["doc_id"] is not None and r["n_pieces"]}) == len([r for r in rows if r["doc_id"] is not None and r["n_pieces"]])
    assert 90_003 not in {r["doc_id"] for r in rows}

    # behind the classifier every row without words stays, copies go, the secret goes and its endpoint stays
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, spark.read.parquet(f"{scratch}/documents.parquet").where("doc_id > 90000 OR doc_id IS NULL"), scratch)
    assert sorted(str((r["doc_id"], r["text"] is None, (r["text"] or "").strip()[:4])) for r in kept.collect()) == sorted(
        map(str, [(None, True, ""), (None, True, ""), (None, False, ""), (90_001, False, ""), (90_001, False, ""), (90_002, False, plain.strip()[:4]),
                  (None, False, plain.strip()[:4]), (90_003, False, "some"), (90_004, False, "w w ")]))
    clean = corpus_pipeline.keep_uncontaminated(spark, kept, scratch)
    assert clean.count() == kept.count() - 1 and clean.columns == both.columns
    masked = corpus_pipeline.mask_secrets(spark, clean, scratch)
    hidden = [r for r in masked.collect() if r["text"] and "[SECRET]" in r["text"]]
    assert [(r["doc_id"], r["n_chars"], r["start"]) for r in hidden] == [(None, len(hidden[0]["text"]), "kept")]
    assert "[SECRET] https://h.example/x" in hidden[0]["text"]
    pieces = corpus_pipeline.to_piece_ids(spark, masked, scratch).collect()
    assert len(pieces) == 8 and sum(r["piece_ids"] is None for r in pieces) == 2


def test_queries_equal_their_sql(spark):
    from oracle_check import compare

    import __spark_entry__ as entry

    names = [n for n in entry.oracle_sql() if re.match(r"op\d+_", n)]
    assert len(names) == 8
    assert all(r["match"] for r in compare(spark, DIR, names).values())
