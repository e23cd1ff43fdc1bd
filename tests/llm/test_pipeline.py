"""The stages one by one against plain versions, and the whole run."""

from collections import Counter

import brute
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from textmill.llm import language_id, piece_sampling, simhash_cover

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    stages = dict(pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    clear = stages["language"](spark, docs, SF)
    model = language_id.fit(docs)
    assert clear.columns == docs.columns
    kept = {r["doc_id"] for r in clear.collect()}
    assert kept == {i for i, t in rows.items() if not language_id.identify(t, model)[2]} and len(kept) > 0.95 * len(rows)

    exact = stages["exact_dedup"](spark, docs, SF)
    best: dict = {}
    for i, t in rows.items():
        best[brute.sha(t)] = max(i, best.get(brute.sha(t), -1))
    assert exact.columns == docs.columns and {r["doc_id"] for r in exact.collect()} == set(best.values())

    near = stages["near_dedup"](spark, docs, SF)
    marks = {r["doc_id"]: r["component_id"] for r in simhash_cover.simhash_classes(docs).collect()}
    assert near.columns == docs.columns and sorted(r["doc_id"] for r in near.collect()) == sorted(set(marks.values()))

    mixed = stages["mix"](spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0

    vocabulary = piece_sampling.read_vocabulary()
    encoded = stages["encode"](spark, docs, SF).select("doc_id", F.explode("samples.ids").alias("ids"))
    assert all(r["decoded"] == rows[r["doc_id"]] for r in piece_sampling.decode(encoded, vocabulary).collect())

    # The whole run is the five plain stages in a row, each over what the one before kept.
    whole = pipeline.run(spark, SF)
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    left = {i: t for i, t in rows.items() if i in kept}
    best = {}
    for i, t in left.items():
        best[t] = max(i, best.get(t, -1))
    left = {i: left[i] for i in best.values()}
    roots = brute.near_roots(left)
    left = {i: left[i] for i in set(roots.values())}
    copies = brute.mix_copies(left, sources)
    assert whole.columns == ["doc_id", "lang", "source", "samples"]
    assert Counter(r["doc_id"] for r in whole.collect()) == copies and len(copies) > 50


def test_documents_without_labels_pass(spark, tmp_path):
    sf = str(tmp_path)
    spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert dict(pipeline.STAGES)["language"](spark, docs, sf).count() == docs.count()
    assert pipeline.run(spark, sf).count() > 0


def test_empty_and_odd_documents(spark, tmp_path):
    kind = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, rank STRING"
    for name, rows in (("none", []), ("odd", [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "x"), (2, "The cat and the dog of the house", "en", None, 1, None)] * 2)):
        sf = str(tmp_path / name)
        spark.createDataFrame(rows, kind).write.parquet(f"{sf}/documents.parquet")
        out = pipeline.run(spark, sf).collect()
        assert {r["doc_id"] for r in out} <= {2}
