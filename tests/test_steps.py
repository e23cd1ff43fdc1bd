"""Steps that outlive a crash."""

import os
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textmill.operators.language import lang_model, lang_profile
from textmill.plans.corpus import prepare_corpus, run_corpus
from textmill.plans.steps import Step, StepFault, StepRun


def test_restart_lifetime_and_faults(spark, tmp_path):
    made, broken = [], [True]

    def noted(name, frame):
        made.append(name)
        return frame

    def fragile(first):
        if broken[0]:
            raise RuntimeError("lost")
        return noted("third", first.where("id > 5"))

    steps = [
        Step("first", (), lambda: noted("first", spark.range(10))),
        Step("second", ("first",), lambda t: noted("second", t.withColumn("x", F.nullif("id", F.lit(3)))), {"x: null": F.col("x").isNull()}, 0.5),
        Step("third", ("second",), fragile),
    ]
    folder = str(tmp_path / "job")
    with pytest.raises(RuntimeError, match="lost"):
        StepRun(spark, folder, steps, "k").run(["third"])
    assert made == ["first", "second"] and not os.path.exists(f"{folder}/first")  # its only reader was done

    broken[0] = False
    # What a killed task left behind has no marker and is written again.
    spark.range(99).write.parquet(f"{folder}/third")
    run = StepRun(spark, folder, steps, "k")
    assert rows(run.run(["third"])["third"].select("id")) == [(i,) for i in range(6, 10)]
    assert made == ["first", "second", "third"] and run.rows("second") == 10 and run.faults("second") == {"x: null": 1}
    assert not run.present("second") and run.done("second")
    assert StepRun(spark, folder, steps, "k").run(["third"])["third"].count() == 4 and len(made) == 3
    with pytest.raises(ValueError, match="belongs to"):
        StepRun(spark, folder, steps, "other")
    strict = [steps[0], Step("second", ("first",), steps[1].make, steps[1].faults, 0.05)]
    bad = StepRun(spark, str(tmp_path / "bad"), strict)
    with pytest.raises(StepFault, match="x: null"):
        bad.run(["second"])
    assert not bad.done("second")
    empty = StepRun(spark, str(tmp_path / "empty"), [Step("none", (), lambda: spark.range(0), {"null": F.col("id").isNull()})])
    assert empty.run(["none"])["none"].count() == 0


def test_steps_run_at_the_same_time_and_fall_together(spark, tmp_path):
    met = threading.Barrier(2, timeout=60)

    def meet(_):
        met.wait()  # passes only when both steps are being made
        return spark.range(3)

    steps = [Step("root", (), lambda: spark.range(3)), Step("left", ("root",), meet), Step("right", ("root",), meet)]
    out = StepRun(spark, str(tmp_path / "both"), steps).run(["left", "right"])
    assert [t.count() for t in out.values()] == [3, 3]

    def slow():
        met.wait()
        return spark.range(0, 200_000_000, 1, 4).select(F.sha2(F.sha2(F.col("id").cast("string"), 512), 512).alias("h")).agg(F.max("h"))

    def fails():
        met.wait()
        raise RuntimeError("tail lost")

    run = StepRun(spark, str(tmp_path / "fall"), [Step("slow", (), slow), Step("fails", (), fails)])
    with pytest.raises(RuntimeError, match="tail lost"):
        run.run(["slow", "fails"])
    assert not run.done("slow")


def test_whole_job_gives_the_same_tokens(spark, tmp_path):
    english, french = "the quick brown fox jumps over the lazy dog and then the others with that there ", "le renard brun saute par dessus le chien paresseux et puis les autres avec cela "
    model = lang_model(lang_profile(spark.createDataFrame([(english * 3, "en"), (french * 3, "fr")], "text string, lang string"), "text", "lang"))
    page = lambda words: f"<html><body><article><p>{words}</p></article></body></html>"
    texts = [english * 3, english * 3, english * 2 + "once more with feeling", french * 3]
    records = [(str(i), f"http://h{i}.org/a", "2020-01-01", page(t)) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(records, "warc_id string, url string, date string, html_content string")
    listed = spark.createDataFrame([("bad.org",)], "domain string")
    whole = prepare_corpus(pages, listed, model)
    near, exact, run = run_corpus(spark, str(tmp_path / "corpus"), pages, listed, model)
    assert rows(near.select("warc_id")) == rows(whole.tokens_near.select("warc_id"))
    assert rows(exact.select("warc_id")) == rows(whole.tokens_exact.select("warc_id"))
    assert run.rows("filtered") == 4 and run.faults("english") and not run.present("english") and run.present("tokens_near")
