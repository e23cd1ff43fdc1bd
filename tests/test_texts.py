"""Language, exact duplicates, tokens and shingles."""

import hashlib
import re
import time
import tracemalloc

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from textmill.functions.grams import words
from textmill.operators import language
from textmill.operators.exact import dedup_compare, exact_dedup, first_of_each
from textmill.operators.funnel import stage_funnel
from textmill.operators.language import (
    lang_filter,
    lang_model,
    lang_predict,
    lang_profile,
    lang_score,
    model_filter,
    single_line,
)
from textmill.operators.shingle import shingles
from textmill.operators.tokens import token_ids, token_stats, tokenize_fixed, word_tokens
from textmill.plans.corpus import CorpusConfig, prepare_corpus
from textmill.schemas import check_step

ENGLISH = "the quick brown fox jumps over the lazy dog and then the others with that there "
FRENCH = "le renard brun saute par dessus le chien paresseux et puis les autres avec cela "


@pytest.fixture(scope="module")
def model(spark):
    train = spark.createDataFrame([(ENGLISH * 5, "en"), (FRENCH * 5, "fr"), ("x", None)], "text string, lang string")
    return lang_model(lang_profile(train, "text"))


def test_language(spark, model):
    texts = [
        (1, "the dog and\nthe fox\r\n"), (2, "le chien et le renard"), (3, "\n\r \n"), (4, None), (5, ""), (6, "ab"),
        (7, "the lazy dog le chien paresseux"),
    ]
    df = spark.createDataFrame(texts, "id long, text string")
    top = {r["id"]: r["lang"] for r in lang_predict(df, "id", "text", model).collect()}
    assert top[1] == "en" and top[2] == "fr" and set(top) == {1, 2, 7}
    scores = {(r["id"], r["lang"]): r["prob"] for r in lang_score(df, "id", "text", model).collect()}
    assert all(abs(scores[i, "en"] + scores[i, "fr"] - 1) < 1e-5 for i in top)
    assert [r[0] for r in rows(lang_filter(df, "text", model).select("id"))][0] == 1
    at = scores[1, "en"]
    assert lang_filter(df.where("id = 1"), "text", model, threshold=at).count() == 1
    assert lang_filter(df.where("id = 1"), "text", model, threshold=at + 1e-6).count() == 0


def test_a_long_text_is_taken_piece_by_piece():
    """Neither training nor scoring holds all code points of a text at once."""
    text, chunks = "ab ç" * 2_000_000, language._bucketer(language.BUCKETS)
    tracemalloc.start()
    try:
        assert sum(len(part) for part in chunks(text)) == len(text) - 2
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()
    assert not list(chunks(None)) and not list(chunks("ab")) and [len(p) for p in chunks("abc")] == [1]


def test_trigrams_of_a_text_are_those_of_its_single_line(spark):
    """Batches hold texts as they are; before, they had to hold lines made by regular expressions."""
    ends = ["", " ", "\r\n", "\t\n ", "\u00a0\u3000", "\u2028", "\u0085", " \u0085", "\u0085 ", " \u0085\u0085", "\u0085\n", "\u180e", "\x1c"]
    texts = [a + middle + b for a in ends for b in ends for middle in ("", "x", "Ab\r\n cΣ", "É😀 \u0085 y")]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    pairs = df.select(F.lower("text").alias("low"), F.lower(single_line(F.col("text"))).alias("line")).collect()
    chunks, factors = language._bucketer(1000), language.gram_multipliers(3)
    for low, line in pairs:
        plain = [sum(ord(c) * m for c, m in zip(line[i:], factors)) % (2**31 - 1) % 1000 for i in range(len(line) - 2)]
        assert [int(b) for part in chunks(low) for b in part] == plain, (low, line)


def test_own_model(spark):
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"lang": ["en" if " " in t else "fr" for t in texts], "prob": [len(t) / 10 for t in texts]})

    df = spark.createDataFrame([(1, "a\nb c d "), (2, "ab"), (3, "a b"), (4, None), (5, " ")], "id long, text string")
    assert [r[0] for r in rows(model_filter(df, "text", predict))] == [1]


def test_exact(spark):
    docs = [(1, "2020-01-02", "a"), (2, "2020-01-01", "a"), (3, None, "a"), (4, None, "b"), (5, "2020", None), (6, "2019", None), (8, "x", "c"), (7, "x", "c")]
    df = spark.createDataFrame(docs, "id long, date string, text string")
    kept = exact_dedup(df, "text", ["date", "id"])
    assert [r[0] for r in rows(kept.select("id"))] == [2, 4, 6, 7]
    assert exact_dedup(kept, "text", ["date", "id"]).exceptAll(kept).isEmpty()
    compared = dedup_compare(kept, df.where("id > 3"), "id").first()
    assert tuple(compared) == (4, 5, 3, 1, 2)


def test_exact_ways_agree(spark):
    # A third of the rows one text, pairs, single texts, repeated whole rows and nulls.
    text = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('pair ', id div 6) WHEN id % 50 = 2 THEN NULL ELSE concat('one ', id) END")
    df = spark.range(3000).select((F.col("id") % 2900).alias("id"), text.alias("text"), (F.col("id") % 7).cast("string").alias("date"))
    want = rows(first_of_each(df, "text", ["date", "id"]).fillna("none"))
    assert rows(exact_dedup(df, "text", ["date", "id"]).fillna("none")) == want
    assert rows(exact_dedup(df, "text", ["date", "id"], max_bytes=8).fillna("none")) == want
    single = spark.range(10).select(F.col("id").cast("string").alias("text"))
    assert exact_dedup(single, "text", ["text"]).count() == 10 and exact_dedup(single.limit(0), "text", ["text"]).count() == 0


def reference_tokens(text):
    words = re.findall(r"\b\w+\b", (text or "").lower())[:512]
    ids = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 49999 + 1 for w in words]
    return ids + [0] * (512 - len(ids)), [1] * len(ids) + [0] * (512 - len(ids))


def test_tokens(spark):
    texts = {
        "null": None, "empty": "", "marks": "... !?", "accents": "Été_1 naïve ÇA 42", "script": "Привет мир 你好",
        "short": " ".join(f"w{i}" for i in range(511)), "exact": " ".join(f"w{i}" for i in range(512)),
        "long": " ".join(f"w{i}" for i in range(700)),
    }
    df = spark.createDataFrame(list(texts.items()), "warc_id string, extracted_text string")
    tokens = check_step(tokenize_fixed(df), 6)
    got = {r["warc_id"]: (r["tokens"], r["attention_mask"]) for r in tokens.collect()}
    assert got == {k: reference_tokens(t) for k, t in texts.items()}
    assert all(0 < t < 50000 for ids, mask in got.values() for t, m in zip(ids, mask) if m)
    stats = token_stats(tokens).first()
    assert stats["n_docs"] == 8 and stats["n_full"] == 2 and stats["n_empty"] == 3
    words = word_tokens(df.where("warc_id = 'accents'"), "warc_id", "extracted_text")
    assert [r[2] for r in sorted(words.collect())] == ["été_1", "naïve", "ça", "42"]
    assert token_ids(df, "warc_id", "extracted_text").count() == 511 + 512 + 700 + 4 + 3


@pytest.mark.parametrize("unit,text,count", [("char", "abcde", 1), ("char", "abcd", 0), ("char", "AAAAAAaaaa", 1), ("word", "a b c d e f", 2), ("word", "a b c d", 0), ("char", "😀é𝄞ab", 1)])
def test_shingles(spark, unit, text, count):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert shingles(df, "id", "text", unit=unit).count() == count


def test_corpus(spark, model):
    page = "<html><head><title>t</title></head><body><p>{}</p></body></html>"
    pages = [
        ("1", "http://ok.org/1", "2020-02-01", page.format(ENGLISH * 3)),
        ("2", "http://ok.org/2", "2020-01-01", page.format(ENGLISH * 3)),
        ("3", "http://www.bad.org/3", "2020-01-01", page.format(ENGLISH * 3)),
        ("4", "http://ok.org/4", "2020-01-01", page.format(FRENCH * 3)),
        ("5", "http://ok.org/5", "2020-01-01", "<script>x</script>"),
        ("6", "http://ok.org/6", "2020-01-01", page.format(ENGLISH * 3 + "and one more fox")),
    ]
    df = spark.createDataFrame(pages, "warc_id string, url string, date string, html_content string")
    corpus = prepare_corpus(df, spark.createDataFrame([("bad.org",)], "domain string"), model, CorpusConfig())
    assert [r[0] for r in rows(corpus.tokens_exact.select("warc_id"))] == ["2", "6"]
    assert [r[0] for r in rows(corpus.tokens_near.select("warc_id"))] == ["6"]
    assert [(r["stage"], r["rows_in"], r["rows_out"]) for r in corpus.funnel().orderBy("step").collect()] == [
        ("2_domain_filter", 5, 5), ("3_html_extract", 5, 4), ("4_lang_filter", 4, 3), ("5a_near_dedup", 3, 1),
        ("5b_exact_dedup", 3, 2), ("6a_tokenize", 1, 1), ("6b_tokenize", 2, 2),
    ]
    assert tuple(corpus.compare().first()) == (1, 2, 1, 0, 1)


def test_funnel_of_nothing(spark):
    empty = spark.range(0)
    assert stage_funnel([("a", None, empty), ("b", "a", empty)]).where(F.col("share").isNull()).count() == 2


def test_language_filter_judges_rows_by_their_text(spark):
    english, german = "the cat and the dog of the house with that", "der hund und die katze aus dem haus mit"
    labelled = spark.createDataFrame([(english, "en"), (german, "de")], "text STRING, lang STRING")
    model = lang_model(lang_profile(labelled, "text"))
    rows = [(1, english), (1, german), (None, english), (None, german), (2, None), (3, english)]
    kept = lang_filter(spark.createDataFrame(rows, "id INT, text STRING"), "text", model).collect()
    assert sorted((r["id"] or 0, r["text"]) for r in kept) == [(0, english), (1, english), (3, english)]


def test_language_models_of_any_size_score_alike(spark):
    """Arrays over Arrow batches and the join for large models; a text longer than a chunk, copies, null and empty."""
    labelled = [(ENGLISH, "en"), (FRENCH, "fr"), ("Привет, мир и все остальные", "ru"), (None, "en"), ("", "xx")]
    profile = lang_profile(spark.createDataFrame(labelled, "text STRING, lang STRING"), "text")
    texts = [ENGLISH * 2000, FRENCH, FRENCH, "мир", "😀é", "ab", "", None, "zzz qqq"]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    packed, joined = lang_model(profile), lang_model(profile, limit=0)
    assert packed.packed is not None and joined.packed is None and packed.langs == ["en", "fr", "ru"]
    got = rows(lang_score(df, "id", "text", packed))
    assert got == rows(lang_score(df, "id", "text", joined))
    assert {r[0] for r in got} == {0, 1, 2, 3, 8}
    assert rows(lang_filter(df, "text", packed)) == rows(lang_filter(df, "text", joined))


def test_blank_runs_take_linear_time(spark):
    text = "a" + " " * 1_000_000 + "b"
    df = spark.createDataFrame([(text,)], "text STRING")
    start = time.time()
    assert df.select(single_line(F.col("text")).alias("x")).first()["x"] == text
    assert df.select(F.size(words(F.col("text"))).alias("n")).first()["n"] == 1_000_001
    assert time.time() - start < 15


def test_profile_is_the_same_however_few_trigrams_a_task_holds(spark, monkeypatch):
    texts = [(ENGLISH * 5, "en"), (FRENCH * 7, "fr"), (None, "fr"), ("xy", "it"), ("other words", "en")]
    train = spark.createDataFrame(texts, "text string, lang string")
    whole = rows(lang_profile(train, "text"))
    monkeypatch.setattr(language, "FLUSH", 50)
    assert rows(lang_profile(train.coalesce(1), "text")) == whole and {r[0] for r in whole} == {"en", "fr"}
