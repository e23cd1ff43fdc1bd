"""Near duplicates against brute force, in small buckets and through leaders and prefixes."""

import itertools
import random
import time

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from textmill.functions import grams as grams_module
from textmill.operators.components import connected_components
from textmill.operators.minhash import band_table, hash_coefficients, minhash_signature
from textmill.operators import neardup
from textmill.operators.neardup import NearDupConfig, dup_clusters, near_dedup, near_dup_filter, near_duplicates, pair_losers


def grams(text, unit, n=5):
    units = list(text.lower()) if unit == "char" else text.lower().rstrip().split(" ")
    return {tuple(units[i : i + n]) for i in range(len(units) - n + 1)}


def brute(docs, sharing, unit, threshold):
    """Losers of similar pairs and clusters by comparing all pairs."""
    sets = {i: grams(t, unit) for i, t in docs.items()}
    size = {i: len(t) for i, t in docs.items()}
    pairs = []
    for a, b in itertools.combinations(sorted(docs), 2):
        if sets[a] and sets[b] and sharing[a] & sharing[b]:
            jaccard = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if jaccard >= threshold:
                pairs.append((a, b))
    losers, near = set(), {i: set() for i in docs}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
        losers.add(b if size[a] >= size[b] else a)
    seen, clusters = set(), {}
    for start in sorted(docs):
        if start in seen or not near[start]:
            continue
        component, todo = set(), [start]
        while todo:
            x = todo.pop()
            if x not in component:
                component.add(x)
                todo += near[x]
        seen |= component
        keeper = min(component, key=lambda i: (-size[i], i))
        for x in component:
            clusters[x] = (min(component), keeper)
    return losers, clusters


def families(seed, sizes, noise, words=60):
    """Families of edited copies of a few templates, exact copies, a boilerplate crowd and loners."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for size in sizes:
        template = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            text = list(template)
            for _ in range(rng.randint(0, noise)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append(" ".join(text[: rng.randint(words - noise, words)]))
    crowd = [rng.choice(vocabulary) for _ in range(words)]
    docs += [" ".join(crowd + [rng.choice(vocabulary) for _ in range(40)]) for _ in range(25)]
    docs += docs[:6] + ["one two", "one two", ""]
    docs += [" ".join(rng.choice(vocabulary) for _ in range(words)) for _ in range(10)]
    rng.shuffle(docs)
    return dict(enumerate(docs))


def sharing_of(spark, df, cfg):
    signatures = minhash_signature(df, "id", "text", cfg.n, cfg.unit, cfg.bands * cfg.rows)
    held = {}
    for r in band_table(signatures, ["id"], cfg.bands, cfg.rows).collect():
        held.setdefault(r["id"], set()).add((r["band"], r["bucket"]))
    return held


@pytest.mark.parametrize(
    "cfg",
    [
        NearDupConfig(),
        NearDupConfig(small_bucket=3),
        NearDupConfig(small_bucket=2, leader_rounds=1, bands=24, rows=1),
        NearDupConfig(small_bucket=3, unit="char", rows_per_salt=7, worthwhile_star=0.0, scouts=4),
        NearDupConfig(small_bucket=1, leader_rounds=0),
    ],
    ids=["small", "leaders", "any-table", "char", "prefix-only"],
)
def test_matches_brute_force(spark, cfg):
    docs = families(7, [30, 12, 5], noise=9)
    df = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(4)
    held = sharing_of(spark, df, cfg)
    sharing = {i: held.get(i, set()) for i in docs}
    losers, clusters = brute(docs, sharing, cfg.unit, cfg.threshold)
    found = near_duplicates(df, "id", "text", cfg)

    assert [r["id"] for r in sorted(pair_losers(found).collect())] == sorted(losers)
    assert {r["id"]: (r["cluster"], r["keeper"]) for r in dup_clusters(found).collect()} == clusters

    kept = {r["id"] for r in near_dup_filter(df, "id", found).collect()}
    assert kept == {i for i in docs if i not in clusters or clusters[i][1] == i}
    kept = {r["id"] for r in near_dup_filter(df, "id", found, keep="pairwise").collect()}
    assert kept == set(docs) - losers


def test_large_bucket_yields_linear_links(spark):
    """A template with many variants must not list its pairs."""
    docs = families(3, [120], noise=3)
    df = spark.createDataFrame(list(docs.items()), "id long, text string")
    found = near_duplicates(df, "id", "text", NearDupConfig(small_bucket=4))
    assert found.links.count() < 8 * len(docs)
    clusters = rows(dup_clusters(found).select("cluster").distinct())
    assert len(clusters) <= 3


def test_string_ids_and_idempotence(spark):
    docs = families(5, [10, 4], noise=4)
    df = spark.createDataFrame([(f"<urn:{i:05d}>", t) for i, t in docs.items()], "id string, text string")
    once = near_dup_filter(df, "id", near_duplicates(df, "id", "text")).cache()
    again = near_dup_filter(once, "id", near_duplicates(once, "id", "text"))
    assert rows(once) == rows(again)
    assert once.count() < df.count()


def test_chain_keeps_one_by_cluster_and_two_by_pair(spark):
    words = [f"a{i}" for i in range(60)]
    docs = [(1, " ".join(words[0:40])), (2, " ".join(words[10:50]) + " padding"), (3, " ".join(words[20:60]) + " zz yy xx")]
    df = spark.createDataFrame(docs, "id long, text string")
    cfg = NearDupConfig(bands=24, rows=1)
    found = near_duplicates(df, "id", "text", cfg)
    linked = {(r["a"], r["b"]) for r in found.links.collect()}
    assert linked == {(1, 2), (2, 3)}
    assert len(rows(near_dup_filter(df, "id", found))) == 1
    assert len(rows(near_dup_filter(df, "id", found, keep="pairwise"))) <= 2


@pytest.mark.parametrize("shape", ["path", "star", "mixed"])
def test_components(spark, shape):
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(100)],
        "mixed": [(1, 2), (2, 3), (10, 11), (11, 1), (20, 21), (30, 30)],
    }[shape]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")))
    parent = {v: v for e in edges for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {v: root(v) for v in parent if any(v in e and e[0] != e[1] for e in edges)}


def test_null_and_equal_ids_stay(spark):
    text = " ".join(f"word{i}" for i in range(40))
    made = [(1, text), (2, text + " more"), (None, text), (None, text + " more"), (3, text), (3, "short"), (4, None)]
    df = spark.createDataFrame(made, "id long, text string")
    found = near_duplicates(df, "id", "text")
    assert rows(found.links.select("a", "b")) == [(1, 2)] and found.copies.isEmpty()
    for keep in ("cluster", "pairwise"):
        kept = [r["id"] for r in near_dup_filter(df, "id", found, keep).collect()]
        assert sorted(kept, key=lambda i: i or 0) == [None, None, 2, 3, 3, 4]


def test_repeated_and_null_ids(spark):
    """Rows that share an id, or have none, are deduplicated like any other; the longest stays, then the smallest id."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    other = "a quite different text about something else that nobody has written before today"
    table = spark.createDataFrame(
        [("a", base), ("a", base), ("b", base), ("a", other), (None, base + " thirteen"), (None, other), (None, None), ("c", "short"), ("c", "short")],
        "id string, text string",
    )
    for keep in ("cluster", "pairwise"):
        kept = near_dedup(table, "id", "text", keep=keep)
        assert kept.columns == ["id", "text"]
        got = sorted(map(tuple, kept.collect()), key=str)
        assert got == sorted([(None, base + " thirteen"), (None, other), (None, None), ("c", "short"), ("c", "short")], key=str)
    three = spark.createDataFrame([("a", base), ("a", base), ("b", base)], "id string, text string")
    assert rows(near_dedup(three, "id", "text")) == [("a", base)]


def test_repeated_ids_against_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(30):
        text = [rng.choice(words) for _ in range(20)]
        for _ in range(rng.randint(1, 3)):
            edited = list(text)
            edited[rng.randrange(20)] = "edit"
            texts.append(" ".join(rng.choice([text, edited])))
    data = [(rng.choice([None, 1, 2, 3, i + 10]), t) for i, t in enumerate(texts)]
    cfg = NearDupConfig(bands=24, rows=1)
    kept = near_dedup(spark.createDataFrame(data, "id long, text string"), "id", "text", cfg)
    grams = [frozenset(tuple(t.split()[i : i + 5]) for i in range(16)) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= 0.5:
                parent[root(i)] = root(j)
    groups = {}
    for i, (_, t) in enumerate(data):
        groups.setdefault(root(i), []).append(t)
    got = [r["text"] for r in kept.collect()]
    best = [max(len(t) for t in g) for g in groups.values()]
    assert len(got) == len(groups) and sorted(map(len, got)) == sorted(best)


def babble(seed, count):
    """Texts of a few syllables, so that all share many character shingles, and edited copies of some."""
    rng = random.Random(seed)
    syllables = ["la", "ne", "tor", "mi", "sa", "ku", "ber", "on"]
    docs = []
    for _ in range(count):
        text = "".join(rng.choice(syllables) for _ in range(rng.randint(60, 160)))
        docs += [text, text[: len(text) - rng.randint(1, 60)] + "".join(rng.choice(syllables) for _ in range(5))]
    return dict(enumerate(docs))


def test_sketches_lose_no_similar_pair_and_spare_most_others(spark):
    cfg = NearDupConfig(unit="char")
    docs = babble(3, 40)
    sets = spark.createDataFrame(list(docs.items()), "id bigint, text string").select(
        "id", F.length("text").alias("len"), neardup.gram_set(F.col("text"), cfg.n, cfg.unit).alias("grams")
    )
    left, right = sets.select(F.col("id").alias("a")), sets.select(F.col("id").alias("b"))
    pairs = left.join(right, F.col("a") < F.col("b"))
    close = {tuple(r) for r in rows(neardup._sketched(pairs, neardup._sketches(sets, cfg), cfg))}
    grams_of = {i: grams(t, "char") for i, t in docs.items()}
    similar = {
        (a, b) for a, b in itertools.combinations(docs, 2)
        if len(grams_of[a] & grams_of[b]) / len(grams_of[a] | grams_of[b]) >= cfg.threshold
    }
    assert similar and similar <= close and len(close) < pairs.count() / 2
    found = rows(neardup.verify_pairs(spark.createDataFrame(list(close), "a bigint, b bigint"), sets, cfg).select("a", "b"))
    assert set(found) == similar


@pytest.mark.parametrize("per_gram", [0, 4])
def test_large_buckets_of_common_shingles_pair_by_pair_and_by_prefixes(spark, per_gram):
    cfg = NearDupConfig(unit="char", bands=24, rows=1, small_bucket=4, leader_rounds=1, scouts=2, block=8, pairs_per_gram=per_gram)
    docs = babble(5, 30)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    signatures = minhash_signature(df, "doc_id", "text", cfg.n, cfg.unit, 24)
    sharing = {i: set() for i in docs}
    for r in band_table(signatures, ["doc_id"], 24, 1).collect():
        sharing[r["doc_id"]].add(r["bucket"])
    losers, _ = brute(docs, sharing, "char", cfg.threshold)
    assert {r["id"] for r in pair_losers(near_duplicates(df, "doc_id", "text", cfg)).collect()} == losers


ODD_TEXTS = [
    None, "", " ", "a b c d", "A b C d E", "a b c d e ", " a  b\tc\nd\re\x0bf\fg  ", "a b c d e \u2028", "a b c d e \u2029", "a b c d e \x85",
    "a b c d e  \u2028\u2028", "a b c d e \n \u2028", "a b c d e\u2028 ", "a b c d e \r\n", "É ß İ Ж 漢字 😀 x y z", "a\xa0b c d e\x1f f g", "x" * 60 + " b c d e f",
    "word " * 30, " ".join(["fifty", "five", "bytes", "fill", "x" * 33]), " ".join(["fifty", "six", "bytes", "fill", "x" * 34]), " " * 9 + "a",
    " ".join(str(i * i) for i in range(700)),
]


@pytest.mark.parametrize("piece", [3, 1 << 12])
@pytest.mark.parametrize("n", [1, 5])
def test_word_grams_over_batches_equal_exploded_ones(spark, monkeypatch, n, piece):
    monkeypatch.setattr(grams_module, "PIECE", piece)
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(ODD_TEXTS)], "id int, text string")
    found = minhash_signature(df, "id", "text", n)
    assert "Generate" not in found._jdf.queryExecution().toString()
    exploded = grams_module.explode_grams(df, ["id"], F.col("text"), n, "word")
    minima = [F.min((F.col("h") * a + b) % grams_module.MERSENNE31).alias(f"m{i}") for i, (a, b) in enumerate(hash_coefficients())]
    assert rows(found) == rows(exploded.groupBy("id").agg(*minima))

    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, text string")
    plain = docs.select("id", F.length("text").alias("len"), F.array_sort(grams_module.gram_set(F.col("text"), n, "word")).alias("grams"))
    plain = {r.id: r for r in plain.collect() if r.grams}
    wanted = spark.createDataFrame([(i,) for i in plain if i % 3], "id int")
    sets = neardup._gram_sets(docs, wanted, NearDupConfig(n=n)).collect()
    assert {r.id: r for r in sets} == {i: r for i, r in plain.items() if i % 3}


def test_texts_of_documents_without_a_bucket_are_not_shuffled(spark):
    docs = spark.range(1000).select("id", F.lit("a b c d e").alias("text"))
    for unit in ("word", "char"):
        sets = neardup._gram_sets(docs, spark.range(3), NearDupConfig(unit=unit))
        assert "shiftleft" in sets._jdf.queryExecution().optimizedPlan().toString()
        assert sets.count() == 3


def test_remainders_without_a_division():
    prime, drawn = grams_module.MERSENNE31, random.Random(1)
    edges = [k * prime + d for k in (1, 2, prime, 2**30 - 1) for d in (-1, 0, 1)]
    numbers = [0, *edges, 2**61 - 1, *(drawn.randrange(2**61) for _ in range(1000))]
    assert grams_module.remainder()(np.array(numbers, np.uint64)).tolist() == [x % prime for x in numbers]


@pytest.mark.parametrize("n", [1, 5])
def test_char_grams_over_batches_equal_exploded_ones(spark, n):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, text string")
    plain = docs.select("id", F.length("text").alias("len"), F.array_sort(grams_module.gram_set(F.col("text"), n, "char")).alias("grams"))
    sets = neardup._gram_sets(docs, docs, NearDupConfig(n=n, unit="char")).where(F.size("grams") > 0)
    assert rows(sets) == rows(plain.where(F.size("grams") > 0))


def test_tables_written_between_steps_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = held()
    neardup.cut(spark.range(10_000).groupBy(F.col("id") % 100).count())
    deadline = time.time() + 30
    while held() - before and time.time() < deadline:
        time.sleep(0.5)
    assert not held() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pairs_in_slices_and_bands_in_turns(spark, monkeypatch):
    docs = {**babble(8, 30), 900: "short", 901: None, 902: ""}
    cfg = NearDupConfig(unit="char", bands=4, rows=1)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    whole = {r["id"] for r in pair_losers(near_duplicates(df, "doc_id", "text", cfg)).collect()}
    sharing = {i: set() for i in docs}
    for r in band_table(minhash_signature(df, "doc_id", "text", cfg.n, cfg.unit, 4), ["doc_id"], 4, 1).collect():
        sharing[r["doc_id"]].add(r["bucket"])
    losers, _ = brute({i: t or "" for i, t in docs.items()}, sharing, "char", cfg.threshold)
    written, kept = [], neardup.cut

    def seen(table, name="cut"):
        written.append(name)
        return kept(table, name)

    monkeypatch.setattr(neardup, "cut", seen)
    monkeypatch.setattr(neardup, "AT_ONCE", 20)
    assert {r["id"] for r in pair_losers(near_duplicates(df, "doc_id", "text", cfg)).collect()} == whole == losers
    assert written.count("band") == 4 and "sets" not in written
    found = neardup.verify_pairs(spark.range(60).selectExpr("id a", "id + 900 b").where("id < 0"), df.withColumnRenamed("doc_id", "id"), cfg)
    assert found.count() == 0
    pairs = spark.createDataFrame([(a, b) for a in range(0, 20) for b in range(a + 1, 20)], "a bigint, b bigint")
    texts = df.withColumnRenamed("doc_id", "id")
    sliced = rows(neardup.verify_pairs(pairs, texts, cfg))
    assert written.count("slice") > 1
    monkeypatch.setattr(neardup, "AT_ONCE", 1000)
    assert sliced and sliced == rows(neardup.verify_pairs(pairs, texts, cfg))
