"""The manifest, the toxicity model and the alignment of tokenizers against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import merkle, queries, token_alignment, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, "Hello  World\n", "en", "b", 9), (3, "Hello  World\n", "en", "b", 9),
    (None, "lost", None, "a", 4), (4, "x" * 1_200_000, None, "a", 1), (5, " \t\n", "de", None, 3), (6, "漢字 é 🎉", "de", "c", 5),
    (None, "lost", None, "a", 4), (3, "another text", None, "b", 1), (7, "mark ▁ here <|endoftext|> <s>", "en", "a", 2),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def stored(tmp_path, docs, name="documents"):
    docs.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# --- manifest ---------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves):
    """Root and every leaf's siblings, level by level."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place - place % 3
            proofs[i].append((level[run:place], level[place + 1 : run + 3]))
        at = [p // 3 for p in at]
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0] if level else None, proofs


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups["0" if r["source"] is None else "1" + r["source"]].append((r, plain_leaf(r, r["text"])))
    names = sorted(groups, key=str.encode)
    for g in groups.values():
        g.sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {n: plain_tree([leaf for _, leaf in groups[n]]) for n in names}
    root, tops = plain_tree([trees[n][0] for n in names])
    out = []
    for name, top in zip(names, tops):
        subroot, proofs = trees[name]
        for (r, leaf), proof in zip(groups[name], proofs):
            path = proof + top
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            fold = plain_leaf(r, text)
            for before, after in path:
                fold = sha(*before, fold, *after)
            out.append((r["doc_id"], leaf, subroot, root, sha(*[h for b, a in path for h in b + a]), fold, fold == root))
    return out


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_manifest_equals_a_plain_one(spark, documents, odd, empty, tmp_path):
    clash = odd.withColumn("proof", F.lit("mine")).withColumn("grp", F.lit(1))
    for i, docs in enumerate((documents, clash, documents.limit(1), empty)):
        sf = stored(tmp_path / str(i), docs)
        got = queries.op11_merkle_manifest(spark, sf).collect()
        assert by_text(got) == by_text(plain_manifest(docs.collect()))


def test_manifest_levels_and_hot_source(spark):
    # Many levels of few nodes: subtrees of 3 ** 2, one source with most rows, and equal rows.
    rows = [(i % 700, f"text {i % 700}", "en", "hot" if i % 9 else f"s{i % 45}", i % 700) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    manifest = merkle.Manifest.build(docs, span=2)
    assert len(manifest.sources.levels) > 3 and len(manifest.top.levels) > 1
    proofs = merkle.verify(manifest.proofs(), F.col("digest")).collect()
    plain = plain_manifest(docs.collect())
    assert all(p["verified"] for p in proofs) and manifest.root() == plain[0][3]
    assert sorted((p["id"], p["digest"], p["subroot"]) for p in proofs) == sorted(r[:3] for r in plain)
    forged = merkle.verify(manifest.proofs(), F.sha2(F.lit("forged"), 256))
    assert forged.where("verified").count() == 0


# --- toxicity ---------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op12_toxicity(spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    hits = sum(r["predicted"] and r["toxic"] for r in held)
    assert hits / sum(r["toxic"] for r in held) > 0.85 and hits / sum(r["predicted"] for r in held) > 0.97
    # Calibrated: the mean score is near the share of toxic rows.
    assert np.mean([r["score"] for r in held]) == pytest.approx(np.mean([r["toxic"] for r in held]), abs=0.02)


def test_isotonic_is_the_closest_rising_function():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 8)
        s = np.array([rng.randint(0, 4) for _ in range(n)], float)
        y = np.array([rng.randint(0, 1) for _ in range(n)], float)
        w = np.array([rng.choice([1.0, 2.0]) for _ in range(n)])
        knots = toxicity.isotonic(s, y, w)
        # Max-min form of the solution: over lower and upper sets of scores.
        mean = lambda lo, hi: np.average(y[(s >= lo) & (s <= hi)], weights=w[(s >= lo) & (s <= hi)])
        for at in sorted(set(s)):
            best = max(min(mean(lo, hi) for hi in set(s) if hi >= at) for lo in set(s) if lo <= at)
            assert np.interp(at, *knots) == pytest.approx(best)


def test_trees_learn_an_interaction_and_agree_with_their_splits():
    rng = np.random.default_rng(5)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = toxicity.boost(x, y, np.ones(2000))
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.95

    def plain(row):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return total

    assert trees.margin(x[:50]) == pytest.approx([plain(r) for r in x[:50]])


def test_features_see_disguises_and_address():
    lexicon = toxicity.Lexicon({}, {})
    named = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, lexicon)))
    assert named("you are an idiot")["near_count"] > 0 == named("you " + "x " * 9 + "idiot")["near_count"]
    for disguised in ("an id1ot here", "an i d i o t here", "an idiooot here"):
        assert named(disguised)["disguised_hits"] > 0 == named(disguised)["abuse_count"]
    assert named("WHY NOT")["shout_rate"] == 1.0 and named("a" * 1_500_000)["words"] > 0
    assert not any(toxicity.features(None, lexicon)) and len(named("")) == len(toxicity.FEATURES)


def test_toxicity_odd_rows(spark, documents, odd, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(documents, labels.unionByName(labels))
    clash = odd.withColumn("score", F.lit("mine")).withColumn("found", F.lit(1))
    rows = toxicity.score(clash, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["found"] == 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert len({r["score"] for r in rows if r["text"] == "lost"}) == 1
    assert toxicity.score(empty, model).count() == 0
    for marks, score in (([], 0.0), ([(3, 1)], 1.0), ([(3, 0)], 0.0), ([(None, 1), (4, None)], 0.0)):
        one = toxicity.fit(odd, spark.createDataFrame(marks, "doc_id BIGINT, toxic INT"))
        assert {r["score"] for r in toxicity.score(odd, one).collect()} == {score}


def test_toxicity_sample_is_bounded(spark):
    # One id holds most rows, each with its own text.
    docs = spark.range(4000).select(F.lit(1).alias("doc_id"), F.concat(F.lit("idiot number "), "id").alias("text"))
    docs = docs.unionByName(spark.range(50).select((F.col("id") + 2).alias("doc_id"), F.lit("quiet words").alias("text")))
    labels = spark.range(50).select((F.col("id") + 1).alias("doc_id"), (F.col("id") == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, sample_rows=200)
    assert "idiot" in model.lexicon.words
    assert model.score(["idiot number 5"])[0] > 0.7 > model.score(["quiet words"])[0]


# --- alignment --------------------------------------------------------------------------------------


def plain_alignment(texts):
    """Per text: measures by the definition, over all (text, times) at once."""
    c = token_alignment.coders(token_alignment.read_vocabularies())
    found, total = {}, Counter()
    for text in texts:
        if text in found:
            total.update(found[text][4])
            continue
        result = (0, 0, 0, "", Counter())
        if text:
            a, b = c.a.encode(" " + text, add_special_tokens=False).ids, c.b.encode(text)
            letters = token_alignment.byte_letters()
            bytes_a = [bytes([letters[ch] for ch in c.a.id_to_token(i)]) for i in a]
            bytes_b = [bytes([int(p[3:5], 16)]) if c.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [c.b.id_to_piece(i)]]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = [np.cumsum([len(x) for x in part]).tolist() for part in (bytes_a, bytes_b)]
                at = dict(zip(ends[1], b))
                links = Counter((x, at[e]) for x, e in zip(a, ends[0]) if e in at)
                groups, i, j = [], 0, 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    ga, gb = [], []
                    while i < len(a) and ends[0][i] <= end:
                        ga.append(str(a[i]))
                        i += 1
                    while j < len(b) and ends[1][j] <= end:
                        gb.append(str(b[j]))
                        j += 1
                    groups.append(",".join(ga) + "|" + ",".join(gb))
                result = (len(a), len(b), len(groups), sha(";".join(groups)), links)
        found[text] = result
        total.update(result[4])
    top = defaultdict(int)
    for (_, b), n in total.items():
        top[b] = max(top[b], n)
    return {
        t: (na, nb, g, sum(links.values()), sum(n for p, n in links.items() if total[p] == top[p[1]]), sum(n * total[p] for p, n in links.items()), digest)
        for t, (na, nb, g, digest, links) in found.items()
    }


def test_alignment_equals_the_definition(spark, documents, odd, empty, tmp_path):
    for i, docs in enumerate((documents, odd.withColumn("n_best", F.lit("mine")).withColumn("digest", F.lit(1)))):
        sf = stored(tmp_path / str(i), docs)
        rows = docs.select("doc_id", "text").collect()
        plain = plain_alignment([r["text"] for r in rows])
        got = queries.op13_token_alignment(spark, sf).collect()
        assert by_text(got) == by_text([(r["doc_id"], *plain[r["text"]]) for r in rows])
    assert queries.op13_token_alignment(spark, stored(tmp_path / "none", empty)).count() == 0
    assert plain["mark ▁ here <|endoftext|> <s>"][:3] == (0, 0, 0)


def test_alignment_blocks_do_not_matter(spark, odd):
    vocabularies = token_alignment.read_vocabularies()
    docs = odd.where("length(text) < 1000").withColumn("digest", F.lit("own"))
    small, large = (token_alignment.align_documents(docs, vocabularies, block_chars=n).collect() for n in (1, 1 << 22))
    assert by_text(small) == by_text(large) and small[0]["digest"] == "own"
    aligned = token_alignment.align_texts(docs, vocabularies, block_chars=20)
    pairs = token_alignment.pair_counts(aligned, vocabularies).collect()
    assert sum(p["links"] for p in pairs) == sum(r["n_links"] for r in small)


def test_both_encoders_give_the_same_ids():
    c = token_alignment.coders(token_alignment.read_vocabularies())
    rng = random.Random(6)
    letters = [chr(i) for i in [*range(9, 14), *range(32, 127), *range(0xA0, 0x250)]] + list("  \n\t'stdrem") * 8
    assert c.fast_a is not None
    for _ in range(5000):
        text = " " + "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert token_alignment.first_ids(text, c) == c.a.encode(text, add_special_tokens=False).ids
    for text in (" " * 100_000, "漢" * 50_000, "a" * 1_000_000):
        assert token_alignment.first_ids(text, c) == c.a.encode(text, add_special_tokens=False).ids
