"""Near-duplicate links, clusters and the filter that keeps one document of each.

Two documents are similar when they share an LSH bucket and the Jaccard overlap
of their shingle sets reaches the threshold. Of two similar documents the better
one is the longer, then the one with the smaller id; the other loses. Listing
all similar pairs is quadratic in a group of near copies, so the job finds a
*sufficient* set of links: the same connected components and the same losers as
all similar pairs have, at a size linear in such groups.

1. Exact copies collapse onto their smallest id before any bucket is formed.
2. Buckets of at most ``small_bucket`` documents are compared inside one task, so
   a row has a bounded number of partners and only similar pairs leave it.
3. A larger bucket elects its best open document as leader and compares it with
   every member, one comparison each. The open documents similar to it form its
   star: they are connected through it and lose to it. The others stay open for
   the next leader, as long as the stars of the bucket are worth a round.
4. What may be missing then is a pair across components, or a document that has
   not lost yet and a better one. Only documents in such a position ask. They ask
   a few scouts of the bucket first, which settles those amid many similar ones.
   For the rest, a bucket with few questions for its shingles answers them pair by
   pair; in the others the size, prefix and position filters for Jaccard find the
   partners exactly: a similar pair shares one of the rarest shingles of both.

Pairs are compared by sketches first, bit maps of some bits per shingle that bound the
overlap from above. A sketch travels once for its bucket, or block of a large one, and pairs are
made in the task. Texts travel only for pairs that pass, so none similar is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.bloom import MAX_BYTES, bloom_filter, bloom_size, might_contain
from textmill.functions.grams import char_grams, gram_set, word_grams  # noqa: F401
from textmill.operators.components import connected_components
from textmill.operators.minhash import (
    BANDS,
    NGRAM_SIZE,
    ROWS,
    THRESHOLD,
    band_table,
    minhash_signature,
)
from textmill.session import cut


#: Pairs verified, or sketches shuffled, at a time, so that the disk holds no more texts and sketches at once.
AT_ONCE = 200_000


@dataclass(frozen=True)
class NearDupConfig:
    n: int = NGRAM_SIZE
    unit: str = "word"
    bands: int = BANDS
    rows: int = ROWS
    threshold: float = THRESHOLD
    small_bucket: int = 256
    leader_rounds: int = 6
    worthwhile_star: float = 0.1
    scouts: int = 32
    rows_per_salt: int = 50_000
    sketch_bits: int = 4
    pairs_per_gram: int = 4
    block: int = 2048


@dataclass(frozen=True)
class NearDuplicates:
    """``copies(id, rep)`` and ``links(a, b, len_a, len_b, jaccard)`` between representatives."""

    copies: DataFrame
    links: DataFrame


def _best(id_col: str = "id") -> Column:
    """Sort key that puts the longest text first, then the smallest id."""
    return F.struct(-F.col("len"), F.col(id_col))


def _salts(count: Column, cfg: NearDupConfig) -> Column:
    return F.ceil(count / F.lit(cfg.rows_per_salt)).cast("int")


def _salt_of(key: str, salts: Column) -> Column:
    return F.pmod(F.xxhash64(key), salts).cast("int")


def _distinct_grams(cfg: NearDupConfig) -> Callable[[pa.Array], pa.ListArray]:
    """A function from lower-cased texts to their sets of shingles."""
    grams = word_grams(cfg.n) if cfg.unit == "word" else char_grams(cfg.n)

    def sets(texts: pa.Array) -> pa.ListArray:
        # A gram has at most 31 bits; sorted with its row before it, the distinct ones of a row lie together.
        keyed = [row << 31 | h for row, h in grams(texts)]
        ordered = np.sort(np.concatenate([np.zeros(0, np.int64), *keyed]))
        distinct = ordered[np.diff(ordered, prepend=-1) != 0]
        offsets = np.searchsorted(distinct, np.arange(len(texts) + 1) << 31).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array((distinct & (1 << 31) - 1).astype(np.int32)))

    return sets


def _gram_sets(docs: DataFrame, wanted: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """``(id, len, grams)`` of the wanted documents; ``docs`` is ``(id, text)``."""
    return _sets_of_texts(_of(docs, wanted), cfg)


def _sets_of_texts(texts: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """``(id, len, grams)`` of all ``(id, text)``."""
    sets_of = _distinct_grams(cfg)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = sets_of(part.column("lower"))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("len"), sets], ["id", "len", "grams"])

    id_type = texts.schema["id"].dataType.simpleString()
    lowered = texts.select("id", F.length("text").alias("len"), F.lower("text").alias("lower"))
    return lowered.mapInArrow(batches, f"id {id_type}, len int, grams array<int>")


def _of(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets, or texts, of the wanted documents; a Bloom filter keeps most others out of the shuffle."""
    ids = cut(wanted.select("id").distinct(), "wanted")
    n = ids.count()
    words, hashes = bloom_size(n)
    if n and words * 8 <= MAX_BYTES:
        held = cut(bloom_filter(ids, "id", words, hashes), "bloom")
        sets = sets.where(might_contain(held, F.col("id"), words, hashes))
    return sets.join(ids, "id", "left_semi")


def _sketches(sets: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """``(id, len, n, bits)``: a bit map, in 64-bit words, of ``sketch_bits`` to twice as many bits per shingle.

    Its width is a power of two; a wider one folds onto a narrower one of its halves.
    """
    per_gram = cfg.sketch_bits

    def bit_map(grams: np.ndarray) -> np.ndarray:
        width = max(64, 1 << (per_gram * len(grams) - 1).bit_length())
        held = np.zeros(width, np.uint8)
        held[grams & (width - 1)] = 1
        return np.packbits(held, bitorder="little").view("<i8")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                grams = part.column("grams")
                maps = [bit_map(g.values.to_numpy()) for g in grams]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("len"), grams.value_lengths(), pa.array(maps, pa.list_(pa.int64()))],
                    ["id", "len", "n", "bits"],
                )

    id_type = sets.schema["id"].dataType.simpleString()
    return sets.mapInArrow(batches, f"id {id_type}, len int, n int, bits array<bigint>")


def _met(rows: DataFrame, key: list[str], cfg: NearDupConfig) -> DataFrame:
    """Pairs ``(a, b)`` of answering and asking rows under one key that their sketches do not rule out.

    ``rows`` has the key, ``role``, ``id, n, bits`` and, where ``_matters`` decides too, ``len, component,
    unsettled``. Rows of role 0 answer, rows of role 1 ask those before them, rows of role 2 do both.
    A sketch travels once for its key instead of once for every pair; pairs are made in the task.

    Of the shingles of one side, each bit that the other side lacks rules out one at least.
    Sizes alike within a factor of two differ by one fold at most; pairs further apart pass.
    """
    threshold, judged = cfg.threshold, "component" in rows.columns

    def possible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """Of the pairs ``open_`` of bit maps of one width a side, those that can reach the threshold."""
        open_ = open_ & (np.minimum(n_a[:, None], n_b) >= threshold * np.maximum(n_a[:, None], n_b))
        width = min(a.shape[1], b.shape[1])
        if max(a.shape[1], b.shape[1]) > 2 * width or not open_.any():
            return open_
        a, b = (m if m.shape[1] == width else m[:, :width] | m[:, width:] for m in (a, b))
        spare_a, spare_b = (n - np.bitwise_count(m).sum(axis=1, dtype=np.int64) for m, n in ((a, n_a), (b, n_b)))
        both, step = np.empty(open_.shape, np.int64), max(1, (1 << 18) // (width * len(b)))
        for at in range(0, len(a), step):
            both[at : at + step] = np.bitwise_count(a[at : at + step, None] & b).sum(axis=2, dtype=np.int64)
        most = np.minimum(spare_a[:, None], spare_b) + both
        return open_ & (most >= threshold / (1 + threshold) * (n_a[:, None] + n_b) - 1e-6)

    def order(value: object) -> object:
        """Orders ids, structs with nulls included, as Spark does."""
        return tuple(map(order, value.values())) if isinstance(value, dict) else (value is not None, value)

    def by_width(part: pa.RecordBatch) -> list[tuple]:
        lists = part.column("bits")
        widths, values = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().view(np.uint64)
        starts = np.cumsum(widths, dtype=np.int64) - widths
        numbers = [part.column(c).to_numpy(zero_copy_only=False) for c in ("n", *(("len", "component", "unsettled") if judged else ()))]
        found = []
        for w in np.unique(widths):
            of = np.flatnonzero(widths == w)
            found.append((part.column("id").take(pa.array(of)), values[starts[of, None] + np.arange(w)], *(x[of] for x in numbers)))
        return found

    def matched(left: tuple, right: tuple, own: bool) -> tuple[pa.Array, pa.Array] | None:
        (id_a, bits_a, n_a, *more_a), (id_b, bits_b, n_b, *more_b) = left, right
        open_ = np.ones((len(n_a), len(n_b)), bool)
        if own:
            open_ = np.triu(open_, 1)
        if judged:
            longer = more_a[0][:, None] >= more_b[0]
            open_ &= (more_a[1][:, None] != more_b[1]) | (more_b[2] & longer)
        i, j = np.nonzero(possible(bits_a, bits_b, n_a, n_b, open_))
        if not len(i):
            return None
        a, b = id_a.take(pa.array(i)), id_b.take(pa.array(j))
        if not own:
            keep = np.ones(len(i), bool)
            for k, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                tie = judged and more_a[0][i[k]] == more_b[0][j[k]] and more_a[1][i[k]] == more_b[1][j[k]]
                keep[k] = x != y and (not tie or order(x) < order(y))
            a, b = a.filter(pa.array(keep)), b.filter(pa.array(keep))
        return a, b

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, answers = None, []
        for batch in rows:
            marks = np.stack([batch.column(c).to_numpy() for c in (*key, "role")])
            begins = np.concatenate(([0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            found = []
            for start, stop in zip(begins[:-1], begins[1:]):
                group, role = tuple(marks[:-1, start]), marks[-1, start]
                if group != last:
                    last, answers = group, []
                for at in range(start, stop, 2048):
                    asking = by_width(batch.slice(at, min(stop - at, 2048)))
                    if role:
                        found += [matched(x, y, False) for x in answers for y in asking]
                    if role == 2:
                        found += [matched(x, y, i == j) for i, x in enumerate(asking) for j, y in enumerate(asking) if i <= j]
                    if role != 1:
                        answers += asking
            for a, b in filter(None, found):
                if len(a):
                    yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.repartition(*key).sortWithinPartitions(*key, "role").mapInArrow(batches, f"a {kind}, b {kind}")


def _sketched(pairs: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The pairs ``(a, b)`` that their sketches do not rule out; ``b`` may have any number of partners."""
    partners = cut(pairs.groupBy("b").agg(_salts(F.count("*"), cfg).alias("salts")), "partners")
    key = F.xxhash64("b").alias("key")
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    answers = partners.select(key, every, F.col("b").alias("id"), F.lit(0).alias("role"))
    askers = pairs.join(partners, "b").select(key, _salt_of("a", F.col("salts")).alias("salt"), F.col("a").alias("id"), F.lit(1).alias("role"))
    rows = answers.unionByName(askers).join(sketches.select("id", "n", "bits"), "id")
    return _met(rows, ["key", "salt"], cfg).select(F.col("b").alias("a"), F.col("a").alias("b"))


def _alike_in_size(a: Column, b: Column, cfg: NearDupConfig) -> Column:
    return F.least(a, b) >= F.lit(cfg.threshold) * F.greatest(a, b)


def _similar(pairs: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The pairs of sets, or texts, similar enough, with both lengths and the overlap."""
    threshold, sets_of, kind = cfg.threshold, _distinct_grams(cfg), "grams" if "grams_a" in pairs.columns else "lower"

    def sets(column: pa.Array) -> list[np.ndarray]:
        if kind == "grams":
            return [x.values.to_numpy() for x in column]
        coded = column.dictionary_encode()
        held = [x.values.to_numpy() for x in sets_of(coded.dictionary)]
        return [held[i] for i in coded.indices.to_pylist()]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sides = [sets(part.column(f"{kind}_{side}")) for side in "ab"]
                both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)], np.int64)
                sizes = [np.array(list(map(len, side)), np.int64) for side in sides]
                jaccard = both / (sizes[0] + sizes[1] - both)
                held = part.select(["a", "b", "len_a", "len_b"]).append_column("jaccard", pa.array(jaccard, pa.float64()))
                yield held.filter(pa.array(jaccard >= threshold))

    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b", "len_a", "len_b"))
    return pairs.select("a", "b", "len_a", "len_b", f"{kind}_a", f"{kind}_b").mapInArrow(batches, f"{kinds}, jaccard double")


def _sides(sets: DataFrame, *shared: str) -> tuple[DataFrame, DataFrame]:
    """The same rows as left (``a``) and right (``b``) side of a self-join."""

    def side(tag: str) -> DataFrame:
        return sets.select(
            *shared,
            F.col("id").alias(tag),
            *[F.col(c).alias(f"{c}_{tag}") for c in sets.columns if c not in shared and c != "id"],
        )

    return side("a"), side("b")


def _verified(pairs: DataFrame, sets: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The same for pairs whose sets, or texts, fit the disk at once."""
    partners = cut(pairs.groupBy("b").agg(_salts(F.count("*"), cfg).alias("salts")), "partners")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    held = _of(sets, wanted)
    if "text" in sets.columns:
        lowered = held.select("id", F.length("text").alias("len"), F.lower("text").alias("lower"))
        held = _sets_of_texts(held, cfg) if cfg.unit == "word" else lowered
    left, right = _sides(held)
    salted_right = right.join(partners, "b").select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    salted = pairs.join(partners, "b").select("a", "b", _salt_of("a", F.col("salts")).alias("salt"))
    return _similar(salted.join(left, "a").join(salted_right, ["b", "salt"]), cfg)


def verify_pairs(pairs: DataFrame, sets: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Of the distinct pairs ``(a, b)`` those similar enough, with both lengths and the overlap.

    ``a`` has few partners by construction; ``b`` may have any number, so its set
    is replicated over salts in proportion to them. ``sets`` may be texts ``(id, text)``; where a set
    of characters' shingles would take several times the bytes, the texts travel. The pairs are taken in slices of
    at most ``AT_ONCE``, or of as many as there are documents in them.
    """
    n = pairs.count()
    if n <= AT_ONCE:
        return _verified(pairs, sets, cfg)
    documents = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().count()
    slices = -(-n // max(AT_ONCE, documents))
    parts = [pairs.where(F.pmod(F.xxhash64("a"), F.lit(slices)) == i) for i in range(slices)]
    return reduce(DataFrame.unionByName, [cut(_verified(part, sets, cfg), "slice") for part in parts])


def _small_pairs(keyed: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs ``(a, b)`` inside buckets of bounded size that their sketches do not rule out.

    ``keyed`` has sketches with the ``keys`` of a document's small buckets by band. Of many rows,
    a few bands or one are compared at a time, so that the disk holds a sketch as often only.
    """
    n = keyed.agg(F.sum(F.size(F.array_compact("keys")))).first()[0] or 0
    turns, found = max(1, min(cfg.bands, -(-n // AT_ONCE))), []
    for turn in range(turns):
        buckets = F.explode(F.array(*[F.get("keys", F.lit(band)) for band in range(turn, cfg.bands, turns)]))
        rows = keyed.where("keys IS NOT NULL").select(buckets.alias("bucket"), F.lit(2).alias("role"), "id", "n", "bits")
        found.append(cut(_met(rows.where(F.col("bucket").isNotNull()), ["bucket"], cfg), "band"))
    pairs = reduce(DataFrame.unionByName, found)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _blocks(rows: DataFrame, sizes: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """``rows`` of buckets with the number of ``blocks`` that the bucket's members are dealt to."""
    return rows.join(sizes.select("bucket", F.ceil(F.col("n_bucket") / cfg.block).cast("int").alias("blocks")), "bucket")


def _asked(answers: DataFrame, askers: DataFrame, sizes: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs of each asker, as ``a``, with each of its bucket's few answers, as ``b``; askers are dealt to blocks."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    answering = _blocks(answers, sizes, cfg).withColumn("salt", every).withColumn("role", F.lit(0))
    asking = _blocks(askers, sizes, cfg).withColumn("salt", _salt_of("id", F.col("blocks"))).withColumn("role", F.lit(1))
    rows = answering.unionByName(asking).drop("blocks").join(sketches.select("id", "n", "bits"), "id")
    return _met(rows, ["bucket", "salt"], cfg).select(F.col("b").alias("a"), F.col("a").alias("b")).distinct()


def _led_pairs(state: DataFrame, leaders: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs of each member with its bucket's leader."""
    sizes = state.groupBy("bucket").agg(F.count("*").alias("n_bucket"))
    askers = state.join(leaders.select("bucket"), "bucket", "left_semi").select("bucket", "id")
    return _asked(leaders.select("bucket", F.col("leader").alias("id")), askers, sizes, sketches, cfg)


def _leader_links(
    members: DataFrame, texts: DataFrame, sketches: DataFrame, cfg: NearDupConfig
) -> tuple[DataFrame, list[DataFrame]]:
    """Stars around elected leaders: members with a ``star`` number (0 = open) and the links found."""
    found: list[DataFrame] = []
    state = members.withColumn("star", F.lit(0))
    active = members.select("bucket").distinct()
    for turn in range(1, cfg.leader_rounds + 1):
        leaders = (
            state.where("star = 0")
            .join(active, "bucket", "left_semi")
            .groupBy("bucket")
            .agg(F.count("*").alias("n_open"), F.min_by("id", _best()).alias("leader"))
            .where(F.col("n_open") > cfg.small_bucket)
        )
        sizes = state.groupBy("bucket").agg(_salts(F.count("*"), cfg).alias("salts"))
        leaders = cut(leaders.join(sizes, "bucket"), "leaders")
        if leaders.isEmpty():
            break
        spread = leaders.select(
            "bucket", "leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
        )
        led = (
            state.join(leaders.select("bucket", "salts"), "bucket")
            .withColumn("salt", _salt_of("id", F.col("salts")))
            .join(spread, ["bucket", "salt"])
            .select("bucket", "id", "star", "leader")
        )
        close = cut(_led_pairs(state, leaders, sketches, cfg), "close")
        links = cut(verify_pairs(close, texts, cfg), "links")
        found.append(links)
        hits = links.select(F.col("a").alias("id"), F.col("b").alias("leader"), F.lit(True).alias("hit"))
        joined = led.where("star = 0").join(hits, ["id", "leader"], "left")
        placed = cut(
            joined.where(F.col("hit") | (F.col("id") == F.col("leader"))).select(
                "bucket", "id", F.lit(turn).alias("new_star")
            ),
            "placed",
        )
        active = (
            placed.groupBy("bucket")
            .agg(F.count("*").alias("n_star"))
            .join(leaders, "bucket")
            .where(F.col("n_star") >= cfg.worthwhile_star * F.col("n_open"))
            .select("bucket")
        )
        state = cut(
            state.join(placed, ["bucket", "id"], "left").select(
                "bucket", "id", "len", F.coalesce("new_star", "star").alias("star")
            ),
            "stars",
        )
    return state, found


def _open_questions(state: DataFrame, links: DataFrame) -> DataFrame:
    """``(bucket, id, len, component, unsettled, asks)`` for buckets where something asks.

    A document asks in a bucket when it lies outside the component most of the
    bucket belongs to, or when it is ``unsettled``: in no star and without a
    known better partner.
    """
    components = connected_components(links, "a", "b")
    losers = _losers(links).select("id", F.lit(True).alias("lost"))
    tagged = cut(
        state.join(components, "id", "left")
        .join(losers, "id", "left")
        .select(
            "bucket",
            "id",
            "len",
            F.coalesce("component", "id").alias("component"),
            ((F.col("star") == 0) & F.col("lost").isNull()).alias("unsettled"),
        ),
        "tagged",
    )
    main = (
        tagged.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    )
    asking = tagged.join(main, "bucket").select(
        *tagged.columns, (F.col("unsettled") | (F.col("component") != F.col("main"))).alias("asks")
    )
    return cut(asking.join(asking.where("asks").select("bucket").distinct(), "bucket", "left_semi"), "asking")


def _a_is_better() -> Column:
    return (F.col("len_a") > F.col("len_b")) | ((F.col("len_a") == F.col("len_b")) & (F.col("a") < F.col("b")))


def _matters() -> Column:
    """Whether the answer of ``a`` could tell the asking ``b`` something new."""
    return (F.col("component_a") != F.col("component_b")) | (F.col("unsettled_b") & _a_is_better())


def _labelled(questions: DataFrame) -> DataFrame:
    """What ``_met`` needs of questions to tell which answers matter."""
    return questions.select("bucket", "id", "len", F.xxhash64("component").alias("component"), "unsettled")


def _scouted_pairs(questions: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs of every asking document with a few arbitrary members of its bucket."""
    arbitrary = Window.partitionBy("bucket").orderBy(F.xxhash64("id", F.lit(1)), "id")
    scouts = questions.withColumn("_rank", F.row_number().over(arbitrary)).where(F.col("_rank") <= cfg.scouts)
    sizes = questions.groupBy("bucket").agg(F.count("*").alias("n_bucket"))
    return _asked(_labelled(scouts), _labelled(questions.where("asks")), sizes, sketches, cfg)


def _remaining_pairs(questions: DataFrame, texts: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs ``(a, b)`` of an answering and an asking document that can reach the threshold.

    Where a bucket has few pairs for its shingles, its sketches are compared pair by pair:
    common shingles, such as those of characters, would match far more rows than there are pairs.
    """
    sized = questions.join(sketches.select("id", "n"), "id")
    few = F.count_if("asks") * F.count("*") <= F.lit(cfg.pairs_per_gram) * F.sum("n")
    plain = cut(sized.groupBy("bucket").agg(few.alias("few"), F.count("*").alias("n_bucket")).where("few"), "plain")
    direct = _direct_pairs(questions.join(plain.select("bucket"), "bucket", "left_semi"), plain, sketches, cfg)
    by_prefix = cut(_prefix_pairs(questions.join(plain, "bucket", "left_anti"), texts, cfg), "pairs")
    return direct.unionByName(_sketched(by_prefix, sketches, cfg)).distinct()


def _direct_pairs(questions: DataFrame, sizes: DataFrame, sketches: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Asking documents meet each block of their bucket's answers; ``sizes`` has the buckets' ``n_bucket``."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    answers = _blocks(_labelled(questions), sizes, cfg).withColumn("salt", _salt_of("id", F.col("blocks")))
    askers = _blocks(_labelled(questions.where("asks")), sizes, cfg).withColumn("salt", every)
    rows = answers.withColumn("role", F.lit(0)).unionByName(askers.withColumn("role", F.lit(1)))
    return _met(rows.drop("blocks").join(sketches.select("id", "n", "bits"), "id"), ["bucket", "salt"], cfg).distinct()


def _prefix_pairs(questions: DataFrame, texts: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The same by the size, prefix and position filters."""
    if questions.isEmpty():
        return questions.select(F.col("id").alias("a"), F.col("id").alias("b"))
    grams = _gram_sets(texts, questions, cfg).select("id", F.size("grams").alias("n"), F.explode("grams").alias("h"))
    frequency = grams.groupBy("h").agg(F.count("*").alias("df"))
    rarest = Window.partitionBy("id").orderBy("df", "h")
    prefix_length = F.col("n") - F.ceil(F.lit(cfg.threshold) * F.col("n")) + 1
    prefixes = (
        grams.join(frequency, "h")
        .withColumn("rank", F.row_number().over(rarest))
        .where(F.col("rank") <= prefix_length)
        .select("id", "n", "h", "rank")
    )
    keyed = cut(questions.join(prefixes, "id"), "prefixes")
    # A shingle that a third of a bucket shares is split: its answers over salts, its askers to each of them.
    salts = keyed.groupBy("bucket", "h").agg(_salts(F.count("*"), cfg).alias("salts"), F.max("asks").alias("asked"))
    salted = keyed.join(salts.where("asked").drop("asked"), ["bucket", "h"])
    spread = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    answers = _sides(salted.withColumn("salt", _salt_of("id", F.col("salts"))), "bucket", "h", "salt")[0]
    askers = _sides(salted.where("asks").withColumn("salt", spread), "bucket", "h", "salt")[1]
    reachable = 1 + F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b"))
    needed = F.lit(cfg.threshold / (1 + cfg.threshold)) * (F.col("n_a") + F.col("n_b"))
    return (
        answers.join(askers, ["bucket", "h", "salt"])
        .where(_matters() & _alike_in_size(F.col("n_a"), F.col("n_b"), cfg) & (reachable >= needed - 1e-6))
        .select("a", "b")
        .distinct()
    )


def near_duplicates(df: DataFrame, id_col: str, text_col: str, cfg: NearDupConfig = NearDupConfig()) -> NearDuplicates:
    """Copies and sufficient similarity links of a document table.

    The links have the components and the losers of all similar pairs; which of the
    pairs they are depends on the sizes of the buckets. Documents with a null id, and
    those whose id another row has too, take no part: no filter could name them.
    ``near_dedup`` gives such rows ids of their own first.
    """
    docs = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    narrow = docs.withColumn("fp", F.md5("text")).withColumn("len", F.length("text"))
    signatures = cut(
        minhash_signature(narrow, "id", "text", cfg.n, cfg.unit, cfg.bands * cfg.rows, keep=["fp", "len"]),
        "signatures",
    )
    unclear = cut(docs.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "unclear")
    signatures = signatures.join(unclear, "id", "left_anti")
    reps = signatures.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    copies = cut(
        signatures.select("id", "fp").join(reps.where("n > 1"), "fp").where("id <> rep").select("id", "rep"), "copies"
    )
    distinct_texts = signatures.join(copies.select("id"), "id", "left_anti")
    buckets = band_table(distinct_texts, ["id", "len"], cfg.bands, cfg.rows)
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n_bucket")).where("n_bucket > 1")
    members = cut(buckets.join(sizes, "bucket"), "members")

    small = members.where(F.col("n_bucket") <= cfg.small_bucket)
    keys = small.groupBy("id").agg(
        F.array(*[F.max(F.when(F.col("band") == i, F.col("bucket"))) for i in range(cfg.bands)]).alias("keys")
    )
    texts = cut(_of(docs, members), "texts")
    sketches = cut(_sketches(_sets_of_texts(texts, cfg), cfg).join(keys, "id", "left"), "sketches")
    links = cut(verify_pairs(cut(_small_pairs(sketches, cfg), "close"), texts, cfg), "links")
    large = members.where(F.col("n_bucket") > cfg.small_bucket).select("bucket", "id", "len")
    if not large.isEmpty():
        stars, found = _leader_links(large, texts, sketches, cfg)
        links = cut(reduce(DataFrame.unionByName, found, links), "links")
        for find in (lambda asked: _scouted_pairs(asked, sketches, cfg), lambda asked: _remaining_pairs(asked, texts, sketches, cfg)):
            questions = _open_questions(stars, links)
            if questions.isEmpty():
                break
            close = cut(find(questions), "close")
            links = cut(links.unionByName(verify_pairs(close, texts, cfg)), "links")
    low_first = F.col("a") < F.col("b")
    links = links.select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(low_first, F.col("len_a")).otherwise(F.col("len_b")).alias("len_a"),
        F.when(low_first, F.col("len_b")).otherwise(F.col("len_a")).alias("len_b"),
        "jaccard",
    ).distinct()
    return NearDuplicates(copies=copies, links=cut(links, "links"))


def _losers(links: DataFrame) -> DataFrame:
    """Distinct ids ``(id)`` of the documents that lose a link."""
    return links.select(F.when(_a_is_better(), F.col("b")).otherwise(F.col("a")).alias("id")).distinct()


def pair_losers(found: NearDuplicates) -> DataFrame:
    """Distinct ids ``(id)`` of the documents with a better similar one; all copies are among them."""
    return _losers(found.links).unionByName(found.copies.select("id"))


def dup_clusters(found: NearDuplicates) -> DataFrame:
    """``(id, cluster, keeper)`` for every document with a duplicate.

    A cluster is a connected component named after its smallest id; its keeper is
    its longest document, then the smallest id.
    """
    components = connected_components(found.links, "a", "b")
    lengths = (
        found.links.select(F.col("a").alias("id"), F.col("len_a").alias("len"))
        .unionByName(found.links.select(F.col("b").alias("id"), F.col("len_b").alias("len")))
        .distinct()
    )
    placed = components.join(lengths, "id")
    keepers = placed.groupBy("component").agg(F.min_by("id", _best()).alias("keeper"))
    linked = components.join(keepers, "component").select("id", F.col("component").alias("cluster"), "keeper")
    of_copies = found.copies.join(linked.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.coalesce("cluster", "rep").alias("cluster"), F.coalesce("keeper", "rep").alias("keeper")
    )
    lone_reps = (
        found.copies.select(F.col("rep").alias("id")).distinct().join(linked.select("id"), "id", "left_anti")
    ).select("id", F.col("id").alias("cluster"), F.col("id").alias("keeper"))
    return linked.unionByName(of_copies).unionByName(lone_reps)


def near_dup_filter(df: DataFrame, id_col: str, found: NearDuplicates, keep: str = "cluster") -> DataFrame:
    """Documents that survive; those without shingles always do.

    ``keep="cluster"`` keeps the longest document of each cluster; ``"pairwise"``
    drops every document that has a better similar one.
    """
    if keep == "cluster":
        losers = dup_clusters(found).where("id <> keeper").select("id")
    elif keep == "pairwise":
        losers = pair_losers(found)
    else:
        raise ValueError(f"keep must be 'cluster' or 'pairwise', not {keep!r}")
    return df.join(losers.withColumnRenamed("id", "_loser"), F.col(id_col) == F.col("_loser"), "left_anti")


def near_dedup(
    df: DataFrame, id_col: str, text_col: str, cfg: NearDupConfig = NearDupConfig(), keep: str = "cluster"
) -> DataFrame:
    """``df`` without near duplicates, whatever its ids.

    Where an id is null or repeats, rows are told apart by id and place in a table written
    for it, so a crawl that holds a record twice loses one of the two, and different texts
    under one id are different documents. Ids that are all clear decide as they always do.
    """
    ids = df.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    if ids.where("id IS NULL OR n > 1").isEmpty():
        return near_dup_filter(df, id_col, near_duplicates(df, id_col, text_col, cfg), keep)
    stored = cut(df.withColumn("_place", F.monotonically_increasing_id()), "placed")
    keyed = stored.withColumn("_key", F.struct(F.col(id_col).alias("id"), F.col("_place").alias("place")))
    kept = near_dup_filter(keyed, "_key", near_duplicates(keyed, "_key", text_col, cfg), keep)
    return kept.select(*df.columns)
