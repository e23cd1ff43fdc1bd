"""Language identification from character trigrams.

Trigrams fall into ``buckets``, a parameter that the profile records, so a profile
holds at most that many rows per language however large its training text is.
Scores are sums of integer micro-logarithms: exact, whatever the order of the rows.

Training and scoring go over Arrow batches with numpy: a row is judged by its own
text, without an id and without a shuffle. A model beyond ``BROADCAST_LIMIT`` is
joined on its buckets instead, with the same results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.grams import explode_grams, gram_multipliers, remainder
from textmill.session import cut

# Fixed values of the profile.
GRAM = 3
BUCKETS = 1 << 20
MICRO = 1_000_000
# Sharpness of the probabilities: mean log-probabilities per trigram are multiplied by it.
SCALE = 2.0
LANG = "en"
THRESHOLD = 0.6
BROADCAST_LIMIT = 64 * 2**20
# Code points that numpy handles at a time.
CHUNK = 1 << 16
# What ``single_line`` takes off both ends: [\s\p{Z}].
BLANKS = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Trigrams that a training task holds uncounted.
FLUSH = 1 << 22


def single_line(text: Column) -> Column:
    """Line breaks to spaces, white space off both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"[\r\n]", " "), r"^[\s\p{Z}]+|(?<![\s\p{Z}])[\s\p{Z}]++$", "")


def _bucketer(buckets: int) -> Callable[[str | None], Iterator[np.ndarray]]:
    """A function from a lower-cased text to the buckets of its line's trigrams, chunk by chunk.

    The line is that of ``single_line``, whose pattern also drops blanks before a U+0085 at the
    text's end; its regular expressions take several times as long as the trigrams do. The
    helper is built here, so it travels to the executors by value.
    """
    factors, gram, chunk, blanks, next_line = gram_multipliers(GRAM), GRAM, CHUNK, BLANKS, "\u0085"
    remainders = remainder()

    def single(text: str) -> str:
        line = text.replace("\r", " ").replace("\n", " ").lstrip(blanks)
        end = next_line if line.endswith(next_line) else ""
        return line.removesuffix(next_line).rstrip(blanks) + end

    def chunks(text: str | None) -> Iterator[np.ndarray]:
        line = single(text or "")
        for at in range(0, len(line) - gram + 1, chunk):
            part = np.frombuffer(line[at : at + chunk + gram - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
            size = len(part) - gram + 1
            total = sum(part[k : k + size] * np.uint64(m) for k, m in enumerate(factors))
            yield (remainders(total).astype(np.uint32) % np.uint32(buckets)).astype(np.int32)

    return chunks


def lang_profile(df: DataFrame, text_col: str, lang_col: str = "lang", buckets: int = BUCKETS) -> DataFrame:
    """``(lang, bucket, n, total, logp, buckets)`` with add-one smoothing, ``logp`` in micro-units.

    Trigrams are counted inside every task before anything is shuffled, and at most
    ``FLUSH`` of them are held at a time, however long the batches and texts are.
    """
    chunks, flush = _bucketer(buckets), FLUSH

    def counted(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        bucket, n = np.unique(np.concatenate(parts), return_counts=True)
        columns = [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang = lang.as_py()
                for part in chunks(text.as_py()):
                    held.setdefault(lang, []).append(part)
                    size += len(part)
                    if size >= flush:
                        yield from (counted(label, parts) for label, parts in held.items())
                        held, size = {}, 0
        yield from (counted(label, parts) for label, parts in held.items())

    labelled = df.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.lower(text_col).alias("text")
    )
    parts = labelled.mapInArrow(count, "lang string, bucket int, n bigint")
    counts = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # A language's window holds at most ``buckets`` rows.
    total = F.sum("n").over(Window.partitionBy("lang"))
    return counts.select("lang", "bucket", "n", total.alias("total"), F.lit(buckets).alias("buckets")).select(
        "lang", "bucket", "n", "total", _micro_log(F.col("n") + 1).alias("logp"), "buckets"
    )


def _micro_log(numerator: Column) -> Column:
    return F.round(F.log(numerator / (F.col("total") + F.col("buckets"))) * MICRO).cast("bigint")


@dataclass(frozen=True)
class LanguageModel:
    """The languages of a profile, their floor for unseen trigrams, and gains above it.

    ``gains`` is ``(bucket, place, gain)`` with a language's place in ``langs``;
    ``packed`` has the same as arrays where they fit, and is null for larger models.
    """

    langs: list[str]
    unseen: list[int]
    buckets: int
    gains: DataFrame
    packed: Broadcast | None


def lang_model(profile: DataFrame, limit: int = BROADCAST_LIMIT) -> LanguageModel:
    """The model of a profile, which is written once, so scoring does not train it again.

    The driver sees the languages, and the gains only when their arrays take at most
    ``limit`` bytes.
    """
    profile = cut(profile, "profile")
    one = F.lit(1).alias("one")
    per_lang = profile.groupBy("lang", "total", "buckets").agg(F.count("*").alias("rows")).select(
        "lang", _micro_log(F.lit(1)).alias("floor"), "buckets", "rows", one
    )
    place = F.row_number().over(Window.partitionBy("one").orderBy("lang")) - 1
    langs = cut(per_lang.withColumn("place", place), "languages")
    gains = cut(
        profile.join(langs.select("lang", "floor", "place"), "lang").select(
            "bucket", "place", (F.col("logp") - F.col("floor")).alias("gain")
        ),
        "gains",
    )
    rows = langs.orderBy("place").collect()
    buckets = rows[0]["buckets"] if rows else BUCKETS
    most = min(buckets, sum(r["rows"] for r in rows))
    packed = None
    if 4 * (buckets + (most + 1) * len(rows)) <= limit:
        packed = profile.sparkSession.sparkContext.broadcast(_packed(gains.toPandas(), buckets, len(rows)))
    return LanguageModel([r["lang"] for r in rows], [r["floor"] for r in rows], buckets, gains, packed)


def _packed(gains: pd.DataFrame, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of every bucket, and the gains per language and place; place 0 is of unseen buckets."""
    keys = np.unique(gains["bucket"].to_numpy(np.int64))
    index = np.zeros(buckets, np.int32)
    index[keys] = np.arange(1, len(keys) + 1)
    table = np.zeros((width, len(keys) + 1), np.int32)
    table[gains["place"], index[gains["bucket"]]] = gains["gain"]
    return index, table


def _row_sums(df: DataFrame, text_col: str, model: LanguageModel) -> DataFrame:
    chunks, shared, width = _bucketer(model.buckets), model.packed, len(model.langs)

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, table = shared.value
        for batch in texts:
            n, sums = np.zeros(len(batch), np.int64), np.zeros((len(batch), width), np.int64)
            # Texts leave Arrow one by one, so a batch is never held as Python strings too.
            for row, text in enumerate(batch):
                for part in chunks(text.as_py()):
                    n[row] += len(part)
                    sums[row] += table.take(index[part], axis=1).sum(axis=1, dtype=np.int64)
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * np.int32(width)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.ravel()))
            yield pa.StructArray.from_arrays([pa.array(n), lists], ["n", "g"])

    # Non-deterministic for the planner only, so that a filter on the result does not score every text twice.
    udf = F.arrow_udf(batches, "n bigint, g array<bigint>").asNondeterministic()
    return df.withColumn("_sums", udf(F.lower(text_col)))


def _joined_sums(df: DataFrame, text_col: str, model: LanguageModel) -> DataFrame:
    """The same for a model of any size: different texts, by their digest, meet the gains in a join."""
    digest = F.sha2(F.col(text_col), 256)
    texts = df.select(digest.alias("_digest"), F.col(text_col).alias("_text")).groupBy("_digest").agg(F.first("_text").alias("_text"))
    lines = texts.where("_digest IS NOT NULL").select("_digest", single_line(F.col("_text")).alias("_line"))
    bucket = (F.col("h") % model.buckets).cast("int").alias("bucket")
    counts = explode_grams(lines, ["_digest"], F.col("_line"), GRAM).groupBy("_digest", bucket).agg(F.count("*").alias("k"))
    sizes = counts.groupBy("_digest").agg(F.sum("k").alias("n"))
    gained = counts.join(model.gains, "bucket").groupBy("_digest", "place").agg(F.sum(F.col("k") * F.col("gain")).alias("g"))
    maps = gained.groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("place", "g"))).alias("_of"))
    places = F.array(*[F.lit(i) for i in range(len(model.langs))])
    g = F.transform(places, lambda i: F.coalesce(F.try_element_at("_of", i), F.lit(0).cast("bigint")))
    sums = sizes.join(maps, "_digest", "left").select("_digest", F.struct("n", g.alias("g")).alias("_sums"))
    return df.join(sums, digest == F.col("_digest")).drop("_digest")


def _scored(df: DataFrame, text_col: str, model: LanguageModel) -> DataFrame:
    """``df`` with ``_scores``, an array of ``(lang, prob)``; texts without a trigram give no row."""
    sums = (_joined_sums if model.packed is None else _row_sums)(df, text_col, model).where("_sums.n > 0")
    n, g = F.col("_sums.n"), F.col("_sums.g")
    # The planner may judge a text before the filter on its size.
    means = F.array(
        *[F.try_divide(g[i] + n * F.lit(floor).cast("bigint"), n) * (SCALE / MICRO) for i, floor in enumerate(model.unseen)]
    )
    weights = sums.select(*df.columns, means.alias("_m")).select(
        *df.columns, F.transform("_m", lambda x: F.exp(x - F.array_max("_m"))).alias("_w")
    )
    total = F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x)
    probs = weights.select(*df.columns, F.transform("_w", lambda x: F.round(x / total, 6)).alias("_p"))
    scores = [F.struct(F.lit(lang).alias("lang"), F.col("_p")[i].alias("prob")) for i, lang in enumerate(model.langs)]
    return probs.select(*df.columns, F.array(*scores).alias("_scores"))


def _best() -> Column:
    """The most probable language, ties to the smallest label."""
    ranked = F.transform(
        "_scores", lambda s, i: F.struct(s["prob"].alias("prob"), (-i).alias("rank"), s["lang"].alias("lang"))
    )
    return F.array_max(ranked)


def lang_score(df: DataFrame, id_col: str, text_col: str, model: LanguageModel) -> DataFrame:
    """``(id, lang, prob)`` for every language of the model."""
    return _scored(df.select(id_col, text_col), text_col, model).select(id_col, F.inline("_scores"))


def lang_predict(df: DataFrame, id_col: str, text_col: str, model: LanguageModel) -> DataFrame:
    """``(id, lang, prob)`` of the most probable language, ties to the smallest label."""
    scored = _scored(df.select(id_col, text_col), text_col, model)
    return scored.select(id_col, _best().alias("_b")).select(id_col, "_b.lang", "_b.prob")


def lang_filter(
    df: DataFrame, text_col: str, model: LanguageModel, lang: str = LANG, threshold: float = THRESHOLD
) -> DataFrame:
    """Rows whose most probable language is ``lang`` with at least ``threshold``.

    Every row is judged by its own text: there is no id that could be null or equal.
    """
    best = _scored(df, text_col, model).withColumn("_b", _best())
    return best.where((F.col("_b.lang") == lang) & (F.col("_b.prob") >= threshold)).select(*df.columns)


def model_filter(
    df: DataFrame, text_col: str, predict, lang: str = LANG, threshold: float = THRESHOLD
) -> DataFrame:
    """``lang_filter`` with a user's own model, applied to Arrow batches without a shuffle.

    ``predict`` maps a pandas Series of single-line texts to a DataFrame with
    ``lang`` and ``prob``; it should load its model once per worker. Null and
    blank texts are never passed to it.
    """
    line = single_line(F.col(text_col))
    scored = df.where(F.length(line) > 0).withColumn(
        "_top", F.pandas_udf(predict, "lang string, prob double")(line)
    )
    return scored.where((F.col("_top.lang") == lang) & (F.col("_top.prob") >= threshold)).drop("_top")
