"""The registered queries of this subpackage and their SQL.

Each applies one operator, with its default parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (
    exact_index, hnsw, language_id, link_trust, merkle, mixing, pii_crf, piece_sampling, secret_scan, simhash_cover,
    token_alignment, token_tree, toxicity,
)
from textmill.session import scratch_path


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/{name}.parquet")
    return table.select(*columns) if columns else table


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Learns from three quarters of the ids, scores every text."""
    docs = _table(spark, sf, "documents", "doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    scored = language_id.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Four batches, newest ids first, each against the index of those before; labels from the filled index."""
    docs = _table(spark, sf, "documents", "doc_id", "text")
    index = exact_index.DigestIndex(spark, scratch_path(spark, "digests"), _partitions(spark))
    sizes = index.admit_newest_first(docs)
    return index.label(docs, None, sizes=sizes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_pii_scan(spark: SparkSession, sf: str) -> DataFrame:
    field = pii_crf.train(pii_crf.labelled_table(spark))
    found = pii_crf.scan(_table(spark, sf, "documents", "doc_id", "text"), field)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def ranked(spans: Column) -> Column:
        rank = F.create_map(*[F.lit(x) for i, kind in enumerate(pii_crf.KINDS) for x in (kind, i)])
        return F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    base = F.col("base_spans")
    counts = [secret_scan.count_kind(base, kind).alias(f"n_{kind}") for kind in pii_crf.KINDS]
    every = F.array_sort(ranked(F.concat("base_spans", "added_spans")))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents", "doc_id", "text")
    model = secret_scan.train(secret_scan.labelled_samples(docs, "doc_id", "text"))
    found = secret_scan.scan(docs, model)
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("secrets"), kind).alias(f"n_{kind}") for kind in secret_scan.PATTERNS],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"),
    )


def op5_nearest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    return hnsw.search_index(hnsw.build_index(vectors), vectors.where("vec_id % 100 = 0"))


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = link_trust.url_filter(_table(spark, sf, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every document, and after three edits to each: one insertion, one deletion, one replacement."""
    vocabulary = token_tree.read_vocabulary()
    docs = _table(spark, sf, "documents", "doc_id", "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    somewhere = F.pmod(F.xxhash64("doc_id"), size + 1)

    def edit(start: Column, remove: int, insert: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), F.lit(remove).alias("remove"), insert.alias("insert"))

    edits = F.array(
        edit(size / 3, 0, F.concat(F.lit(" revised "), F.col("doc_id"), F.lit(" times "))),
        edit(size * 2 / 3, 40, F.lit("")),
        edit(somewhere, 5, F.lit("amended, ")),
    )
    before = token_tree.build_trees(docs, vocabulary).withColumnRenamed("n_tokens", "tokens_before")
    after = token_tree.apply_edits(before.withColumns({"edits": edits, "chars_before": size}), vocabulary)
    return after.select(
        "doc_id", "chars_before", "tokens_before", F.length("text").alias("chars_after"), F.col("n_tokens").alias("tokens_after"),
        "encoded_chars", F.size(F.filter(F.slice("tree_chars", F.size("tree_chars") / 2 + 1, F.size("tree_chars")), lambda n: n > 0)).alias("segments"),
    )


def op8_piece_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every document's sampled segmentations, and whether each decodes to its text."""
    vocabulary = piece_sampling.read_vocabulary()
    encoded = piece_sampling.encode(_table(spark, sf, "documents", "doc_id", "text"), vocabulary)
    one = encoded.select("doc_id", "text", F.posexplode("samples").alias("place", "sample"))
    rows = one.select("doc_id", "text", (F.col("place") + 1).alias("rank"), "sample.*")
    # The vocabulary's word mark stands for a blank, so a text that holds one comes back with a blank.
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), piece_sampling.MARK, " ")
    return piece_sampling.decode(rows, vocabulary).select(
        "doc_id", "rank", F.size("ids").alias("n_pieces"), "log_prob", "perturbed", "log_inclusion",
        F.xxhash64("ids").alias("ids_hash"), same.alias("round_trip"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    classes = simhash_cover.simhash_classes(_table(spark, sf, "documents", "doc_id", "text"))
    return classes.select("doc_id", simhash_cover.hex_of(F.col("simhash")).alias("fingerprint"), "component_id")


def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    queued = mixing.queue(_table(spark, sf, "documents", "doc_id", "text", "source"))
    return queued.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "before", F.round("finish", 6).alias("finish"), "taken")


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of every document, and what they say of one whose line feeds were lost where the id's checksum is even."""
    docs = _table(spark, sf, "documents", *merkle.FIELDS)
    fields = [F.col(f) if f != "text" else F.translate("text", "\n", "") for f in merkle.FIELDS]
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    claimed = F.when(even, merkle.leaf_digest(fields))
    proofs = merkle.Manifest.build(docs, carry={"claimed": claimed}).proofs()
    checked = merkle.verify(proofs, F.coalesce("claimed", "digest"))
    return checked.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified",
    )


def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Learns from two thirds of the ids, scores every text."""
    docs = _table(spark, sf, "documents", "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    labels = _table(spark, sf, "labels", "doc_id", "toxic").where(~held_out)
    model = toxicity.fit(docs.where(~held_out), labels)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    aligned = token_alignment.align_documents(_table(spark, sf, "documents", "doc_id", "text"), token_alignment.read_vocabularies())
    return aligned.select("doc_id", *token_alignment.MEASURES)


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_language_id, op2_exact_dedup, op3_pii_scan, op4_secret_scan, op5_nearest, op6_url_filter, op7_token_counts,
    op8_piece_samples, op9_simhash_near_dedup, op10_source_mix,
    op11_merkle_manifest, op12_toxicity, op13_token_alignment,
]

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_index.SQL,
    "op6_url_filter": link_trust.SQL,
    "op10_source_mix": mixing.SQL,
    "op11_merkle_manifest": merkle.SQL,
}
