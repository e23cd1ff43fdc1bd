"""Crawl archives as a DataFrame: byte ranges or a text scan, headers by expression.

Archives, plain or gzip, come from the data source of ``archive_source``, which completes
torn records while it reads, so every archive is read once. In a store that only
Spark reaches, plain archives are scanned as text instead, as follows.

Records end with an empty line and the next one opens with the version line, so
that sequence is the separator of a text scan: one archive is read by as many
tasks as it has blocks. A payload that holds the sequence itself is cut there;
such torn records are recognised by their declared length and sewn together.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from textmill.schemas import CRAWL_RECORD, check_schema
from textmill.session import cut, scratch_path
from textmill.sources.archive_source import BATCH_BYTES, outer_records, reachable, read_archives

# Fixed values of the archive format.
VERSION_LINE = "WARC/1.0"
CRLF = "\r\n"
EMPTY_LINE = CRLF * 2
# Bytes of blank lines that may follow a record's declared end.
SLACK = 2 * len(EMPTY_LINE)


def _separator(version: str) -> str:
    return EMPTY_LINE + version + CRLF


def _header(head: Column, name: str) -> Column:
    """The value of a header, null where it is missing or empty."""
    value = F.btrim(F.regexp_extract(head, rf"(?im)^{name}:([^\r\n]*)", 1), F.lit(" \t"))
    return F.nullif(value, F.lit(""))


def _head(raw: Column) -> Column:
    """The bytes before the first empty line, as text."""
    return F.substring_index(raw.cast("string"), EMPTY_LINE, 1)


def _after(raw: Column, head: Column, gap: Column | int = len(EMPTY_LINE)) -> Column:
    """The bytes after a head and the ``gap`` that ends it."""
    start = F.octet_length(head) + gap + 1
    return F.substr(raw, start, F.greatest(F.octet_length(raw) - start + 1, F.lit(0)))


def _http_head(raw: Column) -> tuple[Column, Column]:
    """An HTTP head, its lines ended by CRLF or by LF alone, and the bytes between it and the body."""
    text = raw.cast("string")
    crlf, lf = F.substring_index(text, "\n" + CRLF, 1), F.substring_index(text, "\n\n", 1)
    first = F.octet_length(crlf) <= F.octet_length(lf)
    return F.when(first, crlf).otherwise(lf), F.when(first, 1 + len(CRLF)).otherwise(2)


def _file_name(file: Column) -> Column:
    return F.element_at(F.split(file, "/"), -1)


def read_fragments(spark: SparkSession, path: str | list[str], glob: str = "*.warc", version: str = VERSION_LINE) -> DataFrame:
    """Separated byte ranges with their archive header, in file order by ``(block, seq)``."""
    raw = (
        spark.read.option("lineSep", _separator(version))
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").cast("binary").alias("raw"),
        )
    )
    return _with_head(raw)


def _with_head(raw: DataFrame) -> DataFrame:
    """Adds ``head``, the ``declared`` content length and ``torn``: fewer bytes than declared."""
    headed = raw.withColumn("head", _head(F.col("raw")))
    declared = _header(F.col("head"), "Content-Length").try_cast("bigint")
    present = F.octet_length("raw") - F.octet_length("head") - len(EMPTY_LINE)
    is_head = _header(F.col("head"), "WARC-Type").isNotNull()
    return headed.withColumn("declared", F.when(is_head, declared)).withColumn(
        "torn", F.coalesce(present < F.col("declared"), F.lit(False))
    )


def _outermost():
    """A function that keeps the torn records of a file that do not open inside another's payload.

    The helper is built here, so it travels to the executors by value.
    """

    def keep(spans: pd.DataFrame) -> pd.DataFrame:
        ordered = spans.sort_values("start")
        mask, reach = [], -1
        for start, stop in zip(ordered["start"], ordered["stop"]):
            mask.append(start >= reach)
            if start >= reach:
                reach = stop
        return ordered[mask]

    return keep


def sew(fragments: DataFrame, separator_length: int, version: str) -> DataFrame:
    """Fragments with every torn record made whole from the ones that follow it.

    Byte offsets come from a running sum inside each block plus the total of the
    blocks before it, so no task sees a whole archive; only offsets, never payloads,
    are put in order per file. A declared length counts only where it ends at the end
    of a fragment (``SLACK`` bytes of blank lines aside). A record that declares any
    other length, in a damaged archive, stays the one fragment that it is, so a false
    length never gathers the archive behind it.
    """
    sized = fragments.withColumn("size", F.octet_length("raw") + separator_length)
    blocks = sized.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    light = sized.select("file", "block", "seq", "size", "torn", F.octet_length("head").alias("head_size"), "declared")
    placed = cut(
        light.join(bases, ["file", "block"]).withColumn(
            "start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
        ),
        "placed",
    )
    claims = placed.where("torn").select(
        "file", "start", (F.col("start") + F.col("head_size") + len(EMPTY_LINE) + F.col("declared")).alias("stop")
    )
    ends = placed.select("file", (F.col("start") + F.col("size") - separator_length).alias("end"))
    spans = (
        claims.withColumn("end", F.explode(F.sequence(F.col("stop"), F.col("stop") + SLACK)))
        .join(ends, ["file", "end"], "left_semi")
        .select("file", "start", "stop")
        .distinct()
    )
    outer = cut(spans.groupBy("file").applyInPandas(_outermost(), spans.schema), "torn")
    # The last torn record that opened before a fragment, if it reaches that far.
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    marks = outer.select("file", "start", "stop", F.col("start").alias("record"))
    pieces = cut(
        placed.select("file", "block", "seq", "start")
        .join(marks, ["file", "start"], "left")
        .withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("record", "stop")})
        .where("start < stop")
        .select("file", "block", "seq", "start", "record"),
        "pieces",
    )
    whole = fragments.join(pieces, ["file", "block", "seq"], "left_anti")
    joined = (
        fragments.join(pieces, ["file", "block", "seq"])
        .groupBy("file", "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "block", "seq", "raw"))).alias("p"),
        )
        .select(
            "file",
            F.col("p")[0]["block"].alias("block"),
            F.col("p")[0]["seq"].alias("seq"),
            F.aggregate(
                F.slice("p", F.lit(2), F.size("p")),
                F.col("p")[0]["raw"],
                lambda acc, x: F.concat(acc, F.lit(_separator(version)).cast("binary"), x["raw"]),
            ).alias("raw"),
        )
    )
    return whole.unionByName(_with_head(joined))


def undo_transfer(body: Column, coding: Column) -> Column:
    """Undo chunked transfer and gzip or deflate coding; null when the bytes do not decode."""
    most = BATCH_BYTES

    def chunks(data: bytes) -> bytes:
        out, at = [], 0
        while True:
            end = data.index(b"\r\n", at)
            size = int(data[at:end].split(b";")[0], 16)
            if size == 0:
                return b"".join(out)
            out.append(data[end + 2 : end + 2 + size])
            at = end + 2 + size + 2

    def plain(data: bytes | None, how: str) -> bytes | None:
        if data is None:
            return None
        try:
            if "chunked" in how:
                data = chunks(data)
            if "gzip" in how:
                data = gzip.decompress(data)
            elif "deflate" in how:
                data = zlib.decompress(data)
            return data
        except (ValueError, EOFError, OSError, zlib.error):
            return None

    def batches(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        # Batches are limited by their coded size only; decoded bodies go on once they take ``most`` bytes.
        for bodies, codings in columns:
            out, held = [], 0
            for body, coding in zip(bodies, codings):
                out.append(plain(body.as_py(), coding.as_py()))
                held += len(out[-1] or b"")
                if held >= most:
                    yield pa.array(out, pa.binary())
                    out, held = [], 0
            yield pa.array(out, pa.binary())

    return F.arrow_udf(batches, "binary")(body, coding)


def decode_payload(raw: Column) -> Column:
    """UTF-8, or latin-1 when the bytes are not valid UTF-8."""
    text = raw.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(raw, "ISO-8859-1"))


def parse_records(fragments: DataFrame, keep: Column | None = None, extra: list[str] = []) -> DataFrame:
    """HTML responses among whole fragments, as crawl records.

    Rows where ``keep`` holds stay whatever they are, with null content where they are no
    HTML response; ``wanted`` tells then, and the ``extra`` columns stay too.
    """
    others = ["file", *extra, "wanted"] if keep is not None else []
    return _contents(_bodies(fragments, keep, extra), others)


def _bodies(fragments: DataFrame, keep: Column | None = None, extra: list[str] = []) -> DataFrame:
    """What ``parse_records`` takes, with the ``body`` as it was sent and its ``coding``."""
    kept = F.lit(False) if keep is None else keep
    response = F.lower(_header(F.col("head"), "WARC-Type")) == "response"
    http = fragments.where(response | kept).select(
        "file",
        *extra,
        kept.alias("kept"),
        response.alias("response"),
        _header(F.col("head"), "WARC-Record-ID").alias("warc_id"),
        _header(F.col("head"), "WARC-Target-URI").alias("url"),
        _header(F.col("head"), "WARC-Date").alias("date"),
        F.substr(_after(F.col("raw"), F.col("head")), F.lit(1), F.col("declared").cast("int")).alias("http"),
    )
    http_head, gap = _http_head(F.col("http"))
    split = http.withColumns({"http_head": http_head, "gap": gap})
    is_html = F.col("response") & F.coalesce(F.lower(_header(F.col("http_head"), "Content-Type")).contains("html"), F.lit(False))
    html = split.withColumn("wanted", F.coalesce(is_html, F.lit(False))).where("wanted OR kept")
    coding = F.lower(
        F.concat_ws(" ", _header(F.col("http_head"), "Transfer-Encoding"), _header(F.col("http_head"), "Content-Encoding"))
    )
    body = F.when(F.col("wanted"), _after(F.col("http"), F.col("http_head"), F.col("gap")))
    others = ["file", *extra, "wanted", "warc_id", "url", "date"]
    return html.select(*others, body.alias("body"), coding.alias("coding"))


def _coded() -> Column:
    return F.col("coding").rlike("chunked|gzip|deflate")


def _contents(bodies: DataFrame, others: list[str], undo: bool = True) -> DataFrame:
    """``bodies`` as crawl records behind the ``others``; without ``undo`` none may be coded, and no Python runs."""
    payload = F.col("body")
    if undo:
        # Only coded bodies are handed to Python; the rest pass as nulls.
        bodies = bodies.withColumn("undone", undo_transfer(F.when(_coded(), F.col("body")), F.col("coding")))
        payload = F.when(F.col("undone").isNotNull(), F.col("undone")).otherwise(F.col("body"))
    return bodies.select(
        *others,
        "warc_id",
        "url",
        "date",
        decode_payload(payload).alias("html_content"),
        _file_name(F.col("file")).alias("warc_filename"),
    )


def warc_ingest(spark: SparkSession, path: str, glob: str = "*.warc", version: str = VERSION_LINE) -> DataFrame:
    """Crawl records of all archives under ``path``, written to the shared folder once and read from there."""
    if reachable(path):
        return check_schema(_staged(spark, path, glob, version), CRAWL_RECORD)
    out = scratch_path(spark, "records")
    _scan(spark, path, out, glob, version)
    return check_schema(spark.read.schema(CRAWL_RECORD).parquet(out), CRAWL_RECORD)


def warc_to_parquet(spark: SparkSession, path: str, out: str, glob: str = "*.warc", version: str = VERSION_LINE) -> int:
    """Write the crawl records under ``path`` as zstd Parquet partitioned by archive; returns the rows.

    Rows are dealt by archive and size before the write, so an archive has few files of
    about the advisory partition size, however many tasks read it.
    """
    if reachable(path):
        _write(_staged(spark, path, glob, version).hint("rebalance", "warc_filename"), out, "overwrite")
    else:
        _scan(spark, path, out, glob, version)
    return spark.read.schema(CRAWL_RECORD).parquet(out).count()


def _staged(spark: SparkSession, path: str, glob: str, version: str, range_bytes: int | None = None) -> DataFrame:
    """Crawl records by the data source. Records that were completed over a separator are
    staged whatever they are, since what lies inside them is no record.

    Bodies are staged as they were sent, and only those that are coded are decoded and staged
    once more, so no task reads an archive in one Python process and decodes in another.
    """
    widths = {} if range_bytes is None else {"range_bytes": range_bytes}
    fragments = _with_head(read_archives(spark, path, glob, version, **widths))
    completed = F.col("stop").isNotNull()
    bodies = cut(_bodies(fragments, completed, ["start", "stop"]), "bodies")
    others = ["file", "start", "stop", "wanted"]
    staged = _contents(bodies.where(~_coded()), others, undo=False)
    coded = bodies.where(_coded())
    if not coded.isEmpty():
        staged = staged.unionByName(cut(_contents(coded, others), "decoded"))
    spans = staged.where(completed).select("file", "start", "stop")
    if not spans.isEmpty():
        staged = outer_records(staged, spans)
    return staged.where("wanted").select(*CRAWL_RECORD.fieldNames())


def _scan(spark: SparkSession, path: str, out: str, glob: str, version: str) -> None:
    """By text scan; one pass in the usual case: torn records are counted while the table is written.

    Only archives that hold one are read again, and their partitions replaced.
    Partitions go by file name, so all archives of a name are read again together.
    """
    fragments = read_fragments(spark, path, glob, version)
    seen = Observation("fragments")
    watched = fragments.observe(seen, F.count_if("torn").alias("torn"))
    _write(parse_records(watched), out, "overwrite")
    if seen.get["torn"]:
        named = fragments.withColumn("name", _file_name(F.col("file")))
        torn = cut(named.where("torn").select("name").distinct(), "torn_files")
        again = named.join(torn, "name", "left_semi").drop("name")
        _write(parse_records(sew(again, len(_separator(version)), version)), out, "overwrite", dynamic=True)


def _write(records: DataFrame, out: str, mode: str, dynamic: bool = False) -> None:
    (
        records.write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", 1_000_000)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("warc_filename")
        .parquet(out)
    )


def archive_lines(
    df: DataFrame, id_col: str, url_col: str, date_col: str, html_col: str,
    kind: Column | None = None, media: Column | None = None,
) -> DataFrame:
    """One record per page as a ``value`` string; write as text with ``EMPTY_LINE`` as ``lineSep``.

    ``kind`` is the record type (``response``), ``media`` the content type (UTF-8 HTML).
    """
    kind = F.lit("response") if kind is None else kind
    media = F.lit("text/html; charset=utf-8") if media is None else media
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), media, F.lit(EMPTY_LINE), F.col(html_col))
    return df.select(
        F.concat(
            F.lit(VERSION_LINE + CRLF + "WARC-Type: "),
            kind,
            F.lit("\r\nWARC-Record-ID: "),
            F.col(id_col),
            F.lit("\r\nWARC-Target-URI: "),
            F.col(url_col),
            F.lit("\r\nWARC-Date: "),
            F.col(date_col),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
            F.octet_length(body).cast("string"),
            F.lit(EMPTY_LINE),
            body,
        ).alias("value")
    )
