"""

Every query reads the given tables whole, or files that Spark writes from them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# Python workers of a session that starts after this import find the package from any folder.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import duck_sql
from textmill.functions.hosts import host_of
from textmill.operators import domains, exact, extract, language, minhash, neardup, runs, shingle, stats, tokens, tree
from textmill.plans import corpus
from textmill.schemas import CRAWL_RECORD, check_schema
from textmill.session import cut, scratch_path
from textmill.sources import blacklist as blacklists
from textmill.sources import eventlog, warc
from textmill.sources.tables import read_table, write_table

SMOKE_DIR = "/root/testdata/sf0.001"


# --- inputs --------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str, spread_by: str | None = None) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", spread_by=spread_by)


def _day(expression: str) -> Column:
    return F.expr(f"CAST(date_add(DATE '2020-01-01', {expression}) AS STRING)")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents", "doc_id")


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").withColumn("date", _day(duck_sql.DOC_DAY))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages", "page_id")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as crawl records keyed by a zero-padded page id, so that text order is id order."""
    return _pages(spark, sf).select(
        F.lpad(F.col("page_id").cast("string"), 19, "0").alias("warc_id"),
        "url",
        _day(duck_sql.PAGE_DAY).alias("date"),
        F.col("html").alias("html_content"),
        F.lit("pages").alias("warc_filename"),
    )


def _blog_parents(spark: SparkSession, sf: str) -> DataFrame:
    """The blacklist of the checks: parent domains of blog hosts."""
    hosts = _table(spark, sf, "pages").select(host_of(F.col("url")).alias("host")).where("host LIKE 'blog.%'")
    labels = F.split("host", r"\.")
    return hosts.select(F.array_join(F.slice(labels, F.lit(2), F.size(labels)), ".").alias("domain")).distinct()


def _raw_list_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Blacklist lines with blanks, capitals, copies and comments, written out of the hosts of all pages."""
    host = host_of(F.col("url"))
    return _table(spark, sf, "pages").select(
        F.explode(
            F.array(host, F.concat(F.lit("  "), F.upper(host), F.lit(" ")), F.concat(F.lit("# "), host), F.lit(""))
        ).alias("value")
    )


def _run_table(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in duck_sql.RUN_EXPRESSIONS.items()])


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_enrich(_run_table(spark, sf), runs.data_sizes(spark))


def _completed(spark: SparkSession, sf: str) -> DataFrame:
    return runs.completed(_enriched(spark, sf))


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- sources and sinks ---------------------------------------------------------------------------


def warc_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of every page as UTF-8 and as latin-1, with requests and images that the filters must drop."""
    path = scratch_path(spark, "archives")
    html = F.col("html")
    latin = F.encode(F.concat(F.regexp_replace(html, r"[^\x00-\xff]", "?"), F.lit("é")), "ISO-8859-1").cast("string")
    kinds = [
        ("page", "response", "text/html; charset=utf-8", html),
        ("latin", "response", "Text/HTML", latin),
        ("request", "request", "text/html", html),
        ("image", "response", "image/gif", html),
    ]
    variants = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.lit(m).alias("media"), body.alias("body"))
            for n, k, m, body in kinds
        ]
    )
    pages = _table(spark, sf, "pages").select(
        "page_id", "url", _day(duck_sql.PAGE_DAY).alias("date"), F.explode(variants).alias("v")
    ).select(
        F.concat(F.lit("<urn:"), "v.name", F.lit(":"), "page_id", F.lit(">")).alias("id"),
        "url", "date", "v.kind", "v.media", "v.body",
    )
    lines = warc.archive_lines(pages, "id", "url", "date", "body", F.col("kind"), F.col("media"))
    lines.write.option("lineSep", warc.EMPTY_LINE).text(path)
    records = warc.warc_ingest(spark, path, glob="*.txt")
    return records.select(
        "warc_id",
        "url",
        "date",
        F.md5("html_content").alias("html_md5"),
        F.octet_length("html_content").alias("html_bytes"),
    )


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "records")
    write_table(check_schema(_records(spark, sf), CRAWL_RECORD), path, partition_by="warc_filename")
    back = read_table(spark, path, ["warc_id", "url", "date", "html_content"], CRAWL_RECORD)
    return back.select(
        F.col("warc_id").cast("bigint").alias("page_id"), "url", "date", F.md5("html_content").alias("html_md5")
    )


def blacklist_load(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lists")
    lines = _raw_list_lines(spark, sf)
    lines.write.text(f"{root}/adult/domains")
    lines.select(F.upper("value").alias("value")).write.text(f"{root}/mixed/deep/urls")
    lines.select(F.concat(F.lit("x."), "value").alias("value")).write.text(f"{root}/mixed/notes")
    return blacklists.blacklist_load(spark, root)


def blacklist_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return domains.blacklist_normalise(_raw_list_lines(spark, sf))


def eventlog_metrics(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "eventlogs")
    m = duck_sql.TASK_METRICS
    orders = _table(spark, sf, "orders").withColumn("app", F.expr(duck_sql.APP_NAME))
    task = F.to_json(
        F.expr(
            f"""named_struct('Event', 'SparkListenerTaskEnd', 'Task Metrics', named_struct(
              'Executor Run Time', {m['run']}, 'JVM GC Time', {m['gc']},
              'Memory Bytes Spilled', {m['mem']}, 'Disk Bytes Spilled', {m['disk']},
              'Shuffle Read Metrics', named_struct('Fetch Wait Time', {m['fetch']}),
              'Shuffle Write Metrics', named_struct('Shuffle Write Time', {m['write_ns']})))"""
        )
    )
    heap = F.to_json(
        F.expr(
            f"""named_struct('Event', 'SparkListenerExecutorMetricsUpdate', 'Executor ID', string(o_custkey % 10),
              'Executor Metrics Updated', array(named_struct('Executor Metrics', named_struct('JVMHeapMemory', {m['heap']}))))"""
        )
    )
    lines = orders.select("app", F.explode(F.array(task, heap)).alias("value"))
    span = orders.groupBy("app").agg(F.sum("o_custkey").alias("total"))
    start = F.to_json(F.expr("named_struct('Event', 'SparkListenerApplicationStart', 'Timestamp', 1700000000000L)"))
    end = F.to_json(F.expr("named_struct('Event', 'SparkListenerApplicationEnd', 'Timestamp', 1700000000000L + total)"))
    bounds = span.select("app", F.explode(F.array(start, end, F.lit('{"Event": "cut'))).alias("value"))
    lines.unionByName(bounds).write.partitionBy("app").text(path)
    metrics = eventlog.eventlog_metrics(eventlog.read_event_logs(spark, path))
    exact_columns = {"app", "total_time_ms", "executor_run_time_ms", "gc_time_ms", "shuffle_read_ms"}
    return _rounded(metrics, 6, *[c for c in metrics.columns if c not in exact_columns])


def runlog_scrape(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runlogs")
    steps = runs.STAGE_COLUMNS[:-1]
    sums = (
        _table(spark, sf, "orders")
        .groupBy(F.expr(duck_sql.APP_NAME).alias("app"))
        .agg(
            F.sum("o_custkey").alias("total"),
            *[F.sum(F.col("o_custkey") % (7 + i)).alias(s) for i, s in enumerate(steps)],
        )
    )
    log = F.concat_ws(
        "\n",
        F.lit("submitted application_1600000000000_7"),
        F.concat(F.lit("tracking "), F.col("app"), F.lit(" accepted")),
        *[F.concat(F.lit(f">>> Step {s[1:]} completed in "), F.col(s), F.lit(".500000 seconds")) for s in steps],
        F.concat(F.lit("Total execution time: "), F.col("total"), F.lit(".500000 seconds")),
    )
    sums.select(F.col("app").alias("log"), log.alias("value")).write.partitionBy("log").text(path)
    return eventlog.runlog_scrape(spark, path).drop("file")


def run_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    table = _run_table(spark, sf)
    runs.append_runs(table.where("Type = 'Strong'"), path)
    runs.append_runs(table.where("Type <> 'Strong'"), path)
    return runs.read_runs(spark, path).select(
        "Type", "Execs", "Cores", "Data", "AppID", "AppTimeMs", "Parallelism", "PeakHeapMB", "Run"
    )


# --- pages ---------------------------------------------------------------------------------------


def host_extract(spark: SparkSession, sf: str) -> DataFrame:
    return domains.host_extract(_table(spark, sf, "pages"), "url").select("page_id", "host")


def domain_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return domains.domain_suffixes(_table(spark, sf, "pages"), "page_id", "url")


def domain_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return domains.domain_filter(pages, _blog_parents(spark, sf))


def domain_filter_bloom(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by a Bloom filter, the list grown by an unseen domain for every order."""
    pages = _table(spark, sf, "pages").select("page_id", "url")
    made = _table(spark, sf, "orders").select(F.concat(F.lit("shop"), "o_orderkey", F.lit(".example.net")).alias("domain"))
    return domains.bloom_domain_filter(pages, _blog_parents(spark, sf).unionByName(made))


def url_prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    entries = pages.where("url LIKE '%/fr/%' OR url LIKE '%/de/%'").select(
        F.lower(F.regexp_extract("url", "https?://([^/:]+/[^/?#]+)", 1)).alias("domain")
    )
    return domains.url_prefix_filter(pages, entries.distinct())


def html_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as it is, and once more inside a form that is never closed, where only the fallback finds text."""
    variants = F.array(
        F.struct(F.lit(False).alias("in_form"), F.col("html")),
        F.struct(F.lit(True).alias("in_form"), F.concat(F.lit("<form>"), F.col("html")).alias("html")),
    )
    pages = _pages(spark, sf).select("page_id", F.explode(variants).alias("v")).select("page_id", "v.in_form", "v.html")
    return extract.html_extract(pages, "html", "text")


def html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """The heaviest block of every page, as it is and behind mis-nested and unclosed tags."""
    torn = F.concat(F.lit("</i></div><nav><b><div>"), F.regexp_replace("html", "</p>", "</p></b><p>"))
    variants = F.array(
        F.struct(F.lit(False).alias("torn"), F.col("html")), F.struct(F.lit(True).alias("torn"), torn.alias("html"))
    )
    pages = _table(spark, sf, "pages").select("page_id", F.explode(variants).alias("v")).select("page_id", "v.torn", "v.html")
    return tree.main_text(pages, "html", "text")


def boilerplate_filter(spark: SparkSession, sf: str) -> DataFrame:
    texts = cut(extract.html_extract(_pages(spark, sf), "html", "text"), "texts")
    hosted = texts.withColumn("host", host_of(F.col("url")))
    return extract.boilerplate_filter(hosted, "page_id", "host", "text", min_pages=2).select("page_id", "text")


# --- language ------------------------------------------------------------------------------------


def language_model(spark: SparkSession, sf: str) -> language.LanguageModel:
    return language.lang_model(lang_profile(spark, sf))


def lang_profile(spark: SparkSession, sf: str) -> DataFrame:
    return language.lang_profile(_documents(spark, sf), "text")


def lang_score(spark: SparkSession, sf: str) -> DataFrame:
    return language.lang_score(_documents(spark, sf), "doc_id", "text", language_model(spark, sf))


def filter_languages(spark: SparkSession, sf: str, model: language.LanguageModel) -> DataFrame:
    return language.lang_filter(_documents(spark, sf), "text", model).select("doc_id", "source")


def lang_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_languages(spark, sf, language_model(spark, sf))


# --- duplicates ----------------------------------------------------------------------------------


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = exact.exact_dedup(_dated(spark, sf), "text", ["date", "doc_id"])
    return kept.select("doc_id", "date", F.md5("text").alias("fingerprint"))


def shingles(spark: SparkSession, sf: str) -> DataFrame:
    return shingle.shingle_profile(_documents(spark, sf), "doc_id", "text")


def shingles_char(spark: SparkSession, sf: str) -> DataFrame:
    return shingle.shingle_profile(_documents(spark, sf), "doc_id", "text", unit="char")


def minhash_signature(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.minhash_signature(_documents(spark, sf), "doc_id", "text")


def minhash_signature_char(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.minhash_signature(_documents(spark, sf), "doc_id", "text", unit="char")


def minhash_candidates(spark: SparkSession, sf: str) -> DataFrame:
    signatures = minhash.minhash_signature(_documents(spark, sf), "doc_id", "text")
    return minhash.minhash_candidates(minhash.band_table(signatures, ["doc_id"]), "doc_id")


def _found(spark: SparkSession, sf: str, cfg: neardup.NearDupConfig = neardup.NearDupConfig()):
    return neardup.near_duplicates(_documents(spark, sf), "doc_id", "text", cfg)


def minhash_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The losing side of all similar pairs."""
    return neardup.pair_losers(_found(spark, sf)).withColumnRenamed("id", "doc_id")


def minhash_pairs_char(spark: SparkSession, sf: str) -> DataFrame:
    cfg = neardup.NearDupConfig(unit="char")
    return neardup.pair_losers(_found(spark, sf, cfg)).withColumnRenamed("id", "doc_id")


def minhash_pairs_any(spark: SparkSession, sf: str) -> DataFrame:
    """One hash per band: any of the 24 minima in common makes a candidate."""
    cfg = neardup.NearDupConfig(bands=24, rows=1)
    return neardup.pair_losers(_found(spark, sf, cfg)).withColumnRenamed("id", "doc_id")


def dup_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.dup_clusters(_found(spark, sf)).withColumnRenamed("id", "doc_id")


def near_dup_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "source")
    return neardup.near_dup_filter(docs, "doc_id", _found(spark, sf))


def near_dup_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "source")
    return neardup.near_dup_filter(docs, "doc_id", _found(spark, sf), keep="pairwise")


def dedup_compare(spark: SparkSession, sf: str) -> DataFrame:
    near = near_dup_filter(spark, sf)
    kept = exact.exact_dedup(_dated(spark, sf), "text", ["date", "doc_id"])
    return exact.dedup_compare(near, kept, "doc_id")


# --- tokens --------------------------------------------------------------------------------------


def word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.word_tokens(_documents(spark, sf), "doc_id", "text")


def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = tokens.token_ids(_documents(spark, sf), "doc_id", "text")
    token = F.col("token").cast("bigint")
    return ids.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"), F.sum(token).alias("token_sum"), F.sum(token * F.col("pos")).alias("token_order")
    )


def _flat(sequences: DataFrame, id_col: str) -> DataFrame:
    """Arrays as strings, which every checker compares alike."""
    return sequences.select(
        id_col, F.array_join("tokens", " ").alias("tokens"), F.array_join("attention_mask", " ").alias("attention_mask")
    )


def tokenize_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(tokens.tokenize_fixed(_documents(spark, sf), "doc_id", "text"), "doc_id")


def token_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_stats(tokens.tokenize_fixed(_documents(spark, sf), "doc_id", "text"), "doc_id")


# --- the whole job -------------------------------------------------------------------------------


def _english(spark: SparkSession, sf: str):
    return corpus.extract_english(_records(spark, sf), _blog_parents(spark, sf), language_model(spark, sf))


def _by_page(sequences: DataFrame) -> DataFrame:
    return _flat(sequences, "warc_id").select(
        F.col("warc_id").cast("bigint").alias("page_id"), "tokens", "attention_mask"
    )


def stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job with both tails, counted step by step."""
    job = corpus.prepare_corpus(_records(spark, sf), _blog_parents(spark, sf), language_model(spark, sf))
    return job.funnel()


def corpus_md5(spark: SparkSession, sf: str) -> DataFrame:
    english = _english(spark, sf)[2]
    return _by_page(tokens.tokenize_fixed(corpus.drop_exact(english)))


def corpus_lsh(spark: SparkSession, sf: str) -> DataFrame:
    english = _english(spark, sf)[2]
    return _by_page(tokens.tokenize_fixed(corpus.drop_near(english)))


# --- run analytics -------------------------------------------------------------------------------


def run_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf)


def run_status(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_status(_run_table(spark, sf)).groupBy("Type", "status").agg(F.count("*").alias("n"))


def run_dedup(spark: SparkSession, sf: str) -> DataFrame:
    items = _table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return runs.run_dedup(items, ["l_orderkey"])


def stack(spark: SparkSession, sf: str) -> DataFrame:
    kinds = _run_table(spark, sf).groupBy(F.lit("runs").alias("origin"), F.col("Type").alias("label"))
    events = _table(spark, sf, "events").groupBy(F.lit("events").alias("origin"), F.col("event_type").alias("label"))
    return stats.stack([kinds.agg(F.count("*").alias("n")), events.agg(F.count("*").alias("n"))])


def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_keys(_table(spark, sf, "lineitem"), "l_linenumber")


def grouped_mean(spark: SparkSession, sf: str) -> DataFrame:
    return stats.grouped_mean(
        _completed(spark, sf),
        ["Type", "Execs", "Cores", "TotalCores", "MemGB"],
        ["AppTimeSec", "MemSpillGB", "DiskSpillGB", "PeakHeapGB"],
        6,
    )


def mean_std_by_group(spark: SparkSession, sf: str) -> DataFrame:
    study = _completed(spark, sf).where("Type = 'MemoryStudy'")
    return stats.mean_std_by_group(study, ["MemGB"], ["AppTimeSec", "GCRatio", "MemSpillMB"], 6)


def quantiles_by_group(spark: SparkSession, sf: str) -> DataFrame:
    table = stats.quantiles_by_group(_enriched(spark, sf), ["Type"], "PeakHeapGB")
    return _rounded(table, 6, "min", "q1", "median", "q3", "max")


def quantiles_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles off sketches of four appended batches, and whether each one's true rank is within 1 % of the wanted one."""
    group, probs = ["o_orderpriority"], {"q1": 0.25, "median": 0.5, "q3": 0.75}
    orders = _table(spark, sf, "orders").select(*group, "o_orderkey", "o_totalprice")
    batches = stats.quantile_sketches(orders.withColumn("batch", F.col("o_orderkey") % 4), [*group, "batch"], "o_totalprice")
    merged = stats.merge_sketches(cut(batches, "sketches"), group)
    found = cut(stats.sketch_quantiles(merged, group, probs), "quantiles")
    price = F.col("o_totalprice").cast("double")
    ranks = [F.sum((price < F.col(q)).cast("int")) / F.count("*") <= p + 0.01 for q, p in probs.items()]
    ranks += [F.sum((price <= F.col(q)).cast("int")) / F.count("*") >= p - 0.01 for q, p in probs.items()]
    inside = orders.join(found, group).groupBy(*group, "n").agg(*[r.alias(f"r{i}") for i, r in enumerate(ranks)])
    return inside.select(*group, "n", *[(F.col(f"r{i}") & F.col(f"r{i + 3}")).alias(f"{q}_within") for i, q in enumerate(probs)])


def best_row_by_group(spark: SparkSession, sf: str) -> DataFrame:
    best = stats.best_row_by_group(_run_table(spark, sf), ["Type", "Cores"], "AppTimeMs", ["AppID"])
    return best.select("Type", "Cores", "AppTimeMs", "AppID", "Execs", "PeakHeapMB")


def baseline_ratio(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return stats.baseline_ratio(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").drop("o_orderdate")


def strong_scaling(spark: SparkSession, sf: str) -> DataFrame:
    return runs.strong_scaling(_completed(spark, sf))


def weak_scaling(spark: SparkSession, sf: str) -> DataFrame:
    table = runs.weak_scaling(_completed(spark, sf).where("Type = 'Weak'"), metrics=["TimePerUnit"])
    return _rounded(table, 6, "AppTimeSec", "TimePerUnit", "Efficiency")


def ratio_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return runs.ratio_breakdown(_completed(spark, sf).where("Type = 'Strong'"), ["TotalCores"])


def stage_time_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return runs.stage_time_by_group(_completed(spark, sf).where("Type = 'Strong'"), ["TotalCores"])


def memory_profile(spark: SparkSession, sf: str) -> DataFrame:
    return runs.memory_profile(_completed(spark, sf))


def utilisation(spark: SparkSession, sf: str) -> DataFrame:
    return runs.utilisation(_completed(spark, sf))


def best_configurations(spark: SparkSession, sf: str) -> DataFrame:
    return runs.best_configurations(_completed(spark, sf))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_summary(_completed(spark, sf))


def shuffle_profile(spark: SparkSession, sf: str) -> DataFrame:
    table = runs.shuffle_profile(_completed(spark, sf).where("Type = 'Weak'"))
    return _rounded(table, 6, *[c for c in table.columns if c not in runs.CONFIGURATION])


def best_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.best_runs(_completed(spark, sf))


def report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Every report table read back from its CSV, as rows of ``report, key, metric, value``."""
    path = scratch_path(spark, "reports")
    tables = runs.report_tables(cut(_enriched(spark, sf), "enriched"))
    runs.write_reports(tables, path)
    keys = {"Experiment", "Configuration", "Scenario", *runs.CONFIGURATION}
    parts = []
    for name, table in tables.items():
        back = spark.read.schema(table.schema).option("header", True).csv(f"{path}/{name}")
        metrics = F.array(
            *[F.struct(F.lit(c).alias("metric"), F.round(F.col(c).cast("double"), 6).alias("value"))
              for c in back.columns if c not in keys]
        )
        key = F.concat_ws("|", *[F.col(c) for c in back.columns if c in keys])
        rows = back.select(F.lit(name).alias("report"), key.alias("key"), F.explode(metrics).alias("m"))
        parts.append(rows.select("report", "key", "m.metric", "m.value").where("value IS NOT NULL"))
    return stats.stack(parts)


# --- contract ------------------------------------------------------------------------------------


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    warc_ingest, parquet_roundtrip, blacklist_load, blacklist_normalise, host_extract, domain_suffixes, domain_filter, domain_filter_bloom,
    url_prefix_filter, html_extract, html_main_text, boilerplate_filter, lang_profile, lang_score, lang_filter, exact_dedup, shingles,
    shingles_char, minhash_signature, minhash_signature_char, minhash_candidates, minhash_pairs, minhash_pairs_char,
    minhash_pairs_any, dup_clusters, near_dup_filter, near_dup_pairwise, dedup_compare, word_tokens, token_ids, tokenize_fixed, token_stats,
    stage_funnel, corpus_md5, corpus_lsh, eventlog_metrics, runlog_scrape, run_append, run_enrich, run_status,
    run_dedup, stack, distinct_keys, grouped_mean, mean_std_by_group, quantiles_by_group, quantiles_sketched, best_row_by_group,
    baseline_ratio, strong_scaling, weak_scaling, ratio_breakdown, stage_time_by_group, memory_profile, utilisation,
    best_configurations, run_summary, shuffle_profile, best_runs, report_sink,
]


def entry(spark: SparkSession) -> DataFrame:
    """The whole job with exact deduplication on the smoke tables."""
    return corpus_md5(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline; none where those are not installed."""
    try:
        import corpus_pipeline
        from textmill.llm import queries as llm
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "textmill.llm"):
            raise
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**{q.__name__: q for q in llm.QUERIES}, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{q.__name__: q for q in QUERIES}, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**duck_sql.statements(), **_training_data()[1]}
