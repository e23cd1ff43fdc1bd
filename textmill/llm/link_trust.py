"""URL filter: listed rules first, then trust and distrust passed along host links.

Hosts are the nodes. A page's absolute links are edges of its host, weighted by
their number; a host and the domain one label up are linked both ways with weight
``kin``. Personalised PageRank starts from hosts whose pages a rule allows and
follows the links; its reverse starts from hosts whose pages a rule blocks and
goes against them, since a host that links to bad ones is suspect. A host is
blocked where distrust exceeds trust by more than ``margin`` times their sum, so
that scores which shrink as hosts are added keep every verdict; one that neither
reaches gets ``default``.

Every round is one join and one aggregate over host pairs; every few rounds are written to
the shared folder, and the table before is dropped. Rounds go on until none raises any host's score by more than ``tolerance``
of it, so a host counts however far from the seeds and however small its score; a
given number of ``rounds`` stops there instead. While the links of all paths of a
length are few (``matrix_rows``), a job costs more than its rows, so the length is
doubled by joining these links with themselves, and a round then goes that far at
once; the scores are the same. Rules are a short list held in the
plan; the graph and its scores stay in tables.

Defined results: a null URL, or one without ``://``, has an empty host and path
and so the default verdict unless a rule fits. Pages that repeat count again as
seeds and links. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh
from textmill.session import cut, discard, scratch_path

#: (verdict, host/path)
Rule = tuple[str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
DAMPING = 0.85
#: A given number of rounds that is enough where seeds are near.
ROUNDS = 8
#: Rounds between two tables.
ROUNDS_A_TABLE = 10
TOLERANCE = 1e-9
#: Rows of a join of links with links up to which paths are doubled.
MATRIX_ROWS = 1 << 20
KIN = 1.0
#: Above what the tolerance leaves open: a share of ``TOLERANCE / (1 - DAMPING)`` of a score.
MARGIN = 1e-7
#: Rounds of the SQL: what is left after them is below the tolerance for hosts up to 250 links from a seed.
SQL_ROUNDS = 400

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)\b(?:href|src)\s{0,8}=\s{0,8}["']?(?:https?:)?//([^/?#"'\s<>]+)"""


def fold(host: Column) -> Column:
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def url_host(url: Column) -> Column:
    return fold(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    at, slash, rest = rule.partition("/")
    return ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        found = F.when(_fits(rule, host, path), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str, html_col: str, kin: float = KIN) -> DataFrame:
    """``(src, dst, w)``: one row per pair of different hosts."""
    linked = pages.select(
        url_host(col(url_col)).alias("src"), F.explode(F.regexp_extract_all(col(html_col), F.lit(LINK), 1)).alias("dst")
    ).select("src", fold(F.col("dst")).alias("dst"), F.lit(1.0).alias("w"))
    hosts = pages.select(url_host(col(url_col)).alias("src")).distinct()
    # One row per ancestor domain of at least two labels, so that the chain is whole.
    labels = F.split("src", r"\.")
    above = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2))
    chain = hosts.select(labels.alias("parts"), F.explode(above).alias("k")).select(
        F.array_join(F.expr("slice(parts, k, size(parts))"), ".").alias("child"),
        F.array_join(F.expr("slice(parts, k + 1, size(parts))"), ".").alias("parent"),
    ).distinct()
    up = chain.select(F.col("child").alias("src"), F.col("parent").alias("dst"), F.lit(kin).alias("w"))
    down = chain.select(F.col("parent").alias("src"), F.col("child").alias("dst"), F.lit(kin).alias("w"))
    edges = linked.unionByName(up).unionByName(down).where("src <> '' AND dst <> '' AND src <> dst AND w > 0")
    return edges.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(
    edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE,
    matrix_rows: int = MATRIX_ROWS,
) -> DataFrame:
    """``(host, kind, score)`` from seeds of the same form, converged or after ``rounds`` rounds.

    Kind 0 follows the links, each host's score shared by the weight of what it
    links to; kind 1 goes against them, shared by the weight of what links to it.
    """
    out = edges.groupBy("src").agg(F.sum("w").alias("all"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("all"))
    ahead = edges.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(0).alias("kind"), (F.col("w") / F.col("all") * damping).alias("p"))
    back = edges.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(1).alias("kind"), (F.col("w") / F.col("all") * damping).alias("p"))
    passes = cut(ahead.unionByName(back), "passes")
    start = seeds.select("host", "kind", (F.col("score") * (1 - damping)).alias("score"))
    if rounds is None:
        passes, start, length = _longer_passes(passes, start, damping, tolerance, matrix_rows)
        return _converged(passes, start, tolerance, length)
    state = seeds
    for _ in range(rounds):
        moved = passes.join(state, ["host", "kind"]).select(F.col("to").alias("host"), "kind", (F.col("p") * F.col("score")).alias("score"))
        state = cut(moved.unionByName(start).groupBy("host", "kind").agg(F.sum("score").alias("score")), "scores")
    return state


def _longer_passes(
    passes: DataFrame, start: DataFrame, damping: float, tolerance: float, matrix_rows: int
) -> tuple[DataFrame, DataFrame, int]:
    """``(passes, start, length)``: what paths of ``length`` links pass on, and what all shorter ones brought.

    ``length`` doubles until what is left beyond it is below the tolerance, or until the
    join that doubles it would make more than ``matrix_rows`` rows.
    """
    spark = passes.sparkSession
    schema = "host STRING, to STRING, kind INT, p DOUBLE, seed BOOLEAN"
    seeds = start.select(F.lit("").alias("host"), F.col("host").alias("to"), "kind", F.col("score").alias("p"), F.lit(True).alias("seed"))
    table, last, length = passes.withColumn("seed", F.lit(False)).unionByName(seeds), None, 1
    while damping**length > tolerance:
        into = table.groupBy("kind", "to").agg(F.count("*").alias("n_in"))
        out = table.where("NOT seed").groupBy("kind", F.col("host").alias("to")).agg(F.count("*").alias("n_out"))
        made = into.join(out, ["kind", "to"]).agg(F.sum(F.col("n_in") * F.col("n_out"))).first()[0] or 0
        if made > matrix_rows:
            break
        onward = table.where("NOT seed").select(F.col("host").alias("to"), "kind", F.col("to").alias("next"), F.col("p").alias("q"))
        longer = table.join(onward, ["to", "kind"]).select("host", F.col("next").alias("to"), "kind", (F.col("p") * F.col("q")).alias("p"), "seed")
        path = scratch_path(spark, "longer")
        longer.unionByName(table.where("seed")).groupBy("host", "to", "kind", "seed").agg(F.sum("p").alias("p")).select(
            "host", "to", "kind", "p", "seed"
        ).write.parquet(path)
        if last is not None:
            discard(spark, last)
        table, last, length = spark.read.schema(schema).parquet(path), path, length * 2
    brought = table.where("seed").select(F.col("to").alias("host"), "kind", F.col("p").alias("score"))
    return table.where("NOT seed").drop("seed"), brought, length


def _converged(passes: DataFrame, start: DataFrame, tolerance: float, length: int = 1) -> DataFrame:
    """The sum over all path lengths of what ``start`` passes on.

    ``term`` is what the last round brought to a host. All terms together shrink by
    the damping every round, while a host's score only grows, so the rounds end. Every
    host keeps its score by an edge to itself, so a round is a single join.
    """
    spark = passes.sparkSession
    known = passes.select("host", "kind").union(passes.select("to", "kind")).union(start.select("host", "kind")).distinct()
    keeps = known.select("host", "kind", F.col("host").alias("to"), F.lit(0.0).alias("p"), F.lit(True).alias("keep"))
    flows = cut(passes.withColumn("keep", F.lit(False)).unionByName(keeps), "flows")
    state, change, last = start.withColumn("term", F.col("score")), 1.0, None
    brought = F.when(F.col("keep"), 0.0).otherwise(F.col("p") * F.col("term"))
    while change > tolerance:
        for _ in range(max(1, ROUNDS_A_TABLE // length)):
            moved = flows.join(state, ["host", "kind"]).where("keep OR term > 0").select(
                F.col("to").alias("host"), "kind", brought.alias("term"), F.when(F.col("keep"), F.col("score")).otherwise(brought).alias("score")
            )
            state = moved.groupBy("host", "kind").agg(F.sum("term").alias("term"), F.sum("score").alias("score"))
        seen, path = Observation("terms"), scratch_path(spark, "scores")
        share = F.max(F.when(F.col("score") > 0, F.col("term") / F.col("score")))
        state.observe(seen, share.alias("share")).write.parquet(path)
        change = seen.get["share"] or 0.0
        if last is not None:
            discard(spark, last)
        state, last = spark.read.schema("host STRING, kind INT, term DOUBLE, score DOUBLE").parquet(path), path
    return state.where("score > 0").select("host", "kind", "score")


def seed_hosts(ruled: DataFrame) -> DataFrame:
    """``(host, kind, score)``: each host's share of the allowed (0) and of the blocked (1) pages."""
    kind = F.when(F.col("verdict") == "allow", 0).when(F.col("verdict") == "block", 1)
    counts = cut(ruled.select("host", kind.alias("kind")).where("kind IS NOT NULL AND host <> ''").groupBy("host", "kind").agg(F.count("*").alias("n")), "seeds")
    totals = counts.groupBy("kind").agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(totals), "kind").select("host", "kind", (F.col("n") / F.col("all")).alias("score"))


def url_filter(
    pages: DataFrame, rules: Sequence[Rule] = RULES, url_col: str = "url", html_col: str = "html", rounds: int | None = None,
    damping: float = DAMPING, kin: float = KIN, margin: float = MARGIN, default: str = "allow", tolerance: float = TOLERANCE,
) -> DataFrame:
    """``pages`` without their HTML, with ``host, path, rule, verdict, trust, distrust``.

    ``trust`` and ``distrust`` are the host's scores, 0 where nothing reaches it."""
    results = ["host", "path", "rule", "verdict", "trust", "distrust"]
    extra = [c for c in pages.columns if c.lower() not in results and c != html_col]
    judged, row_host = fresh(pages, "judged", "row_host")
    url = col(url_col)
    parted = pages.select(url_host(url).alias("host"), url_path(url).alias("path"))
    ruled = parted.select("host", rule_of(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
    edges = cut(host_links(pages, url_col, html_col, kin), "links")
    scores = propagate(edges, cut(seed_hosts(ruled), "shares"), rounds, damping, tolerance)
    by_host = cut(
        scores.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == 0, F.col("score"))).alias("trust"),
            F.sum(F.when(F.col("kind") == 1, F.col("score"))).alias("distrust"),
        ).withColumnRenamed("host", row_host),
        "trust",
    )
    rows = pages.select(*[col(c) for c in extra], url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn(judged, rule_of(F.col("host"), F.col("path"), rules))
    trust, distrust = F.coalesce(F.col("trust"), F.lit(0.0)), F.coalesce(F.col("distrust"), F.lit(0.0))
    method = F.when(distrust - trust > (distrust + trust) * margin, "block").when((trust == 0) & (distrust == 0), default).otherwise("allow")
    return rows.join(by_host, F.col("host") == F.col(row_host), "left").select(
        *[col(c) for c in extra], "host", "path", F.col(judged)["rule"].alias("rule"),
        F.coalesce(F.col(judged)["verdict"], method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
    )


def _rules_sql(field: int) -> str:
    longest = sorted(RULES, key=lambda r: -len(r[1]))
    cases = []
    for rule in longest:
        at, slash, rest = rule[1].partition("/")
        cases.append(f"WHEN (host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{slash + rest}') THEN '{rule[field]}'")
    return f"CASE {' '.join(cases)} END"


SQL = f"""
WITH RECURSIVE cutoff AS (SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{ascii_uppercase}', '{ascii_lowercase}') AS host,
             regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM cutoff),
r AS (SELECT *, {_rules_sql(1)} AS rule, {_rules_sql(0)} AS said FROM u),
counts AS (SELECT host, CASE said WHEN 'allow' THEN 0 ELSE 1 END AS kind, count(*) AS n FROM r WHERE said IS NOT NULL AND host <> '' GROUP BY ALL),
seeds AS (SELECT *, sum(n) OVER (PARTITION BY kind) AS all_n FROM counts),
hrefs AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)\\b(?:href|src)\\s{{0,8}}=\\s{{0,8}}["'']?(?:https?:)?//([^/?#"''\\s<>]+)', 1)), '{ascii_uppercase}', '{ascii_lowercase}') AS dst FROM u),
parts AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM u),
steps AS (SELECT l, unnest(range(1, len(l) - 1)) AS k FROM parts WHERE len(l) > 2),
chain AS (SELECT DISTINCT array_to_string(l[k:], '.') AS child, array_to_string(l[k + 1:], '.') AS parent FROM steps),
raw AS (SELECT src, dst, 1.0 AS w FROM hrefs UNION ALL SELECT child, parent, {KIN} FROM chain UNION ALL SELECT parent, child, {KIN} FROM chain),
edges AS (SELECT src, dst, CAST(sum(w) AS DOUBLE) AS w FROM raw WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
passes AS (SELECT src, dst, 0 AS kind, w / sum(w) OVER (PARTITION BY src) AS p FROM edges
           UNION ALL SELECT dst, src, 1, w / sum(w) OVER (PARTITION BY dst) FROM edges),
-- What every path length brings to a host.
terms AS (
  SELECT 0 AS round, host, kind, {1 - DAMPING} * n / all_n AS term FROM seeds UNION ALL
  SELECT round + 1, p.dst, p.kind, sum(p.p * {DAMPING} * t.term) FROM terms t JOIN passes p ON p.src = t.host AND p.kind = t.kind
  WHERE round < {SQL_ROUNDS} GROUP BY ALL),
t AS (SELECT host, coalesce(sum(term) FILTER (kind = 0), 0) AS trust, coalesce(sum(term) FILTER (kind = 1), 0) AS distrust FROM terms GROUP BY host)
SELECT page_id, r.host, path, rule, coalesce(said, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0)
    > {MARGIN} * (coalesce(distrust, 0) + coalesce(trust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN t ON r.host = t.host
"""
