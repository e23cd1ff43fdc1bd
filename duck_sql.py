"""DuckDB statements that check the registered queries, built from shared parts.

Constants come from the package; the logic is stated here independently in SQL.
"""

from __future__ import annotations

from html.entities import name2codepoint

from textmill.functions import markup
from textmill.functions.grams import MERSENNE31, gram_multipliers
from textmill.operators import language as lang
from textmill.operators import tree
from textmill.operators.extract import VISIBLE_PATTERN
from textmill.operators.minhash import BANDS, ROWS, THRESHOLD, hash_coefficients
from textmill.operators.runs import DATA_SIZES, STAGE_COLUMNS
from textmill.operators.tokens import MAX_LENGTH, VOCAB_SIZE, WORD_PATTERN

# --- expressions valid in Spark SQL and DuckDB alike -------------------------------------------

# A page or document has no date: one is derived from its key.
DOC_DAY = "CAST((doc_id * 7919) % 1000 AS INT)"
PAGE_DAY = "CAST((page_id * 7919) % 1000 AS INT)"

# A run table derived from line items, one run per row.
RUN_EXPRESSIONS = {
    "Type": "CASE l_returnflag WHEN 'R' THEN 'Strong' WHEN 'N' THEN 'Weak' ELSE 'MemoryStudy' END",
    "Execs": "l_linenumber",
    "Cores": "CASE l_linestatus WHEN 'O' THEN 2 ELSE 4 END",
    "TotalCores": "l_linenumber * CASE l_linestatus WHEN 'O' THEN 2 ELSE 4 END",
    "MemGB": "CAST(4 + 2 * (l_suppkey % 4) AS INT)",
    "Data": "concat('small_', CASE l_suppkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '4'"
    " WHEN 3 THEN '6' WHEN 4 THEN '8' ELSE '16' END)",
    "AppID": "concat('application_1700000000000_', l_orderkey, '_', l_partkey, '_', l_linenumber)",
    **{s: f"l_quantity * {i + 2} + l_linenumber" for i, s in enumerate(STAGE_COLUMNS)},
    "TotalTime": "CASE WHEN l_quantity > 48 THEN 0 ELSE l_quantity * 45 END",
    "AppTimeMs": "CAST(floor(l_extendedprice * 10) AS BIGINT) + 1",
    "ExecRunTimeMs": "CAST(floor(l_extendedprice * 35) AS BIGINT) + 7",
    "Parallelism": "(floor(l_extendedprice * 35) + 7) / (floor(l_extendedprice * 10) + 1)",
    "GCMs": "l_partkey % 1000",
    "GCRatio": "(l_partkey % 1000) / (floor(l_extendedprice * 35) + 7)",
    "ShuffleReadMs": "l_suppkey % 700",
    "ShuffleWriteMs": "l_discount * 1000",
    "CommMs": "(l_suppkey % 700) + l_discount * 1000",
    "CommRatio": "((l_suppkey % 700) + l_discount * 1000) / (floor(l_extendedprice * 35) + 7)",
    "ComputeMs": "CAST(floor(l_extendedprice * 34) AS DOUBLE)",
    "ComputeRatio": "floor(l_extendedprice * 34) / (floor(l_extendedprice * 35) + 7)",
    "MemSpillMB": "l_quantity * 128",
    "DiskSpillMB": "l_quantity * 40",
    "PeakHeapMB": "l_quantity * 50 + l_tax * 1000",
    "Run": "l_linenumber % 3 + 1",
}

# Fifteen applications out of orders: status and priority name them.
APP_NAME = "concat('application_17000000000', ascii(o_orderstatus), '_', substr(o_orderpriority, 1, 1))"
TASK_METRICS = {
    "run": "o_custkey % 5000 + 10",
    "gc": "o_custkey % 50",
    "mem": "o_orderkey * 1024",
    "disk": "o_orderkey * 512",
    "fetch": "o_orderkey % 100",
    "write_ns": "o_orderkey * 1000",
    "heap": "CAST(floor(o_totalprice) AS BIGINT) * 1000",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- shared table expressions --------------------------------------------------------------------

DOCS_DATED = f"""
dated AS (SELECT doc_id, text, strftime(DATE '2020-01-01' + {DOC_DAY}, '%Y-%m-%d') AS date FROM documents)"""


def host(url: str = "url") -> str:
    return f"regexp_extract({url}, 'https?://([^/:]+)', 1)"


# Parent domains of blog hosts are the blacklist of the checks.
BLACKLIST = f"""
listed AS (
  SELECT DISTINCT array_to_string(string_split({host()}, '.')[2:], '.') AS domain FROM pages
  WHERE {host()} LIKE 'blog.%')"""
UNLISTED = f"""NOT EXISTS (
    SELECT 1 FROM listed WHERE {host()} = domain OR ends_with({host()}, '.' || domain))"""


def _grams(source: str, key: str, text: str, n: int, out: str) -> str:
    """Character grams of a table expression as ``out(key, h)``."""
    terms = " + ".join(
        (f"lead(c, {k}) OVER w" if k else "c") + f" * {m}::BIGINT" for k, m in enumerate(gram_multipliers(n))
    )
    return f"""
{out}_chars AS (
  SELECT {key}, unnest(cs) AS c, generate_subscripts(cs, 1) AS i
  FROM (SELECT {key}, list_transform(string_split(lower({text}), ''), lambda x: unicode(x)::BIGINT) AS cs FROM {source})),
{out} AS (
  SELECT {key}, h FROM (
    SELECT {key}, ({terms}) % {MERSENNE31} AS h FROM {out}_chars WINDOW w AS (PARTITION BY {key} ORDER BY i))
  WHERE h IS NOT NULL)"""


def _word_grams(source: str, key: str, text: str, n: int, out: str) -> str:
    gram = " || ' ' || ".join(f"lead(w, {k}) OVER o" if k else "w" for k in range(n))
    return f"""
{out}_words AS (
  SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT {key}, regexp_split_to_array(regexp_replace(lower({text}), '\\s+$', ''), '\\s') AS ws FROM {source})),
{out} AS (
  SELECT {key}, ('0x' || substr(md5(gram), 1, 7))::BIGINT AS h FROM (
    SELECT {key}, {gram} AS gram FROM {out}_words WINDOW o AS (PARTITION BY {key} ORDER BY i))
  WHERE gram IS NOT NULL)"""


def _near(source: str, key: str, text: str, unit: str = "word", bands: int = BANDS, rows: int = ROWS) -> str:
    """Shingles, signatures, candidate and similar pairs over all documents of ``source``."""
    grams = _grams if unit == "char" else _word_grams
    minima = ", ".join(f"min((h * {a} + {b}) % {MERSENNE31}) AS m{i}" for i, (a, b) in enumerate(hash_coefficients(bands * rows)))
    entries = " UNION ALL ".join(
        f"SELECT {key} AS id, {b} AS band, {' || chr(32) || '.join(f'm{b * rows + r}' for r in range(rows))} AS bucket FROM sig"
        for b in range(bands)
    )
    return f"""
{grams(source, key, text, 5, 'grams')},
sh AS (SELECT DISTINCT {key} AS id, h FROM grams),
sig AS (SELECT {key}, {minima} FROM grams GROUP BY {key}),
bands AS ({entries}),
cand AS (
  SELECT DISTINCT x.id AS a, y.id AS b FROM bands x JOIN bands y
  ON x.band = y.band AND x.bucket = y.bucket AND x.id < y.id),
sizes AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
common AS (
  SELECT a, b, count(*) AS k FROM cand JOIN sh x ON x.id = a JOIN sh y ON y.id = b AND y.h = x.h GROUP BY a, b),
lens AS (SELECT {key} AS id, length({text}) AS len FROM {source}),
pairs AS (
  SELECT a, b, k / (p.n + q.n - k) AS jaccard, la.len AS len_a, lb.len AS len_b
  FROM common JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b JOIN lens la ON la.id = a JOIN lens lb ON lb.id = b
  WHERE k / (p.n + q.n - k) >= {THRESHOLD}),
directed AS (
  SELECT CASE WHEN len_a >= len_b THEN b ELSE a END AS id, CASE WHEN len_a >= len_b THEN a ELSE b END AS partner,
         greatest(len_a, len_b) AS len, jaccard FROM pairs),
best AS (
  SELECT id, partner, jaccard FROM directed
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY len DESC, partner) = 1)"""


# Components by closure over the similar pairs; needs WITH RECURSIVE.
CLUSTERS = """
edges AS (SELECT a AS u, b AS v FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT u AS id, u AS r FROM edges UNION SELECT e.v, reach.r FROM reach JOIN edges e ON e.u = reach.id),
comp AS (SELECT id, min(r) AS cluster FROM reach GROUP BY id),
clusters AS (
  SELECT id, cluster, first_value(id) OVER (PARTITION BY cluster ORDER BY len DESC, id) AS keeper
  FROM comp JOIN lens USING (id))"""


def _decode(column: str) -> str:
    entries = ", ".join(f"{_text(n)}: chr({c})" for n, c in sorted(name2codepoint.items()))
    name = f"regexp_extract(p, {_text(markup.ENTITY_PATTERN)}, 1)"
    code = f"CASE WHEN {name}[2] IN ('x', 'X') THEN ('0x' || {name}[3:])::BIGINT ELSE {name}[2:]::BIGINT END"
    char = (
        f"CASE WHEN {name} = '' THEN NULL WHEN {name}[1] = '#' THEN chr(({code})::INT) ELSE map_of[{name}] END"
    )
    piece = f"coalesce({char} || substr(p, length({name}) + 2), '&' || p)"
    return (
        f"(SELECT string_split({column}, '&')[1] || array_to_string(list_transform("
        f"string_split({column}, '&')[2:], lambda p: {piece}), '') FROM (SELECT MAP {{{entries}}} AS map_of))"
    )


def _replace(column: str, pattern: str, by: str) -> str:
    return f"regexp_replace({column}, {_text(pattern)}, {by}, 'g')"


def _folded(column: str) -> str:
    text = _replace(column, markup.BLANK_PATTERN, "' '")
    text = _replace(text, markup.LINE_PATTERN, "chr(10)")
    return _replace(text, r"^[ \n]+|[ \n]+$", "''")


def _extracted(source: str, html: str = "html", keep: str = "page_id, url") -> str:
    """Main text of ``source`` as ``extracted(keep, text)``."""

    def marked(drop: str) -> str:
        text = _replace(html, drop, "''")
        text = _replace(text, markup.LINK_OPEN_PATTERN, _text(markup.LINK_START))
        text = _replace(text, markup.LINK_CLOSE_PATTERN, _text(markup.LINK_END))
        text = _replace(text, markup.BLOCK_PATTERN, "chr(10)")
        text = _replace(text, markup.CELL_PATTERN, "' '")
        return _replace(text, markup.TAG_PATTERN, "''")

    visible = f"length({_replace('b', markup.MARK_PATTERN, _text(''))})"
    outside = f"length({_replace(_replace('b', markup.LINK_SPAN_PATTERN, _text('')), markup.MARK_PATTERN, _text(''))})"
    lines = (
        f"list_filter(string_split(t, chr(10)), lambda b: {visible} > 0"
        f" AND ({visible} - {outside}) <= {markup.MAX_LINK_SHARE} * {visible})"
    )
    joined = _folded(_replace(f"array_to_string({lines}, chr(10))", markup.MARK_PATTERN, "''"))
    whole = _folded(_replace(_decode("w"), markup.MARK_PATTERN, "''"))
    seen = f"regexp_matches(text, {_text(VISIBLE_PATTERN)})"
    return f"""
marked AS (
  SELECT {keep}, {marked(markup.DROP_PATTERN)} AS m, {marked(markup.HIDDEN_PATTERN)} AS w FROM {source} WHERE length({html}) > 0),
plain AS (SELECT {keep}, {_folded(_decode('m'))} AS t, w FROM marked),
strict AS (SELECT {keep}, {joined} AS text, w FROM plain),
extracted AS (
  SELECT * FROM (SELECT {keep}, CASE WHEN {seen} THEN text ELSE {whole} END AS text FROM strict) WHERE {seen})"""


def _names(names: list[str]) -> str:
    return ", ".join(_text(n) for n in names)


def _main_text(source: str, keep: str) -> str:
    """The heaviest block element's text of ``source(keep, html)``."""
    key = keep

    def depth(names: list[str]) -> str:
        return f"coalesce(sum(CASE WHEN matched AND name IN ({_names(names)}) THEN kind END) OVER (PARTITION BY {key} ORDER BY pos), 0) > 0"

    return f"""
shown AS (SELECT {keep}, regexp_extract_all({_replace('html', markup.HIDDEN_PATTERN, "''")}, {_text(tree.TOKEN_PATTERN)}) AS toks
  FROM {source} WHERE length(html) > 0),
cells AS (SELECT {keep}, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS pos FROM shown),
named AS (SELECT *, lower(regexp_extract(tok, {_text(tree.NAME_PATTERN)}, 1)) AS name FROM cells),
kinds AS (SELECT *, CASE WHEN name = '' OR name IN ({_names(tree.VOID_ELEMENTS)}) OR tok LIKE '%/>' THEN 0 WHEN tok LIKE '</%' THEN -1 ELSE 1 END AS kind FROM named),
sums AS (SELECT *, sum(kind) OVER (PARTITION BY {key}, name ORDER BY pos) AS total FROM kinds),
depths AS (SELECT *, total - least(0, min(total) OVER (PARTITION BY {key}, name ORDER BY pos)) AS depth FROM sums),
befores AS (SELECT *, coalesce(lag(depth) OVER (PARTITION BY {key}, name ORDER BY pos), 0) AS before FROM depths),
levels AS (SELECT *, CASE WHEN kind = 1 THEN depth WHEN kind = -1 AND before > 0 THEN before END AS level FROM befores),
mates AS (SELECT *, CASE WHEN kind = 1 THEN lead(pos) OVER (PARTITION BY {key}, name, level ORDER BY pos) END AS mate FROM levels),
matches AS (SELECT *, mate IS NOT NULL OR (kind = -1 AND level IS NOT NULL) AS matched FROM mates),
marks AS (SELECT *, {depth(markup.DROPPED_ELEMENTS)} AS hidden, {depth(['a'])} AS linked FROM matches),
weights AS (SELECT *, CASE WHEN hidden THEN 0 WHEN name <> '' THEN {tree.TAG_WEIGHT}
    ELSE length({_replace('tok', '[\\s\\p{Z}]+', "''")}) * (CASE WHEN linked THEN {tree.LINK_WEIGHT} ELSE 1 END) END AS w FROM marks),
running AS (SELECT *, sum(w) OVER (PARTITION BY {key} ORDER BY pos) AS upto FROM weights),
blocks AS (SELECT *, lead(upto) OVER (PARTITION BY {key}, name, level ORDER BY pos) - upto AS weight FROM running),
best AS (SELECT {keep}, pos AS first, mate AS last FROM blocks WHERE mate IS NOT NULL AND NOT hidden AND name IN ({_names(tree.CONTAINERS)})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY weight DESC, pos) = 1),
pieces AS (
  SELECT {keep}, pos, CASE WHEN name = '' THEN CASE WHEN regexp_matches(tok, '^<[/!?]') THEN '' ELSE tok END
      WHEN name IN ({_names(markup.BLOCK_ELEMENTS)}) THEN chr(10) WHEN name IN ('td', 'th') AND kind = 1 THEN ' ' ELSE '' END AS piece
  FROM blocks LEFT JOIN best USING ({keep}) WHERE NOT hidden AND (first IS NULL OR (pos > first AND pos < last))),
texts AS (SELECT {keep}, string_agg(piece, '' ORDER BY pos) AS t FROM pieces GROUP BY ALL),
whole AS (SELECT {keep}, {_folded(_decode('t'))} AS text FROM texts)"""


def _line(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace({text}, '[\\r\\n]', ' ', 'g'), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
    )


# Trigram profile of all labelled documents.
PROFILE = f"""
train AS (SELECT doc_id, lang, {_line('text')} AS line FROM documents WHERE lang IS NOT NULL),
{_grams('train', 'doc_id', 'line', lang.GRAM, 'tri')},
counts AS (
  SELECT lang, (h % {lang.BUCKETS})::INT AS bucket, count(*) AS n FROM tri JOIN train USING (doc_id) GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS total FROM counts GROUP BY lang),
profile AS (
  SELECT lang, bucket, n, total, round(ln((n + 1) / (total + {lang.BUCKETS})) * {lang.MICRO})::BIGINT AS logp,
    {lang.BUCKETS} AS buckets
  FROM counts JOIN totals USING (lang)),
floors AS (
  SELECT lang, round(ln(1 / (total + {lang.BUCKETS})) * {lang.MICRO})::BIGINT AS floor FROM totals)"""


def _scores(source: str, key: str, text: str) -> str:
    """``scores(key, lang, prob)`` and ``predicted(key, lang, prob)`` for ``source``; needs PROFILE."""
    return f"""
lined AS (SELECT {key}, {_line(text)} AS line FROM {source}),
{_grams('lined', key, 'line', lang.GRAM, 'test')},
bucketed AS (SELECT {key}, (h % {lang.BUCKETS})::INT AS bucket, count(*) AS k FROM test GROUP BY ALL),
lengths AS (SELECT {key}, sum(k)::BIGINT AS n FROM bucketed GROUP BY {key}),
gains AS (
  SELECT {key}, p.lang, sum(k * (logp - floor))::BIGINT AS g
  FROM bucketed JOIN profile p USING (bucket) JOIN floors f ON f.lang = p.lang GROUP BY {key}, p.lang),
means AS (
  SELECT {key}, f.lang, (coalesce(g, 0) + n * floor) / n * CAST({lang.SCALE / lang.MICRO!r} AS DOUBLE) AS m
  FROM lengths CROSS JOIN floors f LEFT JOIN gains USING ({key}, lang)),
weights AS (
  SELECT {key}, lang, exp(m - max(m) OVER (PARTITION BY {key})) AS w FROM means),
scores AS (
  SELECT {key}, lang, round(w / sum(w) OVER (PARTITION BY {key}), 6) AS prob FROM weights),
predicted AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY prob DESC, lang) = 1)"""


def _token_list(text: str) -> str:
    word = f"regexp_extract_all(lower(coalesce({text}, '')), {_text(WORD_PATTERN)})"
    return (
        f"list_transform(list_slice({word}, 1, {MAX_LENGTH}),"
        f" lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {VOCAB_SIZE - 1} + 1)"
    )


def _tokenized(source: str, key: str, text: str) -> str:
    pad = f"repeat(' 0', ({MAX_LENGTH} - len(ids))::BIGINT)"
    return f"""
SELECT {key},
  trim(array_to_string(ids, ' ') || {pad}) AS tokens,
  trim(repeat(' 1', len(ids)::BIGINT) || {pad}) AS attention_mask
FROM (SELECT {key}, {_token_list(text)} AS ids FROM {source})"""


RUNS = "runs AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in RUN_EXPRESSIONS.items()) + " FROM lineitem)"
SIZES = "sizes AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in DATA_SIZES.items()) + ") AS s(Data, DatasetSizeGB))"
ENRICHED = f"""
{RUNS}, {SIZES},
enriched AS (
  SELECT *, AppTimeSec / TotalCores AS TimePerCore, AppTimeSec / SizeFactor AS TimePerUnit FROM (
    SELECT runs.*, DatasetSizeGB, AppTimeMs / 1000 AS AppTimeSec, ExecRunTimeMs / 1000 AS ExecRunTimeSec,
      GCMs / 1000 AS GCSec, ShuffleReadMs / 1000 AS ShuffleReadSec, ShuffleWriteMs / 1000 AS ShuffleWriteSec,
      CommMs / 1000 AS CommSec, ComputeMs / 1000 AS ComputeSec, MemSpillMB / 1024 AS MemSpillGB,
      DiskSpillMB / 1024 AS DiskSpillGB, PeakHeapMB / 1024 AS PeakHeapGB,
      regexp_extract(Data, '_(\\d+)', 1)::DOUBLE AS SizeFactor
    FROM runs JOIN sizes USING (Data)))"""
# Runs that did not fail, and their means per configuration.
COMPLETED = f"""
{ENRICHED},
completed AS (SELECT * FROM enriched WHERE TotalTime > 0 AND {' AND '.join(f'{s} > 0' for s in STAGE_COLUMNS)})"""
CONFIG_METRICS = [
    "AppTimeSec", "Parallelism", "PeakHeapGB", "MemSpillGB", "DiskSpillGB", "ComputeSec", "GCSec", "CommSec",
    "ShuffleReadSec", "ShuffleWriteSec", "ExecRunTimeSec", "ExecRunTimeMs", "ComputeRatio", "GCRatio", "CommRatio",
    "DatasetSizeGB", "TimePerUnit", *STAGE_COLUMNS,
]
CONFIGS = f"""
{COMPLETED},
configs AS (
  SELECT Type, Execs, Cores, TotalCores, MemGB, {', '.join(f'avg({m}) AS {m}' for m in CONFIG_METRICS)}
  FROM completed GROUP BY Type, Execs, Cores, TotalCores, MemGB),
strong AS (
  SELECT *, first_value(AppTimeSec) OVER w / AppTimeSec AS Speedup,
    100 * (first_value(AppTimeSec) OVER w / AppTimeSec) / (TotalCores / min(TotalCores) OVER (PARTITION BY Type)) AS Efficiency,
    min(TotalCores) OVER (PARTITION BY Type) AS Least
  FROM configs WINDOW w AS (PARTITION BY Type ORDER BY Execs, Cores, TotalCores, MemGB)),
weak AS (
  SELECT *, 100 * first_value(AppTimeSec) OVER (PARTITION BY Cores ORDER BY Execs, Cores, TotalCores, MemGB) / AppTimeSec
    AS Efficiency FROM configs WHERE Type = 'Weak')"""
SCENARIO = """CASE WHEN Type = 'Strong' THEN 'Strong Scaling'
  WHEN Type = 'Weak' AND Cores IN (2, 4) THEN 'Weak Scaling (' || Cores || ' cores/exec)' END"""

CORPUS = f"""
{BLACKLIST},
kept AS (SELECT page_id, url, html FROM pages WHERE {UNLISTED}),
{_extracted('kept')},
{PROFILE},
{_scores('extracted', 'page_id', 'text')},
english AS (
  SELECT page_id, text, strftime(DATE '2020-01-01' + {PAGE_DAY}, '%Y-%m-%d') AS date
  FROM extracted WHERE page_id IN (
    SELECT page_id FROM predicted WHERE lang = '{lang.LANG}' AND prob >= {lang.THRESHOLD})),
exact AS (SELECT * FROM english QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY date, page_id) = 1)"""
CORPUS_NEAR = f"""
{CORPUS},
{_near('english', 'page_id', 'text')},
{CLUSTERS},
unique_pages AS (SELECT * FROM english WHERE page_id NOT IN (SELECT id FROM clusters WHERE id <> keeper))"""


def _means(metrics: list[str], digits: int) -> str:
    return ", ".join(f"round(avg({m}), {digits}) AS {m}" for m in metrics)


def _rounds(metrics: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({m}, {digits}) AS {m}" for m in metrics)


SHUFFLE_METRICS = [
    "AppTimeSec", "ComputeSec", "GCSec", "ShuffleReadSec", "ShuffleWriteSec", "ComputeRatio", "GCRatio", "CommRatio",
]
MEMORY = f"""
labelled AS (
  SELECT 'Strong Scaling (Min Cores)' AS Configuration, * FROM configs
  WHERE Type = 'Strong' AND TotalCores = (SELECT min(TotalCores) FROM configs WHERE Type = 'Strong') UNION ALL
  SELECT 'Strong Scaling (Max Cores)', * FROM configs
  WHERE Type = 'Strong' AND TotalCores = (SELECT max(TotalCores) FROM configs WHERE Type = 'Strong') UNION ALL
  SELECT 'Weak Scaling (' || Cores || ' cores/exec)', * FROM configs WHERE Type = 'Weak' AND Cores IN (2, 4)),
memory AS (
  SELECT Configuration, {_means(['PeakHeapGB', 'MemSpillGB', 'DiskSpillGB', 'GCSec'], 2)} FROM labelled GROUP BY Configuration)"""
UTILISATION = f"""
scenarios AS (SELECT {SCENARIO} AS Scenario, * FROM configs),
used AS (
  SELECT Scenario, TotalCores, first(Execs ORDER BY Execs, Cores, MemGB) AS Execs, first(Cores ORDER BY Execs, Cores, MemGB) AS Cores,
    round(avg(Parallelism), 6) AS Parallelism, round(avg(Parallelism) / TotalCores * 100, 1) AS Utilization
  FROM scenarios WHERE Scenario IS NOT NULL GROUP BY Scenario, TotalCores)"""
BEST = f"""
experiments AS (SELECT {SCENARIO} AS Experiment, * FROM strong),
best AS (
  SELECT Experiment, Execs, Cores, TotalCores, round(AppTimeSec, 6) AS AppTimeSec,
    CASE WHEN Type = 'Strong' THEN round(Efficiency, 1) END AS Efficiency, round(PeakHeapGB, 2) AS PeakHeapGB,
    round(MemSpillGB, 2) AS MemSpillGB FROM experiments WHERE Experiment IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY Experiment ORDER BY AppTimeSec, Execs, Cores, TotalCores, MemGB) = 1)"""


def _reports() -> str:
    """All ten report tables as one long table of ``report, key, metric, value``."""
    config = "Execs, Cores, TotalCores, MemGB"
    tables = {
        "strong_performance": (
            "TotalCores",
            "round(avg(AppTimeSec), 2) AS AppTimeSec, round(avg(Speedup), 2) AS Speedup, TotalCores / Least AS IdealSpeedup,"
            " round(avg(Efficiency), 2) AS Efficiency, round(avg(Parallelism), 2) AS Parallelism,"
            " round(round(avg(Parallelism), 2) / TotalCores * 100, 1) AS Utilization",
            "strong WHERE Type = 'Strong' GROUP BY TotalCores, Least",
        ),
        "strong_breakdown": (
            "TotalCores",
            f"{_means(['AppTimeSec', 'ComputeSec', 'GCSec', 'ShuffleReadSec', 'ShuffleWriteSec'], 2)},"
            " round(avg(100 * ComputeSec / ExecRunTimeSec), 2) AS ComputeRatio,"
            " round(avg(100 * GCSec / ExecRunTimeSec), 2) AS GCRatio, round(avg(100 * CommSec / ExecRunTimeSec), 2) AS CommRatio",
            "configs WHERE Type = 'Strong' GROUP BY TotalCores",
        ),
        "stage_strong_time": ("TotalCores", _means(STAGE_COLUMNS, 2), "configs WHERE Type = 'Strong' GROUP BY TotalCores"),
        "weak_comparison": (
            config,
            _rounds(["AppTimeSec", "DatasetSizeGB", "ExecRunTimeMs", "Parallelism", "TimePerUnit", "Efficiency"]),
            "weak WHERE Cores IN (2, 4)",
        ),
        "memory_analysis": ("Configuration", "PeakHeapGB, MemSpillGB, DiskSpillGB, GCSec", "memory"),
        "best_configs": (
            "Experiment, Execs, Cores, TotalCores", "AppTimeSec, Efficiency, PeakHeapGB, MemSpillGB", "best"
        ),
        "parallelism": ("Scenario, TotalCores, Execs, Cores", "Parallelism, Utilization", "used"),
        "strong_spill": (config, _rounds(["MemSpillGB", "DiskSpillGB", "PeakHeapGB"]), "configs WHERE Type = 'Strong'"),
        "stage_weak_time": ("TotalCores", _means(STAGE_COLUMNS, 2), "configs WHERE Type = 'Weak' GROUP BY TotalCores"),
        "weak_shuffle": (config, _rounds(SHUFFLE_METRICS), "configs WHERE Type = 'Weak' AND Cores IN (2, 4)"),
    }
    parts = " UNION ALL ".join(
        f"""
SELECT '{name}' AS report, concat_ws('|', {keys}) AS key, metric, value FROM (
  UNPIVOT (SELECT {keys}, {metrics} FROM {source}) ON COLUMNS(* EXCLUDE ({keys})) INTO NAME metric VALUE value)"""
        for name, (keys, metrics, source) in tables.items()
    )
    return f"WITH {CONFIGS}, {MEMORY}, {UTILISATION}, {BEST} {parts}"


def statements() -> dict[str, str]:
    near = _near("documents", "doc_id", "text")
    words = f"regexp_extract_all(lower(coalesce(text, '')), {_text(WORD_PATTERN)})"
    rec = "WITH RECURSIVE "
    app_task = {k: f"({v})" for k, v in TASK_METRICS.items()}
    return {
        "warc_ingest": f"""
SELECT '<urn:' || name || ':' || page_id || '>' AS warc_id, url,
  strftime(DATE '2020-01-01' + {PAGE_DAY}, '%Y-%m-%d') AS date, md5(html) AS html_md5, strlen(html) AS html_bytes
FROM (
  SELECT 'page' AS name, * FROM pages UNION ALL
  SELECT 'latin', * REPLACE (regexp_replace(html, '[^\\x{{00}}-\\x{{ff}}]', '?', 'g') || 'é' AS html) FROM pages)""",
        "parquet_roundtrip": f"""
SELECT page_id, url, strftime(DATE '2020-01-01' + {PAGE_DAY}, '%Y-%m-%d') AS date,
  md5(html) AS html_md5 FROM pages""",
        "blacklist_load": f"SELECT DISTINCT lower({host()}) AS domain FROM pages WHERE {host()} <> ''",
        "blacklist_normalise": f"SELECT DISTINCT lower({host()}) AS domain FROM pages WHERE {host()} <> ''",
        "host_extract": f"SELECT page_id, {host()} AS host FROM pages",
        "domain_suffixes": f"""
SELECT page_id, array_to_string(parts[i:], '.') AS domain FROM (
  SELECT page_id, parts, unnest(range(1, len(parts))) AS i FROM (
    SELECT page_id, string_split({host()}, '.') AS parts FROM pages))""",
        "domain_filter": f"WITH {BLACKLIST} SELECT page_id, url FROM pages WHERE {UNLISTED}",
        "domain_filter_bloom": f"WITH {BLACKLIST} SELECT page_id, url FROM pages WHERE {UNLISTED}",
        "url_prefix_filter": """
WITH entries AS (
  SELECT DISTINCT lower(regexp_extract(url, 'https?://([^/:]+/[^/?#]+)', 1)) AS prefix FROM pages
  WHERE url LIKE '%/fr/%' OR url LIKE '%/de/%')
SELECT page_id, url FROM pages p WHERE NOT EXISTS (
  SELECT 1 FROM entries WHERE prefix <> '' AND starts_with(
    lower(regexp_replace(regexp_replace(url, '^[^:/?#]+://', ''), '[?#].*$', '')) || '/', prefix || '/'))""",
        "html_extract": f"""
WITH forms AS (
  SELECT page_id, false AS in_form, html FROM pages UNION ALL SELECT page_id, true, '<form>' || html FROM pages),
{_extracted('forms', keep='page_id, in_form')} SELECT page_id, in_form, text FROM extracted""",
        "html_main_text": f"""
WITH torn AS (
  SELECT page_id, false AS torn, html FROM pages UNION ALL
  SELECT page_id, true, '</i></div><nav><b><div>' || replace(html, '</p>', '</p></b><p>') FROM pages),
{_main_text('torn', 'page_id, torn')} SELECT page_id, torn, text FROM whole WHERE regexp_matches(text, {_text(VISIBLE_PATTERN)})""",
        "boilerplate_filter": f"""
WITH {_extracted('pages')},
lines AS (SELECT page_id, {host()} AS host, string_split(text, chr(10)) AS ls, text FROM extracted),
seen AS (SELECT DISTINCT page_id, host, unnest(ls) AS line FROM lines),
often AS (SELECT host, line FROM seen GROUP BY ALL HAVING count(*) >= 2),
hits AS (SELECT host, list(line) AS bad FROM often GROUP BY host)
SELECT page_id, kept AS text FROM (
  SELECT page_id, CASE WHEN bad IS NULL THEN text ELSE
    array_to_string(list_filter(ls, lambda x: NOT list_contains(bad, x)), chr(10)) END AS kept
  FROM lines LEFT JOIN hits USING (host))
WHERE regexp_matches(kept, '[^\\s\\p{{Z}}]')""",
        "lang_profile": f"WITH {PROFILE} SELECT lang, bucket, n, total, logp, buckets FROM profile",
        "lang_score": f"WITH {PROFILE}, {_scores('documents', 'doc_id', 'text')} SELECT doc_id, lang, prob FROM scores",
        "lang_filter": f"""
WITH {PROFILE}, {_scores('documents', 'doc_id', 'text')}
SELECT doc_id, source FROM documents WHERE doc_id IN (
  SELECT doc_id FROM predicted WHERE lang = '{lang.LANG}' AND prob >= {lang.THRESHOLD})""",
        "exact_dedup": f"""
WITH {DOCS_DATED}
SELECT doc_id, date, md5(text) AS fingerprint FROM dated
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY date, doc_id) = 1""",
        "shingles_char": f"""
WITH {_grams('documents', 'doc_id', 'text', 5, 'grams')}
SELECT doc_id, count(*) AS n_shingles, sum(h)::BIGINT AS shingle_sum, min(h) AS shingle_min, max(h) AS shingle_max
FROM (SELECT DISTINCT doc_id, h FROM grams) GROUP BY doc_id""",
        "shingles": f"""
WITH {_word_grams('documents', 'doc_id', 'text', 5, 'grams')}
SELECT doc_id, count(*) AS n_shingles, sum(h)::BIGINT AS shingle_sum, min(h) AS shingle_min, max(h) AS shingle_max
FROM (SELECT DISTINCT doc_id, h FROM grams) GROUP BY doc_id""",
        "minhash_signature": f"WITH {near} SELECT * FROM sig",
        "minhash_signature_char": f"WITH {_near('documents', 'doc_id', 'text', 'char')} SELECT * FROM sig",
        "minhash_candidates": f"""
WITH {near}
SELECT band, min(id) AS first_id, max(id) AS last_id, count(*) AS n_docs FROM bands GROUP BY band, bucket HAVING count(*) > 1""",
        "minhash_pairs": f"WITH {near} SELECT id AS doc_id FROM best",
        "minhash_pairs_char": f"""
WITH {_near('documents', 'doc_id', 'text', 'char')}
SELECT id AS doc_id FROM best""",
        "minhash_pairs_any": f"""
WITH {_near('documents', 'doc_id', 'text', 'word', 24, 1)}
SELECT id AS doc_id FROM best""",
        "dup_clusters": f"{rec}{near}, {CLUSTERS} SELECT id AS doc_id, cluster, keeper FROM clusters",
        "near_dup_filter": f"""
{rec}{near}, {CLUSTERS}
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT id FROM clusters WHERE id <> keeper)""",
        "near_dup_pairwise": f"""
WITH {near} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT id FROM best)""",
        "dedup_compare": f"""
{rec}{near}, {CLUSTERS},
a AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM clusters WHERE id <> keeper)),
{DOCS_DATED},
b AS (SELECT doc_id FROM dated QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY date, doc_id) = 1)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
  (SELECT count(*) FROM a JOIN b USING (doc_id)) AS n_both,
  (SELECT count(*) FROM a ANTI JOIN b USING (doc_id)) AS only_a,
  (SELECT count(*) FROM b ANTI JOIN a USING (doc_id)) AS only_b""",
        "word_tokens": f"""
SELECT doc_id, (i - 1)::INT AS pos, ws[i] AS word FROM (
  SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT doc_id, {words} AS ws FROM documents))""",
        "token_ids": f"""
SELECT doc_id, count(*) AS n_tokens, sum(token)::BIGINT AS token_sum, sum(token * pos)::BIGINT AS token_order FROM (
  SELECT doc_id, i - 1 AS pos, ('0x' || substr(md5(ws[i]), 1, 8))::BIGINT % {VOCAB_SIZE - 1} + 1 AS token FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT doc_id, {words} AS ws FROM documents)))
GROUP BY doc_id""",
        "tokenize_fixed": _tokenized("documents", "doc_id", "text"),
        "token_stats": f"""
SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_tokens, sum({MAX_LENGTH} - n)::BIGINT AS n_padding,
  count_if(n = {MAX_LENGTH})::BIGINT AS n_full, count_if(n = 0)::BIGINT AS n_empty
FROM (SELECT least(len({words}), {MAX_LENGTH}) AS n FROM documents)""",
        "stage_funnel": f"""
{rec}{CORPUS_NEAR},
c AS (
  SELECT 0 AS step, '2_domain_filter' AS stage, NULL AS parent, count(*) AS rows_out FROM kept UNION ALL
  SELECT 1, '3_html_extract', '2_domain_filter', count(*) FROM extracted UNION ALL
  SELECT 2, '4_lang_filter', '3_html_extract', count(*) FROM english UNION ALL
  SELECT 3, '5a_near_dedup', '4_lang_filter', count(*) FROM unique_pages UNION ALL
  SELECT 4, '5b_exact_dedup', '4_lang_filter', count(*) FROM exact UNION ALL
  SELECT 5, '6a_tokenize', '5a_near_dedup', count(*) FROM ({_tokenized('unique_pages', 'page_id', 'text')}) UNION ALL
  SELECT 6, '6b_tokenize', '5b_exact_dedup', count(*) FROM ({_tokenized('exact', 'page_id', 'text')}))
SELECT c.step, c.stage, c.parent, coalesce(p.rows_out, c.rows_out) AS rows_in, c.rows_out,
  round(c.rows_out / coalesce(p.rows_out, c.rows_out), 6) AS share FROM c LEFT JOIN c p ON c.parent = p.stage""",
        "corpus_md5": f"WITH {CORPUS} {_tokenized('exact', 'page_id', 'text')}",
        "corpus_lsh": f"{rec}{CORPUS_NEAR} {_tokenized('unique_pages', 'page_id', 'text')}",
        "eventlog_metrics": f"""
WITH apps AS (
  SELECT {APP_NAME} AS app, sum(o_custkey)::BIGINT AS total, sum({app_task['run']})::BIGINT AS run,
    sum({app_task['gc']})::BIGINT AS gc, sum({app_task['mem']})::BIGINT AS mem, sum({app_task['disk']})::BIGINT AS disk,
    sum({app_task['fetch']})::BIGINT AS waited, sum({app_task['write_ns']})::BIGINT AS write_ns, max({app_task['heap']}) AS heap
  FROM orders GROUP BY app),
m AS (SELECT *, write_ns / 1000000 AS w, run + 1e-9 AS r FROM apps)
SELECT app, total AS total_time_ms, run AS executor_run_time_ms, round(run / (total + 1e-9), 6) AS parallelism_factor,
  gc AS gc_time_ms, round(gc / r, 6) AS gc_ratio, waited AS shuffle_read_ms, round(w, 6) AS shuffle_write_ms,
  round(waited + w, 6) AS communication_ms, round((waited + w) / r, 6) AS communication_ratio,
  round(run - (waited + w) - gc, 6) AS compute_ms, round((run - (waited + w) - gc) / r, 6) AS compute_ratio,
  round(mem / 1048576, 6) AS memory_spill_mb, round(disk / 1048576, 6) AS disk_spill_mb,
  round(heap / 1048576, 6) AS peak_heap_mb FROM m""",
        "runlog_scrape": f"""
SELECT {APP_NAME} AS "AppID", {', '.join(f'sum(o_custkey % {7 + i}) + 0.5::DOUBLE AS "{s}"' for i, s in enumerate(STAGE_COLUMNS[:-1]))},
  0::DOUBLE AS "S6b", sum(o_custkey) + 0.5::DOUBLE AS "TotalTime" FROM orders GROUP BY 1""",
        "run_enrich": f"WITH {ENRICHED} SELECT * FROM enriched",
        "run_append": f"""
WITH {RUNS} SELECT Type, Execs, Cores, Data, AppID, AppTimeMs, Parallelism, PeakHeapMB, Run FROM runs""",
        "run_status": f"""
WITH {RUNS} SELECT Type, CASE WHEN TotalTime > 0 AND {' AND '.join(f'{s} > 0' for s in STAGE_COLUMNS)} THEN 'ok' ELSE 'failed' END AS status,
  count(*) AS n FROM runs GROUP BY ALL""",
        "run_dedup": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem",
        "stack": f"""
WITH {RUNS} SELECT 'runs' AS origin, Type AS label, count(*) AS n FROM runs GROUP BY ALL
UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY ALL""",
        "distinct_keys": "SELECT DISTINCT l_linenumber FROM lineitem",
        "grouped_mean": f"""
WITH {COMPLETED} SELECT Type, Execs, Cores, TotalCores, MemGB, {_means(['AppTimeSec', 'MemSpillGB', 'DiskSpillGB', 'PeakHeapGB'], 6)}
FROM completed GROUP BY ALL""",
        "mean_std_by_group": f"""
WITH {COMPLETED} SELECT MemGB, count(*) AS n, {', '.join(f'round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std' for m in ['AppTimeSec', 'GCRatio', 'MemSpillMB'])}
FROM completed WHERE Type = 'MemoryStudy' GROUP BY MemGB""",
        "quantiles_by_group": f"""
WITH {ENRICHED} SELECT Type, round(min(PeakHeapGB), 6) AS min, round(quantile_cont(PeakHeapGB, 0.25), 6) AS q1,
  round(quantile_cont(PeakHeapGB, 0.5), 6) AS median, round(quantile_cont(PeakHeapGB, 0.75), 6) AS q3,
  round(max(PeakHeapGB), 6) AS max FROM enriched GROUP BY Type""",
        "quantiles_sketched": """
SELECT o_orderpriority, count(*) AS n, true AS q1_within, true AS median_within, true AS q3_within
FROM orders GROUP BY o_orderpriority""",
        "best_row_by_group": f"""
WITH {RUNS} SELECT Type, Cores, AppTimeMs, AppID, Execs, PeakHeapMB FROM runs
QUALIFY row_number() OVER (PARTITION BY Type, Cores ORDER BY AppTimeMs, AppID) = 1""",
        "baseline_ratio": """
SELECT o_custkey, o_orderkey, o_totalprice, first_value(o_totalprice) OVER w AS baseline,
  first_value(o_totalprice) OVER w / o_totalprice AS ratio FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
        "strong_scaling": f"""
WITH {CONFIGS}
SELECT Type, TotalCores, round(avg(AppTimeSec), 2) AS AppTimeSec, round(avg(Speedup), 2) AS Speedup,
  TotalCores / Least AS IdealSpeedup, round(avg(Efficiency), 2) AS Efficiency, round(avg(Parallelism), 2) AS Parallelism,
  round(round(avg(Parallelism), 2) / TotalCores * 100, 1) AS Utilization FROM strong GROUP BY Type, TotalCores, Least""",
        "weak_scaling": f"""
WITH {CONFIGS} SELECT Execs, Cores, TotalCores, MemGB, round(AppTimeSec, 6) AS AppTimeSec, round(TimePerUnit, 6) AS TimePerUnit,
  round(Efficiency, 6) AS Efficiency FROM weak""",
        "ratio_breakdown": f"""
WITH {CONFIGS} SELECT TotalCores, {_means(['AppTimeSec', 'ComputeSec', 'GCSec', 'ShuffleReadSec', 'ShuffleWriteSec'], 2)},
  round(avg(100 * ComputeSec / ExecRunTimeSec), 2) AS ComputeRatio, round(avg(100 * GCSec / ExecRunTimeSec), 2) AS GCRatio,
  round(avg(100 * CommSec / ExecRunTimeSec), 2) AS CommRatio FROM configs WHERE Type = 'Strong' GROUP BY TotalCores""",
        "stage_time_by_group": f"""
WITH {CONFIGS} SELECT TotalCores, {_means(STAGE_COLUMNS, 2)} FROM configs WHERE Type = 'Strong' GROUP BY TotalCores""",
        "report_sink": _reports(),
        "shuffle_profile": f"""
WITH {CONFIGS} SELECT Execs, Cores, TotalCores, MemGB, {_rounds(SHUFFLE_METRICS)} FROM configs WHERE Type = 'Weak'""",
        "best_runs": f"""
WITH {COMPLETED},
v AS (
  SELECT 'time' AS Best, *, AppTimeSec AS Value FROM completed UNION ALL
  SELECT 'time per core', *, TimePerCore FROM completed UNION ALL
  SELECT 'time per unit', *, TimePerUnit FROM completed WHERE Type = 'Weak')
SELECT Best, Execs, Cores, TotalCores, Data, Run, Value FROM v
QUALIFY row_number() OVER (PARTITION BY Best ORDER BY Value, TotalCores, Execs, Data, Run) = 1""",
        "memory_profile": f"WITH {CONFIGS}, {MEMORY} SELECT * FROM memory",
        "utilisation": f"WITH {CONFIGS}, {UTILISATION} SELECT * FROM used",
        "best_configurations": f"WITH {CONFIGS}, {BEST} SELECT * FROM best",
        "run_summary": f"""
WITH {COMPLETED}
SELECT count(*) AS Runs, count_if(Type = 'Strong')::BIGINT AS StrongRuns, count_if(Type = 'Weak')::BIGINT AS WeakRuns,
  count_if(Type = 'MemoryStudy')::BIGINT AS MemoryRuns, round(avg(AppTimeSec), 2) AS AvgTime, round(min(AppTimeSec), 2) AS MinTime,
  round(max(AppTimeSec), 2) AS MaxTime, round(avg(GCSec), 2) AS AvgGC, round(avg(GCRatio) * 100, 2) AS AvgGCRatio,
  round(avg(ComputeRatio) * 100, 2) AS AvgComputeRatio, round(avg(CommRatio) * 100, 2) AS AvgCommRatio,
  round(avg(PeakHeapGB), 2) AS AvgPeakHeapGB, round(avg(MemSpillGB), 2) AS AvgMemSpillGB,
  round(avg(DiskSpillGB), 2) AS AvgDiskSpillGB, round(sum(MemSpillGB), 2) AS SumMemSpillGB,
  round(sum(DiskSpillGB), 2) AS SumDiskSpillGB,
  (SELECT Execs || 'x' || Cores FROM completed ORDER BY AppTimeSec, Execs, Cores, Data, Run LIMIT 1) AS BestConfig,
  (SELECT Execs || 'x' || Cores FROM completed ORDER BY TimePerCore, Execs, Cores, Data, Run LIMIT 1) AS MostEfficientConfig,
  round(min(TimePerCore), 2) AS TimePerCore FROM completed""",
    }
