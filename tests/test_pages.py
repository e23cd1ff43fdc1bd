"""Hosts, blacklists, archives and extraction on literal rows."""

import functools
import gzip
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textmill.functions.bloom import bloom_filter, bloom_size, might_contain
from textmill.functions.markup import LINK_END, LINK_START, MARK_PATTERN, folded, is_prose, unmarked
from textmill.operators import tree
from textmill.operators.domains import (
    blacklist_normalise,
    bloom_domain_filter,
    domain_filter,
    domain_suffixes,
    host_extract,
    url_prefix_filter,
)
from textmill.operators.extract import boilerplate_filter, html_extract
from textmill.schemas import CRAWL_RECORD, FILTERED_PAGE, SchemaMismatch, check_schema, check_step
from textmill.sources.blacklist import blacklist_load
from textmill.sources.tables import read_table, write_table
from textmill.sources import warc
from textmill.sources.warc import archive_lines, warc_ingest, warc_to_parquet

URLS = {
    1: "http://www.bad.example.org/x",
    2: "https://bad.example.org:8080/y",
    3: "http://notbad.example.org/",
    4: "http://example.org",
    5: "http://localhost/",
    6: "http://10.0.0.1/a",
    7: None,
    8: "bad.example.org/without/scheme",
    9: "http://BAD.example.org/",
    10: "http://user:pw@bad.example.org/",
    11: "http://deep.er.bad.example.org./z",
}


@pytest.fixture(scope="module")
def urls(spark):
    return spark.createDataFrame(list(URLS.items()), "id long, url string")


def test_hosts(urls):
    hosts = dict(rows(host_extract(urls, "url").where("url is not null").select("id", "host")))
    assert hosts[2] == "bad.example.org"
    assert hosts[8] == ""
    assert hosts[9] == "BAD.example.org"
    strict = dict(rows(host_extract(urls, "url", strict=True).where("url is not null").select("id", "host")))
    assert strict[9] == strict[10] == "bad.example.org"
    assert strict[11] == "deep.er.bad.example.org"


def test_suffixes(urls):
    got = rows(domain_suffixes(urls.where("id in (1, 5, 7)"), "id", "url"))
    assert got == [(1, "bad.example.org"), (1, "example.org"), (1, "www.bad.example.org")]


def test_domain_filter(spark, urls):
    listed = spark.createDataFrame([("bad.example.org",), ("org",), ("localhost",), ("0.1",)], "domain string")
    assert [r[0] for r in rows(domain_filter(urls, listed).select("id"))] == [3, 4, 5, 7, 8, 9, 10, 11]
    kept = domain_filter(urls, listed, strict=True)
    assert [r[0] for r in rows(kept.select("id"))] == [3, 4, 5, 7, 8]


def test_bloom_filter(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"))
    words, hashes = bloom_size(20_000, 0.01)
    assert 0.9 < words * 64 / (20_000 * 9.585) < 1.1 and hashes in (6, 7)
    held = bloom_filter(keys, "k", words, hashes)
    assert len(held.first()["words"]) == words
    others = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("k"))
    count = lambda df: df.where(might_contain(held, F.col("k"), words, hashes)).count()
    assert count(keys) == 20_000 and 100 < count(others) < 320
    assert bloom_size(0) == (1, 1) and spark.range(1).select(might_contain(held, F.lit(None).cast("string"), words, hashes)).first()[0] is None


def test_bloom_domain_filter(spark, urls):
    listed = spark.createDataFrame([("bad.example.org",), ("org",), ("localhost",), (None,), ("bad.example.org",)], "domain string")
    made = spark.range(200_000).select(F.concat(F.lit("d"), "id", F.lit(".example.net")).alias("domain"))
    pages = spark.range(3000).select(F.col("id") + 100, F.concat(F.lit("http://www.d"), F.col("id") * 100, F.lit(".example.net/")))
    pages = urls.union(pages)
    for found in (listed, listed.unionByName(made), listed.limit(0)):
        for strict, size in ((False, 64 << 20), (True, 64 << 20), (False, 10)):
            want = rows(domain_filter(pages, found, strict=strict).select("id"))
            assert rows(bloom_domain_filter(pages, found, strict=strict, max_bytes=size).select("id")) == want


def test_url_prefixes(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x/y?q"), (2, "http://a.org/xy"), (3, "http://A.org/X"), (4, "a.org"), (5, None)], "id long, url string"
    )
    listed = spark.createDataFrame([("a.org/x/",), ("a.org",)], "domain string")
    assert [r[0] for r in rows(url_prefix_filter(pages, listed).select("id"))] == [2, 4, 5]


def test_blacklist_folder(spark, tmp_path):
    for folder, name, text in [
        ("ads", "domains", "# comment\n\nA.Example.org \na.example.org\n"),
        ("mixed/deep", "urls", "b.example.org/path\n"),
        ("mixed", "usage", "not.a.list\n"),
    ]:
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    assert rows(blacklist_load(spark, str(tmp_path))) == [("a.example.org",), ("b.example.org/path",)]
    lines = spark.createDataFrame([(" X ",), ("x",), ("#x",), ("",), (None,)], "value string")
    assert rows(blacklist_normalise(lines)) == [("x",)]


def record(kind, name, body, http=b"HTTP/1.1 200 OK\r\nContent-Type: Text/HTML; charset=x\r\n\r\n"):
    payload = http + body
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{name}>\r\nWARC-Target-URI: http://a.example/{name}\r\n"
        f"WARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


def coded(name):
    return b"HTTP/1.1 200 OK\r\ncontent-type: text/html\r\n" + name + b"\r\n\r\n"


CASES = {
    "utf8": ("héllo".encode(), None, "héllo"),
    "latin": ("café".encode("latin-1"), None, "café"),
    "blank": (b"a\r\n\r\nb\r\n\r\n", None, "a\r\n\r\nb\r\n\r\n"),
    "empty": (b"", None, ""),
    "inline": (b"see WARC/1.0\r\nfor more", None, "see WARC/1.0\r\nfor more"),
    "nested": (b"x\r\n\r\n" + record("response", "inner", b"in") + b"tail", None, None),
    "liar": (b"\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99999999\r\n\r\nevil", None, None),
    "gzip": (gzip.compress(b"zipped"), coded(b"Content-Encoding: gzip"), "zipped"),
    "chunks": (b"4\r\nabcd\r\n2\r\nef\r\n0\r\n\r\n", coded(b"Transfer-Encoding: chunked"), "abcdef"),
    "lines": (b"lf\n\nbody", b"HTTP/1.1 200 OK\nContent-Type: text/html\n\n", "lf\n\nbody"),
    "broken": (b"not gzip", coded(b"Content-Encoding: gzip"), "not gzip"),
}


@pytest.fixture(params=["source", "scan"])
def way(request, monkeypatch):
    """Archives by the data source, and by text scan as in a store that Python cannot open."""
    if request.param == "scan":
        monkeypatch.setattr(warc, "reachable", lambda path: False)
    return request.param


def test_archives(spark, tmp_path, way):
    data = record("warcinfo", "w", b"", b"") + record("request", "q", b"GET")
    for name, (body, http, _) in CASES.items():
        data += record("response", name, body, http) if http else record("response", name, body)
    data += record("response", "image", b"GIF", b"HTTP/1.1 200 OK\r\nContent-Type: image/gif\r\n\r\n")
    data += record("response", "untyped", b"n", b"HTTP/1.1 200 OK\r\n\r\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(data)
    (tmp_path / "in" / "b.warc").write_bytes(record("response", "other", b"second file"))
    (tmp_path / "in" / "c.txt").write_bytes(record("response", "no", b"not an archive"))
    expected = {f"<urn:{n}>": (t if t is not None else b.decode()) for n, (b, _, t) in CASES.items()}
    expected["<urn:other>"] = "second file"
    got = warc_ingest(spark, str(tmp_path / "in")).collect()
    assert {r["warc_id"]: r["html_content"] for r in got} == expected
    assert len(got) == len(expected)
    assert {r["warc_filename"] for r in got} == {"a.warc", "b.warc"}
    out = str(tmp_path / "out")
    assert warc_to_parquet(spark, str(tmp_path / "in"), out) == len(expected)
    written = read_table(spark, out, ["warc_id", "html_content"], CRAWL_RECORD)
    assert dict(rows(written)) == expected


def test_archives_without_coded_bodies_run_no_decoder(spark, tmp_path, monkeypatch):
    """A reading task has no second Python process beside it, however the records end."""

    def unused(*_):
        raise AssertionError("a decoder was planned")

    monkeypatch.setattr(warc, "undo_transfer", unused)
    plain = {n: c for n, c in CASES.items() if c[1] is None}
    (tmp_path / "a.warc").write_bytes(b"".join(record("response", n, c[0]) for n, c in plain.items()))
    got = {r["warc_id"]: r["html_content"] for r in warc_ingest(spark, str(tmp_path)).collect()}
    assert got == {f"<urn:{n}>": (t if t is not None else b.decode()) for n, (b, _, t) in plain.items()}


def test_coded_bodies_are_decoded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(warc, "BATCH_BYTES", 1000)
    bodies = [(i, None if i % 7 == 0 else gzip.compress(b"%d" % i * 400) if i % 3 else b"%d" % i, "gzip" if i % 3 else "") for i in range(100)]
    df = spark.createDataFrame(bodies, "id long, body binary, coding string").coalesce(1)
    got = dict(df.select("id", warc.undo_transfer(F.col("body"), F.col("coding"))).collect())
    assert got == {i: None if b is None else bytearray(b"%d" % i * (400 if i % 3 else 1)) for i, b, _ in bodies}


def test_damaged_archives(spark, tmp_path, way):
    """A false length takes nothing with it; a missing header is null; archives of one name do not replace each other."""
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "y").mkdir()
    false = record("response", "false", b"short").replace(b"Content-Length: ", b"Content-Length: 9000")
    nameless = record("response", "n", b"nameless").replace(b"WARC-Record-ID: <urn:n>\r\n", b"")
    torn = record("response", "torn", b"a" + b"\r\n\r\nWARC/1.0\r\n" + b"b")
    (tmp_path / "in" / "x" / "same.warc").write_bytes(false + nameless + record("response", "after", b"after") + torn)
    (tmp_path / "in" / "y" / "same.warc").write_bytes(record("response", "twin", b"twin"))
    got = {r["warc_id"]: r["html_content"] for r in warc_ingest(spark, str(tmp_path / "in")).collect()}
    assert got == {
        "<urn:false>": "short", None: "nameless", "<urn:after>": "after", "<urn:torn>": "a\r\n\r\nWARC/1.0\r\nb",
        "<urn:twin>": "twin",
    }


def test_archive_in_many_splits(spark, tmp_path, way):
    pages = spark.range(400).select(
        F.concat(F.lit("<urn:"), "id", F.lit(">")).alias("i"),
        F.concat(F.lit("http://h/"), "id").alias("u"),
        F.lit("2020").alias("d"),
        F.repeat(F.concat(F.lit("é\r\n\r\n"), "id"), 200).alias("h"),
    )
    path = str(tmp_path / "w")
    archive_lines(pages, "i", "u", "d", "h").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = warc_ingest(spark, path, glob="*.txt")
        assert way == "source" or records.rdd.getNumPartitions() > 10
        left = pages.select(F.col("i").alias("warc_id"), F.col("h").alias("html_content"))
        assert records.select("warc_id", "html_content").exceptAll(left).isEmpty()
        assert records.count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_archives_in_any_ranges(spark, tmp_path):
    """Plain and gzip archives give the same records however small the ranges, torn and nested ones included."""
    inner = record("response", "inner", b"in") + record("response", "deep", b"y\r\n\r\nWARC/1.0\r\nz")
    parts = [record("warcinfo", "w", b"", b"")]
    for i in range(40):
        body = (b"a" * (i * 37 % 300), b"x\r\n\r\nWARC/1.0\r\ny" * 5, b"q\r\n\r\n" + inner + b"end")[i % 3]
        parts.append(record("response", f"r{i}", body))
    parts.append(record("request", "q", b"q\r\n\r\n" + inner))  # dropped, and all that it holds
    parts.insert(9, record("response", "false", b"short").replace(b"Content-Length: ", b"Content-Length: 90"))
    (tmp_path / "in").mkdir()
    folder = tmp_path / "in"
    (folder / "plain.warc").write_bytes(b"".join(parts))
    (folder / "members.warc").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (folder / "whole.warc").write_bytes(gzip.compress(b"".join(parts)))
    (folder / "cut.warc").write_bytes(gzip.compress(parts[1]) + gzip.compress(parts[2])[:40])
    (folder / "empty.warc").write_bytes(b"")
    (folder / "_hidden.warc").write_bytes(parts[1])
    seen = {}
    for width in (50, 700, 1 << 26):
        records = warc._staged(spark, str(folder), "*.warc", "WARC/1.0", width)
        for r in records.collect():
            seen.setdefault((width, r["warc_filename"]), []).append((r["warc_id"], r["html_content"]))
    whole = sorted(seen[(1 << 26, "plain.warc")])
    assert len(whole) == 41 and ("<urn:false>", "short") in whole and "<urn:inner>" not in dict(whole)
    assert {k: sorted(v) == whole for k, v in seen.items() if k[1] not in ("cut.warc",)} == {
        (w, f): True for w in (50, 700, 1 << 26) for f in ("plain.warc", "members.warc", "whole.warc")
    }
    assert {tuple(v) for k, v in seen.items() if k[1] == "cut.warc"} <= {(("<urn:r0>", ""),), (("<urn:r0>", ""), ("<urn:r1>", None))}


def test_parquet_files_of_even_size(spark, tmp_path, monkeypatch):
    """Few files an archive, however many ranges it was read in."""
    pages = spark.range(3000).select(
        F.concat(F.lit("<urn:"), "id", F.lit(">")).alias("i"), F.lit("http://h/").alias("u"), F.lit("2020").alias("d"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.xxhash64("id", k))).alias("h"),
    )
    path, out = str(tmp_path / "w"), str(tmp_path / "out")
    archive_lines(pages, "i", "u", "d", "h").repartition(3).write.option("lineSep", "\r\n\r\n").text(path)
    monkeypatch.setattr(warc, "_staged", functools.partial(warc._staged, range_bytes=60_000))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        assert warc_to_parquet(spark, path, out, glob="*.txt") == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet")]
    assert len(list((tmp_path / "out").glob("warc_filename=*"))) == 3
    assert 3 < len(sizes) < 60 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]


HTML = {
    1: (None, None),
    2: ("", None),
    3: ("<html><script>var a='<p>x</p>'</script></html>", None),
    4: ("<body><!-- no --><p>One &amp; two</p><nav><p>menu</p></nav></body>", "One & two"),
    5: ("<table><tr><td>a<td>b</tr><tr><th>c</th><td>d</td></tr></table>", "a b\nc d"),
    6: ("<ul><li>x<ul><li>y</li></ul></li></ul>", "x\ny"),
    7: ("&eacute;&#233;&#xE9;&lt;b&gt;&unknown;&amp;lt;&#128512; &", "ééé<b>&unknown;&lt;😀 &"),
    8: ("<p>open <b>bold", "open bold"),
    9: ("<p><a href='/a'>link</a> <a href='/b'>link</a></p><p>text with <a href='/c'>a link</a></p>", "text with a link"),
    10: ("plain  text\t\there\r\n\r\n\r\nnext", "plain text here\nnext"),
    11: ("<p>kept</p><!-- never closed <p>gone</p>", "kept"),
    12: ("&nbsp;<p> </p>", None),
    14: ("<body><form><p>all in</p><p>a form</p></form></body>", "all in\na form"),
    15: ("<head><title>t</title><body><nav><p><a href='/x'>never</a> closed</p><script>x</script>", "never closed"),
    16: ("<p>&#00000065;&#x0000042;&#0;&#000;</p>", "AB\ufffd\ufffd"),
    17: ("<nav><script>only</script></nav>", None),
    13: ("<header><h1>Title</h1></header><p>body</p>", "Title\nbody"),
}


def test_html(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in HTML.items()], "id long, html string")
    assert dict(rows(html_extract(df, "html", "text"))) == {i: t for i, (_, t) in HTML.items() if t}


def test_unclosed_tags_take_linear_time(spark):
    for html in ("<a " * 333_333, "<nav" * 250_000, "</script" * 125_000, "<form><a href=x " * 62_500, " " * 1_000_000 + "x"):
        df = spark.createDataFrame([(html,)], "html string")
        start = time.time()
        assert html_extract(df, "html", "text").count() <= 1
        assert time.time() - start < 15


def test_boilerplate(spark):
    pages = [(1, "h", "menu\none"), (2, "h", "menu\ntwo"), (3, "h", "menu"), (4, "k", "menu\nmenu"), (5, None, "menu")]
    df = spark.createDataFrame(pages, "id long, host string, text string")
    assert rows(boilerplate_filter(df, "id", "host", "text", 2)) == [
        (1, "h", "one"), (2, "h", "two"), (4, "k", "menu\nmenu"), (5, None, "menu"),
    ]


def test_contracts(spark, tmp_path):
    good = spark.createDataFrame([("a", "b", "c", "d", 1)], "warc_id string, url string, date string, html_content string, n int")
    assert check_step(good, 2) is good
    with pytest.raises(SchemaMismatch, match="extracted_text: missing"):
        check_step(good, 3)
    with pytest.raises(SchemaMismatch, match="url: int, expected string"):
        check_schema(good.withColumn("url", F.lit(1)), FILTERED_PAGE)
    table = good.drop("n").withColumn("warc_filename", F.lit("x.warc"))
    write_table(table, str(tmp_path / "t"), "warc_filename")
    back = read_table(spark, str(tmp_path / "t"), schema=CRAWL_RECORD)
    assert rows(back) == [("a", "b", "c", "d", "x.warc")]


# --- element tree ------------------------------------------------------------------------------------


def plain_tree(tokens):
    """Matched elements ``{open: (close, level)}`` by one stack of open tags per name."""
    stacks, mates = {}, {}
    for pos, name, kind in tokens:
        stack = stacks.setdefault(name, [])
        if kind == 1:
            stack.append(pos)
        elif kind == -1 and stack:
            at = stack.pop()
            mates[at] = (pos, len(stack) + 1)
    return mates


def plain_main(tokens):
    """The pieces of the heaviest block element, element by element."""
    mates = plain_tree([(p, n, k) for p, _, n, k in tokens])
    inside = lambda pos, names: any(a <= pos < b for a, (b, _) in mates.items() if tokens[a][2] in names)
    hidden = [inside(p, tree.DROPPED_ELEMENTS) for p, *_ in tokens]

    def weight(p):
        _, tok, name, _ = tokens[p]
        if hidden[p]:
            return 0
        if name:
            return tree.TAG_WEIGHT
        return len("".join(tok.split())) * (tree.LINK_WEIGHT if inside(p, ["a"]) else 1)

    sums = {a: sum(weight(p) for p in range(a + 1, b + 1)) for a, (b, _) in mates.items() if tokens[a][2] in tree.CONTAINERS and not hidden[a]}
    if not sums:
        return mates, (-1, len(tokens)), hidden
    first = max(sums, key=lambda a: (sums[a], -a))
    return mates, (first, mates[first][0]), hidden


def test_element_tree_equals_a_plain_one(spark):
    rng = random.Random(8)
    names = ["div", "p", "a", "nav", "b", "td", "article", "br", "li"]

    def page():
        out = []
        for _ in range(rng.randint(0, 60)):
            name = rng.choice(names)
            out.append(rng.choice([f"<{name}>", f"<{name.upper()} class='x'>", f"</{name}>", f"</{name}>", "some text ", "&amp; é", "< 3", "<!doctype x>", f"<{name}/>"]))
        return "".join(out)

    pages = spark.createDataFrame([(i, page()) for i in range(300)], "id long, html string").repartition(8, "id").cache()
    tokens = tree.page_tokens(pages, "id", "html")
    got = {}
    for r in tree.subtree_weights(tree.element_tree(tokens, "id"), "id").collect():
        got.setdefault(r["id"], []).append(r)
    texts = {r["id"]: r["text"] for r in tree.main_text(pages, "html", "text").collect()}
    seen = 0
    for i, found in got.items():
        found.sort(key=lambda r: r["pos"])
        mates, (first, last), hidden = plain_main([(r["pos"], r["tok"], r["name"], r["kind"]) for r in found])
        assert {r["pos"]: (r["mate"], r["level"]) for r in found if r["mate"] is not None} == mates
        assert [r["hidden"] for r in found] == hidden
        words = "".join(r["tok"] for r in found[first + 1 : last] if not r["name"] and not r["tok"].startswith("<!") and not r["hidden"])
        plain = "".join(words.replace("&amp;", "&").split())
        assert "".join(texts.get(i, "").split()) == plain
        seen += bool(plain)
    assert seen > 150


def test_main_text_leaves_menus(spark):
    menu = "<div class=m>" + "".join(f"<a href=/{i}>section number {i}</a> " for i in range(30)) + "</div>"
    body = "<div><h1>Title</h1><p>A long first paragraph of the article.</p><p>And <a href=x>one link</a> &amp; more.</p></div>"
    cases = {
        1: f"<html><head><title>t</title></head><body>{menu}{body}<div>tiny</div></body></html>",
        2: f"<body>{menu}</div></b>{body}", 3: f"<nav><div>{body}", 4: "<script>x</script>", 5: None, 6: "", 7: "just text",
    }
    table = spark.createDataFrame([(i, h) for i, h in cases.items()] + [(7, "just text")], "id long, html string")
    got = sorted((r["id"], r["text"]) for r in tree.main_text(table, "html", "text").collect())
    article = "Title\nA long first paragraph of the article.\nAnd one link & more."
    assert got == [(1, article), (2, article), (3, article), (7, "just text"), (7, "just text")]


def test_main_text_of_long_pages_is_linear(spark):
    def seconds(n):
        page = "<div>" * n + "text <b>" * n + "</div>" * n
        table = spark.createDataFrame([(1, page)], "id long, html string")
        start = time.time()
        assert tree.main_text(table, "html", "text").count() == 1
        return time.time() - start

    seconds(100)
    assert seconds(60_000) < 30  # 1.1 MB, 180,000 nested tags


def test_partitions_of_the_element_tree_follow_the_splits(spark, tmp_path):
    page = "<html><body><div><p>some text of a page</p></div></body></html>"
    spark.createDataFrame([(i, page) for i in range(6)], "page_id bigint, html string").repartition(3).write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    found = tree.main_text(pages, "html", "text")
    splits = pages.rdd.getNumPartitions()
    assert "RepartitionByExpression [_row" in found._jdf.queryExecution().optimizedPlan().toString()
    assert f"], {tree.SPLIT_PARTS * splits}" in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("text = 'some text of a page'").count() == 6


@pytest.mark.parametrize("share", [-1, 0, 0.5, 1])
def test_blocks_without_links_are_judged_and_folded_as_those_with(spark, share):
    a, z = LINK_START, LINK_END
    blocks = [None, "", "text", "two words", f"{a}all{z}", f"half{a}half{z}", f"more text {a}x{z}", f"{a}open", z, f"{a}{z}"]
    prose = [
        b is not None and (n := len(b.replace(a, "").replace(z, ""))) > 0 and sum(len(x.split(z)[0]) for x in b.split(a)[1:]) <= share * n
        for b in blocks
    ]
    got = spark.createDataFrame(list(enumerate(blocks)), "i int, b string").select("i", F.coalesce(is_prose(F.col("b"), share), F.lit(False)))
    assert rows(got) == list(enumerate(prose))

    odd = ["a\u0085", "a \u0085\n", "a\n\u0085", " \u2028", "a \u0085\u0085", f"x {a} y{z} \u0085", f"{a} {z}\n{a}b{z}", "a\u00a0 \tb \n \n c ", ""]
    once = spark.createDataFrame([(t,) for t in odd], "t string").select(folded(F.col("t")).alias("t"))
    again = once.select(unmarked(F.col("t")).alias("new"), folded(F.regexp_replace("t", MARK_PATTERN, "")).alias("old")).collect()
    assert [r.new for r in again] == [r.old for r in again]
