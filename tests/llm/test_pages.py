"""URL verdicts and archives against SQL and brute force."""

import base64
import gzip
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from headway.llm import url_filters, warc
from headway.llm.queries import on_workers, op3_warc
from headway.session import fresh_dir

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, verdict string"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    on_workers(lambda session, folder: None)(spark, "")


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        (None, "", "", None),
        ("", "", "", None),
        ("no scheme.net/x", "", "", None),
        ("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
        ("https://example.net/EN/", "example.net", "/EN/", "net/"),
        ("https://x.net", "x.net", "", None),
        ("https://x.net#/a", "x.net", "", None),
        ("http://notexample.com/de/", "notexample.com", "/de/", None),
        ("http://u.example.com/de/1://2", "u.example.com", "/de/1://2", "example.com/de/"),
        ("://org/fr/", "org", "/fr/", "org/fr/"),
        ("x://ÄB.org/fr/\nz", "Äb.org", "/fr/\nz", "org/fr/"),
    ],
)
def test_rules(spark, url, host, path, rule):
    row = url_filters.with_rules(spark.createDataFrame([(url,)], "url string")).first()
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)


def linked_pages():
    """good.org is trusted, bad.net blocked; near.info is linked from the one, far.info links to the other."""
    return [
        (1, "http://good.org/fr/", "<img src=//near.info/i> and <a href='http://both.info/x'>b</a>, not lone.info", None),
        (2, "http://bad.net/x", "<a href='//bad.net'>", None),
        (3, "http://near.info/", None, None),
        (4, "http://far.info/", "<a href='https://BAD.net/y'>", None),
        (5, "http://farther.info/", '<A HREF = "//far.info">', None),
        (6, "http://both.info/", "<link href=ftp://bad.net>", None),
        (7, None, "<a href='//bad.net'>", None),
        (7, "http://lone.info/", "", None),
        (7, "http://lone.info/", "", None),
    ]


def test_trust_and_distrust_spread(spark):
    rows = url_filters.judge(spark.createDataFrame(linked_pages(), PAGES)).collect()
    verdicts = {row["host"]: (row["verdict"], row["trust"] > 0, row["distrust"] > 0) for row in rows}
    assert len(rows) == 9
    assert verdicts["near.info"] == ("allow", True, False)
    assert verdicts["far.info"] == ("block", False, True)
    assert verdicts["farther.info"] == ("block", False, True)
    assert verdicts["both.info"][1:] == (True, True)
    assert verdicts["lone.info"] == verdicts[""] == ("allow", False, False)


def test_links_in_a_page(spark):
    deep = ".".join(["d"] * 5000)
    html = f"""a.b //c.d http://e.f <script>x = "g.h"</script> href="//A.B/x" SRC = 'https://c.d?q' href=//e.f#z src="//g.h:80/"
        href="http://user@i.j/" href='/k.l' href="m.n" data-href="x-y:{'//'}o.p" href=" //q.r" <a href={deep} href="//{deep}"> href='//s.t'"""
    hosts = ["a.b", "c.d", "e.f", "g.h", "g.h:80", "user@i.j", "i.j", "k.l", "m.n", "o.p", "q.r", "s.t", deep, "start.org"]
    pages = [(0, "http://start.org/", html, None)] + [(i + 1, f"http://{h}/", None, None) for i, h in enumerate(hosts)]
    links = url_filters.host_links(url_filters.with_rules(spark.createDataFrame(pages, PAGES))).collect()
    assert {row["dst"] for row in links} == {"a.b", "c.d", "e.f", "g.h:80", "user@i.j", "o.p", "q.r", "s.t", deep}


def anchor(host):
    return f"<a href='https://{host}/'>x</a>"


def linked(arcs):
    """One page for each host of (src, dst) pairs."""
    hosts = sorted({host for arc in arcs for host in arc})
    page = lambda h: f"http://{h}/{'fr/' if h.endswith('org') else ''}"
    return [(i, page(h), " ".join(anchor(d) for s, d in arcs if s == h), None) for i, h in enumerate(hosts)]


def fixed_point(arcs, kind):
    """Scores by plain iteration until nothing changes."""
    hosts = {host for arc in arcs for host in arc}
    ways = set(arcs) if kind == "trust" else {(b, a) for a, b in arcs}
    base = {h: 150_000 for h in hosts if h.endswith("org" if kind == "trust" else "net")}
    degree = {h: sum(a == h for a, _ in ways) for h in hosts}
    scores = dict(base)
    while True:
        following = dict(base)
        for a, b in ways:
            if a in scores:
                following[b] = following.get(b, 0) + scores[a] * 85 // (100 * degree[a])
        if following == scores:
            return scores
        scores = following


def test_distrust_reaches_along_a_long_chain(spark):
    hosts = [f"h{i}.info" for i in range(14)] + ["h14.net"]
    rows = url_filters.judge(spark.createDataFrame(linked(list(zip(hosts, hosts[1:]))), PAGES)).collect()
    assert {row["host"]: row["verdict"] for row in rows} == dict.fromkeys(hosts, "block")


def graphs():
    rng = random.Random(4)
    hosts = [f"h{i}.{'org' if i % 5 == 0 else 'net' if i % 7 == 0 else 'info'}" for i in range(30)]
    yield {(h, d) for h in hosts for d in rng.sample(hosts, 3) if d != h}
    yield {("a.org", "b.info"), ("b.info", "c.info"), ("c.info", "a.org"), ("c.info", "d.net"), ("d.net", "d2.info"), ("d2.info", "d.net")}


@pytest.mark.parametrize("arcs", graphs())
def test_scores_equal_an_exact_solution(spark, arcs):
    pages = spark.createDataFrame(linked(arcs), PAGES)
    rows = url_filters.judge(pages).collect()
    for kind in ("trust", "distrust"):
        scores = fixed_point(arcs, kind)
        assert {row["host"]: row[kind] for row in rows} == {h: scores.get(h, 0) for arc in arcs for h in arc}
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR, verdict VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?, ?, ?)", linked(arcs))
    names = ("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
    expected = duck.execute(f"SELECT {', '.join(names)} FROM ({url_filters.judge_sql()})").fetchall()
    assert sorted(expected) == sorted(tuple(row[name] for name in names) for row in rows)


def test_no_python_in_url_filters(spark):
    plan = url_filters.judge(spark.createDataFrame(linked_pages(), PAGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert url_filters.judge(spark.createDataFrame([], PAGES)).count() == 0


# --- Archives


def brute_records(pages):
    first = {}
    for page, _, html, *_ in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    records = []
    for page, _, html, *_ in pages:
        data = (html or "").encode()
        head = first.get(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        records.append((page, len(data), digest, "response" if head == page else "revisit", None if head == page else head))
    return sorted(records, key=repr)


def as_records(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted((tuple(row) for row in rows), key=repr)


def test_odd_pages_survive_the_archive(spark, monkeypatch):
    pages = [(i, f"http://hot.example.com/p{i % 3}", "same" if i % 2 else f"é {i}\r\n\r\n", "v") for i in range(60)]
    pages += [(100, None, None, "v"), (101, "", "", "v"), (102, "x://a\r\nWARC-Type: evil/", "x" * 300_000, "v"), (102, "other", "y", "v")]
    pages += [(103, "http://a.b/", "z", "v")] * 3 + [(None, "http://a.b/", "same", "v")]
    assert as_records(warc.archived(spark.createDataFrame(pages, PAGES))) == brute_records(pages)
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_lookup_reads_all_lines_of_a_key_across_blocks(spark):
    pages = [(i // 20, f"http://s{i % 4}.org/a", f"text {i}", None) for i in range(200)]
    folder = fresh_dir(spark, "warc")
    captures = warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(5), folder)
    top = warc.write_index(captures, folder, block_lines=3)
    index = warc.CaptureIndex(folder, top)
    for host in range(4):
        for page in range(10):
            lines = list(index.find(f"org,s{host})/a", page))
            found = {warc.read_record(index.reader.read(*line[2:]))["payload"] for line in lines}
            assert found == {f"text {i}".encode() for i in range(page * 20, page * 20 + 20) if i % 4 == host}
    assert list(index.find("org,s9)/a", 1)) == [] and list(index.find("", None)) == []


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab", None), (2, "v", "ab", None), (3, "w", "abc", None), (4, "w", "abc", None)], PAGES)
    folder = fresh_dir(spark, "warc")
    places = warc.write_archives(pages, folder, min_bytes=3)
    assert {row["page_id"]: row["refers_to"] for row in warc.read_captures(places, folder).collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_damage_is_noticed():
    member = warc.write_record(1, "http://a/", b"payload", None)
    assert warc.read_record(member)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.read_record(gzip.compress(gzip.decompress(member).replace(b"payload\r", b"paYload\r")))


def test_op3_equals_brute_force(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert as_records(op3_warc(spark, SF_DIR)) == brute_records(pages)


def test_records_are_read_by_more_than_one_task(spark, monkeypatch):
    """Reads are dealt out by the bytes of the records, look-ups by the number of keys."""
    monkeypatch.setattr(warc, "BYTES_PER_TASK", 5_000)
    monkeypatch.setattr(warc, "KEYS_PER_TASK", 20)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    folder = fresh_dir(spark, "warc-tasks")
    top = warc.write_index(warc.write_archives(pages, folder), folder)
    keys = pages.select(warc.url_key("url").alias("url_key"), "page_id")
    places = warc.look_up(keys, folder, top)
    assert places.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    read = warc.read_captures(places, folder).select("page_id", F.spark_partition_id().alias("p")).collect()
    assert len(read) == pages.count() and len({row["p"] for row in read}) > 1
