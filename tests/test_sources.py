import json

import pytest
from pyspark.sql import functions as F

from newsloom.plans import report
from newsloom.sources import feeds, landing, pages

RSS = """<rss version="2.0"><channel><title>Feed</title>
<item><title>One &amp; two</title><link>https://x.example/a?u=1</link><pubDate>Wed, 15 Jan 2025 06:00:00 +0000</pubDate><description>&lt;p&gt;Hello  there&lt;/p&gt;</description><category>c1</category></item>
<item><title>Three</title><link>https://x.example/b</link></item></channel></rss>"""
ATOM = """<feed><title>F</title><entry><title>A</title><id>1</id><link href="https://x.example/1" rel="alternate"/><published>2025-01-15T06:00:00Z</published><author><name>Ann</name></author></entry></feed>"""
SITEMAP = """<urlset><url><loc>https://x.example/news/1</loc><lastmod>2025-01-15</lastmod></url><url><loc>https://x.example/about</loc></url></urlset>"""


def test_rss(spark):
    df = spark.createDataFrame([("s", RSS), ("bad", "no xml"), ("none", None)], "source_id string, payload string")
    rows = feeds.rss_items(df, ranked=True).orderBy("rank_position").collect()
    assert [r["title"] for r in rows] == ["One & two", "Three"]
    assert rows[0]["canonical_url"] == "https://x.example/a" and rows[0]["published_at"] == "2025-01-15T06:00:00+00:00"
    assert rows[0]["summary"] == "Hello there" and rows[0]["source_tags"] == ["c1"] and rows[1]["summary"] == ""


def test_atom_and_sitemap(spark):
    a = feeds.atom_items(spark.createDataFrame([("s", ATOM)], "source_id string, payload string")).first()
    assert (a["title"], a["source_url"], a["byline"], a["published_at"]) == ("A", "https://x.example/1", "Ann", "2025-01-15T06:00:00+00:00")
    m = feeds.sitemap_pages(spark.createDataFrame([("s", SITEMAP)], "source_id string, payload string"), "/news/").collect()
    assert [r["url"] for r in m] == ["https://x.example/news/1"]


def test_json_listing_and_jsonp(spark):
    doc = json.dumps({"data": {"items": [{"t": "A", "ts": 1736917200, "x": {"y": "sum"}}, {"t": "B", "ts": 1736917200000, "tags": ["k"]}]}})
    df = spark.createDataFrame([("s", doc), ("p", f"cb({doc});"), ("bad", "{")], "source_id string, payload string")
    rows = feeds.json_items(df, "$.data.items", {"title": "$.t", "published_at": "$.ts", "summary": ["$.z", "$.x.y"], "source_tags": "$.tags"}, ranked=True).collect()
    assert len(rows) == 4 and {r["published_at"] for r in rows} == {"2025-01-15T05:00:00+00:00"}
    assert {(r["title"], r["summary"], tuple(r["source_tags"])) for r in rows} == {("A", "sum", ()), ("B", "", ("k",))}


def test_enriched(spark):
    ranked = spark.createDataFrame([("u1", ""), ("u2", "own"), ("u3", "")], "k string, summary string")
    feed = spark.createDataFrame([("u1", "feed"), ("u2", "feed")], "k string, summary string")
    assert {(r["k"], r["summary"]) for r in feeds.enriched(ranked, feed, "k", ["summary"]).collect()} == {("u1", "feed"), ("u2", "own"), ("u3", "")}
    assert feeds.enriched(ranked, feed, "k", ["summary"], inner=True).count() == 2


def test_pages(spark):
    html = '<html><head><title>T</title><meta content="M" property="og:title"></head><body><nav><p>menu</p></nav><p>One <b>two</b></p><p>Three</p><a href="/x">Go</a><a href="/x">Again</a></body></html>'
    df = spark.createDataFrame([(html,), (None,)], "p string")
    r = df.select(pages.page_title(F.col("p")).alias("t"), pages.html_paragraphs("p").alias("ps"), pages.html_links("p").alias("ls")).collect()
    assert r[0]["t"] == "M" and r[0]["ps"] == ["One two", "Three"] and [(x["href"], x["label"]) for x in r[0]["ls"]] == [("/x", "Go")]
    assert r[1]["ps"] is None
    md = spark.createDataFrame([("x\nMarkdown Content:\n# H\n\nSee [this](u) now\n\nStop here\n\nmore",)], "m string")
    assert md.select(pages.markdown_paragraphs(F.col("m"), "Markdown Content:", ["Stop here"]).alias("x")).first()["x"] == ["H", "See this now"]


def test_landing(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    specs = [{"source_id": "a", "protocol": "rss", "location": str(tmp_path / "*.xml")}, {"source_id": "b", "location": str(tmp_path / "none")}, {"source_id": "c", "location": str(tmp_path / "a.xml"), "delay": 3}]
    got = {r["source_id"]: r for r in landing.read_payloads(spark, specs, timeout=1).collect()}
    assert got["a"]["status"] == "ok" and got["b"]["status"] == "failed" and got["c"]["status"] == "timeout"
    assert landing.source_specs("x:5, y:bad, z:-1, w") == [{"id": "x", "limit": 5}, {"id": "y", "limit": 20}, {"id": "z", "limit": 1}, {"id": "w", "limit": 20}]
    with pytest.raises(ValueError):
        landing.requested([], {"p": []}, "q")


def test_items_and_documents(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps([{"title": "A", "source_id": "s"}, {"title": None, "source_id": "t"}]))
    df = landing.read_items(spark, str(tmp_path / "i.json"))
    assert df.count() == 2 and df.filter("title = ''").count() == 1
    landing.write_items(df, str(tmp_path / "out"))
    assert landing.read_items(spark, str(tmp_path / "out")).count() == 2
    landing.write_document(df, str(tmp_path / "d.json"), {"n": 2})
    assert len(json.loads((tmp_path / "d.json").read_text())["rows"]) == 2
    with pytest.raises(ValueError):
        landing.write_document(df, str(tmp_path / "d.json"), {}, most=1)


def test_report(spark):
    df = spark.createDataFrame([("g1", i, f"t|{i}") for i in range(5)] + [("g2", 9, "<x>")], "g string, n int, title string")
    rows = report.top_rows(df, "g", [F.col("n")], 2)
    assert [(r["g"], r["n"]) for r in rows] == [("g1", 0), ("g1", 1), ("g2", 9)]
    assert "t\\|0" in report.markdown(rows, "g", ["title"], "R") and "&lt;x&gt;" in report.page(rows, "g", ["title"], "R")


def test_registry(spark, tmp_path):
    from newsloom.sources import registry

    (tmp_path / "r.xml").write_text(RSS)
    (tmp_path / "m.xml").write_text(SITEMAP)
    (tmp_path / "j.json").write_text(json.dumps({"items": [{"t": "J", "u": "https://x.example/j"}]}))
    (tmp_path / "l.html").write_text('<a href="/news/1">First</a><a href="/about">About</a><a href="https://y.example/news/2">Second</a>')
    sources = [
        registry.Source("r", "rss", str(tmp_path / "r.xml"), ranked=True, section="world", drop="/b$"),
        registry.Source("m", "sitemap", str(tmp_path / "m.xml"), options={"marker": "/news/"}),
        registry.Source("j", "json", str(tmp_path / "j.json"), options={"list_path": "$.items", "fields": {"title": "$.t", "source_url": "$.u"}}),
        registry.Source("l", "links", str(tmp_path / "l.html"), options={"pattern": "/news/", "base": "https://x.example"}),
        registry.Source("gone", "rss", str(tmp_path / "none.xml")),
    ]
    items, summary = registry.ingest(spark, sources, ["r", "m", "j", "l", "gone", "nobody", "r"])
    got = {(r["source_id"], r["source_url"], r["rank_position"], r["section"]) for r in items.collect()}
    assert got == {("r", "https://x.example/a?u=1", 1, "world"), ("m", "https://x.example/news/1", 0, ""), ("j", "https://x.example/j", 0, ""), ("l", "https://x.example/news/1", 1, ""), ("l", "https://y.example/news/2", 2, "")}
    state = {r["source_id"]: (r["status"], r["n_items"]) for r in summary.collect()}
    assert state == {"r": ("ok", 1), "m": ("ok", 1), "j": ("ok", 1), "l": ("ok", 2), "gone": ("failed", 0), "nobody": ("missing_adapter", 0)}
    assert registry.ingest(spark, sources, ["nobody"])[0].count() == 0


def test_page_functions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first()["x"]
    a = F.array(F.lit("Subscribe now"), F.lit("Text one"), F.lit("by staff"))
    assert pick(pages.filtered_paragraphs(a, F.lit("s"), {"s": "^by "}, "subscribe")) == ["Text one"]
    assert pick(pages.filtered_paragraphs(a, F.lit("t"), {"s": "^by "})) == ["Subscribe now", "Text one", "by staff"]
    assert pick(pages.host_allowed(F.lit("news.x.example"), ["x.example"])) and not pick(pages.host_allowed(F.lit("ax.example"), ["x.example"]))
    lines = F.array(*[F.lit(x) for x in ("a", "b", "3:15", "c", "", "d" * 200, "e")])
    assert pick(pages.posts(lines, r"^\d+:\d\d$")) == ["a b", "c", "d" * 200, "e"]
    assert pick(pages.balanced_json(F.lit('var x = {"a": "]}", "b": [1]}; y'), F.lit("var x"))) == '{"a": "]}", "b": [1]}'
    assert pick(pages.balanced_json(F.lit("var x = [1"), F.lit("var x"))) is None


def test_repair_and_decisions(spark):
    from newsloom.functions import text
    from newsloom.operators import relational as rel

    bad = "Zürich – “quoted”".encode().decode("latin-1")
    rows = spark.createDataFrame([(bad,), ("Zürich",), ("Ã",), (None,), ("世界",)], "x string")
    assert [r[0] for r in rows.select(text.repair_bytes(F.col("x"))).collect()] == ["Zürich – “quoted”", "Zürich", "Ã", None, "世界"]
    pairs = spark.createDataFrame([(1.0, 2), (0.5, 2), (0.1, None)], "s double, n int")
    rules = [("same", F.col("s") == 1, True, 1.0), ("far", F.col("n") > 1, False, 0.0), ("near", F.col("s") > 0, True, F.col("s"))]
    assert [(r["merges"], r["reason"], r["confidence"]) for r in rel.decided(pairs, rules).collect()] == [(True, "same", 1.0), (False, "far", 0.0), (True, "near", 0.1)]
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    cache = spark.createDataFrame([("a", "old")], "k string, v string")
    out, new = rel.with_cache(df, "k", "v", cache, lambda m: m.withColumn("v", F.upper("k")))
    assert sorted(map(str, (r["v"] for r in out.collect()))) == ["B", "B", "None", "old"] and new.count() == 1


def test_web_addresses_are_read_like_files(spark):
    """GET with headers, POST of a form and of JSON, JSONP, bytes that are no UTF-8, an error code and a slow answer."""
    import http.server
    import threading
    import time as clock

    class Page(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/slow":
                clock.sleep(5)
            self.send_response(404 if self.path == "/gone" else 200)
            self.end_headers()
            self.wfile.write({"/p": b'cb({"a": 1});', "/bad": b"a\xffb"}.get(self.path, self.headers.get("X-Key", "none").encode()))

        def do_POST(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(self.rfile.read(int(self.headers["Content-Length"])))

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    specs = [
        {"source_id": "get", "location": f"{base}/x", "headers": {"X-Key": "k"}}, {"source_id": "form", "location": f"{base}/f", "form": {"q": "a b"}}, {"source_id": "json", "location": f"{base}/j", "json": {"q": 1}},
        {"source_id": "jsonp", "location": f"{base}/p", "jsonp": True}, {"source_id": "bad", "location": f"{base}/bad"}, {"source_id": "gone", "location": f"{base}/gone"}, {"source_id": "slow", "location": f"{base}/slow"},
    ]
    got = {r["source_id"]: r for r in landing.read_payloads(spark, specs, timeout=2).collect()}
    server.shutdown()
    assert {k: got[k]["payload"] for k in ("get", "form", "json", "jsonp", "bad")} == {"get": "k", "form": "q=a+b", "json": '{"q": 1}', "jsonp": '{"a": 1}', "bad": "a�b"}
    assert got["gone"]["status"] == "failed" and "404" in got["gone"]["error"] and got["slow"]["status"] in ("timeout", "failed")


def test_page_outcomes(spark):
    from pyspark.sql import functions as F

    rows = [(None, 0, 0, False, False), (403, 0, 0, False, False), (500, 9, 9000, False, False), (200, 5, 1200, False, False), (200, 2, 300, False, False), (200, 2, 300, True, False), (200, 1, 50, False, False), (200, 0, 0, True, None), (200, 1, 180, False, True)]
    df = spark.createDataFrame(rows, "s int, n int, k int, c boolean, b boolean")
    got = [tuple(r[0]) for r in df.select(pages.page_outcome(*map(F.col, "snkcb"))).collect()]
    assert got == [
        ("partial_only", "request_failed"), ("partial_only", "http_403_blocked"), ("partial_only", "http_500"), ("full_text_capable", "body_extracted"), ("mixed", "partial_body_extracted"),
        ("mixed", "body_extracted_with_challenge_markers"), ("partial_only", "body_too_short"), ("partial_only", "challenge_or_access_denied"), ("mixed", "short_article_body_extracted"),
    ]


def test_lists_in_json_ld_trends_and_encoded_bodies(spark):
    page = """<html><script type="application/ld+json">{"@type": "ItemList", "itemListElement": [{"position": 1, "url": "https://a.x/1", "name": "One"}, {"position": 2, "item": {"url": "https://a.x/2?q=1", "name": "Two"}}, {"position": 3, "url": "https://a.x/1", "name": "Again"}, {"position": 4}]}</script>
    <script type="application/ld+json">no json</script><script type="application/ld+json">{"mainEntity": {"itemListElement": [{"url": "https://a.x/3", "name": "Three"}]}}</script></html>"""
    df = spark.createDataFrame([("a", page), ("b", "<html></html>"), ("c", None)], "source_id string, payload string")
    got = feeds.json_ld_items(df).orderBy("rank_position").collect()
    assert [(r["source_id"], r["title"], r["canonical_url"], r["rank_position"]) for r in got] == [("a", "One", "https://a.x/1", 1), ("a", "Two", "https://a.x/2", 2), ("a", "Three", "https://a.x/3", 3)]
    trends = """<rss xmlns:ht="https://t.x"><channel><item><title>Tide &amp; wind</title><link>https://t.x/1</link><pubDate>Wed, 15 Jan 2025 06:00:00 +0000</pubDate><ht:approx_traffic>200+</ht:approx_traffic>
    <ht:news_item><ht:news_item_title>Storm nears</ht:news_item_title><ht:news_item_url>https://n.x/a</ht:news_item_url><ht:news_item_source>N</ht:news_item_source></ht:news_item>
    <ht:news_item><ht:news_item_title>Second</ht:news_item_title><ht:news_item_url>https://n.x/b</ht:news_item_url></ht:news_item></item><item><title>Bare</title><link>https://t.x/2</link></item></channel></rss>"""
    got = feeds.trend_items(spark.createDataFrame([("t", trends)], "source_id string, payload string")).orderBy("rank_position").collect()
    assert [(r["title"], r["source_url"], r["summary"], r["byline"], r["rank_position"]) for r in got] == [("Tide & wind", "https://n.x/a", "Storm nears | traffic: 200+", "N", 1), ("Bare", "https://t.x/2", "", "", 2)]
    assert got[0]["published_at"] == "2025-01-15T06:00:00+00:00"
    rss = """<rss xmlns:content="https://c.x"><channel><item><link>https://p.x/1</link><content:encoded><![CDATA[<p>This paragraph is long enough to stay.</p><script>no()</script><p>Too short</p><ul><li>An item of a list that is long enough</li></ul>]]></content:encoded></item><item><link>https://p.x/2</link></item></channel></rss>"""
    got = feeds.encoded_bodies(spark.createDataFrame([("p", rss)], "source_id string, payload string")).collect()
    assert [(r["source_url"], r["body_text"].split("\n")) for r in got] == [("https://p.x/1", ["This paragraph is long enough to stay.", "An item of a list that is long enough"])]
