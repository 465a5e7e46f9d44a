"""Hosts of many labels."""

from threadloom.llm import urls


def test_entries_of_any_number_of_labels(spark):
    deep = ".".join("abcdefghij") + ".example.org"
    captures = spark.createDataFrame([(1, f"http://w.x.{deep}/p"), (2, f"http://{deep}/"), (3, "http://w.example.org/")], "page_id long, url string")
    captures = captures.selectExpr("*", "DATE '2024-05-01' AS fetched_on")
    entries = spark.createDataFrame([("spam", "block", "host", deep, "add", "2024-01-01")], "list string, effect string, kind string, pattern string, action string, dated string")
    got = {r.page_id: (r.blocks, r.blocked) for r in urls.filter_urls(captures, entries).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (0, False)}


def test_hosts(spark):
    given = {
        "http://Example.COM./a/": ("example.com", "example.com/a"),
        "https://u:p@[2001:DB8::1]:80/x?y#z": ("[2001:db8::1]", "[2001:db8::1]/x"),
        "http://a.b:8080": ("a.b", "a.b"),
        "no address": ("", ""),
    }
    df = spark.createDataFrame([(u,) for u in given], "url string")
    got = {r.url: (r.host, r.address) for r in df.select("url", *[c.alias(n) for c, n in zip(urls.url_parts(), ("host", "address"))]).collect()}
    assert got == given
