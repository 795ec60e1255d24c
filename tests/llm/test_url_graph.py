"""URL filter: rules, link graph against SQL and against dense powers, odd rows."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from compare import difference
from tollspark.llm import linkgraph, queries
from tollspark.llm.oracles import llm_oracles

PAGE = "page_id long, url string, html string"


def linked_pages(seed=1, pages=300):
    draw = random.Random(seed)
    hosts = [f"h{i}.{top}" for i in range(10) for top in ("org", "com", "net", "example.org")] + ["X.org"]
    rows = []
    for i in range(pages):
        links = "".join(f"<p><a class=x href={q}{s}//{draw.choice(hosts)}/p{q}>y</a>" for q, s in [
            (draw.choice(['"', "'", ""]), draw.choice(["http:", "https:", "", "HTTPS:"])) for _ in range(draw.randrange(4))])
        if i % 9 == 0:
            links = "<!-- <a href=http://hidden.net/> --><script><a href='http://h2.net'></script>" + links
        path = draw.choice(["/fr/a", "/de/b", "/en/1", "/en/7", "/es/", ""]) + draw.choice(["", "?q=1", "#x"])
        rows.append((i, f"http://{draw.choice(hosts)}{path}", links))
    return rows + [(900, None, "x"), (901, "no url", None), (901, "no url", None), (None, "http://", ""),
                   (902, "http://lonely.net/", "<script> <a href=http://h1.org/>")]


def test_linked_pages_match_sql(spark, tmp_path):
    folder = str(tmp_path / "pages.parquet")
    spark.createDataFrame(linked_pages(), PAGE).coalesce(1).write.parquet(folder)
    connection = duckdb.connect()
    connection.execute(f"create view pages as select * from '{folder}/*.parquet'")
    got = queries.op11_url_graph(spark, str(tmp_path))
    assert difference(got, connection, llm_oracles()["op11_url_graph"]) is None
    assert got.where("verdict = 'block' and rule is null").count() and got.where("page_id = 901").count() == 2


def test_propagation_sums_the_walks_from_the_seeds(spark):
    draw, names = random.Random(7), [f"h{i}" for i in range(30)]
    edges = [(a, b, draw.randrange(1, 5)) for a in names for b in draw.sample(names, draw.randrange(4)) if a != b]
    edges += [("h0", name, 1) for name in names[1:] if not any(e[:2] == ("h0", name) for e in edges)]  # a hub
    seeds = [("trust", "h1", 600_000_000_000), ("trust", "h2", 400_000_000_000), ("distrust", "h3", 10 ** 12)]
    got = linkgraph.propagate(spark.createDataFrame(seeds, "kind string, host string, mass long"),
                              spark.createDataFrame(edges, "source string, target string, weight long"), rounds=20)
    found = {(row.kind, row.host): row.mass for row in got.collect()}
    weight = np.zeros((30, 30))
    for a, b, w in edges:
        weight[int(a[1:]), int(b[1:])] = w
    for kind, matrix in (("trust", weight), ("distrust", weight.T)):
        share = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1)
        start = np.zeros(30)
        for of, host, mass in seeds:
            start[int(host[1:])] += mass * (of == kind)
        want = sum(np.linalg.matrix_power(0.85 * share.T, n) @ start for n in range(21))
        assert np.allclose([found.get((kind, name), 0) for name in names], want, rtol=1e-9, atol=1e3)


def test_longest_rule_and_boundaries(spark):
    rules = linkgraph.rule_table(spark, [("allow", "a.org/"), ("block", "a.org/x"), ("block", "A.org/xy/"), ("allow", "a.org/xy/"),
                                         ("block", "b.a.org/x"), ("allow", "c.d.e.f/")])
    urls = ["http://a.org/", "http://a.org", "http://a.org/xyz", "http://a.org/xy/", "http://q.B.a.org/x", "http://ba.org/",
            "http://c.d.e.f/p?x#y", "http://d.e.f/", "ftp://a.org?/x", "x://y://a.org/", "http://a.org:80/", "a.org/", None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    found = {row.page_id: row for row in linkgraph.with_rules(pages, rules, ["page_id"]).select("kept.page_id", "host", "path", "rule",
                                                                                             "action").collect()}
    assert [found[i].rule for i in range(14)] == ["a.org/", None, "a.org/x", "A.org/xy/", "b.a.org/x", None, "c.d.e.f/", None, None,
                                                 None, None, None, None, None]
    assert found[3].action == "block" and (found[6].host, found[6].path) == ("c.d.e.f", "/p") and found[8].path == ""
    assert (found[9].host, found[9].path) == ("y:", "//a.org/")


def test_empty_tables_and_no_rules(spark):
    pages = spark.createDataFrame(linked_pages(pages=20), PAGE).withColumn("score", F.lit("clash"))
    nothing = linkgraph.rule_table(spark, [("allow", "org/")]).limit(0)
    assert linkgraph.judge(pages, nothing, ["page_id", "html"]).where("verdict = 'allow' and rule is null").count() == 25
    some = linkgraph.rule_table(spark, queries.URL_RULES)
    assert linkgraph.judge(pages.limit(0), some, ["page_id"]).count() == 0
    assert linkgraph.judge(pages, some, ["page_id"], rounds=0, otherwise="block").count() == 25
