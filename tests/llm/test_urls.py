from netbaseline.llm import url_reputation as U


def test_host_path_rule(spark):
    urls = ["https://A.Example.NET/en/1?x#y", "http://example.net/de/", "http://x.example.com/de/9", "https://b.org/fr/x",
            "https://borg/fr/", "no scheme", None, "", "a://b://c/d", "http://?q", "http://h#f", "http://net/", "ftp://net",
            "http://example.net/en"]
    want = [("a.example.net", "/en/1", "example.net/en/"), ("example.net", "/de/", "net/"),
            ("x.example.com", "/de/9", "example.com/de/"), ("b.org", "/fr/x", "org/fr/"), ("borg", "/fr/", None),
            ("", "", None), ("", "", None), ("", "", None), ("b:", "//c/d", None), ("", "", None), ("h", "", None),
            ("net", "/", "net/"), ("net", "", None), ("example.net", "/en", "net/")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in U.judge_urls(pages, labels).collect()}
    assert [(out[i]["host"], out[i]["path"], out[i]["rule"]) for i in range(len(urls))] == want
    assert out[0]["verdict"] == "allow" and out[1]["verdict"] == "block" and out[5]["verdict"] == "allow"
    assert U.judge_urls(pages.where("false"), labels).collect() == []


def test_reputation_blocks_bad_hosts_and_shrinks_small_ones(spark):
    pages, labels, k = [], [], 0
    for host, n, bad in (("good.a.com", 200, 4), ("bad.b.com", 200, 195), ("tiny.c.com", 1, 1), ("half.d.com", 100, 30)):
        for j in range(n):
            pages.append((k, f"http://{host}/en/{k}"))
            labels.append((k, 0 if j < bad else 1, None))
            k += 1
    pages += [(k, "http://bad.b.com/other"), (k + 1, "http://new.z.com/1x"), (None, None)]
    labels += [(None, 0, 0), (5, None, None)]
    out = U.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                       spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    said = {r["host"]: r["verdict"] for r in out}
    assert said == {"good.a.com": "allow", "bad.b.com": "block", "tiny.c.com": "allow", "half.d.com": "allow",
                    "new.z.com": "allow", "": "allow"}
    rate = {r["host"]: r["posterior"] for r in out}
    assert 0.9 < rate["bad.b.com"] < 195 / 200 and 4 / 200 < rate["good.a.com"] < 0.1 and rate["tiny.c.com"] < 0.95


def test_query_sql_on_labels_that_depend_on_the_host(spark, tmp_path):
    """The registered SQL over pages whose hosts are good, bad, small, alone in their domain or suffix."""
    import random

    import duckdb

    from netbaseline.llm.oracles import OP9
    rnd, pages, labels, k = random.Random(3), [], [], 0
    for host, n, rate in [("a.x.com", 60, 0.9), ("b.x.com", 40, 0.95), ("c.y.com", 80, 0.05), ("d.y.com", 1, 1.0), ("e.z.com", 30, 0.6),
                          ("www.q.org", 50, 0.1), ("q.io", 3, 1.0), ("h.net", 25, 0.5), ("f.w.io", 70, 0.97), ("one.two.three", 1, 1.0)]:
        for _ in range(n):
            pages.append((k, f"http://{host}/p/{k}"))
            labels.append((k, int(rnd.random() >= rate), 0))
            k += 1
    p = spark.createDataFrame(pages, "page_id long, url string")
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    said = U.judge_urls(p, l).select("page_id", "host", "path", "rule", "verdict").collect()
    p.write.parquet(f"{tmp_path}/pages.parquet")
    l.write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({OP9})").fetchall()
    assert sorted(map(tuple, said)) == sorted(want)
    verdict = {r["host"]: r["verdict"] for r in said}
    assert verdict["a.x.com"] == verdict["b.x.com"] == verdict["f.w.io"] == "block"
    assert verdict["d.y.com"] == verdict["one.two.three"] == verdict["c.y.com"] == "allow"
