from pyspark.sql import functions as F

from lexquarry.llm.line_dedup import host, line_dedup, page_lines


def test_lines(spark):
    html = "<html><head><title>T</title><script>var a='<p>';</script></head><body><!-- c --><p> one &amp;amp; <b>two</b><br>three</p><style>x</style>&nbsp;<div>  </div></body>"
    assert spark.createDataFrame([(html,)], "h string").select(page_lines(F.col("h"))).first()[0] == ["T", "one &amp; two", "three"]
    assert spark.createDataFrame([(None,)], "h string").select(page_lines(F.col("h"))).first()[0] == []


def test_hosts(spark):
    urls = ["http://User@A.example:80/x", "https://b.example?q", "nonsense", None, "ftp://c#d"]
    assert [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(host(F.col("u"))).collect()] == ["a.example", "b.example", "", "", "c"]


def test_boilerplate_is_relative_to_its_host(spark):
    page = lambda i, h, *lines: (i, f"http://{h}/{i}", "".join(f"<p>{x}</p>" for x in lines), "x")
    rows = [page(i, "a", "menu", f"text {i}", "menu") for i in range(8)] + [page(10 + i, "b", "menu" if i < 2 else f"o {i}", f"text {i}") for i in range(10)] + [page(30, "c", "menu"), page(30, "c", "menu"), (40, None, None, None)]
    got = {}
    for r in line_dedup(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect():
        got.setdefault(r["page_id"], []).append((r["n_lines"], r["n_dropped"], r["text"]))
    assert got[0] == [(3, 2, "text 0")] and got[10] == [(2, 0, "menu\ntext 0")]
    assert got[30] == [(1, 0, "menu")] * 2 and got[40] == [(0, 0, "")]


def test_empty(spark):
    assert line_dedup(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_much_boilerplate_gives_the_same(spark, sf_dir, monkeypatch):
    """Beyond the broadcast, hosts are joined by a shuffle or, if hot, still broadcast."""
    from lexquarry.llm import line_dedup as L

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    few = sorted(map(tuple, line_dedup(pages, 0.2, 2).collect()))
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, line_dedup(pages, 0.2, 2).collect())) == few and any(r[3] for r in few)


def test_long_page_and_a_share_equal_to_the_ratio(spark):
    long = "".join(f"<p>line {i}</p>" for i in range(30_000)) + "<p>" + "x" * 1_000_000 + "</p>"
    rows = [(i, "http://h/", f"<p>own {i}</p>" + ("<p>three</p>" if i < 3 else "") + ("<p>four</p>" if i < 4 else ""), 1, 2) for i in range(9)] + [(9, "http://h/", long, 1, 2)]
    got = {r["page_id"]: r for r in line_dedup(spark.createDataFrame(rows, "page_id long, url string, html string, lines int, pages int")).collect()}
    assert got[0]["text"] == "own 0\nthree" and got[3]["text"] == "own 3"
    assert got[9]["n_lines"] == 30_001 and got[9]["n_dropped"] == 0
