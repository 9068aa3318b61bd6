"""URL filter: rules by hand, model on unseen names, SQL oracle, edge cases."""
import duckdb

from llm_help import SF001, SF01
from tessera.llm import url_filter
from tessera.llm.queries import op4_url_filter


def judged(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [r.asDict() for r in url_filter.judge(df).orderBy("page_id").collect()]


def test_rules_and_parts(spark):
    got = judged(spark, ["https://a.example.com/en/1?x#y", "http://WWW.Example.com/en/", "http://x.com/",
                         "http://com", "http://x.net/fr/a", "http://xnet/es/", None, "", "no scheme/en/",
                         "http://example.com/en", "http://a.org?b://c/d", "x://" + "a" * 20000 + ".com/p"])
    assert [(r["rule"], r["verdict"]) for r in got[:3]] == [
        ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow")]
    assert [r["rule"] for r in got[3:]] == [None, "net/fr/", None, None, None, None, "com/", None, "com/"]
    assert got[1]["host"] == "www.example.com" and got[0]["path"] == "/en/1"
    assert [(r["host"], r["path"]) for r in got[6:9]] == [("", "")] * 3
    assert got[10]["host"] == "a.org" and got[10]["path"] == ""


def test_model_separates_unseen_names(spark):
    bad = ["casino-royal", "online-casino", "adult-xxx", "free-porn", "poker-bets", "track-ads"]
    good = ["physics", "library-news", "gardens", "thereon", "cityhall", "recipes-home"]
    got = judged(spark, [f"http://{n}.org/en/5" for n in bad + good])
    assert [r["verdict"] for r in got] == ["block"] * 6 + ["allow"] * 6


def test_oracle(spark):
    for sf in (SF001, SF01):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
        want = con.execute(url_filter.oracle()).df().sort_values("page_id").reset_index(drop=True)
        got = op4_url_filter(spark, sf).toPandas().sort_values("page_id").reset_index(drop=True)
        assert got.astype(object).where(got.notna(), None).equals(want.astype(object).where(want.notna(), None))


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "page_id long, url string, host string, score string")
    assert url_filter.judge(df).count() == 0
    df = spark.createDataFrame([(None, "http://a.com/", "h", "s")] * 2,
                               "page_id long, url string, host string, score string")
    assert [r["rule"] for r in url_filter.judge(df).collect()] == ["com/"] * 2
