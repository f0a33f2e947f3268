"""Link lists as a data source: equal to fetching, host filters, and streams that fetch what is new."""

from __future__ import annotations

import pytest

from cartolex.sources import link_source, links


def fetcher():
    def answer(url):
        if "boom" in url.lower():
            raise ValueError("boom")
        return (url.encode(), "text/html", None) if "a" in url else (None, "", "404")

    return answer


@pytest.fixture
def folder(spark, tmp_path):
    link_source.register(spark, fetcher())
    return f"file://{tmp_path}/list"


def urls(spark, found):
    return spark.createDataFrame([(u, 1) for u in found], "url string, host int")  # a column that clashes


def test_reading_equals_fetching(spark, folder):
    given = urls(spark, ["http://a.x/1", "http://a.x/1", "http://b.x/2.pdf", None, "no url", "https://Boom.x/a", "http://a.x/ü?q=1"])
    assert link_source.deal(given, folder, slots=4, per_host=2) == 5
    got = spark.read.format("links").load(folder)
    want = links.fetch(given.select("url"), fetcher())
    assert sorted(map(str, got.drop("host").collect())) == sorted(map(str, want.collect()))
    assert {r.url: r.host for r in got.collect()}["https://Boom.x/a"] == "boom.x"
    assert link_source.deal(given, folder) == 0


def test_host_filters_reach_the_source(spark, folder):
    assert link_source.deal(urls(spark, [f"http://h{i % 40}.a/{i}" for i in range(200)]), folder, slots=64) == 200
    every, one = spark.read.format("links").load(folder), spark.read.format("links").load(folder).where("host = 'h7.a'")
    assert every.rdd.getNumPartitions() == 64 and one.rdd.getNumPartitions() == 1
    assert one.count() == 5 and every.where("host in ('h7.a', 'h8.a') and ok").count() == 10 and every.where("host = 'none'").count() == 0


def test_a_stream_fetches_each_url_once(spark, folder, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def counting(url):
        with open(asked / url.rsplit("/", 1)[1], "a") as f:
            f.write("x")
        return url.encode(), "application/pdf", None

    link_source.register(spark, counting, "counted_links")

    def run():
        out = spark.readStream.format("counted_links").load(folder).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query = out.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        query.stop()
        return spark.read.parquet(str(tmp_path / "out")).count()

    link_source.deal(urls(spark, [f"http://a/{i}" for i in range(10)]), folder, slots=4)
    assert run() == 10
    assert link_source.deal(urls(spark, [f"http://a/{i}" for i in range(5, 15)]), folder) == 5
    assert run() == 15 and run() == 15
    assert sorted(p.name for p in asked.iterdir()) == sorted(map(str, range(15))) and all(p.read_text() == "x" for p in asked.iterdir())


def test_an_empty_list(spark, folder):
    assert link_source.deal(urls(spark, []), folder) == 0
    assert spark.read.format("links").load(folder).count() == 0
