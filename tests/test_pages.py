import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sparsepages as sp

URL, LAST = "https://h.example/{0}/info.0.json", "https://h.example/info.0.json"
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def body(num, title="t"):
    return json.dumps({"num": num, "title": title, "img": "i", "alt": "a", "month": "7"})


def landed(spark, *extra):
    rows = [
        (1, 200, body(1), T0),
        (3, 404, body(3), T0),  # not found, whatever the body says
        (4, 500, "oops", T0),  # no page, still a neighbour
        (6, 200, body(6), T0),
        (7, 200, '{"num":', T0),  # malformed, still a neighbour
        (9, 404, None, T0),
        (9, 200, body(9, "later"), T1),  # only the later landing counts
        (12, 200, body(12), T0),
        (12, 404, None, T1),  # gone again
        (15, 200, body(99), T0),  # the address counts, not the number inside
        *extra,
    ]
    urls = [(u if isinstance(u, str) else URL.format(u), *rest) for u, *rest in rows]
    return sp.with_ids(spark.createDataFrame(urls, sp.RESPONSES), URL)


def nav(df):
    return {r["num"]: (r["next_page"], r["prev_page"], r["next_url"], r["prev_url"]) for r in df.collect()}


WANT = {
    1: (4, 0, "/comics/4", None),
    6: (7, 4, "/comics/7", "/comics/4"),
    9: (15, 7, "/comics/15", "/comics/7"),
    15: (0, 9, None, "/comics/9"),
}


def test_pages(spark):
    out = sp.pages(landed(spark))
    assert nav(out) == WANT
    assert out.columns == ["num", "result", "next_page", "prev_page", "next_url", "prev_url"]
    assert {r["num"]: r["result"]["title"] for r in out.collect()}[9] == "later"
    assert {r["num"]: r["result"]["num"] for r in out.collect()}[15] == 99


def test_missing_field_still_gives_a_page(spark):
    out = sp.pages(landed(spark, (20, 200, "{}", T0)))
    row = {r["num"]: r["result"] for r in out.collect()}[20]
    assert tuple(row) == (0, None, None, None, None)


def test_next_ends_at_the_stated_latest(spark):
    responses = landed(spark, (LAST, 200, body(7), T0), (LAST, 200, body(9), T1))
    got = nav(sp.pages(responses, LAST))
    assert got[6][0] == 7 and got[9][:2] == (0, 7) and got[15][:2] == (0, 9)
    # Not landed or not decodable: the largest id is the bound.
    assert nav(sp.pages(landed(spark), LAST)) == WANT
    assert nav(sp.pages(landed(spark, (LAST, 200, "x", T0)), LAST)) == WANT


@pytest.mark.parametrize("num", [1, 3, 4, 6, 7, 9, 12, 15, 50, -2])
def test_one_page_equals_its_row(spark, num):
    responses = landed(spark)
    got = sp.page_of(responses, num).collect()
    want = [r for r in sp.pages(responses).collect() if r["num"] == num]
    assert got == want


def test_home_page(spark):
    (row,) = sp.home_page(landed(spark)).collect()
    assert (row["num"], row["next_page"], row["prev_page"], row["prev_url"]) == (15, 0, 9, "/comics/9")
    (row,) = sp.home_page(landed(spark, (LAST, 200, body(9), T0)), LAST).collect()
    assert (row["num"], row["next_page"], row["prev_page"], row["next_url"]) == (9, 0, 7, None)
    # The newest record cannot be decoded: no page.
    assert sp.home_page(landed(spark, (30, 500, "x", T0))).count() == 0
    assert sp.home_page(landed(spark), LAST).count() == 0


def test_empty_collection(spark):
    empty = sp.with_ids(spark.createDataFrame([], sp.RESPONSES), URL)
    assert sp.pages(empty).count() == 0
    assert sp.home_page(empty).count() == 0
    assert sp.page_of(empty, 1).count() == 0


def test_outcomes(spark):
    got = {r["num"]: r["outcome"] for r in sp.classified_records(landed(spark)).collect()}
    assert got == {
        1: "ok",
        3: "missing",
        4: "malformed",
        6: "ok",
        7: "malformed",
        9: "ok",
        12: "missing",
        15: "ok",
    }


def test_assemble_and_links(spark):
    records = spark.createDataFrame([(1, ("x",)), (2, ("y",))], "num long, record struct<a:string>")
    steps = spark.createDataFrame([(1, 2, 0), (2, 0, 1)], "num long, next_page long, prev_page long")
    got = sp.nav_links(sp.assemble_pages(records, steps), "/p/{0}").orderBy("num").collect()
    assert [(r["result"]["a"], r["next_url"], r["prev_url"]) for r in got] == [("x", "/p/2", None), ("y", None, "/p/1")]


def test_lookups(spark):
    catalogue = spark.createDataFrame([(1, "a"), (5, "b"), (9, "c")], "num long, v string")
    assert sp.latest_record(catalogue).collect() == [(9, "c")]
    assert sp.latest_record(catalogue.filter("num > 99")).count() == 0
    assert sp.lookup_id(catalogue, 5).collect() == [(5, "b")]
    requests = spark.createDataFrame([(1, 5), (2, 6), (3, None), (4, 5)], "rid long, num long")
    got = {r["rid"]: (r["num"], r["v"], r["found"]) for r in sp.lookup_ids(requests, catalogue, request_id="rid").collect()}
    assert got == {1: (5, "b", True), 2: (6, None, False), 3: (None, None, False), 4: (5, "b", True)}


def test_lookup_splits_a_crowded_id(spark):
    rows = [(i, 7 if i % 3 else i % 11) for i in range(3000)] + [(i, None) for i in range(3000, 4000)]
    requests = spark.createDataFrame(rows, "rid long, num long")
    catalogue = spark.createDataFrame([(i, f"v{i}") for i in range(9)], "num long, v string")
    got = sp.lookup_ids(requests, catalogue, request_id="rid", pieces=16)  # splits nearly every id
    want = {i: (n, f"v{n}" if n is not None and n < 9 else None) for i, n in rows}
    out = got.collect()
    assert len(out) == len(rows)
    assert {r["rid"]: (r["num"], r["v"]) for r in out} == want
    assert all(r["found"] == (r["v"] is not None) for r in out)


@pytest.mark.parametrize("request_id", [None, "rid"])
def test_lookup_spreads_a_hot_id_and_missing_ids(spark, request_id):
    """A third one id, a third NULL: no partition of the join gets more than a few times its share."""
    rows = spark.range(120_000, numPartitions=16).selectExpr("id as rid", "case id % 3 when 0 then 7 when 1 then null else id end as num")
    wanted = rows if request_id else rows.select("num")
    catalogue = spark.range(9).selectExpr("id as num", "concat('v', id) as v")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = sp.lookup_ids(wanted, catalogue, request_id=request_id, pieces=64)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        found = out.groupBy("found", "v").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 120_000 and max(sizes) < 2 * sum(sizes) / 4
    assert {(r["found"], r["v"]): r["count"] for r in found if r["found"]} == {(True, "v7"): 40_000, (True, "v2"): 1, (True, "v5"): 1, (True, "v8"): 1}


def test_records_with_wide_ids(spark):
    """The record's schema is the caller's: ids beyond 32 bits make pages."""
    schema = T.StructType([T.StructField("num", T.LongType()), T.StructField("title", T.StringType())])
    big = 2**40
    landed = [(f"https://e.org/{n}", 200, f'{{"num": {n}, "title": "t{n}"}}', dt.datetime(2024, 1, 1)) for n in (big, big + 5)]
    responses = sp.with_ids(spark.createDataFrame(landed, sp.RESPONSES), "https://e.org/{0}")
    got = sp.pages(responses, schema=schema).orderBy("num").collect()
    assert [(r["num"], r["result"]["num"], r["next_page"], r["prev_page"]) for r in got] == [(big, big, big + 5, 0), (big + 5, big + 5, 0, big)]
    assert sp.pages(responses).count() == 0
    one = sp.page_of(responses, big, template="https://e.org/{0}", schema=schema).collect()
    assert [(r["num"], r["next_page"]) for r in one] == [(big, big + 5)]
    home = sp.home_page(responses, template="https://e.org/{0}", schema=schema).collect()
    assert [(r["num"], r["prev_page"]) for r in home] == [(big + 5, big)]
    home = sp.home_page(responses, last_url=f"https://e.org/{big + 5}", schema=schema).collect()
    assert [(r["num"], r["prev_page"], r["result"]["title"]) for r in home] == [(big + 5, big, f"t{big + 5}")]
    assert sp.home_page(responses, last_url="https://e.org/none", schema=schema).count() == 0
