import datetime as dt
import hashlib
import random

import pytest

import sparsepages as sp
from sparsepages.operators import traffic

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def test_tag_synthetic(spark):
    agents = ["GoogleBot/2", "a spider", "Mozilla/5.0", "", None, "ROBOT", "alwaysON"]
    df = spark.createDataFrame([(a,) for a in agents], "user_agent string")
    assert [r[1] for r in sp.tag_synthetic(df).collect()] == [True, True, False, False, False, True, True]
    cased = [r[1] for r in sp.tag_synthetic(df, match_case=True).collect()]
    assert cased == [True, True, False, False, False, False, False]
    dotted = sp.tag_synthetic(df, words=["5.0"])
    assert [r[1] for r in dotted.collect()] == [False, False, True, False, False, False, False]


def test_exclude_handlers(spark):
    rows = [("System.Web.StaticFileHandler",), ("My.Handler",), (None,), ("system.web.staticfilehandler",)]
    df = spark.createDataFrame(rows, "handler string")
    assert [r[0] for r in sp.exclude_handlers(df).collect()] == ["My.Handler", None, "system.web.staticfilehandler"]


def requests(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, f"request_id long, ts {kind}, k string")


def random_rows(n, seconds, seed=0):
    rng = random.Random(seed)
    return [
        (i, BASE + dt.timedelta(seconds=rng.choice([1, 1, 1, rng.uniform(0, seconds)])), rng.choice("ab"))
        for i in range(n)
    ]


def capped(rows, limit, seconds, by=False):
    seen, kept = {}, set()
    for rid, ts, k in sorted(rows, key=lambda r: (r[1], r[0])):
        bucket = (int((ts - BASE).total_seconds()) // seconds, k if by else None)
        seen[bucket] = seen.get(bucket, 0) + 1
        if seen[bucket] <= limit:
            kept.add(rid)
    return kept


@pytest.mark.parametrize("limit,seconds,by", [(5, 1, False), (3, 10, True), (50, 60, False)])
def test_cap_rate(spark, limit, seconds, by):
    rows = random_rows(600, 30)
    out = sp.cap_rate(requests(spark, rows), limit, seconds, by=["k"] if by else [])
    got = [r["request_id"] for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == capped(rows, limit, seconds, by)
    assert out.columns == ["request_id", "ts", "k"]


def test_requests_without_a_time_are_not_capped(spark):
    rows = [(i, None, "a") for i in range(20)] + [(100 + i, BASE, "a") for i in range(20)]
    got = {r["request_id"] for r in sp.cap_rate(requests(spark, rows), 3, 1).collect()}
    assert got == set(range(20)) | {100, 101, 102}


@pytest.mark.parametrize("threshold", [2, -1])
def test_cap_rate_with_and_without_map_side_limit(spark, threshold):
    rows = random_rows(600, 5)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = {r["request_id"] for r in sp.cap_rate(requests(spark, rows), 40, 1).collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == capped(rows, 40, 1)


def test_cap_rate_has_one_plan_for_every_limit(spark):
    rows = requests(spark, random_rows(10, 3))
    windows = {sp.cap_rate(rows, limit)._jdf.queryExecution().optimizedPlan().toString().count("Window [") for limit in (1, 40, 5000)}
    assert windows == {len(traffic._DEALS)}


def test_buckets_ignore_the_time_zone(spark):
    rows = [
        (1, dt.datetime(1969, 12, 31, 23, 59, 59, 500000), "a"),
        (2, dt.datetime(1970, 1, 1, 0, 0, 0, 500000), "a"),
        (3, None, "a"),
    ]
    for kind in ("timestamp_ntz", "timestamp"):
        df = requests(spark, rows, kind)
        got = df.select(traffic.time_bucket(df["ts"], df.schema["ts"].dataType, 1).alias("b")).collect()
        assert [r["b"] for r in got] == [-1, 0, None]


@pytest.mark.parametrize("crowded", [1, 8, 65_536])
def test_sample_rate(spark, monkeypatch, crowded):
    monkeypatch.setattr(traffic, "_CROWDED", crowded)
    rows = random_rows(3000, 20) + [(10_000 + i, None, "a") for i in range(50)]
    sizes = {}
    for _, ts, _k in rows:
        b = ts and int((ts - BASE).total_seconds())
        sizes[b] = sizes.get(b, 0) + 1
    want = {}
    for rid, ts, _k in rows:
        n = sizes[ts and int((ts - BASE).total_seconds())]
        h = int(hashlib.md5(str(rid).encode()).hexdigest()[:8], 16)
        if ts is None:
            want[rid] = 1.0
        elif h * n < 5 * 2**32:
            want[rid] = max(1.0, n / 5)
    out = sp.sample_rate(requests(spark, rows))
    got = out.collect()
    assert len(got) == len(want) and {r["request_id"]: r["item_weight"] for r in got} == want
    # The weights stand for about all requests.
    assert abs(sum(want.values()) - len(rows)) < 0.5 * len(rows)


def test_sample_bound_does_not_overflow(spark):
    n = 9_000_000_000_000
    row = spark.sql(f"select (5 * 4294967296L - 1) div {n}L as bound").first()
    assert row["bound"] == (5 * 2**32 - 1) // n
