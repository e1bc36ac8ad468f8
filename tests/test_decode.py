import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sparsepages as sp

SCHEMA = "name string, status int, body string"

# name, status, body, outcome, record
CASES = [
    (
        "plain",
        200,
        '{"num":3,"title":"a","img":"u","alt":"b","month":"7","extra":1}',
        "ok",
        (3, "a", "u", "b", "7"),
    ),
    ("key case differs", 200, '{"NUM":4,"Title":"c"}', "ok", (4, "c", None, None, None)),
    ("int as text", 200, '{"num":"12"}', "ok", (12, None, None, None, None)),
    ("int missing", 200, '{"title":"d"}', "ok", (0, "d", None, None, None)),
    ("empty object", 200, "{}", "ok", (0, None, None, None, None)),
    ("repeated key", 200, '{"Num":1,"num":2}', "ok", (2, None, None, None, None)),
    ("repeated key, same case", 200, '{"num":1,"num":2}', "ok", (2, None, None, None, None)),
    ("repeated text", 200, '{"title":"x","TITLE":"y"}', "ok", (0, "y", None, None, None)),
    ("number in a text field", 200, '{"title":5}', "ok", (0, "5", None, None, None)),
    ("null in a text field", 200, '{"num":1,"title":null}', "ok", (1, None, None, None, None)),
    ("text like an object", 200, '{"title":"{\\"a\\":1}"}', "ok", (0, '{"a":1}', None, None, None)),
    ("text like an array", 200, '{"title":"[1]"}', "ok", (0, "[1]", None, None, None)),
    ("text after the object", 200, '{"num":1} x', "ok", (1, None, None, None, None)),
    ("nested in an unknown field", 200, '{"num":1,"more":{"a":[1]}}', "ok", (1, None, None, None, None)),
    ("negative", 200, '{"num":-1}', "ok", (-1, None, None, None, None)),
    ("too large", 200, '{"num":3000000000}', "malformed", None),
    ("fraction", 200, '{"num":1.5}', "malformed", None),
    ("nested value", 200, '{"num":{"a":1}}', "malformed", None),
    ("null in the int field", 200, '{"num":null}', "malformed", None),
    ("blank in the int field", 200, '{"num":""}', "malformed", None),
    ("object in a text field", 200, '{"num":1,"title":{"a":1}}', "malformed", None),
    ("array in a text field", 200, '{"num":1,"title":["a"]}', "malformed", None),
    ("not JSON", 200, "<html>", "malformed", None),
    ("truncated", 200, '{"num":1', "malformed", None),
    ("empty text", 200, "", "malformed", None),
    ("NULL", 200, None, "malformed", None),
    ("null literal", 200, "null", "malformed", None),
    ("array", 200, "[]", "malformed", None),
    ("array of objects", 200, '[{"num":1}]', "malformed", None),
    ("scalar", 200, "5", "malformed", None),
    ("absent", 404, '{"num":1}', "missing", (1, None, None, None, None)),
    ("server error", 500, "oops", "malformed", None),
    ("server error with a record", 500, '{"num":8}', "ok", (8, None, None, None, None)),
    ("no status", None, '{"num":8}', "ok", (8, None, None, None, None)),
]


@pytest.fixture(scope="module")
def decoded(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], SCHEMA)
    out = sp.classify_outcome(sp.fill_defaults(sp.decode_records(df)))
    return {r["name"]: r for r in out.collect()}


@pytest.mark.parametrize("name,outcome,record", [(c[0], c[3], c[4]) for c in CASES])
def test_body(decoded, name, outcome, record):
    row = decoded[name]
    assert row["outcome"] == outcome
    assert (None if row["record"] is None else tuple(row["record"])) == record


def test_defaults_only_for_numbers(spark):
    df = spark.createDataFrame([("a", 200, "{}")], SCHEMA)
    raw = sp.decode_records(df)
    assert raw.select("record.num").first()[0] is None
    assert raw.schema["record"].dataType["num"].dataType == T.IntegerType()


def test_long_text_comes_back_whole(spark):
    text = 'q"\\\n\t\u0001€\U0001f600 ' * 5000
    df = spark.createDataFrame([("a", 200, json.dumps({"num": 1, "alt": text}))], SCHEMA)
    assert sp.project_model(sp.decode_records(df)).first()["alt"] == text


def test_project_model_keeps_the_schema(spark):
    df = spark.createDataFrame([("a", 200, '{"num":1,"other":2}')], SCHEMA)
    out = sp.project_model(sp.decode_records(df), keep=["name"])
    assert out.columns == ["name", "num", "title", "img", "alt", "month"]


def test_quarantine_splits_without_loss(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], SCHEMA)
    good, bad = sp.quarantine(sp.classify_outcome(sp.decode_records(df)))
    assert good.count() + bad.count() == len(CASES)
    assert {r[0] for r in bad.select("outcome").distinct().collect()} == {"missing", "malformed"}


def test_latest_response(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [
        ("u1", 404, None, t[0]),
        ("u1", 200, "new", t[1]),
        ("u2", 200, "old", t[0]),
        ("u2", 404, None, t[2]),
        ("u3", 404, "gone", t[0]),
        ("u3", 200, "here", t[0]),
        ("u4", 200, "only", None),
    ]
    df = spark.createDataFrame(rows, sp.RESPONSES)
    got = {r["url"]: (r["status"], r["body"]) for r in sp.latest_response(df).collect()}
    # At the same instant a response that was found comes first.
    assert got == {"u1": (200, "new"), "u2": (404, None), "u3": (200, "here"), "u4": (200, "only")}
    assert sp.latest_response(df).columns == df.columns


def test_existing_ids_agree_with_latest_response(spark):
    import random

    rng = random.Random(1)
    times = [None] + [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [
        (f"https://h/{rng.randint(1, 60)}/i", rng.choice([200, 404, 404, 500, None]), "b", rng.choice(times))
        for _ in range(300)
    ]
    df = sp.with_ids(spark.createDataFrame(rows, sp.RESPONSES), "https://h/{0}/i")
    narrow = {r[0] for r in sp.existing_ids(df).collect()}
    full = {r["num"] for r in sp.filter_existing(sp.latest_response(df, "num")).collect()}
    assert narrow == full


def test_addresses(spark):
    template = "https://h.example/{0}/info.0.json"
    urls = [
        ("https://h.example/614/info.0.json", 614),
        ("https://h.example/info.0.json", None),
        ("https://h.example/007/info.0.json", None),
        ("https://h.example/+7/info.0.json", None),
        ("https://h.example/ 7/info.0.json", None),
        ("https://h.example/7/infoX0.json", None),
        ("https://h.example/7/info.0.json\n", None),
        ("https://h.example/99999999999999999999/info.0.json", None),
        ("x", None),
        (None, None),
    ]
    df = spark.createDataFrame(urls, "url string, want long")
    assert [r["num"] for r in sp.with_ids(df, template).collect()] == [u[1] for u in urls]
    ids = spark.createDataFrame([(1,), (None,)], "num long")
    assert [r["url"] for r in sp.expand_urls(ids, template).collect()] == ["https://h.example/1/info.0.json", None]
    with pytest.raises(ValueError):
        sp.expand_urls(ids, "https://h.example/")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_scan_responses(spark, tmp_path, fmt):
    rows = [("https://h/5/i", 200, "{}", dt.datetime(2024, 1, 1)), ("https://h/i", 200, "{}", None)]
    path = str(tmp_path / fmt)
    spark.createDataFrame(rows, sp.RESPONSES).write.format(fmt).save(path)
    got = sp.scan_responses(spark, path, "https://h/{0}/i", fmt)
    assert sorted(r["num"] or 0 for r in got.collect()) == [0, 5]
    assert got.columns == [*sp.RESPONSES.names, "num"]


def test_candidate_ids(spark):
    df = sp.candidate_ids(spark, 3, 6)
    assert [r["num"] for r in df.orderBy("num").collect()] == [3, 4, 5, 6]
    assert sp.candidate_ids(spark, 3, 2).count() == 0
    assert df.select(F.col("num")).schema["num"].dataType == T.LongType()
