import datetime as dt

import sparsepages as sp
from sparsepages import streaming


def test_requests(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, "Bot", "My.Handler"), (2, "x", "System.Web.StaticFileHandler"), (3, "x", None)]
    spark.createDataFrame(rows, "request_id long, user_agent string, handler string").write.parquet(source)
    schema = spark.read.parquet(source).schema
    live = streaming.filter_requests(spark.readStream.schema(schema).parquet(source))
    query = streaming.append_stream(live, sink, tmp_path.name).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {r["request_id"]: r["is_synthetic"] for r in spark.read.parquet(sink).collect()}
    assert got == {1: True, 3: False}


def test_responses(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("https://h/5/i", 200, '{"num":5}', dt.datetime(2024, 1, 1)), ("https://h/6/i", 500, "x", None)]
    spark.createDataFrame(rows, sp.RESPONSES).write.parquet(source)
    live = streaming.stream_responses(spark, source, "https://h/{0}/i")
    live = sp.classify_outcome(sp.fill_defaults(sp.decode_records(live)))
    query = streaming.append_stream(live, sink, tmp_path.name).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r["num"]: r["outcome"] for r in spark.read.parquet(sink).collect()} == {5: "ok", 6: "malformed"}
