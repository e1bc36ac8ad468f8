"""The registered queries: their SQL, their contracts, and the pipeline stage by stage."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sparsepages.llm import queries, toxicity

from . import plain

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op3": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op8": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op12": {"doc_id": "bigint", **dict.fromkeys(["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"], "bigint"), "groups_sha256": "string"},
    "op13": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
}
PER_DOCUMENT = [n for n in queries.queries() if n.split("_")[0] in {*COLUMNS, "op9"} - {"op11"}]


def test_one_query_per_operator():
    names = [re.match(r"op(\d+)_", n)[1] for n in queries.queries()]
    assert names == [str(n) for n in range(1, 14)]
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_contract(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS.get(name.split("_")[0], {})} == COLUMNS.get(name.split("_")[0], {})
    ids = [r[0] for r in df.select("doc_id").collect()]
    assert sorted(ids) == [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*sorted(df.columns)).collect())) == sorted(want.select(*sorted(want.columns)).fetchall())


@pytest.mark.parametrize("name", ["op2_decontamination", "op7_fingerprints", "op9_pii_surrogates"])
def test_native_queries_run_no_python(spark, sf, name):
    text = queries.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept, against a plain version."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    text_of = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    assert list(stages) == ["toxicity", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]

    clean = stages["toxicity"](spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score(docs, toxicity.train(docs, labels))
    assert clean.columns == columns and set(text_of(clean)) == {r["doc_id"] for r in scores.filter("predicted = 0").collect()}
    # A learned score may err: at most one clean document in a hundred goes.
    assert clean.join(labels.filter("toxic = 0"), "doc_id").count() >= 0.99 * labels.filter("toxic = 0").count()

    single = stages["MinHash near-dedup"](spark, clean, SF)
    want = plain.near_duplicates(text_of(clean), 5, 80)
    assert single.columns == columns and set(text_of(single)) == {d for d, (_, c) in want.items() if d == c}

    fair = stages["benchmark decontamination"](spark, single, SF)
    items = text_of(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    want = plain.contamination(text_of(single), items)
    assert fair.columns == columns and set(text_of(fair)) == {d for d, (_, hit, _, _) in want.items() if not hit}

    mixed = stages["mixing sources to target weights"](spark, fair, SF)
    assert mixed.columns == columns
    size = {d: len(plain.RUN.findall(t)) for d, t in text_of(fair).items()}
    source = {r["doc_id"]: r["source"] for r in fair.collect()}
    totals = {s: sum(n for d, n in size.items() if source[d] == s) for s in set(source.values())}
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert max(copies.values()) <= 3
    for s, target in plain.targets(list(totals.items())).items():
        own = [d for d in size if source[d] == s]
        assert abs(sum(copies.get(d, 0) * size[d] for d in own) - target) <= max(size[d] for d in own) / 2 + 1e-6

    written = stages["token-ID / binary output"](spark, mixed, SF)
    assert {r["doc_id"]: r["count"] for r in written.groupBy("doc_id").count().collect()} == copies
    assert written.agg(F.sum("n_tokens") - F.max(F.col("start") + F.col("n_tokens"))).first()[0] == 0
