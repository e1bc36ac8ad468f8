"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


OWN = [f.__name__ for f in entry._QUERIES]  # others come with subpackages that have tests of their own

# No Python workers, no cross joins.
UNWANTED = (
    "PythonUDF",
    "EvalPython",
    "InPandas",
    "InArrow",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return con


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert len(OWN) == len(set(OWN)) and set(OWN) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    kinds = {c: str(t) for c, t in zip(want.columns, want.types)}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert rows_of(df.collect(), df.columns) == rows_of(want.fetchall(), want.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in OWN if n.startswith("rule_report")])
def test_rules_fail_on_some_rows(spark, sf, name):
    """Each registered rule meets rows that pass it and, but for those that cannot in these tables, rows that fail."""
    lines = entry.queries()[name](spark, sf).collect()
    assert all(0 <= r["failed"] <= r["checked"] for r in lines)
    if name in ("rule_report_contacts", "rule_report_conditional"):
        assert all(0 < r["failed"] < r["checked"] for r in lines)


def test_queries_stand_empty_tables(spark, sf, tmp_path):
    for table in ("lineitem", "documents", "labels"):
        spark.read.parquet(f"{sf}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    for name in ("candidate_ids", "pages", "home_page", "home_page_numbered", "neighbours_large", "gap_runs"):
        assert entry.queries()[name](spark, str(tmp_path)).count() == 0
