"""What the plans must and must not contain."""

import __spark_entry__ as entry
import sparsepages as sp


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_task_window_sees_the_summary_only(spark, sf):
    text = plan(entry.neighbours_large(spark, sf))
    assert text.count("Exchange SinglePartition") == 1
    below = text[text.index("Exchange SinglePartition") :].splitlines()[1]
    assert "HashAggregate" in below and "min(" in below and "max(" in below


def test_lookup_reaches_the_scan(spark, sf):
    assert "EqualTo(o_orderkey,7)" in plan(entry.lookup_id(spark, sf))


def test_cap_is_applied_before_the_shuffle(spark, sf):
    text = plan(entry.cap_rate(spark, sf))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit") and "Partial" in text


def test_excluded_handlers_are_filtered_in_the_scan(spark, sf):
    scan = [line for line in plan(entry.exclude_handlers(spark, sf)).splitlines() if "FileScan" in line][0]
    assert "PushedFilters: [Or(IsNull(event_type)" in scan


def test_text_is_parsed_once(spark, sf):
    text = plan(entry.pages(spark, sf))
    assert text.count("from_json(MapType(StringType,StringType,true)") == 1


def test_bodies_move_once(spark, tmp_path):
    """Of the shuffles, only the one that picks the newest landing carries bodies."""
    path = str(tmp_path / "landed")
    spark.createDataFrame([], sp.RESPONSES).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(sp.pages(sp.scan_responses(spark, path, entry.URL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bodies, ids = text[: text.index("Window")], text[text.index("Window") :]
    # From the aggregate the bodies go into the join as they are: no sort, no shuffle.
    assert bodies.count("SortAggregate") == 2
    above = bodies[: bodies.index("SortAggregate")]
    assert "SortMergeJoin [num" in above and "Exchange" not in above and "Sort [" not in above
    assert "body" not in ids


def test_scans_read_only_what_is_used(spark, sf):
    scan = [line for line in plan(entry.neighbours_large(spark, sf)).splitlines() if "FileScan" in line]
    assert all("ReadSchema: struct<l_orderkey:bigint>" in line for line in scan)


def test_one_page_reads_no_other_bodies(spark, tmp_path):
    """Whatever scan reads bodies compares the address."""
    path = str(tmp_path / "landed")
    rows = [(f"https://example.org/{n}/info.0.json", 200, f'{{"num": {n}}}', None) for n in range(1, 9)]
    spark.createDataFrame(rows, sp.RESPONSES).write.parquet(path)
    responses = sp.scan_responses(spark, path, entry.URL)
    for df in (sp.page_of(responses, 5, template=entry.URL), sp.lookup_id(responses, 5, template=entry.URL)):
        scans = [line for line in plan(df).splitlines() if "FileScan" in line and "body" in line]
        assert scans and all("EqualTo(url,https://example.org/5/info.0.json)" in line for line in scans)
        assert df.count() == 1
    home = sp.home_page(responses, template=entry.URL)
    assert [(r["num"], r["prev_page"]) for r in home.collect()] == [(8, 7)]
    scans = [line for line in plan(home).splitlines() if "FileScan" in line and "body" in line]
    assert scans and all("url" in line.split("DataFilters")[1].split("]")[0] for line in scans)


def test_home_page_decodes_once(spark, sf):
    df = entry.home_page(spark, sf)
    assert df.count() == 1
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("ReusedSubquery") >= 1
