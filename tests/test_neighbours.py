import random

import pytest
from pyspark.sql import functions as F

import sparsepages as sp
from sparsepages.operators import nearest as module


def walk(ids, start, forward, last):
    """One step at a time over the holes, ending where the search must end."""
    if forward and start >= last or not forward and start <= 0:
        return 0
    at = start
    while at != last:
        at += 1 if forward else -1
        if at in ids:
            return at
    return 0


def model(ids, probes):
    top = max(ids, default=0)
    return {p: (walk(ids, p, True, top), walk(ids, p, False, 0)) for p in probes}


def ids_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "num long")


def as_dict(df):
    return {r["num"]: (r["next_page"], r["prev_page"]) for r in df.collect()}


FIXED = {1, 5, 6, 40, 41, 200}


def test_fixed_probes(spark):
    probes = [-5, 0, 1, 2, 5, 39, 200, 201]
    got = as_dict(sp.neighbours_of(ids_df(spark, probes), ids_df(spark, FIXED)))
    assert got == model(FIXED, probes)
    assert got[2] == (5, 1) and got[200] == (0, 41) and got[201] == (0, 200)
    assert got[1] == (5, 0) and got[-5] == (1, 0)


@pytest.mark.parametrize("ids", [set(), {1}, {7}, {1, 2, 3}, FIXED])
def test_small_sets(spark, ids):
    assert as_dict(sp.neighbours(ids_df(spark, ids))) == model(ids, ids)


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_random_sets_at_all_widths(spark, bits, monkeypatch):
    """Many sets in one job, one group each; blocks of blocks several levels deep."""
    monkeypatch.setattr(module, "STEP_BITS", 2)
    monkeypatch.setattr(module, "TOP_BITS", 2)
    rng = random.Random(bits)
    sets = {}
    for case in range(25):
        size, top = rng.randint(0, 40), rng.choice([1, 5, 64, 200, 1000])
        sets[case] = {rng.randint(1, top) for _ in range(size)}
    probes = {c: {rng.randint(-30, 1100) for _ in range(40)} for c in sets}
    rows = [(c, i) for c, s in sets.items() for i in s for _ in range(rng.choice([1, 1, 3]))]
    ids = spark.createDataFrame(rows, "g long, num long")
    asked = spark.createDataFrame([(c, p) for c, s in probes.items() for p in s], "g long, num long")

    got = sp.neighbours(ids, by=["g"], bucket_bits=bits).collect()
    want = {(c, n): v for c, s in sets.items() for n, v in model(s, s).items()}
    assert {(r["g"], r["num"]): (r["next_page"], r["prev_page"]) for r in got} == want
    assert len(got) == len(want)

    got = sp.neighbours_of(asked, ids, by=["g"], bucket_bits=bits).collect()
    want = {(c, n): v for c in sets for n, v in model(sets[c], probes[c]).items()}
    assert {(r["g"], r["num"]): (r["next_page"], r["prev_page"]) for r in got} == want
    assert len(got) == len(want)


def test_one_collection_across_many_levels(spark, monkeypatch):
    monkeypatch.setattr(module, "STEP_BITS", 2)
    monkeypatch.setattr(module, "TOP_BITS", 2)
    rng = random.Random(5)
    ids = {rng.randint(1, 5000) for _ in range(150)} | {1, 16, 17, 4096}
    assert as_dict(sp.neighbours(ids_df(spark, ids), bucket_bits=3)) == model(ids, ids)


def test_huge_keys_need_no_hint(spark):
    ids = {1, 2**20, 2**40, 2**40 + 1, 2**62, 2**63 - 1}
    ordered = sorted(ids)
    got = as_dict(sp.neighbours(ids_df(spark, ids)))
    for i, num in enumerate(ordered):
        assert got[num] == (ordered[i + 1] if i + 1 < len(ordered) else 0, ordered[i - 1] if i else 0)


def test_sparse_ids_keep_the_last_window_small(spark):
    """The rows of the window without partitions are numbers of blocks, of which the type of the ids allows 2**20 at most."""
    for bits in (63, 31):
        left = bits - module.BUCKET_BITS
        while left > module.TOP_BITS:
            left -= module.STEP_BITS
        assert left <= 20
    ids = spark.range(1, 200_001).select((F.col("id") * ((2**63 - 1) // 200_001)).alias("num"))
    blocks = ids.select(F.shiftright("num", module.BUCKET_BITS + module.STEP_BITS).alias("b"))
    assert blocks.agg(F.max("b")).first()[0] < 2**20
    step = (2**63 - 1) // 200_001
    out = sp.neighbours(ids)
    assert out.filter((F.col("next_page") - F.col("num") != step) & (F.col("next_page") != 0)).count() == 0
    assert out.count() == 200_000 and out.filter("prev_page = 0").count() == 1
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange SinglePartition") == 1


def test_int_keys_keep_their_type(spark):
    ids = spark.createDataFrame([(1,), (9,)], "num int")
    out = sp.neighbours(ids)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "int", "int"]
    assert as_dict(out) == {1: (9, 0), 9: (0, 1)}
    with pytest.raises(ValueError):
        sp.neighbours(spark.createDataFrame([("a",)], "num string"))


def test_null_groups_are_one_group(spark):
    ids = spark.createDataFrame([(None, 1), (None, 900), ("a", 5)], "g string, num long")
    got = {(r["g"], r["num"]): r["next_page"] for r in sp.neighbours(ids, by=["g"], bucket_bits=4).collect()}
    assert got == {(None, 1): 900, (None, 900): 0, ("a", 5): 0}


def test_sentinel_and_floor(spark):
    ids = ids_df(spark, {0, -3, 4, 9})
    assert as_dict(sp.neighbours(ids)) == {4: (9, 0), 9: (0, 4)}
    got = as_dict(sp.neighbours(ids, sentinel=None, floor=None))
    assert got == {-3: (0, None), 0: (4, -3), 4: (9, 0), 9: (None, 4)}
    assert as_dict(sp.neighbours(ids, sentinel=-1)) == {4: (9, -1), 9: (-1, 4)}


def test_next_undoes_prev(spark):
    rng = random.Random(3)
    got = as_dict(sp.neighbours(ids_df(spark, {rng.randint(1, 10**6) for _ in range(500)}), bucket_bits=8))
    for num, (_, prev) in got.items():
        assert prev == 0 or got[prev][0] == num
    steps = ids_df(spark, list(got))
    assert {r[0]: r[1] for r in sp.next_existing(steps).collect()} == {n: v[0] for n, v in got.items()}
    assert {r[0]: r[1] for r in sp.prev_existing(steps).collect()} == {n: v[1] for n, v in got.items()}


def test_bounded_walk(spark):
    ids = ids_df(spark, FIXED)
    assert {r[0]: r[1] for r in sp.bounded_walk(ids, 41).collect()} == {1: 5, 5: 6, 6: 40, 40: 41, 41: 0, 200: 0}
    top = {r[0]: r[1] for r in sp.bounded_walk(ids).collect()}
    assert top == {1: 5, 5: 6, 6: 40, 40: 41, 41: 200, 200: 0}
    lookup = sp.bounded_walk(ids, sp.largest_id(ids.filter("num < 41")))
    assert {r[0]: r[1] for r in lookup.collect()}[40] == 0


def test_holes(spark):
    ids = ids_df(spark, [*FIXED, 5, 5])
    gaps = {(r["gap_start"], r["gap_end"], r["skipped"]) for r in sp.gap_runs(ids).collect()}
    assert gaps == {(2, 4, 3), (7, 39, 33), (42, 199, 158)}
    missing = [r["num"] for r in sp.missing_ids(sp.candidate_ids(spark, 1, 200), ids).collect()]
    assert sorted(missing) == sorted(set(range(1, 201)) - FIXED)
    assert sum(g[2] for g in gaps) + len(FIXED) == 200 == len(missing) + len(FIXED)


def test_end_sentinel(spark):
    df = spark.createDataFrame([(None,), (4,)], "n long")
    assert [r[0] for r in df.select(sp.end_sentinel(F.col("n"))).collect()] == [0, 4]
    assert [r[0] for r in df.select(sp.end_sentinel(F.col("n"), None)).collect()] == [None, 4]
