"""Phrase mining against a plain version, at several memory budgets."""

import random

import numpy as np
import pytest

from sparsepages.llm import phrases

from . import plain


@pytest.fixture(scope="module")
def rows():
    """One word holds half of all, and whole phrases repeat."""
    rng = random.Random(3)
    words, weights = ["alpha", "Beta", "gämma", "δ", "the", "of", "x-y", "IT", "中文"], [1, 2, 3, 4, 50, 20, 3, 2, 1]
    gaps = [" ", "  ", "\t", " ", " ", " ", ", ", ".\n"]
    out = []
    for _ in range(1200):
        text = "".join(rng.choices(words, weights)[0] + rng.choice(gaps) for _ in range(rng.randint(0, 80)))
        out.append((rng.choice(["en", "de", None, "en"]), text + "one fixed Phrase of six words" * (rng.random() < 0.3)))
    return [*out, (None, None), ("en", ""), ("zz", "  . "), *[("es", "casa " * 40)] * 5]


@pytest.mark.parametrize("budget", [1 << 19, 3000, 150])
def test_phrases_equal_plain(spark, rows, budget, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_ROWS", budget)
    table = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert sorted(map(tuple, phrases.collocations(table).collect())) == plain.collocations(rows)


def test_ties_at_the_end_are_settled_by_the_phrase(spark, rows):
    table = spark.createDataFrame(rows, "lang string, text string")
    for top in (1, 5, 9):
        assert sorted(map(tuple, phrases.collocations(table, top).collect())) == plain.collocations(rows, top=top)


def test_scores_beyond_64_bits(spark):
    wide = spark.createDataFrame([(9_000_000_000_000, 9_999_999_999_999, 9_000_000_000_001, 9_000_000_000_002)], "a bigint, n bigint, l bigint, r bigint")
    row = wide.selectExpr(phrases.SCORE + " as score").first()
    assert row["score"] == 1000 * 9_000_000_000_000 * 9_999_999_999_999 // (9_000_000_000_001 * 9_000_000_000_002)


def test_odd_rows(odd, no_documents):
    assert phrases.collocations(no_documents).count() == 0
    want = plain.collocations([(r["lang"], r["text"]) for r in odd.collect()])
    assert [w[2] for w in want] == [" ".join(["long"] * k) for k in (2, 3, 4, 5)]
    assert sorted(map(tuple, phrases.collocations(odd).collect())) == want


def test_filter_holds_every_code(spark):
    codes = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    table = spark.createDataFrame([(int(c),) for c in codes] + [(0,), (-1,), (2**63 - 1,), (phrases.FILTER_BITS - 1,)], "code bigint")
    bits = phrases._filter(table)
    assert phrases._may_hold(bits, codes.view(np.uint64)).all() and np.unpackbits(bits).sum() <= 3004


@pytest.mark.parametrize("budget", [1 << 19, 150])
def test_phrases_of_more_words_than_have_numbers(spark, rows, budget, monkeypatch):
    monkeypatch.setattr(phrases, "NUMBERED", 3)
    monkeypatch.setattr(phrases, "GROUP_ROWS", budget)
    table = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert sorted(map(tuple, phrases.collocations(table).collect())) == plain.collocations(rows)


def test_counted_pairs_are_not_dealt_again(spark, monkeypatch):
    """Each task would give away nearly every frequent pair once more, and both grow with the table."""
    made, mapped = [], phrases._mapped
    monkeypatch.setattr(phrases, "_mapped", lambda docs, make, schema: made.append((schema, mapped(docs, make, schema))) or made[-1][1])
    texts = [("en", f"w{i % 3} v{i % 2}") for i in range(1200)]
    found = phrases.collocations(spark.createDataFrame(texts, "lang string, text string").coalesce(2))
    assert sorted(map(tuple, found.collect())) == plain.collocations(texts) and found.count() == 6
    assert [df.count() for schema, df in made if schema.startswith("key")] == [0]
