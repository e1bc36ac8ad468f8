"""Every operator on odd rows and on empty tables: defined results, no crash."""

import pytest
from pyspark.sql import functions as F

from sparsepages.llm import common, decontaminate, fingerprints, lines, mixing, neardup, pii, substrings, tokencounts, tokenfile, toxicity
from sparsepages.llm.vocab import vocabulary

ROWS = 12


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "Der Hund läuft im Garten und bellt den Mond an weil er"), (2, None), (3, ""), (None, "x"), (4, "another text"), (4, "another text")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("words", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (3, None, None), (5, 1, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")


def test_toxicity(odd, no_documents, labels):
    weights = toxicity.train(odd, labels)
    out = toxicity.score(odd, weights).collect()
    assert len(out) == ROWS and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3, 4)}) == 1
    assert all(r["held_out"] is False for r in out if r["doc_id"] is None)
    assert toxicity.without_toxic(odd, weights, 2.0).columns == odd.columns
    assert toxicity.train(no_documents, labels) == [(-1, 0.0)]
    assert toxicity.train(odd, labels.limit(0)) == [(-1, 0.0)]
    assert toxicity.score(no_documents, weights).count() == 0
    assert {r["score"] for r in toxicity.score(odd, [(-1, 0.0)]).collect()} == {0.5}


def test_decontamination(odd, no_documents, benchmark):
    out = decontaminate.contaminated_words(odd, benchmark).collect()
    assert len(out) == ROWS
    hits = sorted((r["doc_id"] or -1, r["n_hit"], r["n_items"]) for r in out if r["contaminated"])
    assert hits == [(-1, 12, 1), (1, 12, 1), (1, 12, 1), (5, 1, 0), (7, 2, 1), (7, 12, 1)]
    kept = decontaminate.without_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == ROWS - 6
    assert decontaminate.contaminated_words(no_documents, benchmark).count() == 0
    clean = decontaminate.contaminated_words(odd, benchmark.limit(0)).collect()
    assert len(clean) == ROWS and not any(r["contaminated"] for r in clean) and max(r["n_words"] for r in clean) == 60_001


def test_mixing(odd, no_documents):
    out = mixing.mix(odd).collect()
    assert len(out) == ROWS and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    assert {r["source"] for r in out} == {None, "", "a", "b"}
    assert all(r["size"] == 0 for r in out if r["doc_id"] in (2, 3, 4))
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns and rows.count() == sum(r["taken"] // r["size"] for r in out if r["size"])
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed(no_documents).count() == 0


def test_near_duplicates(odd, no_documents):
    out = neardup.near_duplicates(odd, 3, 85).collect()
    assert len(out) == ROWS
    by = {(r["doc_id"], r["n_shingles"]): r for r in out}
    assert all(by[d, 0]["component_id"] == d and by[d, 0]["kept"] for d in (2, 3, 4))
    assert by[None, 15]["component_id"] == 1 and not by[None, 15]["kept"]
    assert by[7, 16]["component_id"] == 1
    assert by[5, 1]["component_id"] == 5
    rest = neardup.without_near_duplicates(odd, 3, 85)
    assert rest.columns == odd.columns and rest.count() == ROWS - 2
    assert neardup.near_duplicates(no_documents).count() == 0


def test_lines(spark, odd, no_documents):
    out = lines.duplicate_lines(odd).collect()
    assert not any(r["doc_id"] in (2, 3, 4) for r in out)
    gone = {(r["doc_id"], r["line"]) for r in out if r["removed"]}
    assert (None, 0) in gone and (1, 0) not in gone
    assert lines.without_duplicate_lines(odd).columns == odd.columns
    assert lines.without_duplicate_lines(odd).count() == ROWS
    assert lines.line_report(no_documents).count() == 0


def test_substrings(odd, no_documents):
    pieces = substrings.chunks(odd).collect()
    assert not any(r["doc_id"] in (2, 3) for r in pieces)
    cut = substrings.without_repeats(odd, 12)
    assert cut.columns == odd.columns and cut.count() == ROWS
    assert substrings.repeated_passages(no_documents).count() == 0 and substrings.without_repeats(no_documents).count() == 0


def test_fingerprints(odd, no_documents):
    out = fingerprints.edited_fingerprints(odd).collect()
    assert len(out) == ROWS and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    blank = {r["fingerprint"] for r in out if r["doc_id"] in (2, 3, 4)}
    assert blank == {"ffffffffffff"}
    assert fingerprints.edited_fingerprints(no_documents).count() == 0
    alone = fingerprints.edited_fingerprints(odd.filter("doc_id = 5")).first()
    assert (alone["near_next"], alone["next_doc_id"]) == (1.0, 5)


def test_token_files(spark, odd, no_documents):
    path = common.scratch(spark, "tokens")
    tokenfile.write_tokens(odd, vocabulary("byte_bpe_50k.json"), path, file_ids=50)
    out = tokenfile.read_tokens(spark, path).orderBy("start").collect()
    assert len(out) == ROWS and [r["doc_id"] for r in out] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(out, out[1:], strict=False))
    assert {r["n_tokens"] for r in out if r["doc_id"] in (2, 3)} == {1}
    empty = common.scratch(spark, "tokens")
    assert tokenfile.write_tokens(no_documents, vocabulary("byte_bpe_50k.json"), empty).count() == 0
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_surrogates(odd, no_documents):
    out = pii.pseudonymised(odd)
    assert sorted(out.columns) == sorted(odd.columns) and out.count() == ROWS
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[2]["text"] is None and rows[2]["pii"] == []
    assert [p["kind"] for p in rows[8]["pii"]] == ["email"] and "a.b@example.com" not in rows[8]["text"]
    assert pii.pseudonymised(no_documents).count() == 0


def test_token_counts(odd, no_documents):
    out = {(r["doc_id"], r["n_bytes"]): r for r in tokencounts.count_tokens(odd, vocabulary("piece_bpe_32k.model")).collect()}
    assert out[2, 0]["n_tokens"] == out[3, 0]["n_tokens"] == 0
    assert out[6, 400_000]["over_limit"] and not out[5, 1]["over_limit"]
    assert tokencounts.count_tokens(no_documents, vocabulary("piece_bpe_32k.model")).count() == 0
