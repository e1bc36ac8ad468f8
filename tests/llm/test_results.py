"""Operators against plain versions, round trips and held-out accuracy."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparsepages.llm import common, decontaminate, fingerprints, lines, mixing, neardup, pieces, pii, sentencepieces, substrings, sweep, tokencounts, tokenfile, toxicity, vocab
from sparsepages.llm.linking import connected

from . import plain


# ---- toxicity


def test_toxicity_learns_what_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights = toxicity.train(docs, labels)
    assert 1 < len(weights) < 1 << 12  # sparse
    held = toxicity.score(docs, weights).filter("held_out").join(labels, "doc_id").collect()
    good, bad = ([r["score"] for r in held if r["toxic"] == t] for t in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.85
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) <= 2


def test_ftrl_step_by_step():
    learner = toxicity.Learner()
    z, n = {}, {}
    for features, label in [([1, 5], 1), ([5, 9], 0), ([1], 1)] * 40:
        w = {f: 0.0 if abs(z.get(f, 0)) <= toxicity.L1 else (np.sign(z[f]) * toxicity.L1 - z[f]) / ((toxicity.BETA + n[f] ** 0.5) / toxicity.ALPHA + toxicity.L2) for f in features}
        g = 1 / (1 + np.exp(-(learner.bias() + sum(w.values())))) - label
        for f in features:
            z[f] = z.get(f, 0.0) + g - ((n.get(f, 0.0) + g * g) ** 0.5 - n.get(f, 0.0) ** 0.5) / toxicity.ALPHA * w[f]
            n[f] = n.get(f, 0.0) + g * g
        learner.learn(np.array(features), label)
    for f in (1, 5, 9):
        assert learner.z[f] == pytest.approx(z[f]) and learner.n[f] == pytest.approx(n[f])


# ---- decontamination


def test_decontamination_equals_plain(spark, documents, texts, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    short = spark.createDataFrame([(1001, "and the"), (1002, "The"), (1003, "ÉTAIT, un"), (1004, texts[3][:40])], "item_id bigint, text string")
    items = items.unionByName(short)
    want = plain.contamination(texts, {r["item_id"]: r["text"] for r in items.collect()})
    got = decontaminate.contaminated_words(documents, items).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got} == want


def test_decontamination_without_broadcast(spark, documents, texts, sf, monkeypatch):
    """Beyond the bound no text and no words are shuffled by shingle."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").unionByName(spark.createDataFrame([(1001, "and the"), (1002, "The"), (1003, texts[3][:40])], "item_id bigint, text string"))
    twice = documents.unionByName(documents.limit(20)).unionByName(spark.createDataFrame([(None, texts[3])], "doc_id bigint, text string"), allowMissingColumns=True)
    rows = lambda: sorted(map(tuple, decontaminate.contaminated_words(twice, items).collect()), key=str)
    want = rows()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert rows() == want and len(want) == len(texts) + 21


# ---- mixing


def test_targets_equal_plain(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = [(s, int(10 ** rng.uniform(0, 5))) for s in [None, "", "a", "B", "é", "zz", "10"]]
        got = mixing.targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()
        want = plain.targets(sizes)
        assert {r["source"]: r["target"] for r in got} == pytest.approx(want)


def test_mix_meets_its_targets_and_reruns_agree(documents):
    out = mixing.mix(documents).collect()
    assert {r["doc_id"]: r["taken"] for r in out} == {r["doc_id"]: r["taken"] for r in mixing.mix(documents.repartition(7)).collect()}
    for source in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert len({r["taken"] // r["size"] for r in own if r["size"]}) <= 2  # complete epochs first
        assert all(r["taken"] <= 3 * r["size"] for r in own)


@pytest.mark.parametrize("sorted_rows", [1 << 16, 300, 3])
def test_mix_equals_plain(spark, sorted_rows, monkeypatch):
    """Weights near zero crowd the keys; the slices at the borders are cut until they are small."""
    monkeypatch.setattr(mixing, "SORTED_ROWS", sorted_rows)
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("word "), (F.pmod(F.xxhash64("id"), F.lit(7)) + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 50 == 1, "c").otherwise("a").alias("source"),
    )
    quality = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, 3.0).when(F.col("doc_id") % 5 < 4, 0.01).otherwise(0.2).alias("weight"))
    keyed = mixing._keyed(docs, quality)
    rows = [(r["doc_id"], r["same"]["source"], r["size"], r["key"]) for r in keyed.collect()]
    want = plain.mix([r[:3] for r in rows], {r[0]: r[3] for r in rows})
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs, quality).collect()} == want
    _, levels = mixing._borders(common.settle(keyed), (1, 2, 3))
    assert levels >= 2 if sorted_rows == 3 else levels <= 2


def test_quality_weights_favour_good_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one word more").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    quality = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("weight"))
    taken = mixing.mix(docs, quality).filter("source = 'a' and taken > 0").collect()
    good = sum(r["doc_id"] % 2 == 0 for r in taken)
    assert good > 1.3 * (len(taken) - good)


# ---- near duplicates


def _copies(seed, groups, size):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    docs = {}
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs[len(docs)] = " ".join(own)
    return docs


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_plain(spark, texts, words, percent):
    docs = {1000 + d: t for d, t in texts.items()} | _copies(1, 12, 12)
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(table, words, percent).collect()}
    assert got == plain.near_duplicates(docs, words, percent)


def test_large_group_of_near_copies(spark):
    """More members than a block, most of them linked through others only."""
    docs = _copies(2, 1, 700)
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(table, 3, 85).collect()}
    assert got == {d: c for d, (_, c) in plain.near_duplicates(docs, 3, 85).items()}


def test_miss_rate_of_the_tables():
    for threshold in (0.8, 0.85, 0.9):
        k = neardup.minhashes_per_half(threshold)
        p = threshold**k
        assert (1 - p) ** neardup.HALVES + neardup.HALVES * p * (1 - p) ** (neardup.HALVES - 1) <= neardup.MISS


def test_connected(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1200)] + [(None, 5), (7, 7)]
    got = {r["id"]: r["root"] for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == plain.components({x for link in real for x in link}, real)


# ---- lines


def test_edit_distance():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 70))) for _ in range(2))
        distance = plain.edit_distance(a, b)
        assert lines.edit_distance(a, b) == distance
        cut = a[:7] + "c" * rng.randint(0, 3) + a[9:]
        for x, y, n in ((a, b, distance), (a, cut, plain.edit_distance(a, cut))):
            assert [lines.within(x, y, most) for most in (n - 1, n, n + 1)] == [False, True, True]


def test_lines_equal_plain(spark, texts):
    rng = random.Random(4)
    docs = dict(list(texts.items())[:120])
    for d in list(docs)[:40]:
        own = docs[d].split("\n")
        line = own[rng.randrange(len(own))]
        at = rng.randrange(len(line) + 1)
        docs[5000 + d] = "new line %d\n" % d + line[:at] + rng.choice(["x", "", " 7 ", "!"]) + line[at + 1 :]
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {(r["doc_id"], r["line"]): r["removed"] for r in lines.duplicate_lines(table).collect()}
    rows = {(d, i): n for d, t in sorted(docs.items()) for i, x in enumerate(t.split("\n")) if (n := lines.normalised(x))}
    forms = list(dict.fromkeys(rows.values()))
    links = [(x, y) for i, x in enumerate(forms) for y in forms[:i] if 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)) and alike(x, y)]
    root, seen, want = plain.components(forms, links), set(), {}
    for place, form in rows.items():
        want[place] = root[form] in seen
        seen.add(root[form])
    assert links and got == want
    kept = {r["doc_id"]: r["text"] for r in lines.without_duplicate_lines(table).collect()}
    assert kept == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if not want.get((d, i))) for d, t in docs.items()}


def test_lines_of_a_text_are_normalised_at_once(texts):
    for t in [*list(texts.values())[:50], "ΑΣ\nΣ Ab1٣ --\n\x1c x\r\ny", "", "\n\n", None]:
        assert lines.normalised_lines(t) == [lines.normalised(x) for x in (t or "").split("\n")]


def test_simhash_counts_bits():
    rng = random.Random(6)
    counts = np.array([1, 3, 255, 256, 700, 2])
    codes = np.array([rng.randrange(2**64) for _ in range(counts.sum())], np.uint64)
    want, at = [], 0
    for n in counts:
        want.append([sum(int(c) >> bit & 1 for c in codes[at : at + n]) for bit in range(64)])
        at += n
    assert lines._votes(codes, counts).tolist() == want


# ---- substrings


def test_chunks_are_the_text_and_resist_insertions(texts):
    gear = substrings._gear()
    for text in list(texts.values())[:60]:
        raw = text.encode()
        ends, words = substrings.chunk_ends(np.frombuffer(raw, np.uint8), gear)
        assert ends[-1] == len(raw) and words[-1] == len(raw.split()) and (np.diff(ends) > 0).all()
        assert [len(raw[:e].split()) for e in ends] == words.tolist()
    raw = max(texts.values(), key=len).encode()
    moved = b"An insertion in front. " + raw
    pieces = [[x[a:b] for a, b in zip([0, *e[:-1]], e, strict=True)] for x in (raw, moved) for e in [substrings.chunk_ends(np.frombuffer(x, np.uint8), gear)[0].tolist()]]
    assert pieces[0][3:] == pieces[1][-len(pieces[0]) + 3 :]


def test_planted_passages_are_found_and_nothing_else(spark):
    rng = random.Random(8)
    new = lambda n: " ".join("".join(rng.choices("abcdefghijklmnoprstuvé", k=rng.randint(3, 9))) for _ in range(n))
    passages = [new(rng.randint(51, 90)) for _ in range(40)]
    docs = {i: new(rng.randint(5, 200)) for i in range(300)}
    planted = {}
    for i, p in enumerate(passages):
        for d in rng.sample(range(300), 3):
            if d not in planted:
                planted[d] = i
                docs[d] = f"{docs[d]}\n{p} {new(30)}"
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    first = {}
    for d in sorted(planted):
        first.setdefault(planted[d], d)
    found = {r["doc_id"]: r for r in substrings.repeated_passages(table).collect()}
    assert set(found) == {d for d in planted if first[planted[d]] != d}
    for d, r in found.items():
        assert r["first_doc_id"] == first[planted[d]] and docs[d][r["first"] : r["last"]].strip() in passages[planted[d]]
    cut = {r["doc_id"]: r["text"] for r in substrings.without_repeats(table).collect()}
    assert all(cut[d] == (t[: found[d]["first"]] + t[found[d]["last"] :] if d in found else t) for d, t in docs.items())


# ---- fingerprints


def test_fingerprints_estimate_the_likeness(documents, texts):
    out = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(documents).collect()}
    order = sorted(texts, reverse=True)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    split = lambda t: {tuple(w[i : i + 5]) for w in [plain.RUN.findall(t)] for i in range(max(1, len(w) - 4)) if w}
    errors = []
    for i, d in enumerate(order):
        text, after = texts[d], texts[order[(i + 1) % len(order)]]
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        import hashlib

        assert (out[d]["n_chars"], out[d]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [out[d]["near_edited"] - jaccard(split(text), split(edited)), out[d]["near_next"] - jaccard(split(text), split(after))]
    assert np.abs(errors).max() < 0.35 and np.abs(errors).mean() < 0.06
    assert len({out[d]["fingerprint"] for d in texts}) <= len(set(texts.values()))


def test_sketches_merge_and_contain(spark):
    rng = random.Random(9)
    long = [str(rng.randrange(10**6)) for _ in range(20_000)]
    part = long[4_000:5_500]
    docs = spark.createDataFrame([(1, " ".join(long), " ".join(part), " ".join(long[:10_000]), " ".join(long[9_996:]))], "id int, a string, b string, c string, d string")
    for name in "abcd":
        docs = fingerprints.with_fingerprint(docs, name, f"f{name}")
    c = F.col
    row = docs.select(
        fingerprints.containment(c("fb"), c("fa")).alias("inside"),
        fingerprints.containment(c("fa"), c("fb")).alias("around"),
        (fingerprints.merged(c("fc"), c("fd")) == c("fa")).alias("merged"),
    ).first()
    assert row["inside"] == 1.0 and 0.04 < row["around"] < 0.12 and row["merged"]


# ---- token files and counts


def _odd_texts():
    rng = random.Random(1)
    parts = ["a", "b", "é", " ", "  ", "\n", "\t", "'s", "'S", "1", "23", ".", ",!", "<|endoftext|>", "<s>", "\xa0", "　", "▁", "中", "😀", "\x1c", "​", "\r", "ß", "İ", "x" * 70, "\x00", "\x85"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(8000)]


def _arrow(texts):
    return pa.array(texts, pa.large_string())


@pytest.mark.parametrize("specials_are_text", [False, True])
def test_byte_ids_equal_the_library(texts, specials_are_text):
    odd = _odd_texts() + list(texts.values())
    own = pieces.ByteIds(vocab.vocabulary("byte_bpe_50k.json"), specials_are_text)
    ids, at = own.ids(_arrow(odd))
    want = own.library.encode_batch(odd, add_special_tokens=False)
    assert [ids[x:y].tolist() for x, y in zip(at, at[1:], strict=False)] == [e.ids for e in want]


def test_recent_pieces_are_remembered_and_results_stay():
    asked = []

    def make(some):
        asked.extend(some)
        return [p * 2 for p in some]

    known = pieces.Remembered(make, most=2000)
    rng = random.Random(3)
    for _ in range(50):
        some = list({b"%d" % rng.randrange(60) for _ in range(20)} | {b"x" * 70})
        assert known(some) == [p * 2 for p in some]
    assert len(known.known) + len(known.before) <= 24 and asked.count(b"x" * 70) == 50 and len(asked) < 50 * 21


def test_token_file_addresses_every_id():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 512, 513, 5000):
        ids = rng.choice([3, 200, 255, 256, 50_000, 70_000, 2**24, 2**32 - 1], n).astype("<u4")
        cuts = np.sort(rng.integers(0, n + 1, 5))
        file = tokenfile.TokenFile(tokenfile.pack(ids, np.concatenate([[0], cuts]), [None, 5, 6, 7, 8, -9]))
        assert [file[i] for i in range(n)] == ids.tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert file.span(a, b).tolist() == ids[a:b].tolist()
        assert file.doc_ids == [None, 5, 6, 7, 8, -9] and file.document(5).tolist() == ids[cuts[-1] :].tolist()


def test_token_files_round_trip(spark, documents, texts):
    path = common.scratch(spark, "tokens")
    listed = tokenfile.write_tokens(documents, vocab.vocabulary("byte_bpe_50k.json"), path, file_ids=5000)
    assert listed.count() > 4
    library = pieces.ByteIds(vocab.vocabulary("byte_bpe_50k.json")).library
    got = {r["doc_id"]: r for r in tokenfile.read_tokens(spark, path).collect()}
    start = 0
    for d in sorted(texts):
        ids = [*library.encode(texts[d], add_special_tokens=False).ids, 0]
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_counts(documents, texts):
    library = sentencepieces.PieceModel(vocab.vocabulary("piece_bpe_32k.model")).library
    for r in tokencounts.count_tokens(documents, vocab.vocabulary("piece_bpe_32k.model")).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)
    assert pieces.by_bytes([5, 5, 30, 1, 1], 10) == [(0, 2), (2, 3), (3, 5)] and pieces.by_bytes([]) == []


# ---- personal data


def _luhn(number):
    digits = [int(c) for c in number if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_surrogates(spark):
    rows = [
        (1, "Write to Jo.Smith9@mail.example.com or JO.SMITH9@MAIL.EXAMPLE.COM, from 10.2.30.200."),
        (2, "Call +1 (974) 555-3436 or +1 974-555-3436; card 4111 1111 1111 1111 is 4111111111111111, 4111111111111112 is none."),
        (3, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and version 4.0.1, 2.0. of 1234 words'),
        (4, "Then Mrs. Anna Miller met Mr. Miller and Frau Schmidt; госпожа Иванова und Mrs Anna Miller."),
        (5, "Nothing here but 12.5 % and a+b or x@y."),
        (6, "jo.smith9@mail.example.com"),
    ]
    out = {r["doc_id"]: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out[5]["text"] == rows[4][1] and not out[5]["pii"]
    mail, loud = (p["surrogate"] for p in out[1]["pii"][:2])
    assert loud == mail.upper() and out[6]["text"] == mail and mail != "jo.smith9@mail.example.com"
    assert [len(x) for x in mail.split(".")] == [2, 11, 7, 3] and out[1]["pii"][2]["surrogate"].count(".") == 3
    phone, other, card, plain_card = (p["surrogate"] for p in out[2]["pii"])
    assert [c for c in phone if c.isdigit()] == [c for c in other if c.isdigit()] and phone[:4] == "+1 (" and phone[8:10] == " " + phone[9]
    assert card.replace(" ", "") == plain_card and _luhn(card) and card.count(" ") == 3 and "4111111111111112 is none" in out[2]["text"]
    assert "version 4.0.1, 2.0. of 1234" in out[3]["text"] and "04dbebab" not in out[3]["text"]
    lady, man, frau, russian, again = (p["surrogate"] for p in out[4]["pii"])
    assert lady == again and len({lady, man, frau, russian}) == 4
    given, family = lady.split(" ")
    assert given in pii.GIVEN["f", "latin"].split() and family.split("-")[0] in pii.FAMILY["f", "latin"].split()
    assert russian.split("-")[0] in pii.FAMILY["f", "cyrillic"].split()


def test_surrogates_stay_distinct(spark):
    people = [("person:m-latin", f"Name{chr(97 + i % 26)}{chr(97 + i // 26)}", ) for i in range(300)] + [("person:f-latin", "Abel"), ("person:f-latin", "Bauer")]
    out = pii.surrogates(spark.createDataFrame(people, "kind string, normal string")).collect()
    drawn = [r["surrogate"] for r in out]
    assert len(out) == 302 and len(set(drawn)) == 302 and not {"Abel", "Bauer"} & set(drawn)


def test_surrogates_end_where_a_class_is_full(spark):
    """All addresses of four one-digit numbers, all five-digit numbers of one prefix, and half of another class."""
    rows = [("ip", f"{a}.{b}.{c}.{d}") for a in range(10) for b in range(10) for c in range(10) for d in range(10)]
    rows += [("phone", f"1{i:04d}") for i in range(10_000)] + [("phone", f"2{i:04d}") for i in range(0, 10_000, 2)]
    rows += [("email", f"{x}@{y}.com") for x in "abcdefghijklmnopqrstuvwxyz" for y in "abcdefghijklmnopqrstuvwxyz"] + [("email", f"ab{i}@cd.ef.com") for i in range(100, 150)]
    out = pii.surrogates(spark.createDataFrame(rows, "kind string, normal string")).collect()
    assert len(out) == len(rows) and len({(r["kind"], r["surrogate"]) for r in out}) == len(rows)
    shape = lambda x: re.sub("[a-z]", "a", re.sub("[0-9]", "0", x))
    assert all(shape(r["normal"]) == shape(r["surrogate"]) for r in out)
    real = {(k, n) for k, n in rows}
    assert not any((r["kind"], r["surrogate"]) in real for r in out if r["normal"].startswith("ab"))
    assert all(r["surrogate"][0] == r["normal"][0] for r in out if r["kind"] == "phone")


def test_family_names_alone_follow_the_full_name(spark):
    texts = ["Then Mrs Anna Miller came. Mrs Miller sat, Mr Miller stood.", "Mrs Miller alone.", "Mrs Anna Miller, Mrs Eva Miller and Mrs Miller."]
    out = [r["pii"] for r in pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()]
    names = [[p["surrogate"] for p in r] for r in out]
    assert names[0][1] == names[0][0].split(" ")[1] != names[0][2] and names[2][0] == names[0][0]
    assert names[1][0] == names[2][2] and len(set(names[2])) == 3  # nobody to follow, or two


def test_every_form_of_mention_is_found_alone(spark):
    """A document with a single mention has nothing else that could draw attention to it."""
    alone = [
        ("card", "Paid by card 4111 1111 1111 1111 on Monday"),
        ("card", "Paid by card 4111-1111-1111-1111 on Monday"),
        ("card", "Paid by card 4111111111111111 on Monday"),
        ("card", "Paid by card 4222222222222 on Monday"),
        ("phone", "Call +4930123456 today"),
        ("phone", "Call +1 974 555 3436 today"),
        ("phone", "Call (974) 555-3436 today"),
        ("phone", "Call 974-555-3436 today"),
        ("phone", "Call 974.555.3436 today"),
        ("ip", "Seen at 10.2.30.200 today"),
        ("email", "Write to jo@example.com today"),
        *(("secret", f"My {name}: abcdefgh12345678 is old") for name in ("token", "Secret", "password", "passwd", "api key", "apikey", "ACCESS_KEY")),
        *(("person", f"Then {t} {n} came") for (_, s), names in pii.TITLES.items() for t in names.split("|") for n in (["Miller"] if s == "latin" else ["Иванов"])),
    ]
    rows = [(i, text) for i, (_, text) in enumerate(alone)]
    out = {r["doc_id"]: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {alone[i]: [p["kind"] for p in out[i]["pii"]] for i, _ in rows} == {x: [x[0]] for x in alone}
    assert all(out[i]["text"] != text for i, text in rows)


def test_lines_with_one_change_are_found(spark):
    """A word swapped, or a letter wrong, added or gone, in lines of every length that stay 0.8 alike or more."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvwé", k=rng.randint(3, 9)))
    docs, pairs = {}, {}
    for i in range(1600):
        own = [word() for _ in range((1, 2, 4, 8, 16, 32, 64, 120)[i // 4 % 8])]
        first, at = " ".join(own), rng.randrange(len(own))
        spoiled = own[at]
        cut = rng.randrange(len(spoiled))
        new = (word(), spoiled[:cut] + "z" + spoiled[cut + 1 :], spoiled[:cut] + "z" + spoiled[cut:], spoiled[:cut] + spoiled[cut + 1 :])[i % 4]
        other = " ".join([*own[:at], new, *own[at + 1 :]])
        if first != other and alike(lines.normalised(first), lines.normalised(other)):
            docs[2 * i], docs[2 * i + 1] = first, other
            pairs[2 * i + 1] = i % 4, len(own)
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    removed = {r["doc_id"] for r in lines.duplicate_lines(table).collect() if r["removed"]}
    for kind in range(4):
        for n in {n for _, n in pairs.values() if n > 1}:
            of = {d for d, x in pairs.items() if x == (kind, n)}
            assert len(of & removed) >= 0.9 * len(of), (kind, n)
    assert removed <= set(pairs) and len(pairs) > 1000


def alike(a, b):
    return lines.edit_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def test_short_lines_miss_no_pair():
    rng = random.Random(13)
    forms = list({"".join(rng.choices("abc", k=rng.randint(1, lines.SHORT))) for _ in range(400)})
    for i, a in enumerate(forms):
        for b in forms[:i]:
            if alike(a, b):
                assert lines.shortened(a) & lines.shortened(b)


def test_trigram_bound_never_drops_a_similar_pair():
    rng = random.Random(14)
    for _ in range(100):
        a = "".join(rng.choices("abcdef ", k=rng.randint(101, 300)))
        b = list(a)
        for at in rng.sample(range(len(b)), rng.randint(0, len(b) // 4)):
            b[at] = rng.choice(["", "x", "ab"])
        b = "".join(b)
        assert lines.similar_lines([a], [b])[0, 0] == alike(a, b)


def test_distance_by_words_is_never_too_small():
    rng = random.Random(18)
    for _ in range(500):
        a, b = ([rng.choice(["ab", "abc", "x", "longer", "aab"]) for _ in range(rng.randint(1, 6))] for _ in range(2))
        assert lines.at_most_by_words(a, b) >= lines.edit_distance(" ".join(a), " ".join(b))
        assert lines.at_most_by_words(a, a) == 0


def test_passages_without_white_space_are_found(spark):
    rng = random.Random(15)
    new = lambda letters, n: "".join(rng.choices(letters, k=n))
    han, code = [chr(0x4E00 + i) for i in range(3000)], "abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"
    docs, want = {}, {}
    for i, letters in enumerate([han, code, han, code]):
        passage = new(letters, 600)
        docs[2 * i] = new(letters, 300) + passage + new(letters, 200)
        docs[2 * i + 1] = passage if i > 1 else new(letters, 100 + i) + passage + new(letters, 50)
        want[2 * i + 1] = passage
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    found = {}
    for r in substrings.repeated_passages(table).collect():
        assert r["first_doc_id"] == r["doc_id"] - 1 and docs[r["doc_id"]][r["first"] : r["last"]] in want[r["doc_id"]]
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["last"] - r["first"]
    assert set(found) == set(want) and min(found.values()) >= 400
    cut = {r["doc_id"]: r["text"] for r in substrings.without_repeats(table).collect()}
    assert all(len(cut[d]) == len(t) - found.get(d, 0) for d, t in docs.items())


def test_passages_of_a_repeated_phrase_are_found(spark):
    rng = random.Random(16)
    new = lambda n: " ".join("".join(rng.choices("abcdefghijklmnoprstuv", k=rng.randint(3, 9))) for _ in range(n))
    docs = {}
    for i in range(60):
        passage = " ".join([new(1 + i % 3)] * (60 // (1 + i % 3)))
        for j in (0, 1):
            docs[2 * i + j] = f"{new(40)} {passage} {new(30)}"
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    assert {r["doc_id"] for r in substrings.repeated_passages(table).collect()} >= set(range(1, 120, 2))


def test_passages_repeated_within_a_document_are_found(spark):
    rng = random.Random(17)
    new = lambda n: " ".join("".join(rng.choices("abcdefghijklmnoprstuv", k=rng.randint(3, 9))) for _ in range(n))
    passage = new(70)
    docs = [(1, " ".join([new(40), passage, new(30), passage, new(30), passage])), (2, new(100)), (3, f"{new(30)} {passage}")]
    found = sorted(substrings.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), key=lambda r: (r["doc"], r["first"]))
    assert [(r["doc_id"], r["first_doc_id"]) for r in found] == [(1, 1), (1, 1), (3, 1)]
    text, second = docs[0][1], docs[0][1].index(passage, docs[0][1].index(passage) + 1)
    assert found[0]["first"] >= second and all(docs[r["doc_id"] - 1][1][r["first"] : r["last"]].strip() in passage for r in found)
    cut = {r["doc_id"]: r["text"] for r in substrings.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert passage in cut[1] and len(cut[1]) < len(text) - 600 and cut[2] == docs[1][1]


def test_gaps_before_a_last_line_separator_divide_words(spark):
    """``$`` would match before a final U+0085, U+2028 or U+2029, which are parts of words."""
    texts = [x for c in "\u0085\u2028\u2029" for x in (f"abc. {c}", f" abc {c}", f"abc{c}. ", f"a b{c}")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = rows.select("doc_id", decontaminate.words_of(F.col("text")).alias("w"), mixing.n_words(F.col("text")).alias("n"), fingerprints.split_words(F.col("text")).alias("s"))
    for r in out.collect():
        t = texts[r["doc_id"]]
        assert (r["w"], r["n"], r["s"]) == (plain.WORD.findall(t), len(plain.RUN.findall(t)), plain.RUN.findall(t))


def test_lines_with_letters_wrong_all_over_are_found(spark):
    """No part of them stays whole, so that no key brings them together; every pair that is similar is linked, and no other."""
    rng = random.Random(21)
    letters = "abcdefghijklmnoprstuvwé"
    docs, want = {}, set()
    for i in range(300):
        own = " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range((3, 6, 12, 30, 70, 160)[i % 6]))
        other = list(own)
        places = [k for k, ch in enumerate(own) if ch != " "]
        for at in rng.sample(places, int(len(own) * rng.choice([0.1, 0.15, 0.19, 0.24]))):
            other[at] = rng.choice(["", "x", "yz", "q"])
        docs[2 * i], docs[2 * i + 1] = own, "".join(other)
        if alike(lines.normalised(docs[2 * i]), lines.normalised(docs[2 * i + 1])):
            want.add(2 * i + 1)
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    assert {r["doc_id"] for r in lines.duplicate_lines(table).collect() if r["removed"]} == want
    assert 100 < len(want) < 280


def test_edits_of_first_halves_are_never_too_many(monkeypatch):
    monkeypatch.setattr(sweep, "FEW", 0)
    rng = random.Random(22)
    for n in (6, 20, 70, 200, 500):
        own = ["".join(rng.choices("abcde é中", k=rng.randint(n - n // 6, n))) for _ in range(12)]
        others = ["".join(rng.choice([ch, ch, ch, ch, "x", "", "日"]) for ch in line) + "ab" for line in own]
        sides = [sweep.Lines(x, np.arange(12) + 12 * k) for k, x in enumerate((own, others))]
        found = {(int(x), int(y)) for i, j in sweep.unlinked(*sides) for x, y in zip(i, j, strict=True)}
        assert {(x, y) for x in range(12) for y in range(12) if alike(own[x], others[y])} <= found
        assert len(found) < 100


def test_small_tables_are_dealt_over_few_partitions(spark):
    """However many partitions the cluster shuffles into, few edges do not leave a file in each."""
    edges = spark.range(300).selectExpr("id as a", "id div 10 * 10 as b").repartition(40)
    assert common.narrow(edges).rdd.getNumPartitions() == 1
    assert common.narrow(edges, 100).rdd.getNumPartitions() == 4
    found = connected(edges)
    assert {r["id"]: r["root"] for r in found.collect()} == {i: i // 10 * 10 for i in range(300)}
    assert found.rdd.getNumPartitions() < 40


def _edited(rng, line, letters):
    """A line with about as many edits as leave it similar, alone or in a row."""
    out, n = list(line), max(0, len(line) // 5 + rng.randint(-2, 2))
    if rng.random() < 0.4:
        at = rng.randrange(len(out))
        out[at : at + rng.choice([0, n])] = rng.choices(letters, k=n)
    else:
        for _ in range(n):
            at = rng.randrange(len(out))
            out[at : at + rng.choice([0, 1, 1])] = rng.choices(letters, k=rng.choice([0, 1, 1]))
            out = out or ["a"]
    return "".join(out)


@pytest.mark.parametrize("few, cells, hits", [(12, 1 << 19, 1 << 18), (0, 100, 30)])
def test_shared_segments_miss_no_similar_pair(monkeypatch, few, cells, hits):
    for name, value in (("FEW", few), ("CELLS", cells), ("HITS", hits)):
        monkeypatch.setattr(sweep, name, value)
    rng = random.Random(23)
    similar = 0
    for n in (5, 6, 8, 10, 11, 15, 16, 24, 60, 79, 80, 100, 160, 300):
        for letters in ("ab", "abc ", "abcdefghijklmnopqrstuvwxyz é中0"):
            own = ["".join(rng.choices(letters, k=rng.randint(max(5, n - n // 6), n))) for _ in range(5)]
            others = [x for line in own for x in (_edited(rng, line, letters) for _ in range(4)) if len(x) >= 5]
            every = list(dict.fromkeys([*own, *others]))
            whole = sweep.Lines(every, np.arange(len(every)))
            found = [(int(x), int(y)) for i, j in sweep.unlinked(whole, whole) for x, y in zip(i, j, strict=True)]
            assert len({frozenset(p) for p in found}) == len(found)
            want = {(x, y) for y in range(len(every)) for x in range(y) if alike(every[x], every[y])}
            assert want <= {tuple(sorted(p)) for p in found}
            sides = [sweep.Lines(x, np.arange(len(x)) + 1000 * k) for k, x in enumerate((own, others))]
            found = {(int(x), int(y)) for i, j in sweep.unlinked(*sides) for x, y in zip(i, j, strict=True)}
            assert {(x, y) for x in range(len(own)) for y in range(len(others)) if alike(own[x], others[y])} <= found
            similar += len(want)
    assert similar > 300


def test_few_pairs_of_long_lines_are_compared_by_edits(monkeypatch):
    """Lines that share most trigrams, though not at like places, are told apart without a table of distances."""
    rng = random.Random(24)
    parts = ["".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(1, 3))) for _ in range(150)]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 3)))
    every = [" ".join(word() for _ in range(140))[:600] for _ in range(200)]
    compared = []
    bound = sweep.least_edits
    monkeypatch.setattr(sweep, "least_edits", lambda *args: compared.append(len(args[4][0])) or bound(*args))
    whole = sweep.Lines(every, np.arange(len(every)))
    left = sum(len(i) for i, _ in sweep.unlinked(whole, whole))
    assert sum(compared) + left < len(every) * (len(every) - 1) / 2 / 50
