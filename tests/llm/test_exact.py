"""Results do not hang on hashes: strings made to collide, and plain versions of op3's matches."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import decontamination, language_model, near_dedup, quality, words
from footfall.llm.words import ALPHANUMERIC, block_of, find_words, numbered

SCHEMA = "doc_id long, text string"


def twins(size):
    """Two words of two letters in the order of Thue and Morse: no polynomial tells them apart."""
    bits = [0]
    while len(bits) < size:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.fixture(params=[1024, 4096])
def pair(request):
    return twins(request.param)


@pytest.fixture(params=[False, True])
def colliding(request, monkeypatch):
    """Once as it is, and once with hashes that collide for most words."""
    if request.param:
        hashes = words.byte_hashes

        def few(data, starts, ends):
            return hashes(data, starts, ends) % np.uint64(3)

        monkeypatch.setattr(words, "byte_hashes", few)
    return request.param


BYTES = st.lists(st.sampled_from([b"", b"a", b"b", b"ab", b"a" * 9, b"a" * 600, b"b" * 600]))


@settings(max_examples=100, deadline=None)
@given(BYTES, st.sampled_from([1, 2, 1 << 62]))
def test_numbers_are_exact(texts, kinds):
    block = block_of(texts)
    hashes = words.byte_hashes
    words.byte_hashes = lambda *ranges: hashes(*ranges) % np.uint64(kinds)
    try:
        ids, first, _ = numbered(block.data, block.offsets[:-1], block.offsets[1:])
    finally:
        words.byte_hashes = hashes
    told = {}
    for text, number in zip(texts, ids.tolist(), strict=True):
        assert told.setdefault(text, number) == number
    assert sorted(told.values()) == list(range(len(told)))
    assert all(told[texts[at]] == number for number, at in enumerate(first.tolist()))


def test_twins_are_told_apart_by_their_hashes(pair):
    block = block_of([x.encode() for x in pair])
    a, b = words.byte_hashes(block.data, block.offsets[:-1], block.offsets[1:])
    assert a != b


def test_quality_counts_true_repeats_only(pair, colliding):
    a, b = (x.encode() for x in pair)
    lines = quality.counts(block_of([a + b"\n" + b, b"\n".join([a, a, b])]))
    assert lines["n_dup_lines"].tolist() == [0, 1]
    triples = quality.counts(block_of([b"x %s y x %s y" % (a, b), b"x %s y x %s y" % (a, a)]))
    assert triples["n_repeat_words"].tolist() == [0, 6]


def test_near_duplicates_are_true_ones(spark, pair):
    a, b = pair
    rows = [(1, a), (2, b), (3, f"{a} {b}"), (4, f"{b} {a}"), (5, a)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in near_dedup.near_duplicates(df, size=2).collect()}
    assert {i: r.component_id for i, r in found.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    assert [r.doc_id for r in near_dedup.keep_one(df, size=2).orderBy("doc_id").collect()] == [
        1,
        2,
        3,
        4,
    ]


def test_shingles_are_exact(colliding):
    block = block_of([b"a b a b c", b"A b", b"a", b"b", b"", b"a b a b c a"])
    number, _, rows = near_dedup.shingles(block, 2)
    sets = [set(number[rows == r].tolist()) for r in range(6)]
    assert [len(s) for s in sets] == [3, 1, 1, 1, 0, 4]
    assert sets[1] < sets[0] < sets[5]
    assert not sets[2] & sets[3] and not sets[2] & sets[0]


def test_language_model_knows_true_words_only(spark, pair):
    a, b = pair
    rows = [(1, a, True), (2, f"{a} {b}", False), (3, b, False)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, learn boolean")
    found = {r.doc_id: r for r in language_model.score_texts(df).collect()}
    assert [found[i].n_known for i in (1, 2, 3)] == [2, 2, 1]
    # Two tokens of two kinds are learned; the end of the text is one of them.
    assert found[3].base_score == pytest.approx(np.log10(1 / 5) + np.log10(2 / 5))


def test_a_shard_tells_words_apart(colliding):
    shard = language_model._Shard()
    rows = words.pa.RecordBatch.from_pydict({"doc_id": [1, 2], "learn": [True, True]})
    for texts in ([b"one two three one", b"four"], [b"five one", b"two six seven eight"]):
        block = block_of(texts, rows)
        shard.add(block)
    row = shard.row(0)
    counted = dict(
        zip(row.column("words")[0].as_py(), row.column("counts")[0].as_py(), strict=True)
    )
    want = dict.fromkeys([b"three", b"four", b"five", b"six", b"seven", b"eight"], 1)
    assert counted == {b"one": 3, b"two": 2, b" ": 4, **want}


def test_contamination_of_twins(spark, pair):
    a, b = pair
    docs = spark.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y")], SCHEMA)
    tests = spark.createDataFrame([("t", f"x {a} y")], "item_id string, text string")
    found = decontamination.find_contamination(docs, tests).orderBy("doc_id").collect()
    assert [(r.n_hit, r.longest_match) for r in found] == [(3, 3), (0, 0)]


# --- matches ---------------------------------------------------------------------------


def plain(texts, items, window):
    word = re.compile(rb"[0-9a-z\x80-\xff]+")
    out = []
    for text in texts:
        own = word.findall(text.lower())
        hit, names, longest = set(), set(), 0
        for k, item in enumerate(word.findall(x.lower()) for x in items):
            n = min(window, len(item))
            for s in range(len(item) - n + 1 if n else 0):
                for a in range(len(own) - n + 1):
                    if own[a : a + n] != item[s : s + n]:
                        continue
                    hit.update(range(a, a + n))
                    names.add(k)
                    while a + n < len(own) and s + n < len(item) and own[a + n] == item[s + n]:
                        n += 1
                    longest, n = max(longest, n), min(window, len(item))
        out.append((len(hit), sorted(names), longest))
    return out


WORDS = st.lists(st.sampled_from([b"a", b"b", b"C"]), max_size=14).map(b" ".join)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(WORDS, min_size=1, max_size=4),
    st.lists(WORDS, min_size=1, max_size=4),
    st.integers(1, 5),
    st.sampled_from([1, 4, 1 << 20]),
)
def test_matches(texts, items, window, lot):
    before = decontamination.LOT
    decontamination.LOT = lot
    try:
        tests = decontamination._Tests([(str(i), x) for i, x in enumerate(items)], window)
        block = block_of(texts).lower()
        found = find_words(block, ALPHANUMERIC)
        hit = np.zeros(len(found.starts) + 1, np.int64)
        names, longest = [set() for _ in texts], [0] * len(texts)
        for first, q, common in decontamination._matches(block, found, tests, window):
            for a, b, c in zip(first.tolist(), q.tolist(), common.tolist(), strict=True):
                hit[a] += 1
                hit[a + tests.lengths[b]] -= 1
                row = found.rows[a]
                names[row].add(int(tests.words.rows[tests.starts[b]]))
                longest[row] = max(longest[row], c)
    finally:
        decontamination.LOT = before
    covered = np.cumsum(hit)[:-1] > 0
    got = [
        (int(covered[found.rows == r].sum()), sorted(names[r]), longest[r])
        for r in range(len(texts))
    ]
    assert got == plain(texts, items, window)


def test_a_copied_book_takes_seconds(spark):
    random = np.random.default_rng(9)
    book = " ".join(f"w{i}" for i in random.integers(0, 5000, 100_000))
    docs = spark.createDataFrame([(1, f"before {book} after"), (2, book[:5000])], SCHEMA)
    tests = spark.createDataFrame([("book", book)], "item_id string, text string")
    began = time.perf_counter()
    found = decontamination.find_contamination(docs, tests).orderBy("doc_id").collect()
    assert time.perf_counter() - began < 30
    assert (found[0].longest_match, found[0].n_hit) == (100_000, 100_000)


def test_too_many_tests_stop(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_TEST_BYTES", 10)
    docs = spark.createDataFrame([(1, "x")], SCHEMA)
    tests = docs.select(F.lit("t").alias("item_id"), F.lit("a longer text").alias("text"))
    with pytest.raises(ValueError, match="10 at most"):
        decontamination.find_contamination(docs, tests)
