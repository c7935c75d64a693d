"""The pieces that operators are made of, against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import chat, decontamination, license_scan, near_dedup, substring_dedup
from footfall.llm.components import components
from footfall.llm.suffix_sort import Suffixes, verified
from footfall.llm.words import SPACED, block_of, blocks, find_words, word_hashes

TEXT = st.text(alphabet="abé \n\t\\<>/turnsay", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_of_a_block(texts):
    block = block_of([t.encode() for t in texts])
    words = find_words(block, SPACED)
    for i, text in enumerate(texts):
        own = range(words.offsets[i], words.offsets[i + 1])
        found = [block.data[words.starts[k] : words.ends[k]].tobytes().decode() for k in own]
        assert found == text.split()
        assert all(words.rows[k] == i for k in own)
    hashes = word_hashes(block, words)
    spelled = [t for text in texts for t in text.split()]
    assert len(set(hashes.tolist())) == len(set(spelled))


def test_blocks_cut_between_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["aa", None, "b" * 10, "", "cc"], "n": range(5)})
    found = list(blocks(iter([batch]), limit=4))
    assert [b.text(i) for b in found for i in range(b.rows.num_rows)] == [
        b"aa",
        b"",
        b"b" * 10,
        b"",
        b"cc",
    ]
    assert [n for b in found for n in b.rows.column("n").to_pylist()] == list(range(5))
    assert max(len(b.data) for b in found) == 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 8))
def test_suffix_array(symbols, depth):
    text = np.array(symbols, np.int64)
    order = decontamination.suffix_array(text, depth)
    assert sorted(order.tolist()) == list(range(len(symbols)))

    def head(i):
        """The symbols of a row: 0 ends it."""
        own = symbols[i : i + depth]
        return own[: own.index(0)] if 0 in own else own

    heads = [head(i) for i in order]
    assert heads == sorted(heads)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.data())
def test_search(symbols, data):
    text = np.array([*symbols, 0], np.int64)
    order = decontamination.suffix_array(text, 4)
    width = data.draw(st.integers(1, 4))
    query = data.draw(st.lists(st.integers(1, 3), min_size=width, max_size=width))
    low, high = decontamination.search(text, order, np.array([query]), np.array([width]))
    want = {i for i in range(len(text)) if text[i : i + width].tolist() == query}
    assert set(order[low[0] : high[0]].tolist()) == want


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=40, max_size=300), st.integers(17, 30), st.integers(1, 4))
def test_suffix_sort(data, depth, letters):
    raw = np.frombuffer(data, np.uint8) % letters
    starts = np.arange(len(raw) - depth + 1)
    groups = (starts >= len(starts) // 2).astype(np.int64)
    suffixes = Suffixes(raw, depth)
    order = suffixes.sorted(starts, groups)
    plain = sorted(starts.tolist(), key=lambda i: (groups[i], raw[i : i + depth].tobytes()))
    got = [(groups[i], raw[i : i + depth].tobytes()) for i in order]
    assert got == [(groups[i], raw[i : i + depth].tobytes()) for i in plain]
    p, q = order[:-1], order[1:]
    common = suffixes.common(p, q)
    for a, b, n in zip(p, q, common, strict=True):
        want = next((k for k in range(depth) if raw[a + k] != raw[b + k]), depth)
        assert n == want
    equal = [bool((raw[a : a + depth] == raw[b : b + depth]).all()) for a, b in zip(p, q, strict=True)]
    assert verified(raw, p, q, depth).tolist() == equal


@pytest.mark.parametrize("segment", [64, 1 << 20])
def test_stretches_hold_each_window_once(monkeypatch, segment):
    """Equal windows have equal anchors, and a text cut into segments still has them all."""
    monkeypatch.setattr(substring_dedup, "SEGMENT", segment)
    random.seed(4)
    same = bytes(random.randrange(97, 100) for _ in range(300))
    texts = [same[50:] + b"abc", b"xy" * 150, same, b"z" * 5, b"ab" * 30 + same]
    length, anchors = 60, {}
    for text in texts:
        start, end, anchor, twice = substring_dedup._cut(text, length)
        windows = Counter()
        for a, b, own in zip(start, end, anchor, strict=True):
            for w in range(a, b - length + 1):
                windows[w] += 1
                anchors.setdefault(text[w : w + length], set()).add(int(own))
        assert windows == Counter(range(max(0, len(text) - length + 1)))
    assert all(len(x) == 1 for x in anchors.values())


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for size in (3, 40, 2000):
        for share in (0.2, 0.5, 0.8):
            both = rng.integers(0, 2**62, size=size, dtype=np.uint64)
            cut = int(size * share)
            other = np.concatenate([both[:cut], rng.integers(0, 2**62, size - cut, np.uint64)])
            found = np.concatenate([both, other])
            rows = np.repeat([0, 1], size)
            made = near_dedup.sketch(found, rows, 3)
            assert (made[:2] != near_dedup._UNSET).all()
            assert (made[2] == near_dedup._UNSET).all()
            errors.append((made[0] == made[1]).mean() - cut / (2 * size - cut))
    assert np.abs(errors).max() < 0.16


def test_linked_parts_are_those_of_all_pairs():
    import zstandard

    random.seed(1)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        words = [w if random.random() > random.choice([0.01, 0.05, 0.2]) else "x" for w in base]
        texts.append(" ".join(words))
    keys = [b"%02d" % i for i in range(len(texts))]
    table = pa.table(
        {"packed": [zstandard.compress(t.encode()) for t in texts], "part": keys}
    )
    got = near_dedup._links(table, 2, 80)
    label = dict(zip(keys, keys, strict=True))
    label |= dict(zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True))
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    want = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    want[i] = want[j] = min(want[i], want[j])
    assert [label[k] for k in keys] == [keys[w] for w in want]


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    label = {n: n for e in edges if None not in e for n in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    alone = {5} if all(e == (5, 5) for e in edges if 5 in e) else set()
    assert {r.node: r.label for r in found} == {n: m for n, m in label.items() if n not in alone}
    assert len(found) == len({r.node for r in found})


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escapes_are_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not chat._PLAIN.search(escaped) or all(
        len(m[1]) % 2 for m in chat._PLAIN.finditer(escaped)
    )


def test_alignment_bridges_gaps():
    text = np.arange(100, dtype=np.uint64)
    template = np.array([10, 11, 12, 500, 13, 14, 17, 18], np.uint64)
    matched, first, end = license_scan.align(text, template, 10, 4)
    assert (matched, first, end) == (7, 10, 19)
    assert license_scan.align(text, np.array([900], np.uint64), 3, 4) == (0, 0, 0)


def test_winnowing_picks_in_every_window():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 50, 200).astype(np.uint64)
    offsets = np.array([0, 3, 3, 90, 200])
    picked = set(license_scan.winnow(hashes, offsets, 4).tolist())
    for a, b in zip(offsets, offsets[1:], strict=False):
        for start in range(a, max(a + 1, b - 3)):
            if a < b:
                assert picked & set(range(start, min(start + 4, b)))


def test_a_changed_license_is_found_with_its_span(spark):
    notice = re.findall("[A-Za-z]+", license_scan.TEMPLATES["MIT permission"])
    changed = [w for i, w in enumerate(notice) if i % 17 != 5]
    text = "code starts " + " ".join(changed) + " code ends"
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    rows = {r.doc_id: r.licenses for r in license_scan.scan_licenses(df).collect()}
    assert rows[2] == []
    (find,) = rows[1]
    assert find.template == "MIT permission" and 0.85 < find.coverage < 1
    assert find.first == 2 and find.end == 2 + len(changed)


def _names(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(license_scan.scan_licenses(df).collect())
    return [[find.template for find in row.licenses] for row in rows]


def test_licenses_are_not_taken_for_their_relatives(spark):
    gnu = "This work is licensed under the GNU {} License, version {}. 2 more words"
    cases = {
        gnu.format("General Public", "3"): ["GPL-3.0 notice"],
        gnu.format("General Public", "2"): ["GPL-2.0 notice"],
        gnu.format("General Public", "2.0"): ["GPL-2.0 notice"],
        gnu.format("General Public", "2.1"): [],
        gnu.format("General Public", "4"): [],
        gnu.format("Lesser General Public", "3"): ["LGPL-3.0 notice"],
        gnu.format("Lesser General Public", "2.1"): ["LGPL-2.1 notice"],
        gnu.format("Affero General Public", "3"): ["AGPL-3.0 notice"],
        "Some prose. Licensed under CC BY 4.0. And on": ["CC-BY-4.0 notice"],
        "Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0 notice"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0 notice"],
        "Licensed under CC BY-NC-SA 3.0.": ["CC-BY-NC-SA-3.0 notice"],
        "Licensed under CC BY-NC 1.0.": [],
        "Released under the BSD License.": ["BSD notice"],
        "Released under the BSD 3-Clause License.": ["BSD-3-Clause notice"],
        "Released under the MIT-0 License.": [],
        "Licensed under the Apache License, Version 1.1.": [],
        "Licensed under the MIT License and the Apache License, Version 2.0.": [
            "Apache-2.0 notice",
            "MIT notice",
        ],
        "Released under the Foo License.": [],
    }
    assert dict(zip(cases, _names(spark, *cases), strict=True)) == cases


def test_every_template_finds_itself_alone(spark):
    templates = dict(license_scan.TEMPLATES)
    found = _names(spark, *[f"Prose before. {text} Prose after." for text in templates.values()])
    assert dict(zip(templates, found, strict=True)) == {name: [name] for name in templates}


def test_changed_whole_licenses_keep_their_name(spark):
    texts = license_scan.TEMPLATES
    agpl = texts["GPL-3.0"].replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC")
    agpl = agpl.replace("GNU General Public", "GNU Affero General Public")
    holder = texts["BSD-3-Clause"].replace("the copyright holder nor", "Some Company Inc nor")
    lost = " ".join(w for i, w in enumerate(texts["MPL-2.0"].split()) if i < 9 or i % 40)
    assert _names(spark, agpl, holder, lost, texts["GPL-3.0"][200:]) == [
        ["AGPL-3.0 header"],
        ["BSD-3-Clause"],
        ["MPL-2.0"],
        ["GPL-3.0 header"],
    ]
