"""Operators on vectors, against plain versions that look at every pair."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import exact_search, hard_negatives, vector_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHES = "row rank score pivot far wanted ring pack slot place own label_error x of anchor".split()
INF = math.inf


def clashing(df):
    return df.select("*", *[F.lit("x").alias(name) for name in CLASHES])


def drawn(seed, n, size=16, groups=6, copies=0):
    """Rows around a few middles, the first ``copies`` of them alike."""
    random = np.random.default_rng(seed)
    middles = random.normal(size=(groups, size))
    own = random.integers(0, groups, n)
    rows = middles[own] + 0.3 * random.normal(size=(n, size))
    rows[:copies] = rows[0]
    rows = (rows / 8).astype(np.float32)
    ids = random.permutation(3 * n)[:n]
    labels = random.integers(0, 3, n)
    return [(int(i), x.tolist(), int(c)) for i, x, c in zip(ids, rows, labels, strict=True)]


ODD = [
    (0, [0.5, 0.25, -0.125, 1.0, 0.5, 0.5, 0.5, 0.5], 1),
    (0, [0.5, 0.25, -0.125, 1.0, 0.5, 0.5, 0.5, 0.5], 1),
    (2, [0.5, 0.25, -0.125, 1.0, 0.5, 0.5, 0.5, 0.5], 2),
    (4, [0.25, 0.5], None),
    (6, [], 2),
    (8, None, 1),
    (10, [0.5, None, 0.25], 1),
    (12, [0.5, math.nan], 1),
    (14, [0.5, -INF], 1),
    (None, [0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0], 2),
    (16, [-0.001] * 8, 1),
    (18, [0.3, 0.2, 0.1, 0.3, 0.2, 0.1, 0.3, 0.2], 2),
    (20, [0.4, 0.2, 0.1, 0.3, 0.2, 0.1, 0.3, 0.2], None),
]
TABLES = {
    "groups": drawn(1, 700),
    "copies": drawn(2, 600, copies=300),
    "alike": [(i, [0.5, 0.25], i % 2) for i in range(90)],
    "odd": ODD,
    "one": ODD[:1],
    "none": [],
}


def sound(rows):
    return [
        r
        for r in rows
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]


def whole(rows, scale, parts=1):
    size = max((len(r[1]) for r in rows), default=0)
    size = -(-size // parts) * parts
    filled = [[*r[1], *[0.0] * (size - len(r[1]))] for r in rows]
    return [[math.floor(float(np.float32(x)) * scale) for x in v] for v in filled]


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


# --- codes -----------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    rows = sound(rows)
    points = whole(rows, 4096, parts)
    named = [i for i, r in enumerate(rows) if r[0] is not None]
    first = sorted(named, key=lambda i: (rows[i][0], rows[i][1]))[:entries]
    if not first:
        return []
    wide = len(points[0]) // parts
    codes, errors, digits = [""] * len(rows), [0] * len(rows), []
    for p in range(parts):
        own = [v[p * wide : (p + 1) * wide] for v in points]
        book = [own[i] for i in first]
        for turn in range(rounds + 1):
            apart = [[squared(v, e) for e in book] for v in own]
            entry = [d.index(min(d)) for d in apart]
            for k in range(len(book)):
                held = [v for v, e in zip(own, entry, strict=True) if e == k]
                if held and turn < rounds:
                    book[k] = [sum(c) // len(held) for c in zip(*held, strict=True)]
        digits += [x for e in book for x in e]
        for i, k in enumerate(entry):
            codes[i] += f"{k:02x}"
            errors[i] += apart[i][k]
    of = {}
    for r, e in zip(rows, errors, strict=True):
        of[r[2]] = of.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(map(str, digits)).encode()).hexdigest()
    return [
        (r[0], r[2], c, e, of[r[2]], digest) for r, c, e in zip(rows, codes, errors, strict=True)
    ]


@pytest.mark.parametrize("name", TABLES)
def test_codes(spark, name):
    df = spark.createDataFrame(TABLES[name], SCHEMA).repartition(3)
    want = sorted(map(str, plain_codes(TABLES[name])))
    for table in (df, clashing(df)):
        found = vector_codes.compress(table)
        assert found.columns == "vec_id label code error label_error codebooks_sha256".split()
        assert sorted(str(tuple(r)) for r in found.collect()) == want


def test_codes_in_small_blocks(spark, monkeypatch):
    """Blocks share nothing but the codebooks."""
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 37)
    df = spark.createDataFrame(TABLES["copies"], SCHEMA).repartition(2)
    found = vector_codes.compress(df, parts=3, entries=5, rounds=2).collect()
    want = plain_codes(TABLES["copies"], 3, 5, 2)
    assert sorted(str(tuple(r)) for r in found) == sorted(map(str, want))


POINT = st.lists(st.integers(-4, 4), min_size=2, max_size=2)
POINTS = st.lists(POINT, min_size=1, max_size=120)


@settings(max_examples=150, deadline=None)
@given(POINTS, st.lists(POINT, min_size=1, max_size=6))
def test_trees_find_the_nearest_entry(points, book):
    points, book = np.array(points, np.int64), np.array(book, np.int64)
    tree = vector_codes.Tree.unpacked(vector_codes.grow(points).packed())
    want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert vector_codes.entries_of(tree, points, book).tolist() == want.tolist()
    sums = vector_codes.entry_sums(tree, points, book)
    for k in range(len(book)):
        own = points[want == k]
        assert sums[k].tolist() == [len(own), *own.sum(axis=0).tolist()]


def test_balls_hold_their_points():
    random = np.random.default_rng(3)
    points = random.integers(-200, 200, (2000, 4))
    points[:700] = points[0]
    tree = vector_codes.grow(points)
    assert sorted(tree.order.tolist()) == list(range(2000))
    for i in range(len(tree.start)):
        own = points[tree.order[tree.start[i] : tree.stop[i]]]
        assert (tree.total[i] == own.sum(axis=0)).all()
        away = np.sqrt(((own - tree.centre[i]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[i] + 1e-9
        if tree.left[i] >= 0:
            left, right = tree.left[i], tree.right[i]
            assert (tree.start[left], tree.stop[right]) == (tree.start[i], tree.stop[i])
            assert tree.stop[left] == tree.start[right]


def test_most_of_a_tree_is_settled_in_whole_balls():
    random = np.random.default_rng(4)
    middles = random.integers(-4000, 4000, (16, 8))
    points = middles[random.integers(0, 16, 4096)] + random.integers(-40, 40, (4096, 8))
    tree = vector_codes.grow(points)
    single = sum(
        len(rows)
        for _, _, rows, _ in vector_codes._nearest(tree, points, middles)
        if rows is not None
    )
    assert single < 400


# --- search ----------------------------------------------------------------------------


def plain_search(rows, k=5, every=50):
    rows = [r for r in sound(rows) if r[0] is not None]
    points = whole(rows, 256)
    out = []
    for i, r in enumerate(rows):
        if r[0] % every == 0:
            scored = [(-dot(points[i], v), rows[j][0]) for j, v in enumerate(points) if j != i]
            out += [(r[0], n + 1, x[1], -x[0]) for n, x in enumerate(sorted(scored)[:k])]
    return sorted(out)


def searched(df, every=50, **options):
    found = exact_search.nearest(df, F.col("vec_id") % every == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("name", TABLES)
def test_search(spark, name):
    df = spark.createDataFrame(TABLES[name], SCHEMA).repartition(3)
    every = 50 if len(TABLES[name]) > 100 else 2
    want = plain_search(TABLES[name], every=every)
    assert searched(df, every) == want
    assert searched(clashing(df), every) == want


def test_search_in_small_rings(spark, monkeypatch):
    """Many rounds, rings and packs."""
    monkeypatch.setattr(exact_search, "RING_ROWS", 16)
    monkeypatch.setattr(exact_search, "PACK_ROWS", 5)
    df = spark.createDataFrame(TABLES["copies"], SCHEMA).repartition(2)
    assert searched(df, 7, k=9, pivots=4) == plain_search(TABLES["copies"], 9, 7)


def test_neither_queries_nor_rings_go_to_every_task(spark):
    """Spark judges them by the bytes of files, and what is asked is a multiple of the packs."""
    noise = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.xxhash64("id", i) % 100 / 256)
    df = spark.range(20_000).select(F.col("id").alias("vec_id"), noise.alias("embedding"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1500k")
    try:
        got = searched(df, every=8)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    points = np.floor(256 * np.array([r.embedding for r in df.orderBy("vec_id").collect()]))
    assert [x[:2] for x in got] == [(i, n) for i in range(0, 20_000, 8) for n in range(1, 6)]
    for at in range(0, len(got), 250):
        query = got[at][0]
        scores = points @ points[query]
        scores[query] = -np.inf
        best = np.argsort(-scores, kind="stable")[:5]
        assert [x[2:] for x in got[at : at + 5]] == [(j, scores[j]) for j in best]


def test_most_rings_are_never_read(spark, monkeypatch):
    """Groups that lie apart: the bounds leave out the rings of other groups."""
    monkeypatch.setattr(exact_search, "RING_ROWS", 32)
    asked = []
    scored = exact_search._scored

    def counted(pairs, *rest):
        asked.append(pairs.selectExpr("sum(octet_length(slots)) / 8").head()[0] or 0)
        return scored(pairs, *rest)

    monkeypatch.setattr(exact_search, "_scored", counted)
    rows = drawn(5, 1500, groups=5)
    rows = [(i, (4 * np.array(x)).round(1).tolist(), c) for i, x, c in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert searched(df) == plain_search(rows)
    queries = sum(1 for r in rows if r[0] % 50 == 0)
    assert sum(asked) < 0.6 * queries * 1500 / 32


def test_a_bound_holds_for_all_pairs():
    random = np.random.default_rng(6)
    rows = random.integers(-300, 300, (400, 7))
    pivots = rows[:5].astype(float)
    away = exact_search._distances(rows, pivots)
    own = away.argmin(axis=1)
    far = away[np.arange(400), own]
    directory = exact_search.Directory(
        np.arange(400), own, far, far, vectors.squares(rows), pivots
    )
    _, limit = directory.limits(rows)
    assert (rows @ rows.T <= limit).all()


# --- hard negatives --------------------------------------------------------------------


def plain_negatives(rows, every):
    rows = [r for r in sound(rows) if r[0] is not None and r[2] is not None]
    points = whole(rows, 256)
    out = []
    for i, r in enumerate(rows):
        if r[0] % every:
            continue
        others = [j for j in range(len(rows)) if j != i]
        scored = sorted((-dot(points[i], points[j]), rows[j][0], rows[j][2]) for j in others)
        for p in [x for x in scored if x[2] == r[2]][:5]:
            band = [
                x for x in scored if x[2] != r[2] and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]
            ]
            out += [(r[0], p[1], n + 1, x[1], -p[0], -x[0]) for n, x in enumerate(band[:10])]
    return sorted(out)


def mined(df, every, **options):
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    assert found.columns == (
        "anchor_id positive_id rank negative_id positive_score negative_score".split()
    )
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("name", TABLES)
def test_negatives(spark, name):
    df = spark.createDataFrame(TABLES[name], SCHEMA).repartition(3)
    every = 20 if len(TABLES[name]) > 100 else 2
    want = plain_negatives(TABLES[name], every)
    assert want or name not in ("groups", "copies", "odd")
    assert mined(df, every) == want
    clashes = clashing(df)
    assert mined(clashes, every) == want


def test_negatives_in_small_stretches(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "STRETCH_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", 4)
    df = spark.createDataFrame(TABLES["copies"], SCHEMA).repartition(2)
    assert mined(df, 12, clusters=3) == plain_negatives(TABLES["copies"], 12)


def test_a_list_bounds_all_anchors_of_its_cluster():
    random = np.random.default_rng(7)
    rows = random.integers(-90, 90, (300, 6))
    rows[:3] = 0
    middles = random.normal(size=(4, 6))
    middles /= np.sqrt((middles**2).sum(axis=1))[:, None]
    flat = hard_negatives.Clusters(middles, np.zeros(4))
    angles = flat.angles_to(rows)
    own = angles.argmin(axis=1)
    widest = np.array([angles[own == c, c].max(initial=0) for c in range(4)])
    bounds = hard_negatives.Clusters(middles, widest).bounds(rows)
    length = np.sqrt((rows**2).sum(axis=1))
    for c in range(4):
        anchors = np.flatnonzero(own == c)
        limit = length[anchors][:, None] * bounds[:, c] + 1
        assert (rows[anchors] @ rows.T <= limit).all()


# --- helpers ---------------------------------------------------------------------------


@pytest.mark.parametrize("size", [200, 5_000, 2**24 - 1])
def test_products_are_exact(size):
    random = np.random.default_rng(8)
    a, b = random.integers(-size, size, (20, 33)), random.integers(-size, size, (30, 33))
    want = [[dot(x, y) for y in b.tolist()] for x in a.tolist()]
    assert vectors.products(a, b).astype(np.int64).tolist() == want


def test_a_component_too_large_stops(spark):
    df = spark.createDataFrame([(0, [1e30], 1)], SCHEMA)
    for run in (
        lambda: vector_codes.compress(df),
        lambda: searched(df),
        lambda: mined(df, 1),
    ):
        with pytest.raises(ValueError, match="beyond"):
            run()


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 4), min_size=6, max_size=6), min_size=1, max_size=5),
    st.permutations(range(6)),
    st.integers(1, 7),
)
def test_leading(scores, ids, k):
    table, ids = np.array(scores, np.float32), np.array(ids)
    vectors.hide(table, table == 2)
    floor = np.full(len(table), 1)
    rows, columns = vectors.leading(table, ids, floor, k)
    want = []
    for i, row in enumerate(scores):
        seen = [j for j, x in enumerate(row) if x not in (0, 2)]
        want += [(i, j) for j in sorted(seen, key=lambda j: (-row[j], ids[j]))[:k]]
    assert list(zip(rows.tolist(), columns.tolist(), strict=True)) == want


@given(st.lists(st.lists(st.integers(0, 2), max_size=5), max_size=5), st.integers(1, 3))
def test_pieces(batches, size):
    flat = sorted(x for b in batches for x in b)
    cut, made = 0, []
    for b in batches:
        keys = pa.array(flat[cut : cut + len(b)], pa.int64())
        made.append(pa.RecordBatch.from_pydict({"k": keys}))
        cut += len(b)
    found = [p.column("k").to_pylist() for p in vectors.pieces(iter(made), "k", size)]
    assert [x for p in found for x in p] == flat
    assert all(len(set(p)) == 1 and len(p) <= size for p in found)
    assert all(len(a) == size for a, b in zip(found, found[1:], strict=False) if a[0] == b[0])
