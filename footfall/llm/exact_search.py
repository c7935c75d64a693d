"""Exact search for the highest inner products, by distances to pivots.

Every vector is keyed by its nearest pivot and the distance to it. Sorted by that key, the
vectors of a pivot form rings around it, and each ring is a row of the index. A query that
lies at distance d from a pivot is at least |d - r| away from a vector at distance r from it,
so its inner product with a vector no longer than m is at most (|q|^2 + m^2 - (d - r)^2) / 2.
A query takes rings from the nearest outwards, eight times as many each time, and leaves out
all whose bound is below the k-th score that it has found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.tables import kept, need
from footfall.llm.vectors import (
    NONE,
    Shape,
    byte_rows,
    finite,
    from_byte_rows,
    hide,
    leading,
    longs,
    matrix,
    measured,
    pieces,
    products,
    record,
    spread,
    squares,
    whole,
)

SCALE = 256
SAMPLE = 2048  # vectors that pivots are chosen from
PIVOTS = 32
RING_ROWS = 1024  # of a ring, while there are at most RINGS of them
RINGS = 1 << 16
GROUPS = 64  # of rings, while the vectors of one take at most GROUP_BYTES
GROUP_BYTES = 16 << 20
GROUP_BITS = 20  # of a ring's number, below those of its group
PACK_ROWS = 512  # queries that travel together
GROWTH = 8  # times as many rings in the next round
AT_ONCE = 1 << 20  # distances between queries and rings that are held at a time

_RINGS = pa.schema(
    [
        ("ring", pa.int64()),
        ("pivot", pa.int32()),
        ("low", pa.float64()),
        ("high", pa.float64()),
        ("longest", pa.int64()),
        ("ids", pa.binary()),
        ("vectors", pa.binary()),
        ("far", pa.binary()),
        ("wanted", pa.binary()),
    ]
)
_PACK = pa.schema(
    [("pack", pa.int64()), ("ids", pa.binary()), ("own", pa.binary()), ("vectors", pa.binary())]
)
_ASKED = pa.schema(
    [
        ("group", pa.int64()),
        ("pack", pa.int64()),
        ("rings", pa.list_(pa.int64())),
        ("slots_of", pa.list_(pa.binary())),
        ("members", pa.binary()),
        ("asking", pa.binary()),
        ("own", pa.binary()),
        ("queries", pa.binary()),
        ("floors", pa.binary()),
    ]
)
_FOUND = pa.schema(
    [
        ("pack", pa.int64()),
        ("slot", pa.int32()),
        ("query_id", pa.int64()),
        ("vec_id", pa.int64()),
        ("score", pa.int64()),
    ]
)

_FLOORS = "array<struct<slot: int, score: bigint>>"


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.binary(): "binary"}
    names |= {pa.list_(kind): f"array<{names[kind]}>" for kind in (pa.int64(), pa.binary())}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def choose_pivots(vectors: DataFrame, shape: Shape, number: int) -> np.ndarray:
    """Means of the vectors around far-apart members of a sample of ``SAMPLE`` rows."""
    rows = vectors.orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE)
    column = rows.select("embedding").toArrow().column(0).combine_chunks()
    sample = whole(column, shape)
    found = sample[spread(sample, number)]
    nearest = _distances(sample, found).argmin(axis=1)
    return np.array([sample[nearest == p].mean(axis=0).round() for p in range(len(found))])


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all rows to all pivots. Their squares are whole numbers and exact."""
    rows, pivots = rows.astype(np.float64), pivots.astype(np.float64)
    squared = (rows**2).sum(axis=1)[:, None] - 2 * rows @ pivots.T + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(squared, 0))


def index(vectors: DataFrame, shape: Shape, pivots: np.ndarray) -> DataFrame:
    """The rings: vectors by pivot and distance, ``RING_ROWS`` a row.

    Rows are dealt by ranges of pivot, distance and id, so that one vector that stands there
    very often is spread as well. With more than ``RINGS`` times ``RING_ROWS`` vectors rings
    grow, so that the list of rings does not. The rings of a range make up a group.
    """
    size = max(RING_ROWS, -(-shape.rows // RINGS))
    row = shape.size * shape.width + 16  # with id and distance
    groups = max(GROUPS, -(-shape.rows * row // GROUP_BYTES))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = whole(batch.column("embedding"), shape)
            far = _distances(rows, pivots)
            nearest = far.argmin(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "pivot": nearest.astype(np.int32),
                    "far": far[np.arange(len(rows)), nearest],
                    "vec_id": batch.column("vec_id"),
                    "wanted": batch.column("wanted"),
                    "vector": byte_rows(rows.astype(shape.kind)),
                }
            )

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << GROUP_BITS
        for piece in pieces(batches, "pivot", size):
            rows = from_byte_rows(piece.column("vector"), shape)
            far = piece.column("far").to_numpy()
            yield record(
                _RINGS,
                ring=[number],
                pivot=[piece.column("pivot")[0].as_py()],
                low=[far[0]],
                high=[far[-1]],
                longest=[int(squares(rows).max())],
                ids=[piece.column("vec_id").to_numpy().tobytes()],
                vectors=[rows.tobytes()],
                far=[far.tobytes()],
                wanted=[piece.column("wanted").to_numpy(zero_copy_only=False).tobytes()],
            )
            number += 1

    keyed = vectors.mapInArrow(
        key, "pivot int, far double, vec_id long, wanted boolean, vector binary"
    )
    order = ["pivot", "far", "vec_id"]
    parts = max(1, min(groups, -(-shape.rows // (4 * size))))
    dealt = keyed.repartitionByRange(parts, *order)
    return kept(dealt.sortWithinPartitions(*order).mapInArrow(ring, _ddl(_RINGS)))


@dataclass(frozen=True)
class Directory:
    """What tells rings apart, at most ``RINGS`` and some: it goes along with tasks."""

    ring: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    longest: np.ndarray
    pivots: np.ndarray

    @staticmethod
    def of(rings: DataFrame, pivots: np.ndarray) -> Directory:
        names = ["ring", "pivot", "low", "high", "longest"]
        rows = rings.select(*names).orderBy("ring").toArrow()
        return Directory(*[rows.column(n).to_numpy() for n in names], pivots)

    def limits(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By query and ring: an order to take rings in, and what no score can pass."""
        away = _distances(queries, self.pivots)[:, self.pivot]
        gap = np.maximum(np.maximum(self.low - away, away - self.high), 0)
        least = np.maximum(gap * (1 - 1e-9) - 1e-6, 0)
        limit = (squares(queries)[:, None] + self.longest - least * least) / 2 + 1
        # Where the query lies inside several rings, the nearest pivot's comes first.
        order = np.argsort(gap + 1e-6 * away, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None], axis=1)
        return place, limit


def _packed(rings: DataFrame, shape: Shape) -> DataFrame:
    """The queries, in packs of neighbours. ``own`` tells a query's own row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        held: list[tuple[np.ndarray, ...]] = []

        def pack(parts: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            ids, own, vectors = (x.tobytes() for x in parts)
            return record(_PACK, pack=[number], ids=[ids], own=[own], vectors=[vectors])

        for batch in batches:
            for i in range(batch.num_rows):
                ids = longs(batch.column("ids")[i].as_py())
                chosen = np.flatnonzero(np.frombuffer(batch.column("wanted")[i].as_py(), bool))
                own = np.stack([np.full_like(chosen, batch.column("ring")[i].as_py()), chosen], 1)
                rows = matrix(batch.column("vectors")[i].as_py(), len(ids), shape)
                held.append((ids[chosen], own, rows[chosen]))
                parts = tuple(map(np.concatenate, zip(*held, strict=True)))
                while len(parts[0]) >= PACK_ROWS:
                    yield pack(tuple(x[:PACK_ROWS] for x in parts))
                    number += 1
                    parts = tuple(x[PACK_ROWS:] for x in parts)
                held = [parts]
        if held and len(held[0][0]):
            yield pack(held[0])

    columns = rings.select("ring", "ids", "wanted", "vectors")
    return kept(columns.mapInArrow(run, _ddl(_PACK)))


def _asked(
    packs: DataFrame, shape: Shape, directory: Directory, first: int, last: int
) -> DataFrame:
    """For the rings at places ``first`` to ``last``: the queries that they can serve.

    A pack's queries go once to each group of rings, with the slots that each ring serves.
    """
    chunk = max(1, AT_ONCE // max(1, len(directory.ring)))
    groups = directory.ring >> GROUP_BITS
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = longs(batch.column("ids")[i].as_py())
                own = longs(batch.column("own")[i].as_py()).reshape(-1, 2)
                rows = matrix(batch.column("vectors")[i].as_py(), len(ids), shape)
                floors = np.full(len(ids), NONE)
                for known in batch.column("floors")[i].as_py() or []:
                    floors[known["slot"]] = known["score"]
                asked = np.zeros((len(ids), len(directory.ring)), bool)
                for low in range(0, len(ids), chunk):
                    part = slice(low, low + chunk)
                    place, limit = directory.limits(rows[part])
                    open_ = limit >= floors[part, None]
                    asked[part] = open_ & (place >= first) & (place < last)
                for low, high in zip(cuts, cuts[1:], strict=False):
                    rings = low + np.flatnonzero(asked[:, low:high].any(axis=0))
                    if not len(rings):
                        continue
                    members = np.flatnonzero(asked[:, rings].any(axis=1))
                    yield record(
                        _ASKED,
                        group=[groups[low]],
                        pack=[batch.column("pack")[i].as_py()],
                        rings=[directory.ring[rings]],
                        slots_of=[[np.flatnonzero(asked[:, r]).tobytes() for r in rings]],
                        members=[members.tobytes()],
                        asking=[ids[members].tobytes()],
                        own=[own[members].tobytes()],
                        queries=[rows[members].tobytes()],
                        floors=[floors[members].tobytes()],
                    )

    return packs.mapInArrow(run, _ddl(_ASKED))


def _met(asked: DataFrame, content: DataFrame) -> DataFrame:
    """Each ring with each pack that asks it, and in ``slots`` the queries that do.

    Spark judges what is asked by the bytes of the packs, of which it is a multiple, and would
    collect it in the driver to send it to every task. So both sides are sorted by group: a
    task holds the rings of one group and goes through the packs.
    """
    place = F.array_position("rings", F.col("ring"))
    rings = content.withColumn("group", F.shiftright("ring", GROUP_BITS))
    each = asked.hint("merge").join(rings, "group")
    each = each.withColumn("place", place.cast("int")).where("place > 0")
    slots = F.element_at("slots_of", F.col("place"))
    return each.withColumn("slots", slots).drop("group", "rings", "slots_of", "place")


def _scored(pairs: DataFrame, shape: Shape, directory: Directory, k: int) -> DataFrame:
    """The best of each ring for each query that asks it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from best({n: batch.column(n)[row].as_py() for n in batch.schema.names})

    def best(x: dict) -> Iterator[pa.RecordBatch]:
        ids, far = longs(x["ids"]), np.frombuffer(x["far"], np.float64)
        vectors = matrix(x["vectors"], len(ids), shape)
        slots, members = longs(x["slots"]), longs(x["members"])
        chosen = np.searchsorted(members, slots)
        asking, floors = longs(x["asking"])[chosen], longs(x["floors"])[chosen]
        own = longs(x["own"]).reshape(-1, 2)[chosen]
        queries = matrix(x["queries"], len(members), shape)[chosen]
        away = _distances(queries, directory.pivots[x["pivot"], None])[:, 0]
        # How far from its own distance a query's k-th score lets it look.
        reach = squares(queries) + x["longest"] + 2.0 - 2.0 * floors
        reach = np.sqrt(np.maximum(reach, 0)) * (1 + 1e-9) + 1e-6
        for low in range(0, len(ids), RING_ROWS):
            part = slice(low, low + RING_ROWS)
            near, distant = far[part][0], far[part][-1]
            take = np.flatnonzero((near <= away + reach) & (distant >= away - reach))
            if not len(take):
                continue
            scores = products(queries[take], vectors[part])
            mine = (own[take, 0] == x["ring"]) & (own[take, 1] // RING_ROWS == low // RING_ROWS)
            mine = np.flatnonzero(mine)
            hide(scores, (mine, own[take[mine], 1] - low))
            rows, columns = leading(scores, ids[part], floors[take], k)
            yield record(
                _FOUND,
                pack=np.full(len(rows), x["pack"]),
                slot=slots[take[rows]],
                query_id=asking[take[rows]],
                vec_id=ids[part][columns],
                score=scores[rows, columns].astype(np.int64),
            )

    return pairs.mapInArrow(run, _ddl(_FOUND))


def nearest(
    df: DataFrame, wanted: Column, k: int = 5, scale: int = SCALE, pivots: int = PIVOTS
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best of all rows for each query.

    ``df`` has ``vec_id`` and ``embedding``; rows where ``wanted`` holds are the queries.
    Components become ``floor(scale * x)``; the score is the inner product of these, higher
    is better, and ties go to the smaller ``vec_id``. Each query has its ``k`` best rows
    among all others, or as many as there are. Nothing is approximate.

    Rows whose vector is NULL, or holds a component that is NULL or not finite, or whose id
    is NULL, take no part. A row is never its own result, but another row with the same id
    is one, and each row with a query's id is a query. Shorter vectors are filled up with
    zeros; an empty one scores 0. A component beyond 2**24 / ``scale`` stops the job with a
    message. Other columns are ignored; without rows or queries there is no result.

    Rings and queries are rows of bounded size; the list of rings, 40 bytes each and about
    ``RINGS`` at most, goes along with the tasks. What grows with queries times rings is
    only what the bounds leave.
    """
    need(df, "vec_id", "embedding")
    vectors = df.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(wanted.cast("boolean"), F.lit(False)).alias("wanted"),
    ).where(finite(F.col("embedding")) & F.col("vec_id").isNotNull())
    shape = measured(vectors, scale)
    if not shape.rows:
        return vectors.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "0L AS score")
    chosen = choose_pivots(vectors, shape, pivots)
    rings = index(vectors, shape, chosen)
    directory = Directory.of(rings, chosen)
    packs = _packed(rings, shape)
    content = rings.select("ring", "pivot", "longest", "ids", "vectors", "far")
    by_score = Window.partitionBy("pack", "slot").orderBy(F.desc("score"), "vec_id")

    best, first, last = None, 0, 1
    while first < len(directory.ring):
        if best is None:
            known = packs.withColumn("floors", F.lit(None).cast(_FLOORS))
        else:
            full = best.where(F.col("rank") == k).groupBy("pack")
            full = full.agg(F.collect_list(F.struct("slot", "score")).alias("floors"))
            known = packs.join(full, "pack", "left")
        pairs = _met(_asked(known, shape, directory, first, last), content)
        found = _scored(pairs, shape, directory, k)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        ranked = found.withColumn("rank", F.row_number().over(by_score))
        best = kept(ranked.where(F.col("rank") <= k))
        first, last = last, last + GROWTH * (last - first)
    return best.select("query_id", "rank", "vec_id", "score")
