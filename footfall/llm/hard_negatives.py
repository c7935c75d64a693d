"""Hard negatives by candidate lists that the anchors of a cluster share.

Anchors are clustered by direction. Seen from a cluster's middle, no anchor of it is further
away than the cluster's angle, so no candidate can be nearer to any anchor than its own angle
to the middle less the cluster's: its length times the cosine of that difference bounds its
inner product with an anchor of length one. Each cluster has all candidates sorted by this
bound, once. Every anchor of the cluster walks that list from the top, stretch by stretch, and
is done where the bound is below all that it still lacks: first its positives, then the
negatives in the band of scores below each positive.
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
SAMPLE = 2048  # anchors that clusters are formed of
CLUSTERS = 8
TURNS = 5  # of forming them
STRETCH_ROWS = 1024  # of a list, while there are at most STRETCHES
STRETCHES = 1 << 16
PACK_ROWS = 256  # anchors that walk together
GROWTH = 8  # times as many stretches in the next round

_STRETCH = pa.schema(
    [
        ("stretch", pa.int64()),
        ("cluster", pa.int32()),
        ("bound", pa.float64()),
        ("rows", pa.binary()),
        ("ids", pa.binary()),
        ("labels", pa.binary()),
        ("vectors", pa.binary()),
    ]
)
_PACK = pa.schema(
    [
        ("pack", pa.int64()),
        ("cluster", pa.int32()),
        ("rows", pa.binary()),
        ("ids", pa.binary()),
        ("labels", pa.binary()),
        ("vectors", pa.binary()),
    ]
)
# Bands: from the least score that is wanted to the highest, ``places`` of each anchor.
_ASKED = pa.schema(
    [
        ("stretch", pa.int64()),
        ("pack", pa.int64()),
        ("slots", pa.binary()),
        ("asking", pa.binary()),
        ("own", pa.binary()),
        ("classes", pa.binary()),
        ("anchors", pa.binary()),
        ("lows", pa.binary()),
        ("highs", pa.binary()),
    ]
)
_FOUND = pa.schema(
    [
        ("pack", pa.int64()),
        ("slot", pa.int32()),
        ("place", pa.int32()),
        ("anchor_id", pa.int64()),
        ("found_id", pa.int64()),
        ("score", pa.int64()),
    ]
)
_KINDS = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.binary(): "binary"}
_ANY = 1 << 62  # above every score


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_KINDS[f.type]}" for f in schema)


# --- clusters --------------------------------------------------------------------------


@dataclass(frozen=True)
class Clusters:
    """Middles of length one, and the largest angle of an anchor to its own."""

    middles: np.ndarray
    angles: np.ndarray

    def angles_to(self, rows: np.ndarray) -> np.ndarray:
        """The angle of each row to each middle; a row of zeros has none, and 0 will do."""
        length = np.sqrt(squares(rows).astype(np.float64))
        cosine = rows.astype(np.float64) @ self.middles.T / np.maximum(length, 1)[:, None]
        return np.where(length[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """By row and cluster: what no inner product with an anchor of length one passes."""
        apart = np.maximum(self.angles_to(rows) - self.angles - 1e-6, 0)
        return np.sqrt(squares(rows).astype(np.float64))[:, None] * np.cos(apart) + 1e-6


def form_clusters(anchors: DataFrame, shape: Shape, number: int) -> Clusters:
    """Clusters of a sample of ``SAMPLE`` anchors, with angles that hold for all anchors."""
    rows = anchors.orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE)
    sample = whole(rows.select("embedding").toArrow().column(0).combine_chunks(), shape)
    sample = sample / np.sqrt(np.maximum(squares(sample), 1))[:, None]
    middles = sample[spread(sample, number)]
    for _ in range(TURNS):
        nearest = (sample @ middles.T).argmax(axis=1)
        sums = np.array([sample[nearest == c].sum(axis=0) for c in range(len(middles))])
        length = np.sqrt((sums**2).sum(axis=1))[:, None]
        middles = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), middles)
    formed = Clusters(middles, np.zeros(len(middles)))

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(len(middles), -1.0)
        for batch in batches:
            angles = formed.angles_to(whole(batch.column("embedding"), shape))
            own = angles.argmin(axis=1)
            np.maximum.at(most, own, angles[np.arange(len(own)), own])
        used = np.flatnonzero(most >= 0)
        yield pa.RecordBatch.from_pydict({"cluster": used.astype(np.int32), "angle": most[used]})

    told = anchors.select("embedding").mapInArrow(widest, "cluster int, angle double")
    angles = np.zeros(len(middles))
    for cluster, angle in told.groupBy("cluster").agg(F.max("angle")).collect():
        angles[cluster] = angle
    return Clusters(middles, angles)


# --- lists and packs -------------------------------------------------------------------


def _dealt(rows: DataFrame, n_rows: int, size: int, order: list[str]) -> DataFrame:
    """Rows by ranges of ``order``, so that a cluster may have any share of them."""
    dealt = rows.repartitionByRange(max(1, -(-n_rows // (4 * size))), *order)
    return dealt.sortWithinPartitions(*order)


def shared_lists(vectors: DataFrame, shape: Shape, clusters: Clusters) -> DataFrame:
    """The list of every cluster, sorted by falling bound, in stretches of bounded size.

    A candidate stands in the list of each of the ``CLUSTERS``, whatever the number of
    anchors.
    """
    number = len(clusters.middles)
    size = max(STRETCH_ROWS, -(-shape.rows * number // STRETCHES))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = whole(batch.column("embedding"), shape)
            bounds = clusters.bounds(rows)
            content = byte_rows(rows.astype(shape.kind))
            for c in range(number):
                yield pa.RecordBatch.from_pydict(
                    {
                        "cluster": np.full(len(rows), c, np.int32),
                        "fall": -bounds[:, c],
                        "row": batch.column("row"),
                        "vec_id": batch.column("vec_id"),
                        "label": batch.column("label"),
                        "vector": content,
                    }
                )

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for piece in pieces(batches, "cluster", size):
            yield record(
                _STRETCH,
                stretch=[number],
                cluster=[piece.column("cluster")[0].as_py()],
                bound=[-piece.column("fall")[0].as_py()],
                **_columns(piece, shape),
            )
            number += 1

    rows = vectors.select("embedding", "row", "vec_id", "label").mapInArrow(
        listed, "cluster int, fall double, row long, vec_id long, label long, vector binary"
    )
    dealt = _dealt(rows, shape.rows * number, size, ["cluster", "fall", "row"])
    return kept(dealt.mapInArrow(stretch, _ddl(_STRETCH)))


def _columns(piece: pa.RecordBatch, shape: Shape) -> dict:
    """Rows of a piece as bytes."""
    names = {"rows": "row", "ids": "vec_id", "labels": "label"}
    found = {k: [piece.column(name).to_numpy().tobytes()] for k, name in names.items()}
    return {**found, "vectors": [from_byte_rows(piece.column("vector"), shape).tobytes()]}


def _packs(anchors: DataFrame, n_anchors: int, shape: Shape, clusters: Clusters) -> DataFrame:
    """The anchors by cluster and angle, in packs."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = whole(batch.column("embedding"), shape)
            angles = clusters.angles_to(rows)
            own = angles.argmin(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": own.astype(np.int32),
                    "angle": angles[np.arange(len(own)), own],
                    "row": batch.column("row"),
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "vector": byte_rows(rows.astype(shape.kind)),
                }
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for piece in pieces(batches, "cluster", PACK_ROWS):
            cluster = [piece.column("cluster")[0].as_py()]
            yield record(_PACK, pack=[number], cluster=cluster, **_columns(piece, shape))
            number += 1

    rows = anchors.select("embedding", "row", "vec_id", "label").mapInArrow(
        placed, "cluster int, angle double, row long, vec_id long, label long, vector binary"
    )
    dealt = _dealt(rows, n_anchors, PACK_ROWS, ["cluster", "angle", "row"])
    return kept(dealt.mapInArrow(pack, _ddl(_PACK)))


# --- walks -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Lists:
    """The stretches of each cluster from the top, about ``STRETCHES`` in all."""

    stretches: list[np.ndarray]
    bounds: list[np.ndarray]

    @staticmethod
    def of(table: DataFrame, number: int) -> Lists:
        rows = table.select("cluster", "stretch", "bound").toArrow()
        cluster, stretch, bound = (rows.column(i).to_numpy() for i in range(3))
        order = np.lexsort((stretch, -bound, cluster))
        own = [order[cluster[order] == c] for c in range(number)]
        return Lists([stretch[x] for x in own], [bound[x] for x in own])

    @property
    def longest(self) -> int:
        return max(map(len, self.stretches), default=0)


def _asked(packs: DataFrame, shape: Shape, lists: Lists, first: int, last: int) -> DataFrame:
    """For each stretch at places ``first`` to ``last``: the anchors that are not done there.

    ``bands`` has ``slot``, ``place``, ``low`` and ``high`` of what a pack's anchors lack.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from ask({n: batch.column(n)[i].as_py() for n in batch.schema.names})

    def ask(x: dict) -> Iterator[pa.RecordBatch]:
        own, asking, classes = longs(x["rows"]), longs(x["ids"]), longs(x["labels"])
        anchors = matrix(x["vectors"], len(own), shape)
        bands = x["bands"] or []
        places = 1 + max((b["place"] for b in bands), default=-1)
        lows, highs = np.full((len(own), places), _ANY), np.full((len(own), places), NONE)
        for b in bands:
            lows[b["slot"], b["place"]], highs[b["slot"], b["place"]] = b["low"], b["high"]
        least = np.where(lows <= highs, lows, _ANY).min(axis=1, initial=_ANY)
        length = np.sqrt(squares(anchors).astype(np.float64))
        cluster = x["cluster"]
        span = slice(first, last)
        for stretch, bound in zip(
            lists.stretches[cluster][span], lists.bounds[cluster][span], strict=True
        ):
            # Whole scores and a bound in floating point: 1 to spare.
            slots = np.flatnonzero(length * bound + 1 >= least)
            if not len(slots):
                continue
            yield record(
                _ASKED,
                stretch=[stretch],
                pack=[x["pack"]],
                slots=[slots.tobytes()],
                asking=[asking[slots].tobytes()],
                own=[own[slots].tobytes()],
                classes=[classes[slots].tobytes()],
                anchors=[anchors[slots].tobytes()],
                lows=[lows[slots].tobytes()],
                highs=[highs[slots].tobytes()],
            )

    return packs.mapInArrow(run, _ddl(_ASKED))


def _scored(pairs: DataFrame, shape: Shape, k: int, same: bool) -> DataFrame:
    """The best of a stretch in each band, among rows of the anchor's label or of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from best({n: batch.column(n)[i].as_py() for n in batch.schema.names})

    def best(x: dict) -> Iterator[pa.RecordBatch]:
        rows, ids, labels = longs(x["rows"]), longs(x["ids"]), longs(x["labels"])
        vectors = matrix(x["vectors"], len(ids), shape)
        slots, asking = longs(x["slots"]), longs(x["asking"])
        own, classes = longs(x["own"]), longs(x["classes"])
        anchors = matrix(x["anchors"], len(slots), shape)
        lows = longs(x["lows"]).reshape(len(slots), -1)
        highs = longs(x["highs"]).reshape(len(slots), -1)
        for start in range(0, len(ids), STRETCH_ROWS):
            part = slice(start, start + STRETCH_ROWS)
            scores = products(anchors, vectors[part])
            alike = classes[:, None] == labels[part]
            hide(scores, ~alike | (own[:, None] == rows[part]) if same else alike)
            for place in range(lows.shape[1]):
                banded = scores.copy()
                hide(banded, scores > highs[:, place, None])
                found, columns = leading(banded, ids[part], lows[:, place], k)
                yield record(
                    _FOUND,
                    pack=np.full(len(found), x["pack"]),
                    slot=slots[found],
                    place=np.full(len(found), place),
                    anchor_id=asking[found],
                    found_id=ids[part][columns],
                    score=scores[found, columns].astype(np.int64),
                )

    return pairs.mapInArrow(run, _ddl(_FOUND))


def _walk(
    packs: DataFrame,
    table: DataFrame,
    shape: Shape,
    lists: Lists,
    bands: DataFrame,
    k: int,
    same: bool,
) -> DataFrame:
    """``pack``, ``slot``, ``place``, ``rank``, ``found_id``, ``score``: ``k`` per band.

    ``bands`` has ``pack``, ``slot``, ``place``, ``low`` and ``high``. The low end rises to
    the ``k``-th score that is known.
    """
    content = table.select("stretch", "rows", "ids", "labels", "vectors")
    key = ["pack", "slot", "place"]
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "found_id")
    best, first, last = None, 0, 1
    while first < lists.longest or best is None:
        lacking = bands
        if best is not None:
            full = best.where(F.col("rank") == k).select(*key, F.col("score").alias("known"))
            lacking = bands.join(full, key, "left").withColumn("low", F.greatest("low", "known"))
        lacking = lacking.groupBy("pack").agg(
            F.collect_list(F.struct("slot", "place", "low", "high")).alias("bands")
        )
        asked = _asked(packs.join(lacking, "pack"), shape, lists, first, last)
        found = _scored(asked.join(content, "stretch"), shape, k, same)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        ranked = found.withColumn("rank", F.row_number().over(order))
        best = kept(ranked.where(F.col("rank") <= k))
        first, last = last, last + GROWTH * (last - first)
    return best


def mine(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
) -> DataFrame:
    """Hard negatives for each anchor and positive, exact.

    ``df`` has ``vec_id``, ``label`` and ``embedding``; rows where ``anchor`` holds are the
    anchors. Components become ``floor(scale * x)``, and scores are inner products of these.
    An anchor's positives are the ``positives`` rows of its label with the highest scores;
    the negatives of a positive are the ``negatives`` highest rows of other labels whose
    scores are from ``lowest`` to ``highest`` per cent of the positive's. Ties go to the
    smaller ``vec_id``, and where there are fewer, all are taken.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``
    and ``negative_score``, a row per negative.

    Rows without label or id, and those whose vector is NULL or holds a component that is
    NULL or not finite, take no part. A row is not its own positive, but another row with the
    same id is one, and each row with an anchor's id is an anchor. A positive with a
    score below 0 has an empty band. Labels are whole numbers. Shorter vectors are filled up
    with zeros; an empty one scores 0. A component beyond 2**24 / ``scale`` stops the job
    with a message. Other columns are ignored; without rows or anchors there is no result.
    """
    need(df, "vec_id", "label", "embedding")
    vectors = df.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(anchor.cast("boolean"), F.lit(False)).alias("anchor"),
    )
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    vectors = vectors.where(named & finite(F.col("embedding")))
    # Rows get a number of their own, which must not change: written down.
    vectors = kept(vectors.withColumn("row", F.monotonically_increasing_id()))
    shape = measured(vectors, scale)
    anchors = vectors.where("anchor")
    n_anchors = anchors.count()
    if not n_anchors:
        return vectors.limit(0).selectExpr(
            "vec_id AS anchor_id",
            "vec_id AS positive_id",
            "0 AS rank",
            "vec_id AS negative_id",
            "0L AS positive_score",
            "0L AS negative_score",
        )
    formed = form_clusters(anchors, shape, clusters)
    table = shared_lists(vectors, shape, formed)
    lists = Lists.of(table, len(formed.middles))
    packs = _packs(anchors, n_anchors, shape, formed)

    def walk(bands: DataFrame, k: int, same: bool) -> DataFrame:
        return _walk(packs, table, shape, lists, bands, k, same)

    last = (F.octet_length("ids") / 8).cast("int") - 1
    slots = packs.select("pack", F.explode(F.sequence(F.lit(0), last)).alias("slot"))
    whole_range = [F.lit(0).alias("place"), F.lit(NONE).alias("low"), F.lit(_ANY).alias("high")]
    best = walk(slots.select("pack", "slot", *whole_range), positives, True)
    chosen = best.select(
        "pack",
        "slot",
        (F.col("rank") - 1).alias("place"),
        "anchor_id",
        F.col("found_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    # Whole quotients, rounded into the band.
    bands = chosen.where("positive_score >= 0").select(
        "pack",
        "slot",
        "place",
        F.expr(f"(positive_score * {lowest} + 99) div 100").alias("low"),
        F.expr(f"positive_score * {highest} div 100").alias("high"),
    )
    found = walk(bands, negatives, False).drop("anchor_id")
    return found.join(chosen, ["pack", "slot", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
