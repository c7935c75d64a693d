"""Vector compression: each part of a vector becomes the number of an entry of a codebook.

Codebooks are found by rounds of nearest entries and means. Parts stand in metric trees, one
for each part position of a few thousand vectors, built middle out: anchors far from each
other share the parts among them, then anchors are joined pair by pair upwards into larger
balls, and each is split the same way downwards. A ball knows its centre, radius, count and
sum. A round walks the trees with the entries that can be nearest to anything in a ball; a
ball inherits its parent's and drops more, and one that a single entry is left for counts
as a whole.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import kept, need
from footfall.llm.vectors import LARGEST, Shape, finite, matrix, measured, record, whole

SCALE = 4096
BLOCK_ROWS = 4096  # vectors that share trees
LEAF = 32  # parts of a ball that is not split


# --- trees -----------------------------------------------------------------------------


def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    away = points - centre
    return (away * away).sum(axis=-1)


def _shared(points: np.ndarray, number: int) -> np.ndarray:
    """Splits points among anchors: the number of each point's own.

    The next anchor is the point farthest from its own. It takes the points nearer to it;
    a point that is less than half as far from its anchor as the anchors are from each
    other cannot be one.
    """
    owner = np.zeros(len(points), np.int64)
    far = _apart(points, points[0])
    anchors = [0]
    while len(anchors) < number:
        new = int(far.argmax())
        if not far[new]:
            break
        between = _apart(points[anchors], points[new])
        may = np.flatnonzero(4 * far > between[owner])
        distance = _apart(points[may], points[new])
        nearer = distance < far[may]
        owner[may[nearer]], far[may[nearer]] = len(anchors), distance[nearer]
        anchors.append(new)
    return owner


@dataclass
class _Ball:
    """A ball while the tree grows: rows, or two balls."""

    centre: np.ndarray
    radius: float
    count: int
    rows: np.ndarray | None = None
    children: tuple[_Ball, _Ball] | None = None


def _grown(points: np.ndarray, rows: np.ndarray) -> _Ball:
    own = points[rows]
    centre = own.mean(axis=0)
    radius = float(np.sqrt(_apart(own, centre).max()))
    if len(rows) <= LEAF or not (own != own[0]).any():
        return _Ball(centre, radius, len(rows), rows=rows)
    owner = _shared(own, int(np.ceil(np.sqrt(len(rows)))))
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order])) + 1
    return _joined([_grown(points, rows[part]) for part in np.split(order, cuts)])


def _joined(balls: list[_Ball]) -> _Ball:
    """Joins the two balls that the least ball holds, again and again."""
    n = len(balls)
    centres = np.array([b.centre for b in balls])
    radii = np.array([b.radius for b in balls])
    held = (np.sqrt(_apart(centres[:, None], centres[None])) + radii + radii[:, None]) / 2
    held = np.maximum(held, np.maximum(radii, radii[:, None]))
    np.fill_diagonal(held, np.inf)
    for _ in range(n - 1):
        i, j = divmod(int(held.argmin()), n)
        a, b = balls[i], balls[j]
        count = a.count + b.count
        centre = (a.centre * a.count + b.centre * b.count) / count
        reach = [float(np.sqrt(_apart(x.centre, centre))) + x.radius for x in (a, b)]
        balls[i] = _Ball(centre, max(reach), count, children=(a, b))
        centres[i], radii[i] = centre, balls[i].radius
        held[j], held[:, j] = np.inf, np.inf
        open_ = np.isfinite(held[i])
        row = (np.sqrt(_apart(centres, centre)) + radii + radii[i]) / 2
        row = np.maximum(row, np.maximum(radii, radii[i]))
        held[i], held[:, i] = np.where(open_, row, np.inf), np.where(open_, row, np.inf)
    return balls[i] if n > 1 else balls[0]


@dataclass(frozen=True)
class Tree:
    """Balls in arrays: the first is the root; a leaf has no children (-1).

    ``order`` lists rows so that a ball's are ``order[start:stop]``. Centres are rounded
    means, so that squared distances are exact.
    """

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @staticmethod
    def unpacked(raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw)) as held:
            return Tree(**{name: held[name] for name in held.files})


def grow(points: np.ndarray) -> Tree:
    """The metric tree of some whole-numbered points, at least one."""
    root = _grown(points, np.arange(len(points)))
    spans, left, right, rows = [], [], [], []
    todo, place = [(root, -1, False)], 0
    while todo:
        ball, parent, second = todo.pop()
        number = len(spans)
        if parent >= 0:
            (right if second else left)[parent] = number
        spans.append((place, place + ball.count))
        left.append(-1)
        right.append(-1)
        if ball.rows is not None:
            rows.append(ball.rows)
            place += ball.count
        else:
            # The left one is taken first and fills its places before the right one.
            todo += [(ball.children[1], number, True), (ball.children[0], number, False)]
    order = np.concatenate(rows)
    start, stop = np.array(spans).T
    ordered = points[order]
    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), ordered.cumsum(axis=0)])
    total = sums[stop] - sums[start]
    centre = total // (stop - start)[:, None]
    radius = [
        np.sqrt(_apart(ordered[a:b], c).max())
        for a, b, c in zip(start.tolist(), stop.tolist(), centre, strict=True)
    ]
    return Tree(
        order, start, stop, np.array(left), np.array(right), centre, np.array(radius), total
    )


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges, and the number of the range of each."""
    length = stop - start
    which = np.repeat(np.arange(len(start)), length)
    before = np.cumsum(length) - length
    return np.arange(length.sum()) - before[which] + start[which], which


def _nearest(tree: Tree, points: np.ndarray, book: np.ndarray) -> Iterator[tuple]:
    """Walks a tree, level by level: balls and their entries, then single rows and theirs.

    Distances are whole numbers, so ties are seen; they go to the lower entry. An entry is
    dropped where even the part of the ball nearest to it is nearer to the best one.
    """
    squared = (book * book).sum(axis=1)
    between = np.sqrt(_apart(book[:, None], book[None]))
    # Of equal entries the first is always taken.
    first = ~np.tril(between == 0, -1).any(axis=1)
    active, may = np.zeros(1, np.int64), first[None]
    largest = np.iinfo(np.int64).max
    while len(active):
        centre = tree.centre[active]
        distance = squared - 2 * centre @ book.T + (centre * centre).sum(axis=1)[:, None]
        best = np.where(may, distance, largest).argmin(axis=1)
        ahead = distance - distance[np.arange(len(active)), best][:, None]
        may = may & (ahead <= 2.000001 * tree.radius[active][:, None] * between[best])
        may[np.arange(len(active)), best] = True
        owned = may.sum(axis=1) == 1
        yield active[owned], best[owned], None, None
        active, may = active[~owned], may[~owned]
        leaf = tree.left[active] < 0
        places, which = _ranges(tree.start[active[leaf]], tree.stop[active[leaf]])
        rows = tree.order[places]
        own = points[rows]
        distance = squared - 2 * own @ book.T
        entry = np.where(may[leaf][which], distance, largest).argmin(axis=1)
        yield None, None, rows, entry
        active, may = active[~leaf], may[~leaf]
        active = np.concatenate([tree.left[active], tree.right[active]])
        may = np.concatenate([may, may])


def entry_sums(tree: Tree, points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per entry of the book the count of its points, then their sum."""
    out = np.zeros((len(book), 1 + points.shape[1]), np.int64)
    for balls, best, rows, entry in _nearest(tree, points, book):
        if balls is not None:
            np.add.at(out[:, 0], best, tree.stop[balls] - tree.start[balls])
            np.add.at(out[:, 1:], best, tree.total[balls])
        else:
            out[:, 0] += np.bincount(entry, minlength=len(book))
            np.add.at(out[:, 1:], entry, points[rows])
    return out


def entries_of(tree: Tree, points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of each point."""
    out = np.zeros(len(points), np.int64)
    for balls, best, rows, entry in _nearest(tree, points, book):
        if balls is not None:
            places, which = _ranges(tree.start[balls], tree.stop[balls])
            out[tree.order[places]] = best[which]
        else:
            out[rows] = entry
    return out


# --- jobs ------------------------------------------------------------------------------


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return df.select(name).limit(0).toArrow().schema.field(0).type


def _planted(vectors: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """A row for each ``BLOCK_ROWS`` vectors of a partition, with a tree per part."""
    label = _arrow_type(vectors, "label")
    schema = pa.schema(
        [
            ("ids", pa.list_(pa.int64())),
            ("labels", pa.list_(label)),
            ("points", pa.binary()),
            ("trees", pa.list_(pa.binary())),
        ]
    )
    wide = shape.size // parts

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        points = whole(rows.column("embedding"), shape)
        trees = [grow(points[:, p * wide : (p + 1) * wide]).packed() for p in range(parts)]
        ends = pa.array([0, rows.num_rows], pa.int32())
        return record(
            schema,
            ids=pa.ListArray.from_arrays(ends, rows.column("vec_id")),
            labels=pa.ListArray.from_arrays(ends, rows.column("label")),
            points=[points.astype(shape.kind).tobytes()],
            trees=[trees],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                lacking = BLOCK_ROWS - sum(x.num_rows for x in held)
                held.append(batch.slice(0, lacking))
                batch = batch.slice(lacking)
                if held[-1].num_rows == lacking:
                    yield row(held)
                    held = []
        if held:
            yield row(held)

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(
        run,
        f"ids array<long>, labels array<{kind}>, points binary, trees array<binary>",
    )


def _rows_of(batch: pa.RecordBatch, i: int, shape: Shape) -> tuple[np.ndarray, list[Tree]]:
    raw = batch.column("points")[i].as_py()
    n = len(batch.column("ids")[i])
    trees = [Tree.unpacked(x) for x in batch.column("trees")[i].as_py()]
    return matrix(raw, n, shape).astype(np.int64), trees


def _next(planted: DataFrame, shape: Shape, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the mean, rounded down, of the parts it is nearest to.

    Each task adds up its blocks, so a row per entry and task is shuffled, and a row per
    entry comes to the driver.
    """
    parts, entries, wide = books.shape
    schema = pa.schema([("entry", pa.int32()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((parts, entries, 1 + wide), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                points, trees = _rows_of(batch, i, shape)
                for p, tree in enumerate(trees):
                    out[p] += entry_sums(tree, points[:, p * wide : (p + 1) * wide], books[p])
        flat = out.reshape(parts * entries, 1 + wide)
        used = np.flatnonzero(flat[:, 0])
        yield record(schema, entry=used, sums=flat[used].tolist())

    sums = planted.select("ids", "points", "trees").mapInArrow(run, "entry int, sums array<long>")
    total = [F.sum(F.get("sums", F.lit(c))).alias(f"s{c}") for c in range(1 + wide)]
    flat = books.reshape(parts * entries, wide).copy()
    for entry, count, *values in sums.groupBy("entry").agg(*total).collect():
        flat[entry] = [value // count for value in values]
    return flat.reshape(books.shape)


def _coded(planted: DataFrame, shape: Shape, books: np.ndarray, kind: str) -> DataFrame:
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points, trees = _rows_of(batch, i, shape)
                codes = np.zeros((len(points), parts), np.uint8)
                error = np.zeros(len(points), np.int64)
                for p, tree in enumerate(trees):
                    own = points[:, p * wide : (p + 1) * wide]
                    codes[:, p] = found = entries_of(tree, own, books[p])
                    error += _apart(own, books[p][found])
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": batch.column("ids")[i].values,
                        "label": batch.column("labels")[i].values,
                        "code": pa.array([row.tobytes().hex() for row in codes]),
                        "error": error,
                    }
                )

    return planted.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(
    df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = SCALE
) -> DataFrame:
    """``vec_id``, ``label``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    ``df`` has ``vec_id``, ``embedding`` and ``label``. Components become
    ``floor(scale * x)``, and vectors are cut into ``parts`` equal parts. Codebooks start as
    the parts of the ``entries`` smallest ``vec_id`` (256 at most) and are improved
    ``rounds`` times. ``code`` has two hexadecimal digits a part, ``error`` is the squared
    distance to what the code stands for, ``label_error`` its sum over equal labels.

    Vectors that are NULL or hold a component that is NULL or not finite are left out.
    A vector shorter than the longest, or than the next multiple of ``parts``, is filled up
    with zeros; an empty one is all zeros. Repeated rows count as often as they stand there.
    A NULL id keeps its row, but such rows do not start codebooks; with fewer ids than
    ``entries`` there are fewer entries. Ids that stand on several rows start codebooks in
    the order of their vectors. NULL labels are one label. A component
    beyond 2**24 / ``scale`` stops the job with a message. Other columns are ignored;
    without rows, or without ids, there is no result.

    Tasks hold the trees of one block at a time. Each round sends a row per entry and task.
    """
    need(df, "vec_id", "embedding", "label")
    if not 0 < entries <= 256:
        raise ValueError("a code has room for 1 to 256 entries")
    kind = df.schema["label"].dataType.simpleString()
    columns = [
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
    ]
    vectors = df.select(*columns).where(finite(F.col("embedding")))
    shape = measured(vectors, scale, parts)
    named = vectors.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding")
    first = named.select("embedding").limit(entries).toArrow().column(0).combine_chunks()
    if not len(first):
        return vectors.limit(0).selectExpr(
            "vec_id",
            "label",
            "'' AS code",
            "0L AS error",
            "0L AS label_error",
            "'' AS codebooks_sha256",
        )
    books = whole(first, shape).reshape(len(first), parts, -1).transpose(1, 0, 2)
    planted = kept(_planted(vectors, shape, parts))
    for _ in range(rounds):
        books = _next(planted, shape, books)
    coded = kept(_coded(planted, shape, books, kind))
    digits = ",".join(map(str, books.reshape(-1).tolist()))
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        "label",
        "code",
        "error",
        "label_error",
        F.lit(hashlib.sha256(digits.encode()).hexdigest()).alias("codebooks_sha256"),
    )
