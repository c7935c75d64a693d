"""Removal of long strings that occur twice, by suffix sorts of texts that share an anchor.

Every window of ``length`` bytes has an anchor, the piece of it whose hash is least, so equal
windows have equal anchors wherever they stand. Consecutive windows with one anchor make up
a stretch of text. Stretches meet by anchor; those with the same bytes are equal as a whole,
and the different ones of an anchor are cut into suffixes and sorted, which shows every
window that they have in common. If an anchor has too many for one task, they are cut into
parts of a few windows, which meet by the bytes that all windows of a part hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.suffix_sort import Suffixes, verified
from footfall.llm.tables import kept, narrowed, need
from footfall.llm.words import (
    BLOCK_BYTES,
    blocks,
    mix,
    powers,
    prefix_hashes,
    replace_columns,
)

LENGTH = 200
PIECE = 48  # bytes of an anchor
SEGMENT = 4 << 20  # of a very long text that is cut into stretches at once
CROWD = 1 << 20  # bytes of an anchor's stretches that are sorted together; more are cut into parts
PARTS = (40, 8, 1)  # windows in a part of a crowded stretch, then of a part still crowded
SORT_BYTES = 1 << 18  # of stretches that a sort takes at once
_PLACE = np.uint64((1 << 24) - 1)


def _places(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the anchor of each window of the data begins, and the anchors' hashes."""
    piece = min(PIECE, length)
    width = length - piece + 1  # pieces in a window
    n = len(data) - piece + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = prefix_hashes(data)
    power = powers(len(prefix))[1]
    hashes = mix((prefix[piece:] - prefix[:-piece]) * power[:n])
    # The first of equal pieces; blocks are far smaller than 2**24.
    value = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    padded = -(-n // width) * width
    grid = np.full(padded, np.uint64(2**64 - 1))
    grid[:n] = value
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n_windows = n - width + 1
    least = np.minimum(back[:n_windows], ahead[width - 1 : width - 1 + n_windows])
    place = (least & _PLACE).astype(np.int64)
    return place, hashes[place]


def stretches(data: np.ndarray, offsets: np.ndarray, length: int):
    """(start, end, anchor, whether the anchor occurs twice in it) of all stretches.

    Stretches do not cross ``offsets``. Their windows are all windows of the data, each in
    one stretch.
    """
    place, anchor = _places(data, length)
    n_windows = len(place)
    if not n_windows:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool)
    # Windows inside one text.
    inside = np.zeros(n_windows, bool)
    for a, b in zip(offsets[:-1], offsets[1:] - length + 1, strict=True):
        inside[a : max(a, b)] = True
    new = np.ones(n_windows, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    new[offsets[:-1][offsets[:-1] < n_windows]] = True
    heads = np.flatnonzero(new & inside)
    if not len(heads):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool)
    groups = np.cumsum(new)[inside]
    counts = np.bincount(groups - groups[0])
    ends = heads + counts[counts > 0] - 1 + length
    twice = place[heads] != place[ends - length]
    return heads, ends, anchor[heads], twice


def _cut(text: bytes, length: int):
    """Stretches of one text of any length."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), SEGMENT):
        data = np.frombuffer(text, np.uint8)[at : at + SEGMENT + length - 1]
        start, end, anchor, twice = stretches(data, np.array([0, len(data)]), length)
        parts.append((start + at, end + at, anchor, twice))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _key(text):
    """What tells texts apart: equal texts are removed alike."""
    return F.unhex(F.md5(text.cast("binary")))


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``brief`` (short name of the text), ``start`` of each stretch.

    A stretch that holds its anchor twice has the start -1 - start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=min(BLOCK_BYTES, SEGMENT)):
            names = block.rows.column("brief").to_numpy()
            if len(block.data) > SEGMENT:
                start, _, anchor, twice = _cut(block.text(0), length)
                rows = np.zeros(len(start), np.int64)
            else:
                start, _, anchor, twice = stretches(block.data, block.offsets, length)
                rows = np.searchsorted(block.offsets, start, "right") - 1
                start = start - block.offsets[rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(anchor.view(np.int64)),
                    "brief": pa.array(names[rows], pa.int64()),
                    "start": pa.array(np.where(twice, -1 - start, start), pa.int64()),
                }
            )

    return texts.select("brief", "text").mapInArrow(run, "anchor long, brief long, start long")


def _packed(texts: DataFrame, length: int) -> DataFrame:
    """Long enough texts, compressed for shuffles, each once per task at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        seen: set[bytes] = set()
        for block in blocks(batches):
            keys, take = block.rows.column("key").to_pylist(), []
            for i, size in enumerate(np.diff(block.offsets)):
                if size >= length and keys[i] not in seen:
                    seen.add(keys[i])
                    take.append(i)
            packed = [compressor.compress(block.text(i)) for i in take]
            rows = block.rows.take(pa.array(take, pa.int64()))
            yield replace_columns(rows, ["key", "brief"], packed=pa.array(packed, pa.binary()))

    return texts.select("key", "brief", "text").mapInArrow(
        run, "key binary, brief long, packed binary"
    )


def _shared_stretches(texts: DataFrame, length: int) -> DataFrame:
    """Stretches whose anchor stands in another place too, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "packed", "starts")]
            for key, packed, wanted in zip(*columns, strict=True):
                text = unpack.decompress(packed)
                start, end, anchor, twice = _cut(text, length)
                wanted = np.array(wanted)
                take = np.isin(start, np.where(wanted < 0, -1 - wanted, wanted))
                start, end, anchor, twice = start[take], end[take], anchor[take], twice[take]
                rows = []
                for name, a, b, own in zip(
                    *[x.tolist() for x in (anchor.view(np.int64), start, end, twice)], strict=True
                ):
                    if own:
                        rows += _periods(name, a, text[a:b], length)
                    else:
                        rows.append((name, a, False, text[a:b], None))
                yield _stretch_rows(key, rows)

    return texts.mapInArrow(run, STRETCH)


def _periods(name: int, start: int, piece: bytes, length: int) -> Iterator[tuple]:
    """A stretch that holds its anchor twice, without windows that come again a period later.

    They are told as spans, byte by byte equal; the last of equal ones stands for them.
    """
    data = np.frombuffer(piece, np.uint8)
    place, _ = _places(data, length)
    n_windows = len(place)
    gaps = np.diff(place)
    period = int(np.bincount(gaps[gaps > 0]).argmax()) if gaps.any() else 0
    live = np.ones(n_windows, bool)
    if 0 < period < n_windows:
        wrong = np.concatenate([[0], np.cumsum(data[:-period] != data[period:])])
        again = np.flatnonzero(wrong[length:] == wrong[:-length])  # windows that come again
        live[again] = False
        found = np.zeros(n_windows, bool)
        found[again] = found[again + period] = True
        for a, b in _spans(found, start, length):
            yield name, a, False, None, b
    for a, b in _spans(live, 0, length):
        yield name, start + a, True, piece[a:b], None


def _common_windows(pieces: list[bytes], groups: np.ndarray, length: int) -> list[np.ndarray]:
    """Per piece, which of its windows occur twice in the pieces of its group."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(x) for x in pieces])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    n_windows = sizes - length + 1
    owner = np.repeat(np.arange(len(pieces)), n_windows)
    first = np.concatenate([[0], np.cumsum(n_windows)])
    starts = np.arange(first[-1]) - first[:-1][owner] + offsets[:-1][owner]
    suffixes = Suffixes(data, length)
    found = np.zeros(len(starts), bool)

    order = suffixes.sorted(starts, groups[owner])
    near, far = order[:-1], order[1:]
    same = groups[owner[near]] == groups[owner[far]]
    near, far = near[same], far[same]
    equal = suffixes.common(starts[near], starts[far]) >= length
    near, far = near[equal], far[equal]
    sure = verified(data, starts[near], starts[far], length)
    found[near[sure]] = True
    found[far[sure]] = True
    return np.split(found, first[1:-1])


def _spans(flags: np.ndarray, start: int, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the flagged windows of a stretch."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]]))).reshape(-1, 2)
    return [(int(start + a), int(start + b - 1 + length)) for a, b in edges]


SPANS = "key binary, first long, end long"


def _sorted_spans(mixed: DataFrame, length: int) -> DataFrame:
    """Spans from sorting the suffixes of stretches, grouped by anchor."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        anchors = np.array([r[0] for r in rows], np.int64)
        groups = np.cumsum(np.concatenate([[0], anchors[1:] != anchors[:-1]]))
        flags = _common_windows([r[3] for r in rows], groups, length)
        out = [
            (key, *span)
            for (_, key, start, _), own in zip(rows, flags, strict=True)
            for span in _spans(own, start, length)
        ]
        keys, first, end = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.array(keys, pa.binary()),
                "first": pa.array(first, pa.int64()),
                "end": pa.array(end, pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by anchor. Whole anchors are sorted together, several at once.
        rows: list[tuple] = []
        size, last = 0, None
        for found in batches:
            columns = [found.column(c).to_pylist() for c in ("anchor", "key", "start", "piece")]
            for row in zip(*columns, strict=True):
                if size >= SORT_BYTES and row[0] != last:
                    yield batch(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
                last = row[0]
        if rows:
            yield batch(rows)

    sorted_ = mixed.repartition("anchor").sortWithinPartitions("anchor", "key", "start")
    return sorted_.mapInArrow(run, SPANS)


def _parts(crowded: DataFrame, length: int, size: int) -> DataFrame:
    """Stretches cut into parts of at most ``size`` windows that may equal each other's.

    Equal windows have their anchor at the same distance, so windows are put together by
    distance, ``size`` of them in a row. All windows of a part hold the same middle; parts
    meet by it, which stands in for the anchor.
    """

    def cut(piece: bytes) -> Iterator[tuple[int, int, int]]:
        place, _ = _places(np.frombuffer(piece, np.uint8), length)
        group = (place - np.arange(len(place))) // size
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (group[1:] != group[:-1])
        heads = np.flatnonzero(new)
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(place)], strict=True):
            far = int(group[a]) * size  # least distance of the anchor, to be in this part
            middle = piece[place[a] - far : place[a] - far - size + 1 + length]
            name = hashlib.blake2b(b"%d:" % group[a] + middle, digest_size=8).digest()
            yield int.from_bytes(name, "little", signed=True), a, b - 1 + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "start", "piece")]
            for key, start, piece in zip(*columns, strict=True):
                rows = [(name, start + a, False, piece[a:b], None) for name, a, b in cut(piece)]
                yield _stretch_rows(key, rows)

    return crowded.select("key", "start", "piece").mapInArrow(run, STRETCH)


# A stretch, or a span if it has an end and no bytes.
STRETCH = (
    "anchor long, key binary, start long, twice boolean, digest binary, piece binary, end long"
)


def _stretch_rows(key: bytes, rows: list[tuple]) -> pa.RecordBatch:
    anchors, starts, twice, pieces, ends = zip(*rows, strict=True) if rows else ((),) * 5
    digests = [x and hashlib.blake2b(x, digest_size=16).digest() for x in pieces]
    return pa.RecordBatch.from_pydict(
        {
            "anchor": pa.array(anchors, pa.int64()),
            "key": pa.array([key] * len(rows), pa.binary()),
            "start": pa.array(starts, pa.int64()),
            "twice": pa.array(twice, pa.bool_()),
            "digest": pa.array(digests, pa.binary()),
            "piece": pa.array(pieces, pa.binary()),
            "end": pa.array(ends, pa.int64()),
        }
    )


def _matched(found: DataFrame, length: int, parts: tuple[int, ...] = PARTS) -> DataFrame:
    """Spans of all windows that two of the stretches, or two places of one, have in common."""
    own = found.where("piece IS NULL").select("key", F.col("start").alias("first"), "end")
    found = found.where("piece IS NOT NULL")
    same = ["anchor", "digest"]
    place = F.xxhash64("key", "start")
    pieces = found.groupBy(*same).agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.max(F.length("piece")).alias("size")
    )
    per_anchor = pieces.groupBy("anchor").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")
    )
    state = found.select("anchor", "key", "start", "digest", F.length("piece").alias("size"))
    repeats = pieces.where("low <> high").select(*same)
    equal = state.join(repeats, same).select(
        "key", F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("end")
    )
    # One of each different stretch, where an anchor has several or repeats in one.
    one = found.withColumn("place", place).join(
        pieces.select("anchor", "digest", F.col("low").alias("place")), [*same, "place"]
    )
    one = one.join(per_anchor, "anchor").where("n > 1 OR twice")
    one = kept(one.select("anchor", "key", "start", "piece", "bytes"))
    # Parts of one window hold nothing but their middle: no two of them differ.
    small = F.col("bytes") <= CROWD if parts else F.lit(True)
    spans = own.unionByName(equal).unionByName(_sorted_spans(one.where(small), length))
    crowded = one.where(~small)
    if crowded.isEmpty():
        return spans
    spread = crowded.repartition("key", "start")  # crowds lie in few of the table's files
    finer = kept(_parts(spread, length, parts[0]))
    return spans.unionByName(_matched(finer, length, parts[1:]))


def repeated_spans(df: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Spans (``key``, ``first``, ``end``) of repeated strings in each text that occurs once,
    and those texts (``key``, ``packed``). ``df`` has ``text``; ``key`` is the digest of it.
    """
    texts = df.select(
        _key(F.col("text")).alias("key"), F.xxhash64("text").alias("brief"), "text"
    ).where(F.octet_length("text") >= length)
    anchors = kept(_anchors(texts, length)).repartition("anchor")
    place = F.xxhash64("brief", "start")
    shared = anchors.groupBy("anchor").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.min("start").alias("start")
    )
    shared = shared.where("low <> high OR start < 0").select("anchor")
    wanted = anchors.join(shared, "anchor").groupBy("brief")
    wanted = wanted.agg(F.collect_set("start").alias("starts"))
    some = _packed(texts, length).join(wanted, "brief").dropDuplicates(["key"])
    some = kept(some.select("key", "packed", "starts"))

    return _matched(kept(_shared_stretches(some, length)), length), some


def _removed(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Per text with spans: bytes and runs removed, and what remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {"key": [], "n_removed": [], "n_spans": [], "remaining": []}
            for key, packed, spans_ in zip(
                *[batch.column(c).to_pylist() for c in ("key", "packed", "spans")], strict=True
            ):
                text = unpack.decompress(packed)
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, [s["first"] for s in spans_], 1)
                np.add.at(step, [s["end"] for s in spans_], -1)
                gone = np.cumsum(step[:-1]) > 0
                out["key"].append(key)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(np.concatenate([[0], gone])) > 0).sum()))
                out["remaining"].append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema(
        [
            ("key", pa.binary()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("remaining", pa.binary()),
        ]
    )
    both = F.collect_list(F.struct("first", "end")).alias("spans")
    each = spans.distinct().groupBy("key").agg(both)
    return texts.select("key", "packed").join(each, "key").mapInArrow(
        run, "key binary, n_removed long, n_spans long, remaining binary"
    )


def _judged(df: DataFrame, length: int) -> DataFrame:
    """Per distinct text that loses bytes: ``key``, ``n_removed``, ``n_spans``, ``remaining``.

    A text that occurs twice loses all; ``whole`` says so.
    """
    texts = df.select(F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select(_key(F.col("text")).alias("key"), F.octet_length("text").alias("size"))
    copies = keyed.where(F.col("size") >= length).groupBy("key").agg(
        F.count("*").alias("copies"), F.first("size").alias("size")
    )
    whole = copies.where("copies > 1").select(
        "key",
        F.col("size").cast("long").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.lit(b"").alias("remaining"),
    )
    whole = kept(whole)
    spans, some = repeated_spans(texts, length)
    part = _removed(spans, some).join(whole.select("key"), "key", "left_anti")
    return whole.unionByName(part)


def repeated_strings(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of each row.

    Every byte of a text's UTF-8 that lies in a string of ``length`` bytes that also starts
    anywhere else in the table, the same text included, is removed; strings are judged on
    the input. A text that two rows have loses all its bytes.

    NULL and empty texts and those shorter than ``length`` lose nothing. A NULL ``doc_id``
    stays NULL; ids play no part, so repeated rows are copies of each other. Other columns
    are ignored, no rows give none. Very long texts are cut into overlapping segments.
    """
    rows = narrowed(df, doc_id="long", text="string")
    judged = _judged(rows, length).select(
        "key", "n_removed", "n_spans", F.sha2("remaining", 256).alias("left_sha256")
    )
    text = F.coalesce("text", F.lit(""))
    docs = rows.select(
        "doc_id",
        _key(text).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("own_sha256"),
    )
    none = F.lit(0).cast("long")
    return docs.join(judged, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("left_sha256", "own_sha256").alias("kept_sha256"),
    )


def without_repeats(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``df`` with what remains of ``text``; rows of which nothing remains go.

    A character of which a byte is removed goes as a whole. NULL and empty texts stay as they
    are, a text that stands on several rows goes from all of them, columns may have any
    names, and no rows give none.
    """
    need(df, "text")
    judged = _judged(df, length).select(
        F.col("key").alias("judged"),
        F.expr("try_validate_utf8(cast(remaining AS string))").alias("valid"),
        "remaining",
    )
    broken = judged.where("valid IS NULL").mapInArrow(
        _mended, "judged binary, remaining binary, valid string"
    )
    judged = judged.where("valid IS NOT NULL").unionByName(broken).drop("remaining")
    # Packed, so that no name of the caller's meets one of these.
    rows = df.select(F.struct("*").alias("row"))
    rows = rows.withColumn("key", _key(F.coalesce("row.text", F.lit(""))))
    joined = rows.join(judged, F.col("key") == F.col("judged"), "left")
    left = joined.where(F.col("judged").isNull() | (F.col("valid") != ""))
    text = F.coalesce("valid", "row.text")
    return left.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of the whole characters among the remaining bytes."""
    for batch in batches:
        texts = [x.decode(errors="ignore") for x in batch.column("remaining").to_pylist()]
        yield replace_columns(
            batch, ["judged", "remaining"], valid=pa.array(texts, pa.string())
        )
