"""Near-duplicates by fast similarity sketches, banding and exact verification.

A sketch is filled in rounds: in each, a hash throws every shingle into one of the bins with
a value, and the first round to reach a bin decides, least value first. After as many rounds
as bins, each further round throws all shingles into one bin, so every bin fills. Two sketches
agree in a bin with the probability of the sets' similarity, with errors as small as those of
independent bins.

Texts that share a band of bins are compared by their sketches, neighbour by neighbour in
the order of their other bins, and those alike form families. Inside a family all links are
decided on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.tables import kept, narrowed, need
from footfall.llm.words import (
    SPACED,
    Block,
    block_of,
    blocks,
    find_words,
    mix,
    numbered,
    replace_columns,
    sequences,
    shingle_hashes,
)

BANDS = 30
BAND_BINS = 5
BINS = BANDS * BAND_BINS
FAMILY_ESTIMATE = 0.5  # of neighbours in a bucket to count as one family
BLOCK_TEXTS = 512  # of a family that are compared at once
BLOCK_TEXT_BYTES = 16 << 20
PIVOTS = 64  # of a large family that take part in each of its blocks
_UNSET = np.uint64(2**64 - 1)


def shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct shingles: their numbers in the block, hashes, and rows.

    Numbers are equal for equal shingles only. A row of fewer words than ``size`` has one
    shingle, its whole sequence; without words it has none.
    """
    block = block.lower()
    words = find_words(block, SPACED)
    ids, _, hashes = numbered(block.data, words.starts, words.ends)
    counts = np.diff(words.offsets)
    own = sequences(ids, size)
    rows = words.rows[: len(own)]
    at = np.flatnonzero(np.arange(len(own)) + size <= words.offsets[1:][rows])
    many = int(own.max(initial=-1)) + 1
    pairs, first = np.unique(rows[at] * many + own[at], return_index=True)
    at = at[first]
    hashed = shingle_hashes(hashes[ids], size)[at]
    number, owner = own[at], rows[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    brief: dict[bytes, int] = {}
    few_hashes, few_numbers = [], []
    for row in short:
        few = ids[words.offsets[row] : words.offsets[row + 1]]
        few_numbers.append(brief.setdefault(few.tobytes(), many + len(brief)))
        few_hashes.append(shingle_hashes(hashes[few], len(few))[0] + np.uint64(len(few)))
    number = np.concatenate([number, np.array(few_numbers, np.int64)])
    hashed = np.concatenate([hashed, mix(np.array(few_hashes, np.uint64))])
    owner = np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    return number[order], hashed[order], owner[order]


def sketch(found: np.ndarray, rows: np.ndarray, n_rows: int, bins: int = BINS) -> np.ndarray:
    """Sketch of each row, ``bins`` numbers; rows without shingles stay unset."""
    out = np.full((n_rows, bins), _UNSET, np.uint64)
    flat = out.reshape(-1)
    todo = np.bincount(rows, minlength=n_rows) > 0
    for turn in range(2 * bins):
        if not len(found):
            break
        thrown = mix(found + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = (np.uint64(turn) << np.uint64(48)) | (thrown >> np.uint64(16))
        if turn < bins:
            place = ((thrown & np.uint64(0xFFFFFFFF)) * np.uint64(bins)) >> np.uint64(32)
        else:
            place = np.uint64(turn - bins)
        np.minimum.at(flat, rows * bins + place.astype(np.int64), value)
        filled = (out != _UNSET).all(axis=1)
        if (filled & todo).any():
            todo &= ~filled
            left = todo[rows]
            found, rows = found[left], rows[left]
    return out


def _bands(sketches: np.ndarray) -> np.ndarray:
    """One number per band, which tells bands apart."""
    out = np.zeros((len(sketches), BANDS), np.uint64)
    for k in range(BAND_BINS):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + sketches[:, k::BAND_BINS][:, :BANDS])
    return mix(out + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _sketched(df: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``key``, ``n_shingles``, ``bands`` and ``sketch``, a byte for each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = len(block.offsets) - 1
            _, found, rows = shingles(block, size)
            sizes = np.bincount(rows, minlength=n).astype(np.int64)
            made = sketch(found, rows, n)
            bands = _bands(made)
            ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
            brief = (mix(made) & np.uint64(0xFF)).astype(np.uint8)
            # In the order of bands: bins of band b are 5b to 5b + 4.
            listed = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(bands[sizes > 0].reshape(-1))
            )
            raw = pa.array([row.tobytes() for row in brief], pa.binary())
            yield replace_columns(
                block.rows, ["doc_id", "key"], n_shingles=sizes, bands=listed, sketch=raw
            )

    texts = narrowed(df, doc_id="long", text="string")
    return texts.select("doc_id", _key(F.col("text")).alias("key"), "text").mapInArrow(
        run,
        "doc_id long, key binary, n_shingles long, bands array<long>, sketch binary",
    )


def _key(text):
    """What tells texts apart: equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _families(sketched: DataFrame) -> DataFrame:
    """Edges between neighbours that look alike, from each to the first of its run."""
    nodes = sketched.where("n_shingles > 0").select("key", "bands", "sketch")
    nodes = nodes.dropDuplicates(["key"])
    rows = nodes.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = shared.where("low <> high").select("bucket")
    rows = rows.join(shared, "bucket").join(nodes.select("key", "sketch"), "key")
    # Turned so that the bins after the band come first.
    head = (F.col("band") + 1) * BAND_BINS
    turned = F.concat(
        F.substring(F.col("sketch"), head + 1, F.lit(BINS)),
        F.substring(F.col("sketch"), F.lit(1), head),
    )
    rows = rows.select("bucket", turned.alias("turned"), "key")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "turned", "key")
    return rows.mapInArrow(_runs, "a binary, b binary").distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from rows sorted by bucket and sketch; a run ends where neighbours differ."""
    last_bucket, last, head = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        keys = batch.column("key").to_pylist()
        bins = np.frombuffer(b"".join(batch.column("turned").to_pylist()), np.uint8)
        bins = bins.reshape(-1, BINS)
        before = np.concatenate([bins[:1] if last is None else last[None], bins[:-1]])
        agree = (bins == before).mean(axis=1) >= FAMILY_ESTIMATE
        agree[1:] &= bucket[1:] == bucket[:-1]
        agree[0] &= bucket[0] == last_bucket
        out_a, out_b = [], []
        for key, joined in zip(keys, agree.tolist(), strict=True):
            if joined:
                out_a.append(key)
                out_b.append(head)
            else:
                head = key
        last_bucket, last = bucket[-1], bins[-1]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())}
        )


def _links(texts: pa.Table, size: int, percent: int) -> pa.Table:
    """The parts of a few texts that links join: each with the least that it is joined to.

    Texts of one ``part`` are joined already and are not compared.
    """
    unpack = zstandard.ZstdDecompressor()
    packed, parts = texts.column("packed").to_pylist(), texts.column("part").to_pylist()
    ids, _, rows = shingles(block_of([unpack.decompress(x) for x in packed]), size)
    offsets = np.searchsorted(rows, np.arange(len(parts) + 1))
    sizes = np.diff(offsets)
    # Parts by number, in their order: a root is the least of its tree.
    names = sorted(set(parts))
    number = {part: i for i, part in enumerate(names)}
    root = np.array([number[part] for part in parts], np.int64)  # of each text
    marked = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    for i in range(len(parts) - 1):
        rest = slice(i + 1, None)
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        apart = (root[rest] != root[i]) & (100 * small >= percent * large)
        if not apart.any():
            continue
        own = ids[offsets[i] : offsets[i + 1]]
        marked[own] = 1
        total = np.concatenate([[0], np.cumsum(marked[ids[offsets[i + 1] :]])])
        common = np.diff(total[offsets[i + 1 :] - offsets[i + 1]])
        marked[own] = 0
        union = sizes[i] + sizes[rest] - common
        near = apart & (100 * common >= percent * union)
        if near.any():
            joined = np.append(root[rest][near], root[i])
            root[np.isin(root, joined)] = joined.min()
    moved = {part: names[r] for part, r in zip(parts, root.tolist(), strict=True)}
    moved = {part: r for part, r in moved.items() if part != r}
    return pa.table(
        {"a": pa.array(moved, pa.binary()), "b": pa.array(moved.values(), pa.binary())}
    )


def _verified(df: DataFrame, family: DataFrame, size: int, percent: int) -> DataFrame:
    """``key`` and ``label`` of texts whose full sets link them with others of their family.

    A family is compared in blocks of bounded size, most in one, which then knows its
    components. Each block of a larger family holds some texts of all its blocks, so what
    lies in the middle is joined at once; the texts that then stay outside their family's
    largest part are compared with all others of it.
    """

    def link(texts: pa.Table) -> pa.Table:
        return _links(texts, size, percent)

    # Texts go by key whatever the sizes are, to meet their family and each other.
    packed = _packed(df).join(family.hint("merge"), "key").dropDuplicates(["key"])
    packed = kept(packed.select("key", "label", "packed", "n_bytes"))
    sums = packed.groupBy("label").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    n_blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_TEXT_BYTES)
    )
    rare = F.ceil(F.col("n") / PIVOTS)
    # Only large families need their sizes, which are few: texts go straight to their blocks,
    # and not by way of one task for their family.
    large = kept(
        sums.select("label", n_blocks.cast("int").alias("n_blocks"), rare.alias("rare")).where(
            "n_blocks > 1"
        )
    )
    rows = packed.join(large, "label", "left").withColumns(
        {
            "n_blocks": F.coalesce("n_blocks", F.lit(1)),
            "rare": F.coalesce("rare", F.lit(1)),
            "part": F.col("key"),
        }
    )
    own = F.pmod(F.xxhash64(F.lit(1), "key"), F.col("n_blocks")).cast("int")
    pivot = (F.col("n_blocks") > 1) & (F.pmod(F.xxhash64(F.lit(2), "key"), F.col("rare")) == 0)
    every = F.when(pivot, F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array(own))
    first = rows.select(
        "label", "n_blocks", "packed", "part", F.explode(every).alias("block")
    )
    edges = first.groupBy("label", "n_blocks", "block").applyInArrow(
        lambda key, texts: _flagged(link(texts), key[1].as_py() == 1),
        "a binary, b binary, whole boolean",
    )
    edges = kept(edges)
    labels = edges.where("whole").select(F.col("a").alias("key"), F.col("b").alias("label"))
    large = rows.where("n_blocks > 1")
    if large.isEmpty():
        return labels

    parts = kept(components(edges.where(~F.col("whole"))))
    parts = parts.select(F.col("node").alias("key"), F.col("label").alias("part"))
    large = large.drop("part").join(parts, "key", "left")
    large = large.withColumn("part", F.coalesce("part", "key"))
    counts = large.groupBy("label", "part").agg(F.count("*").alias("n"))
    largest = F.max_by("part", F.struct("n", "part")).alias("main")
    most = counts.groupBy("label").agg(
        largest, (F.sum("n") - F.max("n")).alias("outside")
    )
    large = large.join(most.where("outside > 0"), "label")
    n_out = F.ceil(F.col("outside") * 2 / BLOCK_TEXTS).cast("int")
    large = large.withColumn("n_out", n_out)
    # A grid of blocks: outsiders by all texts.
    out_block = F.pmod(F.xxhash64(F.lit(3), "key"), F.col("n_out")).cast("int")
    column = F.transform(
        F.sequence(F.lit(0), F.col("n_out") - 1),
        lambda i: F.struct(i.alias("i"), own.alias("j")),
    )
    line = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda j: F.struct(out_block.alias("i"), j.alias("j")),
    )
    cells = F.when(F.col("part") == F.col("main"), column).otherwise(
        F.array_distinct(F.concat(column, line))
    )
    grid = large.select("label", "packed", "part", F.explode(cells).alias("cell"))
    grid = grid.select("label", "packed", "part", "cell.i", "cell.j")
    more = kept(grid.groupBy("label", "i", "j").applyInArrow(link, "a binary, b binary"))
    if not more.isEmpty():
        joined = components(more).withColumnsRenamed({"node": "part", "label": "joined"})
        parts = parts.join(joined, "part", "left").select(
            "key", F.coalesce("joined", "part").alias("part")
        )
        # Parts of one text stand in no edge of the first round.
        new = joined.join(parts, joined["part"] == parts["key"], "left_anti")
        new = new.select(F.col("part").alias("key"), F.col("joined").alias("part"))
        parts = parts.unionByName(new)
    return labels.unionByName(parts.withColumnRenamed("part", "label"))


def _flagged(edges: pa.Table, whole: bool) -> pa.Table:
    return edges.append_column("whole", pa.array([whole] * len(edges), pa.bool_()))


def _packed(df: DataFrame) -> DataFrame:
    """Texts compressed for their way through shuffles; a task sends a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        seen: set[bytes] = set()
        for block in blocks(batches):
            new = []
            for i, key in enumerate(block.rows.column("key").to_pylist()):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            packed = pa.array([compressor.compress(block.text(i)) for i in new], pa.binary())
            yield replace_columns(
                block.rows.take(pa.array(new, pa.int64())),
                ["key"],
                packed=packed,
                n_bytes=np.diff(block.offsets)[new].astype(np.int64),
            )

    texts = narrowed(df, text="string").select(_key(F.col("text")).alias("key"), "text")
    return texts.mapInArrow(run, "key binary, packed binary, n_bytes long")


def _decided(df: DataFrame, size: int, percent: int) -> DataFrame:
    sketched = kept(_sketched(df, size))
    family = kept(components(_families(sketched))).withColumnRenamed("node", "key")
    labels = _verified(df, family, size, percent)
    parts = sketched.select("doc_id", "key", "n_shingles").join(labels, "key", "left")
    parts = parts.withColumn("part", F.coalesce("label", "key")).drop("label")
    some = parts.where("n_shingles > 0")
    least = some.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    joined = some.join(least, "part")
    alone = parts.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return joined.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_duplicates(df: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of each row.

    Links rows whose sets of ``size``-word shingles have ``percent`` of their union in common;
    a component is named by its smallest ``doc_id``, whose row is the one kept. Two texts
    meet in a band with probability 1 - (1 - s**5)**30 at similarity s, 0.999993 at 0.8;
    what meets is decided on the full sets.

    NULL and empty texts have no shingles and stay alone. A NULL ``doc_id`` names a
    component only if no row of it has one; rows repeated under one id share its fate, and
    there are no other ties. Other columns are ignored, no rows give none.
    """
    return _decided(df, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(df: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, with all columns, that ``near_duplicates`` keeps.

    NULL and empty texts stay, and so do all rows that repeat the one that is kept under
    its id. Columns may have any names; no rows give none.
    """
    need(df, "doc_id", "text")
    gone = _decided(df, size, percent).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
    # Packed, so that no name of the caller's meets one of these.
    rows = df.select(F.struct("*").alias("row")).withColumn("key", _key(F.col("row.text")))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    return rows.join(gone, same, "left_anti").select("row.*")
