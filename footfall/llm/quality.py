"""Quality rules: counts of words and repeats, and compression bands.

A text that zstandard shrinks too much repeats itself; one that it hardly shrinks is
noise. How far a sound text shrinks depends on its length, so each length class has its
own band. The same test on fixed chunks finds bad parts of a longer text. A text that shrinks
far more than its length class in the corpus at hand does goes as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.llm.tables import kept, narrowed, need
from footfall.llm.words import (
    SPACED,
    Block,
    blocks,
    find_words,
    numbered,
    per_row,
    replace_columns,
    sequences,
    shingle_hashes,
)

SYMBOLS = b"#*$%&|<>"
STEP = 1e-4  # of ratios, where they are counted
WHOLE = (  # the docstring of Bands says what each is for
    (128, 0.50, 0.99),
    (160, 0.50, 0.94),
    (192, 0.54, 0.90),
    (256, 0.505, 0.86),
    (384, 0.44, 0.81),
    (512, 0.41, 0.77),
    (768, 0.395, 0.72),
    (1024, 0.38, 0.68),
    (1536, 0.345, 0.64),
    (2048, 0.325, 0.58),
    (3072, 0.31, 0.56),
    (4096, 0.29, 0.515),
    (8192, 0.26, 0.49),
    (16384, 0.25, 0.46),
)


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size / size.

    ``whole`` holds (bytes from, lowest, highest) by rising length; shorter texts than
    the first are not judged. A chunk of ``chunk`` bytes is bad outside ``chunk_band``, or
    without one outside the limits of its own length; a text goes if more than
    ``bad_chunks`` of its chunks are bad. A last chunk of less than half the size is judged
    with the whole text only.

    The limits lie at least 0.01 outside what clean prose has in a class, and beyond what
    they are to reject wherever the two lie apart. Clean prose are the good documents of
    the test corpus (four languages) and windows of English license texts, of which the
    middle 98 %. Below are texts whose second half repeats the first (from 192 bytes on).
    Above are base64 (from 128 bytes on), random lower-case letters (from 2048) and hex
    digits (from 4096); shorter ones shrink as prose does and cannot be told by a ratio.

    How far prose shrinks differs from corpus to corpus, so a second lower limit is taken
    from all texts of the table that pass the base rule: ``spreads`` standard deviations
    below the median of the length class, told from the median deviation, where a class has
    ``least_texts`` different texts. Texts that share the least hash of their three-word
    windows, as copies and most near copies do, count once, so that a large group of copies
    does not shift it.
    """

    whole: tuple[tuple[int, float, float], ...] = WHOLE
    chunk: int = 4096
    chunk_band: tuple[float, float] | None = None
    bad_chunks: float = 0.5
    level: int = 3
    spreads: float = 3.25
    least_texts: int = 50

    def limits(self, size: int) -> tuple[float, float]:
        """Lowest and highest ratio of ``size`` bytes."""
        fits = 0.0, math.inf
        for least, low, high in self.whole:
            if size >= least:
                fits = low, high
        return fits


def _judge(text: bytes, bands: Bands, compressor: zstandard.ZstdCompressor):
    """Ratio of the whole text, worst chunks' share, and the verdict."""
    size = len(text)
    if not size:
        return None, 0, 0, True
    ratio = len(compressor.compress(text)) / size
    low, high = bands.limits(size)
    fits = low <= ratio <= high
    chunks = bad = 0
    if size > bands.chunk:
        for start in range(0, size, bands.chunk):
            piece = text[start : start + bands.chunk]
            if 2 * len(piece) < bands.chunk:
                break
            chunks += 1
            low, high = bands.chunk_band or bands.limits(len(piece))
            bad += not low <= len(compressor.compress(piece)) / len(piece) <= high
    return ratio, chunks, bad, fits and bad <= bands.bad_chunks * chunks


def counts(block: Block) -> dict[str, np.ndarray]:
    """Counts of each text of a block, over whole texts."""
    data, offsets = block.data, block.offsets
    n = len(offsets) - 1
    words = find_words(block, SPACED)
    inside = SPACED[data]
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True

    breaks = np.flatnonzero(data == ord("\n"))
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    # A break ends a line in front of it; so does the end of a text.
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]))
    break_rows = np.searchsorted(offsets, breaks, "right") - 1
    line_rows = np.sort(np.concatenate([np.arange(n), break_rows]))
    worded = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    lines, _, _ = numbered(data, line_starts[worded], line_ends[worded])
    rows = line_rows[worded]
    _, first = np.unique(rows * (len(lines) + 1) + lines, return_index=True)
    n_lines, distinct = np.bincount(rows, minlength=n), np.bincount(rows[first], minlength=n)

    ids, _, hashes = numbered(data, words.starts, words.ends)
    repeated = np.zeros(len(ids), bool)
    least = np.full(n, np.iinfo(np.int64).max)
    if len(ids) >= 3:
        windows = sequences(ids, 3)
        whole = words.rows[:-2] == words.rows[2:]
        hashed = shingle_hashes(hashes[ids], 3)[:-2].view(np.int64)
        np.minimum.at(least, words.rows[:-2][whole], hashed[whole])
        windows = (words.rows[:-2] * len(ids) + windows)[whole]
        _, inverse, found = np.unique(windows, return_inverse=True, return_counts=True)
        at = np.flatnonzero(whole)[found[inverse] >= 2]
        for k in range(3):
            repeated[at + k] = True
    return {
        "n_words": np.diff(words.offsets).astype(np.int64),
        "word_chars": per_row(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_row(symbols[data], offsets),
        "n_dup_lines": (n_lines - distinct).astype(np.int64),
        "n_repeat_words": per_row(repeated, words.offsets),
        "n_bytes": np.diff(offsets).astype(np.int64),
        "least_window": least,
    }


def _judged(df: DataFrame, bands: Bands, text: str = "text") -> DataFrame:
    """Verdicts on the texts, beside the other columns of ``df``."""
    others = [f for f in df.schema if f.name != text]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        for block in blocks(batches, text):
            found = counts(block)
            n = len(block.offsets) - 1
            verdicts = [_judge(block.text(i), bands, compressor) for i in range(n)]
            ratio, chunks, bad, fits = zip(*verdicts, strict=True)
            failed = (found["n_words"] < 50) | (
                100 * found["n_repeat_words"] > 50 * found["n_words"]
            )
            yield replace_columns(
                block.rows,
                [f.name for f in others],
                **{name: found[name] for name in COUNTS},
                base_failed=failed,
                n_bytes=found["n_bytes"],
                least_window=found["least_window"],
                ratio=pa.array(ratio, pa.float64()),
                n_chunks=pa.array(chunks, pa.int64()),
                n_bad_chunks=pa.array(bad, pa.int64()),
                kept=~failed & np.array(fits),
            )

    return df.mapInArrow(judge, StructType([*others, *StructType.fromDDL(VERDICT)]))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_bytes long, least_window long, ratio double, n_chunks long, "
    "n_bad_chunks long, kept boolean"
)


def _class(bands: Bands) -> Column:
    """The number of the length class of ``n_bytes``, 0 for shorter texts."""
    return sum(
        ((F.col("n_bytes") >= least).cast("int") for least, _, _ in bands.whole), F.lit(0)
    )


def corpus_limits(judged: DataFrame, bands: Bands) -> list[float]:
    """The lowest ratio of each length class that the corpus itself asks for, 0 without any.

    ``judged`` has the figures of all texts. Ratios are counted in steps of ``STEP``, so that
    some thousand counts per class come to the driver, and reruns agree.
    """
    sound = judged.where(~F.col("base_failed") & F.col("ratio").isNotNull())
    at = F.floor(F.col("ratio") / STEP).cast("long")
    once = sound.groupBy(_class(bands).alias("kind"), "least_window").agg(F.min(at).alias("at"))
    told = once.groupBy("kind", "at").agg(F.count("*").alias("n")).collect()
    limits = [0.0] * (len(bands.whole) + 1)
    for kind in range(1, len(limits)):
        counts = sorted((r["at"], r["n"]) for r in told if r["kind"] == kind)
        total = sum(n for _, n in counts)
        if total < bands.least_texts:
            continue
        middle = _median(counts)
        deviation = _median(sorted((abs(x - middle), n) for x, n in counts))
        limits[kind] = (middle - bands.spreads * max(1.4826 * deviation, 1)) * STEP
    return limits


def _median(counts: list[tuple[int, int]]) -> int:
    """The lower median of sorted values, each with its number."""
    half, before = (sum(n for _, n in counts) + 1) // 2, 0
    for value, n in counts:
        before += n
        if before >= half:
            return value
    raise ValueError("no values")


def _kept(bands: Bands, limits: list[float]) -> Column:
    low = F.get(F.array(*map(F.lit, limits)), _class(bands))
    return F.col("kept") & (F.col("ratio") >= low)


def quality_rules(df: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``doc_id``, counts, compression figures, ``base_failed`` and ``kept`` of each row.

    Texts are read once; their figures are written down, and the limits of the corpus are
    taken from all of them. NULL and empty texts have no words, so they
    fail; ``ratio`` is NULL for them. A NULL ``doc_id`` stays NULL, repeated rows are
    judged one by one, other columns are ignored. An empty table gives no rows.
    """
    judged = kept(_judged(narrowed(df, doc_id="long", text="string"), bands))
    passed = F.coalesce(_kept(bands, corpus_limits(judged, bands)), F.lit(False))
    return judged.withColumn("kept", passed).drop("least_window")


def keep_sound(df: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``df``, with all columns, that the rules keep.

    Texts are read twice, first for the limits of the corpus. NULL and empty texts go.
    Repeated rows are judged one by one, columns may have any names, and no rows give none.
    """
    need(df, "text")
    limits = corpus_limits(_judged(narrowed(df, text="string"), bands), bands)
    rows = df.select(F.struct("*").alias("_row"))
    return _judged(rows, bands, "_row.text").where(_kept(bands, limits)).select("_row.*")
