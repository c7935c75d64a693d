"""Compression classifier: which of two zstandard dictionaries suits a text better.

A text is compressed in chunks, each anew with the dictionaries. Otherwise the history of a
long text would take their place, and its difference would go to the middle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import narrowed
from footfall.llm.words import blocks, replace_columns

DICTIONARY_BYTES = 64 << 10
SAMPLE = 1500  # texts of each label and use, at most
PIECE_BYTES = 2048
PIECES = 1 << 14  # pieces of those texts, of each label, that reach the driver, at most
CHUNK_BYTES = 2048  # of a text that are compressed at once
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """A dictionary per label and the calibration of their difference."""

    bad: bytes
    good: bytes
    slope: float
    middle: float


class _Sizes:
    def __init__(self, model: Model) -> None:
        self.compressors = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=self._ready(d))
            for d in (model.bad, model.good)
        ]

    @staticmethod
    def _ready(data: bytes) -> zstandard.ZstdCompressionDict:
        ready = zstandard.ZstdCompressionDict(data)
        ready.precompute_compress(level=LEVEL)
        return ready

    def difference(self, text: bytes) -> float:
        """Between -1 and 1, above 0 if the good dictionary shrinks the text more.

        The mean over all chunks, weighted by their compressed sizes; chunks are of about
        equal length, so that none is short.
        """
        count = max(1, round(len(text) / CHUNK_BYTES))
        cuts = [len(text) * k // count for k in range(count + 1)]
        chunks = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        bad, good = (sum(len(c.compress(x)) for x in chunks) for c in self.compressors)
        return (bad - good) / (bad + good)


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or the pieces themselves if they are too few to train one."""
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, pieces)) // 8))
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:] or b"\0"


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a logistic curve through labels, by Newton's method.

    Half a made-up observation on either side keeps separable labels finite; labels
    weigh alike however many there are of each.
    """
    if not len(x):
        return 1.0, 0.0
    scale = max(float(np.std(x)), 1e-9)
    centre = float(np.mean(x))
    z = np.stack([(x - centre) / scale, np.ones_like(x)], axis=1)
    share = np.where(y > 0, max(1, (y > 0).sum()), max(1, (y <= 0).sum()))
    weight = len(y) / 2 / share
    goal = (y * (len(y) - 1) + 0.5) / len(y)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        gradient = z.T @ (weight * (goal - p)) - np.array([0.01, 0.0]) * beta
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([0.01, 1e-9])
        step = np.linalg.solve(bend, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slope = float(beta[0]) / scale
    return (slope, centre - float(beta[1]) / slope) if slope > 0 else (1.0, 0.0)


def train(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from ``df`` (``doc_id``, ``text``) with ``labels`` (``doc_id``, ``label`` 0 or 1).

    ``sample`` bounds the texts of each label that build a dictionary, and as many others
    that calibrate; they are those first in a seeded order of ids. Texts count whole: they are
    scored where they lie, and their pieces go to the driver, all of them or, beyond
    ``PIECES`` of a label, the first in a seeded order. Rows with a NULL id, text or label teach
    nothing. Without one of the labels every text scores near one half.
    """
    texts = narrowed(df, doc_id="long", text="string").where("text <> ''")
    marks = narrowed(labels, doc_id="long", label="int").where("label IN (0, 1)").distinct()
    order = F.xxhash64(F.lit(11), "doc_id")
    pieces, held = [], []
    for label in (0, 1):
        # Ids are chosen before texts move: one bounded list per label.
        ids = texts.select("doc_id").join(marks.where(F.col("label") == label), "doc_id")
        ids = ids.select("doc_id").distinct().orderBy(order, "doc_id").limit(2 * sample)
        ids = [(row.doc_id,) for row in ids.collect()]
        learn, hold = (
            texts.join(F.broadcast(df.sparkSession.createDataFrame(own, "doc_id long")), "doc_id")
            for own in (ids[::2], ids[1::2])
        )
        pieces.append(_pieces(learn, order))
        held.append(hold)
    dictionaries = Model(*map(_dictionary, pieces), 1.0, 0.0)
    found = []
    for hold in held:
        differences = score(hold, dictionaries).select(order.alias("at"), "difference")
        rows = differences.orderBy("at", "difference").limit(2 * sample).collect()
        found.append([row.difference for row in rows])
    if min(map(len, found)) == 0:
        return dictionaries
    x = np.concatenate(found)
    y = np.repeat([0.0, 1.0], [len(own) for own in found])
    return replace(dictionaries, **dict(zip(("slope", "middle"), _calibrate(x, y), strict=True)))


def _pieces(texts: DataFrame, order) -> list[bytes]:
    """Pieces of whole texts, in the order of the texts if they are not too many."""
    raw = F.encode("text", "UTF-8")
    begins = F.sequence(F.lit(1), F.octet_length("text"), F.lit(PIECE_BYTES))
    cut = texts.select(order.alias("at"), raw.alias("raw"), F.explode(begins).alias("begin"))
    cut = cut.select(
        "at", "begin", F.substring("raw", F.col("begin"), F.lit(PIECE_BYTES)).alias("piece")
    )
    drawn = cut.orderBy(F.xxhash64(F.lit(12), "at", "begin"), "piece").limit(PIECES).collect()
    drawn.sort(key=lambda row: (row.at, row.begin, bytes(row.piece)))
    return [bytes(row.piece) for row in drawn]


def score(df: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``difference`` and ``score`` of each row, over whole texts.

    Works row by row without a shuffle; the model, two dictionaries of bounded size, goes
    along with the tasks. NULL and empty texts differ by about 0 and are scored as that;
    a NULL ``doc_id`` stays NULL, repeated rows score alike, other columns are ignored.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(model)
        for block in blocks(batches):
            n = len(block.offsets) - 1
            x = np.array([sizes.difference(block.text(i)) for i in range(n)])
            power = np.clip(-model.slope * (x - model.middle), -700, 700)
            yield replace_columns(
                block.rows, ["doc_id"], difference=x, score=1 / (1 + np.exp(power))
            )

    return narrowed(df, doc_id="long", text="string").mapInArrow(
        judge, "doc_id long, difference double, score double"
    )
