"""Chat formatting at token level.

Every turn is ``<turn>`` role ``<says>`` text ``</turn>``. Roles and texts are encoded apart
from each other and from the three control strings, which are reserved ids beyond the
vocabulary: no text can produce them. Where a text itself holds a control string, a
backslash goes before it, so that the decoded conversation can be read back too.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.tables import narrowed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 16 << 20  # a vocabulary file goes along with the tasks: no larger one
# Fixed value: how the vocabulary's tokenizer cuts text before it joins bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TURN, SAYS, END = CONTROLS = ("<turn>", "<says>", "</turn>")
CHUNK_TOKENS = 1 << 16
PIECE_CHARS = 1 << 16  # of a very long text that are encoded at once
_BEFORE_BLANK = re.compile(r"(?<=\S)(?=[ \n])")
_CONTROL = "|".join(map(re.escape, CONTROLS))
_PLAIN = re.compile(rf"(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"(\\+)({_CONTROL})")


def escape(text: str) -> str:
    """n backslashes before a control string become 2n + 1."""
    return _PLAIN.sub(lambda m: "\\" * (2 * len(m[1]) + 1) + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" * ((len(m[1]) - 1) // 2) + m[2], text)


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The vocabulary file, read by Spark; it must be small enough to go along with tasks."""
    size = spark.read.format("binaryFile").load(path).select("length", "content")
    if size.select("length").head()[0] > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return bytes(size.head().content)


@lru_cache(maxsize=1)
def _encoding(ranks: bytes) -> tuple[tiktoken.Encoding, int]:
    """The tokenizer, and the first id beyond it with one to spare for its end of text."""
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    made = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return made, max(table.values()) + 2


def _encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The tokens of a text. A long one is cut where the pattern cuts anyhow: before a blank
    or a line break that follows other characters. So its tokens are those of the whole.
    """
    ids: list[int] = []
    start = 0
    while len(text) - start > PIECE_CHARS:
        found = _BEFORE_BLANK.search(text, start + PIECE_CHARS)
        if found is None:
            break
        ids += encoding.encode_ordinary(text[start : found.start()])
        start = found.start()
    return ids + encoding.encode_ordinary(text[start:])


def assemble(encoding, reserved: int, turns: Iterable[tuple[str, str]], learn: str):
    """Ids and loss mask of some turns, spliced from segments."""
    segments: list[tuple[list[int], bool]] = []
    for role, text in turns:
        segments += [
            ([reserved], False),
            (_encode(encoding, escape(role)), False),
            ([reserved + 1], False),
            (_encode(encoding, escape(text)), role == learn),
            ([reserved + 2], False),
        ]
    lengths = np.array([len(ids) for ids, _ in segments], np.int64)
    ends = np.cumsum(lengths)
    marks = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int8)
    learned = np.array([flag for _, flag in segments], bool)
    np.add.at(marks, (ends - lengths)[learned], 1)
    np.add.at(marks, ends[learned], -1)
    mask = np.cumsum(marks[:-1], dtype=np.int8)
    ids = np.fromiter((i for part, _ in segments for i in part), np.int32, int(lengths.sum()))
    return ids, mask


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``; NULL role or text becomes empty text."""
    return narrowed(
        conversations, conv_id="long", turn="long", role="string", text="string"
    ).select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])


def format_chats(
    conversations: DataFrame,
    ranks: bytes,
    learn: str = "assistant",
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Formatted conversations in chunks of whole turns: ``ids`` and ``loss_mask``.

    A conversation's chunks, in the order of ``chunk``, are its tokens. The mask is 1 on the
    text of each turn whose role is ``learn``. Write the rows to a table before use: another
    run may number the chunks otherwise. Turns are ordered over the whole
    table by conversation, turn, role and text, so one conversation may be spread over many
    tasks; a task holds one chunk. A chunk closes at ``chunk_tokens`` or after a longer turn.

    NULL roles and texts count as empty. NULL ids make up one conversation, NULL turns
    come first, tied turns go by role and text, repeated rows are all kept, other columns
    are ignored, no rows give no chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, reserved = _encoding(ranks)
        # Partitions are ranges in order, and so are the numbers made from theirs.
        number = TaskContext.get().partitionId() << 33
        turns: list[tuple[np.ndarray, np.ndarray]] = []
        owner, size = None, 0

        def chunk() -> pa.RecordBatch:
            ids, mask = (np.concatenate(parts) for parts in zip(*turns, strict=True))
            turns.clear()
            columns = [
                pa.array([owner], pa.int64()),
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int32())),
                pa.array([mask], pa.list_(pa.int8())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=CHUNK)

        for batch in batches:
            for conv_id, role, text in zip(
                *[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True
            ):
                if turns and (owner != conv_id or size >= chunk_tokens):
                    yield chunk()
                    number, size = number + 1, 0
                owner = conv_id
                turns.append(assemble(encoding, reserved, [(role, text)], learn))
                size += len(turns[-1][0])
        if turns:
            yield chunk()

    order = ["conv_id", "turn", "role", "text"]
    turns = turns_in_order(conversations)
    return (
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            run,
            "conv_id long, chunk long, ids array<int>, loss_mask array<tinyint>",
        )
    )


def parse(encoding, reserved: int, ids: np.ndarray, mask: np.ndarray):
    """Turns of a chunk from its tokens: role, text, characters, and the text under the mask."""
    starts, ends = np.flatnonzero(ids == reserved), np.flatnonzero(ids == reserved + 2)
    middles = np.flatnonzero(ids == reserved + 1)
    controls = sum(map(len, CONTROLS))
    for a, b, c in zip(starts, middles, ends, strict=True):
        role = encoding.decode(ids[a + 1 : b].tolist())
        text = encoding.decode(ids[b + 1 : c].tolist())
        learned = [
            unescape(encoding.decode(ids[a:c][run].tolist())) for run in _runs(mask[a : c + 1])
        ]
        yield unescape(role), unescape(text), controls + len(role) + len(text), "".join(learned)


def _runs(mask: np.ndarray) -> list[slice]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    return [slice(a, b) for a, b in edges.reshape(-1, 2)]


def decoded(chunks: DataFrame, ranks: bytes) -> DataFrame:
    """The turns of formatted conversations, read from their tokens alone.

    Per turn: ``conv_id``, ``chunk``, ``at`` (place in the chunk), ``role``, ``text``, ``chars``
    (of the formatted turn) and ``learned`` (text under the mask).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, reserved = _encoding(ranks)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in TURNS.names}
            tokens = 0
            for i in range(batch.num_rows):
                ids, mask = (batch.column(c)[i].values.to_numpy() for c in ("ids", "loss_mask"))
                owner = [batch.column(c)[i].as_py() for c in ("conv_id", "chunk")]
                for at, turn in enumerate(parse(encoding, reserved, ids, mask)):
                    for name, value in zip(TURNS.names, [*owner, at, *turn], strict=True):
                        out[name].append(value)
                tokens += len(ids)
                if tokens >= CHUNK_TOKENS:
                    yield pa.RecordBatch.from_pydict(out, TURNS)
                    out, tokens = {name: [] for name in TURNS.names}, 0
            yield pa.RecordBatch.from_pydict(out, TURNS)

    return chunks.select(*CHUNK).mapInArrow(
        read,
        "conv_id long, chunk long, at long, role string, text string, chars long, learned string",
    )


CHUNK = ["conv_id", "chunk", "ids", "loss_mask"]
TURNS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("chunk", pa.int64()),
        ("at", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("chars", pa.int64()),
        ("learned", pa.string()),
    ]
)
