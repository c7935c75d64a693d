"""Texts as byte arrays: blocks of documents, their words, and polynomial hashes of any slice.

Word classes are given over bytes. That is exact for UTF-8: every byte of a character
outside ASCII is 128 or more, and all classes here treat those characters alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONG = 512  # bytes of a range from which on it is hashed and compared alone
BLOCK_BYTES = (1 << 19) - 64  # texts handled at once; a longer document is a block of its own
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _class(separators: list[int]) -> np.ndarray:
    table = np.ones(256, bool)
    table[separators] = False
    return table


# The separators of the two kinds of words.
SPACED = _class([0x20, *range(0x09, 0x0E)])
ALPHANUMERIC = _class([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Block:
    """Some rows of a batch; row i has the bytes ``data[offsets[i]:offsets[i + 1]]``."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def lower(self) -> Block:
        """With A to Z as a to z."""
        return Block(self.rows, LOWER[self.data], self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def block_of(texts: list[bytes], rows: pa.RecordBatch | None = None) -> Block:
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    return Block(rows, np.frombuffer(b"".join(texts), np.uint8), ends)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or with a dot a field of one."""
    first, *fields = name.split(".")
    found = batch.column(first)
    for field in fields:
        found = pc.struct_field(found, field)
    return found


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[Block]:
    """Cuts batches into blocks of about ``limit`` bytes of text, or bytes. NULL counts as empty."""
    for batch in batches:
        texts = pc.fill_null(_column(batch, column).cast(pa.large_binary()), b"")
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(sizes, sizes[low] + limit, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            part = texts.slice(low, high - low)
            _, ends, data = part.buffers()
            ends = np.frombuffer(ends, np.int64)[part.offset : part.offset + len(part) + 1]
            raw = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
            yield Block(batch.slice(low, high - low), raw, ends - ends[0])
            low = high


@dataclass(frozen=True)
class Words:
    """Words of a block: byte ranges, row of each, and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    offsets: np.ndarray


def find_words(block: Block, kind: np.ndarray) -> Words:
    inside = kind[block.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(block.offsets), np.int64))
    edges = block.offsets[:-1]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = edges[edges < n]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = block.offsets[1:]
    tails = tails[tails > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.searchsorted(starts, block.offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return Words(starts, ends, rows, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for factor in (_BASE, inverse):
        powers = np.full(size, factor, np.uint64)
        powers[:1] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``size`` of each."""
    return _powers(1 << max(16, int(size).bit_length()))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every prefix; differences give the hash of any slice (see ``slice_hashes``)."""
    out = np.zeros(len(data) + 1, np.uint64)
    values = data.astype(np.uint64) + np.uint64(1)
    values *= powers(len(data))[0][: len(data)]
    np.cumsum(values, out=out[1:])
    return out


def slice_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``data[starts:ends]``, equal for equal bytes wherever they stand."""
    unshift = powers(len(prefix))[1][starts]
    return mix((prefix[ends] - prefix[starts]) * unshift + (ends - starts).astype(np.uint64))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; behind the end stand zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, np.uint64, padded, 0, (1,))


def _part(eights: np.ndarray, starts: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from ``starts``, of ranges that have ``left`` bytes from there."""
    shift = (np.uint64(8) * np.clip(8 - left, 0, 8).astype(np.uint64)).astype(np.uint64)
    found = eights[starts]
    # A shift by all 64 bits is none, so an empty range is cleared by itself.
    return np.where(left > 0, found << shift, np.uint64(0))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, eight bytes at a time and mixed after each."""
    length = ends - starts
    out = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    eights = _eights(data)
    short = length <= LONG
    own = np.flatnonzero(short & (length > 0))
    at = 0
    while len(own):
        part = _part(eights, starts[own] + at, length[own] - at)
        out[own] = mix((out[own] + part) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(at + 1))
        at += 8
        own = own[length[own] > at]
    for i in np.flatnonzero(~short):
        digest = blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def equal_ranges(
    data: np.ndarray, starts, ends, others: np.ndarray, other_starts, other_ends
) -> np.ndarray:
    """Whether ranges of ``data`` hold the same bytes as ranges of ``others``, one by one."""
    length = ends - starts
    same = length == other_ends - other_starts
    ours = _eights(data)
    theirs = ours if others is data else _eights(others)
    own = np.flatnonzero(same & (length > 0) & (length <= LONG))
    at = 0
    while len(own):
        left = length[own] - at
        a, b = starts[own] + at, other_starts[own] + at
        differ = _part(ours, a, left) != _part(theirs, b, left)
        same[own[differ]] = False
        at += 8
        own = own[~differ & (length[own] > at)]
    for i in np.flatnonzero(same & (length > LONG)):
        theirs_ = others[other_starts[i] : other_ends[i]]
        same[i] = bool((data[starts[i] : ends[i]] == theirs_).all())
    return same


def numbered(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of byte ranges, the same for the same bytes and for no others.

    Also the place of a range of each number, and its hash. Hashes only propose what is
    equal; bytes are compared, and ranges that share a hash alone get numbers of their own.
    """
    hashes = byte_hashes(data, starts, ends)
    distinct, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    named = first[ids]
    same = equal_ranges(data, starts, ends, data, starts[named], ends[named])
    if not same.all():
        more: dict[bytes, int] = {}
        extra = []
        for i in np.flatnonzero(~same):
            key = data[starts[i] : ends[i]].tobytes()
            if key not in more:
                more[key] = len(first) + len(extra)
                extra.append(i)
            ids[i] = more[key]
        first = np.concatenate([first, np.array(extra, first.dtype)])
    return ids, first, hashes[first]


def sequences(ids: np.ndarray, size: int) -> np.ndarray:
    """Numbers of each ``size`` ids in a row, the same for the same ids and for no others."""
    many = int(ids.max(initial=0)) + 1
    out = ids[: max(0, len(ids) - size + 1)].astype(np.int64)
    for k in range(1, size):
        out = out * many + ids[k : k + len(out)]
        out = np.unique(out, return_inverse=True)[1]
    return out


def word_hashes(block: Block, words: Words) -> np.ndarray:
    return byte_hashes(block.data, words.starts, words.ends)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words; the last ``size - 1`` entries mean nothing."""
    out = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        part = hashes[k:]
        out[: len(part)] = out[: len(part)] * np.uint64(0xD6E8FEB86659FD93) + part
    return mix(out)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each ``offsets[i]:offsets[i + 1]``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def replace_columns(rows: pa.RecordBatch, keep: list[str], **new) -> pa.RecordBatch:
    """Columns of ``rows`` named in ``keep``, and new ones."""
    columns = {name: rows.column(name) for name in keep}
    columns.update({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in new.items()})
    return pa.RecordBatch.from_pydict(columns)
