"""Benchmark decontamination with suffix arrays of the training text.

Training documents are cut into shards. Each shard gets a suffix array over its words,
ordered to a bounded depth, and every suffix of every test item is searched in it by
bisection, all suffixes of a shard at once. The places found give the words of a document
that lie in a test passage, and the longest verbatim match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.llm.tables import narrowed, need
from footfall.llm.words import (
    ALPHANUMERIC,
    Block,
    Words,
    block_of,
    blocks,
    equal_ranges,
    find_words,
    numbered,
    replace_columns,
    word_hashes,
)

WINDOW = 10
TEST_BYTES = 8 << 20  # of test text that is searched for at once
LOT = 1 << 21  # matches that are held at once
MOST_TEST_BYTES = 128 << 20  # of all test text, which passes through the driver
SHARD_BYTES = (2 << 20) - 64

Test = list[tuple[str, bytes]]


def _symbols(ids: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Words' numbers, from 1, in one array with a 0 after each row; the place of each word."""
    text = np.zeros(len(ids) + n_rows, np.int64)
    at = np.arange(len(ids)) + rows
    text[at] = ids + 1
    return text, at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by their first ``depth`` symbols at least.

    Symbols are below 2**31; 0 ends a row, and what comes after it does not matter. Each
    round doubles the ordered length; only suffixes still tied are ordered again.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    bits = max(1, int(text.max()).bit_length())
    length = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(length):
        key <<= bits
        key[: max(0, n - k)] |= text[k:]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    first = np.ones(n, bool)
    ordered = key[order]
    first[1:] = ordered[1:] != ordered[:-1]
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while length < depth:
        tied = ~first
        tied[:-1] |= ~first[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        at = order[places]
        ahead = at + length
        next_rank = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        again = np.lexsort((next_rank, rank[at]))
        at, next_rank = at[again], next_rank[again]
        order[places] = at
        group = rank[at]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (next_rank[1:] != next_rank[:-1])
        first[places] = new
        rank[at] = np.maximum.accumulate(np.where(new, places, 0))
        length *= 2
    return order


def search(text: np.ndarray, order: np.ndarray, queries: np.ndarray, lengths: np.ndarray):
    """For each query row, the range of suffixes that begin with its first ``length`` symbols."""
    width = queries.shape[1]
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    steps = np.arange(width)
    inside = steps[None, :] < lengths[:, None]

    def bound(after_equal: bool) -> np.ndarray:
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(order), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            found = padded[order[middle][:, None] + steps]
            differ = (found != queries[open_]) & inside[open_]
            at = differ.argmax(axis=1)
            pick = np.arange(len(open_))
            equal = ~differ[pick, at]
            less = found[pick, at] < queries[open_][pick, at]
            go = np.where(equal, after_equal, less)
            low[open_[go]] = middle[go] + 1
            high[open_[~go]] = middle[~go]

    return bound(False), bound(True)


class _Tests:
    """Test items as words; windows are the suffixes to search for."""

    def __init__(self, items: Test, window: int) -> None:
        self.items = items
        self.block = block_of([text for _, text in items]).lower()
        self.words = find_words(self.block, ALPHANUMERIC)
        self.hashes = word_hashes(self.block, self.words)
        counts = np.diff(self.words.offsets)
        last = np.repeat(self.words.offsets[1:], counts)
        left = last - np.arange(len(last))  # words from here to the end of the item
        short = np.repeat(counts < window, counts)
        heads = np.zeros(len(last), bool)
        heads[self.words.offsets[:-1][counts > 0]] = True
        self.starts = np.flatnonzero((left >= window) | (short & heads))
        self.lengths = np.minimum(left[self.starts], window)
        self.left = left

    def numbers(self, block: Block, words: Words, first: np.ndarray, hashes: np.ndarray):
        """Each word's number among the words of ``block``; -1 where it is none of them.

        ``first`` is a place of each of the block's distinct words. Bytes decide.
        """
        order = np.argsort(hashes, kind="stable")
        out = np.full(len(self.hashes), -1)
        if not len(order):
            return out
        low = np.searchsorted(hashes[order], self.hashes, "left")
        high = np.searchsorted(hashes[order], self.hashes, "right")
        for k in range(int((high - low).max(initial=0))):  # words may share a hash
            at = np.flatnonzero((low + k < high) & (out < 0))
            number = order[low[at] + k]
            place = first[number]
            same = equal_ranges(
                self.block.data,
                self.words.starts[at],
                self.words.ends[at],
                block.data,
                words.starts[place],
                words.ends[place],
            )
            out[at[same]] = number[same]
        return out


Match = tuple[np.ndarray, np.ndarray, np.ndarray]


def _matches(block: Block, words: Words, tests: _Tests, window: int) -> Iterator[Match]:
    """(first word, number of the window, words in common from there on) of all places where
    a window of the tests occurs, in lots of bounded size.
    """
    ids, first, hashes = numbered(block.data, words.starts, words.ends)
    text, at = _symbols(ids, words.rows, len(block.offsets) - 1)
    order = suffix_array(text, window)
    known = tests.numbers(block, words, first, hashes) + 1
    padded = np.concatenate([known, np.zeros(window, np.int64)])
    queries = padded[tests.starts[:, None] + np.arange(window)]
    inside = np.arange(window)[None, :] < tests.lengths[:, None]
    possible = np.flatnonzero(((queries > 0) | ~inside).all(axis=1))
    low, high = search(text, order, queries[possible], tests.lengths[possible])
    possible, low, high = (x[low < high] for x in (possible, low, high))
    back = np.full(len(text), -1, np.int64)
    back[at] = np.arange(len(at))
    # Places in ``text`` do not follow each other from row to row.
    n = high - low
    items = tests.words.rows[tests.starts[possible]]
    cuts = np.flatnonzero(np.diff(items, prepend=-1))
    sizes = np.add.reduceat(n, cuts) if len(cuts) else cuts
    begin = 0
    while begin < len(cuts):
        end = begin + 1
        while end < len(cuts) and sizes[begin : end + 1].sum() <= LOT:
            end += 1
        own = slice(cuts[begin], cuts[end] if end < len(cuts) else len(n))
        if sizes[begin] > LOT:
            ranges = zip(possible[own], low[own], high[own], strict=True)
            for found, q, common in _one_by_one(list(ranges), order, tests):
                yield back[found], q, common
        else:
            which = np.repeat(np.arange(own.start, own.stop), n[own])
            inside = np.arange(len(which)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
            found, q = order[low[which] + inside], possible[which]
            yield back[found], q, _stretches(found, q, tests)
        begin = end


def _one_by_one(ranges: list, order: np.ndarray, tests: _Tests) -> Iterator[Match]:
    """Matches of an item whose windows occur very often, window by window from the last."""
    after, more, next_start = np.zeros(0, np.int64), np.zeros(0, np.int64), -1
    for q, low, high in reversed(ranges):
        found = np.sort(order[low:high])
        common = np.full(len(found), tests.lengths[q])
        if len(after) and tests.starts[q] + 1 == next_start:
            at = np.minimum(np.searchsorted(after, found + 1), len(after) - 1)
            common = np.where(after[at] == found + 1, more[at] + 1, common)
        after, more, next_start = found, common, tests.starts[q]
        yield found, np.full(len(found), q), common


def _stretches(first: np.ndarray, q: np.ndarray, tests: _Tests) -> np.ndarray:
    """Words in common from each match on: windows that follow each other in both texts.

    They lie on a diagonal. The last of a run ends where the texts differ, and each one
    before it has one word more.
    """
    start = tests.starts[q]
    order = np.lexsort((start, first - start))
    first, start = first[order], start[order]
    # Of two items that follow each other the second has windows of its own.
    follows = (np.diff(start) == 1) & (np.diff(first) == 1)
    follows &= np.diff(tests.words.rows[start]) == 0
    ends = np.flatnonzero(np.append(~follows, len(order) > 0))
    run = ends[np.searchsorted(ends, np.arange(len(order)))]
    out = np.empty(len(order), np.int64)
    out[order] = start[run] - start + tests.lengths[q][order][run]
    return out


def _scan(df: DataFrame, items: Test, window: int, text: str = "text") -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = _Tests(items, window)
        for block in blocks(batches, text, SHARD_BYTES):
            block = block.lower()
            words = find_words(block, ALPHANUMERIC)
            n = len(block.offsets) - 1
            found: list[set[str]] = [set() for _ in range(n)]
            longest = np.zeros(n, np.int64)
            hit = np.zeros(len(words.starts) + 1, np.int64)
            for first, q, common in _matches(block, words, tests, window):
                hit += np.bincount(first, minlength=len(hit))
                hit -= np.bincount(first + tests.lengths[q], minlength=len(hit))
                row, item = words.rows[first], tests.words.rows[tests.starts[q]]
                np.maximum.at(longest, row, common)
                for r, t in np.unique(np.stack([row, item]), axis=1).T.tolist():
                    found[r].add(items[t][0])
            covered = np.cumsum(hit)[:-1] > 0
            spans = [[] for _ in range(n)]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])))
            for a, b in edge.reshape(-1, 2):
                while a < b:  # a run of hit words may go on in the next document
                    row = words.rows[a]
                    end = min(b, words.offsets[row + 1])
                    spans[row].append((int(a - words.offsets[row]), int(end - words.offsets[row])))
                    a = end
            pairs = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            yield replace_columns(
                block.rows,
                [name for name in block.rows.schema.names if name != text],
                n_words=np.diff(words.offsets).astype(np.int64),
                longest_match=longest,
                items=pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                spans=pa.array(
                    [[{"first": a, "end": b} for a, b in x] for x in spans], pa.list_(pairs)
                ),
            )

    others = [f for f in df.schema if f.name != text]
    return df.mapInArrow(scan, StructType([*others, *StructType.fromDDL(FOUND)]))


FOUND = (
    "n_words long, longest_match long, items array<string>, "
    "spans array<struct<first: long, end: long>>"
)


def _test_blocks(tests: DataFrame, limit: int) -> list[Test]:
    """Test items in blocks of at most ``limit`` bytes, or of one longer item.

    They go along with the tasks, so more than ``MOST_TEST_BYTES`` in all stop the job.
    """
    size = tests.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    if size > MOST_TEST_BYTES:
        raise ValueError(f"{size} bytes of tests, {MOST_TEST_BYTES} at most: search them in parts")
    packed: list[Test] = [[]]
    size = 0
    for row in tests.toLocalIterator():
        text = (row.text or "").encode()
        if packed[-1] and size + len(text) > limit:
            packed.append([])
            size = 0
        packed[-1].append(("" if row.item_id is None else str(row.item_id), text))
        size += len(text)
    return packed


def find_contamination(
    df: DataFrame, tests: DataFrame, window: int = WINDOW, test_bytes: int = TEST_BYTES
) -> DataFrame:
    """Per row of ``df``: words, hit words, spans of hit words, test items, longest match.

    ``df`` has ``doc_id`` and ``text``, ``tests`` has ``item_id`` and ``text``. Words are
    lower-cased alphanumerics; a test passage is ``window`` words in a row of an item, or
    a whole shorter item. ``longest_match`` is the longest verbatim match in words.

    Tests of more than ``MOST_TEST_BYTES`` stop the job with a message.
    The documents are read once for every ``test_bytes`` of test text, without a shuffle
    if that is once. NULL texts have no words, a NULL ``item_id`` counts as an item named
    by empty text, repeated rows are searched one by one, other columns are ignored. With
    no tests nothing is hit; with no documents there are no rows.
    """
    docs = narrowed(df, doc_id="long", text="string")
    packed = _test_blocks(narrowed(tests, item_id="string", text="string"), test_bytes)
    if len(packed) == 1:
        found = _scan(docs, packed[0], window)
    else:
        found = _merged(docs, packed, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long")})


def _merged(docs: DataFrame, packed: list[Test], window: int) -> DataFrame:
    """Row-wise union of the finds of several blocks of tests, scanned one after the other."""
    spans, items, longest = F.array(), F.array(), F.lit(0).cast("long")
    for i, block in enumerate(packed):
        docs = _scan(docs.withColumn("_text", F.col("text")), block, window)
        names = {"spans": f"_spans{i}", "items": f"_items{i}", "longest_match": f"_longest{i}"}
        docs = docs.withColumnsRenamed(names).withColumnRenamed("_text", "text")
        docs = docs.withColumnRenamed("n_words", f"_n{i}")
        spans, items = F.concat(spans, F.col(f"_spans{i}")), F.concat(items, F.col(f"_items{i}"))
        longest = F.greatest(longest, F.col(f"_longest{i}"))

    def joined(runs, run):
        last = F.element_at(runs, -1)
        apart = (F.size(runs) == 0) | (F.try_element_at(runs, F.lit(-1))["end"] < run["first"])
        both = F.struct(
            last["first"].alias("first"), F.greatest(last["end"], run["end"]).alias("end")
        )
        head = F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when(apart, F.concat(runs, F.array(run))).otherwise(F.concat(head, F.array(both)))

    none = F.array().cast("array<struct<first: long, end: long>>")
    return docs.select(
        "doc_id",
        F.col("_n0").alias("n_words"),
        longest.alias("longest_match"),
        F.sort_array(F.array_distinct(items)).alias("items"),
        F.aggregate(F.sort_array(spans), none, joined).alias("spans"),
    )


def decontaminate(df: DataFrame, tests: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``df``, with all columns, that hold no test passage.

    NULL and empty texts stay. Repeated rows are searched one by one, columns may have any
    names, and no rows give none.
    """
    packed = _test_blocks(narrowed(tests, item_id="string", text="string"), TEST_BYTES)
    need(df, "text")
    rows = df.select(F.struct("*").alias("_row"))
    for block in packed:
        rows = _scan(rows, block, window, "_row.text").where(F.size("spans") == 0).select("_row")
    return rows.select("_row.*")
