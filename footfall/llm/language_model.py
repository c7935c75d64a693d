"""Hashed maximum-entropy language model with a class-factored softmax.

The chance of a token is that of its class times that of the token in its class. The most
frequent tokens fill classes of fixed size, in the order of their counts; all others lie in
classes by their endings. Classes, and the members of the first kind, are chosen by softmax
over sums of weights that the words before pick by hash: the last word, the last two (n-gram
features), and the one before the last alone (a skip feature). Members of the other classes go
by how often each followed the word before, with absolute discounting; what that leaves goes by
their counts plus one. The model knows V + 1 tokens as the base does, but has one unknown
token for each ending.

Tokens are numbered within shards of text, which are written down; counts of words, and of words
after words, meet in shuffles and go back to the shards that asked, so they grow with the text.
Weights are of fixed size: every round, tasks
descend from the same weights over their part of all training text and return what they
changed, and the changes are averaged.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import batches_of, kept, narrowed
from footfall.llm.words import SPACED, block_of, blocks, find_words, mix, numbered, word_hashes

END = " "  # no word holds a space
SHARD_BYTES = 8 << 20
BATCH_BYTES = "16m"  # of shards that a task has on its way to or from Python
LISTED, MEMBERS, ENDINGS = 16, 32, 16  # classes of frequent tokens, their size, other classes
CLASSES = LISTED + ENDINGS
ROWS = 4096  # hashed rows of weights per feature of the class
MEMBER_ROWS = 8192
CLASS_FEATURES, MEMBER_FEATURES = 3, 2
ROUNDS = 4
BATCH = 1 << 15
STEP = 0.1
PART = 1 << 14  # weights that are summed up together
WORD_BITS = 24  # of a pair's key that are of the word, the others of what it follows
PAIR_SHARDS = 2  # shards whose pairs a bucket of pairs is as large as
_END_HASH = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)


# --- shards ----------------------------------------------------------------------------

SHARD = (
    "shard long, doc_ids array<long>, learn array<boolean>, offsets array<int>, "
    "ids binary, hashes binary, endings array<tinyint>, words array<binary>, counts array<int>"
)


class _Shard:
    """Numbers the tokens of some blocks of text."""

    def __init__(self) -> None:
        self.doc_ids, self.learn, self.sizes = [], [], []
        self.ids, self.hashes, self.endings, self.words = [], [], [], []
        self.n_words = self.bytes = 0

    def add(self, block) -> None:
        block = block.lower()
        found = find_words(block, SPACED)
        counts = np.diff(found.offsets)
        ids, first, hashes = numbered(block.data, found.starts, found.ends)
        starts, ends = found.starts[first], found.ends[first]
        raw = block.data.tobytes()
        self.words += [END.encode()]
        self.words += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        last = block.data[ends - 1].astype(np.uint64)
        before = block.data[np.maximum(ends - 2, starts)].astype(np.uint64)
        ending = (mix(last * np.uint64(257) + before) % np.uint64(ENDINGS)).astype(np.uint8)
        # The end of a text is a token; it has the first number of its block.
        n = len(counts)
        tokens = np.zeros(len(ids) + n, np.int32)
        tokens[np.arange(len(ids)) + found.rows] = ids + 1
        self.ids.append(tokens + np.int32(self.n_words))
        self.hashes.append(np.concatenate([[_END_HASH], hashes]))
        self.endings.append(np.concatenate([[0], ending]).astype(np.int8))
        self.n_words += len(hashes) + 1
        self.doc_ids += block.rows.column("doc_id").to_pylist()
        self.learn += block.rows.column("learn").to_pylist()
        self.sizes.append(counts + 1)
        self.bytes += len(block.data)

    def row(self, shard: int) -> pa.RecordBatch:
        hashes = np.concatenate(self.hashes)
        _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        named = map(self.words.__getitem__, first[number].tolist())
        if not all(map(operator.eq, self.words, named)):
            # Words that share a hash are told apart by their bytes.
            numbers: dict[bytes, int] = {}
            number = np.array([numbers.setdefault(w, len(numbers)) for w in self.words])
            first = np.unique(number, return_index=True)[1]
        hashes = hashes[first]
        ids = number.astype(np.int32)[np.concatenate(self.ids)]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))])
        learned = np.repeat(np.array(self.learn, bool), np.diff(offsets))
        counts = np.bincount(ids[learned], minlength=len(hashes))
        # Frequent tokens get small numbers, which pack better.
        order = np.argsort(-np.bincount(ids, minlength=len(hashes)), kind="stable")
        new = np.empty(len(order), np.int32)
        new[order] = np.arange(len(order))
        pack = zstandard.ZstdCompressor(level=1).compress
        values = {
            "shard": pa.array([shard], pa.int64()),
            "doc_ids": pa.array([self.doc_ids], pa.list_(pa.int64())),
            "learn": pa.array([self.learn], pa.list_(pa.bool_())),
            "offsets": pa.array([offsets], pa.list_(pa.int32())),
            "ids": pa.array([pack(_planes(new[ids]))], pa.binary()),
            "hashes": pa.array([_brief(hashes)[order].tobytes()], pa.binary()),
            "endings": pa.array([np.concatenate(self.endings)[first][order]], pa.list_(pa.int8())),
            "words": pa.array([[self.words[i] for i in first[order]]], pa.list_(pa.binary())),
            "counts": pa.array([counts[order]], pa.list_(pa.int32())),
        }
        return pa.RecordBatch.from_pydict(values)


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which pack better."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


def _brief(hashes: np.ndarray) -> np.ndarray:
    """Half of a word's hash: enough to pick weights, and to know one of a few listed words."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def shards(df: DataFrame) -> DataFrame:
    """Texts with ``learn`` as numbered tokens, a row per ``SHARD_BYTES`` or longer text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        open_ = _Shard()
        for block in blocks(batches):
            open_.add(block)
            if open_.bytes >= SHARD_BYTES:
                yield open_.row(number)
                open_, number = _Shard(), number + 1
        if open_.doc_ids:
            yield open_.row(number)

    rows = narrowed(df, doc_id="long", text="string", learn="boolean")
    rows = rows.withColumn("learn", F.coalesce("learn", F.lit(False)))
    return kept(rows.mapInArrow(run, SHARD), "zstd")


def _tokens(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """Token numbers, offsets of texts, hashes and endings of row i."""
    raw = zstandard.ZstdDecompressor().decompress(batch.column("ids")[i].as_py())
    return (
        _from_planes(raw, np.int32),
        batch.column("offsets")[i].values.to_numpy(),
        np.frombuffer(batch.column("hashes")[i].as_py(), np.uint32).astype(np.uint64),
        batch.column("endings")[i].values.to_numpy(),
    )


# --- counts ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Token counts in sum, the listed tokens, and the weights."""

    n_tokens: int
    n_distinct: int
    listed: np.ndarray  # hashes of listed tokens, sorted
    rank: np.ndarray  # of each
    class_bias: np.ndarray
    member_bias: np.ndarray
    rest: np.ndarray  # log10 of the count that a class by ending is divided by
    weights: np.ndarray


def _vocabulary(table: DataFrame) -> DataFrame:
    """``shard``, ``word``, ``place`` and ``n`` (of training) of each shard's words.

    ``place`` is the word's number in the shard and its ending.
    """
    listed = F.posexplode(F.arrays_zip("words", "counts", "endings"))
    return table.select("shard", listed.alias("at", "x")).select(
        "shard",
        (F.col("at").cast("long") * ENDINGS + F.col("x.endings")).alias("place"),
        F.col("x.words").alias("word"),
        F.col("x.counts").cast("long").alias("n"),
    )


def totals(table: DataFrame) -> DataFrame:
    """``shard``, ``place``, ``n``, ``total``, ``word`` where they tell something.

    ``total`` counts a word over all shards. A row stands for each word of a shard that
    does not know it, having ``n`` of it alone; and one for each word at all, with the
    ``word``. A word has a row per shard, which meet where its sum is.
    """
    rows = _vocabulary(table).repartition("word")
    own = F.struct("shard", "place")
    sums = rows.groupBy("word").agg(F.sum("n").alias("total"), F.min(own).alias("first"))
    once = F.when(own == F.col("first"), F.col("word"))
    found = rows.join(sums, "word").select("shard", "place", "n", "total", once.alias("word"))
    return found.where("total <> n OR word IS NOT NULL")


def untrained(table: DataFrame, found: DataFrame) -> Model:
    """The model with zero weights: only sums and a list of fixed length reach the driver."""
    ending = (F.col("place") % ENDINGS).cast("int").alias("ending")
    known = found.where("word IS NOT NULL AND total > 0")
    known = known.select("word", F.col("total").alias("n"), ending)
    n_tokens, n_distinct = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    end = known.where(F.col("word") == END.encode()).collect()
    top = known.where(F.col("word") != END.encode()).orderBy(F.desc("n"), "word")
    top = [*end, *top.limit(LISTED * MEMBERS - 1).collect()]
    top.sort(key=lambda r: (-r.n, bytes(r.word)))
    hashes = np.array([_hash(bytes(r.word)) for r in top], np.uint64)
    counts = np.zeros(LISTED * MEMBERS)
    counts[: len(top)] = [r.n for r in top]
    listed_words = table.sparkSession.createDataFrame(
        [(bytes(r.word),) for r in top], "word binary"
    )
    rest = known.join(F.broadcast(listed_words), "word", "left_anti")
    per_ending = {
        r.ending: (r.n, r.distinct)
        for r in rest.groupBy("ending")
        .agg(F.sum("n").alias("n"), F.count("*").alias("distinct"))
        .collect()
    }
    by_ending = np.array([per_ending.get(e, (0, 0)) for e in range(ENDINGS)], float)
    in_class = np.concatenate([counts.reshape(LISTED, MEMBERS).sum(axis=1), by_ending[:, 0]])
    order = np.argsort(hashes)
    member_bias = np.log(counts.reshape(LISTED, MEMBERS) + 1e-6)
    size = CLASS_FEATURES * ROWS * CLASSES + MEMBER_FEATURES * MEMBER_ROWS * MEMBERS
    return Model(
        n_tokens,
        n_distinct,
        hashes[order],
        order.astype(np.int64),
        _normal(np.log(in_class + 1.0)[None])[0],
        _normal(member_bias),
        np.log10(by_ending.sum(axis=1) + 1),
        np.zeros(size, np.float32),
    )


def _hash(word: bytes) -> int:
    if word == END.encode():
        return int(_brief(np.array([_END_HASH]))[0])
    block = block_of([word])
    return int(_brief(word_hashes(block, find_words(block, SPACED)))[0])


def _normal(logs: np.ndarray) -> np.ndarray:
    """Logarithms of odds as those of chances, row by row."""
    return (logs - np.log(np.exp(logs).sum(axis=1, keepdims=True))).astype(np.float32)


# --- the softmaxes ---------------------------------------------------------------------


class _Net:
    """The model's weights as tables, and what a shard's tokens pick of them."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.weights = model.weights.copy()
        split = CLASS_FEATURES * ROWS * CLASSES
        self.of_class = self.weights[:split].reshape(CLASS_FEATURES, ROWS, CLASSES)
        self.of_member = self.weights[split:].reshape(MEMBER_FEATURES, MEMBER_ROWS, MEMBERS)

    def targets(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and member of each word of a vocabulary; the member is -1 by ending."""
        listed, rank = self.model.listed, self.model.rank
        group, member = LISTED + endings.astype(np.int64), np.full(len(hashes), -1)
        if len(listed):
            at = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
            hit = listed[at] == hashes
            group = np.where(hit, rank[at] // MEMBERS, group)
            member = np.where(hit, rank[at] % MEMBERS, member)
        return group, member

    @staticmethod
    def contexts(ids: np.ndarray, first: np.ndarray, hashes: np.ndarray, at: np.ndarray):
        """Hashes of the word before each of the tokens ``at``, and of the one before that.

        ``first`` marks the first token of each text.
        """
        last, before = np.maximum(at - 1, 0), np.maximum(at - 2, 0)
        begins = first[at]
        one = np.where(begins, _START, hashes[ids[last]])
        two = np.where(begins | first[last], _START, hashes[ids[before]])
        return one, two

    @staticmethod
    def class_rows(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
        both = mix(one + two * np.uint64(0xD6E8FEB86659FD93))
        return [
            (mix(x) % np.uint64(ROWS)).astype(np.int64)
            for x in (one, both, two + np.uint64(0x2545F4914F6CDD1D))
        ]

    @staticmethod
    def member_rows(one, two, group) -> list[np.ndarray]:
        shift = (group + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return [
            (mix(x ^ shift) % np.uint64(MEMBER_ROWS)).astype(np.int64)
            for x in (one, two + np.uint64(0x2545F4914F6CDD1D))
        ]

    def class_scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return _added(self.of_class, rows, self.model.class_bias)

    def member_scores(self, rows: list[np.ndarray], group: np.ndarray) -> np.ndarray:
        return _added(self.of_member, rows, self.model.member_bias[group])


def _firsts(offsets: np.ndarray) -> np.ndarray:
    first = np.zeros(offsets[-1], bool)
    first[offsets[:-1]] = True
    return first


def _added(tables: np.ndarray, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    out = np.take(tables[0], rows[0], axis=0)
    for table, row in zip(tables[1:], rows[1:], strict=True):
        out += np.take(table, row, axis=0)
    out += bias
    # Biases are logarithms of chances, so only runaway weights come near this.
    return np.minimum(out, 80, out=out)


# Sums along short rows go by matrix products, which are far faster than reductions.
_ONES = np.ones(CLASSES, np.float32)
_UP_TO = np.triu(np.ones((CLASSES, CLASSES), np.float32))


def _log_chance(scores: np.ndarray, target: np.ndarray) -> np.ndarray:
    picked = scores[np.arange(len(target)), target].astype(np.float64)
    return picked - np.log((np.exp(scores) @ _ONES).astype(np.float64))


def _descend(tables, squares, rows, scores, target, random) -> None:
    """One step of gradient descent; a drawn outcome stands for the expected one."""
    odds = np.exp(scores, out=scores) @ _UP_TO
    limit = random.random(len(target), dtype=np.float32) * odds[:, -1]
    width = scores.shape[1]
    drawn = ((odds < limit[:, None]).astype(np.float32) @ _ONES).astype(np.int64)
    drawn = np.minimum(drawn, width - 1)
    scale = 1.0 / math.sqrt(len(target))
    for table, square, row in zip(tables, squares, rows, strict=True):
        flat = row * width
        size = table.size
        gradient = np.bincount(flat + drawn, minlength=size)
        gradient -= np.bincount(flat + target, minlength=size)
        at = np.flatnonzero(gradient)
        change = gradient[at] * np.float32(scale)
        flat_square = square.reshape(-1)
        flat_square[at] += change * change
        table.reshape(-1)[at] -= STEP * change / np.sqrt(flat_square[at] + 1e-6)


# --- training --------------------------------------------------------------------------


def _changes(part: DataFrame, model: Model, seed: int) -> DataFrame:
    """What each task changes of the weights over its shards: ``part``, ``tokens``, ``change``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = _Net(model)
        squares = [np.zeros_like(net.of_class), np.zeros_like(net.of_member)]
        random = np.random.default_rng([seed, TaskContext.get().partitionId()])
        tokens = 0
        for batch in batches:
            for i in range(batch.num_rows):
                ids, offsets, hashes, endings = _tokens(batch, i)
                learn = batch.column("learn")[i].values.to_numpy(zero_copy_only=False)
                used = np.flatnonzero(np.repeat(learn, np.diff(offsets)))
                first = _firsts(offsets)
                group, member = net.targets(hashes, endings)
                for at in range(0, len(used), BATCH):
                    own = used[at : at + BATCH]
                    a, b = net.contexts(ids, first, hashes, own)
                    target, inner = group[ids[own]], member[ids[own]]
                    rows = net.class_rows(a, b)
                    _descend(net.of_class, squares[0], rows, net.class_scores(rows), target, random)
                    has = inner >= 0
                    if has.any():
                        rows = net.member_rows(a[has], b[has], target[has])
                        scores = net.member_scores(rows, target[has])
                        _descend(net.of_member, squares[1], rows, scores, inner[has], random)
                tokens += len(used)
        if tokens:
            change = (net.weights - model.weights).astype(np.float16)
            pieces = [change[k : k + PART].tobytes() for k in range(0, len(change), PART)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(range(len(pieces)), pa.int32()),
                    "tokens": pa.array([tokens] * len(pieces), pa.int64()),
                    "change": pa.array(pieces, pa.binary()),
                }
            )

    columns = ["learn", "offsets", "ids", "hashes", "endings"]
    return part.select(*columns).mapInArrow(run, "part int, tokens long, change binary")


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of changes by part, weighted by tokens; holds one row per part."""
    total: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for part, tokens, change in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            sum_, before = total.get(part, (0, 0.0))
            values = np.frombuffer(change, np.float16).astype(np.float64)
            total[part] = (sum_ + tokens, before + tokens * values)
    for part, (tokens, values) in total.items():
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "change": pa.array([(values / tokens).astype(np.float32).tobytes()], pa.binary()),
            }
        )


def train(table: DataFrame, model: Model, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """Descends once over all training text, in ``rounds`` parts with averaging after each."""
    for turn in range(rounds):
        part = table.where(F.pmod(F.xxhash64("shard"), F.lit(rounds)) == turn)
        changes = _changes(part, model, seed + turn).repartition("part")
        weights = model.weights.copy()
        for row in changes.mapInArrow(_averaged, "part int, change binary").collect():
            change = np.frombuffer(row.change, np.float32)
            weights[row.part * PART : row.part * PART + len(change)] += change
        model = replace(model, weights=weights)
    return model


# --- words after words -----------------------------------------------------------------


def _pair_keys(net: _Net, ids, first, hashes, group, member) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that are not listed, and for each a key of the word before, its class and itself.

    The upper bits are hashed of the word before and the class, the lower ones of the word.
    """
    own = np.flatnonzero(member[ids] < 0)
    one, _ = net.contexts(ids, first, hashes, own)
    of_group = mix((np.arange(CLASSES) + 1).astype(np.uint64))
    context = mix(one ^ of_group[group[ids[own]]]) >> np.uint64(WORD_BITS)
    word = mix(hashes) >> np.uint64(64 - WORD_BITS)
    return own, context << np.uint64(WORD_BITS) | word[ids[own]]


def _settled(keys: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """For each shard's keys the count of each; the count and the kinds of words of each context.

    All pairs of a context are given, so are the pairs of all shards. Contexts are in the
    order of their keys. The last array has the discount, that of Ney, Essen and Kneser from
    the pairs seen once and twice.
    """
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)
    once, twice = (n == 1).sum(), (n == 2).sum()
    discount = min(max((once + 1) / (once + 2 * twice + 2), 0.1), 0.99)
    begins, context = _contexts(distinct)
    total = np.add.reduceat(n, begins)
    kinds = np.add.reduceat((n > 0).astype(np.int64), begins)
    low = 0
    for own in keys:
        place = at[low : low + len(own)]
        low += len(own)
        asked = context[place[_contexts(own)[0]]]
        yield [n[place], total[asked], kinds[asked], np.array([discount])]


def _contexts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each context begins in sorted keys, and the number of that of each key."""
    heads = keys >> np.uint64(WORD_BITS)
    new = np.concatenate([[True], heads[1:] != heads[:-1]])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _discounted(keys: np.ndarray, settled: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each key the chance from its own count, and the share its context leaves to others."""
    n, total, kinds, (discount,) = settled
    context = _contexts(keys)[1]
    of_all = np.maximum(total, 1)[context]
    left = np.where(total[context] > 0, discount * kinds[context] / of_all, 1)
    return np.maximum(n - discount, 0) / of_all, left


def followers(table: DataFrame, model: Model) -> DataFrame:
    """``shard``, ``bucket`` and counts of the pairs of a shard over all training text.

    They are for each distinct key of the shard in the bucket, in the order of the keys, and
    for each context of those (see ``_settled``). Buckets are ranges of keys and keep
    contexts whole; there are as many as the number of shards asks for, and a task holds one.
    """
    buckets = table.count() // PAIR_SHARDS + 1
    spread = np.uint64(64 - WORD_BITS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = _Net(model)
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for i in range(batch.num_rows):
                ids, offsets, hashes, endings = _tokens(batch, i)
                learn = batch.column("learn")[i].values.to_numpy(zero_copy_only=False)
                learned = np.repeat(learn, np.diff(offsets))
                targets = net.targets(hashes, endings)
                own, keys = _pair_keys(net, ids, _firsts(offsets), hashes, *targets)
                if not len(keys):
                    continue
                keys, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, learned[own], len(keys)).astype(np.int32)
                place = (keys >> np.uint64(WORD_BITS)) * np.uint64(buckets) >> spread
                bucket, begins = np.unique(place, return_index=True)
                ends = np.append(begins[1:], len(keys))
                data = [
                    (
                        pack(_planes(np.diff(keys[a:b], prepend=np.uint64(0)))),
                        pack(_planes(n[a:b])),
                    )
                    for a, b in zip(begins.tolist(), ends.tolist(), strict=True)
                ]
                shard = batch.column("shard")[i].as_py()
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard] * len(data), pa.int64()),
                        "bucket": pa.array(bucket.astype(np.int64)),
                        "keys": pa.array([k for k, _ in data], pa.binary()),
                        "counts": pa.array([c for _, c in data], pa.binary()),
                    }
                )

    def settle(bucket: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor().decompress
        keys = [np.cumsum(_from_planes(unpack(k), np.uint64)) for _, k, _ in rows]
        counts = [_from_planes(unpack(c), np.int32) for _, _, c in rows]
        pack = zstandard.ZstdCompressor(level=1).compress
        settled = [[pack(_planes(a)) for a in arrays] for arrays in _settled(keys, counts)]
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard for shard, _, _ in rows], pa.int64()),
                "bucket": pa.array([bucket] * len(rows), pa.int64()),
                "known": pa.array(settled, pa.list_(pa.binary())),
            }
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for shard, bucket, keys, counts in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                if rows and bucket != current:
                    yield settle(current, rows)
                    rows = []
                current = bucket
                rows.append((shard, keys, counts))
        if rows:
            yield settle(current, rows)

    sent = table.select("shard", "learn", "offsets", "ids", "hashes", "endings").mapInArrow(
        send, "shard long, bucket long, keys binary, counts binary"
    )
    met = sent.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(meet, "shard long, bucket long, known array<binary>")


# --- scoring ---------------------------------------------------------------------------


def _followed(net: _Net, ids, first, hashes, targets, known) -> tuple[np.ndarray, np.ndarray]:
    """Per token what its pair is worth, and the share left to its class; 0 and 1 if listed."""
    seen, left = np.zeros(len(ids), np.float32), np.ones(len(ids), np.float32)
    own, keys = _pair_keys(net, ids, first, hashes, *targets)
    if len(own):
        keys, at = np.unique(keys, return_inverse=True)
        unpack = zstandard.ZstdDecompressor().decompress
        low, worth = 0, []
        for packed in known:  # by bucket, which are ranges of keys
            raw = [unpack(x) for x in packed]
            settled = [_from_planes(x, np.int64) for x in raw[:3]] + [_from_planes(raw[3], float)]
            high = low + len(settled[0])
            worth.append(np.stack(_discounted(keys[low:high], settled)))
            low = high
        seen[own], left[own] = np.concatenate(worth, axis=1)[:, at]
    return seen, left


def _score_shard(net: _Net, batch: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    model = net.model
    ids, offsets, hashes, endings = _tokens(batch, i)
    counts = batch.column("counts")[i].values.to_numpy().astype(np.int64)
    shared = batch.column("shared")[i]
    if shared.is_valid and len(shared.values):
        # Words of other shards too: their counts over all.
        fields = shared.values
        counts[fields.field("at").to_numpy()] = fields.field("n").to_numpy()
    group, member = targets = net.targets(hashes, endings)
    base = np.log10((counts + 1) / (model.n_tokens + model.n_distinct + 1))
    rest = np.log10(counts + 1) - model.rest[np.maximum(group - LISTED, 0)]
    first = _firsts(offsets)
    known = batch.column("known")[i].as_py() or []
    seen, left = _followed(net, ids, first, hashes, targets, [x["known"] for x in known])
    found = np.empty(len(ids))
    for at in range(0, len(ids), BATCH):
        own = np.arange(at, min(at + BATCH, len(ids)))
        one, two = net.contexts(ids, first, hashes, own)
        target, inner = group[ids[own]], member[ids[own]]
        chance = _log_chance(net.class_scores(net.class_rows(one, two)), target)
        chance /= math.log(10)
        has = inner >= 0
        rare = own[~has]
        chance[~has] += np.log10(seen[rare] + left[rare] * 10.0 ** rest[ids[rare]])
        if has.any():
            picked = net.member_rows(one[has], two[has], target[has])
            within = _log_chance(net.member_scores(picked, target[has]), inner[has])
            chance[has] += within / math.log(10)
        found[own] = chance
    starts = offsets[:-1]  # every text has a token
    return {
        "n_tokens": np.diff(offsets).astype(np.int64),
        "n_known": np.add.reduceat((counts > 0)[ids], starts, dtype=np.int64),
        "base_score": np.add.reduceat(base[ids], starts),
        "score": np.add.reduceat(found, starts),
    }


def score(table: DataFrame, found: DataFrame, after: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = _Net(model)
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids = batch.column("doc_ids")[i].values
                scored = _score_shard(net, batch, i)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": doc_ids,
                        **{k: pa.array(v) for k, v in scored.items()},
                        "train_tokens": pa.array([model.n_tokens] * len(doc_ids), pa.int64()),
                    }
                )

    at = F.floor(F.col("place") / ENDINGS).cast("int").alias("at")
    back = found.where("total <> n").groupBy("shard")
    back = back.agg(F.collect_list(F.struct(at, F.col("total").alias("n"))).alias("shared"))
    columns = ["shard", "doc_ids", "offsets", "ids", "hashes", "endings", "counts"]
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "known")))
    after = after.groupBy("shard").agg(pairs.alias("known"))
    rows = table.select(*columns).join(back, "shard", "left").join(after, "shard", "left")
    rows = rows.drop("shard")
    return rows.mapInArrow(
        run,
        "doc_id long, n_tokens long, n_known long, base_score double, score double, "
        "train_tokens long",
    )


def score_texts(df: DataFrame, rounds: int = ROUNDS, seed: int = 5) -> DataFrame:
    """Scores all rows of ``df`` (``doc_id``, ``text``, ``learn``), learning from some.

    ``score`` is the log10 probability that the model gives to a text, its end included;
    ``base_score`` is that of counts plus one. A text's tokens are its words, A to Z
    lower-cased, and one end. NULL and empty texts are an end alone; a NULL ``learn`` means no;
    a NULL ``doc_id`` stays NULL, repeated rows count and score one by one, other columns are
    ignored. Without training text all tokens are unknown; no rows give none.
    """
    with batches_of(df.sparkSession, BATCH_BYTES):
        table = shards(df)
        found = kept(totals(table), "zstd")
        model = untrained(table, found)
        after = followers(table, model)
        return kept(score(table, found, after, train(table, model, rounds, seed)))
