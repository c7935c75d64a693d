"""License scans: winnowed fingerprints pick templates, banded alignment says what matches.

Fingerprints of all templates stand in an inverted index, and those of a text tell which
templates to align, and along which diagonals. A template with names (see ``licenses``) is
found only where the text has all of them word for word, and is aligned around them. What
several templates match goes to the best.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.licenses import NAMES, TEMPLATES
from footfall.llm.tables import narrowed
from footfall.llm.words import (
    ALPHANUMERIC,
    Block,
    Words,
    block_of,
    blocks,
    find_words,
    replace_columns,
    shingle_hashes,
    word_hashes,
)

TEMPLATE_BYTES = 4 << 20
GRAM = 3
WINNOW = 4  # grams of which one is looked up, or as many as the shortest template has
BAND = 16
LEAST_COVERAGE = 0.8
LEAST_DENSITY = 2 / 3  # of the words of a span that must be the template's


def winnow(hashes: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of every ``window`` grams in a row, the last of equals.

    Gram i of row r is ``hashes[offsets[r] + i]``. A row with fewer grams keeps its least.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    best, least = np.arange(n), hashes.copy()
    for k in range(1, window):
        other = np.arange(n - k) + k
        better = (rows[k:] == rows[: n - k]) & (hashes[k:] <= least[: n - k])
        best[: n - k][better] = other[better]
        least[: n - k][better] = hashes[k:][better]
    starts = np.arange(n)
    whole = starts + window <= offsets[1:][rows]
    whole |= starts == offsets[:-1][rows]
    return np.unique(best[whole])


def align(text: np.ndarray, template: np.ndarray, offset: int, band: int):
    """Most template words met in order near one diagonal, and the text words that meet them.

    Row i of the band holds template word i against text words ``i + offset - band`` to
    ``i + offset + band``. Returns (matched words, first and end of the text span).
    """
    met = _met(text, template, offset, band)
    return (len(met), met[0], met[-1] + 1) if met else (0, 0, 0)


def _met(text: np.ndarray, template: np.ndarray, offset: int, band: int) -> list[int]:
    """Places of the text words that meet template words; the last possible ones."""
    width = 2 * band + 1
    n = len(template)
    score = np.zeros(width + 1, np.int32)
    step = np.zeros((n + 1, width), np.int8)  # 1: match, 2: skip template, 3: skip text
    for i in range(n):
        low = i + offset - band
        a, b = min(max(-low, 0), width), max(min(len(text) - low, width), 0)
        match = np.full(width, -1, np.int32)
        if a < b:
            equal = text[low + a : low + b] == template[i]
            match[a:b] = np.where(equal, score[a:b] + 1, -1)
        skip = score[1:]  # the same text word stands one column to the right
        best = np.maximum(match, skip)
        run = np.maximum.accumulate(best)
        step[i + 1] = np.where(run > best, 3, np.where(match >= skip, 1, 2))
        step[i + 1][run == 0] = 0
        score = np.append(run, np.int32(0))
    j = width - 1
    i, met = n, []
    while i > 0 and j < width and step[i, j]:
        move = step[i, j]
        if move == 3:
            j -= 1
        elif move == 1:
            met.append(i - 1 + offset - band + j)
            i -= 1
        else:
            i, j = i - 1, j + 1
    return met[::-1]


def _most(text: np.ndarray, template: np.ndarray, offset: int, band: int) -> int:
    """Template words that stand anywhere in their place of the band: no alignment has more."""
    if not len(text) or not len(template):
        return 0
    known, ids = np.unique(text, return_inverse=True)
    keys = np.sort(ids * (len(text) + 1) + np.arange(len(text)))
    own = np.minimum(np.searchsorted(known, template), len(known) - 1)
    middle = np.arange(len(template)) + offset
    low = np.maximum(middle - band, 0)
    high = np.minimum(middle + band, len(text) - 1)
    at = np.searchsorted(keys, own * (len(text) + 1) + low)
    next_ = keys[np.minimum(at, len(keys) - 1)]
    inside = (at < len(keys)) & (next_ <= own * (len(text) + 1) + high) & (low <= high)
    return int(((known[own] == template) & inside).sum())


def _words(texts: list[str]) -> list[np.ndarray]:
    block = block_of([t.encode() for t in texts]).lower()
    words = find_words(block, ALPHANUMERIC)
    hashes = word_hashes(block, words)
    return [hashes[a:b] for a, b in zip(words.offsets, words.offsets[1:], strict=False)]


class _Index:
    """Fingerprints of the templates, sorted, with the template and place of each; their names."""

    def __init__(self, templates: Mapping[str, str], names: Mapping[str, tuple[str, ...]]) -> None:
        self.names = list(templates)
        self.words = _words(list(templates.values()))
        # Of each template the places of its names, and the names themselves.
        self.marks: list[list[tuple[int, np.ndarray]]] = []
        for t, name in enumerate(self.names):
            marks, after = [], 0
            for phrase in _words(list(names.get(name, ()))):
                places = _occurrences(self.words[t], phrase)
                place = int(places[places >= after][0])
                marks.append((place, phrase))
                after = place + len(phrase)
            self.marks.append(marks)
        prints, template, place = [], [], []
        for t, own in enumerate(self.words):
            grams, offsets = _grams(own, np.array([0, len(own)]))
            # A template keeps all its grams: what a text's winnowing picks is then found.
            prints.append(grams)
            template.append(np.full(len(grams), t))
            place.append(np.arange(len(grams)))
        self.window = min([WINNOW, *[len(p) for p in prints if len(p)]])
        prints = np.concatenate([np.zeros(0, np.uint64), *prints])
        order = np.argsort(prints)
        self.prints = prints[order]
        self.template = np.concatenate([np.zeros(0, int), *template])[order]
        self.place = np.concatenate([np.zeros(0, int), *place])[order]


def _occurrences(text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where ``phrase`` stands in ``text`` word for word."""
    n = len(text) - len(phrase) + 1
    places = np.flatnonzero(text[: max(n, 0)] == phrase[0])
    for k in range(1, len(phrase)):
        places = places[text[places + k] == phrase[k]]
    return places


def _goes_on(block: Block, words: Words) -> np.ndarray:
    """Whether each word continues a number: "1" in "2.1", but not "0" in "2.0"."""
    out = np.zeros(len(words.starts) + 1, bool)
    if len(words.starts) < 2:
        return out
    data, starts, ends = block.data, words.starts, words.ends
    digit = (data >= ord("0")) & (data <= ord("9"))
    near = (starts[1:] == ends[:-1] + 1) & (words.rows[1:] == words.rows[:-1])
    near &= (data[ends[:-1]] == ord(".")) & digit[ends[:-1] - 1] & digit[starts[1:]]
    out[1:-1] = near & (data[starts[1:]] != ord("0"))
    return out


def _grams(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``GRAM`` words in a row within each row, and their offsets."""
    counts = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    new = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(new[-1]) + np.repeat(offsets[:-1] - new[:-1], counts)
    return shingle_hashes(hashes, GRAM)[starts], new


def scan_licenses(
    df: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: float = LEAST_COVERAGE,
    band: int = BAND,
    names: Mapping[str, tuple[str, ...]] = NAMES,
) -> DataFrame:
    """``doc_id`` and ``licenses``: template, matched words, coverage and span of each find.

    A text's fingerprints are looked up in the inverted index of the templates. Those that
    share one are aligned along each diagonal band with a shared fingerprint; one with
    ``names``, phrases in its order, before, between and after these, where the text has all
    of them word for word and the first of them in such a band. A number that ends a name may
    not go on (version 2 is not 2.1). A band reaches ``band`` words, or as many as a find
    may lack, to either side. A find is an alignment that matches at least
    ``least`` of a template's words, which are ``LEAST_DENSITY`` of its span. Spans are words
    of the text, ``first`` to before ``end``. Overlapping finds of a template, and finds of
    several templates that have most words in common, keep the one with most matched less
    unmatched words of template and span, then the first. Templates of fewer than three words
    are not searched for; together they may have ``TEMPLATE_BYTES``.

    Works row by row without a shuffle. NULL and empty texts and texts without finds have
    an empty list; a NULL ``doc_id`` stays NULL, repeated rows are scanned one by one, other
    columns are ignored.
    """
    if sum(len(t.encode()) for t in templates.values()) > TEMPLATE_BYTES:
        raise ValueError(f"templates have more than {TEMPLATE_BYTES} bytes")
    templates = dict(templates)
    names = {name: phrases for name, phrases in names.items() if name in templates}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(templates, names)
        for block in blocks(batches):
            block = block.lower()
            words = find_words(block, ALPHANUMERIC)
            hashes = word_hashes(block, words)
            grams, offsets = _grams(hashes, words.offsets)
            picked = winnow(grams, offsets, index.window)
            low = np.searchsorted(index.prints, grams[picked], "left")
            high = np.searchsorted(index.prints, grams[picked], "right")
            seeds: dict[int, dict[int, set[int]]] = {}
            for gram, a, b in zip(
                picked[low < high], low[low < high], high[low < high], strict=True
            ):
                row = int(np.searchsorted(offsets, gram, "right")) - 1
                at = int(gram - offsets[row])
                for entry in range(a, b):
                    diagonal = at - int(index.place[entry])
                    found = seeds.setdefault(row, {})
                    found.setdefault(int(index.template[entry]), set()).add(diagonal)
            goes_on = _goes_on(block, words) if seeds else None
            out = [[] for _ in range(len(block.offsets) - 1)]
            for row, by_template in seeds.items():
                begin, end = words.offsets[row], words.offsets[row + 1]
                finds = _finds(
                    hashes[begin:end], goes_on[begin : end + 1], by_template, index, least, band
                )
                out[row] = finds
            yield replace_columns(block.rows, ["doc_id"], licenses=pa.array(out, kind))

    kind = pa.list_(
        pa.struct(
            [
                ("template", pa.string()),
                ("matched", pa.int64()),
                ("coverage", pa.float64()),
                ("first", pa.int64()),
                ("end", pa.int64()),
            ]
        )
    )
    return narrowed(df, doc_id="long", text="string").mapInArrow(
        scan,
        "doc_id long, licenses array<struct<template: string, matched: long, "
        "coverage: double, first: long, end: long>>",
    )


@dataclass(frozen=True)
class _Find:
    template: int
    met: list[int]  # text words, in order

    @property
    def span(self) -> tuple[int, int]:
        return self.met[0], self.met[-1] + 1

    def worth(self, index: _Index) -> int:
        """Matched words less those of the template and of the span that are not."""
        first, end = self.span
        return 3 * len(self.met) - len(index.words[self.template]) - (end - first)

    def meets(self, other: _Find) -> bool:
        """Whether two finds cannot both hold."""
        (a, b), (c, d) = self.span, other.span
        if b <= c or d <= a:
            return False
        if self.template == other.template:
            return True
        common = len(set(self.met) & set(other.met))
        return 2 * common > min(len(self.met), len(other.met))


def _named(
    text, goes_on, template, marks, diagonals: list[int], least: float, band: int
) -> Iterator[list[int]]:
    """Text words that meet a template, around every place where its names stand.

    The first name must lie within the band around one of the ``diagonals``, in order.
    """
    places = []
    for _, phrase in marks:
        found = _occurrences(text, phrase)
        places.append([int(p) for p in found if not goes_on[p + len(phrase)]])

    def seeded(place: int) -> bool:
        at = bisect_left(diagonals, place - marks[0][0] - band)
        return at < len(diagonals) and diagonals[at] <= place - marks[0][0] + band

    places[0] = [place for place in places[0] if seeded(place)]
    head, tail = template[: marks[0][0]], template[marks[-1][0] + len(marks[-1][1]) :]

    def chains(k: int, after: int) -> Iterator[list[int]]:
        if k == len(marks):
            yield []
            return
        low, high = 0, len(text)
        if k:
            gap = marks[k][0] - marks[k - 1][0] - len(marks[k - 1][1])
            low, high = after + max(0, gap - band), after + gap + band
        for place in places[k][bisect_left(places[k], low) : bisect_right(places[k], high)]:
            for rest in chains(k + 1, place + len(marks[k][1])):
                yield [place, *rest]

    for chain in chains(0, 0):
        start, end = chain[0], chain[-1] + len(marks[-1][1])
        low = max(0, start - len(head) - band)
        before, behind = text[low:start], text[end : end + len(tail) + band]
        missing = len(head) - _most(before, head, start - low - len(head), band)
        missing += len(tail) - _most(behind, tail, 0, band)
        if missing > (1 - least) * len(template) + 1e-9:
            continue
        met = [low + p for p in _met(before, head, start - low - len(head), band)]
        for k, (place, (at, phrase)) in enumerate(zip(chain, marks, strict=True)):
            if k:
                was, own = chain[k - 1] + len(marks[k - 1][1]), marks[k - 1]
                between = template[own[0] + len(own[1]) : at]
                met += [was + p for p in _met(text[was:place], between, 0, band)]
            met += range(place, place + len(phrase))
        # Read backwards, the words behind are met as near to the name as can be.
        back = _met(behind[::-1], tail[::-1], len(behind) - len(tail), band)
        met += [end + len(behind) - 1 - p for p in reversed(back)]
        yield met


def _finds(text, goes_on, by_template, index: _Index, least: float, band: int) -> list[dict]:
    finds = []
    for t in sorted(by_template):
        template = index.words[t]
        if len(text) < least * len(template):
            continue
        # As many words as may be missing can shift the others.
        wide = max(band, math.ceil((1 - least) * len(template)))
        if index.marks[t]:
            diagonals = sorted(by_template[t])
            found = list(_named(text, goes_on, template, index.marks[t], diagonals, least, wide))
        else:
            tried, found = None, []
            for diagonal in sorted(by_template[t]):
                if tried is not None and diagonal - tried <= wide // 2:
                    continue  # the band around the last one covers it
                tried = diagonal
                if _most(text, template, diagonal, wide) >= least * len(template):
                    found.append(_met(text, template, diagonal, wide))
        for met in found:
            dense = met and len(met) >= LEAST_DENSITY * (met[-1] + 1 - met[0])
            if dense and len(met) >= least * len(template):
                finds.append(_Find(t, met))
    finds.sort(key=lambda f: (-f.worth(index), f.span, f.template))
    last: list[_Find] = []
    near: dict[int, list[_Find]] = {}  # by stretches of 256 words
    for find in finds:
        stretches = range(find.span[0] >> 8, ((find.span[1] - 1) >> 8) + 1)
        if not any(find.meets(other) for k in stretches for other in near.get(k, ())):
            last.append(find)
            for k in stretches:
                near.setdefault(k, []).append(find)
    out = [
        {
            "template": index.names[f.template],
            "matched": len(f.met),
            "coverage": len(f.met) / len(index.words[f.template]),
            "first": int(f.span[0]),
            "end": int(f.span[1]),
        }
        for f in last
    ]
    return sorted(out, key=lambda x: (x["first"], x["template"]))
