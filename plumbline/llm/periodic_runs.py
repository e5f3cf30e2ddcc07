"""Periodic runs of words: every maximal stretch whose words repeat with some period, and the text without the repeats.

For each period ``p`` the places 0, p, 2p, ... of a text form a grid; a run of period ``p`` holds two neighbouring grid
places, so one pair of places a grid step finds it: n ln n pairs a text, most of which differ at once. How far a pair
agrees to the right and to the left comes from longest common extensions. Only suffixes at places of a difference
cover modulo 13 are sorted: any two places reach two sampled ones after at most 12 words, those are compared word by word,
and a sparse table over the common prefixes of neighbouring sampled suffixes answers the rest. Pairs found with a
multiple of the smallest period give the same stretch and go.

Texts are independent, so rows stay where they are (no shuffle); short texts share one numpy pass, a long one has its own,
and grid pairs are made in bounded blocks. Memory follows the longest single text.

Null or blank text: no words, no runs, empty collapsed text. Repeated rows give repeated results, ties do not arise (a stretch has
one smallest period), an empty table gives an empty result. Further columns are kept; one that has the name of a
result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: every difference modulo MODULUS is one of two members of COVER
MODULUS = 13
COVER = (0, 1, 3, 9)
BATCH_WORDS = 200_000
BLOCK_PAIRS = 2_000_000

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
_FIRST = np.array([next(a for a in COVER if (a + d) % MODULUS in COVER) for d in range(MODULUS)])

RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
_ARROW_RUN = [pa.field(x, pa.int64()) for x in ("start", "length", "period")]


def _ranked(order: np.ndarray, changed: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(changed)])
    return rank


class Extensions:
    """How many words two places have in common, from the suffixes sampled by the difference cover.

    ``words`` are ids in one array; every text in it ends with an id that occurs nowhere else.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words, np.zeros(MODULUS, words.dtype)])
        self.places = np.flatnonzero(_IN_COVER[np.arange(self.n) % MODULUS])
        self.index = np.full(self.n, -1, np.int64)
        self.index[self.places] = np.arange(len(self.places))
        levels = self._sorted()
        order = np.argsort(levels[-1], kind="stable")
        self.rank = levels[-1]
        self.table = self._minima(self._neighbours(order, levels))

    def _sorted(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 13, 26, 52, ... words, until all differ."""
        bits = int(self.words.max()).bit_length() + 1
        per = max(1, 62 // bits)
        keys = []
        for at in range(0, MODULUS, per):
            key = np.zeros(len(self.places), np.int64)
            for k in range(at, min(at + per, MODULUS)):
                key = key << bits | self.words[self.places + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        changed = np.zeros(len(order) - 1, bool)
        for key in keys:
            changed |= np.diff(key[order]) != 0
        levels, span = [_ranked(order, changed)], MODULUS
        while levels[-1].max(initial=0) < len(self.places) - 1:
            key = levels[-1] * (len(self.places) + 1) + self._rank_at(levels[-1], self.places + span) + 1
            order = np.argsort(key, kind="stable")
            levels.append(_ranked(order, np.diff(key[order]) != 0))
            span *= 2
        return levels

    def _rank_at(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = at < self.n
        return np.where(inside, level[self.index[np.where(inside, at, 0)]], -1)

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of suffixes that are neighbours in the sorted order."""
        a, b = self.places[order[:-1]].copy(), self.places[order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.maximum(a, b) < self.n
            same = inside & (self._rank_at(levels[k], a) == self._rank_at(levels[k], b))
            step = np.where(same, MODULUS << k, 0)
            a, b, common = a + step, b + step, common + step
        return common + self._direct(a, b, np.full(len(a), MODULUS))

    def _direct(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words in common, compared one by one, up to ``most``."""
        common = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for k in range(MODULUS):
            live = live[(k < most[live]) & (np.maximum(a[live], b[live]) + k < self.n)]
            live = live[self.words[a[live] + k] == self.words[b[live] + k]]
            if not len(live):
                break
            common[live] += 1
        return common

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values.astype(np.int32)], 1
        while 2 * width <= len(values):
            last = table[-1]
            table.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        return table

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b`` (a != b)."""
        shift = (_FIRST[(b - a) % MODULUS] - a) % MODULUS
        out = self._direct(a, b, shift)
        live = np.flatnonzero(out == shift)
        x, y = self.rank[self.index[a[live] + shift[live]]], self.rank[self.index[b[live] + shift[live]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        width = np.frexp(high - low)[1] - 1
        for k in np.unique(width):
            own = width == k
            minima = self.table[k]
            out[live[own]] += np.minimum(minima[low[own]], minima[high[own] - (1 << k)])
        return out


def _near(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Words in common from ``a`` and ``b`` on in one direction, up to 12; texts are fenced by ids of their own."""
    common = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(MODULUS - 1):
        live = live[words[a[live] + step * k] == words[b[live] + step * k]]
        if not len(live):
            break
        common[live] += 1
    return common


def _candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int):
    """Grid pairs whose agreement may reach a run: text, place, period, agreement right and left (12: may be longer)."""
    periods = sizes // 2
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    pairs = (sizes[text] - 1) // period
    ends = np.cumsum(pairs)
    at, found = 0, []
    while at < len(pairs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_PAIRS, side="right")))
        count, p, d = pairs[at:to], period[at:to], text[at:to]
        which = np.repeat(np.arange(to - at), count)
        place = starts[d][which] + (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)) * p[which]
        hit = words[place] == words[place + p[which]]
        place, p, d = place[hit], p[which[hit]], d[which[hit]]
        right = _near(words, place, place + p, 1)
        need, most = np.maximum(p, least - p), MODULUS - 1
        live = (right == most) | (right + np.minimum(p - 1, most) >= need) | (p > most)
        place, p, d, right, need = place[live], p[live], d[live], right[live], need[live]
        left = _near(words, place - 1, place + p - 1, -1)
        live = (right + left >= need) | (right == most) | (left == most)
        found.append((d[live], place[live], p[live], right[live], left[live]))
        at = to
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 5


def runs_of(ids: np.ndarray, sizes: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of texts given as word ids (one array, ``sizes`` words each): text, start, length and period, sorted by them.

    A run has at least ``max(least, 2 * period)`` words and cannot be extended with its period.
    """
    sizes = np.asarray(sizes, np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # a fence of its own before each text and after the last
    words = np.full(int(sizes.sum()) + len(sizes) + 1, -1, np.int64)
    inside = np.ones(len(words), bool)
    fences = np.append(starts - 1, len(words) - 1)
    inside[fences] = False
    words[inside] = ids
    base = int(ids.max(initial=-1)) + 1
    words[fences] = base + np.arange(len(fences))
    text, place, period, right, left = _candidates(words, starts, sizes, least)
    open_ = (right == MODULUS - 1) | (left == MODULUS - 1)
    if open_.any():
        texts = np.unique(text[open_])  # only these are sorted
        own = [words[starts[d]:starts[d] + sizes[d] + 1] for d in texts]
        joined = np.concatenate(own)
        joined = np.unique(joined, return_inverse=True)[1].astype(np.int64)
        offset = np.cumsum([len(x) for x in own]) - [len(x) for x in own]
        a = offset[np.searchsorted(texts, text[open_])] + place[open_] - starts[text[open_]]
        b = a + period[open_]
        right[open_] = Extensions(joined).common(a, b)
        # leftwards: the same on the reversed array, whose texts end with the fence before them
        first = base + len(fences)
        fence = np.concatenate([np.append(x[:-1][::-1], 0) for x in reversed(own)])
        ends = np.cumsum([len(x) for x in reversed(own)]) - 1
        fence = np.unique(fence, return_inverse=True)[1].astype(np.int64)
        fence[ends] = first + np.arange(len(ends))
        size = np.array([len(x) for x in own])
        back = (ends[::-1] - (size - 1))[np.searchsorted(texts, text[open_])]  # start of the reversed text
        words_left = place[open_] - starts[text[open_]]  # words before the place
        n_own = sizes[text[open_]]
        ra = back + n_own - words_left  # one word left of the place; at the first word: the fence
        rb = ra - period[open_]
        left[open_] = Extensions(fence).common(ra, rb)
    start, end = place - left, place + period + right
    good = (right + left >= period) & (end - start >= least)
    text, start, end, period = text[good], start[good], end[good], period[good]
    order = np.lexsort((period, end, start, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    text, start, end, period = text[new], start[new], end[new], period[new]
    order = np.lexsort((period, start, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    return text, start - starts[text], end - start, period


def _collapsed(words: list[list[bytes]], sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """Texts without the words that a run has after its first period."""
    offset = np.cumsum(sizes) - sizes
    marks = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(marks, offset[text] + start + period, 1)
    np.add.at(marks, offset[text] + start + length, -1)
    kept = np.cumsum(marks)[:-1] == 0
    hit = set(text.tolist())
    return [b" ".join([x for x, k in zip(w, kept[offset[d]:offset[d] + sizes[d]].tolist()) if k]) if d in hit else b" ".join(w) for d, w in enumerate(words)]


def _parts(texts: list[bytes | None]) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Consecutive rows, about BATCH_WORDS words at a time."""
    at, words, n = 0, [], 0
    for k, text in enumerate(texts):
        words.append((text or b"").split())  # bytes split at ASCII white space only
        n += len(words[-1])
        if n >= BATCH_WORDS:
            yield at, k + 1, words
            at, words, n = k + 1, [], 0
    if words:
        yield at, len(texts), words


def find_runs(docs: DataFrame, least: int = 12, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with all periodic runs of each text (array of start, length, period) and the text without the repeats."""
    kept = [f for f in docs.schema.fields if f.name not in (runs, collapsed)]
    schema = T.StructType([*kept, T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())])
    names = [f.name for f in kept]
    # the text travels under a name of its own: with ``collapsed`` named like it, the column is replaced
    body = "_" * (max(map(len, docs.columns)) + 1) + "text"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(body)).to_pylist()
            for at, to, words in _parts(own):
                sizes = np.array([len(w) for w in words], np.int64)
                coded = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
                d, start, length, period = runs_of(coded.indices.to_numpy().astype(np.int64), sizes, least)
                counts = np.bincount(d, minlength=len(words))
                found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=_ARROW_RUN)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), found)
                left = pa.array(_collapsed(words, sizes, d, start, length, period), pa.binary()).cast(pa.string())
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in names], lists, left], names=[*names, runs, collapsed])

    return docs.withColumn(body, docs[text].cast("binary")).select(*[docs[c] for c in names], body).mapInArrow(work, schema)
