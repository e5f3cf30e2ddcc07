"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut into chunks that no piece can span; the distinct chunks of a batch are grouped by length and every group
advances together, one end position at a time. Polynomial hashes of all substrings are looked up in the sorted hashes of
the pieces by binary search. For each end position the best predecessor is a vectorised maximum over piece lengths,
kept as a backpointer.

A unigram model takes the segmentation with the greatest sum of scores. In a byte-pair model the scores are merge
priorities and no sum of them gives its result, so there the lattice has only those steps from one piece to the next that
merging would leave apart: a step is allowed if undoing the two pieces' merges, latest first, meets no earlier merge
across their border. Exactly one path is left, and it is the result of merging.

Characters without a piece become byte pieces where the model has them, else the unknown piece. Decoding joins pieces
and bytes and turns the space mark back into spaces. Null text: null ids, and ``round_trip`` null. Empty text: no ids.
Repeated rows give repeated results; empty tables empty ones; further columns can be kept by name.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.llm.common import fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
PRIME = np.uint64(0x9E3779B97F4A7C15)
GROUP_CELLS = 2_000_000
NO_PIECE = -1
NEAR = 1024
SEEN_BITS = 20
MEMORY_BITS = 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialized message: numbers as int, everything else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class Pieces:
    """The vocabulary of a model file as sorted hash keys, with scores or merge ranks."""

    def __init__(self, data: bytes):
        self.text, self.score, self.kind, spec, norm = [], [], [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                self.text.append(p[1].decode())
                self.score.append(float(np.frombuffer(p[2], np.float32)[0]) if 2 in p else 0.0)
                self.kind.append(p.get(3, 1))
            elif field == 2:
                spec = dict(_fields(value))
            elif field == 3:
                norm = dict(_fields(value))
        self.merges = spec.get(3, 1) == 2
        self.prefix, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.normalizer = norm.get(1, b"").decode()
        kind = np.array(self.kind)
        self.unknown = int(np.flatnonzero(kind == 2)[0]) if (kind == 2).any() else 0
        self.bytes = {int(self.text[i][3:5], 16): int(i) for i in np.flatnonzero(kind == 6)}
        own = np.flatnonzero((kind == 1) | (kind == 4))
        self.length = np.array([len(t) for t in self.text])
        self.longest = int(self.length[own].max()) if len(own) else 1
        self.power = np.ones(self.longest + 1, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(self.longest):
                self.power[i + 1] = self.power[i] * PRIME
        self.hash = np.array([self.hash_of(t) for t in self.text], np.uint64)
        order = own[np.argsort(self.hash[own])]
        self.keys, self.ids = self.hash[order], order
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have the same hash")
        scores = np.array(self.score)
        self.best = scores
        several = {c for i in own if self.length[i] > 1 for c in self.text[i]}
        # two characters that stand next to each other in no piece are a sure border
        pairs = {(ord(x), ord(y)) for i in own for x, y in zip(self.text[i], self.text[i][1:])}
        self.near = np.zeros((NEAR, NEAR), bool)
        for x, y in pairs:
            if x < NEAR and y < NEAR:
                self.near[x, y] = True
        self.far = np.array(sorted(x << 21 | y for x, y in pairs), np.int64)
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.memory_key, self.memory_ok = np.full(1 << MEMORY_BITS, -1, np.int64), np.zeros(1 << MEMORY_BITS, bool)
        # bytes decode as themselves or, above 127, by way of escapes for single bytes
        self.plain = ["" if k not in (1, 4, 6) else t if k != 6 else (chr(b) if (b := int(t[3:5], 16)) < 128 else chr(0xDC00 + b))
                      for t, k in zip(self.text, self.kind)]
        if self.merges:
            # earlier merges have smaller ranks; single characters are there from the start
            self.rank = np.full(len(self.text) + 1, -1, np.int64)
            longer = own[self.length[own] > 1]
            self.rank[longer[np.argsort(-scores[longer], kind="stable")]] = np.arange(len(longer))
            self.left, self.right = np.full(len(self.text) + 1, -1), np.full(len(self.text) + 1, -1)
            self._splits(longer)
        self.seen[(self.keys >> np.uint64(64 - SEEN_BITS)).astype(np.int64)] = True

    def hash_of(self, text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(PRIME) + ord(c) + 1) & (2 ** 64 - 1)
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, or NO_PIECE."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.ids[at], NO_PIECE)

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece that two pieces would merge to. The last id stands for a character that has no piece."""
        out = np.full(len(a), NO_PIECE)
        fits = (a < len(self.text)) & (b < len(self.text))
        fits[fits] = self.length[a[fits]] + self.length[b[fits]] <= self.longest
        x, y = a[fits], b[fits]
        with np.errstate(over="ignore"):
            out[fits] = self.find(self.hash[x] * self.power[self.length[y]] + self.hash[y])
        return out

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between two pieces alone."""
        ok, open_, limit = np.ones(len(a), bool), np.arange(len(a)), np.full(len(a), 2 ** 60)
        a, b = a.copy(), b.copy()
        while len(open_):
            x, y = a[open_], b[open_]
            joined = self._joined(x, y)
            crossed = (joined >= 0) & (self.rank[joined] < limit[open_])
            ok[open_[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            ended = crossed | ((rx < 0) & (ry < 0))
            undo_x = ~ended & (rx > ry)
            undo_y = ~ended & ~undo_x
            limit[open_[undo_x]] = rx[undo_x]
            a[open_[undo_x]] = self.right[x[undo_x]]
            limit[open_[undo_y]] = ry[undo_y] + 1
            b[open_[undo_y]] = self.left[y[undo_y]]
            open_ = open_[~ended]
        return ok

    def _splits(self, longer: np.ndarray) -> None:
        """The last merge of every piece, shorter pieces first; pieces that merging never makes lose their rank."""
        for size in range(2, self.longest + 1):
            pieces = longer[self.length[longer] == size]
            best = np.full(len(pieces), 2 ** 60)
            for cut in range(1, size):
                a = self.find(np.array([self.hash_of(self.text[p][:cut]) for p in pieces], np.uint64))
                b = self.find(np.array([self.hash_of(self.text[p][cut:]) for p in pieces], np.uint64))
                made = (a >= 0) & (b >= 0)
                made[made] &= (self.rank[a[made]] < self.rank[pieces[made]]) & (self.rank[b[made]] < self.rank[pieces[made]])
                # until its own merge is in place, a piece must not count as a merge across the border
                ranks, self.rank[pieces] = self.rank[pieces].copy(), 2 ** 61
                made[made] = self._apart(a[made], b[made])
                self.rank[pieces] = ranks
                first = made & (best == 2 ** 60)
                best[first] = cut
                self.left[pieces[first]], self.right[pieces[first]] = a[first], b[first]
            lost = pieces[best == 2 ** 60]
            keep = ~np.isin(self.ids, lost)
            self.keys, self.ids = self.keys[keep], self.ids[keep]

    def allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_apart`` with a bounded memory of pairs."""
        key = a.astype(np.int64) * (len(self.text) + 1) + b
        at = ((key.view(np.uint64) * PRIME) >> np.uint64(64 - MEMORY_BITS)).astype(np.int64)
        known = self.memory_key[at] == key
        ok = self.memory_ok[at]
        if not known.all():
            new, where = np.unique(key[~known], return_inverse=True)
            fresh = self._apart(new // (len(self.text) + 1), new % (len(self.text) + 1))
            ok[~known] = fresh[where]
            self.memory_key[at[~known]], self.memory_ok[at[~known]] = key[~known], fresh[where]
        return ok

    def segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of one length, a row each: piece that ends at each position, and its length."""
        rows, size = points.shape
        none = len(self.text)  # a character without a piece
        hashes = np.zeros((rows, size), np.uint64)
        last = np.full((rows, size + 1), none)
        back = np.zeros((rows, size + 1), np.int32)
        total = np.full((rows, size + 1), -np.inf)
        total[:, 0] = 0
        scores = np.append(self.best, self.best.min(initial=0.0) - 10.0) if not self.merges else np.zeros(none + 1)
        for end in range(1, size + 1):
            low = max(0, end - self.longest)
            # from here on hashes[:, k] is of the substring from k to the end
            with np.errstate(over="ignore"):
                hashes[:, low:end] = hashes[:, low:end] * PRIME + points[:, end - 1, None]
            maybe = self.seen[(hashes[:, low:end] >> np.uint64(64 - SEEN_BITS)).astype(np.int64)]
            maybe[:, -1] = True
            row, start = np.nonzero(maybe)
            start += low
            ids = self.find(hashes[row, start])
            ids[(ids < 0) & (start == end - 1)] = none
            value = total[row, start] + scores[ids]
            ok = (ids >= 0) & np.isfinite(value)
            row, start, ids, value = row[ok], start[ok], ids[ok], value[ok]
            if self.merges:
                ok = start == 0
                ok[~ok] = self.allowed(last[row[~ok], start[~ok]], ids[~ok])
                row, start, ids, value = row[ok], start[ok], ids[ok], value[ok]
            best = np.full(rows, -np.inf)
            np.maximum.at(best, row, value)
            won = value == best[row]
            total[:, end] = best
            back[row[won], end], last[row[won], end] = end - start[won], ids[won]
        return last, back

    def cut(self, texts: list[str]) -> list[list[str]]:
        """Each text in chunks between sure borders."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.int32)
        ends = np.cumsum([len(t) for t in texts])
        x, y = points[:-1], points[1:]
        joined = np.zeros(len(points), bool)  # by the place of the first of two characters
        low = (x < NEAR) & (y < NEAR)
        joined[:-1] = self.near[np.where(low, x, 0), np.where(low, y, 0)] & low
        other = np.flatnonzero(~low)
        if len(self.far) and len(other):
            key = x[other].astype(np.int64) << 21 | y[other]
            joined[other] = self.far[np.minimum(np.searchsorted(self.far, key), len(self.far) - 1)] == key
        joined[ends[ends > 0] - 1] = False
        borders = np.flatnonzero(~joined) + 1
        out, at = [], 0
        places = np.searchsorted(borders, ends, "right")
        begin = 0
        for end, upto in zip(ends.tolist(), places.tolist()):
            own = borders[at:upto].tolist()
            out.append([whole[a:b] for a, b in zip([begin, *own[:-1]], own) if a < b])
            at, begin = upto, end
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(chunks)
        sizes = np.array([len(c) for c in chunks])
        for size in np.unique(sizes):
            same = np.flatnonzero(sizes == size)
            step = max(1, GROUP_CELLS // int(size))
            for lo in range(0, len(same), step):
                part = same[lo:lo + step]
                text = "".join(chunks[i] for i in part)
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), int(size)).astype(np.uint64) + np.uint64(1)
                last, back = self.segment(points)
                path, at, every = np.zeros(last.shape, bool), np.full(len(part), int(size)), np.arange(len(part))
                while at.any():
                    path[every, at] = True
                    at = at - back[every, at]
                path[:, 0] = False
                ids, ends = last[path].tolist(), np.cumsum(path.sum(axis=1)).tolist()
                strange = (path & (last == len(self.text))).any(axis=1)
                for r, (i, lo_, hi) in enumerate(zip(part.tolist(), [0, *ends[:-1]], ends)):
                    out[i] = ids[lo_:hi] if not strange[r] else [
                        x for end in np.flatnonzero(path[r]) for x in self._plain(int(last[r, end]), chunks[i][end - 1])]
        return out

    def _plain(self, piece: int, char: str) -> list[int]:
        if piece < len(self.text):
            return [piece]
        return [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def prepared(self, text: str) -> str:
        if self.normalizer not in ("identity", ""):
            raise ValueError(f"the model's normalizer {self.normalizer} is not supported")
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.plain.__getitem__, ids))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def opened(model: str) -> tuple[Pieces, dict[str, list[int]]]:
    """The pieces of a model file and the ids of chunks met so far: one of each for all tasks that a process runs, not one a task.

    They are held by a module of their own, as the functions of this one are made anew for each task.
    """
    held = sys.modules.setdefault("_plumbline_pieces", ModuleType("_plumbline_pieces")).__dict__
    found = os.stat(model)
    key = model, found.st_mtime_ns, found.st_size
    if held.get("key") != key:
        with open(model, "rb") as f:
            held.update(value=(Pieces(f.read()), {}), key=key)
    return held["value"]


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", keep: list[str] | None = None, memory: int = 300_000) -> DataFrame:
    """The kept columns, ids, n_ids and round_trip: whether decoding the ids gives the text back.

    Kept columns that have the name of a result are replaced by it.
    """
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in ("ids", "n_ids", "round_trip")]
    body = fresh(docs.columns, "_text")
    fields = [docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType()),
                                               T.StructField("round_trip", T.BooleanType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, known = opened(model)
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                part = batch.iloc[lo:lo + 1000]
                texts = pieces.cut([pieces.prepared(t or "") for t in part[body]])
                new = list(set().union(*texts).difference(known))
                if len(known) + len(new) > memory:
                    known.clear()
                    new = list(set().union(*texts))
                known.update(zip(new, pieces.encode_chunks(new)))
                ids = [None if t is None else list(chain.from_iterable(map(known.__getitem__, c))) for t, c in zip(part[body], texts)]
                same = [None if i is None else pieces.decode(i) == t for i, t in zip(ids, part[body])]
                out = {c: part[c] for c in keep}
                yield pd.DataFrame({**out, "ids": ids, "n_ids": [None if i is None else len(i) for i in ids], "round_trip": same}).astype({"n_ids": "Int64"})

    return docs.select(*keep, docs[text].alias(body)).mapInPandas(run, T.StructType(fields))
