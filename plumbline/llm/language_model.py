"""N-gram language model of any order in Elias-Fano tries, trained and queried by blocks.

Texts become blocks of packed word codes, written once; nothing larger than a block or a shard is ever held by a task
and no model is collected, so the model may grow with the corpus.

1. Each block sends its distinct words, with training counts, to the shard of the word's hash. The shard sums the
   counts and answers with the global count and id of every word; frequent words have small ids.
2. Level 2 of the trie: each block sends its distinct (context, word) pairs with training counts to the shard of the
   context; the pairs of a frequent context are spread over several shards by the word.
3. A shard merges the pairs of all blocks into its part of the level: contexts, monotone pointers, and
   successors, each an Elias-Fano sequence, and next to it the quantised probabilities, all in one memory-mapped file. A
   query finds its context, and then its word by a successor search inside the context's range. Answers are one byte
   and, for all but the last level, the pair's place in the level and its count.
4. Level k + 1 is the same with places of level k as contexts, so a context of any length is one whole number, and a
   frequent one is spread like a frequent word. An n-gram whose shorter form no training text holds is not asked for.
5. Each block sums up its texts: p(w | h) = c(h w) / (c(h) + mass) + mass / (c(h) + mass) * p(w | h without its first
   word), down to the add-one share of w. Histories begin with the end token before the text's first word.

Words are runs of bytes other than white space, with A-Z in lower case; every text has one end token. Null texts are empty:
one token. Null ids are kept. Repeated rows count as often as they stand there. An empty table gives an empty result;
without training rows every count is 0. Further columns are ignored.

The trie's file is a temporary file of one task, which reads it and lets it go: a lost executor costs that task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir

BLOCK_TOKENS = 1_500_000
WORDS_A_SHARD = 600_000
PAIRS_A_SHARD = 2_500_000
HOT_CONTEXT = 400_000
#: the engine's own limit; beyond it a bucket holds several blocks, which are still read one by one
MOST_BUCKETS = 100_000
END = b""
NO_ID = -(2 ** 63)
#: quantised probabilities: codes 1 to 255 are steps of the base 10 logarithm from 0 down; 0 is an unseen pair
STEP = 9 / 254
WORD, TOTAL = 1002, 1003
BLOCKS = "kind int, block bigint, shard int, a binary, b binary, c binary, d binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up: as many bytes each as the largest takes, byte by byte side by side, compressed."""
    import zstandard

    values = np.ascontiguousarray(values, np.int64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view(np.int64).ravel()


def _packed_rising(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=0))


def _unpacked_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw))


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place among them of each element; values from 0 up."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 63:
        return np.unique(key, return_inverse=True)
    # values are sorted together with their places, which is several times faster than sorting places by value
    both = np.sort((key << bits) | np.arange(len(key)))
    key, place = both >> bits, both & ((1 << bits) - 1)
    new = np.r_[True, key[1:] != key[:-1]]
    at = np.empty(len(key), np.int64)
    at[place] = np.cumsum(new) - 1
    return key[new], at


def _to_blocks(shards: int):
    """Kind 0: ids, lengths and codes of a block. Kind 1: its words of one shard, with training counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        import zstandard
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 24
        place, ids, sizes, codes, held = defaultdict(lambda: len(place), {END: 0}), [], [], [], 0

        def out() -> pd.DataFrame:
            nonlocal name, held
            code, train = np.concatenate(codes), np.array(sizes) & 1
            size = np.array(sizes) >> 1
            used = np.bincount(code, minlength=len(place))
            taught = np.bincount(code, weights=np.repeat(train, size), minlength=len(place)).astype(np.int64)
            by_use = np.argsort(-used, kind="stable")  # frequent words get small codes
            new = np.empty(len(by_use), np.int32)
            new[by_use] = np.arange(len(by_use))
            rows = [(0, name, -1, np.array(ids, np.int64).tobytes(), _packed(np.array(sizes)), _packed(new[code]), b"")]
            words = list(place)
            shard = np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in words), np.int64, len(words))
            order = np.argsort(shard, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                text = zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[i] for i in part.tolist()))
                rows.append((1, name, int(shard[part[0]]), text, _packed(taught[part]), _packed(new[part]), b""))
            name += 1
            place.clear()
            place[END] = 0
            ids.clear(), sizes.clear(), codes.clear()
            held = 0
            return pd.DataFrame(rows, columns=["kind", "block", "shard", "a", "b", "c", "d"])

        for batch in batches:
            for doc_id, text, train in zip(batch["id"].tolist(), batch["text"], batch["train"].tolist()):
                words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                words.append(END)
                codes.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id)
                sizes.append(len(words) * 2 + int(train))
                held += len(words)
                if held >= BLOCK_TOKENS:
                    yield out()
        if held:
            yield out()

    return run


def _count_words(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        words = [zstandard.ZstdDecompressor().decompress(bytes(x)).split(b"\n") for x in pdf["a"]]
        place: dict[bytes, int] = {}
        for own in words:
            for w in own:
                if w not in place:
                    place[w] = len(place)
        at = [np.fromiter(map(place.__getitem__, own), np.int64, len(own)) for own in words]
        counts = np.zeros(len(place), np.int64)
        for where, taught in zip(at, pdf["b"]):
            counts[where] += _unpacked(taught)  # a block names a word once
        rank = np.empty(len(place), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(place))
        shard = int(pdf["shard"].iloc[0])
        rows = [(WORD, int(block), shard, bytes(codes), _packed(counts[where]), _packed(rank[where] * shards + shard), b"")
                for block, codes, where in zip(pdf["block"], pdf["c"], at)]
        total = np.array([counts.sum(), (counts > 0).sum()], np.int64).tobytes()
        return pd.DataFrame([*rows, (TOTAL, -1, shard, total, b"", b"", b"")], columns=["kind", "block", "shard", "a", "b", "c", "d"])

    return run


class _Level:
    """The distinct n-grams of one level in a block, dealt to shards, and which of them each token ends."""

    def __init__(self, key: np.ndarray, asked: np.ndarray, weight: np.ndarray, words: np.ndarray, ids: np.ndarray, counts: np.ndarray, shards: int):
        """``key``: context and word of the tokens ``asked``, both numbered by id; ``ids`` and ``counts`` are those of the contexts."""
        n = max(len(words), 1)
        grams, self.at = _distinct(key)
        self.asked, self.contexts = asked, grams // n
        self.taught = np.bincount(self.at, weights=weight, minlength=len(grams)).astype(np.int64)
        self.context, self.word, self.count = ids[self.contexts], words[grams % n], counts[self.contexts]
        with np.errstate(over="ignore"):
            spread = (1 + self.count // HOT_CONTEXT).astype(np.uint64)
            to = (_mix(self.context) % np.uint64(shards)).astype(np.int64) + (_mix(self.word + 1) % spread).astype(np.int64)
        self.shard = to % shards
        # n-grams are in order of context and word already
        self.order = np.argsort(self.shard.astype(np.min_scalar_type(shards)), kind="stable")
        self.codes, self.found, self.place = np.zeros(len(grams), np.uint8), np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)

    def parts(self) -> list[np.ndarray]:
        """N-grams of each shard, by context and word."""
        if not len(self.order):
            return []
        return np.split(self.order, np.flatnonzero(np.diff(self.shard[self.order])) + 1)

    def take(self, answers: pd.DataFrame):
        given = {int(s): (a, b, c) for s, a, b, c in zip(answers["shard"], answers["a"], answers["b"], answers["c"])}
        for part in self.parts():
            codes, found, place = given[int(self.shard[part[0]])]
            self.codes[part] = _unpacked(codes)
            if len(found):
                hit = part[self.codes[part] > 0]
                self.found[hit], self.place[hit] = _unpacked(found), _unpacked_rising(place)

    def of_tokens(self, values: np.ndarray, tokens: int, default: int) -> np.ndarray:
        out = np.full(tokens, default, values.dtype)
        out[self.asked] = values[self.at]
        return out


class _Block:
    """A block with the answers to its words and to the levels of the trie below ``level``."""

    def __init__(self, answers: pd.DataFrame, shards: list[int], level: int):
        own = answers[answers["kind"] == 0].iloc[0]
        self.ids, sizes = np.frombuffer(own["a"], np.int64), _unpacked(own["b"])
        self.size, self.train = sizes >> 1, (sizes & 1).astype(bool)
        self.codes = _unpacked(own["c"])
        names = answers[answers["kind"] == WORD]
        at = [_unpacked(x) for x in names["a"]]
        self.count, self.word = np.zeros(sum(map(len, at)), np.int64), np.zeros(sum(map(len, at)), np.int64)
        for where, counts, ids in zip(at, names["b"], names["c"]):
            self.count[where], self.word[where] = _unpacked(counts), _unpacked(ids)
        by_id = np.argsort(self.word)
        rank = np.empty_like(by_id)
        rank[by_id] = np.arange(len(by_id))
        self.codes, self.count, self.word = rank[self.codes], self.count[by_id], self.word[by_id]
        ends = np.cumsum(self.size)
        self.first = ends - self.size
        self.before = np.empty_like(self.codes)
        self.before[1:] = self.codes[:-1]
        self.before[self.first] = self.codes[ends - 1]  # the end token
        weight = np.repeat(self.train, self.size)
        n = len(self.count)
        asked = np.flatnonzero((self.count[self.before] > 0) & (self.count[self.codes] > 0))
        self.levels = [_Level(self.before[asked] * n + self.codes[asked], asked, weight[asked], self.word, self.word, self.count, shards[0])]
        for k in range(3, level + 1):
            last = self.levels[-1]
            last.take(answers[answers["kind"] == k - 1])
            # a token's context is the n-gram that the token before it ends; both it and the token's own must be in the trie
            hit = np.flatnonzero(last.codes)
            hit = hit[np.argsort(last.place[hit])]
            rank = np.full(len(last.codes), -1)
            rank[hit] = np.arange(len(hit))
            held = last.of_tokens(rank, len(self.codes), -1)
            context = np.r_[-1, held[:-1]]
            context[self.first] = -1
            asked = np.flatnonzero((context >= 0) & (held >= 0))
            self.levels.append(_Level(context[asked] * n + self.codes[asked], asked, weight[asked], self.word, last.place[hit], last.found[hit], shards[k - 2]))


def _ask(shards: list[int], level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        grams, out = _Block(rows, shards, level).levels[-1], []
        for part in grams.parts():
            v = grams.context[part]
            first = np.flatnonzero(np.diff(v, prepend=-1) != 0)
            heads = np.r_[np.diff(np.r_[first, len(part)]), grams.count[part][first]]
            out.append((level, int(key[0]), int(grams.shard[part[0]]), _packed_rising(v[first]), _packed(grams.word[part]), _packed(grams.taught[part]),
                        _packed(heads)))
        return pd.DataFrame(out, columns=["kind", "block", "shard", "a", "b", "c", "d"])

    return run


#: place of the k-th zero bit of each byte
ZERO_IN_BYTE = np.argsort((np.arange(256)[:, None] >> np.arange(8)) & 1, axis=1, kind="stable")


class EliasFano:
    """A sorted sequence of whole numbers: low bits packed side by side, high bits in unary; both may be memory-mapped."""

    def __init__(self, values: np.ndarray, mapped):
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        self.n, self.bits = n, min(56, max(0, int(np.floor(np.log2(max(top / max(n, 1), 1))))))
        low = values & ((1 << self.bits) - 1)
        if self.bits:
            packed = np.zeros((n * self.bits + 7) // 8 + 8, np.uint8)
            for lo in range(0, n, 1 << 18):  # whole bytes a part, as 2^18 is a multiple of 8
                part = low[lo:lo + (1 << 18)]
                bits = ((part[:, None] >> np.arange(self.bits)) & 1).astype(np.uint8)
                raw = np.packbits(bits.ravel(), bitorder="little")
                packed[lo * self.bits // 8:lo * self.bits // 8 + len(raw)] = raw
            packed = mapped(packed)
            self.low = np.ndarray((len(packed) - 7,), "<u8", buffer=packed, strides=(1,))  # eight bytes from any byte on
        high = values >> self.bits
        # a one for each value, a zero after each high part; zeros are counted up to every 64th place
        unary = np.zeros(-(-(int(high[-1]) + n + 1 if n else 1) // 64) * 64, np.uint8)
        unary[high + np.arange(n)] = 1
        self.high = mapped(np.packbits(unary, bitorder="little")).reshape(-1, 8)
        zeros = 64 - unary.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        self.before = mapped(np.cumsum(zeros) - zeros)
        self.buckets = int(high[-1]) + 1 if n else 0

    def lows(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.int64)
        bit = at * self.bits
        return ((self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def zero(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th zeros of the unary code: word, byte and bit by counts of zeros."""
        out = np.empty(len(k), np.int64)
        for lo in range(0, len(k), 1 << 17):
            part = k[lo:lo + (1 << 17)]
            word = np.searchsorted(self.before, part, "right") - 1
            left = part - self.before[word]
            raw = self.high[word]
            passed = np.cumsum(8 - np.bitwise_count(raw), axis=1, dtype=np.uint8)
            byte = (passed > left[:, None]).argmax(axis=1)
            at = np.arange(len(part))
            left -= np.where(byte > 0, passed[at, byte - 1], 0)
            out[lo:lo + (1 << 17)] = word * 64 + byte * 8 + ZERO_IN_BYTE[raw[at, byte], left]
        return out

    def run(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index and end of the values with this high part."""
        inside = high < self.buckets
        h = np.where(inside, high, 0)
        lo = np.where(h > 0, self.zero(np.maximum(h - 1, 0)) - (h - 1), 0)
        return np.where(inside, lo, 0), np.where(inside, self.zero(h) - h, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1: the successor inside the run of its high part, by binary search in the low bits."""
        if not self.n:
            return np.full(len(values), -1)
        lo, end = self.run(values >> self.bits)
        want, hi = values & ((1 << self.bits) - 1), end.copy()
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            less = (lo < hi) & (self.lows(np.minimum(mid, self.n - 1)) < want)
            lo, hi = np.where(less, mid + 1, lo), np.where((lo < hi) & ~less, mid, hi)
        found = lo < end
        found[found] = self.lows(lo[found]) == want[found]
        return np.where(found, lo, -1)


class Trie:
    """Contexts and their successors with quantised probabilities, in one memory-mapped file that goes with it."""

    def __init__(self, v: np.ndarray, w: np.ndarray, n: np.ndarray, total: np.ndarray, mass: float):
        """Distinct pairs sorted by (v, w), their counts, and the counts of the contexts."""
        self.file = tempfile.TemporaryFile()
        first = np.flatnonzero(np.r_[True, np.diff(v) != 0]) if len(v) else np.zeros(0, np.int64)
        self.contexts = EliasFano(v[first], self._mapped)
        self.pointers = self._mapped(np.r_[first, len(v)].astype(np.int32 if len(v) < 2 ** 31 else np.int64))
        self.width = int(w.max()) + 1 if len(w) else 1
        # a successor's value is relative to its context: the contexts' ranges follow each other
        rank = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(v)]))
        self.successors = EliasFano(rank * self.width + w, self._mapped)
        self.codes = self._mapped(1 + np.minimum(254, np.round(-np.log10(n / (total + mass)) / STEP)).astype(np.uint8))

    def _mapped(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return values
        self.file.seek(0, 2)
        start = -(-self.file.tell() // 16) * 16
        self.file.seek(start)
        self.file.write(values.tobytes())
        self.file.flush()
        return np.memmap(self.file, values.dtype, "r", start, values.shape)

    def find(self, v: np.ndarray, sizes: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Places of words under contexts, or -1; ``v`` has each context once, ``sizes`` how many words follow."""
        at = np.repeat(self.contexts.find(v), sizes)
        out = np.full(len(w), -1)
        ok = np.flatnonzero((at >= 0) & (w < self.width))
        found = self.successors.find(at[ok] * self.width + w[ok])
        ok, found = ok[found >= 0], found[found >= 0]
        # the successor search stays between the context's pointers
        inside = (found >= self.pointers[at[ok]]) & (found < self.pointers[at[ok] + 1])
        out[ok[inside]] = found[inside]
        return out

    def ask(self, v: np.ndarray, sizes: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Codes for words under contexts; 0 where the trie has none."""
        place = self.find(v, sizes, w)
        out = np.zeros(len(place), np.uint8)
        out[place >= 0] = self.codes[place[place >= 0]]
        return out


def _answer(mass: float, shards: int, last: bool):
    """Merges a shard's n-grams of all blocks into a trie and asks it once for each distinct one."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = [_unpacked_rising(x) for x in pdf["a"]]
        heads = [_unpacked(x).reshape(2, -1) for x in pdf["d"]]
        sizes = np.concatenate([h[0] for h in heads])
        contexts, rank = _distinct(np.concatenate(ids))
        total = np.zeros(len(contexts), np.int64)
        total[rank] = np.concatenate([h[1] for h in heads])
        words = [_unpacked(x) for x in pdf["b"]]
        w = np.concatenate(words)
        width = int(w.max()) + 1
        grams, at = _distinct(np.repeat(rank, sizes) * width + w)
        n = np.bincount(at, weights=np.concatenate([_unpacked(x) for x in pdf["c"]]), minlength=len(grams)).astype(np.int64)
        rank, w = grams // width, grams % width
        use = n > 0
        trie = Trie(contexts[rank[use]], w[use], n[use], total[rank[use]], mass)
        place = trie.find(contexts, np.bincount(rank, minlength=len(contexts)), w)
        codes = np.zeros(len(grams), np.uint8)
        codes[place >= 0] = trie.codes[place[place >= 0]]
        trie.file.close()
        shard, rows = int(pdf["shard"].iloc[0]), []
        for kind, block, own in zip(pdf["kind"], pdf["block"], np.split(at, np.cumsum([len(x) for x in words])[:-1])):
            hit = own[place[own] >= 0]
            rows.append((int(kind), int(block), shard, _packed(codes[own]), b"" if last else _packed(n[hit]),
                         b"" if last else _packed_rising(place[hit] * shards + shard), b""))
        return pd.DataFrame(rows, columns=["kind", "block", "shard", "a", "b", "c", "d"])

    return run


def _sum_up(shards: list[int], order: int, mass: float, n_train: int, n_words: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = _Block(rows, shards, order)
        block.levels[-1].take(rows[rows["kind"] == order])
        share = (block.count + 1.0) / (n_train + n_words + 1.0)
        seen = np.r_[0.0, 10.0 ** (-np.arange(255) * STEP)]
        p = share[block.codes]
        context = block.count[block.before]
        for grams in block.levels:
            p = np.where(context > 0, grams.of_tokens(seen[grams.codes], len(p), 0) + mass / (context + mass) * p, p)
            # the next level's context is the n-gram of this level that the token before ends
            context = np.r_[0, grams.of_tokens(grams.found, len(p), 0)[:-1]]
            context[block.first] = 0
        total = np.add.reduceat(np.log10(np.minimum(p, 1.0)), block.first)
        base = np.add.reduceat(np.log10(share)[block.codes], block.first)
        known = np.add.reduceat((block.count[block.codes] > 0).astype(np.int64), block.first)
        return pd.DataFrame({"id": block.ids, "trained": block.train, "n_tokens": block.size, "n_known": known, "train_tokens": n_train,
                             "base_score": base, "score": total})

    return run


class _State:
    """Blocks and the answers to them, in one table below the checkpoint folder, bucketed by block.

    Texts are never shuffled and answers once, however many levels read them; the questions are shuffled and not written,
    so a lost executor costs the blocks it asked for.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.name = spark, buckets, f"model_state_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark)}/{self.name}"

    def add(self, df: DataFrame) -> None:
        (df.write.mode("append").format("parquet").option("path", self.path).option("compression", "zstd")
         .partitionBy("kind").bucketBy(self.buckets, "block").saveAsTable(self.name))

    def rows(self, which: Column) -> DataFrame:
        return self.spark.table(self.name).filter(which)


def score(docs: DataFrame, train, order: int = 3, mass: float = 20.0) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score, score; ``train`` is a boolean column of ``docs``.

    ``order`` is the length of the longest n-grams, 2 or more.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text", train.alias("train"))
    # the number of shards follows the size of the input; texts hold a new word every few dozen bytes at most
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    word_shards = int(max(4, size // 40 // WORDS_A_SHARD))
    # longer n-grams repeat less, so their levels have more shards
    shards = [int(max(4, size // (8 if k == 2 else 5) // PAIRS_A_SHARD)) for k in range(2, order + 1)]
    buckets = int(min(MOST_BUCKETS, max(8, size // 6 // BLOCK_TOKENS)))
    state = _State(docs.sparkSession, buckets)
    state.add(rows.mapInPandas(_to_blocks(word_shards), BLOCKS))
    asked = state.rows(F.col("kind") == 1).repartition(word_shards, "shard")
    state.add(asked.groupBy("shard").applyInPandas(_count_words(word_shards), BLOCKS).repartition(buckets, "block"))
    totals = np.sum([np.frombuffer(r["a"], np.int64) for r in state.rows(F.col("kind") == TOTAL).select("a").collect()] or [[0, 0]], axis=0)
    mine = ~F.col("kind").isin(1, TOTAL)
    for level, parts in enumerate(shards, 2):
        asked = state.rows(mine).groupBy("block").applyInPandas(_ask(shards, level), BLOCKS).repartition(parts, "shard")
        state.add(asked.groupBy("shard").applyInPandas(_answer(mass, parts, level == order), BLOCKS).repartition(buckets, "block"))
    out = state.rows(mine).groupBy("block").applyInPandas(
        _sum_up(shards, order, mass, int(totals[0]), int(totals[1])),
        "id bigint, trained boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score")
