"""Approximate nearest neighbours by inner product: multi-index hashing over learned binary codes.

Vectors are brought to the unit sphere (a component is added that fills each up to the largest norm, so that the angle to a
query orders like the inner product), rotated by learned rotations (principal axes, then alternating sign and Procrustes
steps) and cut to signs: a code of ``BITS`` bits. The code is split into substrings of 16 bits and every substring is an index of
its own. A query takes all codes within its Hamming radius ``r``: by the pigeonhole principle one substring then differs in at
most ``r // m`` bits, so only buckets that close are read; each code is met once, at its first such substring. What lies in
the radius is ranked by the original vectors in double precision.

The radius of a query comes from the fitting sample: its ``k``-th best sampled score is one that the true neighbours reach or
beat, the codes' distances at that angle are known from the sample, and the radius covers ``COVERED`` of them, and at least
``k`` sampled rows, so each query finds ``k`` rows (all, if there are fewer).

Only the fit is bounded: rotations and radii come from at most ``SAMPLE_ROWS`` rows (about; and at most SAMPLE_BYTES), chosen by
hash. Every row is indexed. Buckets are laid out in parts of PART_ROWS postings by their counts (a table of at most 65,536 a substring, whatever
the input); a bucket larger than a part is divided over several by the hash of the row, and queries go to all of them. In a task one part is
held at a time and queries stream past it. Of equal vectors only the ``k + 1`` with the smallest ids can be among the results,
so the others are left out before the search; that changes no result.

Null ids, null or empty vectors, zero vectors, null or non-finite components, and vectors whose length differs from the most frequent one (the
smaller of two) take no part. Ties go to the smaller id. Equal rows count once; two rows with one id and different vectors are two
candidates and two queries, whose results carry the same ``query_id``. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.llm.common import save

BITS = 128
WIDTH = 16
PARTS = BITS // WIDTH
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64_000_000
CALIBRATION_QUERIES = 500
COVERED = 0.98
PART_ROWS = 50_000
QUERY_BLOCK = 200
ROUNDS = 25

_BITS_OF = np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint32)).astype(np.uint8)
_MASKS = np.argsort(_BITS_OF, kind="stable").astype(np.uint32)
#: how many masks have at most so many bits
_MASKS_TO = np.cumsum(np.bincount(_BITS_OF, minlength=WIDTH + 1))


@dataclass
class Model:
    """Rotations and the sample that gives queries their radius."""

    centre: np.ndarray
    rotation: np.ndarray
    largest: float
    ids: np.ndarray
    vectors: np.ndarray
    slope: float
    base: float
    rows: int
    k: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Rows of 16-bit substrings for index rows."""
        return self._cut(_lifted(vectors, self.largest))

    def query_codes(self, vectors: np.ndarray) -> np.ndarray:
        return self._cut(_unit(vectors))

    def _cut(self, lifted: np.ndarray) -> np.ndarray:
        return np.packbits((lifted - self.centre) @ self.rotation > 0, axis=1, bitorder="little").view("<u2")

    def radii(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The Hamming radius that each query searches."""
        if len(self.ids) <= self.k:
            return np.full(len(ids), BITS)
        scores = vectors @ self.vectors.T
        own = ids[:, None] == self.ids[None]
        scores[own] = -np.inf
        least = np.partition(scores, -self.k, axis=1)[:, -self.k]
        distance = _distances(codes, self.codes(self.vectors)).astype(np.int64)
        distance[own] = BITS + 1
        found = np.partition(distance, self.k - 1, axis=1)[:, self.k - 1]
        radius = np.ceil(self.base + self.slope * _angle(least, vectors, self.largest))
        return np.where(np.isfinite(least), np.clip(np.maximum(radius, found), 0, BITS), BITS).astype(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Queries on the sphere, with a zero where index rows have their filling."""
    return np.hstack([vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True)), np.zeros((len(vectors), 1))])


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    scaled = vectors / largest
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1, keepdims=True)))])


def _angle(scores: np.ndarray, vectors: np.ndarray, largest: float) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(1)).reshape((-1,) + (1,) * (scores.ndim - 1))
    return np.arccos(np.clip(scores / (largest * norm), -1, 1))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all rows of ``a`` to all of ``b`` (a block of queries against the bounded sample)."""
    out = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(a.view("<u8").T, b.view("<u8").T):
        out += np.bitwise_count(x[:, None] ^ y[None])
    return out


def _rotations(lifted: np.ndarray) -> np.ndarray:
    """Columns of as many learned rotations as fill the code."""
    random = np.random.default_rng(7)
    axes = np.linalg.svd(lifted.T @ lifted)[0]
    columns, todo = [], BITS
    while todo:
        width = min(todo, lifted.shape[1])
        flat = lifted @ axes[:, :width]
        turn = np.linalg.qr(random.normal(size=(width, width)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        columns.append(axes[:, :width] @ turn)
        todo -= width
    return np.hstack(columns)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(embedding: Column) -> Column:
    """Vectors that take part, whatever their length."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def fit(rows: DataFrame, k: int = 20) -> Model | None:
    """Rotations and radii from a bounded sample of ``rows`` (vec_id, embedding); None without rows."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, largest, size = rows.agg(F.count("*"), F.max(norm), F.max(F.size("embedding"))).first()
    if not n:
        return None
    wanted = max(k + 1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    draw = F.pmod(F.xxhash64("vec_id", "embedding", F.lit(3)), F.lit(1 << 40))
    drawn = rows if n <= wanted else rows.filter(draw < int((1 << 40) * wanted / n))
    sample = drawn.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).toArrow().sort_by("vec_id")
    ids = sample["vec_id"].to_numpy()
    vectors = _matrix(sample["embedding"].combine_chunks(), size)
    lifted = _lifted(vectors, largest)
    centre = lifted.mean(0)
    model = Model(centre, _rotations(lifted - centre), largest, ids, vectors, 0.0, float(BITS), n, k)
    if len(ids) <= k:
        return model
    # distances of codes against angles, over the best of some sampled rows
    pick = np.random.default_rng(11).permutation(len(ids))[:CALIBRATION_QUERIES]
    scores = vectors[pick] @ vectors.T
    scores[ids[pick][:, None] == ids[None]] = -np.inf
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    distance = np.take_along_axis(_distances(model.query_codes(vectors[pick]), model.codes(vectors)), best, 1).astype(float).ravel()
    angle = _angle(np.take_along_axis(scores, best, 1), vectors[pick], largest).ravel()
    good = np.isfinite(angle)
    slope = np.polyfit(angle[good], distance[good], 1)[0] if np.ptp(angle[good]) > 1e-6 else BITS / np.pi
    model.slope = float(max(slope, 0))
    model.base = float(np.quantile(distance[good] - model.slope * angle[good], COVERED))
    return model


def _substrings(codes: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), "<u2").reshape(-1, PARTS)


def _layout(counts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Where the buckets of each substring lie: sorted bucket keys, first part, last part, and where each substring starts."""
    counts = counts.sort_by([("j", "ascending"), ("value", "ascending")])
    j, value, n = (counts[c].to_numpy().astype(np.int64) for c in ("j", "value", "n"))
    ends = np.cumsum(n)
    first, last = (ends - n) // PART_ROWS, (ends - 1) // PART_ROWS
    return j << WIDTH | value, first, last, np.searchsorted(j, np.arange(PARTS + 1)), int(last.max(initial=-1)) + 1


def _budgets(radius: np.ndarray) -> np.ndarray:
    """How many bits each substring may differ in, for each query: the pigeonhole rule (-1: not searched)."""
    each, more = np.divmod(radius, PARTS)
    return np.where(np.arange(PARTS)[None] <= more[:, None], each[:, None], each[:, None] - 1)


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row of ``vectors`` that ``is_query`` names.

    ``vectors`` has vec_id (integer) and embedding (array of numbers); a query's own id is no candidate.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "array<double>"
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    read = read.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    lengths = read.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], result)
    size = lengths["size"]
    rows = read.filter(F.size("embedding") == size)
    mark = F.xxhash64("embedding").alias("mark")
    # of equal vectors the k + 1 smallest ids can be results; the limit is applied before rows are shuffled by vector
    least = Window.partitionBy("embedding").orderBy("vec_id")
    kept = save(rows.select("vec_id", "embedding").distinct().withColumn("at", F.row_number().over(least)).filter(F.col("at") <= k + 1)
                .select("vec_id", mark, "embedding"), "ann-rows")
    shared = spark.sparkContext.broadcast(fit(kept, k))
    coded_type = f"vec_id bigint, mark bigint, embedding {kind}, code binary, radius int"

    def coded(batches: Iterator[pa.RecordBatch], asks: bool) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            step = QUERY_BLOCK if asks else len(batch)  # a bounded block of queries against the bounded sample
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                matrix = _matrix(part.column(2), size)
                code = own.query_codes(matrix) if asks else own.codes(matrix)
                radius = own.radii(part.column(0).to_numpy(), matrix, code) if asks else np.zeros(len(part), np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([x.tobytes() for x in code], pa.binary()), pa.array(radius, pa.int32())],
                                                 names=["vec_id", "mark", "embedding", "code", "radius"])

    index = save(kept.mapInArrow(lambda b: coded(b, False), coded_type), "ann-index")
    asked = rows.filter("asks").select("vec_id", mark, "embedding").distinct().mapInArrow(lambda b: coded(b, True), coded_type)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _substrings(batch.column(0))
            for j in range(PARTS):
                value, n = np.unique(code[:, j], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), j), pa.int32()), pa.array(value, pa.int32()), pa.array(n, pa.int64())], names=["j", "value", "n"])

    # at most 65,536 values a substring, however many rows
    counts = index.select("code").mapInArrow(counted, "j int, value int, n bigint").groupBy("j", "value").agg(F.sum("n").alias("n"))
    layout = spark.sparkContext.broadcast(_layout(counts.toArrow()))
    sent_type = f"part int, kind int, j int, {coded_type}"

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each index row goes to one part a substring; a bucket over several parts is divided by the row's hash."""
        keys, first, last, _, _ = layout.value
        for batch in batches:
            code = _substrings(batch.column(3))
            for j in range(PARTS):
                at = np.searchsorted(keys, j << WIDTH | code[:, j].astype(np.int64))
                part = first[at] + batch.column(1).to_numpy() % (last[at] - first[at] + 1)
                yield _sent(batch, part, 0, np.full(len(part), j), np.arange(len(part)))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query goes once to every part that has a bucket near one of its substrings."""
        keys, first, last, starts, parts = layout.value
        for batch in batches:
            code = _substrings(batch.column(3))
            budgets = _budgets(batch.column(4).to_numpy().astype(np.int64))
            who, where = [], []
            for q in range(len(batch)):
                hit = np.zeros(parts + 1, np.int64)
                for j in np.flatnonzero(budgets[q] >= 0):
                    at = _close(keys[starts[j]:starts[j + 1]] & ((1 << WIDTH) - 1), int(code[q, j]), int(budgets[q, j])) + starts[j]
                    np.add.at(hit, first[at], 1)
                    np.add.at(hit, last[at] + 1, -1)
                own = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
                who.append(np.full(len(own), q))
                where.append(own)
            yield _sent(batch, np.concatenate(where), 1, np.zeros(sum(map(len, who))), np.concatenate(who))

    sent = index.mapInArrow(postings, sent_type).unionByName(asked.mapInArrow(probes, sent_type))
    sorted_ = sent.repartition("part").sortWithinPartitions("part", "kind", "j")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, table = [], None, None
        for batch in batches:
            part_of, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(part_of) != 0) | (np.diff(kind) != 0)) + 1, [len(batch)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if part_of[a] != part:
                    held, part, table = [], part_of[a], None
                piece = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(piece)
                elif held:
                    if table is None:
                        table = _Part(held, size)
                        held = [True]
                    yield table.answer(piece, size, k)

    found = sorted_.mapInArrow(probe, "query_id bigint, mark bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _sent(batch: pa.RecordBatch, part: np.ndarray, kind: int, j: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    own = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(np.full(len(part), kind), pa.int32()), pa.array(j, pa.int32()), *own.columns],
        names=["part", "kind", "j", "vec_id", "mark", "embedding", "code", "radius"])


def _close(values: np.ndarray, value: int, budget: int) -> np.ndarray:
    """Places in the sorted ``values`` within ``budget`` bits of ``value``: by probing or by a scan, whichever reads less."""
    masks = _MASKS_TO[min(budget, WIDTH)]
    if masks * 4 < len(values):
        wanted = _MASKS[:masks] ^ value
        at = np.searchsorted(values, wanted)
        at[at == len(values)] = 0
        return at[values[at] == wanted]
    return np.flatnonzero(_BITS_OF[values ^ value] <= budget)


class _Part:
    """The index rows of one part, by substring and bucket."""

    def __init__(self, pieces: list[pa.RecordBatch], size: int):
        self.j = np.concatenate([p.column(2).to_numpy() for p in pieces])
        self.ids = np.concatenate([p.column(3).to_numpy() for p in pieces])
        self.vectors = np.concatenate([_matrix(p.column(5), size) for p in pieces])
        code = np.concatenate([_substrings(p.column(6)) for p in pieces])
        order = np.lexsort((code[np.arange(len(code)), self.j], self.j))
        self.j, self.ids, self.vectors, self.code = self.j[order], self.ids[order], self.vectors[order], code[order]
        self.long = self.code.view("<u8")
        self.lists = {}
        for j in np.unique(self.j):
            rows = np.flatnonzero(self.j == j)
            values, start = np.unique(self.code[rows, j], return_index=True)
            self.lists[int(j)] = (values.astype(np.int64), rows[0] + start, np.append(np.diff(start), len(rows) - start[-1]))

    def _within(self, code: np.ndarray, radius: int, budget: np.ndarray) -> np.ndarray:
        """Rows within the radius, each at its first substring that is close enough."""
        long = code.view("<u8")
        out = []
        for j, (values, start, count) in self.lists.items():
            if budget[j] < 0:
                continue
            hit = _close(values, int(code[j]), int(budget[j]))
            n = count[hit]
            rows = np.repeat(start[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            distance = sum(np.bitwise_count(self.long[rows, w] ^ long[w]).astype(np.int16) for w in range(self.long.shape[1]))
            rows = rows[distance <= radius]
            if j:
                earlier = _BITS_OF[self.code[rows, :j] ^ code[:j]] <= budget[:j]
                rows = rows[~earlier.any(axis=1)]
            out.append(rows)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def answer(self, queries: pa.RecordBatch, size: int, k: int) -> pa.RecordBatch:
        ids, marks, vectors = queries.column(3).to_numpy(), queries.column(4).to_numpy(), _matrix(queries.column(5), size)
        code = _substrings(queries.column(6))
        radius = queries.column(7).to_numpy().astype(np.int64)
        budgets = _budgets(radius)
        out = []
        for q in range(len(ids)):
            rows = self._within(code[q], int(radius[q]), budgets[q])
            rows = rows[self.ids[rows] != ids[q]]
            if not len(rows):
                continue
            # row by row in one fixed order, so equal vectors get equal scores
            score = (self.vectors[rows] * vectors[q]).sum(axis=1)
            if len(rows) > k:
                good = score >= np.partition(score, -k)[-k]
                rows, score = rows[good], score[good]
            order = np.lexsort((self.ids[rows], -score))[:k]
            out.append((np.full(len(order), ids[q]), np.full(len(order), marks[q]), self.ids[rows[order]], score[order]))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "mark", "vec_id", "score"])
