"""Nearest neighbours, periodic runs and fill-in-middle texts against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ann_search, fill_in_middle, periodic_runs
from plumbline.llm.queries import QUERIES, with_planted_periods

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, mark string, code int, part int, rank int, score string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    found = set()
    for p in range(1, len(w) // 2 + 1):
        at = 0
        while at + p < len(w):
            start = at
            while at + p < len(w) and w[at] == w[at + p]:
                at += 1
            if at + p - start >= max(least, 2 * p) and at > start:
                x = w[start:at + p]
                if not any(x[q:] == x[:-q] for q in range(1, p)):
                    found.add((start, len(x), p))
            at += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(w: list[str], runs) -> str:
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    some = lambda n, k: [r.choice("abcdefghijklmnop"[:k]) for _ in range(n)]
    long = [str(r.randrange(500)) for _ in range(9000)]
    out = [None, "", " \t\n ", "one", " ".join(["x"] * 11), " ".join(["x"] * 12), "\n".join(["a b c"] * 4), "a b c " * 4 + "a b", "\xa0 " * 12, "日本 語\t" * 9,
           " ".join(long[:400] * 9), " ".join(long), " ".join(long + long + ["y"]), "z " * 30_000]
    for _ in range(60):
        w = some(r.choice([5, 30, 90]), r.choice([1, 2, 3, 16]))
        a, p = r.randrange(len(w)), r.randint(1, 20)
        out.append(" ".join((w[:a] + w[a:a + p] * 20)[:120] + some(4, 3)))
    return out


def test_periodic_runs_match_brute_force(spark, texts):
    data = [(i, t, "kept", "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*data, data[6], (None, texts[6], None, None)], "doc_id bigint, text string, runs string, _text string")
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "text", "_text", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(data) + 2 and sum(len(r["runs"]) for r in got) > 60
    for r in got:
        w = [x.decode() for x in (r["text"] or "").encode().split()]
        # the long texts are periodic by construction: brute force would take too long
        if len(w) < 3000:
            runs = brute_runs(w)
            assert [tuple(x) for x in r["runs"]] == runs, r["text"]
            assert r["collapsed"] == brute_collapsed(w, runs)
    by_id = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got}
    assert by_id[10] == [(0, 3600, 400)] and by_id[11] == [] and by_id[12] == [(0, 18000, 9000)] and by_id[13] == [(0, 30_000, 1)]
    assert periodic_runs.find_runs(docs.filter("false")).count() == 0
    assert [r["text"] for r in periodic_runs.find_runs(docs.filter("doc_id = 6").limit(1), collapsed="text").collect()] == ["a b c"]


def test_runs_share_no_words_across_texts():
    """Neighbours in one pass are fenced, also when one has no words."""
    sizes = np.array([6, 0, 6, 12])
    d, start, length, period = periodic_runs.runs_of(np.zeros(24, np.int64), sizes)
    assert (d.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([3], [0], [12], [1])


def test_extensions_match_comparison():
    r = np.random.default_rng(1)
    words = np.concatenate([r.integers(0, 2, 300), np.tile(r.integers(0, 3, 7), 60), [9]])
    own = periodic_runs.Extensions(words)
    a, b = r.integers(0, len(words), 3000), r.integers(0, len(words), 3000)
    a, b = a[a != b], b[a != b]
    for x, y, n in zip(a.tolist(), b.tolist(), own.common(a, b).tolist()):
        k = 0
        while max(x, y) + k < len(words) and words[x + k] == words[y + k]:
            k += 1
        assert n == k


def test_periodic_run_query_matches_its_contract(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        w = [x.decode() for x in text.encode().split()]
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        if n > 1500:
            continue
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        assert tuple(got[i]) == (i, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)), sha(brute_collapsed(w, runs)))
    empty = with_planted_periods(spark.createDataFrame([(None, None), (None, ""), (20, " ")], "doc_id bigint, text string"))
    assert empty.count() == 3


def brute_fim(i, text: str | None, seed: str = "1"):
    text = text or ""
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    one, two, three, four = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((one % (n + 1), two % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if four % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_matches_brute_force(spark, texts):
    more = ["a <P> b", "<S>", "< P><p>", "🎉é" * 40_000, "line\nend\r\n", "<", "M>", "<M"]
    data = [(i, t, "x", "y") for i, t in enumerate([*texts, *more])]
    data += [data[10], data[10], (10, "another text of the same id", "", ""), (None, None, None, None), (None, "no id", None, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, fim_form string, row string")
    for seed in ("1", "two"):
        expected = sorted(((-1 if i is None else i, *own[:4], sha(own[4]), sha(t or "")) for i, t, *_ in data for own in [brute_fim(i, t, seed)]), key=str)
        got = sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in fill_in_middle.digests(docs, seed=seed).collect()), key=str)
        assert got == expected
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    whole = fill_in_middle.transformed(docs)
    assert whole.columns == ["doc_id", "text", "row", "fim_form", "fim_text"]
    assert all(r["fim_text"] == brute_fim(r["doc_id"], r["text"])[4] and r["fim_form"] == brute_fim(r["doc_id"], r["text"])[1] for r in whole.collect())
    assert fill_in_middle.digests(docs.filter("false")).count() == 0 and fill_in_middle.transformed(docs.filter("false")).count() == 0


def test_fill_in_middle_shuffles_once(spark):
    plan = QUERIES["op13_fill_in_middle"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def brute_nearest(rows, asked, k):
    out = {}
    for i, v in asked:
        scored = sorted({(-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in rows if j != i})
        out[i] = [j for _, j in scored[:k]]
    return out


def vectors_of(n: int, size: int = 16, seed: int = 2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, size))
    return [(i, (centres[i % 20] + r.normal(size=size) * 0.6).astype("float32") * r.uniform(0.5, 2)) for i in range(n)]


def recall(got: dict, expected: dict) -> float:
    return float(np.mean([len(set(got[i]) & set(e)) / max(len(e), 1) for i, e in expected.items()]))


def nearest(frame, asks, k=20):
    out = {}
    for r in frame.transform(lambda f: ann_search.search(f, asks, k)).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append(r["vec_id"])
    return out


def test_nearest_neighbours_by_inner_product(spark):
    """Norms differ: what counts is the inner product, not the angle."""
    rows = [(i, v.tolist()) for i, v in vectors_of(3000)]
    frame = spark.createDataFrame([(i, v, "a", 1, 1, 1, "b") for i, v in rows], VECTORS)
    expected = brute_nearest(rows, [x for x in rows if x[0] % 20 == 0], 20)
    got = nearest(frame, F.col("vec_id") % 20 == 0)
    assert got.keys() == expected.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, expected) >= 0.9


def test_nearest_neighbours_of_odd_rows(spark):
    """Bad vectors take no part; few candidates are all returned; copies tie to the smaller id; equal rows count once."""
    good = [(i, v.tolist()) for i, v in vectors_of(12, 4)]
    bad = [(100, None), (120, []), (140, [0.0] * 4), (160, [1.0, None, 1.0, 1.0]), (180, [1.0, float("nan"), 1.0, 1.0]), (200, [1.0, float("inf"), 0.0, 1.0]), (220, [1.0, 2.0]), (None, [1.0] * 4)]
    copies = [(300 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    rows = [*good, *bad, *copies, copies[0], copies[0], good[0]]
    frame = spark.createDataFrame([(i, v, "a", 1, 1, 1, "b") for i, v in rows], VECTORS)
    got = nearest(frame, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 301))
    expected = brute_nearest([*good, *copies], [good[0], copies[0], copies[1], copies[20], copies[40]], 20)
    assert got == expected
    few = frame.filter("vec_id in (0, 1, 2, 100)")
    assert nearest(few, F.col("vec_id") == 0) == brute_nearest(good[:3], [good[0]], 20)
    assert nearest(frame.filter("vec_id = 0"), F.col("vec_id") == 0) == {}
    assert ann_search.search(frame.filter("false"), F.lit(True)).count() == 0
    assert ann_search.search(frame, F.lit(None).cast("boolean")).count() == 0


def test_every_code_within_the_radius_is_met_once():
    """The pigeonhole rule over one part against a scan of all codes."""
    import pyarrow as pa

    r = np.random.default_rng(4)
    code = r.integers(0, 1 << 16, (400, ann_search.PARTS)).astype("<u2")
    code[200:] = code[:200] ^ (r.random((200, ann_search.PARTS)) < 0.3).astype("<u2")
    n = len(code) * ann_search.PARTS
    rows = np.repeat(np.arange(len(code)), ann_search.PARTS)
    piece = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n), pa.int32()), pa.array(np.zeros(n), pa.int32()), pa.array(np.tile(np.arange(ann_search.PARTS), len(code)), pa.int32()), pa.array(rows, pa.int64()),
         pa.array(rows, pa.int64()), pa.array([[1.0]] * n, pa.list_(pa.float64())), pa.array([code[i].tobytes() for i in rows], pa.binary())], names=list("abcdefg"))
    part = ann_search._Part([piece], 1)
    for radius in (0, 1, 5, 12, 60, 128):
        budget = ann_search._budgets(np.array([radius]))[0]
        for q in (0, 7, 250):
            met = part.ids[part._within(code[q], radius, budget)].tolist()
            distance = np.bitwise_count(code ^ code[q]).sum(1)
            assert sorted(met) == np.flatnonzero(distance <= radius).tolist()


def test_search_query_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = {}
    for r in QUERIES["op11_ann_search"](spark, SF).collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    assert recall(out, brute_nearest(rows, [x for x in rows if x[0] % 20 == 0], 20)) >= 0.9
