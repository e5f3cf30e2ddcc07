"""Clashing column names, bounds that hold, cut-offs without an end, and near copies under repeated ids."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import decontaminate, jaccard_join, line_dedup, quality_classifier, quality_rules, sentencepiece_codec

CLASHES = ("_doc", "_h", "_gone", "_removed", "_words", "_lines", "_chars", "_stat_n_words", "__stat_n_words", "_text", "_draw", "_y", "_id", "ids", "n_ids", "score", "label", "h")
PASSAGE = "\n".join(" ".join(f"line{i}word{j}" for j in range(12)) for i in range(4))


@pytest.fixture(scope="module")
def clashing(spark):
    texts = [PASSAGE + "\nfirst end", "second start\n" + PASSAGE, None, "", "short"]
    rows = [(i, t, *[f"{c}-{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHES))


def kept_as_given(frame, out, replaced=()):
    own = [c for c in CLASHES if c not in replaced]
    assert Counter(tuple(r) for r in out.select("doc_id", *own).collect()) <= Counter(tuple(r) for r in frame.select("doc_id", *own).collect())


def test_user_columns_may_have_any_name(spark, clashing):
    cleaned = line_dedup.dedup_lines(clashing)
    assert sorted(cleaned.columns) == sorted(clashing.columns) and {r["doc_id"]: r["_removed"] for r in cleaned.collect()}[1] == 4
    kept_as_given(clashing, cleaned, ("_removed",))
    items = spark.createDataFrame([(7, PASSAGE.replace("\n", " "))], "item_id bigint, text string")
    clean = decontaminate.remove_contaminated(clashing, items)
    assert clean.columns == clashing.columns and {r["doc_id"] for r in clean.collect()} == {2, 3, 4}
    kept_as_given(clashing, clean)
    assert decontaminate.remove_contaminated(clashing, items.filter("false")).count() == 5
    empty = decontaminate.contaminated_pairs(clashing, items.filter("false"))
    assert empty.columns == decontaminate.contaminated_pairs(clashing, items).columns and empty.count() == 0
    model = quality_classifier.fit(clashing, spark.createDataFrame([(0, 1), (4, 0), (1, 1), (3, 0)], "doc_id bigint, quality int"))
    scored = quality_classifier.score(clashing, model)
    assert scored.columns == clashing.columns and scored.filter("score between 0 and 1").count() == 5
    kept_as_given(clashing, scored, ("score",))
    pytest.importorskip("sentencepiece")
    coded = sentencepiece_codec.encode(clashing, keep=["doc_id", "ids", "_text"])
    assert coded.columns == ["doc_id", "_text", "ids", "n_ids", "round_trip"]
    assert {r["doc_id"]: (r["_text"], r["round_trip"]) for r in coded.collect()}[4] == ("_text-4", True)


def test_the_fit_is_bounded_by_rows(spark, monkeypatch):
    """Two labels of one id that many rows carry: labels and documents together stay below the bound."""
    seen = []
    monkeypatch.setattr(quality_classifier, "fit_rules", lambda x, y, **_: seen.append(len(y)))
    docs = spark.range(3000).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1)], "doc_id bigint, quality int")
    quality_classifier.fit(docs, labels, max_rows=100)
    quality_classifier.fit(docs.limit(30), labels, max_rows=100)
    assert seen == [100, 60]


def brute_fences(rows, factor=4, min_rows=4):
    """The documents kept and the rules that fail, from the stated sketch."""
    def stats(text):
        w, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        again = len({j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)})
        chars = sum(map(len, w))
        share = lambda a, b, unit: a * unit / b if b else 0.0
        return len(w), again, {
            "symbols": share(sum(c in "#*$%&|<>" for c in text), chars, 1000), "shouts": share(sum(c.isascii() and c.isupper() or c == "!" for c in text), chars, 1000),
            "repeats": share(again, len(w), 1000), "dup_lines": share(len(lines) - len(set(lines)), len(lines), 1000), "word_length": share(chars, len(w), 100)}

    base = 1 + quality_rules.ACCURACY
    bucket = lambda v: math.ceil(math.log(v) / math.log(base)) if v > 0 else -math.inf
    value = lambda b: 0.0 if b == -math.inf else base ** b * 2 / (1 + base)
    known = [(i, lang, source, *stats(t or "")) for i, t, lang, source in rows]
    groups = defaultdict(list)
    for _, lang, source, _, _, m in known:
        for key in ((lang, source), (lang,), ()):
            groups[key].append(m)

    def fence(lang, source, name):
        key = next((k for k in ((lang, source), (lang,)) if len(groups[k]) >= min_rows), ())
        own = sorted(bucket(m[name]) for m in groups[key])
        q1, q3 = (value(own[-(-len(own) * k // 4) - 1]) for k in (1, 3))
        return q3 + factor * max(q3 - q1, quality_rules.METRICS[name])

    out = {}
    for i, lang, source, n, again, m in known:
        failed = [name for name in quality_rules.METRICS if m[name] > fence(lang, source, name)]
        out[i] = (failed, not (n < 20 or 100 * again > 30 * n) and not failed)
    return out


def test_fences_and_verdicts_match_brute_force(spark):
    """Also where the metric is far beyond any fixed end: words of four hundred letters beside short ones."""
    draw = random.Random(4)
    word = lambda i, j, n: "".join(draw.choice("abcdefghij") for _ in range(n))
    plain = lambda i, low, high: " ".join(word(i, j, low + (i + j) % (high - low)) for j in range(40 + i % 7))
    rows = [(i, plain(i, 3, 8), "en" if i % 3 else "fr", "web" if i % 2 else None) for i in range(40)]
    rows += [(100, " ".join(word(1, j, 400) for j in range(30)), "en", "web"), (101, plain(5, 3, 8).upper(), "en", "web"), (102, plain(6, 3, 8) + " ###$$$%%%" * 30, "fr", None),
             (103, "\n".join(["the same line of words again"] * 9), "fr", "web"), (104, None, None, None), (105, "", "xx", "web"), (106, plain(9, 390, 400), "xx", "rare")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: (list(r["failed_rules"]), r["kept"]) for r in quality_rules.apply_rules(frame, min_rows=4).collect()}
    assert got == brute_fences(rows)
    assert got[100] == (["word_length"], False) and not got[101][1] and not got[102][1] and sum(kept for _, kept in got.values()) >= 35


def test_near_copies_under_repeated_ids(spark):
    """A text is dropped for its own copies only, whatever else carries its id."""
    one, two, three = (" ".join(f"{name}{i}" for i in range(60)) for name in ("a", "b", "c"))
    near = one.replace("a30", "changed")
    rows = [(1, one), (2, one), (2, two), (2, near), (3, three), (4, three + " more"), (None, three), (None, "lonely text of no id at all"), (5, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_near(spark, docs, "").collect())
    assert got == Counter([(1, one), (2, two), (3, three), (None, "lonely text of no id at all"), (5, None), (6, "")])


def test_components_of_a_long_chain(spark):
    """Rounds go on until nothing is left, however long a chain is."""
    n = 700
    links = spark.createDataFrame([((i * 37) % n, ((i + 1) * 37) % n) for i in range(n - 1)], "a bigint, b bigint")
    assert {r["label"] for r in jaccard_join.labels(links).collect()} == {0}


def statistics_by_hand(text):
    body = text or ""
    words = [w for w in re.split("[\x20\x09-\x0D]+", body) if w]
    lines = [x for x in body.split("\n") if x.strip("\x20\x09\x0A\x0B\x0C\x0D")]
    chars = sum(map(len, words))
    count = lambda known: sum(c in known for c in body)
    share = lambda part, whole: part / whole if whole else 0.0
    capitals = "".join(map(chr, range(65, 91))) + "!"
    return [len(words), share(chars, len(words)), share(len(set(words)), len(words)), share(count("#*$%&|<>"), chars), share(count(capitals), chars),
            share(count("0123456789"), chars), share(count(".?,;:"), len(words)), share(len(words), len(lines)),
            share(len(lines) - len(set(lines)), len(lines)), share(chars, len(lines))]


def test_compiled_rules_score_as_by_hand(spark):
    """Statistics and the compiled sum of rules against plain Python, on texts with ties, repeats, blanks and one very long text."""
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["the", "Quick", "fox!", "#12", "a|b", "x.", "été", "\u2003", "\n", "\t"]) for _ in range(draw.randrange(80))) for _ in range(300)]
    texts += [None, "", " \n\t", "one", texts[0], texts[0], "long word, " * 60_000]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(statistics_by_hand(t)[3] < 0.05)) for i, t in rows[:250]], "doc_id bigint, quality int")
    model = quality_classifier.fit(docs, labels)
    assert model.rules and any(len(parts) > 1 for _, parts in model.rules)

    def expected(text):
        x = statistics_by_hand(text)
        held = [weight for weight, parts in model.rules if all((x[at] > cut) == above for at, above, cut in parts)]
        return 1 / (1 + math.exp(-(model.bias + sum(held))))

    got = quality_classifier.score(docs, model).select("doc_id", F.xxhash64("text").alias("h"), "text", "score").collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    for r in got:
        assert r["score"] == pytest.approx(expected(r["text"]), abs=1e-9)
    stats = quality_classifier.with_statistics(docs).collect()
    for r in stats:
        assert [r[f"_stat_{k}"] for k in quality_classifier.STATISTICS] == pytest.approx(statistics_by_hand(r["text"]))


def test_shingles_of_many_texts_are_those_of_each():
    """Chunks of texts give each text the number of distinct runs of five words that a set of tuples has, and shared ones are shared."""
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcXYZé") for _ in range(rng.randint(1, 9))) for _ in range(30)] + ["w" * 100, "W" * 99 + "w", "w" * 101]
    texts = [None, "", " \t\n", "one", "One TWO", "\x0bone\x0ctwo\r"] + [
        rng.choice(" \n\t").join(rng.choice(pool) for _ in range(rng.choice([1, 4, 5, 6, 40, 3000]))) for _ in range(150)]
    by_hand = []
    for t in texts:
        w = (t or "").encode().lower().split()
        by_hand.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    shingles = jaccard_join.Shingler(5)
    sets = list(shingles.many(texts))
    assert [len(s) for s in sets] == [len(x) for x in by_hand]
    assert all(set(shingles(t)) == set(s) for t, s in zip(texts, sets))
    for i in range(len(texts)):
        for j in range(0, i, 7):
            assert len(set(sets[i].tolist()) & set(sets[j].tolist())) == len(by_hand[i] & by_hand[j])


def test_long_texts_with_one_passage_in_common_are_no_candidates():
    """Long unrelated texts that share a few listed shingles are no candidates; all linked sets are, whatever the order."""
    rng = random.Random(9)
    passage = " ".join(f"shared{i}" for i in range(24))
    texts = []
    for i in range(8):
        own = [f"w{rng.randrange(10 ** 9)}" for _ in range([2400, 2400, 2400, 60, 60, 8, 6, 3000][i])]
        half = len(own) // 2
        for changes in range(3):
            near = list(own)
            for k in rng.sample(range(len(own)), changes * len(own) // 80):
                near[k] = f"w{rng.randrange(10 ** 9)}"
            texts.append(" ".join([*near[:half], passage, *near[half:]]))
    shingles = jaccard_join.Shingler(5)
    sets = [shingles(t) for t in texts]
    n = [len(x) for x in sets]
    batch = pd.DataFrame({"text": texts, "cls": [jaccard_join._name(x) for x in sets], "node": range(len(texts)), "need": [3 * k for k in n],
                          "least": [int(5.25 * k) for k in n], "known": range(len(texts))})
    none = np.zeros(0, np.uint64)
    for weight in (np.zeros(jaccard_join.BUCKETS, np.int64), np.arange(jaccard_join.BUCKETS) % 97):
        index = pd.concat(jaccard_join._index(5, 3, (none, none, weight))(iter([batch.iloc[:10].reset_index(drop=True), batch.iloc[10:].reset_index(drop=True)])))
        found = pd.concat([jaccard_join._probe(part.reset_index(drop=True)) for _, part in index.groupby("shard")])
        found = found.groupby(["a", "b"]).agg({"hits": "sum", "rest": "min", "need": "min", "wanted": "min"}).reset_index()
        found = found[(found.hits >= found.wanted) & (7 * (found.hits + found.rest - found.wanted) >= found.need)]
        pairs = set(zip(found.a, found.b))
        shared = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(len(n)) for j in range(i + 1, len(n))}
        assert {p for p, k in shared.items() if 7 * k >= 3 * (n[p[0]] + n[p[1]])} <= pairs
        assert all(i // 3 == j // 3 for i, j in pairs if n[i] > 1000)


def test_tasks_of_one_process_share_the_vocabulary(spark, tmp_path):
    """A model is prepared once a process however many tasks it runs, and again if the file is another one."""
    model = tmp_path / "pieces.model"
    with open(sentencepiece_codec.MODEL, "rb") as f:
        data = f.read()
    model.write_bytes(data)
    first = sentencepiece_codec.opened(str(model))
    assert sentencepiece_codec.opened(str(model)) is first
    model.write_bytes(data + b"\x32\x00")  # a field that no reader knows
    assert sentencepiece_codec.opened(str(model)) is not first
    rows = [(i, f"word{i % 7} and others {i % 5}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, many = (sorted((r["doc_id"], *r["ids"]) for r in sentencepiece_codec.encode(docs.repartition(n), memory=5).collect()) for n in (1, 8))
    assert one == many and len(one) == 40
