"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import (chat, decontaminate, jaccard_join, language_id, language_model, line_dedup, quality_classifier, quality_rules,
                           sentencepiece_codec, sharding)
from plumbline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, shard string, label string"
RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choice("abcdefgh") for _ in range(RANDOM.randint(2, 6))) for _ in range(400)]


def words(n: int) -> str:
    return " ".join(RANDOM.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and blank texts, ties, equal rows, a very long text, near copies and a shared passage."""
    base, passage = words(120), words(60)
    near = base.split()
    near[50] = "changed"
    texts = [None, "", " \t\n ", "one", "one two three", base, base, " ".join(near), passage + "\n" + words(80),
             words(90) + "\n" + passage + "\n" + words(40), "\n".join([words(12), words(12), words(12)] * 2), words(30_000), "É" * 500,
             "퟿ 日本語 🎉 \x01\x02 1.5 kg"] + [words(RANDOM.randint(5, 200)) for _ in range(20)]
    out = [(i, t, "en" if i % 3 else None, "s", None, "x", "y", "z") for i, t in enumerate(texts)]
    return [*out, out[5], (None, base, None, None, 3, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_line_dedup_matches_brute_force(docs, rows):
    got = {(r["doc_id"], r["text"]): r["_removed"] for r in docs.select("doc_id", F.col("text").alias("was")).distinct().withColumn("text", F.col("was"))
           .transform(lambda d: line_dedup.dedup_lines(d, 30)).select("doc_id", F.col("was").alias("text"), "_removed").collect()}
    seen, expected = set(), {}
    for i, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        lines = [x for x in text.split("\n") if x.strip()]
        gone = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(len(x.split()) for x in lines[a:b + 1]) >= 30:
                    key = tuple(lines[a:b + 1])
                    if key in seen:
                        gone |= set(range(a, b + 1))
                    seen.add(key)
        expected[i, text] = len(gone)
    assert {k: v for k, v in got.items() if k[1] is not None} == expected
    assert any(expected.values())


def test_line_dedup_counts_words_of_a_repeated_row_once(spark):
    """Equal rows are one document: runs are not cut shorter in it, and a shared run under 30 words stays."""
    passage, short = [words(12) for _ in range(5)], "\n".join([words(10), words(10)])
    data = [(1, "\n".join([words(12), *passage])), (2, "\n".join([*passage, words(12)])), (3, short + "\n" + words(40)), (4, short + "\n" + words(50))]
    frame = spark.createDataFrame([*data, data[0], data[2], data[2], data[3]], "doc_id bigint, text string")
    got = Counter((r["doc_id"], r["text"], r["_removed"]) for r in line_dedup.dedup_lines(frame, 30).collect())
    assert got == Counter({(1, data[0][1], 0): 2, (2, data[1][1].split("\n")[-1], 5): 1, (3, data[2][1], 0): 3, (4, data[3][1], 0): 2})


def test_line_dedup_keeps_rows_and_columns(docs, spark):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_removed"] and out.count() == docs.count()
    assert line_dedup.dedup_lines(docs.filter("false")).count() == 0


def _sets(rows):
    out = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def test_jaccard_join_matches_brute_force(docs, rows):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect())
    sets, group = _sets(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for g, r in zip(group, rows):
        if r[0] is not None:
            first[g] = min(first.get(g, r[0]), r[0])
    assert got == Counter((r[0], len(s), first.get(g) if s else r[0]) for r, s, g in zip(rows, sets, group))


def test_jaccard_join_with_many_near_copies(spark):
    base = words(200).split()
    data = []
    for i in range(120):
        own = list(base)
        for _ in range(i % 7):
            own[RANDOM.randrange(200)] = RANDOM.choice(VOCABULARY)
        data.append((i, " ".join(own)))
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    sets, group = _sets(data), list(range(120))
    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {g: min(i for i in range(120) if group[i] == g) for g in set(group)}
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.components(frame).collect()} == {i: first[g] for i, g in enumerate(group)}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    found = {r["node"]: r["label"] for r in jaccard_join.labels(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_decontamination_counts_the_consistent_part(spark):
    """One changed occurrence of a repeated number, two values made equal, a longer name and an inserted word."""
    parts = [words(9) for _ in range(20)]
    long = " 3 ".join(parts)
    changed = " 3 ".join(parts[:10]) + " 4 " + " 3 ".join(parts[10:])
    apples = "Every day the boy eats 5 apples and the girl eats 6 pears before they both walk home"
    split = "yesterday at noon old farmer named Tom went over the river to buy bread"
    wordy = "many people think that seven small red birds live inside that hollow tree"
    data = [(1, words(20) + " . " + changed), (2, apples.replace("5", "7").replace("6", "7")), (3, split.replace("Tom", "Ann Lee")),
            (4, wordy.replace("red birds", "red happy birds")), (5, words(50))]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, long), (2, apples), (3, split), (4, wordy)], "item_id bigint, text string")
    for share in (0.5, 0.99):
        found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated_pairs(frame, bench, width=4, min_share=share).collect()}
        assert found == ({(1, 1), (2, 2), (3, 3), (4, 4)} if share == 0.5 else {(1, 1), (2, 2), (4, 4)})


def test_decontamination_catches_other_numbers_and_names(spark):
    item = "A farmer named Tom sells 12 apples and 30 pears at the market for 5 dollars each and then walks home"
    other = "A farmer named Ann sells 77 apples and 81 pears at the market for 9 dollars each and then walks home"
    mixed = "A farmer sells 12 apples and 12 pears " + words(10)
    data = [(1, words(40) + ". " + item, 0), (2, words(20) + "\n" + other, 0), (3, words(60), 0), (4, mixed, 0), (5, None, 0), (6, "", 0), (None, item, 0)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (8, "short question here"), (9, None), (10, "")], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated_pairs(frame, bench).collect()} == {(1, 7), (2, 7), (None, 7)}
    assert {r["doc_id"] for r in decontaminate.remove_contaminated(frame, bench).collect()} == {3, 4, 5, 6}
    assert decontaminate.remove_contaminated(frame, bench.filter("false")).count() == 7
    assert decontaminate.contaminated_pairs(frame.filter("false"), bench).count() == 0


def test_decontamination_finds_copies_that_are_mostly_slots(spark):
    """Exact copies of tables and lists of names count, other values in the same template do not."""
    numbers = "12 7 31 5 88 2 46 19 3 77 10 64"
    names = "Paris, London, Rome, Madrid, Vienna, Prague, Berlin, Oslo, Dublin, Lisbon"
    short = "3 4 5"
    data = [(1, words(30) + " " + numbers + " " + words(30)), (2, words(30) + " " + names + " " + words(5)), (3, "see 3 4 5 there"),
            (4, words(30) + " 13 8 32 6 89 1 47 20 4 78 11 65 " + words(5)), (5, "see " + names.replace("London", "Bern").replace("Oslo", "Kyiv")),
            (6, names)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, numbers), (2, names), (3, short)], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated_pairs(frame, bench).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (6, 2)}
    assert {r["doc_id"] for r in decontaminate.remove_contaminated(frame, bench).collect()} == {4, 5}


def test_decontamination_needs_consistent_slots(spark):
    item = "first take 3 steps to the left then take 3 steps to the right then take 3 steps back again"
    good, bad = item.replace("3", "8"), item.replace("3", "8", 1)
    frame = spark.createDataFrame([(1, good), (2, bad)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [r["doc_id"] for r in decontaminate.contaminated_pairs(frame, bench).collect()] == [1]


def test_language_id(docs, spark):
    out = QUERIES["op3_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out and lang is not null")
    assert held.filter("lang = lang_pred").count() >= 0.95 * held.count()
    model = language_id.fit(docs)
    odd = language_id.predict(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} >= {0, 1, 2}
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.fit(docs.filter("false"))).collect()} == {"und"}


def test_language_id_counts_every_word(spark):
    """What is broadcast changes no score, and a rare language keeps its words."""
    big, small = [words(60) for _ in range(30)], ["zorn plim quax " + " ".join(f"w{'abcdefghij'[i]}{'klmnopqrst'[j]}x" for j in range(10)) for i in range(10)]
    train = [(i, t, "aa") for i, t in enumerate(big)] + [(100 + i, t, "bb") for i, t in enumerate(small)]
    frame = spark.createDataFrame(train, "doc_id bigint, text string, lang string")
    ask = spark.createDataFrame([(1, "wakx wjtx"), (2, "zorn abba"), (3, big[3]), (3, big[3]), (4, "123"), (5, None)], "doc_id bigint, text string")
    few = sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in language_id.predict(ask, language_id.fit(frame, near_mb=0.0004)).collect())
    all_ = sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in language_id.predict(ask, language_id.fit(frame, near_mb=50)).collect())
    assert few == all_ and len(few) == 6 and few[0][1] == "bb" and few[-2:] == [(4, "und", 0.0), (5, "und", 0.0)]
    counts = {lang: Counter(w for _, t, x in train if x == lang for w in t.split()) for lang in ("aa", "bb")}
    vocabulary = len(set().union(*counts.values()))
    sums = [sum(math.log((counts[x][w] + 0.5) / (sum(counts[x].values()) + 0.5 * vocabulary)) for w in ("wakx", "wjtx")) + math.log(sum(counts[x].values()))
            for x in ("aa", "bb")]
    assert few[0][2] == pytest.approx(1 / (1 + math.exp(sums[0] - sums[1])), abs=1e-8)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_matches_brute_force(docs, rows, order):
    out = language_model.score(docs, F.coalesce(F.col("doc_id") % 3, F.lit(0)) != 2, order=order)
    tokens = [(r[1] or "").encode().lower().split() + [b""] for r in rows]
    taught = [(r[0] or 0) % 3 != 2 for r in rows]
    grams, contexts = Counter(), Counter()
    for t, yes in zip(tokens, taught):
        told = [b"", *t]
        for j in range(len(t) if yes else 0):
            grams[t[j],] += 1
            for k in range(1, min(order, j + 2)):
                grams[tuple(told[j + 1 - k:j + 2])] += 1
                contexts[tuple(told[j + 1 - k:j + 1])] += 1
    one = Counter({g[0]: c for g, c in grams.items() if len(g) == 1})
    n, v = sum(one.values()), len(one)

    def chance(history, w):
        if not history:
            return (one[w] + 1) / (n + v + 1)
        return (grams[*history, w] + 20 * chance(history[1:], w)) / (contexts[history] + 20)

    expected = []
    for r, t in zip(rows, tokens):
        told = [b"", *t]
        model = sum(math.log10(min(1.0, chance(tuple(told[max(0, j + 2 - order):j + 1]), w))) for j, w in enumerate(t))
        expected.append((str(r[0]), len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(chance((), w)) for w in t), model))
    got = sorted((str(r[0]), *r[2:]) for r in out.collect())
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4]) and abs(a[5] - b[5]) <= 0.02 * b[1] + 1e-9
    assert language_model.score(docs.filter("false"), F.lit(True), order=order).count() == 0


def test_language_model_spreads_frequent_contexts(docs, monkeypatch):
    """What shard an n-gram goes to changes no score."""
    train = F.coalesce(F.col("doc_id") % 3, F.lit(0)) != 2
    plain = sorted(map(str, language_model.score(docs, train).collect()))
    monkeypatch.setattr(language_model, "HOT_CONTEXT", 1)
    monkeypatch.setattr(language_model, "PAIRS_A_SHARD", 100)
    assert sorted(map(str, language_model.score(docs, train).collect())) == plain


def test_trie_finds_what_it_holds():
    draw = np.random.default_rng(3)
    pairs = np.unique(draw.integers(0, [50, 100_000], (20_000, 2)), axis=0)
    n = draw.integers(1, 9, len(pairs))
    trie = language_model.Trie(pairs[:, 0], pairs[:, 1], n, np.full(len(pairs), 100), 1.0)
    contexts, sizes = np.unique(pairs[:, 0], return_counts=True)
    assert (trie.ask(contexts, sizes, pairs[:, 1]) == 1 + np.round(-np.log10(n / 101) / language_model.STEP)).all()
    absent = np.setdiff1d(np.arange(100_000), pairs[:, 1])[:50]
    assert not trie.ask(np.array([3, 60]), np.array([25, 25]), absent).any()


def test_pieces_equal_the_library(docs, rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    got = Counter((r["doc_id"], None if r["ids"] is None else tuple(r["ids"]), r["round_trip"]) for r in sentencepiece_codec.encode(docs).collect())
    assert got == Counter((r[0], None if r[1] is None else tuple(library.encode(r[1])), None if r[1] is None else True) for r in rows)


def test_unigram_viterbi_takes_the_best_sum():
    pieces = sentencepiece_codec.Pieces(open(sentencepiece_codec.MODEL, "rb").read())
    pieces.merges, score = False, {"a": -2.0, "b": -2.0, "ab": -3.0, "ba": -1.0}
    ids = {k: pieces.text.index(k) for k in score}
    pieces.best = np.full(len(pieces.text), -50.0)
    for k, s in score.items():
        pieces.best[ids[k]] = s
    assert pieces.encode_chunks(["aba"]) == [[ids["a"], ids["ba"]]]


def test_chat_round_trip_and_mask(spark):
    data = [(1, 1, "assistant", "a <b> \\ </turn>\n日本🎉", 0), (1, 0, "user", None, 0), (2, 0, None, "\\", 0), (2, 1, "assistant", "", 0),
            (2, 2, "assistant", "\n\n  x", 0), (None, 0, "user", "hi", 0), (1, 0, "user", None, 0)]
    turns = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string, formatted int")
    out = {r["conv_id"]: r for r in chat.format_conversations(turns).collect()}
    for conv, r in out.items():
        own = sorted(((d[1], d[2] or "", d[3] or "") for d in data if d[0] == conv))
        assert [(role, text) for role, text, _, _ in chat.parse(r["formatted"])] == [x[1:] for x in own]
        loss = chat.ESCAPED.sub(r"\1", "".join(r["formatted"][s["start"]:s["end"]] for s in r["loss_spans"]))
        assert loss == "".join(t for _, role, t in own if role == "assistant")
        assert len(r["token_ids"]) == len(r["loss_mask"])
    assert chat.format_conversations(turns.filter("false")).count() == 0
    digest = {r["conv_id"]: r for r in QUERIES["op4_chat_formatting"](spark, SF).collect()}[-7]
    assert digest["n_turns"] == 2 and digest["loss_sha256"] == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()


def _language_by_hand(train: list[tuple[str, str]], text: str) -> tuple[str, float]:
    """Counted words first, then the longest counted n-grams of a word."""
    langs = sorted({lang for _, lang in train})
    count = {x: Counter(w for t, lang in train if lang == x for token in t.lower().split() for w in language_id.words_in(token)) for x in langs}
    grams = {}
    for size in range(1, 5):
        for x in langs:
            for word, n in count[x].items():
                marked = f"^{word}$" if size > 1 else word
                for i in range(len(marked) - size + 1):
                    grams.setdefault(size, {}).setdefault(marked[i:i + size], Counter())[x] += n

    def logs(table: dict, key: str) -> list[float]:
        return [math.log((table[key][x] + 0.5) / (sum(c[x] for c in table.values()) + 0.5 * len(table))) for x in langs]

    words = {}
    for x in langs:
        for w, n in count[x].items():
            words.setdefault(w, Counter())[x] += n
    total = sum(sum(c.values()) for c in count.values())
    sums = [math.log(sum(count[x].values()) / total) for x in langs]
    for token in text.lower().split():
        for word in language_id.words_in(token):
            if word in words:
                v = logs(words, word)
            else:
                for size in range(4, 0, -1):
                    marked = f"^{word}$" if size > 1 else word
                    hits = [logs(grams[size], marked[i:i + size]) for i in range(len(marked) - size + 1) if marked[i:i + size] in grams[size]]
                    if hits:
                        v = [0.8 ** (5 - size) * sum(h[k] for h in hits) / len(hits) for k in range(len(langs))]
                        break
                else:
                    v = [0.0] * len(langs)
            sums = [a + b for a, b in zip(sums, v)]
    best = max(sums)
    return langs[sums.index(best)], 1 / sum(math.exp(x - best) for x in sums)


def test_language_backs_off_as_by_hand(spark):
    """Unseen words by the longest counted n-grams, with every word broadcast, some, or none; ties go to the smaller name."""
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(1, 7)))
    train = [(" ".join(word("abcde") for _ in range(12)), "aa") for _ in range(6)] + [(" ".join(word("cdefg") for _ in range(9)), "bb") for _ in range(6)]
    asked = [" ".join(word(k) for _ in range(4)) for k in ("abcde", "cdefg", "abgzz", "zzyx")] * 3 + [train[0][0], "q", "Abc-DEF3gg a1b"]
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(train)], "doc_id bigint, text string, lang string")
    ask = spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string")
    for near_mb in (0, 0.002, 10):
        for row in language_id.predict(ask, language_id.fit(frame, near_mb=near_mb)).collect():
            lang, score = _language_by_hand(train, asked[row["doc_id"]])
            assert row["lang_pred"] == lang and row["score"] == pytest.approx(score, abs=1e-9), asked[row["doc_id"]]
    twins = spark.createDataFrame([(1, "same words", "bb"), (2, "same words", "aa")], "doc_id bigint, text string, lang string")
    assert {(x["lang_pred"], x["score"]) for x in language_id.predict(ask, language_id.fit(twins)).collect()} == {("aa", 0.5)}


def test_shards_are_near_equal_and_gapless(docs, spark):
    out = [r.asDict() for r in QUERIES["op6_sharding"](spark, SF).collect()]
    sizes, slots = Counter(), {}
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 16 and r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in out)
    assert len(out) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in out)
    assert set(sizes) <= set(range(40)) and max(sizes.values()) <= sum(sizes.values()) / 40 + largest
    assert sharding.assign_shards(docs, 3).count() == docs.count() and sharding.assign_shards(docs.filter("false"), 3).count() == 0
    hot = sharding.assign_shards(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text")), 4)
    assert sorted(r["count"] for r in hot.groupBy("shard").count().collect()) == [750] * 4


def _repeat_words(w: list[str]) -> int:
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    return len({j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)})


def test_quality_rules_match_brute_force(docs, rows):
    got = quality_rules.apply_rules(docs).collect()
    count = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    expected = Counter()
    for r in rows:
        text = r[1] or ""
        w = text.split()
        lines = [x for x in text.split("\n") if x.strip()]
        again = _repeat_words(w)
        expected[r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again,
                 len(w) < 20 or 100 * again > 30 * len(w)] += 1
    assert count == expected and not any(r["kept"] and (r["base_failed"] or r["failed_rules"]) for r in got)
    assert quality_rules.apply_rules(docs.filter("false")).count() == 0


def test_quality_classifier_learns_and_scores_all(docs, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = QUERIES["op10_quality_classifier"](spark, SF).join(labels, "doc_id")
    assert out.filter("predicted = quality").count() >= 0.9 * out.count()
    none = quality_classifier.fit(docs, labels.filter("false"))
    scores = quality_classifier.score(docs, none)
    assert scores.columns == [*docs.columns, "score"] and {r["score"] for r in scores.select("score").collect()} == {0.5}
    one = quality_classifier.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert all(r[0] > 0.9 for r in quality_classifier.score(docs, one).select("score").collect())


def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out = out.persist()
            assert 0 < out.count() <= docs.count()
            docs = out
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()} and out.filter("not round_trip").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram jaccard join", "benchmark decontamination", "sentencepiece"]


def test_pipeline_stages_take_odd_rows(docs, spark):
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, SF).count() <= frame.count()
        assert stage(spark, frame.filter("false"), SF).count() == 0
