"""Language identification by words first, and by ever shorter character n-grams for unseen words.

Training counts words per language over all labelled texts, and n-grams of one to four letters (with word ends) of all
counted words. All counts stay tables. ``near_mb`` bounds only what is broadcast: each language has an equal part of it for its
most frequent words, which are scored where the text is read; all others are joined to the tables, each distinct word once.
A text is scored word by word: a counted word by its smoothed log frequency in each language, an unseen word by the
longest n-grams of it that were counted, shorter ones only where no longer one was. The summed scores and the languages' log
shares of training words give a posterior.

Null text, or one without letters: ``und`` with score 0. Null language: not learned from. Ties go to the smaller
language name. Without training rows everything is ``und``. Repeated rows count as often as they stand there; empty
tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import save

LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 4
FLUSH = 600_000
#: an n-gram of a word tells less than the word: its log score counts by this factor a step of backing off
BACKOFF = 0.8


def plain(values: list[str]) -> pd.Series:
    """Strings as Python objects; a string column made of pieces, or empty, may not turn into one Arrow array."""
    return pd.Series(values, dtype=object)


def words_in(token: str) -> list[str]:
    """The runs of letters in a lower-case token."""
    if token.isalpha():
        return [token]
    return [x for part in LETTERS.findall(token) if (x := part if part.isalpha() else "".join(filter(str.isalpha, part)))]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of a task. Whole tokens are counted first, so that only distinct ones are looked into."""
    counts: dict[str, Counter] = {}

    def out() -> Iterator[pd.DataFrame]:
        for lang, tokens in counts.items():
            words: Counter = Counter()
            for token, n in tokens.items():
                for word in words_in(token):
                    words[word] += n
            yield pd.DataFrame({"lang": plain([lang] * len(words)), "word": plain(list(words)), "n": list(words.values())})
        counts.clear()

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            counts.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, counts.values())) > FLUSH:
                yield from out()
    yield from out()


def _grams_of(words: list[str], counts: np.ndarray) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """For each length: the distinct n-grams of the words with their summed counts."""
    text = "".join(f"^{w}$" for w in words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters, codes = np.unique(points, return_inverse=True)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(sizes), sizes)
    weight = np.repeat(counts, sizes)
    at = np.arange(len(points))
    key = np.zeros(len(points), np.int64)
    for size in range(1, LONGEST + 1):
        key = key[:len(points) - size + 1] * len(letters) + codes[size - 1:] if size > 1 else codes.astype(np.int64)
        inside = at[:len(key)] + size <= ends[:len(key)]
        if size == 1:
            inside &= (points != ord("^")) & (points != ord("$"))
        found, first, group = np.unique(key[inside], return_index=True, return_inverse=True)
        places = at[:len(key)][inside][first]
        yield size, [text[p:p + size] for p in places], np.bincount(group, weights=weight[:len(key)][inside], minlength=len(found))


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []

    def out() -> Iterator[pd.DataFrame]:
        part = pd.concat(held)
        held.clear()
        for lang, own in part.groupby("lang"):
            for size, grams, n in _grams_of(list(own["word"]), own["n"].to_numpy(np.float64)):
                yield pd.DataFrame({"lang": plain([lang] * len(grams)), "size": size, "gram": plain(grams), "n": n.astype(np.int64)})

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > FLUSH // 2:
            yield from out()
    if held:
        yield from out()


@dataclass
class LanguageModel:
    langs: list[str]
    prior: list[float]
    near: tuple[list[str], np.ndarray]  # the most frequent words and their log frequencies, a row each
    words: DataFrame | None = None  # word, v: of all words
    grams: dict[int, DataFrame] | None = None  # by length: gram, v


def _vectors(counts: DataFrame, key: str, langs: list[str]) -> DataFrame:
    """key, v: logs of add-half smoothed shares in each language, over all counted keys."""
    total = counts.agg(F.count("*"), *[F.sum(F.get("c", F.lit(i))) for i in range(len(langs))]).first()
    return counts.select(key, F.array(*[F.log((F.get("c", F.lit(i)) + 0.5) / ((total[i + 1] or 0) + 0.5 * total[0]))
                                        for i in range(len(langs))]).alias("v"))


def _frequent(words: DataFrame, langs: list[str], near_mb: float) -> DataFrame:
    """The words of each language whose counts lie above a border, chosen from counts of counts: nothing is sorted.

    A word takes about 64 bytes and a number for each language. Counts are in steps of a sixteenth of a doubling; a step that does not fit
    whole stays out, and its words are joined like all others.
    """
    room = near_mb * 1e6 / len(langs) / (64 + 8 * len(langs))
    step = F.floor(F.log2("n") * 16).alias("step")
    border, taken = {}, Counter()
    for r in words.groupBy("lang", step).count().orderBy(F.desc("step")).collect():
        if border.get(r["lang"], (0, True))[1]:
            taken[r["lang"]] += r["count"]
            fits = taken[r["lang"]] <= room
            border[r["lang"]] = (r["step"] if fits else r["step"] + 1, fits)
    borders = words.sparkSession.createDataFrame([(x, int(at)) for x, (at, _) in border.items()], "lang string, border bigint")
    return words.join(F.broadcast(borders), "lang").filter(step >= F.col("border")).select("word").distinct()


def fit(docs: DataFrame, near_mb: float = 24) -> LanguageModel:
    """Counts over all rows with a text and a language; ``near_mb`` bounds the words that are broadcast."""
    pairs = docs.filter("text is not null and lang is not null").select("text", "lang")
    counted = (pairs.mapInPandas(_count_words, "lang string, word string, n bigint")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    words = save(counted, "language-words")
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return LanguageModel([], [], ([], np.zeros((0, 0))))
    prior = [float(np.log(totals[x] / max(sum(totals.values()), 1))) for x in langs]
    by_lang = F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) for x in langs]).alias("c")
    vectors = _vectors(save(words.groupBy("word").agg(by_lang), "language-word-counts"), "word", langs)
    near = vectors.join(_frequent(words, langs, near_mb), "word").toArrow()
    near = (near["word"].to_pylist(), near["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs)))
    grams = words.mapInPandas(_count_grams, "lang string, size int, gram string, n bigint").groupBy("size", "gram").agg(by_lang)
    grams = save(grams, "language-grams")
    return LanguageModel(langs, prior, near, vectors,
                         {size: _vectors(grams.filter(F.col("size") == size), "gram", langs) for size in range(1, LONGEST + 1)})


def _scored_words(words: DataFrame, model: LanguageModel) -> DataFrame:
    """word, v for distinct words: counted ones by their own vector, others by their longest counted n-grams."""
    found = save(words.join(model.words, "word", "left"), "language-found")
    out, pending = found.filter("v is not null"), found.filter("v is null").select("word")
    for size in range(LONGEST, 0, -1):
        marked = F.concat(F.lit("^"), "word", F.lit("$")) if size > 1 else F.col("word")
        last = F.length(marked) - (size - 1)
        pieces = pending.filter(last > 0).select("word", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(marked, i, F.lit(size)))).alias("gram"))
        weight = F.lit(BACKOFF ** (LONGEST + 1 - size)) / F.count("*")
        hits = pieces.join(model.grams[size], "gram").groupBy("word").agg(
            F.array(*[F.sum(F.get("v", F.lit(i))) * weight for i in range(len(model.langs))]).alias("v"))
        hits = save(hits, "language-backoff")
        out, pending = out.unionByName(hits), pending.join(hits.select("word"), "word", "left_anti")
    return out


def predict(docs: DataFrame, model: LanguageModel, cache_tokens: int = 300_000) -> DataFrame:
    """doc_id, lang_pred, score for every row; texts are read whole."""
    size = len(model.langs)
    if not size:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # plain containers: a broadcast value is unpickled by name
    shared = docs.sparkSession.sparkContext.broadcast(model.near)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, logs = shared.value
        near = dict(zip(known, range(len(known))))
        place: dict[str, int] = {}
        others: dict[str, list[str]] = {}  # words of a token that are not broadcast
        vectors = np.zeros((0, size))

        def total(tokens: list[str], rest: Counter) -> np.ndarray:
            nonlocal vectors
            new = [t for t in dict.fromkeys(tokens) if t not in place]
            if len(place) + len(new) > cache_tokens:
                place.clear()
                others.clear()
                new, vectors = list(dict.fromkeys(tokens)), vectors[:0]
            if len(place) + len(new) > len(vectors):
                grown = np.zeros((max(2 * (len(place) + len(new)), 1024), size))
                grown[:len(vectors)] = vectors
                vectors = grown
            for token in new:
                vector = np.zeros(size)
                for word in words_in(token):
                    if word in near:
                        vector = vector + logs[near[word]]
                    else:
                        others.setdefault(token, []).append(word)
                vectors[len(place)] = vector
                place[token] = len(place)
            for token in tokens:
                if token in others:
                    rest.update(others[token])
            return vectors[np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))].sum(axis=0)

        for batch in batches:
            found = []
            for text in batch["text"]:
                tokens, rest = text.lower().split() if text is not None else [], Counter()
                sums = sum((total(tokens[lo:lo + 50_000], rest) for lo in range(0, len(tokens), 50_000)), np.zeros(size))
                letters = bool(rest) or bool(sums.any()) or any(map(words_in, tokens))
                found.append((sums.tolist(), letters, list(rest), list(rest.values())))
            yield pd.DataFrame({"doc_id": batch["doc_id"], **{c: plain([f[i] for f in found]) for i, c in enumerate(("sums", "letters", "rest", "times"))}})

    read = docs.select("doc_id", "text").mapInPandas(score, "doc_id bigint, sums array<double>, letters boolean, rest array<string>, times array<bigint>")
    read = save(read.withColumn("row", F.monotonically_increasing_id()), "language-read")
    rest = read.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("n"))
    scored = _scored_words(rest.select("word").distinct(), model)
    joined = rest.join(scored, "word").groupBy("row").agg(F.array(*[F.sum(F.col("n") * F.get("v", F.lit(i))) for i in range(size)]).alias("more"))
    out = read.select("row", "doc_id", "sums", "letters").join(joined, "row", "left")
    out = out.withColumn("all", F.array(*[F.get("sums", F.lit(i)) + F.coalesce(F.get("more", F.lit(i)), F.lit(0.0)) + model.prior[i] for i in range(size)]))
    out = out.withColumn("most", F.array_max("all"))
    share = 1 / F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    name = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("all", F.col("most")).cast("int"))
    return out.select("doc_id", F.when(F.col("letters"), name).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), share).otherwise(0.0).alias("score"))
