"""Order-dependent operators against brute force, with one key owning most of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators.dedupe import reject_duplicates
from plumbline.operators.evidence import first_values, list_text, pages
from plumbline.operators.joins import best_mention, join_null_safe, lookup
from plumbline.operators.ordered import previous, running_total, trailing, with_position


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", i, rng.randrange(100)) for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t long, v long").repartition(6)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("order", [["t"], ["v", "t"]])
def test_keep_first(spark, skewed, broadcast_bytes, order):
    rows, df = skewed
    rows = [(None if k == "k1" else k, t, v) for k, t, v in rows]
    df = df.withColumn("k", F.when(F.col("k") != "k1", F.col("k")))
    marked = reject_duplicates(df, "k", order, (F.col("v") == 3, "bad value"), broadcast_bytes)
    place = {"t": 1, "v": 2}
    first = {}
    for row in rows:
        if row[0] is not None and row[2] != 3:
            spot = tuple(row[place[c]] for c in order)
            first[row[0]] = min(first.get(row[0], spot), spot)
    expected = {}
    for row in rows:
        spot = tuple(row[place[c]] for c in order)
        expected[row[1]] = ("bad value" if row[2] == 3 else "missing primary key k" if row[0] is None
                            else None if first[row[0]] == spot else "duplicate primary key k")
    got = {r.t: r._reject_reason for r in marked.collect()}
    assert got == expected


def test_positions(skewed):
    rows, df = skewed
    placed = with_position(df, ["k"], ["t"], partitions=5)
    expected = {}
    for k, t, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        expected[t] = sum(1 for x in expected.values() if x[0] == k) + 1, k
        expected[t] = (k, expected[t][0])
    assert {r.t: (r.k, r._n) for r in placed.collect()} == expected


def test_trailing_matches_plain_window(skewed):
    _, df = skewed
    window = Window.partitionBy("k").orderBy("t").rowsBetween(-7, -1)
    plain = {r.t: (r.n, r.m) for r in df.withColumn("n", F.count("v").over(window)).withColumn("m", F.avg("v").over(window)).collect()}
    blocked = trailing(df, ["k"], ["t"], 7, {"n": F.count("v"), "m": F.avg("v")}, block_rows=50, partitions=5)
    assert {r.t: (r.n, r.m) for r in blocked.collect()} == plain


def test_previous_and_running_total(skewed):
    _, df = skewed
    by_time = Window.partitionBy("k").orderBy("t")
    total = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = {r.t: (r.p, r.s) for r in df.withColumn("p", F.lag("v").over(by_time)).withColumn("s", F.sum("v").over(total)).collect()}
    placed = with_position(df, ["k"], ["t"], partitions=5)
    both = running_total(previous(placed, ["k"], ["v"], block_rows=40), ["k"], "v", "s", block_rows=40)
    assert {r.t: (r.previous_v, r.s) for r in both.collect()} == plain


@pytest.mark.parametrize("most", [100, 1])
def test_mentions_are_substring_search(spark, most):
    names = ["gold_a", "gold_ab", "b", "silver", "absent"]
    texts = ["late gold_ab load", "gold_a", "xgold_abx and silver", "nothing here", "ab"]
    left = spark.createDataFrame([(i % 2, i, t) for i, t in enumerate(texts)], "g int, i int, text string")
    right = spark.createDataFrame([(g, n) for g in (0, 1) for n in names], "g int, name string")
    got = {(r.g, r.name): r.i for r in best_mention(left, "text", "i", right, "name", ["g"], most).collect()}
    expected = {}
    for i, text in enumerate(texts):
        for name in names:
            if name in text:
                expected[i % 2, name] = i
    assert got == expected


def test_first_values_counts_everything(spark, skewed):
    rows, df = skewed
    got = {r.k: r for r in first_values(df, ["k"], "t", size=5).collect()}
    for key in {r[0] for r in rows}:
        mine = sorted(str(r[1]) for r in rows if r[0] == key)
        assert got[key].value_count == len(mine) and got[key].value_list == mine[:5]


def test_pages_hold_every_value_once(spark, skewed):
    rows, df = skewed
    got = {}
    for r in pages(df, ["k"], "t", size=7).orderBy("k", "page").collect():
        assert len(r.value_list) == r.value_count <= 7 and (r.value_list[0], r.value_list[-1]) == (r.first_value, r.last_value)
        assert r.page == len(got.get(r.k, [])) // 7 + 1
        got.setdefault(r.k, []).extend(r.value_list)
    assert got == {key: sorted({str(r[1]) for r in rows if r[0] == key}) for key in {r[0] for r in rows}}
    long = spark.createDataFrame([(["a", "b"], 5), (["a"], 1), (None, None)], "v array<string>, n int")
    assert [r[0] for r in long.select(list_text(F.col("v"), F.col("n"))).collect()] == ["a, b, ... (5 values in all)", "a", ""]


def test_null_safe_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert {tuple(r) for r in join_null_safe(left, right, ["k"]).collect()} == {(None, 1, 10), ("a", 2, 20)}


@pytest.mark.parametrize("most", [1000, 3])
def test_lookup_broadcast_or_salted(spark, skewed, most):
    rows, df = skewed
    names = sorted({r[0] for r in rows})[:-1]
    right = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, w int")
    got = {r.t: r.w for r in lookup(df, right, "k", ["t"], most=most, salts=4).collect()}
    assert got == {t: (names.index(k) if k in names else None) for k, t, _ in rows}


def test_rows_are_not_shuffled_when_few_keys_repeat(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("t"))
    plan = reject_duplicates(df, "k", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_keep_first_builds_the_rows_once_for_the_first_positions(spark):
    """With a long list of repeated keys, the first positions are read back and not aggregated from the rows again."""
    df = spark.range(2000).selectExpr("cast(id % 700 as string) as k", "id as t")
    marked = reject_duplicates(df, "k", ["t"], broadcast_bytes=0)
    assert "Aggregate" not in marked._jdf.queryExecution().executedPlan().toString()
    assert {r["t"] for r in marked.where("_reject_reason is null").collect()} == set(range(700))
