"""Tables with versions, marts refreshed by what changed, and replays."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plumbline.plans import marts
from plumbline.plans.history import History, partition_changes
from plumbline.sinks import lake
from plumbline.sinks.versions import COMMIT, ConcurrentPublish, VersionedTable, folder_text
from plumbline.sources.bronze import enrich


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "n int, day string")


def only(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "day string")


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/table"


def test_versions_replace_only_named_partitions(spark, path):
    table = VersionedTable(spark, path, ("day",))
    assert table.version == 0 and table.inputs() == {}
    with pytest.raises(ValueError, match="no version"):
        table.read()
    odd = "a/b=c %x"
    assert table.append(days(spark, (1, "d1"), (2, "d2"), (3, None), (4, odd)), {"source": 7}) == 1
    first = table.manifest().collect()
    assert table.append(days(spark, (5, "d2"))) == 2 and table.inputs() == {}
    assert table.replace(days(spark, (6, "d2"), (7, None)), only(spark, "d2", None, "d9")) == 3
    assert rows_of(table.read()) == [(1, "d1"), (4, odd), (6, "d2"), (7, None)]
    assert rows_of(table.read(1)) == [(1, "d1"), (2, "d2"), (3, None), (4, odd)] and rows_of(table.read(2))[-1] == (5, "d2")
    kept = {(r["day"], r[COMMIT]) for r in first if r["day"] in ("d1", odd)}
    assert kept < {(r["day"], r[COMMIT]) for r in table.manifest().collect()}
    assert {r["day"] for r in table.changed(2, 3).collect()} == {"d2", None} and {r["day"] for r in table.changed(0, 1).collect()} == {"d1", "d2", None, odd}
    assert table.replace(days(spark, (1, "x")).where("false"), only(spark, "d1")) == 4
    assert rows_of(table.read()) == [(4, odd), (6, "d2"), (7, None)]
    assert rows_of(table.read(only=only(spark, "d2", "nothing"))) == [(6, "d2")] and table.read(only=only(spark, "zz")).count() == 0
    plan = table.read(only=only(spark, "d2"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["partition"]: r["rewritten"] for r in partition_changes(table, 2).collect()} == {odd: False, "d2": True, "null": True}


def test_a_failed_change_leaves_the_old_version(spark, path):
    table = VersionedTable(spark, path, ("day",))
    table.append(days(spark, (1, "d1"), (2, "d2")))
    broken = days(spark, (3, "d1")).withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("stop"))).cast("int"))
    with pytest.raises(PySparkException):
        table.replace(broken, only(spark, "d1"))
    with pytest.raises(ValueError, match="not replaced"):
        table.replace(days(spark, (3, "d1"), (4, "d2")), only(spark, "d1"))
    assert table.version == 1 and rows_of(table.read()) == [(1, "d1"), (2, "d2")]
    # the same commit id again: the staged folder is written anew
    assert table.replace(days(spark, (9, "d1")), only(spark, "d1"), commit_id="again") == 2
    assert rows_of(table.read()) == [(2, "d2"), (9, "d1")]


def test_two_writers_of_one_version_are_noticed(spark, path):
    one, two = VersionedTable(spark, path, ("day",)), VersionedTable(spark, path, ("day",))
    one.append(days(spark, (1, "d1")), commit_id="c1")
    entry = two._entry()
    two._entry = lambda version=None: entry if version is None else VersionedTable._entry(two, version)
    one.append(days(spark, (2, "d1")), commit_id="c2")
    with pytest.raises(ConcurrentPublish):
        two.append(days(spark, (3, "d1")), commit_id="c3")
    assert one.version == 2 and rows_of(one.read()) == [(1, "d1"), (2, "d1")]


def test_a_table_without_partitions_is_replaced_whole(spark, path):
    table = VersionedTable(spark, path)
    assert table.replace(days(spark, (1, "d1"))) == 1 and table.replace(days(spark, (2, "d1"), (3, "d2"))) == 2
    assert rows_of(table.read()) == [(2, "d1"), (3, "d2")] and rows_of(table.read(1)) == [(1, "d1")]
    assert folder_text("2024-01-01") == "2024-01-01" and folder_text("a:b") == "a%3Ab"


ORDER = "transaction_id string, customer_id string, product_id string, order_ts string, amount string, status string, _pos bigint"


def order(n, day, amount="10.00", status="completed"):
    return (f"T{n}", f"C{n % 3}", "P1", f"{day}T10:00:00Z", amount, status, n)


def bronze(spark, root, rows, batch, day="2024-05-01"):
    frame = spark.createDataFrame(rows, ORDER)
    lake.write_bronze(enrich(frame, "ecommerce_transactions", batch, f"{day}T00:00:00Z"), f"{root}/bronze", day, batch)


@pytest.fixture
def history(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    bronze(spark, root, [order(1, "2024-01-05"), order(2, "2024-02-05"), order(3, "2024-02-06", "-1")], "0001")
    bronze(spark, root, [order(4, "2024-03-05", "7.50"), order(5, "2024-03-05", "2.50", "refunded")], "0002", "2024-05-02")
    return History(spark, root, order=["_pos"])


def revenue_days(history):
    return {str(r.order_date): r.gross_revenue for r in history.gold("gold_revenue_analytics").read().collect()}


def test_late_rows_cost_their_own_months(spark, history):
    """A batch with late rows for January rewrites January and no other month; the mart equals a rebuild."""
    assert history.load_bronze("ecommerce_transactions") == ["0001", "0002"]
    assert history.refresh("gold_revenue_analytics") == 1 and history.refresh("gold_revenue_analytics") == 1
    assert revenue_days(history) == {"2024-01-05": 10.0, "2024-02-05": 10.0, "2024-03-05": 7.5}
    bronze(spark, history.root, [order(6, "2024-01-05", "5.00"), order(7, "2024-01-06", "1.00")], "0003", "2024-05-03")
    assert history.load_bronze("ecommerce_transactions", batch_id="0003") == ["0003"]
    assert {r.period for r in history.changed_periods("gold_revenue_analytics")[1].collect()} == {"2024-01"}
    assert history.refresh("gold_revenue_analytics") == 2
    assert revenue_days(history) == {"2024-01-05": 15.0, "2024-01-06": 1.0, "2024-02-05": 10.0, "2024-03-05": 7.5}
    changes = {r.partition: r.rewritten for r in partition_changes(history.gold("gold_revenue_analytics"), 1).collect()}
    assert changes == {"2024-01": True, "2024-02": False, "2024-03": False}
    whole = marts.gold_revenue_analytics(history.rows("ecommerce_transactions"), history.rows("targets_planning", 0))
    assert rows_of(whole) == rows_of(history.gold("gold_revenue_analytics").read().drop("period"))
    assert rows_of(history.rejected("ecommerce_transactions").read().select("transaction_id", "batch_id")) == [("T3", "0001")]


def test_a_replay_mends_one_batch_and_what_depends_on_it(spark, history):
    history.load_bronze("ecommerce_transactions")
    history.load("ecommerce_transactions", spark.createDataFrame([order(4, "2024-03-05", "999"), order(9, "2024-02-05", "1")], ORDER), "0002")  # spoilt
    history.refresh_all("ecommerce_transactions")
    assert revenue_days(history) == {"2024-01-05": 10.0, "2024-02-05": 11.0, "2024-03-05": 999.0}
    report = {(r.layer, r.dataset_name, r.partition): (r.row_count, r.rewritten) for r in history.replay("ecommerce_transactions", "2024-05-02").collect()}
    assert revenue_days(history) == {"2024-01-05": 10.0, "2024-02-05": 10.0, "2024-03-05": 7.5}
    silver = {k[2]: v for k, v in report.items() if k[0] == "silver"}
    # the spoilt row of February is gone with its partition
    assert silver == {"0001/2024-01": (1, False), "0001/2024-02": (1, False), "0002/2024-03": (2, True)}
    gold = {k[2]: v for k, v in report.items() if k[1] == "gold_revenue_analytics"}
    assert gold == {"2024-01": (1, False), "2024-02": (1, True), "2024-03": (1, True)}
    assert report["gold", "gold_customer_analytics", ""] == (2, True)
    with pytest.raises(ValueError, match="no bronze batch"):
        history.replay("ecommerce_transactions", batch_id="nothing")
    assert datetime.date(2024, 3, 5) in {r.target_date for r in history.gold("gold_target_vs_actual").read().collect()}


def test_a_large_partition_is_cut_over_several_tasks(spark, path):
    """A partition's rows go to several writing tasks, not all to one; reading back gives them all."""
    table = VersionedTable(spark, path, ("day",))
    rows = [(n, "d1" if n % 10 else "d2") for n in range(4000)] + [(7, "d1")] * 50 + [(None, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.append(spark.createDataFrame(rows, "n int, day string"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in table.read().select("n", "day").collect()), key=str) == sorted(rows, key=str)
    files = table.read().where("day = 'd1'").select(F.input_file_name()).distinct().count()
    assert files > 1
