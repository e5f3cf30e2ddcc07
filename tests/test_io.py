"""Readers, writers and the streaming ingest on temporary files."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import write_landing
from plumbline.config import SOURCES
from plumbline.operators.dedupe import split
from plumbline.operators.incremental import refresh_revenue, upsert
from plumbline.plans import governance, marts
from plumbline.sinks import export, lake
from plumbline.sources import landing
from plumbline.streaming import ingest


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)


def test_files_with_different_headers_do_not_mix(spark, tmp_path):
    root = write_landing(str(tmp_path))
    groups = landing.read_landing(spark, f"{root}/ecommerce_transactions/*")
    assert [len(g.columns) for g in groups] == [8, 9]
    rows = {r.transaction_id or r.order_id: r for r in landing.union_groups(groups).collect()}
    assert rows["N2101"].amount == "84.25" and rows["N2101"].order_value is None
    assert rows["N2105"].order_value == "18.40" and rows["N2105"].coupon_code == "TWENTY"
    assert rows["N2105"]._source_file == "orders_0507_v2.csv"


def test_quoted_header_and_values(spark, tmp_path):
    put(f"{tmp_path}/a/x.csv", '"Order ID","Note, long"\n1,"a ""quoted"", text"\n')
    (group,) = landing.read_landing(spark, f"{tmp_path}/a/*")
    assert group.columns == ["Order ID", "Note, long"]
    row = landing.union_groups([group]).first()
    assert (row.order_id, row.note_long) == ("1", 'a "quoted", text')


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(f"{tmp_path}/a/x %41 y.csv", 'id,note\n1,"two\nlines"\n2,b\n')
    put(f"{tmp_path}/a/z.csv", 'id,note\n3,c\n')
    groups = landing.read_landing(spark, f"{tmp_path}/a/*")
    rows = landing.union_groups(groups).collect()
    assert sorted((r.id, r.note) for r in rows) == [("1", "two\nlines"), ("2", "b"), ("3", "c")]


@pytest.mark.parametrize("text", ['[{"a": 1, "b": true}, {"a": 2}]', '{"records": [{"a": 1, "b": true}, {"a": 2}]}'])
def test_json_shapes(spark, tmp_path, text):
    put(f"{tmp_path}/a/x.json", text)
    (group,) = landing.read_landing(spark, f"{tmp_path}/a/*")
    rows = group.rows.orderBy(*landing.FILE_ORDER).select("a", "b").collect()
    assert [tuple(r) for r in rows] == [("1", "true"), ("2", None)]


@pytest.mark.parametrize("shape", ["%s", '{"records": %s}'])
def test_several_json_documents(spark, tmp_path, shape):
    for file in "xyz":
        put(f"{tmp_path}/a/{file}.json", shape % json.dumps([{"a": f"{file}{i}"} for i in range(3)]))
    (group,) = landing.read_landing(spark, f"{tmp_path}/a/*")
    rows = group.rows.orderBy(*landing.FILE_ORDER).collect()
    assert [(r.a, r._source_file) for r in rows] == [(f"{file}{i}", f"{file}.json") for file in "xyz" for i in range(3)]


def test_json_of_another_shape_raises(spark, tmp_path):
    put(f"{tmp_path}/a/x.json", '{"rows": 1}')
    with pytest.raises(ValueError, match="Unsupported JSON shape"):
        landing.read_landing(spark, f"{tmp_path}/a/*")


def test_jsonl_skips_blank_lines(spark, tmp_path):
    put(f"{tmp_path}/a/x.jsonl", '{"a": 1}\n\n{"a": 2.5, "c": "z"}\n')
    (group,) = landing.read_landing(spark, f"{tmp_path}/a/*")
    assert sorted(tuple(r) for r in group.rows.select("a", "c").collect()) == [("1", None), ("2.5", "z")]


def test_unknown_suffix_raises(spark, tmp_path):
    put(f"{tmp_path}/a/x.xml", "<a/>")
    with pytest.raises(ValueError, match="Unsupported source extension: .xml"):
        landing.read_landing(spark, f"{tmp_path}/a/*")


def test_no_files(spark, tmp_path):
    assert landing.read_landing(spark, f"{tmp_path}/none/*") == []


def test_raw_whitelist(spark):
    df = spark.createDataFrame([("T", "x", 5)], "`Order ID` string, stray string, amount int")
    raw = landing.raw_table(df, SOURCES["ecommerce_transactions"])
    assert raw.columns[:3] == ["transaction_id", "order_id", "customer_id"] and "stray" not in raw.columns
    row = raw.first()
    assert (row.order_id, row.amount, row.customer_id) == ("T", "5", None)


def test_tolerant_readers(spark, tmp_path):
    missing = landing.read_csv_or_empty(spark, f"{tmp_path}/no.csv", ["a", "b"])
    assert missing.columns == ["a", "b"] and missing.count() == 0
    put(f"{tmp_path}/rej/x_rejected.jsonl", '{"a": 1}\n\nnot json\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = landing.read_rejected(spark, f"{tmp_path}/rej", schema).collect()
    assert sorted((r.source_file, r.a, r.raw_line) for r in rows if r.a) == [("x_rejected.jsonl", 1, None)]
    assert [r.raw_line for r in rows if r.a is None] == ["not json"]
    assert landing.read_jsonl_tolerant(spark, f"{tmp_path}/none.jsonl", schema).count() == 0


def test_required_columns_raise(spark, tmp_path):
    put(f"{tmp_path}/s.csv", "transaction_id,amount\nT,1\n")
    with pytest.raises(ValueError, match="order_ts"):
        landing.read_silver_csv(spark, f"{tmp_path}/s.csv", {"transaction_id", "order_ts"})


def test_api_pages(spark):
    ticket = {"customer_id": "c1", "created_ts": "2026-05-11T09:15:00Z", "priority": "High", "status": "open", "topic": "x"}
    pages = [
        {"request_id": "r1", "next_page_token": "p2", "tickets": [{**ticket, "ticket_id": "a"}, {**ticket, "ticket_id": "b"}]},
        {"request_id": "r2", "next_page_token": None, "tickets": [{**ticket, "ticket_id": "c", "priority": "urgent"}, {**ticket, "ticket_id": ""}]},
    ]
    df = spark.createDataFrame([(json.dumps(p),) for p in pages], "v string").select(
        F.from_json("v", landing.PAGE_SCHEMA).alias("p")).select("p.*")
    good, bad = split(landing.ticket_rows(df, "b", "now"))
    assert (good.count(), [r._reject_reason for r in bad.collect()]) == (3, ["missing required field ticket_id"])
    assert landing.request_log(df, "now").agg(F.sum("record_count")).first()[0] == 4


def test_partition_paths():
    assert lake.partition_path("root", "bronze", "ecommerce transactions", "2026-05-10", "batch/001") == \
        "root/bronze/source_system=ecommerce_transactions/load_date=2026-05-10/batch_id=batch_001"
    assert lake.partition_path("root", "gold", "g", "2026-05-10") == "root/gold/dataset=g/load_date=2026-05-10"
    for layer, name in (("raw", "x"), ("bronze", ""), ("gold", None)):
        with pytest.raises(ValueError):
            lake.partition_path("root", layer, name, "2026-05-10")
    assert lake.partition_value("  ") == "unknown"


def test_layer_write_and_manifest(spark, tmp_path):
    full = lake.write_layer(spark.range(3), str(tmp_path), "gold", "g", "2026-05-10", "b1")
    empty = lake.write_layer(spark.range(0), str(tmp_path), "gold", "e", "2026-05-10", "b1")
    assert (full.status, full.row_count, empty.status) == ("written", 3, "skipped")
    table = lake.manifest(spark, [full, empty])
    assert tuple(lake.manifest_counts(table).first()) == (1, 1)
    back = lake.read_layer(spark, str(tmp_path), "gold")
    assert set(back.columns) == {"id", "dataset", "load_date", "batch_id"} and back.count() == 3


def test_load_log_and_sorted_csv(spark, tmp_path):
    for batch in ("b1", "b2"):
        lake.append_load_log(spark, f"{tmp_path}/log", [{"batch_id": batch, "row_count": 1, "other": 9}])
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.columns == lake.LOAD_LOG_COLUMNS and log.count() == 2
    lake.write_sorted_csv(spark.createDataFrame([(1, 2)], "b int, a int"), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["a", "b"]


def test_insert_if_absent_and_tables(spark, tmp_path):
    path = f"{tmp_path}/alerts"
    first = spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int")
    again = spark.createDataFrame([("b", 2), ("c", 2), ("c", 2)], "id string, n int")
    assert lake.append_absent(spark, first, path, "id") == 2
    assert lake.append_absent(spark, again, path, "id") == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 1), ("c", 2)]
    for rows in (first, again):
        lake.materialize(rows, "plumbline_load", "table")
    assert spark.table("plumbline_load").count() == 3
    lake.materialize(first, "plumbline_view", "view")
    assert spark.table("plumbline_view").count() == 2


def test_replace_partitions_touches_only_its_days(spark, tmp_path):
    path = f"{tmp_path}/daily"
    lake.replace_partitions(spark.createDataFrame([("d1", 1), ("d2", 1)], "day string, n int"), path, "day")
    lake.replace_partitions(spark.createDataFrame([("d2", 5)], "day string, n int"), path, "day")
    assert sorted((r.day, r.n) for r in spark.read.parquet(path).collect()) == [("d1", 1), ("d2", 5)]


def revenue_inputs(spark, rows):
    orders = spark.createDataFrame(rows, "transaction_id string, day string, amount double").select(
        "transaction_id", F.col("day").cast("timestamp_ntz").alias("order_ts"),
        F.col("amount").cast("decimal(18,4)").alias("amount"), F.lit("completed").alias("status"))
    targets = spark.createDataFrame([("2026-01-01", 10.0, 1)], "target_date string, revenue_target double, orders_target long")
    return orders, targets.withColumn("target_date", F.col("target_date").cast("date"))


def test_incremental_lookback_sees_late_rows(spark):
    early, targets = revenue_inputs(spark, [("a", "2026-01-01", 5.0), ("b", "2026-01-03", 1.0)])
    mart = marts.gold_revenue_analytics(early, targets)
    late, _ = revenue_inputs(spark, [("a", "2026-01-01", 5.0), ("b", "2026-01-03", 1.0), ("l", "2026-01-02", 7.0), ("n", "2026-01-04", 2.0)])
    def days(lookback):
        return {str(r.order_date): r.gross_revenue for r in refresh_revenue(mart, late, targets, lookback).collect()}
    assert days(0) == {"2026-01-01": 5.0, "2026-01-03": 1.0, "2026-01-04": 2.0}
    assert days(1) == {"2026-01-01": 5.0, "2026-01-02": 7.0, "2026-01-03": 1.0, "2026-01-04": 2.0}
    assert upsert(mart, mart, "order_date").count() == mart.count()


def test_flat_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(["a", "b"], [("x", 1)], {"k": "v"}, None, 2.5)],
        "l array<string>, s array<struct<n:string,v:int>>, m map<string,string>, e string, d double")
    row = export.flatten(df, ["l", "s", "m", "e", "d", "gone"]).first()
    assert tuple(row) == ("a;b", '[{"n":"x","v":1}]', '{"k":"v"}', "", "2.5", "")
    manifest = export.write_exports(spark, {
        "full": export.Export("src", ["d"], lambda: df), "none": export.Export("src2", ["a"], lambda: None)}, str(tmp_path))
    assert {r.file: (r.status, r.row_count) for r in manifest.collect()} == {
        "full": ("written", 1), "none": ("empty_source_missing", 0)}
    rows = export.warehouse_rows(df.withColumn("v", F.lit("")), ["l", "v", "gone"], optional_text=("v",)).first()
    assert tuple(rows) == ('["a","b"]', None, None)


def test_sizes_and_audit(spark, tmp_path):
    put(f"{tmp_path}/gold/a.csv", 'x,y\n1,"two\nlines"\n2,b\n')
    put(f"{tmp_path}/gold/deep/b.jsonl", '{"a":1}\n\n{"a":2}\n')
    sizes = governance.file_sizes(spark, "gold", f"{tmp_path}/gold")
    cost = governance.storage_cost(sizes).first()
    assert cost.file_count == 2 and cost.size_bytes == sum(os.path.getsize(p) for p in (f"{tmp_path}/gold/a.csv", f"{tmp_path}/gold/deep/b.jsonl"))
    audit = governance.audit_files(spark, f"{tmp_path}/gold").collect()
    assert len(audit) == 2 and all(len(r.sha256) == 64 for r in audit)
    assert governance.audit_rows(spark, f"{tmp_path}/gold", "csv").first().row_count == 2
    assert governance.audit_rows(spark, f"{tmp_path}/gold", "jsonl").first().row_count == 2


def test_stream_ingest_picks_up_new_files_once(spark, tmp_path):
    land, bronze, mark = (f"{tmp_path}/{n}" for n in ("land", "bronze", "mark"))
    columns = ["id", "v"]

    def run():
        stream = ingest.stream_landing(spark, land, "csv", columns)
        ingest.ingest_available(stream, "src", bronze, mark, "2026-05-10", "now").awaitTermination(120)

    put(f"{land}/a.csv", "id,v\n1,a\n2,b\n")
    run()
    put(f"{land}/b.csv", "id,v\n3,c\n")
    run()
    run()
    rows = spark.read.parquet(bronze)
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "3"]
    assert {r.batch_id for r in rows.collect()} == {"src-00000000", "src-00000001"}
    assert {"_source_file", "_ingested_at"} <= set(rows.columns)


def test_stream_dedupe(spark, tmp_path):
    put(f"{tmp_path}/in/a.json", '{"id":"x","t":"2026-01-01 00:00:00"}\n{"id":"x","t":"2026-01-01 00:01:00"}\n{"id":"y","t":"2026-01-01 00:02:00"}\n')
    stream = spark.readStream.schema("id string, t timestamp").json(f"{tmp_path}/in")
    query = (
        ingest.dedupe_within(stream, "id", "t", "10 minutes").writeStream.format("memory")
        .queryName("plumbline_dedupe").trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert sorted(r.id for r in spark.table("plumbline_dedupe").collect()) == ["x", "y"]


@pytest.mark.parametrize("kind", ["json", "records", "jsonl"])
def test_each_json_file_has_its_own_keys(spark, tmp_path, kind):
    """Files read into one frame are judged by the keys that they have, null values included."""
    from plumbline.config import SOURCES
    from plumbline.operators import contract, drift

    good = {"ticket_id": "T1", "User ID": "C1", "created_ts": "2026-05-10T00:00:00Z", "priority": "low", "status": "open"}
    files = {"a": [good], "b": [{**{k: v for k, v in good.items() if k != "priority"}, "topic": None}], "c": [good, {**good, "ticket_id": "T2", "extra": 1.50}]}
    for name, records in files.items():
        text = "\n".join(map(json.dumps, records)) if kind == "jsonl" else json.dumps(records if kind == "json" else {"records": records}, indent=1)
        put(f"{tmp_path}/t/{name}.{'jsonl' if kind == 'jsonl' else 'json'}", text)
    group, = landing.read_landing(spark, f"{tmp_path}/t/*")
    rows = group.rows.withColumnsRenamed({c: landing.normalize_name(c) for c in group.columns})
    got = {r["_source_file"][0]: r for r in contract.contract_reports(rows, SOURCES["crm_support"], ["_source_file"], keys=group.keys).collect()}
    found = {name: {v.check_name for v in r.violations} for name, r in got.items()}
    assert found == {"a": set(), "b": {"required_columns_present", "null_threshold_priority"}, "c": {"unexpected_columns"}}
    assert got["b"].observed_columns == ["created_ts", "customer_id", "status", "ticket_id", "topic"] and got["a"].safe_renames_applied == {"user_id": "customer_id"}
    assert got["c"].violations[0].observed_value == '["extra"]' and [got[x].status for x in "abc"] == ["PASS", "FAIL", "WARNING"]
    fields = {(r["_source_file"][0], r.column_name) for r in drift.infer_schema(rows, ["_source_file"], keys=group.keys).collect()}
    assert ("b", "topic") in fields and ("a", "topic") not in fields and ("c", "extra") in fields and ("b", "priority") not in fields


def test_json_documents_land_flat_one_document_a_file(spark, tmp_path, monkeypatch):
    """Each stretch of 500 events lands as one file in one folder, with no folder per document to discover."""
    from plumbline.catalog import files

    rows = spark.createDataFrame(
        [(i, f"2024-01-01 00:00:{i % 60:02d}", i % 40, "error", 1.0, f"p{i % 7}") for i in range(1203)],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.coalesce(1).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    seen = []
    read = landing.read_json_group
    monkeypatch.setattr(landing, "read_json_group", lambda s, paths, shape: seen.extend(paths) or read(s, paths, shape))
    result = {r.priority: r.tickets for r in files.landing_json_documents(spark, str(tmp_path / "sf")).collect()}
    assert sum(result.values()) == 1203
    root = seen[0].removeprefix("file:")
    names = [n for n in os.listdir(root) if not n.startswith((".", "_"))]
    assert all(not os.path.isdir(os.path.join(root, n)) for n in names)
    assert len(names) == 3
