"""Registered queries: control tables, alerts, gates, lineage, metrics and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog.registry import query
from plumbline.catalog.sources import customers, orders, revenue, silver
from plumbline.catalog.views import table, view
from plumbline.config import CLASSIFICATION, QUALITY_SUITES
from plumbline.operators import checks, drift, evidence, incremental
from plumbline.plans import alerts as alerting
from plumbline.plans import gates, governance, marts, metrics, observe
from plumbline.session import cut_lineage
from plumbline.sinks import export

AS_OF = "2024-02-01T00:00:00Z"
ON = ["run_id", "dataset_name"]


def ready_rows(spark, sf):
    return observe.readiness(view(spark, sf, "run_states"))


def volume_rows(ready):
    history = ready.select("run_id", "dataset_name", "evaluated_at", "row_count")
    return observe.row_count_anomalies(history, ["evaluated_at"])


def lineage_rows(spark, sf):
    return view(spark, sf, "lineage").select(
        "run_id", "job_name", F.array("in_1", "in_2").alias("inputs"), F.array("out_1").alias("outputs"))


def edge_rows(spark, sf):
    return governance.lineage_edges(lineage_rows(spark, sf))


def trust_rows(spark, sf, ready=None, edges=None):
    """Trust of all runs. Readiness is written out once: it has one row per run and mart and
    feeds the scores, the objectives, the volume check and the alert match."""
    ready = ready if ready is not None else cut_lineage(ready_rows(spark, sf))
    edges = edges if edges is not None else edge_rows(spark, sf)
    return observe.dataset_trust(
        ready, observe.gold_slos(ready), volume_rows(ready), governance.catalog_table(spark),
        observe.lineage_members(edges), view(spark, sf, "alerts"))


def run_rows(spark, sf):
    return run_states_of(view(spark, sf, "run_states"))


def run_states_of(states):
    both = (F.col("quality_status") == "failed") & (F.col("freshness_status") == "failed")
    totals = states.groupBy("run_id").agg(F.count_if(both).alias("failed"), F.sum("row_count").alias("total"))
    return totals.select(
        "run_id", F.when(F.col("failed") > 0, "failed").otherwise("passed").alias("semantic_status"),
        F.when(F.col("total") % 2 == 0, "passed").otherwise("failed").alias("reconciliation_status"),
        F.lit("passed").alias("pii_status"), F.lit("passed").alias("catalog_status"),
        (F.col("total") / 5.0).alias("duration_seconds"))


class Control:
    """Control tables of all runs, each written once and then read by every later step."""

    def __init__(self, spark, sf):
        self.ready = cut_lineage(ready_rows(spark, sf))
        self.slos = observe.gold_slos(self.ready)
        self.alerts = view(spark, sf, "alerts")
        self.edges = cut_lineage(edge_rows(spark, sf))
        self.trust = cut_lineage(trust_rows(spark, sf, self.ready, self.edges))
        self.runs = run_states_of(self.ready)
        self.findings = gates.certification_findings(self.runs, self.ready, self.slos, self.trust, self.alerts)
        self.certified = cut_lineage(gates.certify(self.runs, self.findings))
        self.facts = gates.run_facts(
            self.runs, self.ready, self.slos, self.alerts, self.trust, self.edges, self.certified)
        self.gates = gates.gate_rows(self.facts)


def gate_table(spark, sf):
    return Control(spark, sf).gates


def finding_rows(spark, sf):
    ready = cut_lineage(ready_rows(spark, sf))
    return gates.certification_findings(
        run_states_of(ready), ready, observe.gold_slos(ready), cut_lineage(trust_rows(spark, sf, ready)),
        view(spark, sf, "alerts"))


# -- readiness, volume, SLO, trust ----------------------------------------------------------

@query("OBS-1", """select run_id, dataset_name, row_count, quality_status, freshness_status, schema_status, readiness_score, readiness_status
    from readiness""")
def dataset_readiness(spark, sf):
    return ready_rows(spark, sf).select(
        *ON, "row_count", "quality_status", "freshness_status", "schema_status", "readiness_score", "readiness_status")


@query("OBS-2 WIN-2", """
    select dataset_name, evaluated_at, row_count, round(base, 2) as baseline_row_count, round(delta, 4) as delta_pct,
      case when seen > 0 and delta > 0.35 then 'failed' else 'passed' end as status
    from (select *, case when base = 0 then 0.0 else abs(row_count - base) / base end as delta
      from (select *, coalesce(mean, row_count::double) as base from (select *, count(*) over w as seen, avg(row_count) over w as mean
        from hourly_counts window w as (partition by dataset_name order by evaluated_at rows between 7 preceding and 1 preceding))))""")
def row_count_anomalies(spark, sf):
    history = view(spark, sf, "hourly_counts")
    return observe.row_count_anomalies(history, ["evaluated_at"]).select(
        "dataset_name", "evaluated_at", "row_count", "baseline_row_count", "delta_pct", "status")


@query("OBS-3 WIN-3 JN-14", """
    select c.source_system, c.owner, c.criticality_tier, last_load_time, last_load_time is not null as loaded,
      case when last_load_time is not null then 'passed' else 'failed' end as slo_status
    from contracts c left join (select source_system, max(load_time) as last_load_time from load_log group by 1) l using (source_system)""")
def source_slos(spark, sf):
    return observe.source_slos(observe.contract_table(spark), view(spark, sf, "load_log")).select(
        "source_system", "owner", "criticality_tier", "last_load_time", "loaded", "slo_status")


@query("OBS-3", """
    select c.source_system, case when epoch(timestamp '2024-01-31 12:00:00') - epoch(date_trunc('second', last_load_time)) <= freshness_sla_minutes * 60
      then 'passed' else 'failed' end as slo_status
    from contracts c left join (select source_system, max(load_time) as last_load_time from load_log group by 1) l using (source_system)""")
def source_slos_with_age(spark, sf):
    return observe.source_slos(
        observe.contract_table(spark), view(spark, sf, "load_log"), check_age=True, as_of="2024-01-31T12:00:00Z",
    ).select("source_system", "slo_status")


@query("OBS-3 SET-5", """select kind, entity, slo_status, count(*) as n from (
      select 'gold' as kind, dataset_name as entity, slo_status from gold_slos
      union all select 'source', c.source_system, case when l.source_system is not null then 'passed' else 'failed' end
      from contracts c left join (select distinct source_system from load_log) l using (source_system)) group by 1, 2, 3""")
def slo_outcomes(spark, sf):
    sources = observe.source_slos(observe.contract_table(spark), view(spark, sf, "load_log"))
    return observe.all_slos(sources, observe.gold_slos(ready_rows(spark, sf))).groupBy(
        "kind", "entity", "slo_status").agg(F.count(F.lit(1)).alias("n"))


@query("OBS-4 OBS-5 OBS-6 JN-10 JN-13 AGG-16", """select run_id, dataset_name, trust_score_overall, trust_score_band, reasons from trust""")
def dataset_trust(spark, sf):
    return trust_rows(spark, sf).select(
        *ON, "trust_score_overall", "trust_score_band", F.array_join("reason_codes", ";").alias("reasons"))


@query("OBS-4 PRJ-22 AGG-15", """select run_id, count(*) as dataset_count, count(*) filter (where trust_score_band = 'Trusted') as trusted_count,
      count(*) filter (where trust_score_band = 'Monitor') as monitor_count, count(*) filter (where trust_score_band = 'At Risk') as at_risk_count,
      count(*) filter (where trust_score_band = 'Blocked') as blocked_count from trust group by 1""")
def trust_rollup(spark, sf):
    return observe.trust_rollup(trust_rows(spark, sf))


@query("PRJ-22", """select run_id, dataset_name, c1::double as comp_readiness, c5::double as comp_slo_compliance, c9::double as comp_incident_history
    from trust_parts""")
def trust_components(spark, sf):
    pivoted = observe.component_columns(trust_rows(spark, sf).select(*ON, "score_components"))
    return pivoted.select(*ON, "comp_readiness", "comp_slo_compliance", "comp_incident_history")


@query("OBS-5 JN-10", """select run_id, dataset_name, cast(worst as int) as rank from worst_alerts""")
def worst_open_alerts(spark, sf):
    return observe.worst_alerts(view(spark, sf, "alerts"), ready_rows(spark, sf))


@query("OBS-6 JN-13", """select r.run_id, r.dataset_name from readiness r
    where (r.run_id, r.dataset_name) in (select (run_id, dataset_name) from lineage_members)""")
def datasets_in_lineage(spark, sf):
    members = observe.lineage_members(edge_rows(spark, sf))
    return ready_rows(spark, sf).join(members, ON, "left_semi").select(*ON)


@query("OBS-7 AGG-16 AGG-17", """
    select u.run_id, cast(round(
        cast(round(r.m * 100, 2) as decimal(9,4)) * 0.18 + cast(round(t.m, 2) as decimal(9,4)) * 0.12
        + (case when s.n = 0 then 100 else 60 end) * 0.13
        + (case l.release_status when 'approved' then 100 when 'conditional' then 50 else 25 end) * 0.13
        + (case c.st when 'passed' then 100 else 50 end) * 0.10 + (case u.semantic_status when 'passed' then 100 else 0 end) * 0.10
        + (case u.reconciliation_status when 'passed' then 100 else 0 end) * 0.09 + 100 * 0.075 + 100 * 0.075, 2) as double) as trust_score
    from runs u join (select run_id, avg(readiness_score) as m from readiness group by 1) r using (run_id)
    join (select run_id, cast(sum(cast(trust_score_overall as decimal(18,4))) as double) / count(*) as m from trust group by 1) t using (run_id)
    join (select run_id, count(*) filter (where slo_status = 'failed') as n from gold_slos group by 1) s using (run_id)
    join release l using (run_id)
    join (select run_id, case when count(*) filter (where status = 'blocked') > 0 then 'blocked' else 'passed' end as st from certified group by 1) c using (run_id)""")
def platform_scorecard(spark, sf):
    control = Control(spark, sf)
    release = gates.release_status(control.gates).select("run_id", "release_status")
    joined = control.facts.join(observe.mean_scores(control.ready, control.trust), "run_id").join(release, "run_id")
    return observe.platform_scorecard(joined).select("run_id", "trust_score")


# -- alerts ---------------------------------------------------------------------------------

@query("OBS-8", """
    select run_id, alert_type, severity, dataset_name from (
      select run_id, 'quality_failure' as alert_type, 'critical' as severity, dataset_name from readiness where quality_status = 'failed'
      union all select run_id, 'gold_dataset_not_ready', 'critical', dataset_name from readiness where readiness_status <> 'ready'
      union all select run_id, 'row_count_anomaly', 'high', dataset_name from volume where status = 'failed'
      union all select run_id, 'rejected_records', 'high', source_system from (
        select run_id, source_system, sum(rejected_count) as n from load_log group by 1, 2) where n > 0)""")
def derived_alerts(spark, sf):
    ready = cut_lineage(ready_rows(spark, sf))
    rejects = view(spark, sf, "load_log").groupBy("run_id", F.col("source_system").alias("dataset_name")).agg(
        F.sum("rejected_count").alias("rejected_count"))
    return alerting.derive_alerts(
        AS_OF, rejects=rejects, summary=ready, anomalies=volume_rows(ready), ready=ready,
    ).select("run_id", "alert_type", "severity", "dataset_name")


@query("OBS-9 JN-12", """
    select r.route, a.alert_id, a.severity, upper(a.severity) || ' ' || a.alert_type || ' on ' || a.dataset_name || ': ' || a.business_impact as message
    from alerts a join routes r on r.severity = case when a.severity in ('critical', 'high', 'medium') then a.severity else 'low' end
    where a.resolution_status = 'open'""")
def routed_notifications(spark, sf):
    return alerting.route_alerts(view(spark, sf, "alerts"), AS_OF).select("route", "alert_id", "severity", "message")


@query("AGG-14 FLT-5", "select severity, count(*) as alert_count from alerts where resolution_status = 'open' group by 1")
def open_alert_severities(spark, sf):
    return alerting.severity_counts(view(spark, sf, "alerts"))


@query("SRT-2 SRT-1", "select timestamp, alert_id, severity from alerts order by timestamp desc, alert_id desc limit 25")
def recent_alerts(spark, sf):
    return alerting.recent_alerts(view(spark, sf, "alerts"), 25).select("timestamp", "alert_id", "severity")


@query("AGG-14 FLT-5", """
    select 'open_alerts' as measure, count(*) as value from alerts where resolution_status = 'open'
    union all select 'critical_alerts', count(*) from alerts where resolution_status = 'open' and severity = 'critical'
    union all select 'failed_slos', count(*) from gold_slos where slo_status = 'failed'
    union all select 'datasets_at_risk', count(*) from readiness where readiness_status <> 'ready'""")
def incident_summary(spark, sf):
    ready = ready_rows(spark, sf)
    return alerting.incident_summary(view(spark, sf, "alerts"), observe.gold_slos(ready), ready)


# -- gates, exceptions, certification, remediation ------------------------------------------

@query("OBS-10 FLT-5", "select run_id, gate_name, status, severity from gates")
def release_gates(spark, sf):
    return gate_table(spark, sf).select("run_id", "gate_name", "status", "severity")


@query("OBS-10", "select * from release")
def release_decisions(spark, sf):
    return gates.release_status(gate_table(spark, sf)).drop("publish_decision")


EXCEPTION_ROWS = [
    ("EX-1", "active", "high_alert_gate", "2024-12-31T23:59:59+00:00"),
    ("EX-2", "active", "slo_gate", "2023-12-31T23:59:59+00:00"),
    ("EX-3", "retired", "*", "2024-12-31T23:59:59+00:00"),
    ("EX-4", "active", "runtime_gate", "2024-02-01T00:00:00+00:00"),
]


@query("OBS-11 FLT-6 JN-11", """
    select run_id, gate_name, status as gate_status, severity as gate_severity,
      gate_name in ('high_alert_gate', 'runtime_gate') as exception_applied,
      cast(case when gate_name in ('high_alert_gate', 'runtime_gate') then 1 else 0 end as bigint) as exception_count,
      case gate_name when 'high_alert_gate' then 'EX-1' when 'runtime_gate' then 'EX-4' else '' end as exception_ids
    from gates where status <> 'passed'""")
def gate_exceptions(spark, sf):
    register = gates.exception_table(spark, EXCEPTION_ROWS)
    return gates.apply_exceptions(gate_table(spark, sf), register, AS_OF).withColumn(
        "exception_ids", F.array_join("exception_ids", ";"))


@query("OBS-11 AGG-12", """
    with register as (select alert_id as exception_id, case when alert_id like '%7' then 'slo_gate' else '*' end as gate_name from alerts), ranked as (
      select run_id, g.gate_name, exception_id, row_number() over (partition by run_id, g.gate_name order by exception_id) as n
      from gates g join register r on r.gate_name = '*' or r.gate_name = g.gate_name where g.status <> 'passed')
    select run_id, gate_name, cast((n - 1) // 50 + 1 as int) as page, count(*) as value_count, min(exception_id) as first_value,
      max(exception_id) as last_value from ranked group by all""")
def exceptions_per_gate(spark, sf):
    """All exceptions that cover a gate, in pages: one for each alert, most of them for every gate.

    Which exceptions cover a gate depends on its name alone, so the pages are made once per gate
    name and then given to every gate of that name, not made from every pair of gate and alert.
    """
    register = view(spark, sf, "alerts").select(
        F.col("alert_id").alias("exception_id"), F.lit("active").alias("status"),
        F.when(F.col("alert_id").endswith("7"), "slo_gate").otherwise("*").alias("gate_name"), F.lit("2024-12-31T23:59:59+00:00").alias("expires_at"))
    named = gate_table(spark, sf).where(F.col("status") != "passed").select("run_id", "gate_name").distinct()
    names = named.select(F.lit(None).cast("string").alias("run_id"), "gate_name", F.lit("failed").alias("status")).distinct()
    matched = gates.covering_exceptions(names, register, AS_OF)
    paged = evidence.pages(matched, ["gate_name"], "exception_id", 50).drop("value_list").withColumnRenamed("gate_name", "__name")
    return named.join(F.broadcast(paged), named["gate_name"].eqNullSafe(paged["__name"])).select(
        "run_id", "gate_name", "page", "value_count", "first_value", "last_value")


@query("OBS-10 AGG-12", """
    select case when band in ('Blocked', 'At Risk') then 'risky' else 'watched' end as list_name, run_id || '/' || dataset_name as value
    from (select run_id, dataset_name, trust_score_band as band from trust) where band in ('Blocked', 'At Risk', 'Monitor')""")
def gate_trust_lists(spark, sf):
    """Every dataset of every run that a trust gate over all runs would name, from the pages of its lists."""
    every = trust_rows(spark, sf).withColumns({"dataset_name": F.concat_ws("/", "run_id", "dataset_name"), "run_id": F.lit("all")})
    paged = evidence.pages(gates.trust_lists(every), ["run_id", "list_name"], "dataset_name")
    return paged.select("list_name", F.explode("value_list").alias("value"))


@query("OBS-11", """
    select run_id, count(*) as evaluated_gate_count,
      count(*) filter (where status = 'failed' and severity in ('critical', 'high')) as unresolved_without_exception_count,
      case when count(*) filter (where status = 'failed' and severity in ('critical', 'high')) > 0 then 'failed' else 'passed' end as status
    from gates where status <> 'passed' group by 1""")
def exception_outcomes(spark, sf):
    register = gates.exception_table(spark, EXCEPTION_ROWS)
    return gates.exception_status(gates.apply_exceptions(gate_table(spark, sf), register, AS_OF))


@query("OBS-11 JN-11", """select run_id, gate_name, 'EX-1' as exception_ids from gates where status <> 'passed'""")
def wildcard_exceptions(spark, sf):
    register = gates.exception_table(spark, [("EX-1", "active", "*", "2024-12-31T23:59:59+00:00")])
    return gates.apply_exceptions(gate_table(spark, sf), register, AS_OF).select(
        "run_id", "gate_name", F.array_join("exception_ids", ";").alias("exception_ids"))


@query("OBS-12", "select run_id, product, kind, finding from findings")
def certification_findings(spark, sf):
    return finding_rows(spark, sf).select("run_id", "product", "kind", "finding")


@query("OBS-12", "select * from certified")
def product_certification(spark, sf):
    return Control(spark, sf).certified.select(
        "run_id", "product", "blocker_count", "warning_count", "status")


@query("OBS-13 WIN-5", """
    select run_id, priority, count(*) as tasks, min(due_at) as due_at from (
      select run_id, case when status = 'failed' and severity = 'critical' then 'P1' when status = 'failed' and severity = 'high' then 'P2'
          when status = 'warning' then 'P3' else 'P4' end as priority,
        timestamp '2024-02-01 00:00:00' + to_hours(case when status = 'failed' and severity = 'critical' then 4
          when status = 'failed' and severity = 'high' then 24 when status = 'warning' then 72 else 168 end) as due_at
      from gates where status <> 'passed'
      union all select run_id, 'P1', timestamp '2024-02-01 04:00:00' from findings where kind = 'blocker') group by 1, 2""")
def remediation_priorities(spark, sf):
    return _plan(spark, sf).groupBy("run_id", "priority").agg(
        F.count(F.lit(1)).alias("tasks"), F.min("due_at").alias("due_at"))


@query("OBS-13 WIN-5", """
    select run_id, 'REM-' || case when row_number() over w < 10 then '00' else '0' end || cast(row_number() over w as varchar) as task_id, gate_name, status_text as priority
    from (select run_id, gate_order, gate_name, case when status = 'failed' and severity = 'critical' then 'P1'
        when status = 'failed' and severity = 'high' then 'P2' when status = 'warning' then 'P3' else 'P4' end as status_text
      from gates where status <> 'passed') window w as (partition by run_id order by gate_order)""")
def remediation_gate_tasks(spark, sf):
    return _plan(spark, sf).where(F.col("gate_name") != "data_product_blocker").select(
        "run_id", "task_id", "gate_name", "priority")


def _plan(spark, sf):
    control = Control(spark, sf)
    table_of_gates = cut_lineage(control.gates)
    register = gates.exception_table(spark, EXCEPTION_ROWS)
    applied = gates.apply_exceptions(table_of_gates, register, AS_OF)
    return gates.remediation_plan(table_of_gates, applied, control.findings, "2024-02-01 00:00:00")


# -- lineage, catalog, coverage, storage ----------------------------------------------------

@query("OBS-14 SET-3", "select * from lineage_edges")
def lineage_edges(spark, sf):
    return edge_rows(spark, sf)


@query("OBS-14", """select e.run_id, n.node_count, e.edge_count from (select run_id, count(*) as edge_count from lineage_edges group by 1) e
    join (select run_id, count(distinct node) as node_count from (select run_id, source as node from lineage_edges
      union all select run_id, target from lineage_edges) group by 1) n using (run_id)""")
def lineage_counts(spark, sf):
    return governance.lineage_counts(lineage_rows(spark, sf))


@query("Q-18 JN-6", """select dataset_name from (select distinct replace(out_1, 'gold.', '') as dataset_name from lineage
      union select distinct 'gold_' || lower(c_mktsegment) from customer) where dataset_name not in (select dataset_name from catalog)""")
def uncatalogued_datasets(spark, sf):
    produced = view(spark, sf, "lineage").select(F.regexp_replace("out_1", r"^gold\.", "").alias("dataset_name"))
    segments = table(spark, sf, "customer").select(F.concat(F.lit("gold_"), F.lower("c_mktsegment")).alias("dataset_name"))
    return governance.uncatalogued(produced.unionByName(segments), governance.catalog_table(spark))


@query("Q-18", """select 'nation-' || n_name as dataset_name, case when supplier_count < 5 then 'owner' else '' end as missing_fields,
      case when supplier_count < 5 then 'failed' else 'passed' end as status
    from (select n_name, count(s_suppkey) as supplier_count from nation left join supplier on s_nationkey = n_nationkey group by 1)""")
def catalog_entries_checked(spark, sf):
    """Catalog entries derived from nations; those with few suppliers lack an owner."""
    counts = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf, "nation").join(counts, "n_nationkey", "left").fillna(0, ["n"])
    filled = [F.lit("x").alias(name) for name in governance.CATALOG_REQUIRED if name not in ("dataset_name", "owner")]
    entries = rows.select(
        F.concat(F.lit("nation-"), "n_name").alias("dataset_name"),
        F.when(F.col("n") >= 5, "data-platform").otherwise("").alias("owner"), *filled)
    return governance.catalog_entry_checks(entries).withColumn("missing_fields", F.array_join("missing_fields", ";"))


@query("JN-14", """select c.dataset_name, c.owner, r.last_refresh, r.readiness_status from catalog c left join (
      select dataset_name, evaluated_at as last_refresh, readiness_status from (select *, row_number() over (partition by dataset_name order by evaluated_at desc) as n
      from readiness) where n = 1) r using (dataset_name)""")
def catalog_refreshed(spark, sf):
    newest = ready_rows(spark, sf).groupBy("dataset_name").agg(
        F.max("evaluated_at").alias("last_refresh"),
        F.max_by("readiness_status", "evaluated_at").alias("readiness_status"))
    return governance.refresh_catalog(governance.catalog_table(spark), newest).select(
        "dataset_name", "owner", "last_refresh", "readiness_status")


def _evidence(spark, sf) -> dict:
    """The table behind each control; a NULL entity stands for a report on everything."""
    loads, runs = view(spark, sf, "load_log"), view(spark, sf, "run_states")
    source, dataset = F.col("source_system").alias("entity"), F.col("dataset_name").alias("entity")
    whole = F.lit(None).cast("string").alias("entity")
    return {
        "source_contract": observe.contract_table(spark).select(source),
        "schema_registry": loads.where("layer = 'silver' and schema_version = 3").select(source),
        "quality_report": loads.where("rejected_count > 0").select(source),
        "catalog": governance.catalog_table(spark).select(dataset),
        "pii_classification": governance.classified(spark),
        "slo_report": loads.where("row_count > 100").select(source),
        "semantic_validation": runs.where("row_count > 0").select(whole),
        "reconciliation": runs.where("row_count < 0").select(whole),
        "certification": runs.where("quality_status = 'passed' and freshness_status = 'passed'").select(dataset),
        "release_gate": view(spark, sf, "alerts").select(dataset),
        "audit_manifest": runs.groupBy("dataset_name").agg(F.count_if(F.col("schema_status") == "breaking_drift").alias("bad")).where("bad < 3").select(dataset),
    }


def _coverage(spark, sf, without=()):
    entities = view(spark, sf, "load_log").select(F.col("source_system").alias("entity"), F.lit("source").alias("entity_type")).unionByName(
        view(spark, sf, "run_states").select(F.col("dataset_name").alias("entity"), F.lit("gold_dataset").alias("entity_type")))
    return governance.derived_controls(entities, {k: v for k, v in _evidence(spark, sf).items() if k not in without})


CLASSIFIED = ", ".join(f"'{r}'" for r in sorted({n.removeprefix(p) for n in CLASSIFICATION for p in ("", "silver_")}))
CONTROL_FLAGS = f"""
    sources as (select source_system as entity, 'source' as entity_type, source_system in (select source_system from contracts) as source_contract,
        count(*) filter (where layer = 'silver' and schema_version = 3) > 0 as schema_registry, count(*) filter (where rejected_count > 0) > 0 as quality_report,
        source_system in (select dataset_name from catalog) as catalog, source_system in ({CLASSIFIED}) as pii_classification,
        count(*) filter (where row_count > 100) > 0 as slo_report from load_log group by 1),
    marts as (select dataset_name as entity, 'gold_dataset' as entity_type, dataset_name in (select dataset_name from catalog) as catalog,
        dataset_name in ({CLASSIFIED}) as pii_classification, (select count(*) from run_states where row_count > 0) > 0 as semantic_validation,
        (select count(*) from run_states where row_count < 0) > 0 as reconciliation,
        count(*) filter (where quality_status = 'passed' and freshness_status = 'passed') > 0 as certification,
        dataset_name in (select dataset_name from alerts) as release_gate,
        count(*) filter (where schema_status = 'breaking_drift') < 3 as audit_manifest from run_states group by 1),
    flags as (unpivot (select * from sources) on columns(* exclude (entity, entity_type)) into name control value covered
      union all unpivot (select * from marts) on columns(* exclude (entity, entity_type)) into name control value covered)"""


@query("OBS-15 AGG-21 SET-4", f"""
    with {CONTROL_FLAGS}, kept as (select 'all' as tables, entity, entity_type, covered from flags
        union all select 'no contracts', entity, entity_type, covered and control <> 'source_contract' from flags)
    select tables, count(distinct entity) filter (where entity_type = 'source') as source_count,
      count(distinct entity) filter (where entity_type = 'gold_dataset') as gold_dataset_count,
      count(*) filter (where covered) as covered_count, count(*) as flag_count,
      round(count(*) filter (where covered) / count(*), 4) as control_coverage_pct from kept group by 1""")
def control_coverage(spark, sf):
    """Coverage by the tables that prove controls, and with the contracts taken away: it falls."""
    both = [governance.control_coverage(_coverage(spark, sf, without)).withColumn("tables", F.lit(name))
            for name, without in (("all", ()), ("no contracts", ("source_contract",)))]
    return both[0].unionByName(both[1])


@query("OBS-15", f"""
    with {CONTROL_FLAGS} select entity, entity_type, coalesce(string_agg(control, ', ' order by control) filter (where covered), '') as covered_controls,
      coalesce(string_agg(control, ', ' order by control) filter (where not covered), '') as missing_controls from flags group by 1, 2""")
def control_lists(spark, sf):
    return governance.control_lists(_coverage(spark, sf))


@query("AGG-22", """
    select source_system as layer, count(*) as file_count, cast(sum(row_count) * 1000000 as bigint) as size_bytes,
      round(sum(row_count) * 1000000 / 1048576.0::double, 4) as size_mb, round(sum(row_count) * 1000000 / 1073741824.0::double * 0.023::double, 6) as monthly_cost_usd
    from load_log group by 1""")
def storage_cost(spark, sf):
    """Cost per layer from a file listing; here every load stands for one file."""
    sizes = view(spark, sf, "load_log").select(
        F.col("source_system").alias("layer"), (F.col("row_count") * 1000000).alias("length"))
    return governance.storage_cost(sizes)


@query("AGG-23", """select run_id, layer, source_system as dataset, cast(sum(row_count) as bigint) as row_count,
    cast(sum(rejected_count) as bigint) as rejected_count, count(*) as loads from load_log group by 1, 2, 3""")
def run_summary(spark, sf):
    return governance.run_summary(view(spark, sf, "load_log").withColumnRenamed("source_system", "dataset"))


@query("WIN-6", """select run_id, step_name, duration_seconds, rank from (select run_id, step_name, duration_seconds,
      cast(row_number() over (partition by run_id order by duration_seconds desc, step_name) as int) as rank from (
      select 'run-' || substr(cast(ts as varchar), 1, 10) as run_id, 'step-' || cast(event_id as varchar) as step_name, value as duration_seconds
      from events)) where rank <= 5""")
def slowest_steps(spark, sf):
    steps = table(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.substring(F.col("ts").cast("string"), 1, 10)).alias("run_id"),
        F.concat(F.lit("step-"), F.col("event_id").cast("string")).alias("step_name"), F.col("value").alias("duration_seconds"))
    return governance.slowest_steps(steps, 5)


# -- metrics, roll-ups, exports -------------------------------------------------------------

@query("AGG-20 Q-19", """
    select 'gross_revenue' as metric, cast(sum(cast(gross_revenue as decimal(28,6))) as double) as value from gold_revenue
    union all select 'completed_orders', cast(sum(completed_orders) as double) from gold_revenue
    union all select 'revenue_attainment', cast(sum(cast(gross_revenue as decimal(28,6))) as double) / cast(sum(cast(revenue_target as decimal(28,6))) as double) from gold_revenue
    union all select 'roas', cast(sum(cast(attributed_revenue as decimal(28,6))) as double) / cast(sum(cast(spend as decimal(28,6))) as double) from gold_marketing
    union all select 'dataset_readiness_score', cast(sum(cast(readiness_score as decimal(28,6))) as double) / count(readiness_score) from readiness""")
def business_metrics(spark, sf):
    tables = _metric_tables(spark, sf)
    broken = [m for m in metrics.check_metrics({n: t.columns for n, t in tables.items()}) if m["status"] == "failed"]
    assert not broken, broken
    return metrics.evaluate_metrics(tables)


def _metric_tables(spark, sf):
    return {
        "gold_revenue_analytics": revenue(spark, sf),
        "gold_marketing_attribution": marts.gold_marketing_attribution(
            orders(spark, sf), silver(spark, sf, "marketing_campaigns")),
        "observability.dataset_readiness": ready_rows(spark, sf)}


@query("AGG-20", """select channel, 'roas' as metric, case when sum(cast(spend as decimal(28,6))) <> 0 then
      cast(sum(cast(attributed_revenue as decimal(28,6))) as double) / cast(sum(cast(spend as decimal(28,6))) as double) end as value
    from gold_marketing group by 1""")
def metrics_by_channel(spark, sf):
    return metrics.evaluate_metrics(_metric_tables(spark, sf), ["channel"])


@query("AGG-18 AGG-17", """
    select 'overall_trust_score' as measure, cast(sum(cast(trust_score_overall as decimal(18,4))) as double) / count(*) as value from trust
    union all select 'at_risk_datasets', cast(count(distinct dataset_name) filter (where trust_score_band in ('At Risk', 'Blocked')) as double) from trust
    union all select 'average_readiness_score', cast(sum(cast(readiness_score as decimal(18,4))) as double) / count(*) from readiness
    union all select 'total_quality_checks', 7.0
    union all select 'failed_quality_checks', cast(failed as double) from q
    union all select 'quality_pass_rate', (7 - failed) / 7.0::double from q
    union all select 'schema_drift_events', cast(count(*) filter (where schema_status <> 'unchanged') as double) from readiness
    union all select 'open_incidents', cast(count(*) as double) from alerts where resolution_status = 'open'
    union all select 'failed_gates', cast(count(*) as double) from gates where status = 'failed'""".replace(
    "from q", """from (select (case when count(*) filter (where customer_id is null) > 0.01 * count(*) then 1 else 0 end)
      + (case when count(*) filter (where status not in ('completed', 'refunded', 'failed', 'pending')) > 0 then 1 else 0 end) as failed from silver_orders)"""))
def bi_measures(spark, sf):
    name = "silver_ecommerce_transactions"
    control = Control(spark, sf)
    return metrics.bi_measures(
        control.trust, control.ready, checks.validate(orders(spark, sf), name, QUALITY_SUITES[name]),
        control.ready.select(F.col("schema_status").alias("status")), control.alerts, control.gates)


@query("AGG-19 FLT-8", """
    select measure, cast(value as double) as value from (
      select 'total_checks' as measure, count(*) * 4 as value from readiness
      union all select 'failed_checks', count(*) filter (where quality_status = 'failed') from readiness
      union all select 'passed_checks', count(*) * 4 - count(*) filter (where quality_status = 'failed') from readiness
      union all select 'failed_datasets', count(*) filter (where quality_status = 'failed') from readiness
      union all select 'warning_checks', 0
      union all select 'null_breaches', count(*) filter (where severity = 'critical') from alerts where alert_type like 'click%'
      union all select 'duplicate_issues', count(*) filter (where severity = 'critical') from alerts where alert_type like 'view%'
      union all select 'rejected_records', count(*) from marked_orders where _reject_reason is not null
      union all select 'row_count_anomalies', count(*) from volume where status = 'failed')""")
def quality_dashboard(spark, sf):
    from plumbline.catalog.sources import rejected_orders

    ready = ready_rows(spark, sf)
    summary = ready.withColumns({
        "check_count": F.lit(4), "failed_check_count": F.when(F.col("quality_status") == "failed", 1).otherwise(0)})
    kind = F.when(F.col("alert_type").startswith("click"), "NULL_rate_x").when(
        F.col("alert_type").startswith("view"), "unique_x").otherwise("other")
    results = view(spark, sf, "alerts").select(
        kind.alias("check_name"), F.when(F.col("severity") == "critical", "failed").otherwise("passed").alias("status"))
    return metrics.quality_rollup(summary, results, rejected_orders(spark, sf), volume_rows(ready))


@query("AGG-19", """
    select measure, cast(value as double) as value from (
      select 'total_alerts' as measure, count(*) as value from alerts
      union all select 'open_alerts', count(*) filter (where resolution_status = 'open') from alerts
      union all select 'resolved_alerts', count(*) filter (where resolution_status = 'resolved') from alerts
      union all select 'high_or_critical_alerts', count(*) filter (where severity in ('high', 'critical')) from alerts)""")
def alert_dashboard(spark, sf):
    return metrics.alert_rollup(view(spark, sf, "alerts"))


@query("AGG-19 AGG-15", """
    select 'datasets_monitored' as measure, cast(count(*) as double) as value from readiness
    union all select 'healthy_datasets', cast(count(*) filter (where readiness_status = 'ready') as double) from readiness
    union all select 'at_risk_datasets', cast(count(*) filter (where readiness_status = 'at_risk') as double) from readiness
    union all select 'blocked_datasets', 0.0
    union all select 'freshness_pass_rate', count(*) filter (where freshness_status = 'passed') / count(*) from readiness
    union all select 'average_trust_score', cast(sum(cast(trust_score_overall as decimal(18,4))) as double) / count(*) from trust
    union all select 'quality_pass_rate', count(*) filter (where quality_status = 'passed') / count(*) from readiness
    union all select 'open_alerts', cast(count(*) as double) from alerts where resolution_status = 'open'""")
def health_dashboard(spark, sf):
    ready = cut_lineage(ready_rows(spark, sf))
    return metrics.health_rollup(ready, trust_rows(spark, sf, ready), ready, view(spark, sf, "alerts"))


@query("AGG-19 Q-3", """
    select 'schema_events' as measure, cast(count(*) as double) as value from readiness
    union all select 'compatible_evolutions', cast(count(*) filter (where schema_status = 'compatible_evolution') as double) from readiness
    union all select 'breaking_events', cast(count(*) filter (where schema_status = 'breaking_drift') as double) from readiness
    union all select 'contract_reports', cast(count(*) as double) from readiness
    union all select 'contract_failures', cast(count(*) filter (where quality_status = 'failed') as double) from readiness""")
def drift_dashboard(spark, sf):
    states = view(spark, sf, "run_states")
    history = states.select(F.col("schema_status").alias("status"), (F.col("schema_status") == "breaking_drift").alias("breaking"))
    reports = states.select(F.when(F.col("quality_status") == "failed", "fail").otherwise("PASS").alias("status"))
    return metrics.drift_rollup(history, reports)


@query("AGG-13", "select coalesce(customer_id, 'unknown') as value, count(*) as n from silver_orders group by 1")
def customer_value_counts(spark, sf):
    return metrics.value_counts(orders(spark, sf), "customer_id")


@query("PRJ-24", "select event_id, coalesce(try_cast(value as double), 0.0) as value from typed_text")
def chart_values(spark, sf):
    return metrics.chart_values(view(spark, sf, "typed_text"), "event_id", "value")


@query("PRJ-21", """select case when check_name like 'schema_required_columns%' then 'schema' when check_name like 'unique_%' then 'uniqueness'
      when check_name like 'null_rate_%' then 'null' when check_name like 'accepted_values_%' then 'accepted_values'
      when check_name like 'non_negative_%' then 'range' else 'other' end as rule_type, count(*) as n
    from (select case event_type when 'click' then 'unique_' when 'view' then 'null_rate_' when 'error' then 'accepted_values_'
      when 'signup' then 'non_negative_' else 'custom_' end || cast(user_id as varchar) as check_name from events) group by 1""")
def rule_types(spark, sf):
    prefix = F.expr("case event_type when 'click' then 'unique_' when 'view' then 'null_rate_' when 'error' then 'accepted_values_' "
                    "when 'signup' then 'non_negative_' else 'custom_' end")
    names = table(spark, sf, "events").select(F.concat(prefix, F.col("user_id").cast("string")).alias("check_name"))
    return export.with_rule_type(names).groupBy("rule_type").agg(F.count(F.lit(1)).alias("n"))


@query("JN-7", """select r.run_id, r.dataset_name, r.readiness_score, t.trust_score_overall, t.trust_score_band
    from readiness r left join trust t using (run_id, dataset_name)""")
def readiness_with_trust(spark, sf):
    ready = cut_lineage(ready_rows(spark, sf))
    return metrics.readiness_with_trust(ready, trust_rows(spark, sf, ready), ON).select(
        *ON, "readiness_score", "trust_score_overall", "trust_score_band")


def _newest(df, *columns):
    latest = df.groupBy("dataset_name").agg(F.max(F.struct("run_id", *columns)).alias("s"))
    return latest.select("dataset_name", *[f"s.{c}" for c in columns])


@query("JN-8", """
    select c.dataset_name, c.row_count, t.trust_score_overall, t.trust_score_band, r.readiness_status, r.quality_status, r.freshness_status, r.schema_status
    from (select dataset_name, count(*) as row_count from run_states group by 1) c
    left join (select * from trust where run_id = (select max(run_id) from trust)) t using (dataset_name)
    left join (select * from readiness where run_id = (select max(run_id) from readiness)) r using (dataset_name)""")
def mart_summary(spark, sf):
    counts = view(spark, sf, "run_states").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("row_count"))
    rows = cut_lineage(ready_rows(spark, sf))
    trust = _newest(trust_rows(spark, sf, rows), "trust_score_overall", "trust_score_band")
    ready = _newest(rows, "readiness_status", "quality_status", "freshness_status", "schema_status")
    return metrics.mart_summary(counts, trust, ready)


@query("JN-9 AGG-19", """
    select m.dataset_name, coalesce(c.row_count, 0) as row_count, coalesce(k.owner, '') as owner, coalesce(r.readiness_status, 'model_defined') as bi_readiness_status,
      case when c.row_count is not null then 'csv_available' else 'dbt_model_available' end as artifact_status
    from (select dataset_name from catalog union all select unnest(['fact_orders', 'fact_marketing_spend', 'dim_customer', 'dim_product'])) m
    left join (select dataset_name, count(*) as row_count from run_states group by 1) c on c.dataset_name = m.dataset_name
    left join catalog k on k.dataset_name = m.dataset_name
    left join (select * from readiness where run_id = (select max(run_id) from readiness)) r on r.dataset_name = m.dataset_name""")
def mart_inventory(spark, sf):
    counts = view(spark, sf, "run_states").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("row_count"))
    rows = cut_lineage(ready_rows(spark, sf))
    ready = _newest(rows, "readiness_status")
    trust = _newest(trust_rows(spark, sf, rows), "trust_score_overall")
    return metrics.mart_inventory(counts, governance.catalog_table(spark), ready, trust).select(
        "dataset_name", "row_count", "owner", "bi_readiness_status", "artifact_status")


@query("SNK-11 UDF-3", """
    select run_id, dataset_name, reasons as reason_codes, '' as not_there from trust""")
def flat_export(spark, sf):
    """Trust rows as flat text cells; a column that is not there comes out empty."""
    return export.flatten(trust_rows(spark, sf), ["run_id", "dataset_name", "reason_codes", "not_there"])


@query("SRC-7", """select event_type, count(*) filter (where value < 200) as parsed, count(*) filter (where value >= 200) as broken from events group by 1""")
def tolerant_json_lines(spark, sf):
    """Event properties as JSON lines, some of them cut short: a broken line stays as raw text."""
    from pyspark.sql import types as T

    from plumbline.sources.landing import parse_tolerant_json

    lines = table(spark, sf, "events").select(
        "event_type", F.when(F.col("value") >= 200, F.concat(F.lit("x"), "props")).otherwise(F.col("props")).alias("value"))
    parsed = parse_tolerant_json(lines, T.StructType([T.StructField("k", T.LongType())]))
    return parsed.groupBy("event_type").agg(
        F.count("k").alias("parsed"), F.count("raw_line").alias("broken"))
