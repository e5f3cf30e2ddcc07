"""Named SQL building blocks of the checking queries."""

from __future__ import annotations

import re

from plumbline.catalog.views import VIEWS, duckdb_text
from plumbline.config import CATALOG, CATALOG_FIELDS, DATA_PRODUCTS, ROUTES, SOURCES, TIER_1_MARTS


def values(rows, names) -> str:
    """Configuration rows as an inline table."""
    def text(value) -> str:
        if isinstance(value, (int, float)):
            return repr(value)
        return "'" + str(value).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) v({', '.join(names)})"


def quoted(items) -> str:
    return ", ".join(f"'{item}'" for item in items)


def _marked(typed: str, key: str, extra: str = "false", reason: str = "") -> str:
    first = f"when {extra} then '{reason}' " if reason else ""
    return f"""
    select *, case {first}when {key} is null then 'missing primary key {key}'
        when row_number() over (partition by {key}, ({extra}) or {key} is null order by _pos) > 1
        then 'duplicate primary key {key}' end as _reject_reason from {typed}"""


def _blank(column: str) -> str:
    return f"nullif(trim({column}), '')"


def _stamp(column: str) -> str:
    return f"try_cast(replace(replace({column}, 'T', ' '), 'Z', '') as timestamp)"


CTES: dict[str, str] = {name: duckdb_text(name) for name in VIEWS}
CTES.update({
    "typed_orders": f"""
        select coalesce({_blank('transaction_id')}, {_blank('order_id')}) as transaction_id,
          {_blank('customer_id')} as customer_id, {_blank('product_id')} as product_id,
          {_stamp('coalesce(order_ts, order_timestamp)')} as order_ts,
          cast(round(coalesce(try_cast(coalesce(amount, order_value) as decimal(18,4)), 0), 2) as decimal(18,4)) as amount,
          coalesce(lower({_blank('status')}), 'pending') as status,
          coalesce(try_cast({_blank('quantity')} as bigint), 1) as quantity,
          coalesce({_blank('campaign_id')}, 'unknown') as campaign_id,
          {_blank('coupon_code')} as coupon_code, _pos from raw_orders""",
    "marked_orders": _marked("typed_orders", "transaction_id", "amount < 0", "negative amount"),
    "silver_orders": "select * exclude (_reject_reason) from marked_orders where _reject_reason is null",
    "typed_behavior": f"""
        select {_blank('event_id')} as event_id, {_blank('user_id')} as customer_id, {_stamp('event_time')} as event_ts,
          coalesce(lower({_blank('event_type')}), 'unknown') as event_type, product_id, session_id, _pos
        from raw_behavior""",
    "marked_behavior": _marked("typed_behavior", "event_id"),
    "silver_behavior": "select * exclude (_reject_reason) from marked_behavior where _reject_reason is null",
    "typed_support": f"""
        select {_blank('ticket_id')} as ticket_id, {_blank('user_id')} as customer_id, {_stamp('created_ts')} as created_ts,
          coalesce(lower({_blank('priority')}), 'medium') as priority, coalesce(lower({_blank('status')}), 'open') as status,
          topic, _pos from raw_support""",
    "marked_support": _marked("typed_support", "ticket_id"),
    "silver_support": "select * exclude (_reject_reason) from marked_support where _reject_reason is null",
    "typed_logs": f"""
        select log_id, service_name, {_stamp('event_ts')} as event_ts, coalesce(lower({_blank('status')}), '') as status,
          coalesce(try_cast({_blank('runtime_seconds')} as bigint), 0) as runtime_seconds, _pos from raw_logs""",
    "marked_logs": _marked("typed_logs", "log_id"),
    "silver_logs": "select * exclude (_reject_reason) from marked_logs where _reject_reason is null",
    "typed_products": f"""
        select product_id, product_name, {_blank('category')} as category,
          coalesce(lower(active_flag) in ('true', '1', 'yes', 'active'), false) as active_flag,
          cast(round(coalesce(try_cast(list_price as decimal(18,4)), 0), 2) as decimal(18,4)) as list_price, _pos
        from raw_products""",
    "marked_products": _marked("typed_products", "product_id"),
    "silver_products": "select * exclude (_reject_reason) from marked_products where _reject_reason is null",
    "typed_campaigns": """
        select campaign_id, cast(campaign_date as date) as campaign_date,
          lower(coalesce(channel, channel_name, 'unknown')) as channel,
          cast(round(cast(spend as decimal(18,4)), 2) as decimal(18,4)) as spend,
          cast(impressions as bigint) as impressions, cast(clicks as bigint) as clicks, _pos from raw_campaigns""",
    "marked_campaigns": _marked("typed_campaigns", "campaign_id"),
    "silver_campaigns": "select * exclude (_reject_reason) from marked_campaigns where _reject_reason is null",
    "typed_targets": """
        select cast(target_date as date) as target_date, cast(revenue_target as decimal(18,4)) as revenue_target,
          cast(orders_target as bigint) as orders_target, _pos from raw_targets""",
    "marked_targets": _marked("typed_targets", "target_date"),
    "silver_targets": "select * exclude (_reject_reason) from marked_targets where _reject_reason is null",
    # staging: no de-duplication, keyless rows dropped
    "stg_orders": f"""
        select * from (select coalesce({_blank('transaction_id')}, {_blank('order_id')}) as transaction_id,
          {_blank('customer_id')} as customer_id, {_blank('product_id')} as product_id,
          {_stamp('coalesce(order_ts, order_timestamp)')} as order_ts,
          try_cast(nullif(regexp_replace(coalesce(amount, order_value), '[^0-9.\\-]', '', 'g'), '') as decimal(18,4)) as amount,
          lower(coalesce({_blank('status')}, 'pending')) as status,
          coalesce(try_cast({_blank('quantity')} as bigint), 1) as quantity,
          coalesce({_blank('campaign_id')}, 'unknown') as campaign_id, {_blank('coupon_code')} as coupon_code
        from raw_orders) where transaction_id is not null""",
    "gold_revenue": """
        select r.order_date, completed_orders, cast(gross as double) as gross_revenue, refund_count, failed_orders,
          cast(t.revenue_target as double) as revenue_target, t.orders_target,
          case when t.revenue_target > 0 then cast(gross as double) / cast(t.revenue_target as double) else 0.0 end as revenue_attainment
        from (select cast(order_ts as date) as order_date,
                count(*) filter (where status = 'completed') as completed_orders,
                sum(case when status = 'completed' then amount else 0 end) as gross,
                count(*) filter (where status = 'refunded') as refund_count,
                count(*) filter (where status = 'failed') as failed_orders
              from silver_orders group by 1) r
        left join silver_targets t on r.order_date = t.target_date""",
    "customer_activity": """
        select coalesce(o.customer_id, e.customer_id, s.customer_id) as customer_id, coalesce(order_count, 0) as order_count,
          coalesce(gross, 0) as gross, coalesce(refund_count, 0) as refund_count, last_order_ts,
          coalesce(behavior_events, 0) as behavior_events, coalesce(support_tickets, 0) as support_tickets
        from (select customer_id, count(*) as order_count, sum(case when status = 'completed' then amount else 0 end) as gross,
                count(*) filter (where status = 'refunded') as refund_count, max(order_ts) as last_order_ts
              from silver_orders where customer_id is not null group by 1) o
        full outer join (select customer_id, count(*) as behavior_events from silver_behavior
              where customer_id is not null group by 1) e on o.customer_id = e.customer_id
        full outer join (select customer_id, count(*) as support_tickets from silver_support
              where customer_id is not null group by 1) s on coalesce(o.customer_id, e.customer_id) = s.customer_id""",
    "gold_customers": """
        select customer_id, order_count, cast(gross as double) as gross_revenue, refund_count, last_order_ts, behavior_events,
          support_tickets, case when support_tickets > 0 and refund_count > 0 then 'retention_risk'
            when cast(gross as double) >= 250 then 'high_value' else 'standard' end as customer_segment
        from customer_activity""",
    "gold_products": """
        select p.product_id, p.product_name, p.category, p.active_flag,
          count(*) filter (where o.status = 'completed') as order_count,
          cast(sum(case when o.status = 'completed' then o.quantity else 0 end) as bigint) as units_sold,
          cast(sum(case when o.status = 'completed' then o.amount else 0 end) as double) as gross_revenue
        from silver_products p left join silver_orders o on p.product_id = o.product_id group by 1, 2, 3, 4""",
    "gold_marketing": """
        select campaign_id, channel, cast(spend as double) as spend, attributed_orders,
          cast(revenue as double) as attributed_revenue,
          case when spend > 0 then cast(revenue as double) / cast(spend as double) else 0.0 end as roas
        from (select coalesce(o.campaign_id, 'unknown') as campaign_id, coalesce(m.channel, 'unknown') as channel,
                coalesce(max(m.spend), 0) as spend, count(*) filter (where o.status = 'completed') as attributed_orders,
                sum(case when o.status = 'completed' then o.amount else 0 end) as revenue
              from silver_orders o left join silver_campaigns m on o.campaign_id = m.campaign_id group by 1, 2)""",
    # control tables
    "readiness": """
        select *, case when readiness_score >= 0.95 then 'ready' else 'at_risk' end as readiness_status
        from (select *, ((case when row_count > 0 then 1 else 0 end) + (case when quality_status = 'passed' then 1 else 0 end)
             + (case when freshness_status = 'passed' then 1 else 0 end)
             + (case when schema_status in ('unchanged', 'new_schema', 'compatible_evolution') then 1 else 0 end)) / 4.0
             ::double as readiness_score from run_states)""",
    "gold_slos": f"""
        select *, case when readiness_score >= readiness_target then 'passed' else 'failed' end as slo_status
        from (select *, case when dataset_name in ({quoted(TIER_1_MARTS)}) then 0.95::double else 0.90::double end
              as readiness_target from readiness)""",
    "volume": """
        select *, case when seen > 0 and delta > 0.35 then 'failed' else 'passed' end as status
        from (select *, case when base = 0 then 0.0 else abs(row_count - base) / base end as delta
          from (select *, coalesce(mean, row_count::double) as base
            from (select run_id, dataset_name, evaluated_at, row_count,
                  count(*) over w as seen, avg(row_count) over w as mean from run_states
                  window w as (partition by dataset_name order by evaluated_at rows between 7 preceding and 1 preceding))))""",
    "catalog": values(CATALOG, CATALOG_FIELDS),
    "lineage_edges": """
        select distinct run_id, source, target, relationship from (
          select run_id, in_1 as source, job_name as target, 'input_to_job' as relationship from lineage
          union all select run_id, in_2, job_name, 'input_to_job' from lineage
          union all select run_id, job_name, out_1, 'job_to_output' from lineage)""",
    "lineage_members": """
        select distinct run_id, regexp_replace(case when relationship = 'input_to_job' then source else target end, '^gold\\.', '')
          as dataset_name from lineage_edges""",
    "worst_alerts": """
        select r.run_id, r.dataset_name, max(case a.severity when 'critical' then 3 when 'high' then 2 else 1 end) as worst
        from readiness r join alerts a on a.run_id = r.run_id and a.resolution_status = 'open'
          and (a.dataset_name = r.dataset_name or contains(a.business_impact, r.dataset_name))
        group by 1, 2""",
    "trust_parts": """
        select r.run_id, r.dataset_name, round(r.readiness_score * 100, 2) as c1,
          case when r.quality_status = 'passed' then 100 else 25 end as c2,
          case when r.freshness_status = 'passed' then 100 else 40 end as c3,
          case when r.schema_status in ('unchanged', 'new_schema', 'compatible_evolution') then 100 else 35 end as c4,
          case when s.slo_status = 'passed' then 100 else 55 end as c5,
          case when coalesce(v.status, 'passed') = 'passed' then 100 else 45 end as c6,
          case when l.dataset_name is not null then 100 else 40 end as c7,
          case when c.dataset_name is not null then 100 else 50 end as c8,
          case coalesce(w.worst, 0) when 3 then 30 when 2 then 60 when 1 then 80 else 100 end as c9
        from readiness r left join gold_slos s using (run_id, dataset_name) left join volume v using (run_id, dataset_name)
        left join lineage_members l on l.run_id = r.run_id and l.dataset_name = r.dataset_name
        left join catalog c on c.dataset_name = r.dataset_name left join worst_alerts w on w.run_id = r.run_id and w.dataset_name = r.dataset_name""",
    "trust": """
        select *, case when trust_score_overall >= 90 then 'Trusted' when trust_score_overall >= 75 then 'Monitor'
            when trust_score_overall >= 60 then 'At Risk' else 'Blocked' end as trust_score_band,
          array_to_string(list_sort(list_filter([
            case c9 when 30 then 'critical_open_alert' when 60 then 'high_open_alert' when 80 then 'open_alert' end,
            case when c2 < 100 then 'failed_quality_gate' end, case when c3 < 100 or c5 < 100 then 'freshness_or_slo_risk' end,
            case when c4 < 100 then 'schema_instability' end, case when c6 < 100 then 'row_count_anomaly' end,
            case when c7 < 100 then 'lineage_incomplete' end, case when c8 < 100 then 'documentation_incomplete' end],
            lambda x: x is not null)), ';') as reasons
        from (select *, cast(round(cast(c1 as decimal(9,4)) * 0.18 + c2 * 0.16 + c3 * 0.12 + c4 * 0.12 + c5 * 0.12 + c6 * 0.10
            + c7 * 0.08 + c8 * 0.06 + c9 * 0.06, 2) as double) as trust_score_overall from trust_parts)""",
    "runs": """
        select run_id, case when failed > 0 then 'failed' else 'passed' end as semantic_status,
          case when total % 2 = 0 then 'passed' else 'failed' end as reconciliation_status, 'passed' as pii_status,
          'passed' as catalog_status, total / 5.0::double as duration_seconds
        from (select run_id, count(*) filter (where quality_status = 'failed' and freshness_status = 'failed') as failed,
              cast(sum(row_count) as bigint) as total from run_states group by run_id)""",
    "products": values(
        [(o, p[0], p[1], float(p[4]), i, d) for o, p in enumerate(DATA_PRODUCTS) for i, d in enumerate(p[3])],
        ("product_order", "product", "owner", "trust_threshold", "dataset_order", "dataset_name")),
    "findings": """
        select run_id, product, kind, finding from (
          select u.run_id, p.product, 'blocker' as kind, p.dataset_name || ' has no readiness record' as finding
          from runs u join products p on true left join readiness r on r.run_id = u.run_id and r.dataset_name = p.dataset_name
          where r.run_id is null
          union all select r.run_id, p.product, 'blocker', p.dataset_name || ' readiness is ' || r.readiness_status
          from readiness r join products p using (dataset_name) where r.readiness_status <> 'ready'
          union all select r.run_id, p.product, 'blocker', p.dataset_name || ' failed SLO target'
          from gold_slos r join products p using (dataset_name) where r.slo_status = 'failed'
          union all select t.run_id, p.product, 'blocker', p.dataset_name || ' trust score ' || cast(t.trust_score_overall as varchar)
             || ' below threshold ' || cast(cast(p.trust_threshold as int) as varchar)
          from trust t join products p using (dataset_name) where t.trust_score_overall < p.trust_threshold
          union all select t.run_id, p.product, 'warning', p.dataset_name || ' trust band is ' || t.trust_score_band
          from trust t join products p using (dataset_name)
          where t.trust_score_overall >= p.trust_threshold and t.trust_score_band <> 'Trusted'
          union all select a.run_id, p.product, case when a.severity = 'critical' then 'blocker' else 'warning' end,
             a.severity || ' alert ' || a.alert_type || ' on ' || a.dataset_name
          from alerts a join (select product, list(dataset_name) as names from products group by 1) p
             on list_contains(p.names, a.dataset_name) or len(list_filter(p.names, lambda n: contains(a.business_impact, n))) > 0
          where a.resolution_status = 'open'
          union all select u.run_id, p.product, 'blocker', 'semantic metric validation failed'
          from runs u join (select distinct product from products) p on true where u.semantic_status <> 'passed'
          union all select u.run_id, p.product, 'blocker', 'financial reconciliation failed'
          from runs u join (select distinct product from products where dataset_name in
            ('gold_revenue_analytics', 'gold_target_vs_actual', 'gold_product_performance')) p on true
          where u.reconciliation_status <> 'passed')""",
    "certified": """
        select u.run_id, p.product, count(*) filter (where f.kind = 'blocker') as blocker_count,
          count(*) filter (where f.kind = 'warning') as warning_count,
          case when count(*) filter (where f.kind = 'blocker') > 0 then 'blocked'
            when count(*) filter (where f.kind = 'warning') > 0 then 'conditional' else 'certified' end as status
        from runs u join (select distinct product from products) p on true
        left join findings f on f.run_id = u.run_id and f.product = p.product group by 1, 2""",
    "run_facts": """
        select u.*, coalesce(q.n, 0) as failed_quality, coalesce(a.c, 0) as critical_alerts, coalesce(a.h, 0) as high_alerts,
          coalesce(s.n, 0) as failed_slos, coalesce(t.risky, 0) as risky, coalesce(t.watched, 0) as watched,
          coalesce(e.n, 0) as edge_count, c.certification_status
        from runs u
        left join (select run_id, count(*) filter (where quality_status = 'failed') as n from run_states group by 1) q using (run_id)
        left join (select run_id, count(*) filter (where severity = 'critical') as c, count(*) filter (where severity = 'high') as h
              from alerts where resolution_status = 'open' group by 1) a using (run_id)
        left join (select run_id, count(*) filter (where slo_status = 'failed') as n from gold_slos group by 1) s using (run_id)
        left join (select run_id, count(*) filter (where trust_score_band in ('Blocked', 'At Risk')) as risky,
              count(*) filter (where trust_score_band = 'Monitor') as watched from trust group by 1) t using (run_id)
        left join (select run_id, count(*) as n from lineage_edges group by 1) e using (run_id)
        left join (select run_id, case when count(*) filter (where status = 'blocked') > 0 then 'blocked' else 'passed' end
              as certification_status from certified group by 1) c using (run_id)""",
    "gates": """
        select run_id, unnest([
          {'gate_order': 0, 'gate_name': 'silver_quality_gate', 'status': case when failed_quality > 0 then 'failed' else 'passed' end, 'severity': 'critical'},
          {'gate_order': 1, 'gate_name': 'critical_alert_gate', 'status': case when critical_alerts > 0 then 'failed' else 'passed' end, 'severity': 'critical'},
          {'gate_order': 2, 'gate_name': 'slo_gate', 'status': case when failed_slos > 0 then 'failed' else 'passed' end, 'severity': 'critical'},
          {'gate_order': 3, 'gate_name': 'data_product_certification_gate', 'status': case when certification_status = 'blocked' then 'failed' else 'passed' end, 'severity': 'critical'},
          {'gate_order': 4, 'gate_name': 'semantic_metric_gate', 'status': case when semantic_status <> 'passed' then 'failed' else 'passed' end, 'severity': 'high'},
          {'gate_order': 5, 'gate_name': 'reconciliation_gate', 'status': case when reconciliation_status <> 'passed' then 'failed' else 'passed' end, 'severity': 'critical'},
          {'gate_order': 6, 'gate_name': 'pii_classification_gate', 'status': 'passed', 'severity': 'critical'},
          {'gate_order': 7, 'gate_name': 'catalog_completeness_gate', 'status': 'passed', 'severity': 'high'},
          {'gate_order': 8, 'gate_name': 'dataset_trust_gate', 'status': case when risky > 0 then 'failed' when watched > 0 then 'warning' else 'passed' end,
           'severity': case when risky > 0 then 'critical' else 'medium' end},
          {'gate_order': 9, 'gate_name': 'runtime_gate', 'status': case when duration_seconds > 60 then 'warning' else 'passed' end, 'severity': 'medium'},
          {'gate_order': 10, 'gate_name': 'lineage_graph_gate', 'status': case when edge_count = 0 then 'failed' else 'passed' end, 'severity': 'high'},
          {'gate_order': 11, 'gate_name': 'high_alert_gate', 'status': case when high_alerts > 0 then 'warning' else 'passed' end, 'severity': 'medium'}
        ], recursive := true) from run_facts""",
    "release": """
        select run_id, count(*) as gate_count, count(*) filter (where status = 'failed') as failed_gate_count,
          count(*) filter (where status = 'warning') as warning_gate_count,
          case when count(*) filter (where status = 'failed' and severity in ('critical', 'high')) > 0 then 'blocked'
            when count(*) filter (where status = 'warning') > 0 then 'conditional' else 'approved' end as release_status
        from gates group by 1""",
    "routes": values([(s, r) for s, rs in ROUTES.items() for r in rs], ("severity", "route")),
    "contracts": values([(s.name, s.owner, s.tier, s.freshness_minutes) for s in SOURCES.values()],
                        ("source_system", "owner", "criticality_tier", "freshness_sla_minutes")),
    "kinds": """
        select *, case when value = '' then 0 when lower(trim(value)) in ('true', 'false') then 1
              when regexp_matches(trim(value), '^[+-]?[0-9]+$') then 2
              when regexp_matches(trim(value), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') then 4
              when regexp_matches(trim(value), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(T[0-9:]+Z| [0-9:]+)$') then 8
              when regexp_matches(trim(value), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') then 16 else 32 end as kind
        from (unpivot (select source_system, day, event_id, value, seen_at, flag, seen_on from typed_text)
              on event_id, value, seen_at, flag, seen_on into name column_name value value)""",
    "schema_fields": """
        select source_system, day, column_name, blanks > 0 as nullable,
          case when bits = 0 then 'string' when bits = 2 then 'integer' when (bits & ~6) = 0 then 'decimal'
            when bits = 16 then 'date' when (bits & ~24) = 0 then 'timestamp' when bits = 1 then 'boolean' else 'string' end as data_type
        from (select source_system, day, column_name, bit_or(kind) as bits, count(*) filter (where value = '') as blanks
              from kinds group by 1, 2, 3)""",
    "schema_prints": """
        select source_system, day, substr(sha256('[' || string_agg('{"data_type": "' || data_type || '", "name": "' || column_name
           || '", "nullable": ' || cast(nullable as varchar) || '}', ', ' order by column_name) || ']'), 1, 16) as fingerprint
        from schema_fields group by 1, 2""",
})


def oracle(body: str) -> str:
    """``body`` with the building blocks it needs, in order of use."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join)\s+\(?\s*{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    blocks = "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in needed)
    own = body.lstrip()
    return f"{blocks},\n{own[5:]}" if own.startswith("with ") else f"{blocks}\n{body}"
