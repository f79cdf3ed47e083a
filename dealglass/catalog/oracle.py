"""DuckDB SQL for every registered query, over the same files.

Money is carried as whole cents and every rounded figure is one exact integer
division, so the expected values do not depend on floating-point order.  The
SQL keeps to plain joins and filters on whole tables; where the Spark side
avoids a row-multiplying or cross join, the SQL here performs it, so that the
two formulations check each other.
"""

from __future__ import annotations

import re

from dealglass.catalog.expected import DOMAINS, STAGES, labels

AS_OF = "DATE '2001-06-01'"


# ---------------------------------------------------------------- SQL snippets

def over(num: str, den: str, k: int = 100) -> str:
    """num / den rounded half away from zero to log10(k) digits, from whole numbers."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) * ((2 * {k} * abs({n}) + abs({d})) "
            f"// (2 * abs({d}))) AS DOUBLE) / {k} END)")


def avg_money(cents: str, n: str) -> str:
    return over(cents, f"100 * {n}")


def pct(num: str, den: str) -> str:
    return over(f"100 * {num}", den)


def usd(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def n(expr: str = "*") -> str:
    return f"CAST(count({expr}) AS BIGINT)"


def n_if(cond: str) -> str:
    return f"(count(*) FILTER (WHERE {cond}))"


def sum_if(cond: str, value: str) -> str:
    return f"coalesce(sum({value}) FILTER (WHERE {cond}), 0)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def pick(expr: str, keys: list, values: list[str], default: str | None = None) -> str:
    whens = " ".join(
        f"WHEN {k!r} THEN '{v}'" if isinstance(k, str) else f"WHEN {k} THEN '{v}'"
        for k, v in zip(keys, values))
    tail = f" ELSE '{default}'" if default else ""
    return f"CASE {expr} {whens}{tail} END"


# ------------------------------------------------------------- domain tables

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

TABLES = {
    "stage": "SELECT * FROM (VALUES " + ", ".join(
        f"({o}, '{s}', {int(float(p))}, {c}, {w})" for s, o, p, c, w in STAGES
    ) + ") v(stage_id, stage_name, prob, closed, won)",
    "cust": """SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS industry,
        n_name AS country, r_name AS region, CAST(round(c_acctbal * 100) AS BIGINT) AS bal_c,
        CASE WHEN c_acctbal >= 7000 THEN 'Enterprise' WHEN c_acctbal >= 3000 THEN 'Mid-Market'
             ELSE 'SMB' END AS customer_tier,
        CASE WHEN c_acctbal < 0 THEN 'Churned' WHEN c_acctbal < 600 THEN 'At-Risk'
             ELSE 'Active' END AS status
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "deal": f"""SELECT o_orderkey AS deal_id, o_custkey AS customer_id,
        CASE o_orderstatus
          WHEN 'F' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 7 ELSE 6 END
          WHEN 'P' THEN CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 5 ELSE 4 END
          ELSE CASE left(o_orderpriority, 1)
               WHEN '1' THEN 3 WHEN '2' THEN 3 WHEN '3' THEN 2 ELSE 1 END
        END AS stage_id,
        'Deal ' || o_orderkey AS deal_name,
        CAST(round(o_totalprice * 100) AS BIGINT) AS val_c,
        CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 120 AS INTEGER) AS close_on,
        CASE WHEN o_orderstatus = 'F'
             THEN CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 80 AS INTEGER) END AS closed_on,
        o_orderdate AS created_at, CAST(o_orderdate AS DATE) AS created_on,
        {pick("o_orderpriority", PRIORITIES, DOMAINS["deals", "deal_source"])} AS deal_source,
        'rep_' || (o_orderkey % 25) AS rep, CAST(o_orderkey % 69 AS INTEGER) AS age,
        o_orderstatus <> 'F' AS active
        FROM orders""",
    "staged": "SELECT * FROM deal JOIN stage USING (stage_id)",
    "prod": """SELECT p_partkey AS product_id, p_name || ' #' || p_partkey AS product_name, p_name,
        p_type AS category, CAST(round(p_retailprice * 100) AS BIGINT) AS price_c,
        CASE WHEN p_size <= 10 THEN 'One-Time' WHEN p_size <= 25 THEN 'Monthly'
             ELSE 'Annual' END AS billing, p_size > 5 AS on_sale FROM part""",
    "line": f"""SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber
          AS line_id, l_orderkey AS deal_id, l_partkey AS product_id,
        CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice * 100) AS BIGINT) AS unit_c,
        CAST(round(l_discount * 100) AS BIGINT) AS disc,
        (2 * CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT)
          * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 100) // 200 AS total_c
        FROM lineitem""",
    "act": f"""SELECT row_number() OVER () AS activity_id, l_orderkey AS deal_id,
        {pick("l_linenumber", list(range(1, 8)), DOMAINS["activities", "activity_type"])} AS kind,
        l_shipdate AS touched_at, CAST(l_shipdate AS DATE) AS on_day,
        CASE WHEN l_returnflag = 'A' THEN 'Positive' WHEN l_returnflag = 'N' THEN 'Neutral'
             WHEN l_linestatus = 'F' THEN 'No Response' ELSE 'Negative' END AS outcome
        FROM lineitem""",
    "cact": "SELECT act.*, customer_id FROM act JOIN deal USING (deal_id)",
    "rev0": f"""SELECT o_orderkey AS revenue_id, o_custkey AS customer_id,
        {pick("o_orderpriority", PRIORITIES, DOMAINS["revenue_records", "revenue_type"])} AS kind,
        CAST(round(o_totalprice * 100) AS BIGINT) AS amt_c,
        CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 80 AS INTEGER) AS billed_on,
        {pick("o_orderkey % 4", list(range(4)), DOMAINS["revenue_records", "billing_period"])}
          AS period,
        {pick("o_orderkey % 5", list(range(4)), DOMAINS["revenue_records", "payment_status"],
              "Paid")} AS paid
        FROM orders WHERE o_orderstatus = 'F'""",
    "rev": """SELECT *,
        CASE period WHEN 'Annual' THEN (2 * amt_c + 12) // 24
                    WHEN 'Quarterly' THEN (2 * amt_c + 3) // 6
                    WHEN 'Monthly' THEN amt_c ELSE 0 END AS mrr_c,
        CASE period WHEN 'Annual' THEN amt_c WHEN 'Quarterly' THEN 4 * amt_c
                    WHEN 'Monthly' THEN 12 * amt_c ELSE 0 END AS arr_c FROM rev0""",
    "sig": f"""SELECT event_id AS signal_id, user_id AS customer_id, event_id AS deal_id,
        {pick("CAST(props->>'$.k' AS INTEGER) % 7", list(range(7)),
              DOMAINS["churn_signals", "signal_type"])} AS kind,
        CASE WHEN value < 20 THEN 'Low' WHEN value < 60 THEN 'Medium' WHEN value < 120 THEN 'High'
             ELSE 'Critical' END AS severity,
        ts AS detected_at, CAST(props->>'$.k' AS INTEGER) < 10 AS resolved
        FROM events WHERE event_type = 'error'""",
    "fc0": f"""SELECT rep, mon, pipe_c, (pipe_c + 1) // 2 AS commit_c,
        CASE WHEN mon < {month(AS_OF)} THEN won_c END AS actual_c
        FROM (SELECT rep, {month("close_on")} AS mon, sum(val_c) AS pipe_c,
              sum(val_c) FILTER (WHERE stage_id = 6) AS won_c FROM deal GROUP BY 1, 2)""",
    "fc": f"""SELECT *, {pct("actual_c", "commit_c")} AS acc,
        CAST(round(100 * {pct("actual_c", "commit_c")}) AS BIGINT) AS acc_c FROM fc0""",
    # one row per key
    "by_deal_act": f"""SELECT deal_id, count(*) AS acts, max(touched_at) AS last_at, max(on_day) AS last_on,
        {n_if("outcome = 'Negative'")} AS neg, {n_if("outcome = 'No Response'")} AS mute,
        {n_if("outcome = 'Positive'")} AS pos, {n_if("kind = 'Demo'")} AS demos,
        {n_if("kind = 'Meeting'")} AS meets FROM act GROUP BY deal_id""",
    "by_cust_act": f"""SELECT customer_id, count(*) AS acts, max(touched_at) AS last_at,
        max(on_day) AS last_on, {n_if("outcome = 'Negative'")} AS neg
        FROM cact GROUP BY customer_id""",
    "by_cust_deal": f"""SELECT customer_id, count(*) AS deals, {n_if("won")} AS won_n,
        {n_if("closed AND NOT won")} AS lost_n, {n_if("closed")} AS closed_n,
        {sum_if("won", "val_c")} AS won_c, min(created_on) AS first_on, max(created_on) AS last_on
        FROM staged GROUP BY customer_id""",
    "by_cust_rev": f"""SELECT customer_id, count(*) AS bills, sum(amt_c) AS amt_c,
        {sum_if("paid = 'Overdue'", "amt_c")} AS due_c, {n_if("paid = 'Overdue'")} AS due_n,
        {sum_if("kind = 'Expansion'", "amt_c")} AS exp_c, sum(mrr_c) AS mrr_c, sum(arr_c) AS arr_c
        FROM rev GROUP BY customer_id""",
    "by_cust_sig": f"""SELECT customer_id, count(*) AS sigs, {n_if("severity = 'Critical'")} AS crit,
        {n_if("severity = 'High'")} AS high, {n_if("NOT resolved")} AS open_n,
        {n_if("NOT resolved AND severity = 'Critical'")} AS open_crit,
        {n_if("NOT resolved AND severity = 'High'")} AS open_high,
        {n_if("NOT resolved AND severity = 'Medium'")} AS open_med,
        {n_if("NOT resolved AND severity = 'Low'")} AS open_low,
        {n_if("kind = 'Contract Expiring'")} AS expiring,
        {n_if("kind = 'Competitor Mention'")} AS rival FROM sig GROUP BY customer_id""",
    "by_rep": f"""SELECT rep, count(*) AS deals, {n_if("won")} AS won_n,
        {n_if("closed AND NOT won")} AS lost_n, {n_if("closed")} AS closed_n,
        {n_if("active")} AS active_n, {sum_if("won", "val_c")} AS won_c,
        {sum_if("active", "val_c")} AS active_c,
        sum(closed_on - created_on) FILTER (WHERE won) AS close_days,
        count(closed_on) FILTER (WHERE won) AS close_n,
        {n_if(f"active AND close_on < {AS_OF}")} AS late_n FROM staged GROUP BY rep""",
    "by_stage_active": f"""SELECT stage.*, count(deal_id) AS deals, sum(val_c) AS val_c,
        sum(age) AS age_sum, count(age) AS age_n, {n_if("age > 30")} AS stale,
        {n_if(f"close_on < {AS_OF}")} AS late, {n_if("deal_source = 'Inbound'")} AS inb,
        {n_if("deal_source = 'Outbound'")} AS outb, {n_if("deal_source = 'Referral'")} AS refr,
        {n_if("deal_source = 'Partner'")} AS part, {n_if("deal_source = 'Renewal'")} AS ren
        FROM stage LEFT JOIN deal ON deal.stage_id = stage.stage_id AND active
        GROUP BY stage.stage_id, stage_name, prob, closed, won""",
    "owned": """SELECT customer_id, product_id, sum(total_c) AS owned_c
        FROM line JOIN staged USING (deal_id) WHERE won GROUP BY ALL""",
    # row-multiplied joins, as a direct join of the child tables gives them
    "wide_health": """SELECT c.customer_id, d.deal_id, d.won, d.val_c, a.activity_id, s.*
        EXCLUDE (customer_id, deal_id)
        FROM cust c LEFT JOIN staged d ON d.customer_id = c.customer_id
        LEFT JOIN cact a ON a.customer_id = c.customer_id
        LEFT JOIN sig s ON s.customer_id = c.customer_id""",
    "wide_segment": """SELECT c.customer_id, customer_tier, industry, country, status, d.deal_id,
        d.won, d.closed, d.val_c, r.mrr_c, r.arr_c
        FROM cust c LEFT JOIN staged d ON d.customer_id = c.customer_id
        LEFT JOIN rev r ON r.customer_id = c.customer_id""",
    "wide_clv": """SELECT c.customer_id, d.won, d.val_c, r.kind AS rev_kind, r.amt_c
        FROM cust c LEFT JOIN staged d ON d.customer_id = c.customer_id
        LEFT JOIN cact a ON a.customer_id = c.customer_id
        LEFT JOIN rev r ON r.customer_id = c.customer_id
        LEFT JOIN sig s ON s.customer_id = c.customer_id AND NOT s.resolved""",
    "wide_rep": """SELECT s.*, f.acc_c FROM staged s LEFT JOIN fc f ON f.rep = s.rep""",
    "months": f"""SELECT {month("billed_on")} AS mon, count(DISTINCT customer_id) AS payers,
        count(*) AS recs, sum(amt_c) AS amt_c, sum(mrr_c) AS mrr_c, sum(arr_c) AS arr_c,
        {sum_if("kind = 'New Business'", "amt_c")} AS new_c,
        {sum_if("kind = 'Expansion'", "amt_c")} AS exp_c,
        {sum_if("kind = 'Renewal'", "amt_c")} AS ren_c,
        {sum_if("kind = 'Churn'", "amt_c")} AS churn_c,
        {sum_if("kind = 'New Business'", "mrr_c")} AS new_mrr,
        {sum_if("kind = 'Expansion'", "mrr_c")} AS exp_mrr,
        {sum_if("kind = 'Renewal'", "mrr_c")} AS ren_mrr,
        {sum_if("kind = 'Churn'", "mrr_c")} AS churn_mrr
        FROM rev GROUP BY 1""",
    "type_months": f"""SELECT {month("billed_on")} AS mon, kind, count(*) AS recs,
        sum(amt_c) AS amt_c, sum(mrr_c) AS mrr_c, sum(arr_c) AS arr_c,
        {sum_if("paid = 'Paid'", "amt_c")} AS paid_c, {sum_if("paid = 'Overdue'", "amt_c")} AS due_c,
        {sum_if("paid = 'Pending'", "amt_c")} AS pend_c FROM rev GROUP BY 1, 2""",
}


def with_tables(body: str, instead: dict[str, str] | None = None) -> str:
    """Prefixes the domain tables a query uses, in dependency order."""
    tables = {**TABLES, **(instead or {})}
    def used(sql: str) -> set[str]:
        words = set(re.findall(r"\b[a-z_0-9]+\b", re.sub(r"'[^']*'", "", sql)))
        return words & set(tables)

    needed, todo = set(), used(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= used(tables[name]) - {name}
    ctes = ",\n".join(f"{t} AS ({tables[t]})" for t in tables if t in needed)
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- analytics

def stage_summary(total: str, weighted: str, extra: str = "") -> str:
    return f"""SELECT stage_name, {big("stage_id")} AS stage_order, CAST(prob AS DOUBLE) AS probability,
        {big("deals")} AS total_deals, {usd("val_c")} AS {total},
        {over("val_c * prob", "10000")} AS {weighted},
        {avg_money("val_c", "deals")} AS avg_deal_value,
        {over("age_sum", "age_n")} AS avg_days_in_stage, {big("stale")} AS stagnant_deals,
        {big("late")} AS overdue_deals {extra} FROM by_stage_active"""


IDLE = f"({AS_OF} - last_on)"
LATE = f"({AS_OF} - close_on)"

DEAL_ROWS = """FROM staged JOIN cust USING (customer_id) LEFT JOIN by_deal_act USING (deal_id)"""

SQL: dict[str, str] = {}

SQL["pipeline_summary"] = stage_summary("total_pipeline_value", "weighted_pipeline_value")
SQL["pipeline_health"] = stage_summary(
    "total_value", "weighted_value",
    f""", {big("inb")} AS inbound_deals, {big("outb")} AS outbound_deals,
        {big("refr")} AS referral_deals, {big("part")} AS partner_deals,
        {big("ren")} AS renewal_deals""")

SQL["deal_risk_scores"] = f"""SELECT deal_id, deal_name, company_name, stage_name,
    {usd("val_c")} AS deal_value, {big("age")} AS days_in_stage, {text("close_on")} AS expected_close_date,
    rep AS assigned_rep, {big(LATE)} AS days_overdue, {big("coalesce(acts, 0)")} AS total_activities,
    {stamp("last_at")} AS last_activity_date, {big(IDLE)} AS days_since_last_activity,
    {big("coalesce(neg, 0)")} AS negative_signals, {big("coalesce(mute, 0)")} AS no_response_count,
    CASE WHEN {IDLE} > 45 THEN 'Critical' WHEN {IDLE} > 30 THEN 'High' WHEN {LATE} > 14 THEN 'High'
         WHEN age > 45 THEN 'High' WHEN {IDLE} > 14 THEN 'Medium' WHEN age > 30 THEN 'Medium'
         WHEN neg > 1 THEN 'Medium' ELSE 'Low' END AS risk_level,
    CAST(4 * coalesce({IDLE}, 0) + 3 * age + 2 * {LATE} + 10 * coalesce(neg, 0) AS DOUBLE) / 10
      AS risk_score {DEAL_ROWS} WHERE active"""

HEALTH_10 = f"(1000 - 5 * coalesce({IDLE}, 0) - 3 * age)"
SQL["deal_health_score"] = f"""SELECT deal_id, deal_name, company_name, {usd("val_c")} AS deal_value,
    stage_name, {big("age")} AS days_in_stage, {big(IDLE)} AS days_since_activity,
    {big("coalesce(acts, 0)")} AS activity_count, {big("coalesce(neg, 0)")} AS negative_signals,
    CAST({HEALTH_10} - 50 * coalesce(neg, 0) AS DOUBLE) / 10 AS health_score,
    CASE WHEN {HEALTH_10} < 200 THEN 'Critical' WHEN {HEALTH_10} < 450 THEN 'At Risk'
         WHEN {HEALTH_10} < 650 THEN 'Needs Attention' ELSE 'Healthy' END AS health_status
    {DEAL_ROWS}"""

SQL["pipeline_scoring"] = f"""WITH open_sig AS (SELECT deal_id, count(*) AS open_n,
      {n_if("severity = 'Critical'")} AS crit, {n_if("severity = 'High'")} AS high
      FROM sig WHERE NOT resolved GROUP BY deal_id)
    SELECT deal_name, company_name, customer_tier, stage_name, {usd("val_c")} AS deal_value,
    {text("close_on")} AS expected_close_date, rep AS assigned_rep, {big("age")} AS days_in_stage,
    {big("coalesce(acts, 0)")} AS total_activities,
    {text("coalesce(last_on, created_on)")} AS last_activity_date,
    {big(f"coalesce({IDLE}, age)")} AS days_since_activity,
    {big("coalesce(neg, 0)")} AS negative_outcomes, {big("coalesce(mute, 0)")} AS no_responses,
    {big("coalesce(open_n, 0)")} AS churn_signals, {big("coalesce(crit, 0)")} AS critical_signals,
    CASE WHEN close_on < {AS_OF} THEN 'OVERDUE' WHEN close_on - 7 < {AS_OF} THEN 'CLOSING SOON'
         ELSE 'ON TRACK' END AS close_date_status,
    CAST(35 * coalesce({IDLE}, 0) + 25 * age + 20 * {LATE} + 80 * coalesce(neg, 0)
         + 60 * coalesce(mute, 0) AS DOUBLE) / 100 AS risk_score,
    CASE WHEN coalesce({IDLE}, 0) > 45 OR coalesce(crit, 0) > 0 THEN '{labels.RISK_CRITICAL}'
         WHEN coalesce({IDLE}, 0) > 30 OR age > 45 OR coalesce(high, 0) > 0 THEN '{labels.RISK_HIGH}'
         WHEN coalesce({IDLE}, 0) > 14 OR age > 30 THEN '{labels.RISK_MEDIUM}'
         ELSE '{labels.RISK_LOW}' END AS risk_level,
    {over("val_c * prob", "10000")} AS weighted_value
    {DEAL_ROWS} LEFT JOIN open_sig USING (deal_id) WHERE active"""

SQL["funnel_velocity"] = f"""WITH f AS (SELECT stage.stage_id, stage_name, prob,
      count(deal_id) AS deals, sum(val_c) AS val_c, {over("sum(age)", "count(age)")} AS pace,
      {n_if("won")} AS won_n, {n_if("closed AND NOT won")} AS lost_n,
      {sum_if("won", "val_c")} AS won_c, {sum_if("closed AND NOT won", "val_c")} AS lost_c
      FROM stage LEFT JOIN deal ON deal.stage_id = stage.stage_id GROUP BY 1, 2, 3),
    g AS (SELECT *, lag(deals) OVER (ORDER BY stage_id) AS before_n FROM f)
    SELECT stage_name, {big("stage_id")} AS stage_order, CAST(prob AS DOUBLE) AS probability,
    {big("deals")} AS total_deals, {usd("val_c")} AS total_value, pace AS avg_days_in_stage,
    {big("won_n")} AS won_deals, {big("lost_n")} AS lost_deals, {usd("won_c")} AS won_value,
    {usd("lost_c")} AS lost_value, {pct("won_n", "deals")} AS conversion_rate_percent,
    {pct("lost_n", "deals")} AS loss_rate_percent,
    {pct("deals", "before_n")} AS stage_to_stage_conversion,
    {pct("lost_c", "val_c")} AS revenue_leak_percent,
    CASE WHEN pace > 45 THEN 'Slow' WHEN pace > 25 THEN 'Moderate' ELSE 'Fast' END
      AS velocity_status FROM g"""

SQL["win_loss"] = f"""WITH seg AS (SELECT customer_tier, industry, deal_source,
      {pct(n_if("won"), n_if("closed"))} AS seg_rate
      FROM staged JOIN cust USING (customer_id) GROUP BY ALL)
    SELECT CASE WHEN won THEN 'Won' ELSE 'Lost' END AS outcome,
    {n()} AS total_deals, {avg_money("sum(val_c)", "count(*)")} AS avg_deal_value,
    {usd("sum(val_c)")} AS total_value,
    {over("sum(closed_on - created_on)", "count(closed_on)", 1)} AS avg_days_to_close,
    {over("coalesce(sum(acts), 0)", "count(*)")} AS avg_activities,
    {over("coalesce(sum(demos), 0)", "count(*)")} AS avg_demos,
    {over("coalesce(sum(meets), 0)", "count(*)")} AS avg_meetings,
    {over("coalesce(sum(pos), 0)", "count(*)")} AS avg_positive_signals,
    {over("coalesce(sum(neg), 0)", "count(*)")} AS avg_negative_signals,
    customer_tier, industry, deal_source, {pct(n_if("won"), "count(*)")} AS win_rate_percent,
    any_value(seg_rate) AS segment_win_rate_percent
    {DEAL_ROWS} JOIN seg USING (customer_tier, industry, deal_source)
    WHERE closed GROUP BY won, customer_tier, industry, deal_source"""

SQL["revenue_by_month"] = f"""WITH t AS (SELECT *, lag(amt_c) OVER (PARTITION BY kind ORDER BY mon)
      AS prev_c FROM type_months)
    SELECT {text("mon")} AS revenue_month, kind AS revenue_type, {big("recs")} AS total_transactions,
    {usd("amt_c")} AS total_revenue, {avg_money("amt_c", "recs")} AS avg_transaction_value,
    {usd("mrr_c")} AS total_mrr, {usd("arr_c")} AS total_arr, {usd("paid_c")} AS collected_revenue,
    {usd("due_c")} AS overdue_revenue, {usd("pend_c")} AS pending_revenue,
    {usd("(amt_c - prev_c)")} AS mom_revenue_change,
    {pct("(amt_c - prev_c)", "prev_c")} AS mom_growth_percent FROM t"""

SQL["monthly_revenue_summary"] = SQL["mv_roundtrip"] = f"""WITH t AS (SELECT *,
      lag(amt_c) OVER (ORDER BY mon) AS prev_c FROM months)
    SELECT {text("mon")} AS revenue_month, {big("payers")} AS paying_customers,
    {big("recs")} AS total_transactions, {usd("amt_c")} AS total_revenue, {usd("mrr_c")} AS total_mrr,
    {usd("arr_c")} AS total_arr, {usd("new_c")} AS new_business_revenue,
    {usd("exp_c")} AS expansion_revenue, {usd("ren_c")} AS renewal_revenue,
    {usd("churn_c")} AS churned_revenue, {usd("(amt_c - prev_c)")} AS mom_change,
    {pct("(amt_c - prev_c)", "prev_c")} AS mom_growth_percent FROM t"""

SQL["stream_monthly_revenue"] = f"""WITH t AS (SELECT *,
      lag(amt_c) OVER (ORDER BY mon) AS prev_c FROM months)
    SELECT {text("mon")} AS revenue_month, {big("payers")} AS paying_customers,
    {big("recs")} AS total_transactions,
    {usd("amt_c")} AS total_revenue, {usd("mrr_c")} AS total_mrr, {usd("arr_c")} AS total_arr,
    {usd("new_c")} AS new_business_revenue, {usd("exp_c")} AS expansion_revenue,
    {usd("ren_c")} AS renewal_revenue, {usd("churn_c")} AS churned_revenue,
    {usd("(amt_c - prev_c)")} AS mom_change,
    {pct("(amt_c - prev_c)", "prev_c")} AS mom_growth_percent FROM t"""

SQL["mrr_trend"] = f"""WITH t AS (SELECT *, lag(mrr_c) OVER (ORDER BY mon) AS prev_c,
      sum(mrr_c) OVER (ORDER BY mon) AS run_c FROM months)
    SELECT {text("mon")} AS revenue_month, {usd("mrr_c")} AS total_mrr, {usd("arr_c")} AS total_arr,
    {usd("new_mrr")} AS new_mrr, {usd("exp_mrr")} AS expansion_mrr, {usd("ren_mrr")} AS renewal_mrr,
    {usd("churn_mrr")} AS churned_mrr, {big("payers")} AS paying_customers,
    {usd("(mrr_c - prev_c)")} AS mrr_change, {pct("(mrr_c - prev_c)", "prev_c")} AS mrr_growth_percent,
    {usd("run_c")} AS cumulative_mrr, {avg_money("mrr_c", "payers")} AS arpu,
    CASE sign(mrr_c - prev_c) WHEN 1 THEN '{labels.TREND_GROWING}'
      WHEN -1 THEN '{labels.TREND_DECLINING}' ELSE '{labels.TREND_FLAT}' END AS growth_trend,
    {usd("(mrr_c - churn_mrr)")} AS net_mrr FROM t"""

SQL["revenue_forecast"] = f"""WITH w AS (SELECT CAST(round(100 * {pct(n_if("won"), n_if("closed"))})
      AS BIGINT) AS rate_c FROM staged),
    p AS (SELECT {month("close_on")} AS mon, count(*) AS deals, sum(val_c) AS pipe_c,
      sum(val_c * prob) AS wt FROM staged
      WHERE active AND close_on >= {AS_OF} AND close_on <= {AS_OF} + INTERVAL 3 MONTH GROUP BY 1)
    SELECT {text("mon")} AS forecast_month, {big("deals")} AS active_deals,
    {usd("pipe_c")} AS total_pipeline, {over("wt", "10000")} AS weighted_forecast,
    {over("pipe_c * 90", "10000")} AS best_case, {over("pipe_c * 40", "10000")} AS worst_case,
    CAST(rate_c AS DOUBLE) / 100 AS historical_win_rate,
    {over("pipe_c * rate_c", "1000000")} AS predicted_revenue FROM p, w"""

SQL["rep_forecast"] = f"""WITH h AS (SELECT rep, {pct("won_n", "closed_n")} AS rate,
      CAST(round(100 * {pct("won_n", "closed_n")}) AS BIGINT) AS rate_c,
      {over("close_days", "close_n", 1)} AS days FROM by_rep),
    p AS (SELECT {month("close_on")} AS mon, rep, count(*) AS deals, sum(val_c) AS pipe_c,
      CAST(round({over("sum(val_c * prob)", "10000")} * 100) AS HUGEINT) AS wt_c FROM staged
      WHERE active AND close_on >= {AS_OF} GROUP BY 1, 2)
    SELECT {text("mon")} AS forecast_month, rep AS assigned_rep, {big("deals")} AS deals_in_period,
    {usd("pipe_c")} AS total_pipeline, {usd("wt_c")} AS weighted_pipeline,
    {over("pipe_c * 90", "10000")} AS best_case, {over("pipe_c * 40", "10000")} AS worst_case,
    rate AS historical_win_rate, days AS avg_days_to_close,
    {over("pipe_c * rate_c", "1000000")} AS predicted_revenue,
    {over("wt_c * 10000 - pipe_c * rate_c", "1000000")} AS forecast_gap,
    CASE sign(wt_c * 10000 - pipe_c * rate_c) WHEN 1 THEN 'Optimistic' WHEN -1 THEN 'Conservative'
      ELSE 'On Target' END AS forecast_bias FROM p LEFT JOIN h USING (rep)"""

SQL["revenue_anomalies"] = f"""WITH s AS (SELECT kind, avg(CAST(amt_c AS DOUBLE) / 100) AS mu,
      stddev_samp(CAST(amt_c AS DOUBLE) / 100) AS sd FROM type_months GROUP BY kind),
    z AS (SELECT mon, kind, amt_c, round((CAST(amt_c AS DOUBLE) / 100 - mu) / sd, 4) AS z
      FROM type_months JOIN s USING (kind))
    SELECT {text("mon")} AS revenue_month, kind AS revenue_type, {usd("amt_c")} AS total_revenue,
    z AS z_score, abs(z) > 2 AS is_anomaly FROM z"""

SQL["forecast_accuracy"] = f"""SELECT {text("mon")} AS forecast_month, rep AS assigned_rep,
    {usd("pipe_c")} AS pipeline_value, {over("pipe_c * 70", "10000")} AS weighted_pipeline,
    {usd("commit_c")} AS committed_value, {usd("actual_c")} AS actual_revenue,
    acc AS forecast_accuracy FROM fc"""

SQL["derive_mrr_arr"] = f"""SELECT revenue_id, period AS billing_period, {usd("amt_c")} AS amount,
    {usd("mrr_c")} AS mrr_contribution, {usd("arr_c")} AS arr_contribution FROM rev"""


def rep_rows(source: str) -> str:
    """Rep figures over ``source`` rows; ``wide_rep`` repeats a deal per forecast."""
    return f"""SELECT rep AS assigned_rep, {n()} AS total_deals, {big(n_if("won"))} AS deals_won,
    {big(n_if("closed AND NOT won"))} AS deals_lost, {big(n_if("active"))} AS active_deals,
    {usd(sum_if("won", "val_c"))} AS total_revenue_won,
    {avg_money(sum_if("won", "val_c"), n_if("won"))} AS avg_won_deal_value,
    {usd(sum_if("active", "val_c"))} AS active_pipeline_value,
    {pct(n_if("won"), n_if("closed"))} AS win_rate_percent,
    {over("sum(closed_on - created_on) FILTER (WHERE won)",
          "count(closed_on) FILTER (WHERE won)", 1)} AS avg_days_to_close,
    {big(n_if(f"active AND close_on < {AS_OF}"))} AS overdue_deals,
    any_value(acc) AS avg_forecast_accuracy
    FROM {source} LEFT JOIN (SELECT rep, {over("sum(acc_c)", "100 * count(acc_c)")} AS acc
      FROM fc GROUP BY rep) USING (rep) GROUP BY rep"""


SQL["rep_performance"] = rep_rows("staged")
SQL["rep_performance_asis"] = rep_rows("wide_rep")

SQL["rep_leaderboard"] = f"""WITH t AS (SELECT *, won_n + lost_n AS done,
      sum(won_c) OVER () AS all_c, rank() OVER (ORDER BY won_c DESC) AS place FROM by_rep)
    SELECT rep AS assigned_rep, {big("deals")} AS total_deals, {big("won_n")} AS won_deals,
    {big("lost_n")} AS lost_deals, {big("active_n")} AS active_deals, {usd("won_c")} AS total_revenue,
    {usd("active_c")} AS active_pipeline, {avg_money("won_c", "won_n")} AS avg_won_value,
    {over("close_days", "close_n", 1)} AS avg_days_to_close, {big("late_n")} AS overdue_deals,
    {pct("won_n", "done")} AS win_rate_percent, {pct("won_c", "all_c")} AS revenue_share_percent,
    {big("place")} AS revenue_rank,
    CASE WHEN done = 0 THEN '{labels.REP_UNDER}' WHEN 10 * won_n >= 7 * done THEN '{labels.REP_TOP}'
         WHEN 10 * won_n >= 5 * done THEN '{labels.REP_ON_TRACK}'
         WHEN 10 * won_n >= 3 * done THEN '{labels.REP_COACHING}' ELSE '{labels.REP_UNDER}' END
      AS performance_status FROM t"""

CUSTOMER_ROWS = """FROM cust LEFT JOIN by_cust_deal d USING (customer_id)
    LEFT JOIN by_cust_act a USING (customer_id) LEFT JOIN by_cust_rev r USING (customer_id)
    LEFT JOIN by_cust_sig s USING (customer_id)"""
C_IDLE = f"({AS_OF} - a.last_on)"


def health(total: str, crit: str, high: str, opened: str, join: str = "") -> str:
    return f"""SELECT customer_id, company_name, customer_tier, industry, status,
    {big("coalesce(deals, 0)")} AS total_deals, {usd(total)} AS total_revenue,
    {avg_money("d.won_c", "won_n")} AS avg_deal_value, {big("coalesce(acts, 0)")} AS total_activities,
    {stamp("a.last_at")} AS last_activity_date, {big(C_IDLE)} AS days_since_activity,
    {big("coalesce(sigs, 0)")} AS total_churn_signals, {big(crit)} AS critical_signals,
    {big(high)} AS high_signals, {big(opened)} AS unresolved_signals,
    CASE WHEN open_crit > 0 THEN 20.0 WHEN open_high > 0 THEN 45.0 WHEN open_med > 0 THEN 65.0
         WHEN {C_IDLE} > 30 THEN 70.0 WHEN open_low > 0 THEN 80.0 ELSE 95.0 END::DOUBLE
      AS health_score,
    CASE WHEN open_crit > 0 THEN 'Critical' WHEN open_high > 0 THEN 'At Risk'
         WHEN open_med > 0 OR {C_IDLE} > 30 THEN 'Needs Attention' ELSE 'Healthy' END
      AS health_status {CUSTOMER_ROWS} {join}"""


SQL["customer_health"] = health(
    "coalesce(d.won_c, 0)", "coalesce(crit, 0)", "coalesce(high, 0)", "coalesce(open_n, 0)")
SQL["customer_health_asis"] = f"""WITH x AS (SELECT customer_id, {sum_if("won", "val_c")} AS x_won,
      {n_if("severity = 'Critical'")} AS x_crit, {n_if("severity = 'High'")} AS x_high,
      {n_if("NOT resolved")} AS x_open FROM wide_health GROUP BY customer_id)
    {health("x_won", "x_crit", "x_high", "x_open", "JOIN x USING (customer_id)")}"""

SQL["customer_segments"] = f"""SELECT customer_tier, industry, country, {n()} AS total_customers,
    {big("coalesce(sum(deals), 0)")} AS total_deals, {usd("coalesce(sum(won_c), 0)")} AS total_revenue,
    {avg_money("sum(won_c)", "sum(won_n)")} AS avg_deal_value,
    {pct("sum(won_n)", "sum(closed_n)")} AS win_rate_percent,
    {big(n_if("status = 'Churned'"))} AS churned_customers,
    {big(n_if("status = 'At-Risk'"))} AS at_risk_customers,
    {pct(n_if("status = 'Churned'"), "count(*)")} AS churn_rate_percent,
    {usd("sum(mrr_c)")} AS total_mrr, {usd("sum(arr_c)")} AS total_arr
    {CUSTOMER_ROWS} GROUP BY customer_tier, industry, country"""

SQL["customer_segments_asis"] = f"""SELECT customer_tier, industry, country,
    {n("DISTINCT customer_id")} AS total_customers, {n("DISTINCT deal_id")} AS total_deals,
    {usd(sum_if("won", "val_c"))} AS total_revenue,
    {avg_money(sum_if("won", "val_c"), n_if("won"))} AS avg_deal_value,
    {pct(n_if("won"), n_if("closed"))} AS win_rate_percent,
    {big(n_if("status = 'Churned'"))} AS churned_customers,
    {big(n_if("status = 'At-Risk'"))} AS at_risk_customers,
    {pct(n_if("status = 'Churned'"), "count(DISTINCT customer_id)")} AS churn_rate_percent,
    {usd("sum(mrr_c)")} AS total_mrr, {usd("sum(arr_c)")} AS total_arr
    FROM wide_segment GROUP BY customer_tier, industry, country"""

MONTHS = f"(({AS_OF} - d.first_on) // 30)"


def lifetime(total: str, won: str, expansion: str, join: str = "") -> str:
    return f"""SELECT customer_id, company_name, customer_tier, industry, {usd(total)} AS total_revenue,
    {big("coalesce(deals, 0)")} AS total_deals, {big(won)} AS won_deals,
    {avg_money("d.won_c", "won_n")} AS avg_deal_value, {big("coalesce(acts, 0)")} AS total_activities,
    {text("d.first_on")} AS first_deal_date, {text("d.last_on")} AS latest_deal_date,
    {big(f"({AS_OF} - d.first_on)")} AS customer_age_days,
    {avg_money(total, MONTHS)} AS avg_monthly_revenue,
    {avg_money(f"12 * {total}", MONTHS)} AS projected_annual_value,
    {usd(expansion)} AS expansion_revenue,
    CAST(20 * coalesce(open_n, 0) + coalesce({C_IDLE}, 0) AS DOUBLE) / 2 AS churn_risk_score,
    {avg_money(f"24 * {total}", MONTHS)} AS clv_estimate {CUSTOMER_ROWS} {join}"""


SQL["customer_lifetime_value"] = lifetime(
    "coalesce(d.won_c, 0)", "coalesce(won_n, 0)", "coalesce(r.exp_c, 0)")
SQL["customer_lifetime_value_asis"] = f"""WITH x AS (SELECT customer_id,
      {sum_if("won", "val_c")} AS x_won, {n_if("won")} AS x_won_n,
      {sum_if("rev_kind = 'Expansion'", "amt_c")} AS x_exp FROM wide_clv GROUP BY customer_id)
    {lifetime("x_won", "x_won_n", "x_exp", "JOIN x USING (customer_id)")}"""

SQL["churn_risk_ranking"] = f"""SELECT company_name, customer_tier, industry, status,
    {big(f"coalesce({C_IDLE}, 999)")} AS days_inactive, {usd("coalesce(due_c, 0)")} AS overdue_amount,
    {usd("coalesce(r.amt_c, 0)")} AS total_revenue, {big("coalesce(sigs, 0)")} AS total_churn_signals,
    {big("coalesce(open_crit, 0)")} AS critical_signals, {big("coalesce(expiring, 0)")} AS expiring_contracts,
    {big("coalesce(rival, 0)")} AS competitor_mentions,
    CAST(coalesce({C_IDLE}, 0) + 4 * (25 * coalesce(open_crit, 0) + 15 * coalesce(open_high, 0)
      + 8 * coalesce(a.neg, 0) + 10 * coalesce(due_n, 0) + 18 * coalesce(rival, 0)
      + 12 * coalesce(expiring, 0)) AS DOUBLE) / 4 AS churn_risk_score,
    CASE WHEN open_crit > 0 OR status = 'Churned' THEN '{labels.RISK_CRITICAL}'
         WHEN open_high > 0 OR due_n > 0 THEN '{labels.RISK_HIGH}'
         WHEN {C_IDLE} > 30 OR expiring > 0 THEN '{labels.RISK_MEDIUM}'
         WHEN exp_c > 0 THEN '{labels.CHURN_EXPANDING}' ELSE '{labels.CHURN_HEALTHY}' END
      AS churn_risk_level {CUSTOMER_ROWS}"""

SQL["customer_segmentation"] = f"""WITH t AS (SELECT customer_id, company_name, customer_tier, status,
      coalesce(d.won_c, 0) AS w, {C_IDLE} AS idle, coalesce({C_IDLE} <= 90, false) AS fresh
      {CUSTOMER_ROWS})
    SELECT customer_id, company_name, customer_tier, {usd("w")} AS total_revenue,
    {big("idle")} AS days_since_activity,
    CASE WHEN w >= 100000000 THEN 'High' WHEN w >= 25000000 THEN 'Mid' ELSE 'Low' END AS value_band,
    CASE WHEN status = 'Churned' THEN 'Lost' WHEN w = 0 THEN 'Prospect'
         WHEN w >= 100000000 THEN CASE WHEN fresh THEN 'Champion' ELSE 'Win Back' END
         WHEN fresh THEN CASE WHEN w >= 25000000 THEN 'Growth' ELSE 'Developing' END
         ELSE 'Dormant' END AS segment FROM t"""

SQL["cohort_analysis"] = f"""WITH c AS (SELECT {month("d.first_on")} AS mon, count(*) AS size,
      sum(coalesce(d.won_c, 0)) AS won_c, sum(coalesce(won_n, 0)) AS won_n,
      sum(coalesce(lost_n, 0)) AS lost_n, {n_if("coalesce(d.won_c, 0) = 0")} AS zero_n
      {CUSTOMER_ROWS} GROUP BY 1),
    t AS (SELECT *, {pct("won_n", "(won_n + lost_n)")} AS rate, sum(won_c) OVER () AS all_c FROM c)
    SELECT {text("mon")} AS cohort_month, {big("size")} AS cohort_size, {usd("won_c")} AS cohort_revenue,
    {avg_money("won_c", "size")} AS avg_revenue_per_customer, {big("won_n")} AS total_won_deals,
    {big("lost_n")} AS total_lost_deals, rate AS cohort_win_rate,
    {big("zero_n")} AS zero_revenue_customers, {pct("won_c", "all_c")} AS revenue_contribution_percent,
    CASE WHEN rate >= 70 THEN '{labels.COHORT_EXCELLENT}' WHEN rate >= 50 THEN '{labels.COHORT_GOOD}'
         WHEN rate >= 30 THEN '{labels.COHORT_AVERAGE}' ELSE '{labels.COHORT_POOR}' END
      AS cohort_performance FROM t"""

SQL["cohort_table"] = f"""WITH firsts AS (SELECT customer_id, deal_source FROM deal
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_on, deal_id) = 1),
    base AS (SELECT cust.*, d.first_on, coalesce(d.won_c, 0) AS w, coalesce(r.exp_c, 0) > 0 AS grew,
      firsts.deal_source {CUSTOMER_ROWS} LEFT JOIN firsts USING (customer_id)),
    long AS (
      SELECT 'Acquisition Month' AS fam, strftime(first_on, '%Y-%m') AS member, * FROM base
      UNION ALL SELECT 'Industry', industry, * FROM base
      UNION ALL SELECT 'Customer Tier', customer_tier, * FROM base
      UNION ALL SELECT 'Deal Source', deal_source, * FROM base
      UNION ALL SELECT 'Revenue Band', CASE WHEN bal_c >= 700000 THEN 'High'
        WHEN bal_c >= 300000 THEN 'Mid' ELSE 'Low' END, * FROM base
      UNION ALL SELECT 'Geography', region, * FROM base)
    SELECT fam AS cohort_type, member AS cohort_member, {n()} AS total_customers,
    {usd("sum(w)")} AS total_revenue, {avg_money("sum(w)", "count(*)")} AS avg_deal_value,
    {pct(n_if("status = 'Churned'"), "count(*)")} AS churn_rate,
    {pct(n_if("grew"), "count(*)")} AS expansion_rate FROM long GROUP BY fam, member"""

SQL["cohort_table_thirds"] = SQL["cohort_table"].replace(
    """CASE WHEN bal_c >= 700000 THEN 'High'
        WHEN bal_c >= 300000 THEN 'Mid' ELSE 'Low' END""", "['Low', 'Mid', 'High'][third]").replace(
    "base AS (SELECT cust.*,", """base AS (SELECT cust.*,
      ntile(3) OVER (ORDER BY bal_c NULLS FIRST, cust.customer_id) AS third,""")
SQL["customer_tiles"] = f"""WITH t AS (SELECT customer_id, company_name, customer_tier, status,
      coalesce(d.won_c, 0) AS w, {C_IDLE} AS idle {CUSTOMER_ROWS}),
    k AS (SELECT *, ntile(3) OVER (ORDER BY w, customer_id) AS v,
      ntile(3) OVER (ORDER BY idle DESC NULLS FIRST, customer_id) AS r FROM t)
    SELECT customer_id, company_name, customer_tier, {usd("w")} AS total_revenue,
    {big("idle")} AS days_since_activity, {big("v")} AS value_tile, {big("r")} AS recency_tile,
    CASE WHEN status = 'Churned' THEN 'Lost' WHEN w = 0 THEN 'Prospect'
         WHEN v = 3 AND r = 3 THEN 'Champion' WHEN v = 3 THEN 'Win Back' WHEN r = 3 THEN 'Developing'
         WHEN r = 1 THEN 'Dormant' ELSE 'Growth' END AS segment FROM k"""

MISSING = """pairs AS (SELECT o.customer_id, count(*) AS miss_n, sum(price_c) AS miss_c
      FROM (SELECT DISTINCT customer_id FROM owned) o CROSS JOIN prod
      WHERE on_sale AND NOT EXISTS (SELECT 1 FROM owned x
        WHERE x.customer_id = o.customer_id AND x.product_id = prod.product_id)
      GROUP BY o.customer_id)"""
SQL["upsell_opportunities"] = f"""WITH {MISSING},
    have AS (SELECT customer_id, count(*) AS own_n, sum(owned_c) AS own_c FROM owned
      JOIN prod USING (product_id) GROUP BY customer_id)
    SELECT company_name, customer_tier, industry, {big("own_n")} AS products_owned,
    {usd("own_c")} AS current_rev, {big("coalesce(miss_n, 0)")} AS missing_product_count,
    {usd("coalesce(miss_c, 0)")} AS potential_expansion_value
    FROM cust JOIN have USING (customer_id) LEFT JOIN pairs USING (customer_id)"""
SQL["join_cross"] = f"""WITH {MISSING}
    SELECT company_name, {big("coalesce(miss_n, 0)")} AS missing_product_count,
    {usd("coalesce(miss_c, 0)")} AS potential_expansion_value
    FROM cust JOIN (SELECT DISTINCT customer_id FROM owned) USING (customer_id)
    LEFT JOIN pairs USING (customer_id)"""
SQL["owned_products"] = f"""SELECT product_id, customer_id, {usd("owned_c")} AS owned_value,
    product_name, category AS product_category, {usd("price_c")} AS unit_price,
    on_sale AS is_active FROM owned JOIN prod USING (product_id)"""
SQL["agg_string_distinct"] = """SELECT customer_id,
    string_agg(DISTINCT category, ', ' ORDER BY category) AS owned_categories
    FROM owned JOIN prod USING (product_id) GROUP BY customer_id"""

# ------------------------------------------------- changes, quality, streams


def json_doc(**fields: str) -> str:
    """A JSON object as text; each field is SQL for an already encoded value or null."""
    parts = " || ',' || ".join(
        f"""'"{name}":' || coalesce({value}, 'null')""" for name, value in fields.items())
    return f"'{{' || {parts} || '}}'"


def quoted(expr: str) -> str:
    return f"""'"' || {expr} || '"'"""


def stable(*parts: str) -> str:
    """The id of a natural key whose parts hold no quotes."""
    doc = " || ',' || ".join(f"""'"k{i}":"' || {p} || '"'""" for i, p in enumerate(parts))
    return f"md5('{{' || {doc} || '}}')"


def snapshot(day: str) -> str:
    later = f"coalesce(closed_on > {day}, false)"
    doc = json_doc(
        deal_id=text("deal_id"), customer_id=text("customer_id"),
        stage_id=text(f"CASE WHEN {later} THEN 5 ELSE stage_id END"),
        deal_name=quoted("deal_name"),
        deal_value="(val_c // 100) || '.' || lpad(CAST(val_c % 100 AS VARCHAR), 2, '0')",
        expected_close_date=quoted("close_on"),
        actual_close_date=quoted(f"CASE WHEN NOT {later} THEN closed_on END"),
        created_at=quoted("strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f')"),
        deal_source=quoted("deal_source"), assigned_rep=quoted("rep"),
        days_in_stage=text("age"), is_active=text(f"(active OR {later})"))
    return f"""SELECT deal_id, {doc} AS doc FROM deal WHERE created_on <= {day}
      AND NOT coalesce(stage_id = 7 AND closed_on <= {day} - INTERVAL 5 YEAR, false)"""


SQL["audit_log_diff"] = f"""WITH o AS ({snapshot("DATE '2000-01-01'")}), w AS ({snapshot(AS_OF)}),
    x AS (SELECT {text("coalesce(o.deal_id, w.deal_id)")} AS rid, o.doc AS old_doc, w.doc AS new_doc,
      CASE WHEN o.deal_id IS NULL THEN 'INSERT' WHEN w.deal_id IS NULL THEN 'DELETE'
           ELSE 'UPDATE' END AS act_name
      FROM o FULL JOIN w ON o.deal_id = w.deal_id WHERE o.doc IS DISTINCT FROM w.doc)
    SELECT {stable("'deals'", "rid", "act_name", "'2001-06-01 00:00:00'")} AS log_id,
    'deals' AS table_name, rid AS record_id, act_name AS action, old_doc AS old_data,
    new_doc AS new_data, 'loader' AS changed_by, '2001-06-01 00:00:00' AS changed_at
    FROM x"""

SQL["detect_inactivity"] = f"""WITH t AS (SELECT deal_id, customer_id,
      coalesce({AS_OF} - last_on, 999) AS idle FROM deal LEFT JOIN by_deal_act USING (deal_id))
    SELECT {stable("'No Activity'", "deal_id", "'2001-06-01'")} AS signal_id, customer_id, deal_id,
    'No Activity' AS signal_type, CASE WHEN idle > 60 THEN 'Critical' WHEN idle > 45 THEN 'High'
      ELSE 'Medium' END AS severity, '2001-06-01 00:00:00' AS detected_at, false AS resolved
    FROM t WHERE idle > 30 AND NOT EXISTS (SELECT 1 FROM sig
      WHERE sig.deal_id = t.deal_id AND NOT resolved AND kind = 'No Activity')"""

SQL["scan_customers"] = f"""SELECT customer_id, company_name, industry, country, region,
    {usd("bal_c")} AS annual_revenue, customer_tier, status FROM cust"""


def rule_row(table: str, column: str, rule: str, source: str, bad: str) -> str:
    quoted = rule.replace("'", "''")
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{quoted}' AS rule, "
            f"{n()} AS rows_checked, {big(n_if(bad))} AS violations FROM {source}")


DOMAIN_AT = {
    ("customers", "customer_tier"): ("cust", "customer_tier"),
    ("customers", "status"): ("cust", "status"),
    ("deals", "deal_source"): ("deal", "deal_source"),
    ("products", "billing_type"): ("prod", "billing"),
    ("activities", "activity_type"): ("act", "kind"),
    ("activities", "outcome"): ("act", "outcome"),
    ("revenue_records", "revenue_type"): ("rev", "kind"),
    ("revenue_records", "billing_period"): ("rev", "period"),
    ("revenue_records", "payment_status"): ("rev", "paid"),
    ("churn_signals", "signal_type"): ("sig", "kind"),
    ("churn_signals", "severity"): ("sig", "severity"),
}


def _domain_rules() -> str:
    return " UNION ALL ".join(
        rule_row(t, c, "domain", src,
                 f"{col} NOT IN ({', '.join(repr(v) for v in DOMAINS[t, c])})")
        for (t, c), (src, col) in DOMAIN_AT.items())


SQL["dq_domain"] = _domain_rules()
SQL["dq_range"] = " UNION ALL ".join([
    rule_row("deal_stages", "probability", "probability between 0 and 100", "stage",
             "prob < 0 OR prob > 100"),
    rule_row("deals", "deal_value", "deal_value > 0", "deal", "val_c <= 0"),
    rule_row("products", "unit_price", "unit_price > 0", "prod", "price_c <= 0"),
    rule_row("deal_products", "quantity", "quantity > 0", "line", "qty <= 0"),
    rule_row("deal_products", "unit_price", "unit_price > 0", "line", "unit_c <= 0"),
    rule_row("deal_products", "discount_percent", "discount_percent between 0 and 100", "line",
             "disc < 0 OR disc > 100"),
    rule_row("revenue_records", "amount", "amount > 0", "rev", "amt_c <= 0"),
    rule_row("customers", "annual_revenue", "annual_revenue >= 0", "cust", "bal_c < 0"),
])
SQL["dq_length"] = " UNION ALL ".join(
    rule_row(t, c, f"at most {most} characters", src, f"length({col}) > {most}")
    for t, src, cols in [
        ("deal_stages", "stage", {"stage_name": ("stage_name", 100)}),
        ("customers", "cust", {"company_name": ("company_name", 150),
                               "industry": ("industry", 100), "country": ("country", 100),
                               "customer_tier": ("customer_tier", 20), "status": ("status", 20)}),
        ("deals", "deal", {"deal_name": ("deal_name", 200), "deal_source": ("deal_source", 50),
                           "assigned_rep": ("rep", 150)}),
        ("products", "prod", {"product_name": ("product_name", 150),
                              "product_category": ("category", 100),
                              "billing_type": ("billing", 20)}),
        ("activities", "act", {"activity_type": ("kind", 50), "outcome": ("outcome", 50)}),
        ("revenue_records", "rev", {"revenue_type": ("kind", 50), "billing_period": ("period", 20),
                                    "payment_status": ("paid", 20)}),
        ("forecasts", "fc", {"assigned_rep": ("rep", 150)}),
        ("churn_signals", "sig", {"signal_type": ("kind", 100), "severity": ("severity", 20)}),
    ]
    for c, (col, most) in cols.items())
SQL["dq_not_null"] = " UNION ALL ".join(
    rule_row(t, c, "not null", src, f"{col} IS NULL")
    for t, src, cols in [
        ("deal_stages", "stage", {"stage_id": "stage_id", "stage_name": "stage_name",
                                  "stage_order": "stage_id"}),
        ("customers", "cust", {"customer_id": "customer_id", "company_name": "company_name"}),
        ("deals", "deal", {"deal_id": "deal_id", "customer_id": "customer_id",
                           "stage_id": "stage_id", "deal_name": "deal_name",
                           "deal_value": "val_c", "expected_close_date": "close_on"}),
        ("products", "prod", {"product_id": "product_id", "product_name": "product_name",
                              "unit_price": "price_c"}),
        ("deal_products", "line", {"deal_product_id": "line_id", "deal_id": "deal_id",
                                   "product_id": "product_id", "quantity": "qty",
                                   "unit_price": "unit_c"}),
        ("activities", "act", {"activity_id": "activity_id", "deal_id": "deal_id",
                               "activity_date": "touched_at"}),
        ("revenue_records", "rev", {"revenue_id": "revenue_id", "deal_id": "revenue_id",
                                    "customer_id": "customer_id", "amount": "amt_c",
                                    "revenue_date": "billed_on"}),
        ("forecasts", "fc", {"forecast_month": "mon"}),
        ("churn_signals", "sig", {"signal_id": "signal_id", "customer_id": "customer_id"}),
    ]
    for c, col in cols.items())
SQL["dq_unique"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{label}' AS key_columns, {big(n_if("k > 1"))} AS repeated_values,
    {big(sum_if("k > 1", "k"))} AS repeated_rows
    FROM (SELECT count(*) AS k FROM {src} GROUP BY {cols})"""
    for t, label, src, cols in [
        ("customers", "customer_id", "cust", "customer_id"),
        ("customers", "company_name", "cust", "company_name"),
        ("deals", "deal_id", "deal", "deal_id"),
        ("deals", "customer_id, created_at", "deal", "customer_id, created_at"),
        ("deal_stages", "stage_id", "stage", "stage_id"),
        ("deal_stages", "stage_name", "stage", "stage_name"),
        ("deal_stages", "stage_order", "stage", "stage_id"),
        ("activities", "activity_id", "(SELECT line_id FROM line)", "line_id"),
        ("revenue_records", "revenue_id", "rev", "revenue_id"),
        ("forecasts", "assigned_rep, forecast_month", "fc", "rep, mon"),
        ("monthly_revenue_summary", "revenue_month", "months", "mon"),
        ("pipeline_health", "stage_name", "by_stage_active", "stage_name"),
        ("customer_segments", "customer_tier, industry, country",
         "(SELECT DISTINCT customer_tier, industry, country FROM cust)",
         "customer_tier, industry, country"),
        ("products", "product_id", "prod", "product_id"),
        ("products", "product_name", "prod", "product_name"),
        ("deal_products", "deal_product_id", "line", "line_id"),
        ("deal_products", "deal_id, product_id", "line", "deal_id, product_id"),
        ("churn_signals", "signal_id", "sig", "signal_id"),
    ])
SQL["dq_orphans"] = " UNION ALL ".join(
    f"""SELECT '{child}' AS child_table, '{col}' AS child_column, '{parent}' AS parent_table,
    {n(f"DISTINCT c.{key}")} AS orphan_keys, {n()} AS orphan_rows FROM {src} c
    WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {psrc} p WHERE p.{pkey} = c.{key})"""
    for child, col, src, key, parent, psrc, pkey in [
        ("deals", "customer_id", "deal", "customer_id", "customers", "cust", "customer_id"),
        ("deals", "stage_id", "deal", "stage_id", "deal_stages", "stage", "stage_id"),
        ("deal_products", "deal_id", "line", "deal_id", "deals", "deal", "deal_id"),
        ("deal_products", "product_id", "line", "product_id", "products", "prod", "product_id"),
        ("activities", "deal_id", "act", "deal_id", "deals", "deal", "deal_id"),
        ("revenue_records", "deal_id", "rev", "revenue_id", "deals", "deal", "deal_id"),
        ("revenue_records", "customer_id", "rev", "customer_id", "customers", "cust",
         "customer_id"),
        ("churn_signals", "customer_id", "sig", "customer_id", "customers", "cust",
         "customer_id"),
        ("churn_signals", "deal_id", "sig", "deal_id", "deals", "deal", "deal_id"),
    ])
SQL["dq_deal_customer"] = f"""WITH c AS (
      SELECT 'churn_signals' AS child_table, deal_id, customer_id FROM sig
      UNION ALL SELECT 'revenue_records', revenue_id, customer_id FROM rev)
    SELECT child_table, c.deal_id, c.customer_id, {n()} AS child_rows,
    deal.customer_id AS deal_customer_id FROM c JOIN deal USING (deal_id)
    WHERE c.customer_id IS DISTINCT FROM deal.customer_id GROUP BY ALL"""

def money(cents: str) -> str:
    """Hundredths as a decimal number, in JSON."""
    return (f"""CASE WHEN {cents} < 0 THEN '-' ELSE '' END || (abs({cents}) // 100) || '.'"""
            f""" || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')""")


def signal_doc(resolved: str) -> str:
    return json_doc(
        signal_id=text("signal_id"), customer_id=text("customer_id"), deal_id=text("deal_id"),
        signal_type=quoted("kind"), severity=quoted("severity"),
        detected_at=quoted("strftime(detected_at, '%Y-%m-%dT%H:%M:%S.%f')"),
        resolved=text(resolved))


CUSTOMER_DOC = json_doc(
    customer_id=text("customer_id"), company_name=quoted("company_name"),
    industry=quoted("industry"), country=quoted("country"), region=quoted("region"),
    annual_revenue=money("bal_c"), customer_tier=quoted("customer_tier"), status=quoted("status"))
REVENUE_DOC = json_doc(
    revenue_id=text("revenue_id"), deal_id=text("revenue_id"), customer_id=text("customer_id"),
    revenue_type=quoted("kind"), amount=money("amt_c"), revenue_date=quoted(text("billed_on")),
    billing_period=quoted("period"), payment_status=quoted("paid"),
    mrr_contribution=money("mrr_c"), arr_contribution=money("arr_c"))


def audited(source: str, at: str) -> str:
    """Audit rows from (tab, rid, act_name, old_doc, new_doc)."""
    parts = ["tab", "rid", "act_name", at + " || '.000000'"]
    doc = " || ',' || ".join(f"""'"k{i}":"' || {p} || '"'""" for i, p in enumerate(parts))
    for i, p in enumerate(["old_doc", "new_doc"], len(parts)):
        doc += f""" || ',"k{i}":' || coalesce('"' || md5({p}) || '"', 'null')"""
    return f"""SELECT md5('{{' || {doc} || '}}') AS log_id, tab AS table_name, rid AS record_id,
    act_name AS action, old_doc AS old_data, new_doc AS new_data, 'loader' AS changed_by,
    {at} AS changed_at FROM ({source})"""


def diff(table: str, before: str, after: str) -> str:
    return f"""SELECT '{table}' AS tab, CAST(coalesce(o.k, w.k) AS VARCHAR) AS rid,
      CASE WHEN o.k IS NULL THEN 'INSERT' WHEN w.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END
        AS act_name, o.doc AS old_doc, w.doc AS new_doc
      FROM ({before}) o(k, doc) FULL JOIN ({after}) w(k, doc) ON o.k = w.k
      WHERE o.doc IS DISTINCT FROM w.doc"""


SQL["stream_audit"] = audited(" UNION ALL ".join([
    diff("customers", f"SELECT customer_id, {CUSTOMER_DOC} FROM cust WHERE false",
         f"SELECT customer_id, {CUSTOMER_DOC} FROM cust"),
    diff("deals", snapshot("DATE '2000-01-01'"), snapshot(AS_OF)),
    diff("revenue_records",
         f"SELECT revenue_id, {REVENUE_DOC} FROM rev WHERE billed_on <= DATE '2000-01-01'",
         f"SELECT revenue_id, {REVENUE_DOC} FROM rev"),
    diff("churn_signals",
         f"SELECT signal_id, {signal_doc('false')} FROM sig"
         " WHERE detected_at < TIMESTAMP '2024-01-15'",
         f"SELECT signal_id, {signal_doc('resolved')} FROM sig"),
]), "'2001-06-01 00:00:00'")
SIGNAL_DOC = json_doc(
    signal_id=quoted("signal_id"), customer_id=text("customer_id"), deal_id=text("deal_id"),
    signal_type=quoted("signal_type"), severity=quoted("severity"),
    detected_at="""'"2001-06-01T00:00:00.000000"'""", resolved=text("resolved"))
SQL["inactivity_audit"] = audited(
    f"""SELECT 'churn_signals' AS tab, signal_id AS rid, 'INSERT' AS act_name,
    CAST(NULL AS VARCHAR) AS old_doc, {SIGNAL_DOC} AS new_doc FROM ({SQL["detect_inactivity"]})""",
    "'2001-06-01 00:00:00'")

MARK = "(SELECT max(on_day) - 1 FROM act)"
SQL["stream_inactivity"] = f"""WITH d AS (SELECT deal_id, on_day, count(*) AS k FROM act GROUP BY ALL),
    g AS (SELECT *, coalesce(on_day - lag(on_day) OVER (PARTITION BY deal_id ORDER BY on_day) > 30,
      true) AS starts FROM d),
    i AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY deal_id ORDER BY on_day) AS isl
      FROM g),
    s AS (SELECT deal_id, max(on_day) AS last_on, sum(k) AS k FROM i GROUP BY deal_id, isl)
    SELECT deal_id, customer_id, 'No Activity' AS signal_type, 'Medium' AS severity,
    {text("last_on")} AS last_activity_date, {text("last_on + 31")} AS detected_on,
    false AS resolved, {big("k")} AS activities FROM s JOIN deal USING (deal_id)
    WHERE s.last_on + 31 <= {MARK} AND NOT EXISTS (SELECT 1 FROM sig
      WHERE sig.deal_id = s.deal_id AND NOT resolved AND kind = 'No Activity')"""
SQL["stream_activity_daily"] = f"""SELECT {text("on_day")} AS activity_day, kind AS activity_type,
    {n()} AS activities, {big(n_if("outcome = 'Positive'"))} AS positives
    FROM act WHERE on_day + 1 <= {MARK} GROUP BY on_day, kind"""

# ---------------------------------------------------------------- primitives

SQL["load_stages"] = f"""SELECT {big("stage.stage_id")} AS stage_id, stage_name,
    {big("stage.stage_id")} AS stage_order, CAST(prob AS DOUBLE) AS probability, closed AS is_closed,
    won AS is_won, {n("deal_id")} AS deals FROM stage LEFT JOIN deal USING (stage_id)
    GROUP BY stage.stage_id, stage_name, prob, closed, won"""
SQL["resolve_keys"] = """WITH k AS (SELECT *, CASE WHEN billing = 'Annual' THEN p_name
      ELSE product_name END AS known FROM prod),
    asked AS (SELECT product_id AS row_id, CASE WHEN on_sale THEN known
      ELSE 'unlisted ' || product_name END AS name FROM k),
    hits AS (SELECT row_id, asked.name, count(k.product_id) AS c, min(k.product_id) AS pid
      FROM asked LEFT JOIN k ON k.known = asked.name GROUP BY ALL)
    SELECT name, row_id, CASE WHEN c = 1 THEN pid END AS product_id,
    CASE c WHEN 0 THEN 'unmatched' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS product_id_status
    FROM hits"""
SQL["apply_defaults"] = f"""SELECT revenue_id, {usd("amt_c")} AS amount,
    CASE WHEN amt_c > 40000000 THEN 'Paid' ELSE paid END AS payment_status, 'USD' AS currency,
    '2001-06-01 00:00:00' AS created_at FROM rev"""
SQL["line_total"] = f"""SELECT line_id AS deal_product_id, qty AS quantity, {usd("unit_c")} AS unit_price,
    CAST(disc AS DOUBLE) AS discount_percent, {usd("total_c")} AS total_value FROM line"""
SQL["filter_active"] = f"""SELECT deal_id, {usd("val_c")} AS deal_value, rep AS assigned_rep FROM deal
    WHERE active AND val_c > 10000000"""
SQL["filter_close_window"] = f"""SELECT deal_id, {text("close_on")} AS expected_close_date,
    {usd("val_c")} AS deal_value FROM deal
    WHERE active AND close_on BETWEEN {AS_OF} AND DATE '2001-09-01'"""
SQL["filter_risk_levels"] = f"""SELECT deal_id, risk_level, risk_score
    FROM ({SQL["deal_risk_scores"]}) WHERE risk_level <> 'Medium' AND risk_level <> 'Low'"""
SQL["join_inner"] = f"""SELECT deal_id, company_name, stage_name, {usd("val_c")} AS deal_value
    FROM staged JOIN cust USING (customer_id) WHERE won"""
SQL["join_left"] = """SELECT cust.customer_id, deals, sigs AS signals FROM cust
    LEFT JOIN by_cust_deal USING (customer_id) LEFT JOIN by_cust_sig USING (customer_id)"""
SQL["join_left_residual"] = f"""SELECT {big("stage_id")} AS stage_id, stage_name,
    CASE WHEN deals > 0 THEN {big("deals")} END AS active_deals, {usd("val_c")} AS active_value
    FROM by_stage_active"""
SQL["join_anti"] = f"""SELECT product_id, {usd("price_c")} AS unit_price FROM prod
    WHERE product_id NOT IN (SELECT product_id FROM owned)"""
SQL["join_semi"] = """SELECT customer_id, company_name FROM cust
    WHERE EXISTS (SELECT 1 FROM staged WHERE staged.customer_id = cust.customer_id AND won)"""
SQL["agg_basic"] = f"""SELECT deal_source, {n()} AS deals, {n("closed_on")} AS closed_deals,
    {usd("sum(val_c)")} AS total_value, {avg_money("sum(val_c)", "count(*)")} AS avg_value,
    {text("min(close_on)")} AS first_close, {text("max(close_on)")} AS last_close,
    {stamp("max(created_at)")} AS last_created_at FROM deal GROUP BY deal_source"""
SQL["agg_conditional"] = f"""SELECT kind AS revenue_type, {big(n_if("paid = 'Overdue'"))} AS overdue_records,
    {usd(sum_if("paid = 'Paid'", "amt_c"))} AS paid_amount,
    {usd(sum_if("paid = 'Failed'", "amt_c"))} AS failed_amount,
    {avg_money(sum_if("paid = 'Pending'", "amt_c"), n_if("paid = 'Pending'"))} AS avg_pending
    FROM rev GROUP BY kind"""
SQL["agg_count_distinct"] = f"""SELECT {text(month("created_on"))} AS created_month,
    {n("DISTINCT customer_id")} AS customers, {n("DISTINCT rep")} AS reps, {n()} AS deals
    FROM deal GROUP BY 1"""
SQL["agg_weighted"] = f"""SELECT deal_source, {over("sum(val_c * prob)", "10000")} AS weighted_value
    FROM staged WHERE active GROUP BY deal_source"""
SQL["agg_ratio"] = f"""SELECT customer_id, {big("won_n")} AS won, {big("closed_n")} AS closed,
    {pct("won_n", "closed_n")} AS win_rate FROM by_cust_deal"""
SQL["window_lag_global"] = f"""SELECT {text("mon")} AS revenue_month,
    {usd("(amt_c - lag(amt_c) OVER (ORDER BY mon))")} AS mom_change FROM months"""
SQL["window_lag_partition"] = f"""SELECT {text("mon")} AS revenue_month, kind AS revenue_type,
    {usd("(amt_c - lag(amt_c) OVER (PARTITION BY kind ORDER BY mon))")} AS mom_revenue_change
    FROM type_months"""
SQL["window_running_sum"] = f"""SELECT {text("mon")} AS revenue_month, {usd("mrr_c")} AS total_mrr,
    {usd("sum(mrr_c) OVER (ORDER BY mon)")} AS cumulative_mrr FROM months"""
SQL["window_share"] = f"""WITH t AS (SELECT deal_source, sum(val_c) AS v FROM deal GROUP BY 1)
    SELECT deal_source, {usd("v")} AS total_value,
    {pct("v", "(SELECT sum(v) FROM t)")} AS share_percent FROM t"""
SQL["window_rank"] = f"""WITH t AS (SELECT {month("created_on")} AS mon, count(*) AS k FROM deal GROUP BY 1)
    SELECT {text("mon")} AS created_month, {big("k")} AS deals,
    {big("rank() OVER (ORDER BY k DESC)")} AS deal_rank FROM t"""
SQL["sort_nulls"] = f"""SELECT deal_id, {text("closed_on")} AS actual_close_date,
    {usd("val_c")} AS deal_value FROM deal ORDER BY closed_on ASC NULLS LAST, val_c DESC, deal_id"""
SQL["scalar_nulls"] = f"""SELECT deal_id, {text("ifnull(closed_on, close_on)")} AS close_date,
    {big("CASE WHEN age <> 0 THEN age END")} AS days_or_null FROM deal"""
SQL["scalar_round"] = f"""SELECT deal_id, {over("val_c * 75", "100000")} AS fee,
    {over("val_c", "100", 1)} AS whole, {over("-val_c", "200", 1)} AS negative_half FROM deal"""
SQL["scalar_dates"] = f"""SELECT deal_id, {text(month("created_on"))} AS created_month,
    {big(LATE)} AS days_overdue, {text("close_on - 7")} AS week_before,
    {text("CAST(created_on + INTERVAL 1 MONTH AS DATE)")} AS month_later FROM deal"""
SQL["scalar_casts"] = f"""SELECT deal_id, {text("deal_id")} AS id_text, {text("created_on")} AS created_on,
    {big(over("val_c", "100", 1))} AS whole_value, CAST(NULL AS BIGINT) AS not_a_number FROM deal"""
SQL["scalar_strings"] = """SELECT customer_id, company_name || ' - ' || industry AS label,
    regexp_replace(company_name, '^Customer#0*', 'C') AS short_name, 'customer' AS singular FROM cust"""
SQL["scalar_json"] = """SELECT event_id, props->>'$.k' AS k_text,
    CAST(props->>'$.k' AS BIGINT) AS k_number, CAST(NULL AS VARCHAR) AS missing FROM events"""
SQL["stable_ids"] = f"""SELECT deal_id,
    {stable("deal_name", "customer_id", stamp("created_at"))} AS stable_id FROM deal"""


# ------------------------------------------------- history and refreshed results

PURGED = "stage_id = 7 AND closed_on <= {day} - INTERVAL 5 YEAR"


def deals_on(day: str) -> str:
    """The deal table as it stood at the end of a day."""
    later = f"coalesce(closed_on > {day}, false)"
    return f"""SELECT * REPLACE (CASE WHEN {later} THEN 5 ELSE stage_id END AS stage_id,
      CASE WHEN NOT {later} THEN closed_on END AS closed_on, active OR {later} AS active)
      FROM ({TABLES["deal"]}) WHERE created_on <= {day}
      AND NOT coalesce({PURGED.format(day=day)}, false)"""


def rejected(table: str, source: str, key: str, rules: list[tuple[str, str]]) -> str:
    """Rows of a table that break a rule, with the rules; a rule is a text and what breaks it."""
    domains = [(f"{c}: domain", f"{col} NOT IN ({', '.join(repr(v) for v in DOMAINS[t, c])})")
               for (t, c), (_, col) in DOMAIN_AT.items() if t == table]
    said = ", ".join(f"CASE WHEN {bad} THEN '{rule}' END" for rule, bad in [*domains, *rules])
    return f"""SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS record_id,
      list_filter([{said}], lambda x: x IS NOT NULL) AS said FROM {source}"""


JUDGED = " UNION ALL ".join([
    rejected("customers", "cust", "customer_id", [("annual_revenue: annual_revenue >= 0", "bal_c < 0")]),
    rejected("deals", "deal", "deal_id", [("deal_value: deal_value > 0", "val_c <= 0"),
                                          ("days_in_stage: days_in_stage <= 60", "age > 60")]),
    rejected("products", "prod", "product_id", [("unit_price: unit_price > 0", "price_c <= 0")]),
    rejected("revenue_records", "rev", "revenue_id", [("amount: amount > 0", "amt_c <= 0")]),
    rejected("churn_signals", "sig", "signal_id", []),
])
SQL["dq_rejects"] = f"""SELECT table_name, record_id, array_to_string(said, '; ') AS reasons
    FROM ({JUDGED}) WHERE len(said) > 0"""
SQL["dq_split"] = f"""SELECT table_name, {n()} AS rows_read, {big(n_if("len(said) = 0"))} AS good_rows,
    {big(n_if("len(said) > 0"))} AS rejected_rows FROM ({JUDGED}) GROUP BY table_name"""
SQL["stream_pending_signals"] = """SELECT signal_id, deal_id, CASE WHEN EXISTS (SELECT 1 FROM deal
      WHERE deal.deal_id = sig.deal_id) THEN 'resolved' ELSE 'orphan' END AS state FROM sig"""
SQL["stream_daily_windows"] = f"""WITH p AS (SELECT *, deal_id % 3 AS part FROM act),
    seen AS (SELECT part, max(max(on_day)) OVER (ORDER BY part
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM p GROUP BY part)
    SELECT {text("on_day")} AS activity_day, kind AS activity_type,
    {big(n_if("NOT late"))} AS on_time, {big(n_if("late"))} AS late
    FROM (SELECT *, coalesce(on_day + 1 <= newest - 1, false) AS late FROM p JOIN seen USING (part))
    GROUP BY ALL"""

REPLAY_DAY = "DATE '2000-01-01'"
SQL["audit_replay_customers"] = SQL["scan_customers"]
SQL["audit_replay_deals"] = f"""SELECT deal_id, customer_id, {big("stage_id")} AS stage_id, deal_name,
    {usd("val_c")} AS deal_value, {text("close_on")} AS expected_close_date,
    {text("closed_on")} AS actual_close_date, {stamp("created_at")} AS created_at, deal_source,
    rep AS assigned_rep, {big("age")} AS days_in_stage, active AS is_active
    FROM ({deals_on(REPLAY_DAY)})"""
SQL["audit_replay_revenue_records"] = f"""SELECT revenue_id, revenue_id AS deal_id, customer_id,
    kind AS revenue_type, {usd("amt_c")} AS amount, {text("billed_on")} AS revenue_date,
    period AS billing_period, paid AS payment_status, {usd("mrr_c")} AS mrr_contribution,
    {usd("arr_c")} AS arr_contribution FROM rev WHERE billed_on <= {REPLAY_DAY}"""
SQL["audit_replay_churn_signals"] = f"""SELECT signal_id, customer_id, deal_id, kind AS signal_type,
    severity, {stamp("detected_at")} AS detected_at,
    resolved AND detected_at + INTERVAL 30 DAY <= TIMESTAMP '2024-02-14 23:59:59' AS resolved
    FROM sig WHERE detected_at <= TIMESTAMP '2024-02-14 23:59:59'"""

STAGE_LOG = f"""SELECT deal_id, created_at AS since,
      CASE WHEN closed_on IS NOT NULL THEN 5 ELSE stage_id END AS stage_id FROM deal
    UNION ALL SELECT deal_id, closed_on, stage_id FROM deal
      WHERE closed_on IS NOT NULL AND stage_id <> 5
    UNION ALL SELECT deal_id, closed_on + INTERVAL 5 YEAR, NULL FROM deal WHERE stage_id = 7"""
SQL["deal_stage_age"] = f"""WITH log AS ({STAGE_LOG}),
    touch AS (SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber
      AS activity_id, l_orderkey AS deal_id, l_shipdate AS touched FROM lineitem)
    SELECT activity_id, touch.deal_id, {stamp("touched")} AS activity_date,
    {big("stage_id")} AS stage_id,
    CASE WHEN stage_id IS NOT NULL THEN {big("CAST(touched AS DATE) - CAST(since AS DATE)")} END
      AS days_in_stage
    FROM touch ASOF LEFT JOIN log ON touch.deal_id = log.deal_id AND touched >= since"""

SQL["stream_quarter_payers"] = f"""SELECT
    {text("CAST(date_trunc('quarter', billed_on) AS DATE)")} AS revenue_quarter,
    {n("DISTINCT customer_id")} AS paying_customers FROM rev GROUP BY ALL"""
SQL["stream_cohort_sizes"] = f"""SELECT {text("mon")} AS cohort_month, {n()} AS cohort_size
    FROM (SELECT customer_id, {month("min(created_on)")} AS mon FROM deal GROUP BY customer_id)
    GROUP BY mon"""
SQL["stored_rep_forecast"] = SQL["rep_forecast"]
SQL["stored_revenue_forecast"] = SQL["sql_revenue_forecast"] = SQL["revenue_forecast"]
SQL["stored_customer_segments"] = SQL["customer_segments"]
SQL["sql_revenue_forecast_6"] = SQL["revenue_forecast"].replace(
    "INTERVAL 3 MONTH", "INTERVAL 6 MONTH")
SQL["sql_deal_health_score"] = f"""SELECT * EXCLUDE (deal_id)
    FROM ({SQL["deal_health_score"]}) WHERE deal_id = 17"""
SQL["sql_customer_lifetime_value"] = f"""SELECT * EXCLUDE (customer_id)
    FROM ({SQL["customer_lifetime_value"]}) WHERE customer_id = 17"""
# The results that streams refresh, over the tables as they stand at the end of the feed.
AT_END = {
    "deal": deals_on(AS_OF),
    "rev": f"SELECT * FROM ({TABLES['rev']}) WHERE billed_on <= {AS_OF}",
}
REFRESHED = {
    "stream_pipeline_health": SQL["pipeline_health"],
    "stream_customer_segments": SQL["customer_segments"],
    "stream_cohort_sizes": SQL["stream_cohort_sizes"],
}


def all_sql() -> dict[str, str]:
    plain = {name: with_tables(body) for name, body in SQL.items()}
    return {**plain, **{name: with_tables(body, AT_END) for name, body in REFRESHED.items()}}
