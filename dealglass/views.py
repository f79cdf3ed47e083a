"""The analytics under SQL names: temporary views and table functions of a session."""

from __future__ import annotations

import datetime as dt

from dealglass.model import Model
from dealglass.operators import cohorts, customers, pipeline, reps, revenue, upsell

# Parameterised results.  Each filters or sums a view registered below; Spark pushes
# the argument down to the scans of the tables that have the key as a column, and
# activities that do not are met by the few deals of the key before they are grouped.
FUNCTIONS = {
    "get_deal_health_score": """(p_deal_id {deal_id}) RETURNS TABLE RETURN
        SELECT deal_name, company_name, deal_value, stage_name, days_in_stage,
               days_since_activity, activity_count, negative_signals, health_score, health_status
        FROM deal_health_scores WHERE deal_id = p_deal_id""",
    "get_customer_lifetime_value": """(p_customer_id {customer_id}) RETURNS TABLE RETURN
        SELECT * EXCEPT (customer_id) FROM customer_lifetime_values
        WHERE customer_id = p_customer_id""",
    "get_revenue_forecast": """(p_months INT DEFAULT 3) RETURNS TABLE RETURN
        SELECT {forecast} FROM (
          SELECT trunc(expected_close_date, 'MM') AS forecast_month,
                 sum(active_deals) AS active_deals, sum(total_pipeline) AS total_pipeline,
                 sum(weighted) AS weighted, max(win_rate) AS historical_win_rate
          FROM open_pipeline_by_day
          WHERE expected_close_date BETWEEN DATE'{as_of}'
            AND add_months(DATE'{as_of}', p_months)
          GROUP BY trunc(expected_close_date, 'MM'))""",
}


def register(m: Model, as_of: dt.date) -> None:
    """Creates the tables, views and table functions in the session of the model.

    Views are evaluated when queried; use ``materialize`` to store one.
    """
    for name, table in m.tables().items():
        table.createOrReplaceTempView(name)
    by_day = revenue.open_pipeline_by_day(m).withColumn(
        "win_rate", revenue.overall_win_rate(m).scalar())
    by_customer = m
    if "customer_id" not in m.activities.columns:
        owners = m.deals.select("deal_id", "customer_id")
        by_customer = m.replace(activities=m.activities.join(owners, "deal_id"))
    results = {
        "pipeline_summary": pipeline.pipeline_summary(m, as_of),
        "deal_risk_scores": pipeline.deal_risk_scores(m, as_of),
        "revenue_by_month": revenue.revenue_by_month(m),
        "rep_performance": reps.rep_performance(m, as_of),
        "customer_health": customers.customer_health(m, as_of),
        "mv_monthly_revenue_summary": revenue.monthly_revenue_summary(m),
        "mv_pipeline_health": pipeline.pipeline_health(m, as_of),
        "mv_customer_segments": customers.customer_segments(m),
        "deal_health_scores": pipeline.deal_health_score(m, as_of),
        "customer_lifetime_values": customers.customer_lifetime_value(by_customer, as_of),
        "open_pipeline_by_day": by_day,
        "pipeline_scoring": pipeline.pipeline_scoring(m, as_of),
        "funnel_velocity": pipeline.funnel_velocity(m, as_of),
        "rep_forecast": revenue.rep_forecast(m, as_of),
        "mrr_trend": revenue.mrr_trend(m),
        "cohort_analysis": cohorts.cohort_analysis(m),
        "churn_risk_ranking": customers.churn_risk_ranking(m, as_of),
        "win_loss": pipeline.win_loss(m),
        "rep_leaderboard": reps.rep_leaderboard(m, as_of),
        "upsell_opportunities": upsell.upsell_opportunities(m),
        "owned_products": upsell.owned_products(m),
    }
    for name, result in results.items():
        result.createOrReplaceTempView(name)
    types = {
        "deal_id": dict(m.deals.dtypes)["deal_id"],
        "customer_id": dict(m.customers.dtypes)["customer_id"],
        "as_of": as_of.isoformat(),
        "forecast": ", ".join(f"{e} AS {name}" for name, e in revenue.FORECAST.items()),
    }
    for name, body in FUNCTIONS.items():
        m.deals.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body.format(**types)}")
