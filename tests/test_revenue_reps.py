import datetime as dt
from decimal import Decimal as D

from dealglass.functions import labels
from dealglass.operators import reps, revenue
from fixtures import AS_OF, by

JAN, MAR = dt.date(2024, 1, 1), dt.date(2024, 3, 1)


def test_months_compare_with_the_previous_existing_month(small):
    rows = by(revenue.monthly_revenue_summary(small), "revenue_month")
    assert list(rows) == [JAN, MAR]                      # February has no revenue
    assert rows[JAN]["paying_customers"] == 1
    assert rows[JAN]["mom_change"] is None
    assert rows[MAR]["mom_change"] == D("30.00")
    assert rows[MAR]["mom_growth_percent"] == D("16.67")


def test_by_type(small):
    rows = by(revenue.revenue_by_month(small), "revenue_month", "revenue_type")
    assert rows[MAR, "New Business"]["mom_growth_percent"] == D("50.00")
    assert rows[MAR, "Churn"]["mom_revenue_change"] is None
    assert rows[JAN, "Expansion"]["overdue_revenue"] == D("60.00")
    assert rows[JAN, "Expansion"]["collected_revenue"] == 0


def test_mrr_trend(small):
    rows = by(revenue.mrr_trend(small), "revenue_month")
    assert rows[JAN]["growth_trend"] == labels.TREND_FLAT           # nothing to compare with
    assert rows[MAR]["growth_trend"] == labels.TREND_FLAT           # 15 and 15
    assert rows[MAR]["cumulative_mrr"] == D("30.00")
    assert rows[MAR]["arpu"] == D("7.50")


def test_growth_from_a_zero_month_is_null(spark, small):
    zero = small.revenue_records.withColumn(
        "amount", small.revenue_records.amount * 0)
    rows = revenue.monthly_revenue_summary(small.replace(revenue_records=zero)).collect()
    assert [r["mom_growth_percent"] for r in rows] == [None, None]


def test_forecast_window_clamps_at_month_end(small):
    # as_of is 31 March; one month later is 30 April
    assert len(revenue.revenue_forecast(small, AS_OF, 1).collect()) == 2
    rows = by(revenue.revenue_forecast(small, AS_OF, 3), "forecast_month")
    assert rows[MAR]["active_deals"] == 1                # closes on as_of itself
    april = rows[dt.date(2024, 4, 1)]
    assert april["historical_win_rate"] == D("66.67")
    assert april["best_case"] == D("72.00")
    assert april["predicted_revenue"] == D("53.34")      # 80 * 66.67 %


def test_rep_forecast(small):
    rows = by(revenue.rep_forecast(small, AS_OF), "forecast_month", "assigned_rep")
    april = dt.date(2024, 4, 1)
    assert rows[april, "ann"]["forecast_bias"] == "Conservative"
    assert rows[april, "ann"]["forecast_gap"] == D("-63.00")
    assert rows[april, None]["historical_win_rate"] is None          # a null rep never joins
    assert rows[april, None]["forecast_bias"] == "On Target"
    assert rows[MAR, "cat"]["historical_win_rate"] is None           # nothing closed yet


def test_rep_performance(small):
    rows = by(reps.rep_performance(small, AS_OF), "assigned_rep")
    wide = by(reps.rep_performance(small, AS_OF, fan_out=True), "assigned_rep")
    assert (rows["ann"]["total_deals"], wide["ann"]["total_deals"]) == (3, 6)   # two forecasts
    assert wide["ann"]["total_revenue_won"] == 2 * rows["ann"]["total_revenue_won"]
    for key in ("win_rate_percent", "avg_won_deal_value", "avg_forecast_accuracy"):
        assert rows["ann"][key] == wide["ann"][key]
    assert rows["ann"]["avg_forecast_accuracy"] == D("112.50")       # the null is left out
    assert wide["bob"] == rows["bob"]                                # no forecast row
    assert rows["cat"]["win_rate_percent"] is None
    assert rows[None]["total_deals"] == 1


def test_leaderboard_ties(small):
    rows = by(reps.rep_leaderboard(small, AS_OF), "assigned_rep")
    assert rows["ann"]["revenue_rank"] == rows["dan"]["revenue_rank"] == 1
    assert {rows[r]["revenue_rank"] for r in ("bob", "cat", None)} == {3}
    assert sum(r["revenue_share_percent"] for r in rows.values()) == 100
    assert rows["ann"]["performance_status"] == labels.REP_TOP
    assert rows["cat"]["performance_status"] == labels.REP_UNDER     # nothing decided


def test_anomalies_need_spread(spark):
    rows = [("r", "New Business", D(v), dt.date(2024, m, 1))
            for m, v in enumerate([10, 10, 10, 10, 10, 10, 10, 500], start=1)]
    records = spark.createDataFrame(
        [(f"{a}{i}", b, c, d) for i, (a, b, c, d) in enumerate(rows)],
        "revenue_id string, revenue_type string, amount decimal(15,2), revenue_date date")
    from dealglass.model import Model

    found = by(revenue.revenue_anomalies(Model(revenue_records=records)), "revenue_month")
    assert [m.month for m, r in found.items() if r["is_anomaly"]] == [8]
    flat = revenue.revenue_anomalies(Model(revenue_records=records.where("amount = 10")))
    assert {(r["z_score"], r["is_anomaly"]) for r in flat.collect()} == {(None, False)}


def test_mrr_from_billing_period(spark):
    records = spark.createDataFrame(
        [("Annual", D("100.00")), ("Quarterly", D("100.00")), ("Monthly", D("100.00")),
         ("One-Time", D("100.00"))], "billing_period string, amount decimal(15,2)")
    rows = by(revenue.derive_mrr_arr(records), "billing_period")
    assert [rows[p]["mrr_contribution"] for p in rows] == [
        D("8.33"), D("33.33"), D("100.00"), D("0.00")]
    assert [rows[p]["arr_contribution"] for p in rows] == [
        D("100.00"), D("400.00"), D("1200.00"), D("0.00")]
