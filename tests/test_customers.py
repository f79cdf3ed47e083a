"""Customer operators against hand values and a row-by-row recomputation."""

import datetime as dt
import itertools
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.operators import cohorts, customers, upsell
from fixtures import (
    ACTIVITIES, AS_OF, CUSTOMERS, DEALS, REVENUE, SIGNALS, STAGES, by)

WON = {s[0] for s in STAGES if s[5]}


def rounded(x):
    return x.quantize(D("0.01"), ROUND_HALF_UP)


def children(rows, position, customer):
    """Child rows of a customer, or one None as an outer join gives."""
    return [r for r in rows if r[position] == customer] or [None]


def test_health(small):
    rows = by(customers.customer_health(small, AS_OF), "customer_id")
    assert rows["c1"]["health_status"] == "At Risk"            # one open High, one resolved
    assert rows["c1"]["health_score"] == 45
    assert rows["c1"]["high_signals"] == 2
    assert rows["c2"]["health_score"] == 70                    # idle 46 beats the open Low
    assert rows["c3"]["health_score"] == 95                    # nothing known
    assert rows["c3"]["total_revenue"] == 0 and rows["c3"]["avg_deal_value"] is None
    assert rows["c4"]["health_score"] == 70                    # the Critical one is resolved


def test_health_fan_out_equals_the_joined_rows(small):
    got = by(customers.customer_health(small, AS_OF, fan_out=True), "customer_id")
    for customer in (c[0] for c in CUSTOMERS):
        combos = list(itertools.product(
            children(DEALS, 1, customer), children(ACTIVITIES, 2, customer),
            children(SIGNALS, 1, customer)))
        assert got[customer]["total_revenue"] == sum(
            (d[3] for d, _, _ in combos if d and d[2] in WON), D(0))
        assert got[customer]["high_signals"] == sum(
            1 for _, _, s in combos if s and s[4] == "High")
        assert got[customer]["unresolved_signals"] == sum(
            1 for _, _, s in combos if s and not s[6])


def test_lifetime_value_fan_out_equals_the_joined_rows(small):
    got = by(customers.customer_lifetime_value(small, AS_OF, fan_out=True), "customer_id")
    for customer in (c[0] for c in CUSTOMERS):
        still_open = [s for s in SIGNALS if not s[6]]
        combos = list(itertools.product(
            children(DEALS, 1, customer), children(ACTIVITIES, 2, customer),
            children(REVENUE, 2, customer), children(still_open, 1, customer)))
        won = sum((c[0][3] for c in combos if c[0] and c[0][2] in WON), D(0))
        assert got[customer]["total_revenue"] == won
        assert got[customer]["expansion_revenue"] == sum(
            (c[2][4] for c in combos if c[2] and c[2][3] == "Expansion"), D(0))


def test_segments_fan_out_equals_the_joined_rows(small):
    got = by(customers.customer_segments(small, fan_out=True),
             "customer_tier", "industry", "country")
    for key, members in itertools.groupby(
            sorted(CUSTOMERS, key=lambda c: (c[5], c[2], c[3])), key=lambda c: (c[5], c[2], c[3])):
        members = list(members)
        combos = [(c, d, r) for c in members for d, r in itertools.product(
            children(DEALS, 1, c[0]), children(REVENUE, 2, c[0]))]
        assert got[key]["total_customers"] == len(members)
        assert got[key]["churned_customers"] == sum(1 for c, _, _ in combos if c[6] == "Churned")
        assert got[key]["total_revenue"] == sum(
            (d[3] for _, d, _ in combos if d and d[2] in WON), D(0))
        mrr = [r[8] for _, _, r in combos if r]
        assert got[key]["total_mrr"] == (sum(mrr) if mrr else None)


def test_lifetime_value(small):
    rows = by(customers.customer_lifetime_value(small, AS_OF), "customer_id")
    assert rows["c4"]["customer_age_days"] == 29
    assert rows["c4"]["clv_estimate"] is None                   # no whole month yet
    c1 = rows["c1"]                                             # 100 days: three months
    assert c1["avg_monthly_revenue"] == rounded(D("100.10") / 3)
    assert c1["clv_estimate"] == D("800.80")
    assert c1["churn_risk_score"] == D("17.0")                  # one open signal, idle 14
    assert rows["c3"]["first_deal_date"] is None
    only = by(customers.customer_lifetime_value(small, AS_OF, "c1"), "customer_id")
    assert only == {"c1": c1}


def test_activities_without_customer(small):
    bare = small.replace(activities=small.activities.drop("customer_id"))
    for operator in (customers.customer_health, customers.customer_lifetime_value,
                     customers.churn_risk_ranking, customers.customer_segmentation):
        assert sorted(operator(bare, AS_OF).collect(), key=str) == sorted(
            operator(small, AS_OF).collect(), key=str)
    one = customers.customer_lifetime_value(bare, AS_OF, "c1").collect()
    assert [r["total_activities"] for r in one] == [4]


def test_churn_ranking(small):
    rows = by(customers.churn_risk_ranking(small, AS_OF), "company_name")
    assert rows["Core"]["days_inactive"] == 999
    assert rows["Core"]["churn_risk_score"] == 0
    assert rows["Core"]["churn_risk_level"] == labels.CHURN_HEALTHY
    assert rows["Bolt"]["churn_risk_level"] == labels.RISK_CRITICAL   # churned status
    # idle 14, one open High, two negatives, one overdue bill, one competitor mention
    assert rows["Acme"]["churn_risk_score"] == D("62.50")
    assert rows["Acme"]["churn_risk_level"] == labels.RISK_HIGH
    assert rows["Dune"]["churn_risk_level"] == labels.RISK_MEDIUM     # idle 31


def test_segmentation(small):
    rows = by(customers.customer_segmentation(small, AS_OF, 100, 50, 30), "customer_id")
    assert {k: r["segment"] for k, r in rows.items()} == {
        "c1": "Champion", "c2": "Lost", "c3": "Prospect", "c4": "Win Back"}


def test_cohorts_keep_customers_without_deals(small):
    rows = by(cohorts.cohort_analysis(small), "cohort_month")
    assert rows[None]["cohort_size"] == 1
    assert rows[None]["cohort_performance"] == labels.COHORT_POOR
    assert rows[dt.date(2024, 3, 1)]["cohort_win_rate"] == D("100.00")
    assert sum(r["revenue_contribution_percent"] for r in rows.values()) == 100


def test_cohort_families_each_cover_all_customers(small):
    rows = cohorts.cohort_table(small, (3000, 7000)).collect()
    totals = {}
    for r in rows:
        totals[r["cohort_type"]] = totals.get(r["cohort_type"], 0) + r["total_customers"]
    assert totals == dict.fromkeys(
        ["Acquisition Month", "Industry", "Customer Tier", "Deal Source", "Revenue Band",
         "Geography"], 4)
    bands = {r["cohort_member"]: r for r in rows if r["cohort_type"] == "Revenue Band"}
    assert bands["High"]["expansion_rate"] == 100
    assert bands["Mid"]["churn_rate"] == 50


def test_upsell(small):
    rows = by(upsell.upsell_opportunities(small), "company_name")
    assert set(rows) == {"Acme", "Dune"}                       # only won deals count
    assert rows["Acme"]["products_owned"] == 2                 # one of them retired
    assert rows["Acme"]["missing_product_count"] == 1
    assert rows["Acme"]["potential_expansion_value"] == D("25.50")
    assert rows["Dune"]["current_rev"] == D("35.00")
    assert rows["Dune"]["missing_product_count"] == 0          # owns everything, stays
    assert rows["Dune"]["potential_expansion_value"] == 0
    lists = by(upsell.owned_categories(small), "customer_id")
    assert lists["c1"]["owned_categories"] == "Core, Legacy"


def test_deals_of_an_unknown_stage_count(small):
    lost = small.replace(deals=small.deals.withColumn("stage_id", F.lit("s9")))
    for fan_out in (False, True):
        health = by(customers.customer_health(lost, AS_OF, fan_out), "customer_id")
        assert {k: r["total_deals"] for k, r in health.items()} == {
            "c1": 3, "c2": 2, "c3": 0, "c4": 2}
        assert {r["total_revenue"] for r in health.values()} == {D(0)}
        value = by(customers.customer_lifetime_value(lost, AS_OF, fan_out=fan_out), "customer_id")
        assert {k: r["total_deals"] for k, r in value.items()} == {
            "c1": 3, "c2": 2, "c3": 0, "c4": 2}
        assert value["c1"]["first_deal_date"] is not None
        segments = customers.customer_segments(lost, fan_out).collect()
        assert sum(r["total_deals"] for r in segments) == 7
    grown = cohorts.cohort_analysis(lost).collect()
    whole = cohorts.cohort_analysis(small).collect()
    size = {r["cohort_month"]: r["cohort_size"] for r in whole}
    assert {r["cohort_month"]: r["cohort_size"] for r in grown} == size


def test_names_of_owned_products(small):
    owned = upsell.owned_products(small).collect()
    for customer in ("c1", "c4", "c3"):
        names = sorted({r["product_name"] for r in owned if r["customer_id"] == customer})
        got = upsell.owned_product_names(small, customer).collect()
        assert [r["products_owned"] for r in got] == [", ".join(names)]
