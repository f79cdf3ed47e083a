"""A small self-made model with one row (or more) per edge case."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from dealglass.model import Model

AS_OF = dt.date(2024, 3, 31)


def ago(days: int) -> dt.date:
    return AS_OF - dt.timedelta(days=days)


def at(days: int, hour: int = 9) -> dt.datetime:
    d = ago(days)
    return dt.datetime(d.year, d.month, d.day, hour)


def D(x) -> Decimal:
    return Decimal(str(x))


STAGES = [
    ("s1", "Open", 1, D("10.00"), False, False),
    ("s2", "Empty", 2, D("50.00"), False, False),
    ("s3", "Won", 3, D("100.00"), True, True),
    ("s4", "Lost", 4, D("0.00"), True, False),
]
STAGE_TYPE = ("stage_id string, stage_name string, stage_order int, probability decimal(5,2), "
              "is_closed boolean, is_won boolean")

# id, name, industry, country, annual revenue, tier, status
CUSTOMERS = [
    ("c1", "Acme", "Tech", "US", D(9000), "Enterprise", "Active"),
    ("c2", "Bolt", "Tech", "US", D(4000), "SMB", "Churned"),
    ("c3", "Core", "Food", "UK", D(100), "SMB", "Active"),       # no deals at all
    ("c4", "Dune", "Food", "UK", D(5000), "SMB", "At-Risk"),     # first deal 29 days old
]
CUSTOMER_TYPE = ("customer_id string, company_name string, industry string, country string, "
                 "annual_revenue decimal(15,2), customer_tier string, status string")

# id, customer, stage, value, expected close, actual close, created, source, rep, age, active
DEALS = [
    ("d1", "c1", "s3", D("100.10"), ago(40), ago(50), at(100), "Inbound", "ann", 10, False),
    ("d2", "c1", "s1", D("200.20"), ago(15), None, at(90), "Partner", "ann", 46, True),
    ("d3", "c2", "s4", D("300.00"), ago(60), ago(61), at(120), "Renewal", "bob", 5, False),
    ("d4", "c2", "s1", D("50.05"), AS_OF, None, at(60), "Inbound", "cat", 30, True),
    ("d5", "c4", "s3", D("100.10"), ago(1), ago(9), at(29), "Referral", "dan", 3, False),
    ("d6", "c4", "s1", D("10.00"), ago(-7), None, at(20), "Outbound", None, 31, True),
    ("d7", "c1", "s1", D("70.00"), ago(-6), None, at(20), "Outbound", "ann", 0, True),
]
DEAL_TYPE = ("deal_id string, customer_id string, stage_id string, deal_value decimal(15,2), "
             "expected_close_date date, actual_close_date date, created_at timestamp_ntz, "
             "deal_source string, assigned_rep string, days_in_stage int, is_active boolean, "
             "deal_name string")

# id, deal, customer, type, when, outcome
ACTIVITIES = [
    ("a1", "d1", "c1", "Demo", at(55), "Positive"),
    ("a2", "d1", "c1", "Call", at(52), "Negative"),
    ("a3", "d2", "c1", "Call", at(14), "Negative"),
    ("a4", "d2", "c1", "Meeting", at(70), "No Response"),
    ("a5", "d4", "c2", "Call", at(46), "Neutral"),
    ("a6", "d6", "c4", "Email", at(31), "Negative"),
    ("a7", "d6", "c4", "Email", at(33), "Negative"),
]
ACTIVITY_TYPE = ("activity_id string, deal_id string, customer_id string, activity_type string, "
                 "activity_date timestamp_ntz, outcome string")

# id, deal, customer, type, amount, date, period, status, mrr, arr
REVENUE = [
    ("r1", "d1", "c1", "New Business", D("120.00"), dt.date(2024, 1, 5), "Annual", "Paid", D(10), D(120)),
    ("r2", "d1", "c1", "Expansion", D("60.00"), dt.date(2024, 1, 20), "Annual", "Overdue", D(5), D(60)),
    ("r3", "d5", "c4", "New Business", D("180.00"), dt.date(2024, 3, 2), "Annual", "Pending", D(15), D(180)),
    ("r4", "d1", "c1", "Churn", D("30.00"), dt.date(2024, 3, 9), "Annual", "Failed", D("0.00"), D(30)),
]
REVENUE_TYPE = ("revenue_id string, deal_id string, customer_id string, revenue_type string, "
                "amount decimal(15,2), revenue_date date, billing_period string, "
                "payment_status string, mrr_contribution decimal(15,2), "
                "arr_contribution decimal(15,2)")

# id, customer, deal, type, severity, when, resolved
SIGNALS = [
    ("g1", "c1", "d2", "No Activity", "High", at(5), False),
    ("g2", "c1", "d2", "Competitor Mention", "High", at(6), True),
    ("g3", "c2", None, "Contract Expiring", "Low", at(7), False),
    ("g4", "c4", "d6", "No Activity", "Critical", at(8), True),
]
SIGNAL_TYPE = ("signal_id string, customer_id string, deal_id string, signal_type string, "
               "severity string, detected_at timestamp_ntz, resolved boolean")

FORECASTS = [
    ("ann", dt.date(2024, 1, 1), D(100), D(80), D(90), D("112.50")),
    ("ann", dt.date(2024, 2, 1), D(100), D(80), None, None),
]
FORECAST_TYPE = ("assigned_rep string, forecast_month date, pipeline_value decimal(15,2), "
                 "committed_value decimal(15,2), actual_revenue decimal(15,2), "
                 "forecast_accuracy decimal(5,2)")

PRODUCTS = [
    ("p1", "Base", "Core", D("10.00"), True),
    ("p2", "Plus", "Core", D("25.50"), True),
    ("p3", "Old", "Legacy", D("99.00"), False),
]
PRODUCT_TYPE = ("product_id string, product_name string, product_category string, "
                "unit_price decimal(15,2), is_active boolean")

LINES = [
    ("l1", "d1", "p1", D("10.00")),
    ("l2", "d1", "p3", D("90.00")),
    ("l3", "d5", "p1", D("10.00")),
    ("l4", "d5", "p2", D("20.00")),
    ("l5", "d5", "p2", D("5.00")),
    ("l6", "d4", "p2", D("25.00")),   # open deal: not owned
]
LINE_TYPE = "deal_product_id string, deal_id string, product_id string, total_value decimal(15,2)"


def small_model(spark) -> Model:
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return Model(
        deal_stages=frame(STAGES, STAGE_TYPE),
        customers=frame(CUSTOMERS, CUSTOMER_TYPE),
        deals=frame([(*d, f"Deal {d[0]}") for d in DEALS], DEAL_TYPE),
        activities=frame(ACTIVITIES, ACTIVITY_TYPE),
        revenue_records=frame(REVENUE, REVENUE_TYPE),
        churn_signals=frame(SIGNALS, SIGNAL_TYPE),
        forecasts=frame(FORECASTS, FORECAST_TYPE),
        products=frame(PRODUCTS, PRODUCT_TYPE),
        deal_products=frame(LINES, LINE_TYPE),
    )


def by(df, *keys):
    """Rows of a result by key, as dictionaries."""
    out = {}
    for row in df.collect():
        k = tuple(row[x] for x in keys)
        out[k[0] if len(k) == 1 else k] = row.asDict()
    return out
