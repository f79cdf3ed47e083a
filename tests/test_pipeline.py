from decimal import Decimal as D

from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.operators import pipeline
from fixtures import AS_OF, at, by


def test_summary_keeps_empty_stages(small):
    rows = by(pipeline.pipeline_summary(small, AS_OF), "stage_name")
    assert list(rows) == ["Open", "Empty", "Won", "Lost"]
    assert rows["Open"]["total_deals"] == 4
    assert rows["Open"]["total_pipeline_value"] == D("330.25")
    assert rows["Open"]["weighted_pipeline_value"] == D("33.03")      # 33.025 rounds up
    assert rows["Open"]["avg_deal_value"] == D("82.56")               # 82.5625
    assert rows["Open"]["stagnant_deals"] == 2                        # 46 and 31, not 30
    assert rows["Open"]["overdue_deals"] == 1                         # closing today is not late
    for stage in ("Empty", "Won", "Lost"):
        assert rows[stage]["total_deals"] == 0
        assert rows[stage]["total_pipeline_value"] is None
        assert rows[stage]["avg_days_in_stage"] is None
        assert rows[stage]["stagnant_deals"] == rows[stage]["overdue_deals"] == 0


def test_health_counts_sources(small):
    row = by(pipeline.pipeline_health(small, AS_OF), "stage_name")["Open"]
    assert (row["inbound_deals"], row["outbound_deals"], row["partner_deals"]) == (1, 2, 1)
    assert row["referral_deals"] == row["renewal_deals"] == 0


def test_risk_levels(small):
    rows = by(pipeline.deal_risk_scores(small, AS_OF), "deal_id")
    assert set(rows) == {"d2", "d4", "d6", "d7"}
    assert rows["d4"]["risk_level"] == "Critical"       # idle 46
    assert rows["d2"]["risk_level"] == "High"           # 15 days overdue, age 46, idle only 14
    assert rows["d6"]["risk_level"] == "High"           # idle exactly 31
    silent = rows["d7"]                                 # never contacted
    assert silent["days_since_last_activity"] is None
    assert silent["total_activities"] == 0
    assert silent["risk_level"] == "Low"
    assert silent["risk_score"] == D("-1.20")           # not yet due lowers the score
    assert rows["d2"]["risk_score"] == D("23.40")       # 14*.4 + 46*.3 + 15*.2 + 1
    assert rows["d2"]["last_activity_date"] == at(14)


def test_scoring(small):
    rows = by(pipeline.pipeline_scoring(small, AS_OF), "deal_name")
    assert rows["Deal d4"]["close_date_status"] == "CLOSING SOON"     # closes today
    assert rows["Deal d7"]["close_date_status"] == "CLOSING SOON"     # in six days
    assert rows["Deal d6"]["close_date_status"] == "ON TRACK"         # in seven days
    assert rows["Deal d2"]["close_date_status"] == "OVERDUE"
    d7 = rows["Deal d7"]
    assert d7["days_since_activity"] == 0               # falls back to days in stage
    assert d7["last_activity_date"] == at(20).date()    # falls back to creation
    assert rows["Deal d2"]["risk_level"] == labels.RISK_HIGH
    assert rows["Deal d2"]["churn_signals"] == 1        # the resolved one does not count
    assert rows["Deal d6"]["critical_signals"] == 0     # resolved
    assert rows["Deal d4"]["risk_level"] == labels.RISK_CRITICAL


def test_deal_health_of_one_deal(small):
    every = by(pipeline.deal_health_score(small, AS_OF), "deal_id")
    assert len(every) == 7
    one = by(pipeline.deal_health_score(small, AS_OF, "d1"), "deal_id")
    assert one == {"d1": every["d1"]}
    assert one["d1"]["health_score"] == D("66.00")      # 100 - 26 - 3 - 5
    assert one["d1"]["health_status"] == "Healthy"      # the band ignores the negative outcome


def test_funnel(small):
    rows = by(pipeline.funnel_velocity(small, AS_OF), "stage_name")
    assert rows["Open"]["stage_to_stage_conversion"] is None
    assert rows["Empty"]["stage_to_stage_conversion"] == D("0.00")
    assert rows["Won"]["stage_to_stage_conversion"] is None           # previous stage has none
    assert rows["Won"]["conversion_rate_percent"] == D("100.00")
    assert rows["Lost"]["revenue_leak_percent"] == D("100.00")
    assert rows["Empty"]["velocity_status"] == "Fast"                 # no average known


def test_funnel_without_won_deals(spark, small):
    open_only = small.replace(deals=small.deals.where("stage_id = 's1'"))
    won = by(pipeline.funnel_velocity(open_only, AS_OF), "stage_name")["Won"]
    assert (won["total_deals"], won["won_deals"]) == (0, 1)           # the outer-join row
    assert won["conversion_rate_percent"] is None


def test_win_loss(small):
    rows = by(pipeline.win_loss(small), "outcome", "customer_tier", "deal_source")
    won = rows["Won", "Enterprise", "Inbound"]
    assert (won["total_deals"], won["avg_activities"], won["avg_demos"]) == (1, 2, 1)
    assert won["avg_days_to_close"] == 50
    assert rows["Won", "SMB", "Referral"]["avg_activities"] == 0
    assert rows["Lost", "SMB", "Renewal"]["win_rate_percent"] == 0
    assert rows["Lost", "SMB", "Renewal"]["segment_win_rate_percent"] == 0
    both = small.replace(deals=small.deals.withColumn("deal_source", F.lit("Inbound")).withColumn(
        "customer_id", F.lit("c1")))
    mixed = by(pipeline.win_loss(both), "outcome")
    assert mixed["Won"]["win_rate_percent"] == 100
    assert {r["segment_win_rate_percent"] for r in mixed.values()} == {D("66.67")}
