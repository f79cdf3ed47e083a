"""Fixed values that the DuckDB SQL expects, stated apart from the engine's own, so
that a wrong value on either side shows as a difference."""

from __future__ import annotations

from types import SimpleNamespace

# The seven pipeline stages in order
# (name, order, probability, closed, won).
STAGES: list[tuple[str, int, str, bool, bool]] = [
    ("Prospecting", 1, "10.00", False, False),
    ("Qualification", 2, "20.00", False, False),
    ("Needs Analysis", 3, "35.00", False, False),
    ("Proposal", 4, "50.00", False, False),
    ("Negotiation", 5, "70.00", False, False),
    ("Closed Won", 6, "100.00", True, True),
    ("Closed Lost", 7, "0.00", True, False),
]

# Allowed values per column.
DOMAINS: dict[tuple[str, str], list[str]] = {
    ("customers", "customer_tier"): ["Enterprise", "Mid-Market", "SMB"],
    ("customers", "status"): ["Active", "Churned", "At-Risk", "Prospect"],
    ("deals", "deal_source"): ["Inbound", "Outbound", "Referral", "Partner", "Renewal"],
    ("products", "billing_type"): ["One-Time", "Monthly", "Annual"],
    ("activities", "activity_type"): [
        "Call", "Email", "Meeting", "Demo", "Follow-Up", "Proposal Sent", "Contract Sent"],
    ("activities", "outcome"): ["Positive", "Neutral", "Negative", "No Response"],
    ("revenue_records", "revenue_type"): [
        "New Business", "Renewal", "Expansion", "Contraction", "Churn"],
    ("revenue_records", "billing_period"): ["Monthly", "Quarterly", "Annual", "One-Time"],
    ("revenue_records", "payment_status"): ["Paid", "Pending", "Overdue", "Failed"],
    ("churn_signals", "signal_type"): [
        "No Activity", "Negative Sentiment", "Payment Failure", "Contract Expiring",
        "Downgrade Request", "Low Engagement", "Competitor Mention"],
    ("churn_signals", "severity"): ["Low", "Medium", "High", "Critical"],
}

# Status labels.
labels = SimpleNamespace(
    RISK_CRITICAL="🔴 Critical",
    RISK_HIGH="🟠 High",
    RISK_MEDIUM="🟡 Medium",
    RISK_LOW="🟢 Low",
    TREND_GROWING="📈 Growing",
    TREND_DECLINING="📉 Declining",
    TREND_FLAT="➡️ Flat",
    COHORT_EXCELLENT="🌟 Excellent",
    COHORT_GOOD="✅ Good",
    COHORT_AVERAGE="⚠️ Average",
    COHORT_POOR="🔴 Poor",
    CHURN_EXPANDING="🟢 Expanding",
    CHURN_HEALTHY="✅ Healthy",
    REP_TOP="🌟 Top Performer",
    REP_ON_TRACK="✅ On Track",
    REP_COACHING="⚠️ Needs Coaching",
    REP_UNDER="🔴 Underperforming",
)
