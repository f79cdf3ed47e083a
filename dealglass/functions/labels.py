"""Status labels emitted by the analytic queries."""

RISK_CRITICAL = "🔴 Critical"
RISK_HIGH = "🟠 High"
RISK_MEDIUM = "🟡 Medium"
RISK_LOW = "🟢 Low"

TREND_GROWING = "📈 Growing"
TREND_DECLINING = "📉 Declining"
TREND_FLAT = "➡️ Flat"

COHORT_EXCELLENT = "🌟 Excellent"
COHORT_GOOD = "✅ Good"
COHORT_AVERAGE = "⚠️ Average"
COHORT_POOR = "🔴 Poor"

CHURN_EXPANDING = "🟢 Expanding"
CHURN_HEALTHY = "✅ Healthy"

REP_TOP = "🌟 Top Performer"
REP_ON_TRACK = "✅ On Track"
REP_COACHING = "⚠️ Needs Coaching"
REP_UNDER = "🔴 Underperforming"
