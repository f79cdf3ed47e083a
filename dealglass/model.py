"""The domain model: table schemas, value domains, keys, and the Model bundle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

# Column types of the domain tables.  "!" marks NOT NULL.
SCHEMAS: dict[str, str] = {
    "deal_stages": """stage_id string!, stage_name string!, stage_order int!,
        probability decimal(5,2), is_closed boolean, is_won boolean, created_at timestamp_ntz""",
    "customers": """customer_id string!, company_name string!, industry string, country string,
        city string, annual_revenue decimal(15,2), employee_count int, customer_tier string,
        status string, created_at timestamp_ntz, updated_at timestamp_ntz""",
    "contacts": """contact_id string!, customer_id string!, first_name string!, last_name string!,
        email string!, phone string, job_title string, decision_maker boolean,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "deals": """deal_id string!, customer_id string!, contact_id string, stage_id string!,
        deal_name string!, deal_value decimal(15,2)!, currency string, expected_close_date date!,
        actual_close_date date, created_at timestamp_ntz, updated_at timestamp_ntz,
        deal_source string, assigned_rep string, days_in_stage int, is_active boolean""",
    "products": """product_id string!, product_name string!, product_category string,
        unit_price decimal(15,2)!, billing_type string, is_active boolean,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "deal_products": """deal_product_id string!, deal_id string!, product_id string!, quantity int!,
        unit_price decimal(15,2)!, discount_percent decimal(5,2), total_value decimal(15,2),
        created_at timestamp_ntz""",
    "activities": """activity_id string!, deal_id string!, contact_id string, customer_id string!,
        activity_type string, activity_date timestamp_ntz!, outcome string, notes string,
        created_at timestamp_ntz""",
    "revenue_records": """revenue_id string!, deal_id string!, customer_id string!,
        revenue_type string, amount decimal(15,2)!, currency string, revenue_date date!,
        billing_period string, payment_status string, mrr_contribution decimal(15,2),
        arr_contribution decimal(15,2), created_at timestamp_ntz""",
    "forecasts": """forecast_id string!, forecast_period string!, forecast_month date!,
        assigned_rep string, pipeline_value decimal(15,2), weighted_pipeline decimal(15,2),
        best_case decimal(15,2), worst_case decimal(15,2), committed_value decimal(15,2),
        actual_revenue decimal(15,2), forecast_accuracy decimal(5,2),
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "churn_signals": """signal_id string!, customer_id string!, deal_id string, signal_type string,
        severity string, detected_at timestamp_ntz, resolved boolean, resolved_at timestamp_ntz,
        resolution_notes string, created_at timestamp_ntz""",
    "cohorts": """cohort_id string!, cohort_name string!, cohort_type string, cohort_period date,
        total_customers int, total_revenue decimal(15,2), avg_deal_value decimal(15,2),
        churn_rate decimal(5,2), expansion_rate decimal(5,2),
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "audit_logs": """log_id string!, table_name string!, record_id string, action string,
        old_data string, new_data string, changed_by string, changed_at timestamp_ntz,
        ip_address string, session_id string""",
}

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
    ("cohorts", "cohort_type"): [
        "Acquisition Month", "Industry", "Customer Tier", "Deal Source", "Revenue Band",
        "Geography"],
    ("audit_logs", "action"): ["INSERT", "UPDATE", "DELETE"],
}

# Numeric range rules, as SQL predicates a valid value satisfies.
RANGES: dict[tuple[str, str], str] = {
    ("deal_stages", "probability"): "probability between 0 and 100",
    ("deals", "deal_value"): "deal_value > 0",
    ("products", "unit_price"): "unit_price > 0",
    ("deal_products", "quantity"): "quantity > 0",
    ("deal_products", "unit_price"): "unit_price > 0",
    ("deal_products", "discount_percent"): "discount_percent between 0 and 100",
    ("revenue_records", "amount"): "amount > 0",
}

# Columns (or column groups) that must be unique.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "deal_stages": [["stage_id"], ["stage_name"], ["stage_order"]],
    "customers": [["customer_id"]],
    "contacts": [["contact_id"], ["email"]],
    "deals": [["deal_id"]],
    "products": [["product_id"], ["product_name"]],
    "deal_products": [["deal_product_id"]],
    "activities": [["activity_id"]],
    "revenue_records": [["revenue_id"]],
    "forecasts": [["forecast_id"]],
    "churn_signals": [["signal_id"]],
    "cohorts": [["cohort_id"], ["cohort_name"]],
}

# Most characters of a text column.
LENGTHS: dict[str, dict[str, int]] = {
    "deal_stages": {"stage_name": 100},
    "customers": {"company_name": 150, "industry": 100, "country": 100, "city": 100,
                  "customer_tier": 20, "status": 20},
    "contacts": {"first_name": 100, "last_name": 100, "email": 150, "phone": 20,
                 "job_title": 100},
    "deals": {"deal_name": 200, "currency": 10, "deal_source": 50, "assigned_rep": 150},
    "products": {"product_name": 150, "product_category": 100, "billing_type": 20},
    "activities": {"activity_type": 50, "outcome": 50},
    "revenue_records": {"revenue_type": 50, "currency": 10, "billing_period": 20,
                        "payment_status": 20},
    "forecasts": {"forecast_period": 20, "assigned_rep": 150},
    "churn_signals": {"signal_type": 100, "severity": 20},
    "cohorts": {"cohort_name": 150, "cohort_type": 50},
    "audit_logs": {"table_name": 100, "action": 20, "changed_by": 150, "ip_address": 50,
                   "session_id": 150},
}

# Child table, child column, parent table, parent column.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("contacts", "customer_id", "customers", "customer_id"),
    ("deals", "customer_id", "customers", "customer_id"),
    ("deals", "contact_id", "contacts", "contact_id"),
    ("deals", "stage_id", "deal_stages", "stage_id"),
    ("deal_products", "deal_id", "deals", "deal_id"),
    ("deal_products", "product_id", "products", "product_id"),
    ("activities", "deal_id", "deals", "deal_id"),
    ("activities", "contact_id", "contacts", "contact_id"),
    ("activities", "customer_id", "customers", "customer_id"),
    ("revenue_records", "deal_id", "deals", "deal_id"),
    ("revenue_records", "customer_id", "customers", "customer_id"),
    ("churn_signals", "customer_id", "customers", "customer_id"),
    ("churn_signals", "deal_id", "deals", "deal_id"),
]

# Primary key of each audited table.
RECORD_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "deals": "deal_id",
    "revenue_records": "revenue_id",
    "churn_signals": "signal_id",
}

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


def ddl(table: str) -> str:
    """Spark DDL schema string of a domain table."""
    return SCHEMAS[table].replace("!", " NOT NULL")


def required_columns(table: str) -> list[str]:
    """NOT NULL columns of a domain table."""
    flat = " ".join(SCHEMAS[table].split())
    return [part.split()[0] for part in flat.split(", ") if part.endswith("!")]


def column_type(table: str, column: str) -> str:
    """Declared type of a column of a domain table."""
    flat = " ".join(SCHEMAS[table].split()).replace("!", "")
    return dict(part.split(" ", 1) for part in flat.split(", "))[column]


class Model:
    """The domain tables by name, as attributes.

    A table is given as a DataFrame or as a function that builds it; a function
    runs when the table is first used, so a query plans only what it reads.
    ``activities`` may come without ``customer_id``; customer-level activity is
    then looked up through the deal.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]) -> None:
        unknown = set(tables) - set(SCHEMAS)
        if unknown:
            raise ValueError(f"not domain tables: {sorted(unknown)}")
        self._given = tables
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._given:
            raise AttributeError(f"the model has no table {name!r}")
        if name not in self._built:
            given = self._given[name]
            self._built[name] = given() if callable(given) else given
        return self._built[name]

    def tables(self) -> dict[str, DataFrame]:
        """The tables that are present, by name."""
        return {name: getattr(self, name) for name in SCHEMAS if name in self._given}

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> Model:
        """The same model with some tables exchanged."""
        return Model(**{**self._given, **self._built, **tables})
