"""The model stored for repeated use: facts bucketed by their join key, deals by closing month."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.model import Model
from dealglass.sources.tables import write_bucketed

# Tables and the key they are joined on most.
KEYS = {
    "customers": "customer_id",
    "deals": "customer_id",
    "revenue_records": "customer_id",
    "churn_signals": "customer_id",
    "activities": "deal_id",
}
BUCKETS = 32


def stored(m: Model, folder: str, buckets: int = BUCKETS) -> Model:
    """The same model over stored tables.

    Tables of the same key join without a shuffle.  Deals are partitioned by the month of
    ``expected_close_date`` as well, kept as column ``close_month``, by which forecasts read
    the months they need only.  Choose as many buckets as a cluster has tasks for the largest
    table.  A table is written when it is first used.
    """
    run = uuid.uuid4().hex
    given = m.tables()

    def keep(name: str) -> DataFrame:
        rows, by = given[name], None
        if name == "deals":
            rows = rows.withColumn("close_month", F.trunc("expected_close_date", "MM"))
            by = ["close_month"]
        return write_bucketed(
            rows, f"{name}_{run}", KEYS[name], buckets, f"{folder}/{name}", by)

    return m.replace(**{name: functools.partial(keep, name) for name in KEYS if name in given})
