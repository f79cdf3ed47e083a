"""Rows split into good ones and rejected ones with their reasons, in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealglass.functions.columns import count_where
from dealglass.model import DOMAINS, LENGTHS, RANGES, required_columns

Rule = tuple[str, str, Column]  # column, rule, what breaks it


@dataclass
class Split:
    """Rows that keep all rules, rows that do not with ``reasons``, and counts."""

    good: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int
    violations: dict[tuple[str, str], int]  # by column and rule, as the counting checks


def rules_of(
    table: str, columns: list[str], extra: dict[tuple[str, str], str] | None = None
) -> list[Rule]:
    """The row rules of a table for the columns that are there; a null breaks "not null" only."""
    allowed = [(c, "domain", ~F.col(c).isin(v)) for (t, c), v in DOMAINS.items() if t == table]
    ranges = [(c, p, ~F.expr(p)) for (t, c), p in {**RANGES, **(extra or {})}.items() if t == table]
    lengths = [(c, f"at most {most} characters", F.char_length(c) > most)
               for c, most in LENGTHS.get(table, {}).items()]
    required = [(c, "not null", F.col(c).isNull()) for c in required_columns(table)]
    return [rule for rule in [*allowed, *ranges, *lengths, *required] if rule[0] in columns]


def split(
    rows: DataFrame, table: str, path: str, extra: dict[tuple[str, str], str] | None = None
) -> Split:
    """Writes the rows to ``path``, good and rejected apart, in one scan of the input.

    The counts are observed while the rows are written.  ``reasons`` names each broken rule
    once, as "column: rule", in the order of the rules; it replaces a column of that name.
    """
    rules = rules_of(table, rows.columns, extra)
    said = [F.when(bad, F.lit(f"{column}: {rule}")) for column, rule, bad in rules]
    reasons = F.array_compact(F.array(*said)) if said else F.array().cast("array<string>")
    judged = rows.withColumn("reasons", reasons)
    counts = Observation()
    observed = judged.observe(
        counts, F.count(F.lit(1)).alias("rows"), count_where(F.size("reasons") > 0).alias("rejected"),
        *[count_where(bad).alias(f"v{k}") for k, (_, _, bad) in enumerate(rules)])
    marked = observed.withColumn("_rejected", F.size("reasons") > 0)
    marked.write.mode("overwrite").partitionBy("_rejected").parquet(path)
    found = counts.get
    schema = StructType([*judged.schema.fields, marked.schema["_rejected"]])
    held = rows.sparkSession.read.schema(schema).parquet(path)
    return Split(
        good=held.where(~F.col("_rejected")).drop("_rejected", "reasons"),
        rejected=held.where("_rejected").drop("_rejected"),
        rows=found["rows"], rejected_rows=found["rejected"],
        violations={(c, r): found[f"v{k}"] for k, (c, r, _) in enumerate(rules)})
