"""Constraints as bulk checks: domains, ranges, not-null, uniqueness, references.

Row rules of a table are counted together in one scan.  Key rules combine
map-side per key before any shuffle or join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import count_where, zero
from dealglass.model import (
    DOMAINS, FOREIGN_KEYS, LENGTHS, RANGES, UNIQUE_KEYS, Model, required_columns)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _count_rules(df: DataFrame, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per rule: rows checked and rows violating, from a single aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[count_where(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)],
    )
    entries = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(text).alias("rule"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, (column, text, _) in enumerate(rules)
    ]
    return counts.select(
        F.lit(table).alias("table_name"), "rows_checked", F.explode(F.array(*entries)).alias("r")
    ).select("table_name", "r.column_name", "r.rule", "rows_checked", "r.violations")


def _present(m: Model, rules) -> dict[str, list]:
    """Rules grouped by table, kept where the model has the table and column."""
    tables = m.tables()
    grouped: dict[str, list] = {}
    for table, column, text, bad in rules:
        if table in tables and column in tables[table].columns:
            grouped.setdefault(table, []).append((column, text, bad))
    return grouped


def _run(m: Model, rules) -> DataFrame:
    tables = m.tables()
    return _union([_count_rules(tables[t], t, r) for t, r in _present(m, rules).items()])


def check_domains(m: Model) -> DataFrame:
    """Values outside a column's allowed list; a null passes."""
    return _run(m, [
        (table, column, "domain", ~F.col(column).isin(allowed))
        for (table, column), allowed in DOMAINS.items()
    ])


def check_ranges(m: Model, extra: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """Values breaking a range predicate; a null passes."""
    return _run(m, [
        (table, column, predicate, ~F.expr(predicate))
        for (table, column), predicate in {**RANGES, **(extra or {})}.items()
    ])


def check_lengths(m: Model) -> DataFrame:
    """Texts longer than their column allows; a null passes."""
    return _run(m, [
        (table, column, f"at most {most} characters", F.char_length(column) > most)
        for table, columns in LENGTHS.items() for column, most in columns.items()
    ])


def check_not_null(m: Model) -> DataFrame:
    """Nulls in required columns."""
    return _run(m, [
        (table, column, "not null", F.col(column).isNull())
        for table in m.tables()
        for column in required_columns(table)
    ])


def check_unique(
    m: Model,
    more: dict[str, list[list[str]]] | None = None,
    results: dict[str, tuple[DataFrame, list[str]]] | None = None,
) -> DataFrame:
    """Per key: values that occur more than once, and the rows they hold.

    Checked are the keys of the domain tables, ``more`` keys of them, and one key
    of each of the ``results``.
    """
    tables = m.tables()
    keys = {t: [*groups, *(more or {}).get(t, [])] for t, groups in UNIQUE_KEYS.items()}
    for name, (result, columns) in (results or {}).items():
        tables = {**tables, name: result}
        keys[name] = [columns]
    parts = []
    for table, groups in keys.items():
        for columns in groups:
            if table in tables and set(columns) <= set(tables[table].columns):
                counts = tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
                repeated = F.col("n") > 1
                parts.append(counts.agg(
                    F.lit(table).alias("table_name"),
                    F.lit(", ".join(columns)).alias("key_columns"),
                    count_where(repeated).alias("repeated_values"),
                    F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias(
                        "repeated_rows"),
                ))
    return _union(parts)


def check_orphans(m: Model) -> DataFrame:
    """Per reference: child rows whose non-null key has no parent row.

    Each table is read once: a child counts the values of all its keys in one
    grouping, and one join brings all of them to the keys of all parents.
    """
    tables = m.tables()
    references: dict[str, list[tuple[str, str, str]]] = {}
    for child, column, parent, parent_key in FOREIGN_KEYS:
        if child in tables and parent in tables and column in tables[child].columns:
            references.setdefault(child, []).append((column, parent, parent_key))
    parents = sorted({(p, k) for found in references.values() for _, p, k in found})
    known = _union([
        tables[parent].select(
            F.lit(parent).alias("parent_table"), F.col(key).cast("string").alias("key"),
            F.lit(True).alias("known"))
        for parent, key in parents])
    keys = _union([_key_counts(tables[child], child, found) for child, found in references.items()])
    orphan = F.col("known").isNull() & F.col("key").isNotNull()
    return (
        keys.join(known, ["parent_table", "key"], "left")
        .groupBy("child_table", "child_column", "parent_table")
        .agg(
            count_where(orphan).alias("orphan_keys"),
            zero(F.sum(F.when(orphan, F.col("n")))).alias("orphan_rows"),
        )
    )


def _key_counts(child: DataFrame, table: str, references: list[tuple[str, str, str]]) -> DataFrame:
    """Distinct values of a child's keys with their row counts, null included."""
    each = F.array(*[
        F.struct(F.lit(column).alias("child_column"), F.lit(parent).alias("parent_table"),
                 F.col(column).cast("string").alias("key"))
        for column, parent, _ in references])
    return (
        child.select(F.inline(each))
        .groupBy("child_column", "parent_table", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("child_table"), "*")
    )


def check_deal_customer(m: Model) -> DataFrame:
    """Child rows whose customer differs from the customer of their deal, per deal pair.

    All child tables that name both meet the deals in one join.
    """
    children = [
        (name, table) for name, table in m.tables().items()
        if name != "deals" and {"deal_id", "customer_id"} <= set(table.columns)]
    rows = _union([
        table.where(F.col("deal_id").isNotNull())
        .groupBy("deal_id", "customer_id")
        .agg(F.lit(name).alias("child_table"), F.count(F.lit(1)).alias("child_rows"))
        for name, table in children
    ])
    owners = m.deals.select("deal_id", F.col("customer_id").alias("deal_customer_id"))
    return rows.join(owners, "deal_id").where(
        ~F.col("customer_id").eqNullSafe(F.col("deal_customer_id")))
