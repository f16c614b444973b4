"""Data-quality rules, rule reports, quarantine and null profiles.

Each report is one aggregate over its table (one scan, partial aggregation
before the single-row merge), turned into rows afterwards, instead of one
job per rule or per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import as_money, percentage
from shoplens.schemas import QUALITY_RULES


def _passes(predicate: str) -> F.Column:
    """True only where the predicate is true; a null input fails the rule."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def rule_report(df: DataFrame, table: str, rules=None) -> DataFrame:
    """One row per rule: table_name, rule_id, rule_expr, message, total_rows,
    failures, status ('PASSED' when no row fails, else 'FAILED')."""
    rules = QUALITY_RULES[table] if rules is None else rules
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~_passes(p)).alias(f"_f{i}") for i, (p, _) in enumerate(rules)],
    )
    per_rule = F.array(*[
        F.struct(F.lit(i + 1).alias("rule_id"), F.lit(p).alias("rule_expr"),
                 F.lit(m).alias("message"), F.col(f"_f{i}").alias("failures"))
        for i, (p, m) in enumerate(rules)
    ])
    out = counts.select(F.lit(table).alias("table_name"), "total_rows",
                        F.inline(per_rule))
    return out.select(
        "table_name", "rule_id", "rule_expr", "message", "total_rows", "failures",
        F.when(F.col("failures") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
    )


def failed_rules(rules) -> F.Column:
    """Messages of the rules a row breaks, in rule order (empty if none)."""
    msgs = F.array(*[F.when(~_passes(p), F.lit(m)) for p, m in rules])
    return F.filter(msgs, lambda m: m.isNotNull())


def quarantine(df: DataFrame, table: str, rules=None) -> DataFrame:
    """Rows that break at least one rule, with ``failed_rules`` (array of messages)."""
    rules = QUALITY_RULES[table] if rules is None else rules
    return (df.withColumn("failed_rules", failed_rules(rules))
              .where(F.size("failed_rules") > 0))


def passing(df: DataFrame, table: str, rules=None) -> DataFrame:
    """Rows that keep every rule (the complement of ``quarantine``)."""
    rules = QUALITY_RULES[table] if rules is None else rules
    ok = F.lit(True)
    for p, _ in rules:
        ok = ok & _passes(p)
    return df.where(ok)


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column: total_rows, null_count and null_pct (0 for an empty table).

    Columns: table_name, column_position (1-based), column_name, total_rows,
    null_count, null_pct. All columns are counted in one pass.
    """
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    per_col = F.array(*[
        F.struct(F.lit(i + 1).alias("column_position"), F.lit(c).alias("column_name"),
                 F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ])
    out = counts.select(F.lit(table).alias("table_name"), "total_rows", F.inline(per_col))
    return out.select(
        "table_name", "column_position", "column_name", "total_rows", "null_count",
        percentage(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
    )


def unusable_amounts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Rows per money column whose value is not null but no amount (NaN, infinite, too large)."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & as_money(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "unusable").select(F.lit(table).alias("table_name"), "column_name", "unusable")
