"""Assertions over the KPI tables, their summary and the gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    max_latency_ms: float = 600_000.0
    max_update_frequency_hz: float = 100.0
    max_price_diff_pct: float = 200.0


def _rules(limits: Limits) -> list[tuple[str, str, str, str]]:
    """(KPI table without its grain, assertion, condition that fails a row, details)."""
    return [
        ("latency", "latency_non_negative", "min_latency_ms < 0", "min_latency_ms must be >= 0"),
        ("latency", "latency_upper_bound", f"max_latency_ms > {limits.max_latency_ms!r}", f"max_latency_ms must be <= {limits.max_latency_ms:g}"),
        ("update_frequency", "update_interval_positive", "min_update_interval_s <= 0", "min_update_interval_s must be > 0"),
        ("update_frequency", "update_frequency_bounds", f"update_frequency_hz < 0 or update_frequency_hz > {limits.max_update_frequency_hz!r}", f"update_frequency_hz must be in 0..{limits.max_update_frequency_hz:g}"),
        ("connection_drops", "disconnect_count_non_negative", "disconnect_count < 0", "disconnect_count must be >= 0"),
        ("price_deviation", "price_diff_abs_non_negative", "max_price_diff_abs < 0", "max_price_diff_abs must be >= 0"),
        ("price_deviation", "price_diff_pct_bounds", f"max_price_diff_pct < 0 or max_price_diff_pct > {limits.max_price_diff_pct!r}", f"max_price_diff_pct must be in 0..{limits.max_price_diff_pct:g}"),
    ]


def run_assertions(kpis: dict[str, DataFrame], limits: Limits = Limits()) -> DataFrame:
    """(assertion_name, severity, is_failed, failed_rows, details): 14 errors, then 6 warnings for tables without rows.

    Each KPI table is aggregated once, whatever the number of rules over it.
    """
    out: DataFrame | None = None
    for grain, suffix in (("daily", ""), ("hourly", "_hourly")):
        for kind in ("latency", "update_frequency", "connection_drops", "price_deviation"):
            rules = [r for r in _rules(limits) if r[0] == kind]
            one = kpis[f"{kind}_{grain}"].agg(F.count("*").alias("rows"), *[F.count_if(F.expr(r[2])).alias(r[1]) for r in rules])
            checks = [F.struct(F.lit(r[1] + suffix).alias("assertion_name"), F.lit("error").alias("severity"), F.col(r[1]).alias("failed_rows"), F.lit(r[3] + suffix.replace("_", " of ")).alias("details")) for r in rules]
            if kind != "connection_drops":
                checks.append(F.struct(F.lit(f"coverage_{kind}_{grain}").alias("assertion_name"), F.lit("warn").alias("severity"), (F.col("rows") == 0).cast("long").alias("failed_rows"), F.lit(f"no rows in {kind}_{grain}").alias("details")))
            rows = one.select(F.explode(F.array(*checks)).alias("c")).select("c.assertion_name", "c.severity", (F.col("c.failed_rows") > 0).cast("int").alias("is_failed"), "c.failed_rows", "c.details")
            out = rows if out is None else out.unionByName(rows)
    return out.orderBy(F.when(F.col("severity") == "error", 0).otherwise(1), "assertion_name")


def assertion_summary(results: DataFrame) -> DataFrame:
    """(severity, total, failed)."""
    return results.groupBy("severity").agg(F.count("*").alias("total"), F.sum("is_failed").cast("long").alias("failed"))


def gate(results: DataFrame) -> bool:
    """Whether no error has failed."""
    return results.where("severity = 'error' and is_failed = 1").limit(1).count() == 0


def kpi_row_counts(kpis: dict[str, DataFrame]) -> DataFrame:
    """(kpi, row_count) of every table."""
    out: DataFrame | None = None
    for name, df in sorted(kpis.items()):
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("kpi"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
