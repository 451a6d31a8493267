"""The core pipeline: scoped and quick, whole, or one after the other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.checks import Limits, assertion_summary, gate, run_assertions
from ..operators.kpi import core_kpis, metadata_row, require_columns, scope_core
from ..sources.scratch import counted, written

NEEDED = {"ticks": ["ts_us", "exch_us", "exchange_id", "symbol", "id"], "events": ["ts_us", "exchange_id", "event_type"], "cleansed": ["bucket_start_utc", "bucket_epoch_s", "exchange_id", "symbol", "price", "is_missing", "is_stale"]}


def stored(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, written; several at a time, since most are small."""
    with ThreadPoolExecutor(4) as pool:
        return dict(zip(tables, pool.map(written, tables.values()), strict=True))


class _Counting:
    """stored(), that also remembers how many rows of each table were written."""

    def __init__(self) -> None:
        self.rows: dict[str, Callable[[], int]] = {}

    def __call__(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        seen = {name: counted(df) for name, df in tables.items()}
        self.rows |= {name: n for name, (_, n) in seen.items()}
        return stored({name: df for name, (df, _) in seen.items()})

    def row_counts(self, spark: SparkSession, key: str = "kpi") -> DataFrame:
        return spark.createDataFrame([(name, n()) for name, n in sorted(self.rows.items())], f"{key} string, row_count bigint")


def run_core(ticks: DataFrame, events: DataFrame, cleansed: DataFrame, phase: str = "full", kpi_date: str | None = None, run_id: str | None = None, limits: Limits = Limits(), on_failure: str = "raise") -> dict[str, dict[str, DataFrame]]:
    """For each phase its KPI tables, with metadata, assertions, summary and (but in fast) row_counts.

    fast looks at one day and run and skips row counts; full looks at everything; both runs fast, then full. KPI tables
    are written once for each phase, and checks read them; rows are counted as tables are written. After a phase whose assertions fail with severity error, no
    other phase runs: on_failure "raise" ends the run with an error, "stop" returns what there is, that phase included.
    """
    if phase not in ("fast", "full", "both"):
        raise ValueError(f"no such phase: {phase}")
    if on_failure not in ("raise", "stop"):
        raise ValueError(f"no such way to fail: {on_failure}")
    for name, df in (("ticks", ticks), ("events", events), ("cleansed", cleansed)):
        require_columns(df, NEEDED[name], name)
    inputs = tuple(stored({"ticks": ticks, "events": events, "cleansed": cleansed}).values())
    spark, out = ticks.sparkSession, {}
    for now in ("fast", "full") if phase == "both" else (phase,):
        filters = (kpi_date, run_id) if now == "fast" else (None, None)
        scoped, counting = scope_core(*inputs, *filters), _Counting()
        # each input is counted in one of the writes that read it
        names = ("latency_samples", "connection_drops_daily", "price_deviation_aligned")
        seen = {name: counted(df) for name, df in zip(names, scoped, strict=True)}
        kpis = core_kpis(*scoped, store=counting, counted={name: df for name, (df, _) in seen.items()})
        metadata = metadata_row(spark, *[n() for _, n in seen.values()], *filters)
        results = written(run_assertions(kpis, limits))
        out[now] = kpis | {"metadata": metadata, "assertions": results, "summary": assertion_summary(results)}
        if now == "full":
            out[now]["row_counts"] = counting.row_counts(spark)
        if not gate(results):
            if on_failure == "stop":
                break
            failed = [r["assertion_name"] for r in results.where("severity = 'error' and is_failed = 1").collect()]
            raise RuntimeError(f"phase {now}: {', '.join(failed)}")
    return out
