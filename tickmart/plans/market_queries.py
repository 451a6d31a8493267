"""Registered queries over ticks, cleansed prices, KPIs, marts and serving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import filters
from ..operators import checks, cleansing, dq, kpi, marts, serving
from ..sources import adapters as src
from . import twins
from .registry import query

#: Hourly bins for the tables at hand.
HOURLY = cleansing.Config(bin_seconds=3600, max_forward_fill_s=10800, stale_after_s=5400)
LINES = cleansing.Config(bin_seconds=3600, max_forward_fill_s=10800, stale_after_s=5400, fill_method="interpolation")
RUN = "run1"


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return src.market_ticks(spark, sf)


def conn(spark: SparkSession, sf: str) -> DataFrame:
    return src.connection_events(spark, sf)


def cleansed(spark: SparkSession, sf: str) -> DataFrame:
    return cleansing.cleanse(ticks(spark, sf), HOURLY, RUN)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return src.lineitem_cleansed(spark, sf)


def _digits(c: str) -> F.Column:
    n = 1e5 if "pct" in c else 1e8
    return (F.floor(F.col(c) * n + 0.5) / n).alias(c)


def tidy(df: DataFrame) -> DataFrame:
    """Averages of prices depend on the order of adding in their last digits: keep those before."""
    return df.select(*[_digits(c) if c.startswith("avg_price") else F.col(c) for c in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """Prices to 8 and percentages to 5 digits, as the twins' tidy()."""
    return df.select(*[_digits(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


_ALIGNED = "max_price min_price price_diff_abs price_diff_pct"
_BUCKET = "max_price_close min_price_close price_diff_abs price_diff_pct"


def _kpis(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return kpi.core_kpis(ticks(spark, sf), conn(spark, sf), cleansed(spark, sf))


def _quality(spark: SparkSession, sf: str, grain: str) -> DataFrame:
    k, name = _kpis(spark, sf), {"day": "daily", "hour": "hourly"}[grain]
    return marts.platform_quality(k[f"{name}_exchange"], k[f"{name}_exchange_symbol"], grain)


# cleansing

query("c01_pair_profiles", "select * from profiles")(lambda s, d: cleansing.pair_profiles(ticks(s, d)))
query("c02_effective_price", "select id, coalesce(price, last) as effective_price from ticks")(lambda s, d: ticks(s, d).select("id", cleansing.effective_price().alias("effective_price")))
query("c03_scope", "select id, exchange_id, symbol from ticks where exchange_id in ('binance', 'okx') and (symbol = 'BTC/USDT' or symbol like 'S%')")(
    lambda s, d: cleansing.scope(ticks(s, d), include="Binance,okx", symbols="btc/usdt, s%").select("id", "exchange_id", "symbol"))
query("c04_bin_floor", "select id, epoch_s // 3600 * 3600 as bucket_epoch_s from ticks")(lambda s, d: ticks(s, d).select("id", cleansing.bin_epoch(F.col("epoch_s"), 3600).alias("bucket_epoch_s")))
query(
    "c05_observed_bins",
    """select exchange_id, symbol, epoch_s // 3600 * 3600 as bucket_epoch_s, count(*) as tick_count_in_bin, arg_min(coalesce(price, last), (ts_us, id)) as first_price, arg_max(coalesce(price, last), (ts_us, id)) as last_price,
  min(epoch_s) as first_epoch_s, max(epoch_s) as last_epoch_s from ticks where coalesce(price, last) is not null group by all""",
)(lambda s, d: cleansing.observed_bins(ticks(s, d), 3600).select("exchange_id", "symbol", "bucket_epoch_s", "tick_count_in_bin", F.col("first.price").alias("first_price"), F.col("last.price").alias("last_price"), F.col("first.epoch_s").alias("first_epoch_s"), F.col("last.epoch_s").alias("last_epoch_s")))
query("c06_bin_grid", "select exchange_id, symbol, unnest(range(min_epoch_s // 3600 * 3600, max_epoch_s // 3600 * 3600 + 1, 3600)) as bucket_epoch_s from profiles")(lambda s, d: cleansing.bin_grid(cleansing.pair_profiles(ticks(s, d)), 3600))
query("c07_forward_fill", "select exchange_id, symbol, bucket_epoch_s, price, age_seconds from cleansed where fill_method = 'forward_fill'")(
    lambda s, d: cleansed(s, d).where("fill_method = 'forward_fill'").select("exchange_id", "symbol", "bucket_epoch_s", "price", "age_seconds"))
query("c08_interpolation", f"select exchange_id, symbol, bucket_epoch_s, round(price, 6) as price, age_seconds, source_ingestion_epoch_s from ({twins.cleansed_sql('interpolation', 'run2')}) where fill_method = 'interpolation'")(
    lambda s, d: cleansing.cleanse(ticks(s, d), LINES, "run2").where("fill_method = 'interpolation'").select("exchange_id", "symbol", "bucket_epoch_s", F.round("price", 6).alias("price"), "age_seconds", "source_ingestion_epoch_s"))
query("c09_quality_flags", "select exchange_id, symbol, bucket_epoch_s, fill_method, age_seconds, is_stale, is_missing from cleansed")(
    lambda s, d: cleansed(s, d).select("exchange_id", "symbol", "bucket_epoch_s", "fill_method", "age_seconds", "is_stale", "is_missing"))
query("c10_cleansed_market", "select * from cleansed")(cleansed)
query(
    "c11_pair_summary",
    """select run_id, p.*, count(*) as bins_total, count(*) filter (where fill_method = 'observed') as bins_observed, count(*) filter (where fill_method = 'forward_fill') as bins_forward_fill,
  count(*) filter (where fill_method = 'interpolation') as bins_interpolation, count(*) filter (where fill_method = 'missing') as bins_missing from cleansed join profiles p using (exchange_id, symbol) group by all""",
)(lambda s, d: cleansing.pair_summary(cleansed(s, d), cleansing.pair_profiles(ticks(s, d))))
query(
    "c12_run_metadata",
    """select run_id, count(distinct (exchange_id, symbol)) as pair_count, count(*) as bins_total, count(*) filter (where fill_method = 'observed') as bins_observed, count(*) filter (where fill_method = 'forward_fill') as bins_forward_fill, count(*) filter (where fill_method = 'interpolation') as bins_interpolation,
  count(*) filter (where fill_method = 'missing') as bins_missing, (select cast(sum(source_tick_count) as bigint) from profiles) as source_tick_count, 3600 as bin_seconds, 10800 as max_forward_fill_s, 5400 as stale_after_s, 'forward_fill' as fill_method_mode from cleansed group by run_id""",
)(lambda s, d: cleansing.cleansing_run_metadata(cleansed(s, d), cleansing.pair_profiles(ticks(s, d)), HOURLY))

_SOURCE = """select exchange_id, symbol, count(*) as source_row_count, count(*) filter (where ts_us is null) as null_ingestion_ts_count, cast(0 as bigint) as invalid_ingestion_ts_count, count(*) filter (where coalesce(price, last) is null) as null_effective_price_count,
  count(*) filter (where coalesce(price, last) <= 0) as non_positive_effective_price_count, count(*) filter (where price < 0 or bid < 0 or ask < 0 or last < 0 or base_volume < 0 or quote_volume < 0) as rows_with_negative_values_count, count(*) filter (where bid > ask) as bid_gt_ask_count from ticks group by all"""
_DUPLICATES = "select exchange_id, symbol, cast(sum(n - 1) as bigint) as duplicate_tick_count from (select exchange_id, symbol, ts_us, coalesce(price, last) as p, count(*) as n from {0} group by all having count(*) > 1) group by all"
_OUTLIERS = "select run_id, exchange_id, symbol, count(*) filter (where abs((price - before) / before) > 0.2) as outlier_return_count from (select *, lag(price) over (partition by exchange_id, symbol order by bucket_epoch_s) as before from cleansed where fill_method = 'observed') where before <> 0 group by all"
_ALL = " + ".join(dq.ISSUES)
_SUMMARY = f"select *, {_ALL} as total_issue_count from (select s.*, coalesce(duplicate_tick_count, 0) as duplicate_tick_count, coalesce(outlier_return_count, 0) as outlier_return_count from ({_SOURCE}) s left join ({_DUPLICATES.format('ticks')}) using (exchange_id, symbol) left join (select * exclude (run_id) from ({_OUTLIERS})) using (exchange_id, symbol))"


def _dq(s: SparkSession, d: str) -> DataFrame:
    return dq.dq_summary(dq.dq_source(ticks(s, d)), dq.dq_duplicates(ticks(s, d)), dq.dq_outliers(cleansed(s, d)))


def _doubled(s: SparkSession, d: str) -> DataFrame:
    """Ticks, those with an id divisible by 7 twice."""
    return ticks(s, d).unionByName(ticks(s, d).where("id % 7 = 0"))


query("c13_dq_source", _SOURCE)(lambda s, d: dq.dq_source(ticks(s, d)))
query("c14_dq_duplicates", _DUPLICATES.format("(select * from ticks union all select * from ticks where id % 7 = 0)"))(lambda s, d: dq.dq_duplicates(_doubled(s, d)))
query("c15_dq_outliers", _OUTLIERS)(lambda s, d: dq.dq_outliers(cleansed(s, d)))
query("c16_dq_summary", _SUMMARY)(_dq)
query("c17_dq_run_summary", "select count(*) as pair_count, count(*) filter (where total_issue_count > 0) as pairs_with_issues, " + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ("source_row_count", *dq.ISSUES, "total_issue_count")) + f" from ({_SUMMARY})")(lambda s, d: dq.dq_run_summary(_dq(s, d)))


@query("c18_export_run", "select run_id, exchange_id, symbol, bucket_epoch_s, fill_method from cleansed")
def c18_export_run(s: SparkSession, d: str) -> DataFrame:
    from ..sources.scratch import scratch_path

    path = scratch_path(s)
    cleansing.export_run({"cleansed_market": cleansed(s, d)}, RUN, path)
    return s.read.schema("run_id string, exchange_id string, symbol string, bucket_epoch_s long, fill_method string").json(f"{path}/cleansed_market")


# core KPIs

query("d01_latency_samples", "select * from samples")(lambda s, d: kpi.latency_samples(ticks(s, d)))
query("d02_latency_daily", "select * from latency_daily")(lambda s, d: kpi.latency_kpi(kpi.latency_samples(ticks(s, d)), "day"))
query("d03_latency_hourly", "select * from latency_hourly")(lambda s, d: kpi.latency_kpi(kpi.latency_samples(ticks(s, d)), "hour"))
query("d04_update_intervals", "select * from intervals")(lambda s, d: kpi.update_intervals(ticks(s, d)))
query("d04b_update_intervals_by_day", "select * from intervals")(lambda s, d: kpi.update_intervals(ticks(s, d)))
query("d05_update_frequency_daily", "select * from frequency_daily")(lambda s, d: kpi.update_frequency_kpi(kpi.update_intervals(ticks(s, d)), "day"))
query("d06_update_frequency_hourly", "select * from frequency_hourly")(lambda s, d: kpi.update_frequency_kpi(kpi.update_intervals(ticks(s, d)), "hour"))
query("d07_connection_drops_daily", "select * from drops_daily")(lambda s, d: kpi.connection_drops(conn(s, d), "day"))
query("d08_connection_drops_hourly", "select * from drops_hourly")(lambda s, d: kpi.connection_drops(conn(s, d), "hour"))
query("d09_price_deviation_aligned", "select * from aligned")(lambda s, d: kpi.price_deviation_aligned(cleansed(s, d)))
query("d09b_price_deviation_aligned_lines", twins.tidy("select * from aligned_lines", _ALIGNED))(lambda s, d: plain(kpi.price_deviation_aligned(lines(s, d))))
query("d10_price_deviation_daily", "select * from deviation_daily")(lambda s, d: tidy(kpi.price_deviation_kpi(kpi.price_deviation_aligned(cleansed(s, d)), "day")))
query("d10b_price_deviation_daily_lines", twins.tidy("select * from deviation_lines_daily", "max_price_diff_abs max_price_diff_pct avg_price_diff_abs avg_price_diff_pct"))(lambda s, d: plain(kpi.price_deviation_kpi(kpi.price_deviation_aligned(lines(s, d)), "day")))
query("d11_price_deviation_hourly", "select * from deviation_hourly")(lambda s, d: tidy(kpi.price_deviation_kpi(kpi.price_deviation_aligned(cleansed(s, d)), "hour")))
query("d12_daily_exchange_symbol", "select * from daily_exchange_symbol")(lambda s, d: _kpis(s, d)["daily_exchange_symbol"])
query("d13_hourly_exchange_symbol", "select * from hourly_exchange_symbol")(lambda s, d: _kpis(s, d)["hourly_exchange_symbol"])
query("d14_daily_exchange", "select * from daily_exchange")(lambda s, d: _kpis(s, d)["daily_exchange"])
query("d15_hourly_exchange", "select * from hourly_exchange")(lambda s, d: _kpis(s, d)["hourly_exchange"])

_DATE = "2024-01-05"
query("d16_scope_core", f"select (select count(*) from ticks where {twins.day('ts_us')} = '{_DATE}') as ticks, (select count(*) from conn where {twins.day('ts_us')} = '{_DATE}') as events, (select count(*) from cleansed where run_id = 'run1' and bucket_start_utc[:10] = '{_DATE}') as cleansed")(
    lambda s, d: (lambda three: three[0].agg(F.count("*").alias("ticks")).crossJoin(three[1].agg(F.count("*").alias("events"))).crossJoin(three[2].agg(F.count("*").alias("cleansed"))))(kpi.scope_core(ticks(s, d), conn(s, d), cleansed(s, d), _DATE, RUN)))


@query("d17_require_columns", "select id, ts_us, 'ticks lacks the columns exch_ms, venue' as refused from ticks")
def d17_require_columns(s: SparkSession, d: str) -> DataFrame:
    """Ticks that have the columns needed, with the words by which others are refused."""
    found = kpi.require_columns(ticks(s, d), ["id", "ts_us", "exch_us"]).select("id", "ts_us")
    try:
        kpi.require_columns(ticks(s, d), ["id", "exch_ms", "venue"], "ticks")
        refused = None
    except ValueError as e:
        refused = str(e)
    return found.withColumn("refused", F.lit(refused))


query("d18_build_metadata", "select cast(null as varchar) as kpi_date, 'run1' as run_id, (select count(*) from ticks) as market_tick_rows, (select count(*) from conn) as connection_event_rows, (select count(*) from cleansed) as cleansed_rows, 15 as view_count")(
    lambda s, d: kpi.core_build_metadata(ticks(s, d), conn(s, d), cleansed(s, d), run_id=RUN))


query("d19_assertions", twins.assertions())(lambda s, d: checks.run_assertions(_kpis(s, d)))
query("d20_assertion_summary", f"select severity, count(*) as total, cast(sum(is_failed) as bigint) as failed from ({twins.assertions()}) group by severity")(lambda s, d: checks.assertion_summary(checks.run_assertions(_kpis(s, d))))
_COUNTED = {
    "latency_samples": "samples", "update_intervals": "intervals", "price_deviation_aligned": "aligned",
    **{f"{k}_{g}": f"{t}_{g}" for g in ("daily", "hourly") for k, t in (("latency", "latency"), ("update_frequency", "frequency"), ("connection_drops", "drops"), ("price_deviation", "deviation"))},
    **{f"{g}_{k}": f"{g}_{k}" for g in ("daily", "hourly") for k in ("exchange", "exchange_symbol")},
}
query("d21_kpi_row_counts", " union all ".join(f"select '{k}' as kpi, count(*) as row_count from {t}" for k, t in _COUNTED.items()))(lambda s, d: checks.kpi_row_counts(_kpis(s, d)))


def _phase_sql(phase: str) -> str:
    tail = "_fast" if phase == "fast" else ""
    counts = {"market_tick_rows": f"ticks{tail}", "connection_event_rows": f"conn{tail}", "cleansed_rows": f"cleansed{tail}"}
    parts = [f"select '{phase}' as phase, 'assertion' as kind, assertion_name as name, failed_rows as value from a_{phase}", f"select '{phase}', 'failed ' || severity, 'assertions', sum(is_failed) from a_{phase} group by severity"]
    parts += [f"select '{phase}', 'metadata', '{k}', count(*) from {t}" for k, t in counts.items()]
    if phase == "full":
        parts += [f"select 'full', 'rows', '{k}', count(*) from {t}" for k, t in _COUNTED.items()]
    return " union all ".join(parts)


def _phases_sql(full_if: str, **limits: str) -> str:
    both = f"with a_fast as ({twins.assertions('_fast', **limits)}), a_full as ({twins.assertions('', **limits)})"
    return f"{both} select phase, kind, name, cast(value as bigint) as value from ({_phase_sql('fast')} union all select * from ({_phase_sql('full')}) where {full_if})"


def _phases(s: SparkSession, d: str, limits: checks.Limits) -> DataFrame:
    """(phase, kind, name, value): assertions, their summary, input rows and KPI rows of each phase that ran."""
    from .core import run_core

    out: DataFrame | None = None
    for phase, got in run_core(ticks(s, d), conn(s, d), cleansed(s, d), "both", _DATE, RUN, limits, "stop").items():
        parts = [got["assertions"].select(F.lit("assertion").alias("kind"), F.col("assertion_name").alias("name"), F.col("failed_rows").alias("value")), got["summary"].select(F.concat(F.lit("failed "), "severity").alias("kind"), F.lit("assertions").alias("name"), F.col("failed").alias("value"))]
        parts.append(got["metadata"].unpivot([], ["market_tick_rows", "connection_event_rows", "cleansed_rows"], "name", "value").select(F.lit("metadata").alias("kind"), "name", "value"))
        if "row_counts" in got:
            parts.append(got["row_counts"].select(F.lit("rows").alias("kind"), F.col("kpi").alias("name"), F.col("row_count").alias("value")))
        for part in parts:
            own = part.select(F.lit(phase).alias("phase"), "*")
            out = own if out is None else out.unionByName(own)
    return out


# with the limits as they are, a fast phase that fails ends the run; without the two limits that these tables break, both run
query("d22_core_pipeline", _phases_sql("(select count(*) from a_fast where severity = 'error' and is_failed = 1) = 0"))(lambda s, d: _phases(s, d, checks.Limits()))
query("d22b_core_pipeline_both_phases", _phases_sql("true", most_hz="1e9", most_pct="1e9"))(lambda s, d: _phases(s, d, checks.Limits(max_price_diff_pct=1e9, max_update_frequency_hz=1e9)))


query("d23_disconnects_by_exchange", "select exchange_id, count(*) as disconnect_count from conn where event_type = 'disconnect' group by exchange_id")(lambda s, d: kpi.disconnects_by_exchange(conn(s, d)))
query(
    "d24_update_interval_stats",
    """select exchange_id, symbol, count(*) as interval_count, round(min(us) / 1000000.0, 3) as min_interval_s, round(cast(sum(us) as double) / count(*) / 1000000.0, 3) as avg_interval_s, round(max(us) / 1000000.0, 3) as max_interval_s
  from (select exchange_id, symbol, ts_us - lag(ts_us) over (partition by exchange_id, symbol order by ts_us, id) as us from ticks) where us is not null group by all""",
)(lambda s, d: kpi.update_interval_stats(ticks(s, d)))

# marts

query("e01_symbol_coverage", "select kpi_date_utc, exchange_id, count(distinct symbol) as symbols_covered from daily_exchange_symbol group by all")(lambda s, d: marts.symbol_coverage(_kpis(s, d)["daily_exchange_symbol"], "day"))
query("e02_capped_score", f"select id, {twins._score('latency', '1000.0')} as score from (select id, (ts_us - exch_us) / 1000.0 as latency from ticks)")(lambda s, d: ticks(s, d).select("id", marts.capped_score((F.col("ts_us") - F.col("exch_us")) / 1000.0, 1000.0).alias("score")))
query("e03_minmax_score", f"select kpi_date_utc, exchange_id, round({twins._place('update_frequency_hz', 'kpi_date_utc')}, 9) as score from daily_exchange")(
    lambda s, d: _kpis(s, d)["daily_exchange"].select("kpi_date_utc", "exchange_id", F.round(marts.minmax_score(F.col("update_frequency_hz"), F.min("update_frequency_hz").over(marts.W.partitionBy("kpi_date_utc")), F.max("update_frequency_hz").over(marts.W.partitionBy("kpi_date_utc"))), 9).alias("score")))
query("e04_quality_score", "select kpi_date_utc, exchange_id, default_quality_score from quality_daily")(lambda s, d: _quality(s, d, "day").select("kpi_date_utc", "exchange_id", "default_quality_score"))
query("e05_platform_quality_daily", "select * from quality_daily")(lambda s, d: _quality(s, d, "day"))
query("e06_platform_quality_hourly", "select * from quality_hourly")(lambda s, d: _quality(s, d, "hour"))
_RANKED = "select *, dense_rank() over (partition by {1} order by coalesce(max_price_diff_pct, 0) desc, coalesce(max_price_diff_abs, 0) desc, symbol) as default_deviation_rank from {0}"
query("e07_price_deviation_daily_rank", _RANKED.format("deviation_daily", "kpi_date_utc"))(lambda s, d: tidy(marts.rank_price_deviation(_kpis(s, d)["price_deviation_daily"], "day")))
query("e08_price_deviation_hourly_rank", _RANKED.format("deviation_hourly", "kpi_hour_utc"))(lambda s, d: tidy(marts.rank_price_deviation(_kpis(s, d)["price_deviation_hourly"], "hour")))
query("e09_symbol_deviation_bucket", twins.tidy("select * from buckets_lines", _BUCKET))(lambda s, d: plain(marts.symbol_deviation_bucket(lines(s, d))))
_BASE = "select run_id, symbol, exchange_id, bucket_start_utc, bucket_epoch_s, cast(fill_method = 'observed' as int) as observed_flag from valid"
query("e10_observed_quality_base", _BASE)(lambda s, d: marts.observed_quality_base(cleansed(s, d)))
query("e11_latest_run", "select max(run_id) as latest_run_id from cleansed having max(run_id) is not null")(lambda s, d: marts.latest_run(cleansed(s, d)))
_CURVE24 = """select run_id, exchange_id, symbol, bucket_start_utc, bucket_epoch_s, round(price, 12) as price_close, row_number() over (partition by symbol order by bucket_epoch_s) as point_index_asc
  from valid v where exchange_id = 'binance' and bucket_epoch_s >= (select max(bucket_epoch_s) - 86400 from valid w where w.exchange_id = 'binance' and w.symbol = v.symbol)"""
query("e12_price_curve_24h", _CURVE24)(lambda s, d: marts.price_curve_24h(cleansed(s, d)))
query("e13_latest_quality_day", "select * from quality_daily where kpi_date_utc = (select max(kpi_date_utc) from quality_daily)")(lambda s, d: marts.latest_period(_quality(s, d, "day"), "kpi_date_utc").orderBy("default_quality_rank"))
query("e13b_latest_quality_hour", "select * from quality_hourly where kpi_hour_utc = (select max(kpi_hour_utc) from quality_hourly)")(lambda s, d: marts.latest_period(_quality(s, d, "hour"), "kpi_hour_utc").orderBy("default_quality_rank"))

# serving: the window is five days of the month

_FROM, _TO = 1704412800, 1704844800
_WINDOW = f"bucket_epoch_s between {_FROM} and {_TO}"
_BTC = "BTC/USDT"
query("e14_runs", "select run_id, min(bucket_start_utc) as min_bucket_start_utc, max(bucket_start_utc) as max_bucket_start_utc, count(*) as row_count from cleansed group by run_id")(lambda s, d: serving.runs(cleansed(s, d)))
query("e15_run_range", "select min(bucket_start_utc) as min_bucket_start_utc, max(bucket_start_utc) as max_bucket_start_utc, count(*) as row_count, count(*) filter (where price is not null and is_missing = 0 and is_stale = 0) as valid_row_count from cleansed where run_id = 'run1'")(lambda s, d: serving.run_range(cleansed(s, d), RUN))
query("e16_symbols_in", f"select distinct symbol from valid where {_WINDOW}")(lambda s, d: serving.symbols_in(cleansed(s, d), RUN, _FROM, _TO))
query("e17_price_curve", f"select run_id, exchange_id, symbol, bucket_start_utc, bucket_epoch_s, round(price, 12) as price_close from valid where symbol = '{_BTC}' and {_WINDOW}")(lambda s, d: serving.price_curve(cleansed(s, d), RUN, _BTC, _FROM, _TO))
query("e17b_price_curve_all_symbols", "select run_id, exchange_id, symbol, bucket_start_utc, bucket_epoch_s, floor(price * 1e8 + 0.5) / 1e8 as price_close from valid_lines")(lambda s, d: plain(serving.price_curve(lines(s, d), "lineitem")))
query("e18_deviation_series", f"select * from buckets where symbol = '{_BTC}' and {_WINDOW}")(lambda s, d: serving.deviation_series(cleansed(s, d), RUN, _BTC, _FROM, _TO))
query("e19_spread_points", "select run_id, symbol, bucket_start_utc, bucket_epoch_s, exchange_count, floor(price_diff_pct * 1e5 + 0.5) / 1e5 as price_diff_pct from buckets_lines")(lambda s, d: plain(serving.spread_points(lines(s, d), "lineitem")))
_COVERAGE = f"""select symbol, exchange_id, total_points, observed_points, most as max_observed_points_for_symbol, round(share, 4) as observed_vs_max_pct, case when share < 50 then '0-50%' when share < 75 then '50-75%' when share < 90 then '75-90%' else '90-100%' end as observed_quality_band,
  case when share < 50 then 0 when share < 75 then 1 when share < 90 then 2 else 3 end as band_order
  from (select *, case when most > 0 then 100.0 * observed_points / most else 0.0 end as share from (select *, max(observed_points) over (partition by symbol) as most from (select symbol, exchange_id, count(*) as total_points, cast(sum(observed_flag) as bigint) as observed_points from ({_BASE}) group by all)))"""


def _coverage(s: SparkSession, d: str) -> DataFrame:
    return serving.observed_coverage(marts.observed_quality_base(cleansed(s, d)), RUN)


query("e20_observed_coverage", _COVERAGE)(_coverage)
query("e21_eligible_symbols", f"select symbol from ({_COVERAGE}) where observed_quality_band in ('90-100%', '75-90%') group by symbol having count(distinct exchange_id) > 1")(lambda s, d: serving.eligible_symbols(_coverage(s, d), ["90-100%", "75-90%"]))
query("e22_deviation_from_curve", f"select bucket_start_utc, bucket_epoch_s, exchange_count, max_price_close as max_price, min_price_close as min_price, price_diff_abs, price_diff_pct, max_diff_exchange_pair from buckets where symbol = '{_BTC}'")(
    lambda s, d: serving.deviation_from_curve(serving.price_curve(cleansed(s, d), RUN, _BTC)))
query("e23_spread_from_curve", "select symbol, bucket_start_utc, bucket_epoch_s, exchange_count, floor(price_diff_pct * 1e5 + 0.5) / 1e5 as price_diff_pct from buckets_lines")(lambda s, d: plain(serving.spread_from_curve(serving.price_curve(lines(s, d), "lineitem"))))
query("e24_symbol_spread_stats", "select *, row_number() over (order by max_price_diff_pct desc, symbol) as spread_rank from (select symbol, count(*) as points, floor(round(avg(price_diff_pct), 6) * 1e5 + 0.5) / 1e5 as avg_price_diff_pct, floor(max(price_diff_pct) * 1e5 + 0.5) / 1e5 as max_price_diff_pct from buckets_lines group by symbol)")(
    lambda s, d: plain(serving.symbol_spread_stats(serving.spread_points(lines(s, d), "lineitem"))))
query(
    "e25_raw_overlay",
    f"""with own as (select * from valid where symbol = '{_BTC}' and {_WINDOW}), w as (select min(b) as lo, max(b) + coalesce(median(step), 60.0) as hi from (select b, b - lag(b) over (order by b) as step from (select distinct bucket_epoch_s as b from own)))
  select ts_us, exchange_id, price as price_close, exchange_id || '_raw' as series_name from ticks, w where symbol = '{_BTC}' and price is not null and exchange_id in (select exchange_id from own) and ts_us between lo * 1000000 and hi * 1000000""",
)(lambda s, d: serving.raw_overlay(ticks(s, d), serving.price_curve(cleansed(s, d), RUN, _BTC, _FROM, _TO), _BTC))
query("e26_exchange_point_counts", "select exchange_id, count(*) as points from valid_lines group by exchange_id")(lambda s, d: serving.exchange_point_counts(serving.price_curve(lines(s, d), "lineitem")))
query("e27_deviation_summary", f"select max(price_diff_pct) as max_price_diff_pct, max(price_diff_abs) as max_price_diff_abs, round(avg(price_diff_pct), 6) as avg_price_diff_pct, count(*) as compared_points, arg_min(bucket_start_utc, (-price_diff_abs, bucket_epoch_s)) as peak_bucket_start_utc, arg_min(max_diff_exchange_pair, (-price_diff_abs, bucket_epoch_s)) as peak_exchange_pair from buckets where symbol = '{_BTC}'")(
    lambda s, d: serving.deviation_summary(serving.deviation_series(cleansed(s, d), RUN, _BTC)))
query("e28_contains_filter", "select id, symbol from ticks where contains(lower(symbol), 'btc') or contains(lower(symbol), 'ada/')")(lambda s, d: filters.contains_filter(ticks(s, d), "symbol", "BTC, ada/").select("id", "symbol"))
query("e29_numeric_filter", "select id, last from ticks where last >= 400 or last between 10 and 20 or last < 1 - 1e-12")(lambda s, d: filters.numeric_filter(ticks(s, d), "last", ">=400, 20-10, <1, x, -5")[0].select("id", "last"))


def _caches(s: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    """The caches named, or all of them, written and read."""
    from ..sources.scratch import scratch_path

    prices = cleansed(s, d)
    tables = marts.cache_tables(prices, _quality(s, d, "day"), tidy(marts.rank_price_deviation(_kpis(s, d)["price_deviation_daily"], "day")))
    return marts.build_caches({name: tables[name] for name in names or tables}, scratch_path(s))


_LATEST = "(select max(kpi_date_utc) from deviation_daily)"
_LATEST_DEVIATION = f"select * from ({_RANKED.format('deviation_daily', 'kpi_date_utc')}) where kpi_date_utc = {_LATEST}"
_SYMBOLS = f"select symbol from ({_CURVE24}) union select symbol from deviation_daily where kpi_date_utc = {_LATEST} union select symbol from buckets"
query("e30_caches", _LATEST_DEVIATION)(lambda s, d: _caches(s, d, "price_deviation_daily_latest")["price_deviation_daily_latest"])
query("e30b_cached_quality", "select * exclude (latency_sample_count, interval_count, avg_update_interval_s, min_update_interval_s, max_update_interval_s) from quality_daily where kpi_date_utc = (select max(kpi_date_utc) from quality_daily)")(lambda s, d: _caches(s, d, "platform_quality_daily_latest")["platform_quality_daily_latest"])
query("e30c_cached_curve", f"select * exclude (bucket_epoch_s) from ({_CURVE24})")(lambda s, d: _caches(s, d, "price_curve_24h_latest")["price_curve_24h_latest"])
query("e30d_cached_buckets", twins.tidy("select * from buckets", _BUCKET))(lambda s, d: plain(_caches(s, d, "symbol_deviation_bucket")["symbol_deviation_bucket"]))
query("e30e_cached_symbols", _SYMBOLS)(lambda s, d: _caches(s, d, "symbols")["symbols"])
query(
    "e31_cache_metadata",
    f"""select 'platform_quality_daily_latest' as cache, count(*) as row_count from quality_daily where kpi_date_utc = (select max(kpi_date_utc) from quality_daily) union all select 'price_deviation_daily_latest', count(*) from deviation_daily where kpi_date_utc = {_LATEST}
  union all select 'price_curve_24h_latest', count(*) from ({_CURVE24}) union all select 'symbol_deviation_bucket', count(*) from buckets union all select 'symbols', count(*) from ({_SYMBOLS})""",
)(lambda s, d: marts.cache_metadata(_caches(s, d)))


def _dimension(name: str):
    return lambda s, d: marts.dimensions(_quality(s, d, "day"), _kpis(s, d)["price_deviation_daily"])[name]


query("e35_dim_date", "select distinct kpi_date_utc as date_key, cast(kpi_date_utc[:4] as int) as year_num, cast(kpi_date_utc[6:7] as int) as month_num, cast(kpi_date_utc[9:10] as int) as day_num from (select kpi_date_utc from quality_daily union select kpi_date_utc from deviation_daily)")(_dimension("date"))
query("e35b_dim_exchange", "select distinct exchange_id as exchange_key, exchange_id, 'exchange' as platform_type from quality_daily")(_dimension("exchange"))
query("e35c_dim_symbol", "select distinct symbol as symbol_key, symbol, split_part(symbol, '/', 1) as base_asset, split_part(symbol, '/', 2) as quote_asset from deviation_daily")(_dimension("symbol"))
_BANDED = "case when default_quality_score >= 0.75 then 'high' when default_quality_score >= 0.5 then 'medium' when default_quality_score >= 0 then 'low' end"
query("e35d_dim_quality_band", f"select quality_band_key, quality_band_key as quality_band_name, case quality_band_key when 'high' then '0.75-1' when 'medium' then '0.5-0.75' when 'low' then '0-0.5' end as score_interval, count(*) as facts from (select {_BANDED} as quality_band_key from quality_daily) group by all")(
    lambda s, d: marts.with_quality_band(_quality(s, d, "day")).join(_dimension("quality_band")(s, d), "quality_band_key").groupBy("quality_band_key", "quality_band_name", "score_interval").agg(F.count("*").alias("facts")))
