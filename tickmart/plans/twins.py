"""The SQL twins' shared tables: what the adapters and the larger operators compute, written again in DuckDB SQL."""

from __future__ import annotations

import re

_ISO = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_DAY = "strftime(make_timestamp({0}), '%Y-%m-%d')"
_HOUR = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:00:00Z')"


def iso(seconds: str) -> str:
    return _ISO.format(seconds)


def day(us: str) -> str:
    return _DAY.format(us)


def hour(us: str) -> str:
    return _HOUR.format(us)


def _latency(source: str, keys: str, named: str) -> str:
    return f"""select {named}, count(*) as latency_sample_count, cast((2 * sum(ts_us - exch_us) + count(*)) // (2 * count(*)) as bigint) / 1000.0 as avg_latency_ms,
  round(min(ts_us - exch_us) / 1000.0, 3) as min_latency_ms, round(max(ts_us - exch_us) / 1000.0, 3) as max_latency_ms from {source} group by {keys}"""


def _frequency(source: str, keys: str, named: str) -> str:
    mean = "cast(sum(ts_us - prev_us) as double) / count(*) / 1000000.0"
    return f"""select {named}, count(*) as interval_count, cast((2 * sum(ts_us - prev_us) + count(*)) // (2 * count(*)) as bigint) / 1000000.0 as avg_update_interval_s, round(min(ts_us - prev_us) / 1000000.0, 6) as min_update_interval_s,
  round(max(ts_us - prev_us) / 1000000.0, 6) as max_update_interval_s, round(case when {mean} > 0 then 1.0 / ({mean}) end, 6) as update_frequency_hz from {source} group by {keys}"""


def deviation(source: str, keys: str, count: str = "count(*)") -> str:
    """Extremes by ranking rows, then joining them: another way than the operator's."""
    on = ", ".join(k.strip() for k in keys.split(","))
    return f"""
  select {on}, exchange_count, round(high, 12) as max_price, round(low, 12) as min_price, round(high - low, 12) as price_diff_abs, round(case when low > 0 then (high - low) / low * 100.0 end, 9) as price_diff_pct,
    max_price_exchange_id, min_price_exchange_id, max_price_exchange_id || '|' || min_price_exchange_id as max_diff_exchange_pair
  from (select {on}, {count} as exchange_count, max(price) as high, min(price) as low from {source} group by {on}) a
  join (select {on}, exchange_id as max_price_exchange_id from {source} qualify row_number() over (partition by {on} order by price desc, exchange_id) = 1) b using ({on})
  join (select {on}, exchange_id as min_price_exchange_id from {source} qualify row_number() over (partition by {on} order by price, exchange_id) = 1) c using ({on})
  where exchange_count >= 2"""


def cleansed_sql(mode: str, run_id: str, ticks: str = "ticks") -> str:
    """bin 3600 s, fill limit 10800 s, stale after 5400 s."""
    line = "before_age <= 10800 and nxt.epoch_s - bucket_epoch_s <= 10800" if mode == "interpolation" else "false"
    return f"""
  select '{run_id}' as run_id, {iso("bucket_epoch_s")} as bucket_start_utc, bucket_epoch_s, exchange_id, symbol, 3600 as bin_seconds, 10800 as max_forward_fill_s, '{mode}' as fill_method_mode,
    case fill_method when 'observed' then prev.price when 'forward_fill' then prev.price when 'interpolation' then prev.price + (nxt.price - prev.price) * (before_age / (nxt.epoch_s - prev.epoch_s)) end as price,
    case when fill_method in ('observed', 'forward_fill') then {iso("prev.epoch_s")} end as source_ingestion_ts_utc, case when fill_method in ('observed', 'forward_fill') then prev.epoch_s end as source_ingestion_epoch_s,
    coalesce(n, 0) as tick_count_in_bin, fill_method, age as age_seconds, case when fill_method = 'observed' then 0 when fill_method = 'missing' or age > 5400 then 1 else 0 end as is_stale, cast(fill_method = 'missing' as int) as is_missing
  from (select *, case fill_method when 'observed' then 0 when 'forward_fill' then before_age when 'interpolation' then least(before_age, nxt.epoch_s - bucket_epoch_s) end as age
    from (select *, case when n is not null then 'observed' when {line} then 'interpolation' when before_age <= 10800 then 'forward_fill' else 'missing' end as fill_method
      from (select *, bucket_epoch_s - prev.epoch_s as before_age
        from (select exchange_id, symbol, bucket_epoch_s, n,
            last_value(final ignore nulls) over (partition by exchange_id, symbol order by bucket_epoch_s rows between unbounded preceding and current row) as prev,
            first_value(start ignore nulls) over (partition by exchange_id, symbol order by bucket_epoch_s rows between 1 following and unbounded following) as nxt
          from (select exchange_id, symbol, unnest(range(min(epoch_s) // 3600 * 3600, max(epoch_s) // 3600 * 3600 + 1, 3600)) as bucket_epoch_s from {ticks} where coalesce(price, last) is not null group by exchange_id, symbol) g
          left join (select exchange_id, symbol, epoch_s // 3600 * 3600 as bucket_epoch_s, count(*) as n, arg_min({{'price': coalesce(price, last), 'epoch_s': epoch_s}}, (ts_us, id)) as start, arg_max({{'price': coalesce(price, last), 'epoch_s': epoch_s}}, (ts_us, id)) as final
            from {ticks} where coalesce(price, last) is not null group by all) o using (exchange_id, symbol, bucket_epoch_s)))))"""


def _score(column: str, cap: str) -> str:
    return f"case when {column} is null then 0.0 when {column} <= 0 then 1.0 when {column} >= {cap} then 0.0 else 1.0 - {column} / {cap} end"


def _place(column: str, period: str) -> str:
    low, high = f"min({column}) over (partition by {period})", f"max({column}) over (partition by {period})"
    return f"case when {column} is null then 0.0 when {low} = {high} then 1.0 else ({column} - {low}) / cast({high} - {low} as double) end"


def _quality(period: str, name: str) -> str:
    return f"""
  select *, dense_rank() over (partition by {period} order by default_quality_score desc, coalesce(avg_latency_ms, 1e12), coalesce(max_latency_ms, 1e12), disconnect_count, coalesce(min_latency_ms, 1e12), exchange_id) as default_quality_rank
  from (select *, floor((({_score("min_latency_ms", "1000.0")}) * 0.15 + ({_score("avg_latency_ms", "10000.0")}) * 0.35 + ({_score("max_latency_ms", "600000.0")}) * 0.30 + ({_place("update_frequency_hz", period)}) * 0.10 + ({_score("disconnect_count", "10.0")}) * 0.08 + ({_place("symbols_covered", period)}) * 0.02) * 1e6 + 0.5) / 1e6 as default_quality_score
    from (select e.* exclude (disconnect_count), coalesce(disconnect_count, 0) as disconnect_count, coalesce(symbols_covered, 0) as symbols_covered from {name}_exchange e
      left join (select {period}, exchange_id, count(distinct symbol) as symbols_covered from {name}_exchange_symbol group by all) using ({period}, exchange_id)))"""


_SYMBOL = "case event_type when 'view' then 'BTC/USDT' when 'click' then 'ETH/USDT' when 'purchase' then 'SOL/USDT' when 'signup' then 'ADA/USDT' end"
_EXCHANGE = "['binance', 'kraken', 'coinbase', 'okx', 'bybit'][(user_id % 5) + 1]"

TABLES: dict[str, str] = {
    "ticks": f"""
  select event_id as id, epoch_us(ts) as ts_us, epoch_us(ts) // 1000000 as epoch_s, {_EXCHANGE} as exchange_id, {_SYMBOL} as symbol, lower({_SYMBOL}) as symbol_norm, lower(split_part({_SYMBOL}, '/', 1)) as asset_norm,
    case when event_id % 97 = 0 then null when event_id % 101 = 0 then -value else value end as price, case when event_id % 103 = 0 then value * 1.001 else value * 0.999 end as bid,
    case when event_id % 103 = 0 then value * 0.999 else value * 1.001 end as ask, case when event_id % 194 <> 0 then value end as last, cast(json_extract_string(props, '$.k') as double) as base_volume,
    cast(json_extract_string(props, '$.k') as double) * value as quote_volume,
    case when event_id % 89 = 0 then null when event_id % 83 = 0 then epoch_us(ts) + 250000 else epoch_us(ts) - (event_id * 37) % 1500 * 1000 end as exch_us, props as raw_json
  from events where event_type <> 'error'""",
    "conn": f"""
  select event_id as id, epoch_us(ts) as ts_us, epoch_us(ts) // 1000000 as epoch_s, {_EXCHANGE} as exchange_id, case when event_id % 3 = 2 then 'reconnected' else 'disconnect' end as event_type, props as details_json
  from events where event_type = 'error'""",
    "samples": f"select {day('ts_us')} as kpi_date_utc, exchange_id, symbol, ts_us, exch_us, (ts_us - exch_us) / 1000.0 as latency_ms from ticks where ts_us >= exch_us",
    "intervals": f"""
  select {day('ts_us')} as kpi_date_utc, exchange_id, symbol, ts_us, prev_us, (ts_us - prev_us) / 1000000.0 as update_interval_s
  from (select *, lag(ts_us) over (partition by exchange_id, symbol order by ts_us, id) as prev_us from ticks) where ts_us > prev_us""",
    "latency_daily": _latency("samples", "all", f"{day('ts_us')} as kpi_date_utc, exchange_id, symbol"),
    "latency_hourly": _latency("samples", "all", f"{hour('ts_us')} as kpi_hour_utc, exchange_id, symbol"),
    "frequency_daily": _frequency("intervals", "all", f"{day('ts_us')} as kpi_date_utc, exchange_id, symbol"),
    "frequency_hourly": _frequency("intervals", "all", f"{hour('ts_us')} as kpi_hour_utc, exchange_id, symbol"),
    "drops_daily": f"select {day('ts_us')} as kpi_date_utc, exchange_id, count(*) as disconnect_count from conn where event_type = 'disconnect' group by all",
    "drops_hourly": f"select {hour('ts_us')} as kpi_hour_utc, exchange_id, count(*) as disconnect_count from conn where event_type = 'disconnect' group by all",
    "latency_ex_daily": _latency("samples", "all", f"{day('ts_us')} as kpi_date_utc, exchange_id"),
    "latency_ex_hourly": _latency("samples", "all", f"{hour('ts_us')} as kpi_hour_utc, exchange_id"),
    "frequency_ex_daily": _frequency("intervals", "all", f"{day('ts_us')} as kpi_date_utc, exchange_id"),
    "frequency_ex_hourly": _frequency("intervals", "all", f"{hour('ts_us')} as kpi_hour_utc, exchange_id"),
    "daily_exchange_symbol": """
  select * from (select kpi_date_utc, exchange_id, symbol from latency_daily union select kpi_date_utc, exchange_id, symbol from frequency_daily)
  left join latency_daily using (kpi_date_utc, exchange_id, symbol) left join frequency_daily using (kpi_date_utc, exchange_id, symbol) left join drops_daily using (kpi_date_utc, exchange_id)""",
    "hourly_exchange_symbol": """
  select * from (select kpi_hour_utc, exchange_id, symbol from latency_hourly union select kpi_hour_utc, exchange_id, symbol from frequency_hourly)
  left join latency_hourly using (kpi_hour_utc, exchange_id, symbol) left join frequency_hourly using (kpi_hour_utc, exchange_id, symbol) left join drops_hourly using (kpi_hour_utc, exchange_id)""",
    "daily_exchange": """
  select * from (select kpi_date_utc, exchange_id from latency_ex_daily union select kpi_date_utc, exchange_id from frequency_ex_daily union select kpi_date_utc, exchange_id from drops_daily)
  left join latency_ex_daily using (kpi_date_utc, exchange_id) left join frequency_ex_daily using (kpi_date_utc, exchange_id) left join drops_daily using (kpi_date_utc, exchange_id)""",
    "hourly_exchange": """
  select * from (select kpi_hour_utc, exchange_id from latency_ex_hourly union select kpi_hour_utc, exchange_id from frequency_ex_hourly union select kpi_hour_utc, exchange_id from drops_hourly)
  left join latency_ex_hourly using (kpi_hour_utc, exchange_id) left join frequency_ex_hourly using (kpi_hour_utc, exchange_id) left join drops_hourly using (kpi_hour_utc, exchange_id)""",
    "quality_daily": _quality("kpi_date_utc", "daily"),
    "quality_hourly": _quality("kpi_hour_utc", "hourly"),
    "cleansed": cleansed_sql("forward_fill", "run1"),
    "lines": """
  select 'lineitem' as run_id, day, epoch(cast(day as timestamp)) as bucket_epoch_s, exchange_id, symbol, price, 'observed' as fill_method, 0 as is_stale, 0 as is_missing
  from (select 'ex' || (l_suppkey % 8) as exchange_id, 'S' || (l_partkey % 20) || '/USD' as symbol, cast(l_shipdate as date) as day, arg_max(cast(l_extendedprice / l_quantity as double), (l_orderkey, l_linenumber)) as price from lineitem group by all)""",
    "lines_cleansed": f"select * exclude (day, bucket_epoch_s), cast(bucket_epoch_s as bigint) as bucket_epoch_s, {iso('cast(bucket_epoch_s as bigint)')} as bucket_start_utc from lines",
    "valid": "select *, bucket_start_utc[:10] as kpi_date_utc from cleansed where price is not null and is_missing = 0 and is_stale = 0",
    "valid_lines": "select *, bucket_start_utc[:10] as kpi_date_utc from lines_cleansed",
    "aligned": deviation("valid", "kpi_date_utc, bucket_start_utc, bucket_epoch_s, symbol"),
    "aligned_lines": deviation("valid_lines", "kpi_date_utc, bucket_start_utc, bucket_epoch_s, symbol"),
    "profiles": "select exchange_id, symbol, min(epoch_s) as min_epoch_s, max(epoch_s) as max_epoch_s, count(*) as source_tick_count from ticks where coalesce(price, last) is not null group by all",
}


def tidy(sql: str, columns: str) -> str:
    """sql with prices to 8 and percentages to 5 digits, by the same arithmetic as in Spark."""
    parts = ", ".join(f"floor({c} * 1e{5 if 'pct' in c else 8} + 0.5) / 1e{5 if 'pct' in c else 8} as {c}" for c in columns.split())
    return f"select * replace ({parts}) from ({sql})"


def price_deviation(period: str, key: str, source: str = "aligned") -> str:
    return f"""
  select {key} as {period}, symbol, count(*) as aligned_points_compared, max(price_diff_abs) as max_price_diff_abs, max(price_diff_pct) as max_price_diff_pct, avg(price_diff_abs) as avg_price_diff_abs, avg(price_diff_pct) as avg_price_diff_pct,
    arg_min(bucket_start_utc, (-price_diff_abs, bucket_epoch_s)) as max_diff_bucket_start_utc, arg_min(max_diff_exchange_pair, (-price_diff_abs, bucket_epoch_s)) as max_diff_exchange_pair
  from {source} group by all"""


TABLES |= {
    "deviation_daily": tidy(price_deviation("kpi_date_utc", "kpi_date_utc"), "avg_price_diff_abs avg_price_diff_pct"),
    "deviation_hourly": tidy(price_deviation("kpi_hour_utc", "bucket_start_utc[:13] || ':00:00Z'"), "avg_price_diff_abs avg_price_diff_pct"),
    "deviation_lines_daily": price_deviation("kpi_date_utc", "kpi_date_utc", "aligned_lines"),
    "buckets": f"select * exclude (max_price, min_price), max_price as max_price_close, min_price as min_price_close from ({deviation('valid', 'run_id, symbol, bucket_start_utc, bucket_epoch_s')}) where price_diff_pct is not null",
    "buckets_lines": f"select * exclude (max_price, min_price), max_price as max_price_close, min_price as min_price_close from ({deviation('valid_lines', 'run_id, symbol, bucket_start_utc, bucket_epoch_s')}) where price_diff_pct is not null",
}


#: The core tables once more, of one day and run, named *_fast.
FAST_DATE, FAST_RUN = "2024-01-05", "run1"
_CORE = [
    "samples", "intervals", "valid", "aligned", "drops_daily", "drops_hourly", *[f"{kind}_{grain}" for kind in ("latency", "frequency", "latency_ex", "frequency_ex", "deviation") for grain in ("daily", "hourly")],
    "daily_exchange_symbol", "hourly_exchange_symbol", "daily_exchange", "hourly_exchange",
]
TABLES |= {
    "ticks_fast": f"select * from ticks where {day('ts_us')} = '{FAST_DATE}'",
    "conn_fast": f"select * from conn where {day('ts_us')} = '{FAST_DATE}'",
    "cleansed_fast": f"select * from cleansed where run_id = '{FAST_RUN}' and bucket_start_utc[:10] = '{FAST_DATE}'",
} | {f"{name}_fast": re.sub(rf"\b({'|'.join(['ticks', 'conn', 'cleansed', *_CORE])})\b", r"\1_fast", TABLES[name]) for name in _CORE}


def assertions(suffix: str = "", most_hz: str = "100", most_pct: str = "200") -> str:
    """(assertion_name, severity, is_failed, failed_rows, details) over the KPI tables whose names end in suffix."""
    out = []
    for grain, tail in (("daily", ""), ("hourly", "_hourly")):
        of = " of hourly" if tail else ""
        latency, frequency, drops, deviated = (f"{k}_{grain}{suffix}" for k in ("latency", "frequency", "drops", "deviation"))
        out += [
            f"select 'latency_non_negative{tail}' as assertion_name, 'error' as severity, count(*) filter (where min_latency_ms < 0) as failed_rows, 'min_latency_ms must be >= 0{of}' as details from {latency}",
            f"select 'latency_upper_bound{tail}', 'error', count(*) filter (where max_latency_ms > 600000), 'max_latency_ms must be <= 600000{of}' from {latency}",
            f"select 'update_interval_positive{tail}', 'error', count(*) filter (where min_update_interval_s <= 0), 'min_update_interval_s must be > 0{of}' from {frequency}",
            f"select 'update_frequency_bounds{tail}', 'error', count(*) filter (where update_frequency_hz < 0 or update_frequency_hz > {most_hz}), 'update_frequency_hz must be in 0..100{of}' from {frequency}",
            f"select 'disconnect_count_non_negative{tail}', 'error', count(*) filter (where disconnect_count < 0), 'disconnect_count must be >= 0{of}' from {drops}",
            f"select 'price_diff_abs_non_negative{tail}', 'error', count(*) filter (where max_price_diff_abs < 0), 'max_price_diff_abs must be >= 0{of}' from {deviated}",
            f"select 'price_diff_pct_bounds{tail}', 'error', count(*) filter (where max_price_diff_pct < 0 or max_price_diff_pct > {most_pct}), 'max_price_diff_pct must be in 0..200{of}' from {deviated}",
            f"select 'coverage_latency_{grain}', 'warn', cast(count(*) = 0 as bigint), 'no rows in latency_{grain}' from {latency}",
            f"select 'coverage_update_frequency_{grain}', 'warn', cast(count(*) = 0 as bigint), 'no rows in update_frequency_{grain}' from {frequency}",
            f"select 'coverage_price_deviation_{grain}', 'warn', cast(count(*) = 0 as bigint), 'no rows in price_deviation_{grain}' from {deviated}",
        ]
    return "select assertion_name, severity, cast(failed_rows > 0 as int) as is_failed, failed_rows, details from (" + " union all ".join(out) + ")"


def with_tables(sql: str) -> str:
    """sql behind the tables that it names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    own = ", ".join(f"{n} as ({TABLES[n]})" for n in needed)
    sql = sql.strip()
    if sql.startswith("with recursive "):
        return f"with recursive {own}, {sql[15:]}"
    return f"with {own}, {sql[5:]}" if sql.startswith("with ") else f"with {own}\n{sql}"
