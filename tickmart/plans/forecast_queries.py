"""Registered queries over ingest, manifest, staging and forecasting."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import filters, keys
from ..operators import backtest, features, ingest, ledger, manifest, models, serving, staging, trees
from ..sources import adapters as src
from ..sources.scratch import exists, scratch_path, written
from ..sources.staging import read_staging, read_vault, write_vault
from . import twins
from .market_queries import RUN, cleansed, conn, ticks
from .registry import query

# ingest: stream messages

_MESSAGES = f"""(with e as (select *, event_type <> 'error' as tick, epoch_us(ts) // 1000 as ms, coalesce({twins._SYMBOL}, '') as symbol from events)
  select event_id as i, tick, value, props, ms, symbol, ' ' || upper({twins._EXCHANGE}) as exchange_id, event_id * 2 as stream_id from e union all select event_id, tick, value, props, ms, symbol, ' ' || upper({twins._EXCHANGE}), event_id * 2 + 1 from e where event_id % 7 = 0)"""
_BAD = "case i % 50 when 4 then 'event_json is not an object' when 5 then 'event_json is not an object' when 6 then 'missing required keys: schema_version' when 1 then 'unsupported event_type=trade' when 3 then 'dedup_key is empty' when 2 then 'exchange_id is empty' end"


def _parsed(s: SparkSession, d: str) -> DataFrame:
    return ingest.parse_envelopes(src.envelopes(s, d))


def _events(s: SparkSession, d: str) -> DataFrame:
    return ingest.dedup_events(ingest.validate_envelopes(_parsed(s, d))[0])


query("a01_parse_envelopes", f"select stream_id, case when i % 50 not in (4, 5) then cast(i as varchar) end as event_id from {_MESSAGES}")(lambda s, d: _parsed(s, d).select("stream_id", F.col("event.event_id").alias("event_id")))
query("a02_validate_envelopes", f"select stream_id, {_BAD} as error_message from {_MESSAGES}")(lambda s, d: ingest.with_errors(_parsed(s, d)).select("stream_id", "error_message"))
query("a03_dead_letters", f"select 'ticks' as source_stream, cast(stream_id as varchar) as source_message_id, {_BAD} as error_message from {_MESSAGES} where {_BAD} is not null")(
    lambda s, d: ingest.dead_letters(ingest.validate_envelopes(_parsed(s, d))[1], "ticks").select("source_stream", "source_message_id", "error_message"))
#: Prices of all sizes, from about 1e-7 to 1e14, by factors that both engines read as the same doubles.
_PRICES = ("price", "bid", "ask", "last")
_FACTOR = "cast(case id % 6 when 0 then '1' when 1 then '1e-7' when 2 then '1e-3' when 3 then '1e5' when 4 then '1e9' else '1e12' end as double)"
_PRICE_TEXT = ", ".join(f"coalesce(cast({c} * {_FACTOR} as varchar), 'None')" for c in _PRICES)
query("a04_tick_dedup_key", f"select id, sha256(concat_ws('|', exchange_id, symbol_norm, cast(ts_us // 1000 as varchar), {_PRICE_TEXT})) as dedup_key from ticks")(
    lambda s, d: ticks(s, d).select("id", F.concat(F.lit(" "), F.upper("exchange_id")).alias("exchange_id"), "symbol", F.floor(F.col("ts_us") / 1000).alias("event_ts_ms"), *[F.expr(f"{c} * {_FACTOR}").alias(c) for c in _PRICES]).select("id", keys.tick_dedup_key().alias("dedup_key")))
_SAID = {"symbol": "case id % 4 when 0 then ' BTC/USDT' when 1 then 'eth/Usdt ' when 2 then '' end", "severity": "case id % 3 when 0 then 'warn' when 1 then 'error' else 'info' end", "message": "case when id % 5 > 0 then details_json end"}
query("a05_event_dedup_key", f"select id, sha256(concat_ws('|', exchange_id, coalesce(lower(trim({_SAID['symbol']})), ''), event_type, {_SAID['severity']}, cast(epoch_s as varchar), coalesce({_SAID['message']}, ''))) as dedup_key from conn")(
    lambda s, d: conn(s, d).select("id", "exchange_id", F.col("event_type").alias("event_name"), F.floor(F.col("ts_us") / 1000).alias("event_ts_ms"), *[F.expr(x).alias(c) for c, x in _SAID.items()]).select("id", keys.event_dedup_key().alias("dedup_key")))
query("a06_dedup_events", f"select min(stream_id) as stream_id from {_MESSAGES} where {_BAD} is null group by i")(lambda s, d: _events(s, d).select("stream_id"))
_ONCE = f"(select distinct on (i) * from {_MESSAGES} where {_BAD} is null order by i, stream_id)"
query("a07_market_ticks", f"select (ms + 20) * 1000 as ts_us, trim(exchange_id) as exchange_id, lower(trim(exchange_id)) as exchange_id_norm, symbol, lower(symbol) as symbol_norm, lower(split_part(symbol, '/', 1)) as asset_norm, value as price, value as last, (ms - 5) * 1000 as exch_us, props as raw_json from {_ONCE} where tick")(
    lambda s, d: ingest.to_market_ticks(_events(s, d)).select("ts_us", "exchange_id", "exchange_id_norm", "symbol", "symbol_norm", "asset_norm", "price", "last", "exch_us", "raw_json"))


def _tickers(s: SparkSession, d: str) -> DataFrame:
    """Payloads of one ticker, an object of tickers and a list of them, of ticks by id."""
    t = ticks(s, d)
    one = F.to_json(F.struct("symbol", F.floor(F.col("exch_us") / 1000).alias("timestamp"), F.col("price").alias("close"), F.when(F.col("id") % 2 == 0, F.col("last")).alias("last"), F.col("base_volume").alias("baseVolume")))
    payload = F.when(F.col("id") % 3 == 0, one).when(F.col("id") % 3 == 1, F.concat(F.lit('{"a":'), one, F.lit(',"b":{"x":1}}'))).otherwise(F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
    return ingest.explode_tickers(t.select("id", "exchange_id", F.col("ts_us").alias("ingestion_us"), payload.alias("payload")))


_TWICE = "(select * from ticks union all select * from ticks where id % 3 = 2)"
query("a08_tickers_to_ticks", f"select ts_us, exchange_id, symbol, asset_norm, coalesce(case when id % 2 = 0 then last end, price) as price, case when id % 2 = 0 then last end as last, base_volume, exch_us // 1000 * 1000 as exch_us from {_TWICE}")(
    lambda s, d: ingest.tickers_to_ticks(_tickers(s, d)).select("ts_us", "exchange_id", "symbol", "asset_norm", "price", "last", "base_volume", "exch_us"))
query("a09_explode_tickers", f"select id, symbol from {_TWICE}")(lambda s, d: _tickers(s, d).select("id", F.get_json_object("ticker", "$.symbol").alias("symbol")))
query("a10_connection_events", f"select ms * 1000 as ts_us, lower(trim(exchange_id)) as exchange_id_norm, case when i % 2 = 0 then 'disconnect' else 'connection_event' end as event_type from {_ONCE} where not tick")(
    lambda s, d: ingest.to_connection_events(_events(s, d)).select("ts_us", "exchange_id_norm", "event_type"))


_COUNTED = f"select symbol, exchange_id_norm, count(*) as rows from (select symbol, lower(trim(exchange_id)) as exchange_id_norm from {_ONCE} where tick) group by all"
_TICK_SCHEMA = "symbol string, exchange_id_norm string, layer string, exchange string, date string, hour string"


#: Messages of a file that the stream reads, about 10 MB.
_FILE_ROWS = 100_000


def _ingested(s: SparkSession, d: str, batches: int = 1) -> str:
    """The folder of a vault that all messages have streamed into, in so many batches of as many files as their number asks for."""
    from ..streaming.vault import start_ingest

    path, messages = scratch_path(s), src.envelopes(s, d)
    files = -(-messages.count() // (batches * _FILE_ROWS)) or 1
    messages.repartition(batches * files, "stream_id").write.parquet(f"{path}/in")
    stream = s.readStream.schema("stream_id bigint, event_json string").option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    start_ingest(stream, f"{path}/vault").awaitTermination()
    return f"{path}/vault"


@query("a11_vault_stream", _COUNTED)
def a11_vault_stream(s: SparkSession, d: str) -> DataFrame:
    """Messages through the streaming ingest into the vault, and counted there."""
    from ..streaming.vault import committed

    return committed(s, _ingested(s, d), "market_ticks", _TICK_SCHEMA).groupBy("symbol", "exchange_id_norm").agg(F.count("*").alias("rows"))


@query("a11b_vault_hours", f"select lower(trim(exchange_id)) as exchange, strftime(make_timestamp((ms + 20) * 1000), '%Y-%m-%d') as date, strftime(make_timestamp((ms + 20) * 1000), '%H') as hour, count(*) as rows from {_ONCE} where tick group by all")
def a11b_vault_hours(s: SparkSession, d: str) -> DataFrame:
    """Messages in two batches, moved into hourly folders; copies of a message may come in another batch than it."""
    from ..streaming.vault import committed, compact

    path = _ingested(s, d, 2)
    compact(s, path)
    return committed(s, path, "market_ticks", _TICK_SCHEMA).groupBy("exchange", "date", "hour").agg(F.count("*").alias("rows"))


@query("a06b_recent_events", f"select i as event_id from {_ONCE}")
def a06b_recent_events(s: SparkSession, d: str) -> DataFrame:
    """Events of a replayed stream, each once: keyed state holds the keys of the last hours."""
    from ..streaming.vault import recent_events

    path = scratch_path(s)
    src.envelopes(s, d).coalesce(1).write.parquet(f"{path}/in")
    stream = s.readStream.schema("stream_id bigint, event_json string").parquet(f"{path}/in")
    recent_events(stream).select(F.col("event_id").cast("long").alias("event_id")).writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return s.read.schema("event_id bigint").parquet(f"{path}/out")


_ID = "'raw:' || exchange_id || ':' || strftime(make_timestamp(ts_us), '%Y%m%d_%H')"
_REGISTRY = f"select {_ID} as partition_id, 'raw' as layer, exchange_id, min(epoch_s) as ts_min_epoch_s, max(epoch_s) as ts_max_epoch_s, count(*) as row_count from (select exchange_id, ts_us, epoch_s from ticks union all select exchange_id, ts_us, epoch_s from conn) group by all"
_PAIRS = f"select {_ID} as partition_id, exchange_id, symbol_norm as symbol, asset_norm, min(epoch_s) as ts_min_epoch_s, max(epoch_s) as ts_max_epoch_s, count(*) as row_count from ticks group by all"


def _registry(s: SparkSession, d: str) -> DataFrame:
    return manifest.partition_registry(ticks(s, d), conn(s, d))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return manifest.partition_pairs(ticks(s, d), conn(s, d))


query("a12_partition_registry", _REGISTRY)(_registry)
query("a13_partition_pairs", _PAIRS)(_pairs)
query("a14_merge_manifest", f"select partition_id, layer, exchange_id, ts_min_epoch_s, ts_max_epoch_s + 60 as ts_max_epoch_s, 2 * row_count as row_count from ({_REGISTRY})")(
    lambda s, d: manifest.merge_manifest(_registry(s, d), _registry(s, d).withColumn("ts_max_epoch_s", F.col("ts_max_epoch_s") + 60)))
query("a15_filter_symbols", "select id from ticks where lower(symbol) = 'eth/usdt' or lower(symbol) like 's%' or lower(symbol) like '%a/u_dt'")(lambda s, d: filters.filter_symbols(ticks(s, d), "ETH/USDT, s%, %A/U_DT").select("id"))
query("a16_filter_exchanges", "select id from ticks where exchange_id in ('binance', 'okx') and exchange_id <> 'okx'")(lambda s, d: filters.filter_exchanges(ticks(s, d), "Binance, OKX", "okx").select("id"))
query(
    "a17_feed_load_profile",
    """select *, ticks / 2592000.0 as ticks_per_sec, bytes_total / 2592000.0 as bytes_per_sec, reconnects / 43200.0 as reconnects_per_min, greatest(1.0, bytes_total / 2592000.0 + 2000.0 * (reconnects / 43200.0)) as score
  from (select exchange_id, count(*) as ticks, cast(sum(length(raw_json)) as bigint) as bytes_total from ticks group by all) full join (select exchange_id, count(*) as reconnects from conn where event_type = 'reconnected' group by all) using (exchange_id)""",
)(lambda s, d: ingest.feed_load_profile(ticks(s, d), conn(s, d), 30 * 86_400.0))
query("a18_select_symbols", "select exchange_id, symbol from (select *, row_number() over (partition by exchange_id order by symbol) as k from (select distinct exchange_id, symbol from ticks where id % 5 <> 0 and id % 2 = 0)) where k <= 3")(
    lambda s, d: ingest.select_symbols(ticks(s, d).select("exchange_id", "symbol", (F.col("id") % 5 != 0).alias("active"), (F.col("id") % 2 == 0).alias("spot")), only_spot=True, most=3))

# staging: six hours that end two hours before the last BTC tick of two exchanges

_MAX = f"select max(ts_max_epoch_s) as max_epoch_s from ({_PAIRS}) where exchange_id in ('binance', 'okx') and symbol = 'btc/usdt'"
_WINDOW = f"(select m - 7200 - 21600 as start_s, m - 7200 as end_s from (select max_epoch_s as m from ({_MAX})))"
_PICKED = f"select r.* from ({_REGISTRY}) r, {_WINDOW} w where r.exchange_id in ('binance', 'okx') and r.ts_max_epoch_s >= start_s and r.ts_min_epoch_s <= end_s and partition_id in (select partition_id from ({_PAIRS}) p, {_WINDOW} v where symbol = 'btc/usdt' and p.ts_max_epoch_s >= v.start_s and p.ts_min_epoch_s <= v.end_s)"
_SCOPE = {"exchanges": "binance,okx", "symbols": "BTC/USDT"}


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(s: SparkSession, d: str, name: str) -> str:
    """The folder of a part of the vault (ticks, events) or of its manifest (registry, pairs), from all rows in d.

    Written once for each application.
    """
    key = (s.sparkContext.applicationId, d, name)
    if key not in _STORED or not exists(s, _STORED[key]):
        path = scratch_path(s)
        if name in _SOURCES:
            write_vault(manifest.with_partition(_SOURCES[name](s, d)), path)
        else:
            {"registry": _registry, "pairs": _pairs}[name](s, d).write.parquet(path)
        _STORED[key] = path
    return _STORED[key]


_SOURCES = {"ticks": ticks, "events": conn}


def _manifest(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(registry, pairs) as stored."""
    return s.read.parquet(_stored(s, d, "registry")), s.read.parquet(_stored(s, d, "pairs"))


def _vault(s: SparkSession, d: str, name: str) -> DataFrame:
    return read_vault(s, _stored(s, d, name), manifest.with_partition(_SOURCES[name](s, d)).schema)


def _window(s: SparkSession, d: str) -> DataFrame:
    return manifest.relative_window(manifest.source_max_epoch(*_manifest(s, d), **_SCOPE), 6, 2)


def _picked(s: SparkSession, d: str) -> DataFrame:
    return manifest.prune_partitions(*_manifest(s, d), _window(s, d), **_SCOPE)


def _staged(s: SparkSession, d: str) -> DataFrame:
    return staging.extract_ticks(_vault(s, d, "ticks"), _window(s, d), _picked(s, d), **_SCOPE)


def _staged_events(s: SparkSession, d: str) -> DataFrame:
    return staging.extract_events(_vault(s, d, "events"), _window(s, d), exchanges="binance,okx")


_TICKS = f"select t.*, {_ID} as source_partition_id from ticks t, {_WINDOW} where exchange_id in ('binance', 'okx') and symbol = 'BTC/USDT' and epoch_s between start_s and end_s and {_ID} in (select partition_id from ({_PICKED}))"
query("b01_source_max_epoch", _MAX)(lambda s, d: manifest.source_max_epoch(*_manifest(s, d), **_SCOPE))
query("b02_relative_window", f"select * from {_WINDOW}")(_window)
query("b03_prune_partitions", _PICKED)(_picked)
query("b04_extract_ticks", f"select id, exchange_id, symbol, ts_us, source_partition_id from ({_TICKS})")(lambda s, d: _staged(s, d).select("id", "exchange_id", "symbol", "ts_us", "source_partition_id"))
query("b05_extract_events", f"select id, exchange_id, event_type, ts_us from conn, {_WINDOW} where exchange_id in ('binance', 'okx') and epoch_s between start_s and end_s")(
    lambda s, d: _staged_events(s, d).select("id", "exchange_id", "event_type", "ts_us"))
query("b06_provenance", f"select source_partition_id, 'layer=raw/exchange=' || exchange_id || '/date=' || {twins.day('ts_us')} || '/hour=' || strftime(make_timestamp(ts_us), '%H') as source_folder, id as source_row_id from ({_TICKS})")(
    lambda s, d: _staged(s, d).select("source_partition_id", F.regexp_extract("source_path", "/([^/]+/[^/]+/[^/]+/[^/]+)/[^/]+$", 1).alias("source_folder"), "source_row_id"))
query("b07_list_scope", f"select w.*, (select count(*) from ({_PICKED})) as partitions, (select cast(coalesce(sum(row_count), 0) as bigint) from ({_PICKED})) as rows from {_WINDOW} w")(lambda s, d: manifest.list_scope(*_manifest(s, d), _window(s, d), **_SCOPE))
query("b08_run_metadata", f"select 'stage1' as run_id, w.*, (select count(*) from ({_TICKS})) as tick_rows, (select count(*) from conn, {_WINDOW} v where exchange_id in ('binance', 'okx') and epoch_s between v.start_s and v.end_s) as event_rows, (select count(*) from ({_PICKED})) as partitions from {_WINDOW} w")(
    lambda s, d: staging.staging_run_metadata(_staged(s, d), _staged_events(s, d), _picked(s, d), _window(s, d), "stage1"))


@query("b09_read_staging", "select id from ticks where id % 3 <> 2")
def b09_read_staging(s: SparkSession, d: str) -> DataFrame:
    """Three exports, of which one is left out."""
    path = scratch_path(s)
    for k in range(3):
        ticks(s, d).where(F.col("id") % 3 == k).write.parquet(f"{path}/{k}")
    return read_staging(s, [f"{path}/{k}" for k in (0, 1, 2, 1)], [f"{path}/2"]).select("id")


# forecasting: hourly series

CONFIG = models.Config(bin_seconds=3600, horizons=(1, 6), min_train_rows=200)
BACKTEST = backtest.Config(horizon_steps=6, horizon_seconds=6 * 3600)


def _series(s: SparkSession, d: str) -> DataFrame:
    return features.resample_last(features.merge_series(ticks(s, d)), 3600)


_SERIES = "(select exchange_id, symbol, epoch_s // 3600 * 3600 as bucket_epoch_s, arg_max(coalesce(price, last, (bid + ask) / 2.0), (ts_us, id)) as price from ticks group by all having arg_max(coalesce(price, last, (bid + ask) / 2.0), (ts_us, id)) > 0)"
_KEY = "exchange_id, symbol, bucket_epoch_s"
_OVER = "over (partition by exchange_id, symbol order by bucket_epoch_s{0})"


def _lag(k: int) -> str:
    return f"lag(price, {k}) {_OVER.format('')}"


def _roll(f: str, n: int) -> str:
    return f"case when row_number() {_OVER.format('')} > {n} then {f}(price) {_OVER.format(f' rows between {n} preceding and 1 preceding')} end"


def _nine(df: DataFrame) -> DataFrame:
    """Floating sums depend on order in their last digits: keep eight."""
    return df.select(*[(F.floor(F.col(c) * 1e8 + 0.5) / 1e8).alias(c) if kind == "double" and c != "price" else F.col(c) for c, kind in df.dtypes])


def _eight(x: str) -> str:
    return f"floor(({x}) * 1e8 + 0.5) / 1e8"


query("f01_training_price", "select id, coalesce(price, last, (bid + ask) / 2.0) as training_price from ticks")(lambda s, d: ticks(s, d).select("id", features.training_price().alias("training_price")))
query("f02_scope_pairs", "select exchange_id, symbol, count(*) as row_count from ticks where epoch_s < 1705276800 and coalesce(price, last, (bid + ask) / 2.0) is not null group by all order by row_count desc, exchange_id, symbol limit 7")(lambda s, d: features.scope_pairs(ticks(s, d), 1705276800, 7))
query("f03_training_cutoff", "select max(epoch_s) + 1 as cutoff_s from ticks")(lambda s, d: features.training_cutoff(ticks(s, d)))
query("f04_merge_series", "select exchange_id, symbol, ts_us, arg_max(coalesce(price, last, (bid + ask) / 2.0), id) as price from ticks where epoch_s < 1705276800 group by all")(lambda s, d: features.merge_series(ticks(s, d), 1705276800))
query("f05_resample_last", f"select * from {_SERIES}")(_series)
query("f06_cleansed_series", "select exchange_id, symbol, bucket_epoch_s, price from valid where price > 0")(lambda s, d: features.cleansed_series(cleansed(s, d), RUN))
query("f07_infer_bin", "select bin_seconds from (select b - lag(b) over (order by b) as bin_seconds from (select distinct bucket_epoch_s as b from cleansed)) where bin_seconds > 0 group by bin_seconds order by count(*) desc, bin_seconds limit 1")(lambda s, d: features.infer_bin(cleansed(s, d), RUN))
query("f08_resolve_run", "select max(run_id) as run_id, min(bucket_epoch_s) as start_epoch_s from cleansed")(lambda s, d: features.resolve_run(cleansed(s, d)).crossJoin(features.run_start(cleansed(s, d), RUN)))
query("f09_calendar", f"select *, {', '.join(f'floor({f}(2.0 * pi() * {x} / {w}) * 1e8 + 0.5) / 1e8 as {n}' for n, f, x, w in (('tod_sin', 'sin', 'm', 1440.0), ('tod_cos', 'cos', 'm', 1440.0), ('dow_sin', 'sin', 'w', 7.0), ('dow_cos', 'cos', 'w', 7.0)))} from (select *, bucket_epoch_s % 86400 // 60 as m, (bucket_epoch_s // 86400 + 3) % 7 as w from {_SERIES})".replace("select *,", "select exchange_id, symbol, bucket_epoch_s, price,", 1))(lambda s, d: _nine(features.add_calendar(_series(s, d))))
query("f10_lags", f"select *, {_eight('lag_1 - lag_5')} as momentum_lag1_lag5, {_eight('lag_1 - lag_10')} as momentum_lag1_lag10 from (select {_KEY}, price, {', '.join(f'{_lag(k)} as lag_{k}' for k in features.LAGS)} from {_SERIES})")(
    lambda s, d: (lambda df: df.select(*[(F.floor(F.col(c) * 1e8 + 0.5) / 1e8).alias(c) if c.startswith("momentum") else F.col(c) for c in df.columns]))(features.add_lags(_series(s, d))))
query("f11_rolling", f"select {_KEY}, price, {', '.join(f'{_eight(_roll(f, n))} as roll_{t}_{n}' for n in features.WINDOWS for f, t in (('avg', 'mean'), ('stddev_samp', 'std')))} from {_SERIES}")(lambda s, d: _nine(features.add_rolling(_series(s, d))))
query("f12_sma", f"select {_KEY}, price, {', '.join(f'{_eight(_roll('avg', n))} as ta_sma_{n}' for n in features.WINDOWS)} from {_SERIES}")(lambda s, d: _nine(features.add_sma(_series(s, d))))
_RECURSE = f"with recursive s as (select exchange_id, symbol, bucket_epoch_s, price, row_number() {_OVER.format('')} as k from {_SERIES})"
query(
    "f13_ema",
    f"""{_RECURSE}, r as (select exchange_id, symbol, 11 as k, avg(price) as y from s where k <= 10 group by exchange_id, symbol union all select r.exchange_id, r.symbol, r.k + 1, r.y + 2.0 / 11 * (s.price - r.y) from r join s on s.exchange_id = r.exchange_id and s.symbol = r.symbol and s.k = r.k)
  select s.exchange_id, s.symbol, s.bucket_epoch_s, round(y, 5) as ta_ema_10 from s left join r using (exchange_id, symbol, k)""",
)(lambda s, d: features.add_ema(_series(s, d), 10).select("exchange_id", "symbol", "bucket_epoch_s", F.round("ta_ema_10", 5).alias("ta_ema_10")))
query(
    "f14_rsi",
    f"""{_RECURSE}, m as (select *, greatest(price - lag(price) {_OVER.format('')}, 0) as up, greatest(lag(price) {_OVER.format('')} - price, 0) as down from s),
  r as (select exchange_id, symbol, 16 as k, avg(up) as u, avg(down) as v from m where k between 2 and 15 group by exchange_id, symbol union all select r.exchange_id, r.symbol, r.k + 1, (13 * r.u + m.up) / 14, (13 * r.v + m.down) / 14 from r join m on m.exchange_id = r.exchange_id and m.symbol = r.symbol and m.k = r.k)
  select s.exchange_id, s.symbol, s.bucket_epoch_s, round(100.0 * u / (u + v), 5) as ta_rsi_14 from s left join r using (exchange_id, symbol, k)""",
)(lambda s, d: features.add_rsi(_series(s, d)).select("exchange_id", "symbol", "bucket_epoch_s", F.round("ta_rsi_14", 5).alias("ta_rsi_14")))
query("f15_roc", f"select {_KEY}, price, {_eight(f'100.0 * (({_lag(1)} - {_lag(11)}) / {_lag(11)})')} as ta_roc_10 from {_SERIES}")(lambda s, d: _nine(features.add_roc(_series(s, d))))
query("f16_bollinger", f"select {_KEY}, price, {_eight('m - 2 * s')} as ta_bbands_lower_20_2, {_eight('m')} as ta_bbands_middle_20_2, {_eight('m + 2 * s')} as ta_bbands_upper_20_2, {_eight('100.0 * (4 * s) / m')} as ta_bbands_bandwidth_20_2 from (select *, {_roll('avg', 20)} as m, {_roll('stddev_pop', 20)} as s from {_SERIES})")(lambda s, d: _nine(features.add_bbands(_series(s, d))))


def _framed(s: SparkSession, d: str) -> DataFrame:
    return features.training_frame(features.add_lags(_series(s, d)), 6)


_FRAME = f"(select * from (select {_KEY}, price, {_lag(1)} as lag_1, {_lag(30)} as lag_30, lead(price, 6) {_OVER.format('')} as target from {_SERIES}) where lag_30 is not null and target is not null)"
_SPLIT = f"(select *, k <= greatest(1, least(rows - 1, floor(rows * 0.8 + 1e-9))) as is_train from (select *, row_number() {_OVER.format('')} as k, count(*) over (partition by exchange_id, symbol) as rows from {_FRAME}))"
query("f17_training_frame", f"select {_KEY}, lag_30, target from {_FRAME}")(lambda s, d: _framed(s, d).select("exchange_id", "symbol", "bucket_epoch_s", "lag_30", "target"))
query("f18_max_training_rows", "select *, greatest(0, max_resampled_rows - 30 - 6) as max_trainable_rows from (select max(epoch_s) + 1 - min(epoch_s) as available_seconds, (max(epoch_s) + 1 - min(epoch_s)) // 3600 as max_resampled_rows, 30 as indicator_warmup_rows, 6 as max_horizon_steps from ticks)")(lambda s, d: features.max_training_rows(ticks(s, d), 3600, horizons=(1, 6)))
query("f19_holdout_split", f"select {_KEY}, is_train from {_SPLIT}")(lambda s, d: features.holdout_split(_framed(s, d)).select("exchange_id", "symbol", "bucket_epoch_s", "is_train"))
query("f20_cv_folds", f"select {_KEY}, cast(case when k <= n - 5 * (n // 6) then 0 else (k - (n - 5 * (n // 6)) - 1) // (n // 6) + 1 end as int) as fold from (select *, count(*) over (partition by exchange_id, symbol) as n from {_SPLIT} where is_train)")(lambda s, d: features.cv_folds(features.holdout_split(_framed(s, d))).select("exchange_id", "symbol", "bucket_epoch_s", "fold"))


@query("f21_ridge")
def f21_ridge(s: SparkSession, d: str) -> DataFrame:
    """Ridge fits of each pair, horizon and fold."""
    table, names = models.slots(_series(s, d), CONFIG)
    return models.fit_ridge(models.folded(table, CONFIG).where("is_train"), names, CONFIG.alpha)


_LEVELLED = f"(select exchange_id, symbol, lag_1 - level as x, target - level as y from (select *, avg(price) over (partition by exchange_id, symbol) as level from {_SPLIT}) where is_train)"


@query("f21b_ridge_of_one_feature", f"select exchange_id, symbol, round(w, 6) as coefficient, round(y - w * x, 6) as intercept, train_rows from (select exchange_id, symbol, covar_pop(x, y) / (var_pop(x) * (1 + 1.0 / count(*))) as w, avg(x) as x, avg(y) as y, count(*) as train_rows from {_LEVELLED} group by all)")
def f21b_ridge_of_one_feature(s: SparkSession, d: str) -> DataFrame:
    """The ridge fit of each pair on its last price alone, which SQL has a formula for."""
    split = features.holdout_split(_framed(s, d))
    rows = models.design(models.with_level(split), ["lag_1"]).where("is_train").select("exchange_id", "symbol", F.lit(6).alias("horizon_steps"), F.lit(0).alias("fold"), "x", "target", "level")
    return models.fit_ridge(rows, ["lag_1"], CONFIG.alpha).select("exchange_id", "symbol", F.round(F.col("coefficients")[0], 6).alias("coefficient"), F.round("intercept", 6).alias("intercept"), "train_rows")


@query("f22_gbt")
def f22_gbt(s: SparkSession, d: str) -> DataFrame:
    """The boosted trees of each pair and horizon, in full size, on the rows held out."""
    table, names = models.slots(_series(s, d), CONFIG)
    grown = models.train_trees(models.folded(table, CONFIG).withColumn("fold", F.lit(0)), names, CONFIG)
    return grown.where(trees.is_check()).select("exchange_id", "symbol", "horizon_steps", "bucket_epoch_s", "predicted_price", "actual")


def _naive(s: SparkSession, d: str) -> DataFrame:
    return _framed(s, d).select("exchange_id", "symbol", F.col("target").alias("actual"), F.col("price").alias("predicted_price"))


query("f23_regression_metrics", f"select exchange_id, symbol, round(avg(abs(target - price)), 6) as mae, round(sqrt(avg((target - price) * (target - price))), 6) as rmse, round(100.0 * avg(abs((target - price) / target)), 6) as mape, round(1.0 - sum((target - price) * (target - price)) / (var_pop(target) * count(*)), 6) as r2, count(*) as rows from {_FRAME} group by all")(
    lambda s, d: models.regression_metrics(_naive(s, d), ["exchange_id", "symbol"]).select("exchange_id", "symbol", *[F.round(m, 6).alias(m) for m in models.METRICS], "rows"))
_FRAMES = f"(select exchange_id, symbol, horizon_steps, count(*) - 30 - horizon_steps as rows from {_SERIES}, (select unnest([1, 6]) as horizon_steps) group by exchange_id, symbol, horizon_steps)"
_ARTIFACTS = f"""select 'train1' as training_run_id, exchange_id, symbol, model_name, horizon_steps, horizon_steps * 3600 as horizon_seconds, train_rows, rows - train_rows as test_rows, 5 as cv_fold_count, 1000 as started_us
  from (select *, cast(greatest(1, least(rows - 1, floor(rows * 0.8 + 1e-9))) as bigint) as train_rows from {_FRAMES} where rows >= 200), (select unnest(['ridge', 'gbt']) as model_name)"""


@query("f24_model_artifacts", _ARTIFACTS)
def f24_model_artifacts(s: SparkSession, d: str) -> DataFrame:
    """What a recorded training run offers to inference. Few rounds: f25 trains in full size."""
    path, small = scratch_path(s), replace(CONFIG, trees=replace(CONFIG.trees, rounds=10))
    ledger.train_run(ticks(s, d), small, path, "train1", 1000, finished_us=2000)
    return ledger.artifacts(s, path).select("training_run_id", "exchange_id", "symbol", "model_name", "horizon_steps", "horizon_seconds", "train_rows", "test_rows", "cv_fold_count", "started_us")


_STATED = "(select 'train' || (id % 40) as training_run_id, case when id % 11 = 0 then 'completed' when id % 13 = 0 then 'failed' else 'started' end as status, ts_us as recorded_us, id as models_trained from ticks where id % 7 = 0 or id % 11 = 0)"


@query("f24b_training_runs", f"select training_run_id, arg_max(status, (recorded_us, models_trained)) as status, arg_max(models_trained, (recorded_us, models_trained)) as models_trained, min(recorded_us) as started_us, case when arg_max(status, (recorded_us, models_trained)) <> 'started' then max(recorded_us) end as finished_us from {_STATED} group by all")
def f24b_training_runs(s: SparkSession, d: str) -> DataFrame:
    """The last state of each of many runs, appended in two parts."""
    return ledger.training_runs(s, _states(s, d)).select("training_run_id", "status", "models_trained", "started_us", "finished_us")


def _states(s: SparkSession, d: str) -> str:
    i, path = F.col("id"), scratch_path(s)
    rows = ticks(s, d).where("id % 7 = 0 or id % 11 = 0").select(F.concat(F.lit("train"), i % 40).alias("training_run_id"), F.when(i % 11 == 0, "completed").when(i % 13 == 0, "failed").otherwise("started").alias("status"), F.col("ts_us").alias("recorded_us"), i.alias("models_trained"))
    for part in (0, 1):
        ledger.append_states(rows.where(F.col("models_trained") % 2 == part), path)
    return path


query("f25_train_all")(lambda s, d: models.train_all(ticks(s, d), CONFIG)[2])
query("f26_inference_frame", f"select {_KEY}, lag_30, 21600 as horizon_seconds, bucket_epoch_s + 21600 as target_bucket_epoch_s from (select {_KEY}, {_lag(30)} as lag_30 from {_SERIES}) where lag_30 is not null")(
    lambda s, d: models.inference_frame(features.add_lags(_series(s, d)), 6 * 3600).select("exchange_id", "symbol", "bucket_epoch_s", "lag_30", "horizon_seconds", "target_bucket_epoch_s"))


@query("f27_score_forecasts")
def f27_score_forecasts(s: SparkSession, d: str) -> DataFrame:
    """Both models of each pair at six hours, fitted on ticks and scored on the cleansed series of the same pairs."""
    known = features.cleansed_series(cleansed(s, d), RUN)
    table, config = written(features.feature_table(known)), replace(CONFIG, horizons=(6,))
    trained, names = models.slots(_series(s, d), config)
    rows = written(models.folded(trained, config))
    frame, levels = models.inference_frame(table, 6 * 3600), trained.select(*features.PAIR, "level").distinct()
    ridge = models.score_forecasts(frame, models.fit_ridge(rows.where("is_train"), names, config.alpha), known, features.feature_names(table), levels, config)
    grown = models.train_trees(rows.withColumn("fold", F.lit(0)), names, config).where(~trees.is_check())
    boosted = models.score_tree_forecasts(frame, grown, known, features.feature_names(table), config)
    return ridge.withColumn("model_name", F.lit("ridge")).unionByName(boosted.withColumn("model_name", F.lit("gbt")))


_REGISTERED = "(select *, 'train' || (id % 3) as training_run_id, case when id % 4 = 0 then 'failed' else 'trained' end as status, 'ridge' as model_name, 3600 * (id % 2 + 1) as horizon_seconds, ts_us as created_utc from ticks)"


def _registered(s: SparkSession, d: str) -> DataFrame:
    i = F.col("id")
    return ticks(s, d).select("*", F.concat(F.lit("train"), i % 3).alias("training_run_id"), F.when(i % 4 == 0, "failed").otherwise("trained").alias("status"), F.lit("ridge").alias("model_name"), (3600 * (i % 2 + 1)).alias("horizon_seconds"), F.col("ts_us").alias("created_utc"))


query("f28_inference_tasks", f"select id, exchange_id, symbol from {_REGISTERED} where training_run_id = 'train1' and status = 'trained' and symbol like 'B%' and (exchange_id, symbol) in (select (exchange_id, symbol) from (select distinct exchange_id, symbol from {_REGISTERED} where training_run_id = 'train1' and status = 'trained' and symbol like 'B%' order by all limit 3))")(
    lambda s, d: models.inference_tasks(_registered(s, d), "train1", symbols="b%", limit_pairs=3).select("id", "exchange_id", "symbol"))
query("f28b_latest_training_run", f"select training_run_id from (select training_run_id, arg_max(status, (recorded_us, models_trained)) as status, min(recorded_us) as started_us from {_STATED} group by all) where status = 'completed' order by started_us desc, training_run_id desc limit 1")(
    lambda s, d: models.latest_training_run(ledger.training_runs(s, _states(s, d))))


@query("f29_replace_predictions", "select id, exchange_id, symbol, case when exchange_id = 'okx' then 2 else 1 end as version from ticks where exchange_id <> 'okx' or (id % 2 = 0 and symbol <> 'ADA/USDT')")
def f29_replace_predictions(s: SparkSession, d: str) -> DataFrame:
    """Predictions of all pairs, and then new ones of an exchange: of its pairs one has none, and loses those it had."""
    path = scratch_path(s)
    rows = lambda version: ticks(s, d).select("id", F.lit(version).alias("version"), F.lit("train1").alias("training_run_id"), F.lit(RUN).alias("cleansing_run_id"), "exchange_id", "symbol")
    models.replace_predictions(rows(1), path, "train1", RUN)
    models.replace_predictions(rows(2).where("id % 2 = 0 and symbol <> 'ADA/USDT'"), path, "train1", RUN, exchanges="OKX")
    return models.read_predictions(s, path, rows(1)).select("id", "exchange_id", "symbol", "version")


_METRICS = "avg(abs(y - p)) as mae, sqrt(avg((y - p) * (y - p))) as rmse, 100.0 * avg(case when abs(y) > 1e-9 then abs((y - p) / y) end) as mape, case when count(*) >= 2 and stddev_pop(y) > 1e-12 then 1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) end as r2"
_BACKTEST = f"""
with s as (select exchange_id, symbol, price, row_number() {_OVER.format('')} as r from {_SERIES}),
n as (select exchange_id, symbol, count(*) as rows, count(*) - least(greatest(6, cast(floor(count(*) * 0.2 + 1e-9) as bigint)), count(*) - 60) as start from s group by all),
o as (select exchange_id, symbol, rows, start, back, start - 6 * back as origin from n, (select unnest(range(0, 4)) as back) where rows >= 66 and rows - start >= 6 and (back = 0 or start - 6 * back >= 60)),
e as (select o.*, last.price as high, first.price as low, origin - greatest(1, origin - 511) as steps from o join s last on last.exchange_id = o.exchange_id and last.symbol = o.symbol and last.r = origin join s first on first.exchange_id = o.exchange_id and first.symbol = o.symbol and first.r = greatest(1, origin - 511)),
q as (select e.exchange_id, e.symbol, back, start, s.price as y, high + (high - low) / greatest(steps, 1) * (s.r - origin) as p from e join s on s.exchange_id = e.exchange_id and s.symbol = e.symbol and s.r between origin + 1 and origin + 6),
m as (select exchange_id, symbol, back, start, {_METRICS}, count(*) as rows from q group by all)
select n.exchange_id, n.symbol, n.rows as series_rows, coalesce(h.start, 0) as train_rows, coalesce(h.rows, 0) as test_rows, coalesce(c.k, 0) as cv_fold_count, case when h.rows > 0 then 'trained' else 'skipped' end as status,
  {', '.join(f'round(h.{x}, 6) as holdout_{x}, round(c.{x}, 6) as cv_mean_{x}' for x in models.METRICS)}
from n left join m h on h.exchange_id = n.exchange_id and h.symbol = n.symbol and h.back = 0
left join (select exchange_id, symbol, count(*) as k, {', '.join(f'avg({x}) as {x}' for x in models.METRICS)} from m where back > 0 group by all) c on c.exchange_id = n.exchange_id and c.symbol = n.symbol"""
query("f30_rolling_origin_backtest", _BACKTEST)(
    lambda s, d: (lambda df: df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]))(backtest.rolling_origin_backtest(_series(s, d), backtest.drift, BACKTEST)))
_FORECAST = f"""select k.exchange_id, k.symbol, k.bucket_epoch_s as generated_bucket_epoch_s, k.bucket_epoch_s + 21600 as target_bucket_epoch_s, k.price as predicted_price, a.price as actual_price, abs(a.price - k.price) as abs_error
  from (select *, row_number() {_OVER.format('')} as k from {_SERIES}) k left join {_SERIES} a on a.exchange_id = k.exchange_id and a.symbol = k.symbol and a.bucket_epoch_s = k.bucket_epoch_s + 21600 where k >= 60"""
query("f31_rolling_forecast", _FORECAST)(lambda s, d: backtest.rolling_forecast(_series(s, d), backtest.last_value, BACKTEST))
query("f31b_rolling_forecast_by_model", _FORECAST)(lambda s, d: backtest.rolling_forecast(_series(s, d), backtest.Batched("last", backtest.repeat_last), BACKTEST))


def _predictions(s: SparkSession, d: str) -> DataFrame:
    made = backtest.rolling_forecast(_series(s, d), backtest.last_value, BACKTEST)
    return made.select(F.lit("train1").alias("training_run_id"), F.lit(RUN).alias("cleansing_run_id"), F.lit("last_value").alias("model_name"), F.lit(21600).alias("horizon_seconds"), "*")


_SERVED = f"(select 'train1' as training_run_id, 'run1' as cleansing_run_id, 'last_value' as model_name, 21600 as horizon_seconds, * from ({_FORECAST}))"
query("e32_forecast_configs", f"select training_run_id, exchange_id, symbol, model_name, horizon_seconds, count(*) as prediction_count, count(actual_price) as actual_count, round(avg(abs_error), 6) as mean_abs_error, min(target_bucket_epoch_s) as min_target_bucket_epoch_s, max(target_bucket_epoch_s) as max_target_bucket_epoch_s from {_SERVED} where symbol = 'BTC/USDT' group by all")(
    lambda s, d: serving.forecast_configs(_predictions(s, d), RUN, "BTC/USDT"))
query("e33_forecast_series", f"select * from {_SERVED} where symbol = 'BTC/USDT' and exchange_id = 'okx'")(lambda s, d: serving.forecast_series(_predictions(s, d), {"cleansing_run_id": RUN, "symbol": "BTC/USDT", "exchange_id": "okx", "model_name": "last_value"}))
query("e34_registry_row", f"select id, training_run_id, exchange_id, symbol from {_REGISTERED} where symbol = 'BTC/USDT' and exchange_id = 'okx' and training_run_id = 'train1' and status = 'trained' order by created_utc desc limit 1")(
    lambda s, d: serving.registry_row(_registered(s, d), {"symbol": "BTC/USDT", "exchange_id": "okx", "training_run_id": "train1"}).select("id", "training_run_id", "exchange_id", "symbol"))
