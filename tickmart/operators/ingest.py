"""Stream messages to ticks and connection events: parsing, validation, dead letters, deduplication, normalising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.filters import filter_symbols
from ..functions.timing import epoch_s

#: The keys that an event must have, and its kinds.
REQUIRED = ("event_id", "event_type", "schema_version", "exchange_id", "symbol", "symbol_norm", "asset_norm", "event_ts_ms", "ingestion_ts_ms", "dedup_key", "payload")
EVENT_TYPES = ("tick", "connection_event", "heartbeat")

_EVENT = "event_id string, event_type string, schema_version string, exchange_id string, symbol string, symbol_norm string, asset_norm string, event_ts_ms double, ingestion_ts_ms double, dedup_key string, payload string"
_PAYLOAD = "market_type string, price double, bid double, ask double, last double, open double, high double, low double, base_volume double, quote_volume double, exchange_ts_ms double, raw_json string, event_name string, details_json string"


def _text(c: Column | str) -> Column:
    """Trimmed text, empty for null."""
    return F.coalesce(F.trim(c), F.lit(""))


def parse_envelopes(messages: DataFrame) -> DataFrame:
    """messages (event_json, ...) with event, the parsed fields, and keys, the names present; both null for non-objects.

    Both come out of a generator, so that filters on them do not move below and parse again for each use.
    """
    once = F.explode(F.array(F.struct(F.json_object_keys("event_json").alias("keys"), F.from_json("event_json", _EVENT).alias("event"))))
    own = messages.drop("keys", "event")
    return own.select("*", once.alias("_parsed")).select(*own.columns, "_parsed.keys", F.when(F.col("_parsed.keys").isNotNull(), F.col("_parsed.event")).alias("event"))


def with_errors(parsed: DataFrame) -> DataFrame:
    """parsed with error_message: the first thing wrong with the event, or null."""
    missing = F.array_except(F.array(*map(F.lit, REQUIRED)), F.col("keys"))
    e = F.col("event")
    error = (
        F.when(F.col("event_json").isNull(), "no event_json field")
        .when(F.col("keys").isNull(), "event_json is not an object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing required keys: "), F.array_join(missing, ", ")))
        .when(~F.coalesce(e["event_type"].isin(*EVENT_TYPES), F.lit(False)), F.concat(F.lit("unsupported event_type="), F.coalesce(e["event_type"], F.lit("null"))))
        .when(F.json_object_keys(e["payload"]).isNull(), "payload is not an object")
        .when(_text(e["dedup_key"]) == "", "dedup_key is empty")
        .when(_text(e["exchange_id"]) == "", "exchange_id is empty")
    )
    return parsed.withColumn("error_message", error)


def flat_envelopes(parsed: DataFrame) -> DataFrame:
    """Messages with error_message and their fields as columns; event_json stays only where something is wrong, payload is text."""
    marked = with_errors(parsed)
    kept = [c for c in parsed.columns if c not in ("event", "keys", "event_json")]
    return marked.select(*kept, "error_message", F.when(F.col("error_message").isNotNull(), F.col("event_json")).alias("event_json"), "event.*")


def split_envelopes(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, failed) of flat_envelopes()."""
    return flat.where("error_message is null").drop("error_message", "event_json"), flat.where("error_message is not null")


def with_details(events: DataFrame) -> DataFrame:
    """events with details, the parsed payload."""
    return events.select("*", F.explode(F.array(F.from_json("payload", _PAYLOAD))).alias("details"))  # once, as in parse_envelopes()


def validate_envelopes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, failed): valid messages with their fields as columns and payload parsed, and the others with error_message."""
    marked = with_errors(parsed)
    kept = [c for c in parsed.columns if c not in ("event", "keys", "event_json")]
    events = marked.where("error_message is null").select(*kept, "event.*")
    return with_details(events), marked.where("error_message is not null").drop("event", "keys")


def dead_letters(failed: DataFrame, source_stream: str, message_id: str = "stream_id") -> DataFrame:
    return failed.select(F.current_timestamp().alias("failed_at_utc"), F.lit(source_stream).alias("source_stream"), F.col(message_id).cast("string").alias("source_message_id"), "error_message", "event_json")


def dedup_events(events: DataFrame, keys: DataFrame | None = None, order: str = "stream_id") -> DataFrame:
    """The first event of each dedup_key by order, without those whose key is in keys (dedup_key).

    An aggregation, not a window: copies of a key are merged before they are shuffled.
    """
    first = events.groupBy(F.trim("dedup_key").alias("_key")).agg(F.min_by(F.struct(*events.columns), F.col(order)).alias("_first"))
    if keys is not None:
        first = first.join(keys.select(F.col("dedup_key").alias("_key")), "_key", "left_anti")
    return first.select("_first.*")


def _common(ms: Column) -> list[Column]:
    us = F.floor(ms).cast("long") * 1000
    name = lambda c, d: F.lower(F.coalesce(F.nullif(_text(c), F.lit("")), d))
    symbol = _text("symbol")
    return [
        us.alias("ts_us"), epoch_s(us).alias("epoch_s"), _text("exchange_id").alias("exchange_id"), F.lower(_text("exchange_id")).alias("exchange_id_norm"), symbol.alias("symbol"),
        name("symbol_norm", symbol).alias("symbol_norm"), name("asset_norm", F.trim(F.split_part("symbol", F.lit("/"), F.lit(1)))).alias("asset_norm")]


def to_market_ticks(events: DataFrame) -> DataFrame:
    """Ticks of valid events; the raw text is the payload itself where the payload has none."""
    d = F.col("details")
    return events.where("event_type = 'tick'").select(
        *_common(F.coalesce("ingestion_ts_ms", F.unix_millis(F.current_timestamp()))), _text(d["market_type"]).alias("market_type"), *[d[c].alias(c) for c in ("price", "bid", "ask", "last", "open", "high", "low", "base_volume", "quote_volume")],
        (F.floor(d["exchange_ts_ms"]).cast("long") * 1000).alias("exch_us"), _text(F.coalesce(F.nullif(d["raw_json"], F.lit("")), "payload")).alias("raw_json"))


def to_connection_events(events: DataFrame) -> DataFrame:
    """Connection events and heartbeats; the name falls back to the event's type, the details to the payload."""
    d = F.col("details")
    return events.where("event_type in ('connection_event', 'heartbeat')").select(
        *_common(F.coalesce("event_ts_ms", F.unix_millis(F.current_timestamp()))), _text(F.coalesce(F.nullif(d["event_name"], F.lit("")), "event_type")).alias("event_type"), _text(F.coalesce(F.nullif(d["details_json"], F.lit("")), "payload")).alias("details_json"))


def explode_tickers(rows: DataFrame, column: str = "payload") -> DataFrame:
    """One row for each ticker with a symbol in a JSON text: a ticker, an object of tickers, or a list of them."""
    as_map, as_list = F.from_json(F.col(column), "map<string,string>"), F.from_json(F.col(column), "array<string>")
    keys = F.json_object_keys(column)
    tickers = F.when(F.array_contains(keys, "symbol"), F.array(F.col(column))).when(keys.isNotNull(), F.map_values(as_map)).otherwise(as_list)
    return rows.withColumn("ticker", F.explode(tickers)).where(F.coalesce(F.get_json_object("ticker", "$.symbol"), F.lit("")) != "")


def tickers_to_ticks(tickers: DataFrame) -> DataFrame:
    """Ticks of (exchange_id, ingestion_us, ticker as JSON): the price is last, else close. Rows without keys or time go."""
    t = F.from_json("ticker", "symbol string, timestamp double, type string, close double, last double, bid double, ask double, open double, high double, low double, baseVolume double, quoteVolume double")
    rows = tickers.withColumn("t", t).where((_text("exchange_id") != "") & (_text(F.col("t.symbol")) != "") & F.col("ingestion_us").isNotNull())
    return rows.select(
        F.col("ingestion_us").alias("ts_us"), epoch_s(F.col("ingestion_us")).alias("epoch_s"), _text("exchange_id").alias("exchange_id"), F.lower(_text("exchange_id")).alias("exchange_id_norm"), _text(F.col("t.symbol")).alias("symbol"), F.lower(_text(F.col("t.symbol"))).alias("symbol_norm"),
        F.lower(F.trim(F.split_part("t.symbol", F.lit("/"), F.lit(1)))).alias("asset_norm"), F.col("t.type").alias("market_type"), F.coalesce("t.last", "t.close").alias("price"), *[F.col(f"t.{c}").alias(c) for c in ("bid", "ask", "last", "open", "high", "low")],
        F.col("t.baseVolume").alias("base_volume"), F.col("t.quoteVolume").alias("quote_volume"), (F.floor("t.timestamp").cast("long") * 1000).alias("exch_us"), F.col("ticker").alias("raw_json"))


def feed_load_profile(ticks: DataFrame, events: DataFrame, window_s: float) -> DataFrame:
    """Load of each exchange over a window: ticks and bytes a second, reconnects a minute, and a score of at least 1."""
    load = ticks.groupBy("exchange_id").agg(F.count("*").alias("ticks"), F.sum(F.length("raw_json")).alias("bytes_total"))
    again = events.where("event_type = 'reconnected'").groupBy("exchange_id").agg(F.count("*").alias("reconnects"))
    wide = load.join(again, "exchange_id", "full_outer").fillna(0)
    per_minute = F.col("reconnects") / (window_s / 60.0)
    rates = wide.select("*", (F.col("ticks") / window_s).alias("ticks_per_sec"), (F.col("bytes_total") / window_s).alias("bytes_per_sec"), per_minute.alias("reconnects_per_min"))
    return rates.withColumn("score", F.greatest(F.lit(1.0), F.col("bytes_per_sec") + 2000.0 * F.col("reconnects_per_min")))


def select_symbols(markets: DataFrame, only_spot: bool = False, symbols: str | None = None, most: int | None = None) -> DataFrame:
    """(exchange_id, symbol) of markets (exchange_id, symbol, active, spot) that are not inactive; the first `most` by name.

    The window over an exchange's symbols holds distinct names only.
    """
    rows = markets.where(F.coalesce("active", F.lit(True)))
    if only_spot:
        rows = rows.where(F.coalesce("spot", F.lit(False)))
    names = filter_symbols(rows, symbols).select("exchange_id", "symbol").distinct()
    if not most or most < 0:
        return names
    return names.withColumn("place", F.row_number().over(W.partitionBy("exchange_id").orderBy("symbol"))).where(F.col("place") <= most).drop("place")
