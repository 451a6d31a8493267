from __future__ import annotations

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tickmart.functions import filters
from tickmart.operators import manifest as partitions
from tickmart.operators import staging
from tickmart.sources.staging import read_vault, write_vault
from tickmart.streaming import keyindex, vault
from tickmart.streaming.vault import committed, compact, ingest_batch, manifest, start_ingest


def message(i, kind="tick", **over):
    e = {"event_id": str(i), "event_type": kind, "schema_version": "1", "exchange_id": " Binance", "symbol": "BTC/USDT", "symbol_norm": "btc/usdt", "asset_norm": "", "event_ts_ms": 1_700_000_000_000 + i, "ingestion_ts_ms": 1_700_000_000_500 + i, "dedup_key": f"k{i}", "payload": {"price": 1.5}}
    return json.dumps({k: v for k, v in (e | over).items() if v != "gone"})


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "stream_id long, event_json string")


def test_batches_are_idempotent_and_keys_last(spark, tmp_path):
    path = str(tmp_path / "vault")
    first = frame(spark, [message(1), message(1), message(2, "heartbeat"), message(3, dedup_key=" "), message(4, schema_version="gone"), "[]", None])
    for _ in range(2):  # a retry
        ingest_batch(first, 0, path)
    ingest_batch(frame(spark, [message(1), message(5)]), 1, path)
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    assert read("market_ticks").count() == 2 and read("connection_events").count() == 1
    assert {r["error_message"] for r in read("dead_letters").collect()} == {"dedup_key is empty", "missing required keys: schema_version", "event_json is not an object", "no event_json field"}
    assert committed(spark, path, "market_ticks", "symbol string").count() == 2
    ingest_batch(frame(spark, [message(7)]), 2, path)
    shutil.rmtree(f"{path}/commits/batch_id=2")  # as if the batch had stopped before its mark
    assert committed(spark, path, "market_ticks", "symbol string").count() == 2 and read("market_ticks").count() == 3
    (row,) = manifest(spark, path).collect()
    assert (row["partition_id"], row["row_count"]) == ("raw:binance:20231114_22", 3)


def test_stream_reads_what_is_available(spark, tmp_path):
    frame(spark, [message(i % 4) for i in range(12)]).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema("stream_id long, event_json string").parquet(str(tmp_path / "in"))
        start_ingest(stream, str(tmp_path / "vault")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "vault/market_ticks")).count() == 4


def test_a_late_batch_opens_few_key_files(spark, tmp_path):
    path = str(tmp_path / "vault")
    for b in range(3):
        ingest_batch(frame(spark, [message(1000 * b + i) for i in range(700)]), b, path)
    files = spark.read.parquet(f"{path}/keys").select("_metadata.file_path").distinct().count()
    assert files > 180
    opened = lambda texts: vault.key_history(spark, path, vault._hashed(spark.createDataFrame([(t,) for t in texts], "dedup_key string")), 3).select("_metadata.file_path").distinct().count()
    # keys of no batch touch all 64 buckets, and open next to nothing; two known ones open their two files
    assert opened([f"new{i}" for i in range(500)]) <= 0.03 * files
    assert 2 <= opened([f"new{i}" for i in range(100)] + ["k3", "k2003"]) <= 0.03 * files
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    few = vault.key_history(spark, path, vault._hashed(spark.createDataFrame([("k3",), ("k2003",)], "dedup_key string")), 3)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert " IN (" in plan[plan.index("PartitionFilters:") : plan.index("PushedFilters:")]  # folders are picked, not rows
    ingest_batch(frame(spark, [message(2005), message(3), message(9999), message(1699)]), 3, path)
    assert spark.read.parquet(f"{path}/market_ticks").where("batch_id = 3").count() == 1
    assert vault.key_history(spark, path, vault._hashed(spark.createDataFrame([("k1",)], "dedup_key string")), 0).count() == 0


def test_no_task_reads_all_messages_or_keys(spark, tmp_path):
    from tickmart.plans import forecast_queries as queries
    from tickmart.sources import adapters

    data = "/root/testdata/sf0.001"
    with pytest.MonkeyPatch.context() as m:
        m.setattr(queries, "_FILE_ROWS", 100, raising=False)
        m.setattr(queries, "scratch_path", lambda s: str(tmp_path / "stream"))
        path = queries._ingested(spark, data, 2)
    files = spark.read.parquet(str(tmp_path / "stream/in")).groupBy("_metadata.file_path").count().agg(F.max("count"), F.sum("count")).first()
    assert files[0] <= 200 and files[1] == adapters.envelopes(spark, data).count()
    assert spark.read.parquet(f"{path}/commits").select("batch_id").distinct().count() == 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest_batch(frame(spark, [message(i) for i in range(300)]), 0, str(tmp_path / "vault"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = spark.read.parquet(str(tmp_path / "vault/key_index"))
    assert index.agg(F.sum("n")).first()[0] == 300 and index.select("_metadata.file_path").distinct().count() > 1


def test_rows_of_a_batch_are_not_read_by_one_task(spark, tmp_path):
    path, schema = str(tmp_path / "vault"), "symbol string, layer string, exchange string, date string, hour string"
    plan = lambda: committed(spark, path, "market_ticks", schema)._jdf.queryExecution().executedPlan().toString()
    ingest_batch(frame(spark, [message(i) for i in range(5)]), 0, path)
    assert "SortMergeJoin" not in plan() and "hashpartitioning(batch_id" not in plan() and committed(spark, path, "market_ticks", schema).count() == 5
    compact(spark, path)
    assert "SortMergeJoin" not in plan() and committed(spark, path, "market_ticks", schema).count() == 5


def test_a_batch_parses_once_and_the_first_asks_no_history(spark, tmp_path, monkeypatch):
    path, seen, asked = str(tmp_path / "vault"), spark.sparkContext.accumulator(0), []
    parse, unseen = vault.parse_envelopes, vault._unseen

    def counted(messages):
        def rows(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        parsed = parse(messages)
        return parsed.mapInArrow(rows, parsed.schema)

    monkeypatch.setattr(vault, "parse_envelopes", counted)
    monkeypatch.setattr(vault, "_unseen", lambda events, path, n: asked.append(n) or unseen(events, path, n))
    first = frame(spark, [*[message(i) for i in range(20)], "[]", None, message(1)])
    ingest_batch(first, 0, path)
    assert seen.value == 23 and asked == []
    ingest_batch(first, 0, path)  # a retry finds what the first try has stored
    ingest_batch(frame(spark, [message(19), message(20), message(21, dedup_key="")]), 1, path)
    assert seen.value == 49 and asked == [0, 1]
    letters = spark.read.parquet(f"{path}/dead_letters").collect()
    assert sorted((r["batch_id"], r["source_message_id"], (r["event_json"] or "")[:2]) for r in letters) == [(0, "20", "[]"), (0, "21", ""), (1, "2", '{"')]
    assert committed(spark, path, "market_ticks", "symbol string").count() == 21


def test_filters_never_miss_a_key():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 5000):
        keys = rng.integers(0, 2**64, n, dtype=np.uint64)
        made = keyindex.bloom(keys)
        assert keyindex.may_hold(made, keys).all() and keyindex.may_hold(made, rng.integers(0, 2**64, 20_000, dtype=np.uint64)).mean() < 0.004


def test_hours_are_compacted_batch_by_batch(spark, tmp_path):
    path = str(tmp_path / "vault")
    schema = "symbol string, layer string, exchange string, date string, hour string"
    read = lambda: committed(spark, path, "market_ticks", schema).count()
    assert compact(spark, path) is None
    ingest_batch(frame(spark, [message(i) for i in range(5)]), 0, path)
    ingest_batch(frame(spark, [message(i) for i in range(3, 9)]), 1, path)
    assert read() == 9 and compact(spark, path) == 1 and read() == 9
    shutil.rmtree(f"{path}/market_ticks/batch_id=0")  # covered: what landed is not needed any more
    ingest_batch(frame(spark, [message(i) for i in (8, 20)]), 2, path)
    assert read() == 10
    shutil.rmtree(f"{path}/generations/gen=1")  # as if the generation had stopped before its mark
    assert read() == 5
    assert compact(spark, path) == 1 and compact(spark, path) is None and read() == 5
    assert {r["hour"] for r in spark.read.parquet(f"{path}/compacted/market_ticks").collect()} == {22}


def test_keyed_state_is_bounded_by_the_watermark(spark, tmp_path):
    hour = 3_600_000
    batches = [[message(i, event_ts_ms=1_700_000_000_000 + i) for i in (1, 2, 2, 3)], [message(3, event_ts_ms=1_700_000_000_003), message(4, event_ts_ms=1_700_000_000_000 + hour // 2)], [message(5, event_ts_ms=1_700_000_000_000 + 5 * hour)], [message(1, event_ts_ms=1_700_000_000_001), message(5, event_ts_ms=1_700_000_000_000 + 5 * hour), message(6, event_ts_ms=1_700_000_000_000 + 5 * hour)], ["[]", message(7, event_ts_ms=1_700_000_000_000 + 6 * hour)]]
    for i, b in enumerate(batches):
        frame(spark, b).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
        for f in (tmp_path / "in" / f"{i}").glob("part-*"):
            f.rename(tmp_path / f"{i}-{f.name}")
    shutil.rmtree(tmp_path / "in")
    (tmp_path / "in").mkdir()
    for i, f in enumerate(sorted(tmp_path.glob("?-part-*"))):
        f.rename(tmp_path / "in" / f.name)
        import os

        os.utime(tmp_path / "in" / f.name, (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema("stream_id long, event_json string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = vault.recent_events(stream).select("dedup_key").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    run.awaitTermination()
    # copies inside the watermark go, and so does the one that comes after it; no key is kept for ever
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["k1", "k2", "k3", "k4", "k5", "k6", "k7"]
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 5 and sizes[-1] <= 3 and "rocksdb" in str(run.recentProgress[-1]["stateOperators"][0]["customMetrics"]).lower()


def test_symbol_patterns_escape_and_case(spark):
    df = spark.createDataFrame([("BTC/USDT",), ("a_b",), ("axb",), ("ETH/USD",)], "symbol string")
    names = lambda spec: sorted(r[0] for r in filters.filter_symbols(df, spec).collect())
    assert names("btc/usdt, eth%") == ["BTC/USDT", "ETH/USD"] and names(r"a\_b") == ["a_b"] and len(names(None)) == 4


def test_exchange_defaults_and_lists(spark):
    df = spark.createDataFrame([("Binance",), ("bitmex",), ("okx",)], "exchange_id string")
    assert sorted(r[0] for r in filters.filter_exchanges(df).collect()) == ["Binance", "okx"]
    assert [r[0] for r in filters.filter_exchanges(df, "binance,okx", "OKX").collect()] == ["Binance"]


def test_number_criteria():
    ranges, refused = filters.number_ranges(">=2, <1, 5-3, 7, x, -4")
    assert ranges[0] == (2.0, float("inf")) and ranges[2:] == [(3.0, 5.0), (7.0, 7.0)] and 0.999 < ranges[1][1] < 1 and refused == ["x", "-4"]


def test_contains_is_plain_text(spark):
    df = spark.createDataFrame([("a.b",), ("axb",)], "c string")
    assert [r[0] for r in filters.contains_filter(df, "c", "A.B").collect()] == ["a.b"]


def test_no_query_collects_into_spark_time_zone(spark):
    from tickmart.functions.timing import hour_key

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert spark.range(1).select(hour_key(F.lit(3_600_000_000))).first()[0] == "1970-01-01T01:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_extract_reads_only_the_folders_of_its_window(spark, tmp_path):
    hours = [(i, 1_704_067_200 + 1800 * i, x, "BTC/USDT" if i % 3 else "ETH/USDT") for i in range(200) for x in ("okx", "kraken")]
    rows = spark.createDataFrame(hours, "id long, epoch_s long, exchange_id string, symbol string").withColumn("ts_us", F.col("epoch_s") * 1_000_000)
    placed = partitions.with_partition(rows)
    write_vault(placed, str(tmp_path / "vault"))
    vault = read_vault(spark, str(tmp_path / "vault"), placed.schema)
    start = 1_704_067_200 + 86_400 - 5400  # over midnight
    window = spark.createDataFrame([(start, start + 4 * 3600)], "start_s long, end_s long")
    got = staging.extract_ticks(vault, window, exchanges="OKX", symbols="btc/usdt")
    want = rows.where(f"exchange_id = 'okx' and symbol = 'BTC/USDT' and epoch_s between {start} and {start + 4 * 3600}")
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect()) and want.count() > 4
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = staging.extract_ticks(vault, window, exchanges="OKX", symbols="btc/usdt")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:") : plan.index("PushedFilters:")]
    assert all(c in filters for c in ("layer", "exchange", "date", "hour")) and "epoch_s" in plan[plan.index("PushedFilters:") :] and "NestedLoop" not in plan
    assert all(f"/layer=raw/exchange=okx/date={r['date']}/hour={r['hour']}/" in r["source_path"] for r in got.select("source_path", F.substring("source_partition_id", -11, 4).alias("y"), F.to_date(F.timestamp_seconds("epoch_s")).cast("string").alias("date"), F.date_format(F.timestamp_seconds("epoch_s"), "HH").alias("hour")).collect())
    files = vault.where("exchange = 'okx'").select("_metadata.file_path").distinct().count()
    assert got.select("source_path").distinct().count() <= 6 < files
    empty = spark.createDataFrame([(None, None)], "start_s long, end_s long")
    assert staging.extract_ticks(vault, empty).count() == 0 and staging.extract_events(vault, window, include=False).count() == 0


def test_floats_are_written_as_producers_do(spark):
    from tickmart.functions.keys import float_text

    values = [0.0, -0.0, 1e-7, 1.5e-5, 1e-4, 0.001, 0.1, 2e-3, 1.0, 123.45, 1e7, 12345678.9, 1e15, 1e16, 1.234e22, -2.5, 0.30000000000000004, 9007199254740991.0, float("nan"), float("inf"), float("-inf"), None]
    got = [r["t"] for r in spark.createDataFrame([(v,) for v in values], "v double").select(float_text(F.col("v")).alias("t")).collect()]
    assert got == [None if v is None else repr(v) for v in values]


def test_temporary_tables_go_and_results_stay(spark):
    from tickmart.sources import scratch

    with scratch.temporaries(spark) as made:
        first = scratch.written(spark.range(3))
        second = scratch.written(first.withColumn("x", F.col("id") + 1))
        gone, kept = made[0], made.pop()
    assert not scratch.exists(spark, gone) and scratch.exists(spark, kept) and second.count() == 3
