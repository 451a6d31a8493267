from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickmart.operators import backtest, features, ledger, models, stretches, trees

HOUR = 3600


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(1)
    rows = [(x, "A/B", i * HOUR, float(p)) for x in ("u", "v") for i, p in enumerate(100 + np.cumsum(rng.normal(size=300)))]
    return spark.createDataFrame(rows, "exchange_id string, symbol string, bucket_epoch_s long, price double").cache()


def prices(series, x="u"):
    return [r["price"] for r in series.where(f"exchange_id = '{x}'").orderBy("bucket_epoch_s").collect()]


def column(df, name, x="u"):
    return [r[name] for r in df.where(f"exchange_id = '{x}'").orderBy("bucket_epoch_s").collect()]


def test_recurrences_equal_plain_loops(series):
    p, n = prices(series), 10
    want, y = [None] * len(p), None
    for i in range(n, len(p)):
        y = sum(p[:n]) / n if i == n else y + 2 / (n + 1) * (p[i - 1] - y)
        want[i] = y
    got = column(features.add_ema(series, n), "ta_ema_10")
    assert got[:n] == [None] * n and got[n:] == pytest.approx(want[n:], rel=1e-9)
    d = [b - a for a, b in zip(p, p[1:])]
    up, down = sum(max(x, 0) for x in d[:14]) / 14, sum(max(-x, 0) for x in d[:14]) / 14
    rsi = {15: 100 * up / (up + down)}
    for i in range(14, len(d)):
        up, down = (13 * up + max(d[i], 0)) / 14, (13 * down + max(-d[i], 0)) / 14
        rsi[i + 2] = 100 * up / (up + down)
    got = column(features.add_rsi(series), "ta_rsi_14")
    assert got[:15] == [None] * 15 and got[15:] == pytest.approx([rsi[i] for i in range(15, len(p))], rel=1e-9)


def test_ridge_equals_direct_solution(spark, series):
    config = models.Config(bin_seconds=HOUR, horizons=(1,), min_train_rows=50)
    table, names = models.slots(series, config)
    train = features.cv_folds(table, config.folds)
    fits = {(r["exchange_id"], r["fold"]): r for r in models.fit_ridge(train, names).collect()}
    assert {f for x, f in fits if x == "u"} == {0, 1, 2, 3, 4, 5}
    rows = train.where("exchange_id = 'u'").collect()
    for fold in (0, 3):
        own = [r for r in rows if not fold or r["fold"] < fold]
        x, y = np.array([r["x"] for r in own]), np.array([r["target"] - r["level"] for r in own])
        m, s = x.mean(0), x.std(0)
        z = (x - m) / s
        w = np.linalg.solve(z.T @ z + np.eye(len(names)), z.T @ (y - y.mean())) / s
        fit = fits["u", fold]
        want, got = y.mean() - w @ m + x @ w, fit["intercept"] + x @ np.array(fit["coefficients"])
        assert fit["train_rows"] == len(own) and np.abs(want - got).max() < 1e-4


def test_registry_marks_short_series(series):
    fits, grown, registry = models.train_series(series, models.Config(bin_seconds=HOUR, horizons=(1, 6), min_train_rows=10_000))
    assert fits.count() == grown.count() == 0 and registry.count() == 8
    assert {(r["status"], r["model_name"]) for r in registry.collect()} == {("skipped", "ridge"), ("skipped", "gbt")}


def test_both_models_of_every_slot_are_trained_and_measured(series):
    config = models.Config(bin_seconds=HOUR, horizons=(1, 6), min_train_rows=50, trees=trees.Params(rounds=20, depth=3))
    fits, grown, registry = models.train_series(series, config)
    rows = registry.collect()
    assert len(rows) == 8 and {(r["status"], r["cv_fold_count"]) for r in rows} == {("trained", 5)} and all(r["holdout_mae"] > 0 and r["test_rows"] > 40 for r in rows)
    assert models.model_artifacts(registry).count() == 8
    table, names = models.slots(series, config)
    frame = models.inference_frame(features.feature_table(series), HOUR)
    scored = models.score_tree_forecasts(frame, grown, series, names, config)
    known = {(r["exchange_id"], r["generated_bucket_epoch_s"]): r for r in scored.collect()}
    assert len(known) == frame.count() and all((r["abs_error"] is None) == (r["actual_price"] is None) for r in known.values())
    tested = table.where("not is_train and horizon_steps = 1").collect()
    mae = {x: np.mean([abs(known[x, r["bucket_epoch_s"]]["predicted_price"] - r["target"]) for r in tested if r["exchange_id"] == x]) for x in ("u", "v")}
    assert all(r["holdout_mae"] == pytest.approx(mae[r["exchange_id"]]) for r in rows if r["model_name"] == "gbt" and r["horizon_steps"] == 1)


def test_trees_fit_what_a_search_over_all_cuts_finds():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (80, 3)).astype(float)
    y = np.where(x[:, 1] > 5, 3.0, 0.0) + np.where(x[:, 2] > 7, 1.0, 0.0) + rng.normal(size=80) * 0.01
    params = trees.Params(rounds=1, rate=1.0, depth=1, min_leaf=5)
    base, feature, threshold, leaf = trees.grow(x, y, params)
    best = min(((((y[x[:, j] <= c] - y[x[:, j] <= c].mean()) ** 2).sum() + ((y[x[:, j] > c] - y[x[:, j] > c].mean()) ** 2).sum(), j, c) for j in range(3) for c in np.unique(x[:, j])[:-1] if min((x[:, j] <= c).sum(), (x[:, j] > c).sum()) >= 5))
    assert (feature[0, 0], threshold[0, 0]) == best[1:]
    got = trees.predict(x, base, feature, threshold, leaf)
    right = x[:, best[1]] > best[2]
    assert got[right] == pytest.approx(y[right].mean()) and got[~right] == pytest.approx(y[~right].mean())
    model = trees.grow(x, y, trees.Params(rounds=60, rate=0.3, depth=3, min_leaf=5))
    assert np.abs(trees.predict(x, *model) - y).max() < 0.1
    for row, want in zip(x[:10], trees.predict(x[:10], *model), strict=True):  # a walk row by row
        total = model[0]
        for f, c, v in zip(*model[1:], strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += v[node - len(f)]
        assert total == pytest.approx(want)


def test_a_slot_that_fails_is_recorded(spark, series):
    bad = series.where("exchange_id = 'u'").selectExpr("'bad' as exchange_id", "symbol", "bucket_epoch_s", "case when bucket_epoch_s = 3600 * 100 then 1e-320 else price end as price")
    config = models.Config(bin_seconds=HOUR, horizons=(1,), min_train_rows=50, trees=trees.Params(rounds=3, depth=2))
    registry = {(r["exchange_id"], r["model_name"]): r for r in models.train_series(series.unionByName(bad), config)[2].collect()}
    assert registry["bad", "gbt"]["status"] == "failed" and registry["bad", "gbt"]["error_message"].startswith("ValueError")
    assert registry["u", "gbt"]["status"] == registry["v", "ridge"]["status"] == "trained"


def test_backtest_of_last_value(series):
    config = backtest.Config(horizon_steps=5, horizon_seconds=5 * HOUR)
    p = prices(series)
    row = backtest.rolling_origin_backtest(series, backtest.last_value, config).where("exchange_id = 'u'").first()
    start = len(p) - math.floor(len(p) * 0.2)
    assert (row["train_rows"], row["test_rows"], row["cv_fold_count"], row["status"]) == (start, 5, 3, "trained")
    assert row["holdout_mae"] == pytest.approx(np.mean([abs(x - p[start - 1]) for x in p[start : start + 5]]))
    assert backtest.rolling_origin_backtest(series, backtest.drift, backtest.Config(min_context=500)).first()["status"] == "skipped"
    made = backtest.rolling_forecast(series, backtest.ema(3), config)
    assert made.where("exchange_id = 'u'").count() == len(p) - 59 and made.where("abs_error is null and exchange_id = 'u'").count() == 5


def straight_line():
    """A model in Python: the line through each context's ends."""
    return lambda contexts, steps: contexts[:, -1:] + (contexts[:, -1:] - contexts[:, :1]) / max(contexts.shape[1] - 1, 1) * np.arange(1, steps + 1)


def test_a_python_model_forecasts_as_columns_do(series, monkeypatch):
    config = backtest.Config(horizon_steps=5, horizon_seconds=5 * HOUR, max_context=70)
    model = backtest.Batched("line", straight_line, batch=16)
    rows = lambda forecaster: sorted((r["exchange_id"], r["generated_bucket_epoch_s"], round(r["predicted_price"], 9), r["actual_price"]) for r in backtest.rolling_forecast(series, forecaster, config).collect())
    want = rows(backtest.drift)
    p = prices(series)
    assert want[60][2] == pytest.approx(p[119] + (p[119] - p[50]) / 69 * 5) and rows(model) == want
    monkeypatch.setattr(backtest, "BLOCK", 80)  # several blocks, of which each needs rows of the one before
    assert rows(backtest.drift) == want
    a, b = (backtest.rolling_origin_backtest(series, f, config).orderBy("exchange_id").toPandas() for f in (backtest.drift, model))
    assert a.drop(columns=["holdout_r2", "cv_mean_r2"]).round(9).equals(b.drop(columns=["holdout_r2", "cv_mean_r2"]).round(9)) and (a["status"] == "trained").all()


def test_contexts_are_views_and_models_are_loaded_once():
    calls, made = [], []

    def load():
        made.append(1)

        def model(contexts, steps):
            calls.append((contexts.shape, contexts.base is not None))
            return contexts[:, -1:] + np.zeros((len(contexts), steps))

        return model

    one = backtest.Batched("counted", load, batch=4)
    got = one.forecast(np.arange(20.0), np.arange(1, 21), 6, 2)
    assert got[:, 1].tolist() == list(range(20)) and made == [1] and max(n for (_, n), _ in calls) == 6 and max(k for (k, _), _ in calls) == 4


def test_boosted_trees_are_registered_in_full_size():
    from tickmart.plans import forecast_queries

    p = forecast_queries.CONFIG.trees
    assert (p.rounds, p.rate, p.depth, p.leaves, p.min_leaf, p.bins) == (300, 0.05, 6, 31, 20, 255)


def test_a_slot_in_blocks_gets_the_trees_of_one_in_a_task(series):
    config = models.Config(bin_seconds=HOUR, horizons=(1,), min_train_rows=50, trees=trees.Params(rounds=11, depth=3, leaves=6, min_leaf=8, bins=31))
    table, names = models.slots(series, config)
    design = models.relative_design(models.folded(table, config), names)
    whole = trees.fit_slots(design, config.trees).toPandas()
    blocks = trees.fit_slots(design, replace(config.trees, task_rows=100, block_rows=40, wave=5)).toPandas()
    by = ["exchange_id", "fold", "bucket_epoch_s"]
    whole, blocks = (df.sort_values(by).reset_index(drop=True) for df in (whole, blocks))
    assert len(whole) == len(blocks) and blocks["error"].isna().all() and (whole[["train_rows", *by]].fillna(-1) == blocks[["train_rows", *by]].fillna(-1)).all().all()
    assert np.allclose(whole["predicted_price"], blocks["predicted_price"], rtol=1e-9, equal_nan=True)
    for a, b in zip(whole[whole["base"].notna()].itertuples(), blocks[blocks["base"].notna()].itertuples(), strict=True):
        assert list(a.feature) == list(b.feature) and np.allclose(a.threshold, b.threshold) and np.allclose(a.leaf, b.leaf)
    # more rows than a task takes: the oldest count, too, and nothing fails
    assert set(whole[whole["base"].notna()]["train_rows"]) == {215} and set(blocks["fold"]) == {0, 1, 2, 3, 4, 5}


def test_best_first_leaves_are_those_of_a_search():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = np.sin(3 * x[:, 0]) + (x[:, 1] > 0.4) * x[:, 2]
    params = trees.Params(rounds=1, rate=1.0, depth=5, leaves=6, min_leaf=10, bins=63)
    base, feature, threshold, leaf = trees.grow(x, y, params)
    own = [np.arange(len(y))]  # the leaves of a plain search: always split where the loss falls most
    loss = lambda at: ((y[at] - y[at].mean()) ** 2).sum()
    cuts = trees.edges_of(x, 63)
    while len(own) < 6:
        tries = [(loss(at) - loss(at[x[at, j] <= c]) - loss(at[x[at, j] > c]), k, j, c) for k, at in enumerate(own) for j in range(4) for c in cuts[j] if min((x[at, j] <= c).sum(), (x[at, j] > c).sum()) >= 10]
        _, k, j, c = max(tries)
        at = own.pop(k)
        own += [at[x[at, j] <= c], at[x[at, j] > c]]
    want = np.zeros(len(y))
    for at in own:
        want[at] = y[at].mean()
    assert trees.predict(x, base, feature, threshold, leaf) == pytest.approx(want)


def test_an_odd_slot_in_blocks_is_recorded(series):
    config = models.Config(bin_seconds=HOUR, horizons=(1,), min_train_rows=50, trees=trees.Params(rounds=2, depth=2, task_rows=100))
    bad = series.where("exchange_id = 'u'").selectExpr("'bad' as exchange_id", "symbol", "bucket_epoch_s", "case when bucket_epoch_s = 3600 * 100 then 1e-320 else price end as price")
    registry = {(r["exchange_id"], r["model_name"]): r for r in models.train_series(series.unionByName(bad), config)[2].collect()}
    assert registry["bad", "gbt"]["status"] == "failed" and registry["bad", "gbt"]["error_message"].startswith("ValueError")
    assert registry["u", "gbt"]["status"] == registry["v", "gbt"]["status"] == "trained"


def test_pairs_of_two_horizons_have_one_level(series):
    table, _ = models.slots(series, models.Config(bin_seconds=HOUR, horizons=(1, 6)))
    assert table.groupBy("exchange_id", "symbol", "horizon_steps", "bucket_epoch_s").count().where("count > 1").count() == 0
    assert table.select("exchange_id", "level").distinct().count() == 2


def test_runs_are_recorded_whatever_becomes_of_them(spark, series, tmp_path):
    path = str(tmp_path)
    assert ledger.training_runs(spark, path).count() == 0
    ticks = series.selectExpr("exchange_id", "symbol", "bucket_epoch_s as epoch_s", "bucket_epoch_s * 1000000 as ts_us", "bucket_epoch_s as id", "price", "price as last", "price as bid", "price as ask")
    config = models.Config(bin_seconds=HOUR, horizons=(1,), min_train_rows=50, trees=trees.Params(rounds=2, depth=2))
    state = ledger.train_run(ticks, config, path, "7", 100, finished_us=900).first()
    assert (state["status"], state["series_total"], state["series_trained"], state["models_trained"], state["started_us"], state["finished_us"]) == ("completed", 2, 2, 4, 100, 900)
    with pytest.raises(Exception, match="price"):
        ledger.train_run(ticks.drop("price"), config, path, "8", 200)
    ledger.append_states(spark.createDataFrame([("9", "started", 300)], "training_run_id string, status string, recorded_us long"), path)
    runs = {r["training_run_id"]: r for r in ledger.training_runs(spark, path).collect()}
    assert {k: r["status"] for k, r in runs.items()} == {"7": "completed", "8": "failed", "9": "started"} and "price" in runs["8"]["error_message"] and runs["9"]["finished_us"] is None
    assert models.latest_training_run(ledger.training_runs(spark, path)).first()[0] == "7" and models.latest_training_run(ledger.training_runs(spark, path), "9").count() == 1
    assert ledger.artifacts(spark, path).count() == 4 and {r["training_run_id"] for r in ledger.artifacts(spark, path).collect()} == {"7"}
    assert models.inference_tasks(ledger.registry(spark, path), "7", exchanges="U").count() == 2


def test_replacing_predictions_touches_its_scope_only(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "value long, training_run_id string, cleansing_run_id string, exchange_id string, symbol string"
    rows = lambda v, pairs, run="1": spark.createDataFrame([(v + i, run, "c", x, y) for x, y in pairs for i in range(3)], schema)
    every = [(x, y) for x in ("okx", "kraken") for y in ("BTC/USDT", "ETH/USDT", "a=b c")]
    models.replace_predictions(rows(0, every), path, "1", "c")
    models.replace_predictions(rows(0, every, "2"), path, "2", "c")
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "p").rglob("part-*")}
    before = files()
    models.replace_predictions(rows(10, [("okx", "BTC/USDT"), ("kraken", "BTC/USDT")]), path, "1", "c", exchanges="OKX", symbols="btc%, a=b c")
    got = sorted((r["training_run_id"], r["exchange_id"], r["symbol"], r["value"]) for r in models.read_predictions(spark, path, rows(0, every)).collect())
    gone = {("1", "okx", "BTC/USDT"), ("1", "okx", "a=b c")}  # one is replaced, the other has no new rows; kraken is out of scope
    assert got == sorted([(r, x, y, i) for r in "12" for x, y in every for i in range(3) if (r, x, y) not in gone] + [("1", "okx", "BTC/USDT", 10 + i) for i in range(3)])
    assert len(before.keys() & files().keys()) == len(before) - 2 and all(before[f] == t for f, t in files().items() if f in before)


def test_stretches_equal_plain_windows(spark):
    rng = np.random.default_rng(8)
    times = {k: sorted(rng.choice(400, 60, replace=False).tolist()) for k in "ab"} | {"c": [5], "d": [0, 399]}
    rows = spark.createDataFrame([(k, int(t), float(t) if t % 3 else None) for k, ts in times.items() for t in ts], "k string, t long, v double").repartition(3)
    numbered = stretches.numbered(rows, ["k"], "t", "row", "rows", stretch=37)
    assert {(r["k"], r["t"]): (r["row"], r["rows"]) for r in numbered.collect()} == {(k, t): (i, len(ts)) for k, ts in times.items() for i, t in enumerate(ts, 1)}
    near = stretches.windowed(numbered, ["k"], 3, 2, lambda df, over: df.select("*", F.lag("t", 3).over(over).alias("old"), F.lead("t", 2).over(over).alias("new")), row="row", block=7)
    at = lambda ts, i: ts[i] if 0 <= i < len(ts) else None
    assert {(r["k"], r["t"]): (r["old"], r["new"]) for r in near.collect()} == {(k, t): (at(ts, i - 3), at(ts, i + 2)) for k, ts in times.items() for i, t in enumerate(ts)}
    known = lambda ts: [t for t in ts if t % 3]
    got = {(r["k"], r["t"]): r["known"] for r in stretches.last_known(rows, ["k"], "v", "t", 37).collect()}
    assert got == {(k, t): max((float(x) for x in known(ts) if x <= t), default=None) for k, ts in times.items() for t in ts}
    got = {(r["k"], r["t"]): r["known"] for r in stretches.next_known(rows, ["k"], "v", "t", 37).collect()}
    assert got == {(k, t): min((float(x) for x in known(ts) if x > t), default=None) for k, ts in times.items() for t in ts}
    every = sorted({t for ts in times.values() for t in ts})
    assert sorted(r["gap"] for r in stretches.gaps(rows, "t", 37).collect()) == sorted(b - a for a, b in zip(every, every[1:]))
    scanned = {(r["k"], r["row"]): r["y"] for r in stretches.affine_scan(numbered, ["k"], "row", {"y": (0.9, F.col("t").cast("double"))}, chunk=2).collect()}
    for k, ts in times.items():
        y = 0.0
        for i, t in enumerate(ts, 1):
            y = 0.9 * y + t
            assert scanned[k, i] == pytest.approx(y)


def test_scans_of_many_levels_equal_a_loop(spark, monkeypatch):
    monkeypatch.setattr(stretches, "WIDTH", 3)
    rows = spark.range(500).select(F.lit("k").alias("k"), (F.col("id") + 1).alias("row"), F.sin("id").alias("b"))
    got = stretches.affine_scan(rows, ["k"], "row", {"y": (0.97, F.col("b")), "z": (0.5, F.lit(1.0))}, chunk=4).orderBy("row").collect()
    want, y = [], 0.0
    for i in range(500):
        y = 0.97 * y + math.sin(i)
        want.append(y)
    assert [r["y"] for r in got] == pytest.approx(want) and got[-1]["z"] == pytest.approx(2)


def test_no_window_sorts_a_whole_pair(series):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    table, windows = features.feature_table(series), []
    for df in (features.add_lags(series), features.add_rolling(series), features.add_bbands(series), features.add_rsi(series), features.training_frame(table, 6), features.holdout_split(table)):
        windows += [line for line in plan(df).splitlines() if "Window [" in line]
    assert len(windows) > 5 and all("_b#" in line or "_t#" in line or "c#" in line or "_rows#" in line for line in windows)
