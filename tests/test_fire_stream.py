"""The fire weather stream against one pass over the whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zephyrgrid.operators import fireweather as fw
from zephyrgrid.streaming import fire_season

NAMES = ("ffmc", "dmc", "dc", "isi", "bui", "fwi")


def _days(cells=(1, 5, 40), days=60):
    draw = np.random.default_rng(4)
    rows = []
    for cell in cells:
        for day in range(days):
            # Cold, warm, cold and warm again, so that a season ends and the next one overwinters; cell 40 stays cold.
            t = (14 if 8 < day % 30 < 24 else 0) + float(draw.normal(0, 1))
            rows.append((cell, 100 + day, 1 + day // 31, -20.0 + cell, 273.15 + (t if cell != 40 else -5.0), float(draw.uniform(20, 90)), float(draw.choice([0, 0, 0, 6])), 4.0))
    return rows


def _feed(spark, path, rows):
    spark.createDataFrame(rows, fire_season.WEATHER).coalesce(1).write.mode("append").parquet(path)


def _found(df):
    return {(r["cell"], r["ord"]): tuple(r[n] for n in ("always_on", *NAMES)) for r in df.select("cell", "ord", "always_on", *NAMES).collect()}


def _same(left, right):
    assert left.keys() == right.keys()
    for key, values in left.items():
        for a, b in zip(values, right[key]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), key


def test_stream_equals_batch_over_restarts_and_late_days(spark, tmp_path):
    rows = _days()
    batch = _found(fw.daily_fire_weather(spark.createDataFrame(rows, fire_season.WEATHER)))
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("incoming", "out", "checkpoint"))
    portions = [[r for r in rows if lo <= r[1] - 100 < hi] for lo, hi in ((0, 5), (5, 6), (6, 27), (27, 60))]
    for number, portion in enumerate(portions):
        _feed(spark, incoming, portion[::-1])
        if number == 1:  # yesterday once more, and a day long past
            _feed(spark, incoming, [(1, 105, 1, -19.0, 300.0, 10.0, 0.0, 50.0), (5, 101, 1, -15.0, 300.0, 10.0, 0.0, 50.0)])
        if number != 2:  # the third portion waits, so one start has to take two in their order
            fire_season.start(spark, incoming, out, checkpoint, files_per_batch=1).awaitTermination()
    written = spark.read.parquet(out)
    assert written.where("NOT on_time").count() == 2
    _same(_found(fire_season.settled(written)), batch)
    flags = {(k[0], v[0]) for k, v in batch.items()}
    assert flags == {(1, False), (5, False), (40, True)}


def test_a_stop_in_the_middle_changes_nothing(spark, tmp_path):
    rows = _days(cells=(3, 17), days=40)
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("incoming", "out", "checkpoint"))
    for lo in range(0, 40, 10):
        _feed(spark, incoming, [r for r in rows if lo <= r[1] - 100 < lo + 10])
    running = fire_season.start(spark, incoming, out, checkpoint, files_per_batch=1, trigger={"processingTime": "0 seconds"})
    while not running.recentProgress and running.isActive:
        running.awaitTermination(1)
    running.stop()
    fire_season.start(spark, incoming, out, checkpoint, files_per_batch=1).awaitTermination()
    _same(_found(fire_season.settled(spark.read.parquet(out))), _found(fw.daily_fire_weather(spark.createDataFrame(rows, fire_season.WEATHER))))


def test_history_in_front_changes_the_first_codes(spark):
    """Two years of one cell: going on from the first differs from a fresh start."""
    rows = [(1, day, 1 + (day % 365) // 31, 45.0, 295.0, 40.0, 0.0, 5.0) for day in range(730)]
    frame = spark.createDataFrame(rows, fire_season.WEATHER)
    first = F.col("ord") == 370
    joined = fw.daily_fire_weather(frame).where(first).first()["dc"]
    alone = fw.daily_fire_weather(frame.where("ord >= 365")).where(first).first()["dc"]
    assert joined > alone


def test_weather_terms_are_worked_out_once_a_portion(monkeypatch):
    """Days come in one portion or singly: same rows and state; a portion's weather is one call, whatever its days."""
    rows = pd.DataFrame(_days(cells=(1, 5, 14), days=60), columns=["cell", "ord", "month", "lat", "t", "rh", "rain", "wind"]).assign(t=lambda f: f["t"] - 273.15)
    rows = rows[(rows["cell"] != 5) | (rows["ord"] < 130)]
    calls, plain = [], fw.ffmc_weather
    monkeypatch.setattr(fw, "ffmc_weather", lambda *a: calls.append(1) or plain(*a))
    whole, cells, numbers = fire_season.tile_portion(rows, [], [])
    assert len(calls) == 1
    singly, state = [], ([], [])
    for day in sorted(rows["ord"].unique()):
        out, *state = fire_season.tile_portion(rows[rows["ord"] == day], *state)
        singly.append(out)
    assert state[0] == cells
    np.testing.assert_array_equal(state[1], numbers)
    pd.testing.assert_frame_equal(pd.concat(singly).sort_values(["cell", "ord"]).reset_index(drop=True), whole.reset_index(drop=True))


def test_settling_shuffles_counts_not_series(spark):
    written = spark.createDataFrame([], fire_season.WRITTEN)
    assert "Window" not in fire_season.settled(written)._jdf.queryExecution().optimizedPlan().toString()
