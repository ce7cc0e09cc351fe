"""Fire weather as a stateful stream: every arriving day moves the codes of its cells on by one day.

The state of a tile of cells holds, per cell, the three moisture codes with their
season (running or not, last autumn's drought code, winter rain, the last three
temperatures), the codes of a season that never ends, and the last day seen.  So a
stream that is fed in any portions, and restarted in between, gives what one pass
over the whole series gives.

A day not after the last one seen of its cell is late (or a repetition) and
changes nothing; it is passed on with ``on_time`` false.  Of several rows for one day in
a portion the first by its values counts.  Whether a cell ever has a season is
known only at the end of a series, so both kinds of codes are written and
`settled` picks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import fire, units
from ..operators import fireweather as fw

WEATHER = "cell bigint, ord bigint, month bigint, lat double, tas double, hurs double, pr double, wind double"
CODES = ("ffmc", "dmc", "dc")
WRITTEN = "cell bigint, ord bigint, wind double, on_time boolean, " + ", ".join(f"{c} double, {c}_always double" for c in CODES)
STATE = "cells array<bigint>, numbers array<double>"
# The numbers of one cell, in this order.
FIELDS = ("last_ord", "days", "running", "autumn", "winter", "t1", "t2", "t3", "ffmc", "dmc", "dc", "ffmc_always", "dmc_always", "dc_always")
FRESH = (-np.inf, 0.0, 0.0, np.nan, 0.0, np.nan, np.nan, np.nan, *(2 * (fw.START_FFMC, fw.START_DMC, fw.START_DC)))


def portion_codes(state: dict[str, np.ndarray], weather: dict[str, np.ndarray], lat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Move every cell on by its ``counts`` days; returns codes (3, days, 2, cells), in season and always, NaN outside the season.

    Cells come with the most days first, so those that have a further day are the
    first columns.  What depends on the weather alone is worked out for all days at once.
    """
    t, rain = weather["t"], weather["rain"]
    known = np.concatenate([np.stack([state["t3"], state["t2"], state["t1"]]), t])
    last = [known[i:i + len(t)] for i in range(fw.SEASON_DAYS)]
    warm, cold = (np.logical_and.reduce(test) for test in ([d > fw.SEASON_START_C for d in last], [d < fw.SEASON_END_C for d in last]))
    may = (state["days"] + np.arange(len(t))[:, None] >= fw.SEASON_DAYS) & ~cold
    terms = fw.code_weather(t, rain, weather["wind"], weather["rh"], weather["month"], lat)
    running, autumn, winter = state["running"] > 0, state["autumn"], state["winter"]
    codes = [np.stack([state[c], state[f"{c}_always"]]) for c in CODES]
    written = np.full((3, len(t), 2, lat.size), np.nan)
    for day in range(len(t)):
        cells = slice(0, int(np.searchsorted(-counts, -day, side="left")))
        was, before = running[cells], [c[:, cells] for c in codes]
        on = (was | warm[day, cells]) & may[day, cells]
        starting, stopping = on & ~was, was & ~on
        if starting.any():
            spring = np.where(np.isnan(autumn[cells]), fw.START_DC, fw.overwintered_dc(autumn[cells], winter[cells]))
            for code, fresh in zip(before, (fw.START_FFMC, fw.START_DMC, spring)):
                code[0] = np.where(starting, fresh, code[0])
            autumn[cells][starting] = np.nan
        if stopping.any():
            autumn[cells] = np.where(stopping, before[2][0], autumn[cells])
        fallen = rain[day, cells]
        winter[cells] = np.where(stopping, fallen, np.where(on, winter[cells], winter[cells] + fallen))
        running[cells] = on
        active = np.stack([on, np.ones_like(on)])
        for i, after in enumerate(fw.codes_after(terms, day, before, cells)):
            np.copyto(before[i], after, where=active)
            np.copyto(written[i, day][:, cells], after, where=active)
    columns = np.arange(lat.size)
    state.update(running=running.astype(float), days=state["days"] + counts,
                 t1=known[counts + 2, columns], t2=known[counts + 1, columns], t3=known[counts, columns])
    for name, code in zip(CODES, codes):
        state[name], state[f"{name}_always"] = code
    return written


def tile_portion(rows: pd.DataFrame, cells: list[int], numbers: list[float]) -> tuple[pd.DataFrame, list[int], list[float]]:
    """(rows as written, cells and numbers of the new state) for one tile's portion of the stream."""
    rows = rows.sort_values(["cell", "ord", "t", "rain", "wind", "rh"], kind="stable")
    names = np.union1d(np.array(cells, np.int64), rows["cell"].to_numpy(np.int64))
    table = np.tile(np.array(FRESH), (names.size, 1))
    table[np.searchsorted(names, cells)] = np.array(numbers, float).reshape(len(cells), len(FIELDS))
    column = np.searchsorted(names, rows["cell"].to_numpy(np.int64))
    late = (rows["ord"].to_numpy() <= table[column, FIELDS.index("last_ord")]) | rows.duplicated(["cell", "ord"]).to_numpy()
    fresh, column = rows[~late], column[~late]
    counts = np.bincount(column, minlength=names.size)
    by_days = np.argsort(-counts, kind="stable")
    state = {field: table[by_days, i] for i, field in enumerate(FIELDS)}
    at, counts = np.argsort(by_days)[column], counts[by_days]
    step = np.arange(len(fresh)) - np.searchsorted(column, column)
    shape = (int(counts.max(initial=0)), names.size)
    weather = {name: np.full(shape, np.nan) for name in ("t", "rain", "wind", "rh")}
    for name, grid in weather.items():
        grid[step, at] = fresh[name].to_numpy(float)
    weather["month"] = np.zeros(shape, int)
    weather["month"][step, at] = fresh["month"].to_numpy(int) - 1
    lat = np.zeros(names.size)
    lat[at] = fresh["lat"].to_numpy(float)
    with np.errstate(all="ignore"):
        codes = portion_codes(state, weather, lat, counts)
    np.maximum.at(state["last_ord"], at, fresh["ord"].to_numpy(float))
    written = {name: codes[i, step, kind, at] for i, c in enumerate(CODES) for kind, name in enumerate((c, f"{c}_always"))}
    out = pd.DataFrame({"cell": fresh["cell"], "ord": fresh["ord"], "wind": fresh["wind"], "on_time": True, **written})
    passed = pd.DataFrame({"cell": rows["cell"][late], "ord": rows["ord"][late], "wind": rows["wind"][late], "on_time": False, **dict.fromkeys(written, np.nan)})
    order = ["cell", "ord", "wind", "on_time", *[n for c in CODES for n in (c, f"{c}_always")]]
    whole = pd.concat([out, passed])[order] if len(passed) else out[order]
    table[by_days] = np.column_stack([state[f] for f in FIELDS])
    return whole, names.tolist(), table.ravel().tolist()


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    cells, numbers = state.get if state.exists else ([], [])
    out, cells, numbers = tile_portion(pd.concat(list(frames)), list(cells), list(numbers))
    state.update((cells, numbers))
    yield out


def start(spark: SparkSession, incoming: str, output: str, checkpoint: str, precipitation_unit: str = "mm d-1",
          tile_cells: int = 16, files_per_batch: int = 1000, trigger: dict | None = None) -> StreamingQuery:
    """Follow the Parquet files of ``incoming`` (columns of `WEATHER`) in the order of their arrival and write the codes to ``output``.

    By default the stream ends when all present files are in; started again on the
    same checkpoint it goes on where it was.
    """
    source = spark.readStream.schema(WEATHER).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    inputs = source.select(
        "cell", "ord", "month", "lat", F.expr(f"cell div {tile_cells}").alias("tile"),
        units.convert(F.col("tas"), "K", "degC").alias("t"), units.convert(F.col("pr"), precipitation_unit, "mm d-1").alias("rain"),
        units.convert(F.col("wind"), "m s-1", "km h-1").alias("wind"), F.col("hurs").alias("rh"))
    codes = inputs.groupBy("tile").applyInPandasWithState(_advance, WRITTEN, STATE, "append", GroupStateTimeout.NoTimeout)
    return (codes.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def settled(written: DataFrame) -> DataFrame:
    """The six daily indices from what the stream has written so far; cells without any season take the codes that always run."""
    real = {c: F.when(~F.isnan(c), F.col(c)) for name in CODES for c in (name, f"{name}_always")}
    days = written.where("on_time").withColumns(real)
    cells = days.groupBy("cell").agg((F.count(F.coalesce(*[F.col(c) for c in CODES])) == 0).alias("always_on"))
    days = days.join(cells, "cell")
    picked = days.select("cell", "ord", "always_on", "wind", *[F.when(F.col("always_on"), F.col(f"{c}_always")).otherwise(F.col(c)).alias(c) for c in CODES])
    indexed = picked.withColumn("isi", fire.initial_spread(F.col("ffmc"), F.col("wind"))).withColumn("bui", fire.buildup(F.col("dmc"), F.col("dc")))
    return indexed.withColumn("fwi", fire.fire_weather(F.col("isi"), F.col("bui"))).drop("wind")
