"""Chunked array stores (Zarr format 2) as a Spark data source, read and written chunk by chunk.

Reading plans one task per block of days and band of latitudes, as the store's
chunks cut them; filters on day, latitude and longitude drop whole tasks before anything
is opened, and narrow the rest.  Writing gives every chunk to one task.  Files go to a
staging folder; the metadata is written last and one rename makes the store visible,
so a job that fails leaves nothing that could be read.

Chunks may be raw or compressed with zlib or gzip; packed integers (scale_factor,
add_offset, _FillValue) are unpacked; missing chunks and fill values are NULL.  Any file
system that Arrow reaches will do; on a cluster the path must be one all executors see.
"""

from __future__ import annotations

import gzip
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage)

from ..functions.calendar import DAYS_BEFORE_MONTH
from ..operators.packing import CODE_LIMIT, FILL
from ..operators.regrid import Axis
from .stores import parse_chunks

FORMAT = "grid_array"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ROWS_AT_ONCE = 1 << 16
LEVEL = 4
_CALENDARS = {"noleap": 365, "365_day": 365, "360_day": 360, "standard": 0, "gregorian": 0, "proleptic_gregorian": 0}


def _place(path: str):
    """(file system, path on it)."""
    from pyarrow import fs

    if re.match(r"[a-z0-9]+://|file:", path):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path)
    return fs.LocalFileSystem(), path


def _bytes(system, path: str) -> bytes | None:
    from pyarrow import fs

    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with system.open_input_file(path) as file:
        return file.read()


@dataclass
class Variable:
    """The metadata of one array and the way to its chunks."""

    system: object
    path: str
    shape: tuple[int, ...]
    chunks: tuple[int, ...]
    meta: dict
    attributes: dict

    @classmethod
    def of(cls, store: str, name: str) -> "Variable":
        system, root = _place(store)
        found = _bytes(system, f"{root}/{name}/.zarray")
        if found is None:
            raise FileNotFoundError(f"{store} has no array {name!r}")
        meta = json.loads(found)
        if meta["filters"] or (meta["compressor"] or {"id": "zlib"})["id"] not in ("zlib", "gzip"):
            raise ValueError(f"{name}: only raw, zlib and gzip chunks without filters are read, not {meta['compressor']} {meta['filters']}")
        attributes = json.loads(_bytes(system, f"{root}/{name}/.zattrs") or b"{}")
        return cls(system, f"{root}/{name}", tuple(meta["shape"]), tuple(meta["chunks"]), meta, attributes)

    def chunk(self, *at: int) -> np.ndarray | None:
        """One whole chunk as stored, or None where there is none."""
        raw = _bytes(self.system, f"{self.path}/{self.meta.get('dimension_separator', '.').join(map(str, at))}")
        if raw is None:
            return None
        if self.meta["compressor"]:
            raw = (zlib if self.meta["compressor"]["id"] == "zlib" else gzip).decompress(raw)
        return np.frombuffer(raw, np.dtype(self.meta["dtype"])).reshape(self.chunks, order=self.meta["order"])

    def values(self, stored: np.ndarray | None, shape: tuple[int, ...]) -> np.ndarray:
        """Real values of a stored block; NaN where it is missing."""
        if stored is None:
            fill = self.meta["fill_value"]
            if fill is None or self.attributes.get("_FillValue", fill) == fill:
                return np.full(shape, np.nan)
            stored = np.full(shape, fill, np.dtype(self.meta["dtype"]))
        real = stored.astype(np.float64)
        for name in ("_FillValue", "missing_value"):
            if isinstance(self.attributes.get(name), (int, float)):
                real[stored == self.attributes[name]] = np.nan
        return real * self.attributes.get("scale_factor", 1.0) + self.attributes.get("add_offset", 0.0)

    def line(self) -> np.ndarray:
        """All values of a one-dimensional array."""
        size = self.chunks[0]
        parts = [self.values(self.chunk(k), (size,)) for k in range(-(-self.shape[0] // size))]
        return np.concatenate(parts)[:self.shape[0]] if parts else np.zeros(0)


def days_of(time: Variable) -> dict[str, np.ndarray]:
    """year, month, day and ord of a time axis in days; ord is NULL (-1 << 62) on leap days and in other calendars."""
    found = re.match(r"\s*(days|hours) since (-?\d+)-(\d+)-(\d+)", time.attributes.get("units", ""))
    calendar = time.attributes.get("calendar", "standard")
    if not found or calendar not in _CALENDARS:
        raise ValueError(f"time axis in {time.attributes.get('units')!r}, calendar {calendar!r}")
    number = np.floor(time.line() / (24 if found[1] == "hours" else 1)).astype(np.int64)
    year, month, day = int(found[2]), int(found[3]), int(found[4])
    starts = np.array(DAYS_BEFORE_MONTH)
    none = np.full(len(number), -1 << 62, np.int64)
    if _CALENDARS[calendar] == 365:
        count = year * 365 + starts[month - 1] + day - 1 + number
        years, rest = count // 365, count % 365
        months = np.searchsorted(starts, rest, side="right")
        return {"year": years, "month": months, "day": rest - starts[months - 1] + 1, "ord": count - 1970 * 365}
    if _CALENDARS[calendar] == 360:
        count = year * 360 + (month - 1) * 30 + day - 1 + number
        return {"year": count // 360, "month": count % 360 // 30 + 1, "day": count % 30 + 1, "ord": none}
    dates = np.datetime64(f"{year:04d}-{month:02d}-{day:02d}", "D") + number
    months = dates.astype("datetime64[M]")
    years = dates.astype("datetime64[Y]").astype(np.int64) + 1970
    within = months.astype(np.int64) % 12
    numbers = (dates - months).astype(np.int64) + 1
    ords = (years - 1970) * 365 + starts[within] + numbers - 1
    return {"year": years, "month": within + 1, "day": numbers, "ord": np.where((within == 1) & (numbers == 29), none, ords)}


@dataclass
class Block(InputPartition):
    """Chunk numbers of days and latitudes, and the index ranges wanted of them."""

    days: int
    rows: int
    day_range: tuple[int, int]
    row_range: tuple[int, int]


def _meets(filter_: Filter, axes: dict[str, np.ndarray]) -> np.ndarray | None:
    """Which positions of an axis can meet a filter; None if it is about something else."""
    name = filter_.attribute[0] if getattr(filter_, "attribute", None) else None
    if name not in axes:
        return None
    axis = axes[name]
    match filter_:
        case EqualTo(value=v):
            return axis == v
        case GreaterThan(value=v):
            return axis > v
        case GreaterThanOrEqual(value=v):
            return axis >= v
        case LessThan(value=v):
            return axis < v
        case LessThanOrEqual(value=v):
            return axis <= v
        case In(value=v):
            return np.isin(axis, v)
    return None


class GridReader(DataSourceReader):
    def __init__(self, path: str, variable: str):
        self.array, self.name = Variable.of(path, variable), variable
        if list(self.array.attributes.get("_ARRAY_DIMENSIONS", ())) != ["time", "lat", "lon"]:
            raise ValueError(f"{variable}: dimensions must be time, lat, lon")
        self.days = days_of(Variable.of(path, "time"))
        lat, lon = (Variable.of(path, n).line() for n in ("lat", "lon"))
        self.rows = {"fi": np.arange(len(lat)), "lat": lat}
        self.columns = {"fj": np.arange(len(lon)), "lon": lon}
        self.keep = [np.ones(n, bool) for n in self.array.shape]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for filter_ in filters:
            for side, axes in enumerate((self.days, self.rows, self.columns)):
                met = _meets(filter_, axes)
                if met is not None:
                    self.keep[side] &= met
            yield filter_  # Spark tests the rows that are left

    def _ranges(self, side: int) -> dict[int, tuple[int, int]]:
        """Per chunk along one axis the first and last position wanted (end exclusive)."""
        found = {}
        size = self.array.chunks[side]
        for number in range(-(-self.array.shape[side] // size)):
            wanted = np.flatnonzero(self.keep[side][number * size:(number + 1) * size])
            if len(wanted):
                found[number] = (number * size + int(wanted[0]), number * size + int(wanted[-1]) + 1)
        return found

    def partitions(self) -> list[Block]:
        if not self.keep[2].any():
            return []
        return [Block(d, r, days, rows) for d, days in self._ranges(0).items() for r, rows in self._ranges(1).items()]

    def read(self, block: Block | None) -> Iterator[pa.RecordBatch]:
        if block is None:  # what Spark asks for where nothing is left to read
            return
        sizes = self.array.chunks
        for number, (c0, c1) in self._ranges(2).items():
            stored = self.array.chunk(block.days, block.rows, number)
            (d0, d1), (r0, r1) = block.day_range, block.row_range
            inside = tuple(slice(lo - at * size, hi - at * size) for (lo, hi), at, size in zip(
                (block.day_range, block.row_range, (c0, c1)), (block.days, block.rows, number), sizes))
            shape = (d1 - d0, r1 - r0, c1 - c0)
            values = self.array.values(None if stored is None else stored[inside], shape)
            at_once = max(1, ROWS_AT_ONCE // (shape[1] * shape[2]))
            row, column = (x.ravel() for x in np.meshgrid(np.arange(r0, r1), np.arange(c0, c1), indexing="ij"))
            for start in range(0, shape[0], at_once):
                part = values[start:start + at_once]
                day = np.repeat(np.arange(d0 + start, d0 + start + len(part)), len(row))
                rows, columns = np.tile(row, len(part)), np.tile(column, len(part))
                flat = part.ravel()
                ords = self.days["ord"][day]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ords, mask=ords == -1 << 62), *[pa.array(self.days[n][day].astype(np.int64)) for n in ("year", "month", "day")],
                     pa.array(rows), pa.array(columns), pa.array(self.rows["lat"][rows]), pa.array(self.columns["lon"][columns]),
                     pa.array(flat, mask=np.isnan(flat))], names=["ord", "year", "month", "day", "fi", "fj", "lat", "lon", self.name])


@dataclass
class Written(WriterCommitMessage):
    chunks: list[int]


class GridWriter(DataSourceArrowWriter):
    """Writes rows (chunk, ord, fi, fj, value) that come ordered by chunk."""

    def __init__(self, options: dict, overwrite: bool):
        self.plan = json.loads(options["plan"])
        self.overwrite = overwrite
        self.staging = f"{self.plan['path']}.staging-{uuid.uuid4().hex}"

    def _shape(self) -> tuple[tuple[int, ...], tuple[int, ...]]:
        return tuple(self.plan["shape"]), tuple(self.plan["chunks"])

    def _save(self, number: int, parts: list[tuple[np.ndarray, ...]]) -> None:
        shape, sizes = self._shape()
        across = [-(-n // c) for n, c in zip(shape, sizes)]
        at = (number // (across[1] * across[2]), number // across[2] % across[1], number % across[2])
        day, row, column, value = (np.concatenate(x) for x in zip(*parts))
        place = np.ravel_multi_index((day - self.plan["first"] - at[0] * sizes[0], row - at[1] * sizes[1], column - at[2] * sizes[2]), sizes)
        if len(np.unique(place)) < len(place):
            raise ValueError(f"chunk {at} holds a cell and day twice")
        if self.plan["packing"]:
            scale, offset = self.plan["packing"]
            missing = np.isnan(value)
            code = np.rint((value - offset) / scale)
            if (np.abs(code[~missing]) > CODE_LIMIT).any():
                raise ValueError(f"chunk {at}: a value does not fit the packing range")
            stored = np.full(int(np.prod(sizes)), FILL, "<i2")
            stored[place] = np.where(missing, FILL, code).astype("<i2")
        else:
            stored = np.full(int(np.prod(sizes)), np.nan, "<f4")
            stored[place] = value
        system, root = _place(self.staging)
        folder = f"{root}/{self.plan['variable']}"
        system.create_dir(folder, recursive=True)
        # Another attempt at this task would write the same bytes; the rename lets one of them win whole.
        own = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(own) as file:
            file.write(zlib.compress(stored.tobytes(), LEVEL))
        system.move(own, f"{folder}/{'.'.join(map(str, at))}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        done: list[int] = []
        number, parts = None, []
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("ord", "fi", "fj", "value")]
            edges = np.flatnonzero(np.diff(chunk)) + 1
            for start, stop in zip([0, *edges], [*edges, len(chunk)]):
                if start < stop and chunk[start] != number:
                    if number is not None:
                        self._save(number, parts)
                        done.append(number)
                    number, parts = int(chunk[start]), []
                parts.append(tuple(c[start:stop] for c in columns))
        if number is not None:
            self._save(number, parts)
            done.append(number)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        chunks = [c for m in messages if m for c in m.chunks]
        if len(set(chunks)) < len(chunks):
            raise ValueError("a chunk was written by two tasks")
        system, root = _place(self.staging)
        plan = self.plan
        system.create_dir(root, recursive=True)
        arrays = {plan["variable"]: None, "time": np.arange(plan["first"], plan["first"] + plan["shape"][0], dtype="<f8"),
                  "lat": np.array(plan["lat"], "<f8"), "lon": np.array(plan["lon"], "<f8")}
        metadata = {".zgroup": {"zarr_format": 2}}
        for name, line in arrays.items():
            packed = line is None and plan["packing"]
            attributes = {"_ARRAY_DIMENSIONS": ["time", "lat", "lon"] if line is None else [name], **({
                "time": {"units": "days since 1970-01-01", "calendar": "noleap"}, "lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}
            }.get(name) or {"units": plan["units"]})}
            if packed:
                attributes |= {"scale_factor": packed[0], "add_offset": packed[1], "_FillValue": FILL}
            metadata[f"{name}/.zattrs"] = attributes
            metadata[f"{name}/.zarray"] = {
                "zarr_format": 2, "shape": plan["shape"] if line is None else [len(line)], "chunks": plan["chunks"] if line is None else [max(1, len(line))],
                "dtype": "<f8" if line is not None else "<i2" if packed else "<f4", "compressor": {"id": "zlib", "level": LEVEL} if line is None else None,
                "fill_value": FILL if packed else "NaN" if line is None else None, "order": "C", "filters": None}
            system.create_dir(f"{root}/{name}", recursive=True)
            if line is not None:
                with system.open_output_stream(f"{root}/{name}/0") as file:
                    file.write(line.tobytes())
        for name, value in {**metadata, ".zmetadata": {"zarr_consolidated_format": 1, "metadata": metadata}}.items():
            with system.open_output_stream(f"{root}/{name}") as file:
                file.write(json.dumps(value, indent=1).encode())
        _, target = _place(plan["path"])
        old = system.get_file_info(target).type != fs.FileType.NotFound
        if old and not self.overwrite:
            raise FileExistsError(plan["path"])
        if old:
            system.move(target, f"{root}.replaced")
        system.move(root, target)
        if old:
            system.delete_dir(f"{root}.replaced")

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = _place(self.staging)
        if system.get_file_info(root).type != fs.FileType.NotFound:
            system.delete_dir(root)


class GridArrays(DataSource):
    """``format("grid_array")`` with the options path and variable."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"ord bigint, year bigint, month bigint, day bigint, fi bigint, fj bigint, lat double, lon double, `{self.options['variable']}` double"

    def reader(self, schema) -> GridReader:
        return GridReader(self.options["path"], self.options["variable"])

    def writer(self, schema, overwrite: bool) -> GridWriter:
        return GridWriter(self.options, overwrite)


def open_array(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """Long rows of one variable of an array store; missing values are NULL."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(GridArrays)
    return spark.read.format(FORMAT).option("variable", variable).load(path)


def write_array(df: DataFrame, path: str, variable: str, days: tuple[int, int], lat: Axis, lon: Axis, chunks: str = "time=365,lat=16,lon=16",
                packing: tuple[float, float] | None = None, units: str = "", overwrite: bool = False) -> None:
    """Write (ord, fi, fj, ``variable``) as one array over the days [first, end) and both axes.

    ``chunks`` gives sizes per axis, -1 for the whole axis.  With ``packing`` values
    are stored as 16-bit codes, else as single precision.  A row outside the axes stops
    the job; cells and days without a row are missing.
    """
    spark = df.sparkSession
    spark.dataSource.register(GridArrays)
    first, end = days
    shape = [end - first, lat.size, lon.size]
    sizes = parse_chunks(chunks)
    if set(sizes) - {"time", "lat", "lon"}:
        raise ValueError(f"chunk names must be time, lat and lon: {chunks!r}")
    cut = [max(1, min(n, n if sizes.get(name, -1) == -1 else sizes[name])) for name, n in zip(("time", "lat", "lon"), shape)]
    across = [-(-n // c) for n, c in zip(shape, cut)]
    inside = F.expr(f"ord >= {first} AND ord < {end} AND fi >= 0 AND fi < {lat.size} AND fj >= 0 AND fj < {lon.size}")
    chunk = F.expr(f"((ord - {first}) div {cut[0]} * {across[1]} + fi div {cut[1]}) * {across[2]} + fj div {cut[2]}")
    checked = F.when(inside, chunk).otherwise(F.raise_error(F.lit("a row lies outside the axes of the array")).cast("bigint"))
    rows = df.select(checked.cast("bigint").alias("chunk"), *[F.col(n).cast("bigint").alias(n) for n in ("ord", "fi", "fj")], F.col(variable).cast("double").alias("value"))
    plan = {"path": path, "variable": variable, "first": first, "shape": shape, "chunks": cut, "packing": list(packing) if packing else None, "units": units,
            "lat": [lat.first + k * lat.step for k in range(lat.size)], "lon": [lon.first + k * lon.step for k in range(lon.size)]}
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, across[0] * across[1] * across[2]))
    placed = rows.repartition(parts, "chunk").sortWithinPartitions("chunk")
    placed.write.format(FORMAT).mode("overwrite" if overwrite else "append").option("plan", json.dumps(plan)).save(path)
