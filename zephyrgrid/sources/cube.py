"""Cubes as long tables, and the adapter that derives one from the order-line table.

A cube has one row per (cell, day).  The adapter reads lineitem: ``l_partkey``
picks the cell, ``l_shipdate`` the day, and the numeric columns average into
weather-like variables.  Sums run over whole numbers (cents, percent points), so
they do not depend on the order in which tasks finish.  The grid side follows
the number of parts, so the cube gets more cells as the tables grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..session import scalar_row

CELL_KEYS = ("cell", "fi", "fj", "ci", "cj", "coarse", "lat", "lon")
DAY_KEYS = ("year", "month", "day", "doy", "ord")


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


_SIDES: dict[tuple[str, str], int] = {}


def grid_side(spark: SparkSession, directory: str) -> int:
    """Cells along one side of the fine grid: even, at least 4, about one cell per 125 parts.

    One number, asked for several times per query, so it is kept per application.
    """
    key = (spark.sparkContext.applicationId, directory)
    if key not in _SIDES:
        parts = scalar_row(table(spark, directory, "part").agg(F.max("p_partkey").alias("m")))["m"]
        _SIDES[key] = max(4, 2 * int(((parts + 1) / 125.0) ** 0.5 / 2))
    return _SIDES[key]


def with_cell_keys(df: DataFrame, side: int) -> DataFrame:
    """Add grid positions for ``cell``: factor-2 nesting, global longitudes, lat in (-60, 60)."""
    half = side // 2
    return df.withColumns(
        {
            "fi": F.expr(f"cell div {side}"),
            "fj": F.expr(f"cell % {side}"),
            "ci": F.expr(f"cell div {side} div 2"),
            "cj": F.expr(f"(cell % {side}) div 2"),
            "coarse": F.expr(f"(cell div {side} div 2) * {half} + (cell % {side}) div 2"),
            "lat": F.expr(f"-60D + (cell div {side} + 0.5D) * 120D / {side}"),
            "lon": F.expr(f"(cell % {side} + 0.5D) * 360D / {side}"),
        }
    )


def _formulas() -> dict[str, Column]:
    n = F.col("n")
    quantity = F.col("q") / n
    discount = F.col("dsc") / n
    tax = F.col("tx") / n
    cents = F.col("cts") / n
    return {
        "tas": F.lit(260.0) + quantity,
        "hurs": F.lit(10.0) * discount,
        "pr": F.greatest(F.lit(0.0), F.lit(2.0) * tax - F.lit(8.0)),
        "wind": cents / F.lit(997300.0),
        "tasrange": quantity / F.lit(5.0),
        "tasskew": discount / F.lit(10.0),
        "prsnratio": tax / F.lit(8.0),
        "ps": F.lit(95000.0) + F.lit(200.0) * quantity,
        "rsds": cents / F.lit(29989.0),
        "rlds": F.lit(200.0) + F.lit(3.0) * quantity,
        # temperature with holes, for everything that must survive missing values
        "tasm": F.when(F.expr("cts % 13 != 0"), F.lit(260.0) + quantity),
    }


# Each series' part of the table, in terms the Parquet scan can skip row groups by.
# Every dated row belongs to exactly one: the role of a row before 1999 is its status.
_ROLE_ROWS = {
    "ref": "l_linestatus = 'O' AND l_shipdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'",
    "hist": "NOT (l_linestatus <=> 'O') AND l_shipdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'",
    "sim": "l_shipdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'",
}


def _daily(
    spark: SparkSession, directory: str, side: int, rows: str | None = None, role: Column | None = None
) -> DataFrame:
    source = table(spark, directory, "lineitem")
    items = (source if rows is None else source.where(rows)).select(
        *([] if role is None else [role.alias("role")]),
        F.expr(f"l_partkey % {side * side}").alias("cell"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.month("l_shipdate").cast("bigint").alias("month"),
        F.dayofmonth("l_shipdate").cast("bigint").alias("day"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("dsc"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("tx"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cts"),
    )
    items = cal.drop_leap_days(items)
    keys = [*([] if role is None else ["role"]), "cell", "year", "month", "day"]
    # Map-side partial sums: however many rows share one cell and day, at most one
    # row per task and key is shuffled, so a hot cell cannot overload a reducer.
    return items.groupBy(*keys).agg(
        F.sum("q").alias("q"), F.sum("dsc").alias("dsc"), F.sum("tx").alias("tx"),
        F.sum("cts").alias("cts"), F.count(F.lit(1)).alias("n"),
    )


def _finish(daily: DataFrame, side: int, columns: tuple[str, ...], *lead: str) -> DataFrame:
    formulas = _formulas()
    chosen = columns or tuple(formulas)
    keyed = cal.with_noleap_keys(with_cell_keys(daily, side))
    return keyed.select(
        *lead, *CELL_KEYS, *DAY_KEYS, *[formulas[name].alias(name) for name in chosen]
    )


def daily_cube(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """The whole cube: one row per (cell, day) with the chosen variables."""
    side = grid_side(spark, directory)
    return _finish(_daily(spark, directory, side), side, columns)


def role_series(spark: SparkSession, directory: str, role: str, *columns: str) -> DataFrame:
    """One of the three series alone; its rows are chosen in the scan."""
    side = grid_side(spark, directory)
    return _finish(_daily(spark, directory, side, _ROLE_ROWS[role]), side, columns)


def roles(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """All three series in one scan: the cube with a ``role`` column, one row per (role, cell, day)."""
    side = grid_side(spark, directory)
    role = F.when(F.expr(_ROLE_ROWS["sim"]), "sim").when(F.expr(_ROLE_ROWS["ref"]), "ref").otherwise("hist")
    return _finish(_daily(spark, directory, side, role=role), side, columns, "role")


def line_counts(spark: SparkSession, directory: str) -> DataFrame:
    """(role, lines, days): how many order lines and cell-days each series holds."""
    side = grid_side(spark, directory)
    parts = [_daily(spark, directory, side, _ROLE_ROWS[r]).agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("days")).select(
        F.lit(r).alias("role"), F.coalesce("lines", F.lit(0)).alias("lines"), "days") for r in _ROLE_ROWS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def cell_table(spark: SparkSession, directory: str) -> DataFrame:
    """Static per-cell fields: source code 0..3, land flag and land share."""
    side = grid_side(spark, directory)
    totals = (
        table(spark, directory, "lineitem")
        .groupBy(F.expr(f"l_partkey % {side * side}").alias("cell"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
            F.sum(F.rint(F.col("l_discount") * 100).cast("bigint")).alias("dsc"),
        )
    )
    code = F.expr(
        "CASE WHEN q % 10 < 2 THEN 0 WHEN q % 10 < 6 THEN 1 WHEN q % 10 < 8 THEN 2 ELSE 3 END"
    ).cast("bigint")
    return with_cell_keys(totals, side).select(
        *CELL_KEYS,
        code.alias("code"),
        F.expr("dsc % 4 <> 0").alias("land"),
        F.expr("(dsc % 101) / 100D").alias("land_share"),
    )


# The same tables for an independent SQL engine.
SQL_GRID = """grid AS (
  SELECT CAST(greatest(4, 2 * floor(sqrt((max(p_partkey) + 1) / 125.0) / 2)) AS BIGINT) AS side
  FROM part)"""

_SQL_KEYS = """cell, cell // side AS fi, cell % side AS fj, cell // side // 2 AS ci,
    (cell % side) // 2 AS cj, (cell // side // 2) * (side // 2) + (cell % side) // 2 AS coarse,
    -60 + (cell // side + 0.5) * 120::DOUBLE / side AS lat,
    (cell % side + 0.5) * 360::DOUBLE / side AS lon"""

_SQL_VALUES = """260 + qa AS tas, 10 * da AS hurs, greatest(0::DOUBLE, 2 * ta - 8) AS pr,
    ca / 997300 AS wind, qa / 5 AS tasrange, da / 10 AS tasskew, ta / 8 AS prsnratio,
    95000 + 200 * qa AS ps, ca / 29989 AS rsds, 200 + 3 * qa AS rlds,
    CASE WHEN cts % 13 <> 0 THEN 260 + qa END AS tasm"""


def _sql_cube(name: str, role: bool) -> str:
    lead = "role, " if role else ""
    where = "role IS NOT NULL" if role else "TRUE"
    return f"""{name} AS (
  SELECT {lead}{_SQL_KEYS}, year, month, day, doy, (year - 1970) * 365 + doy - 1 AS ord,
    {_SQL_VALUES}
  FROM (
    SELECT {lead}cell, side, year, month, day,
      CAST(dayofyear(make_date(2001, month, day)) AS BIGINT) AS doy,
      sum(q)::DOUBLE / count(*) AS qa, sum(dsc)::DOUBLE / count(*) AS da,
      sum(tx)::DOUBLE / count(*) AS ta, sum(cts)::DOUBLE / count(*) AS ca,
      sum(cts)::BIGINT AS cts
    FROM (
      SELECT l_partkey % (side * side) AS cell, side, year(l_shipdate) AS year,
        month(l_shipdate) AS month, day(l_shipdate) AS day, l_quantity::BIGINT AS q,
        round(l_discount * 100)::BIGINT AS dsc, round(l_tax * 100)::BIGINT AS tx,
        round(l_extendedprice * 100)::BIGINT AS cts,
        CASE WHEN l_linestatus = 'O' AND year(l_shipdate) <= 1998 THEN 'ref'
             WHEN year(l_shipdate) <= 1998 THEN 'hist' ELSE 'sim' END AS role
      FROM lineitem, grid
      WHERE NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29))
    WHERE {where}
    GROUP BY {lead}cell, side, year, month, day))"""


SQL_CUBE = _sql_cube("cube", role=False)
SQL_ROLES = _sql_cube("roles", role=True)
SQL_CELLS = f"""cells AS (
  SELECT {_SQL_KEYS},
    CAST(CASE WHEN q % 10 < 2 THEN 0 WHEN q % 10 < 6 THEN 1 WHEN q % 10 < 8 THEN 2 ELSE 3 END
      AS BIGINT) AS code,
    dsc % 4 <> 0 AS land, (dsc % 101)::DOUBLE / 100 AS land_share
  FROM (
    SELECT l_partkey % (side * side) AS cell, side, sum(l_quantity::BIGINT)::BIGINT AS q,
      sum(round(l_discount * 100)::BIGINT)::BIGINT AS dsc
    FROM lineitem, grid GROUP BY ALL))"""
