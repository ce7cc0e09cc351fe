"""Queries over bias adjustment."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions.presets import VARIABLES
from ..operators import adjustment as adj
from ..operators.humidity import linear_quantiles
from ..session import cut_lineage, place_by, shared_directory
from ..sources.cube import line_counts, roles, table
from .registry import query, rounded
from .scalar_queries import TOP_SQL

_NODES = "[" + ", ".join(f"{n:.2f}" for n in adj.quantile_nodes(50)) + "]"


def series(spark, d, *columns):
    """The three series from one scan: daily rows are written once and each series is read from there."""
    keys = ["cell", "ord", "doy", "month", "year", "lat"]
    together = cut_lineage(roles(spark, d, *columns).select("role", *keys, *columns))
    return tuple(together.where(F.col("role") == r).select(*keys, *columns) for r in ("ref", "hist", "sim"))


def _pool(value: str) -> str:
    """Values of the 31-day windows, by joining every day to its 31 possible centres."""
    return f"""s AS (SELECT role, cell, ord, doy, {value} AS v FROM roles),
b AS (SELECT role, cell, min(ord) AS lo, max(ord) AS hi FROM s GROUP BY ALL),
pool AS (SELECT role, cell, ((doy - 1 - k) % 365 + 365) % 365 + 1 AS doy, v FROM s JOIN b USING (role, cell),
  (SELECT unnest(range(-15, 16)) AS k) WHERE role <> 'sim' AND ord - k BETWEEN lo AND hi),
days AS (SELECT DISTINCT role, cell, doy FROM s),
g AS (SELECT cell, doy, avg(v) FILTER (role = 'ref') AS rm, avg(v) FILTER (role = 'hist') AS hm,
    quantile_cont(v, {_NODES}) FILTER (role = 'ref') AS rq, quantile_cont(v, {_NODES}) FILTER (role = 'hist') AS hq
  FROM pool WHERE (cell, doy) IN (SELECT cell, doy FROM days WHERE role = 'ref')
    AND (cell, doy) IN (SELECT cell, doy FROM days WHERE role = 'hist') GROUP BY cell, doy)"""


_RANK = """,
k AS (SELECT cell, ord, doy, v, rank() OVER (PARTITION BY cell, doy ORDER BY v) + (count(*) OVER (PARTITION BY cell, doy, v) - 1) / 2 AS r,
  count(*) OVER (PARTITION BY cell, doy) AS n FROM s WHERE role = 'sim'),
m AS (SELECT *, min(r) OVER (PARTITION BY cell, doy) AS lo, max(r) OVER (PARTITION BY cell, doy) AS hi FROM k),
t AS (SELECT *, CASE WHEN hi > lo THEN greatest(0, least(49, round_even((50 * (hi * (r - lo))) / ((hi - lo) * n) - 0.5, 0)))::BIGINT + 1 END AS i FROM m)"""


@query("scaling_additive", _pool("tas") + """
SELECT cell, ord, round(v + (rm - hm), 8) AS adjusted FROM s LEFT JOIN g USING (cell, doy) WHERE role = 'sim'""", "roles")
def scaling_additive(spark, d):
    out = adj.adjust(*series(spark, d, "tas"), "tas", "scaling", "additive", "dayofyear")
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")


@query("scaling_multiplicative_monthly", """
g AS (SELECT cell, month, avg(wind) FILTER (role = 'ref') / avg(wind) FILTER (role = 'hist') AS f FROM roles GROUP BY ALL)
SELECT cell, ord, round(wind * f, 8) AS adjusted FROM roles LEFT JOIN g USING (cell, month) WHERE role = 'sim'""", "roles")
def scaling_multiplicative_monthly(spark, d):
    out = adj.adjust(*series(spark, d, "wind"), "wind", "scaling", "multiplicative", "month")
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")


@query("qdm_additive", _pool("tas") + _RANK + """
SELECT cell, ord, round(v + (rq[i] - hq[i]), 8) AS adjusted FROM t LEFT JOIN g USING (cell, doy)""", "roles")
def qdm_additive(spark, d):
    out = adj.adjust(*series(spark, d, "tas"), "tas", "qdm", "additive", "dayofyear")
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")


@query("qdm_multiplicative", _pool("wind") + _RANK + """
SELECT cell, ord, round(v * (rq[i] / hq[i]), 8) AS adjusted FROM t LEFT JOIN g USING (cell, doy)""", "roles")
def qdm_multiplicative(spark, d):
    out = adj.adjust(*series(spark, d, "wind"), "wind", "qdm", "multiplicative", "dayofyear")
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")


@query("dqm_additive", _pool("tas") + """,
f AS (SELECT cell, doy, rm - hm AS sc, [x - rm FOR x IN rq] AS rn, [round_even((x - hm) * 1e9, 0) / 1e9 FOR x IN hq] AS hk, [x - hm FOR x IN hq] AS hn FROM g),
a AS (SELECT s.cell, s.ord, s.doy, v + sc AS y, rn, hk, hn FROM s LEFT JOIN f USING (cell, doy) WHERE role = 'sim'),
w AS (SELECT *, avg(y) OVER (PARTITION BY cell ORDER BY ord RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS sm FROM a),
l AS (SELECT cell, doy, coalesce(regr_slope(sm, ord), 0) AS slope, avg(sm) AS lev, avg(ord) FILTER (sm IS NOT NULL) AS mid FROM w GROUP BY ALL),
x AS (SELECT w.*, lev + CASE WHEN isnan(slope) THEN 0 ELSE slope END * (ord - mid) AS trend FROM w JOIN l USING (cell, doy)),
z AS (SELECT cell, ord, y, trend, rn, hn, 1 + list_sum([CASE WHEN hk[i] + hk[i + 1] < 2 * (y - trend) THEN 1 ELSE 0 END FOR i IN range(1, 50)])::BIGINT AS i FROM x)
SELECT cell, ord, round(y + (rn[i] - hn[i]), 6) AS adjusted FROM z""", "roles")
def dqm_additive(spark, d):
    out = adj.adjust(*series(spark, d, "tas"), "tas", "dqm", "additive")
    return rounded(out.select("cell", "ord", "adjusted"), 6, "adjusted")


_DRY = """s AS (SELECT role, cell, ord, doy, month, pr AS v FROM roles),
o AS (SELECT role, cell, month, v, row_number() OVER w AS i, count(*) OVER (PARTITION BY role, cell, month) AS n,
    count(*) FILTER (v < 0.1) OVER (PARTITION BY role, cell, month) AS low FROM s WHERE role <> 'sim'
  WINDOW w AS (PARTITION BY role, cell, month ORDER BY v)),
j AS (SELECT role, cell, month, i, n, CASE WHEN i <= low THEN (i - 0.5::DOUBLE) * 0.1 / low ELSE v END AS v FROM o),
p AS (SELECT cell, month, count(*) FILTER (role = 'ref' AND v <= 0.1) / count(*) FILTER (role = 'ref') AS pr_,
    count(*) FILTER (role = 'hist' AND v <= 0.1) / count(*) FILTER (role = 'hist') AS ph,
    list_sort(list(v) FILTER (role = 'ref')) AS rv FROM j GROUP BY ALL),
q AS (SELECT *, rv[floor((len(rv) - 1) * ph)::BIGINT + 1] + ((len(rv) - 1) * ph - floor((len(rv) - 1) * ph))
    * (rv[ceil((len(rv) - 1) * ph)::BIGINT + 1] - rv[floor((len(rv) - 1) * ph)::BIGINT + 1]) AS top FROM p),
h AS (SELECT cell, month, CASE WHEN ph > pr_ AND i - 1 BETWEEN ceil(pr_ * (n - 1)) AND floor(ph * (n - 1))
    THEN 0.1 + (top - 0.1) * (i - 1 - ceil(pr_ * (n - 1)) + 0.5) / (floor(ph * (n - 1)) - ceil(pr_ * (n - 1)) + 1) ELSE v END AS v
  FROM j JOIN q USING (cell, month) WHERE role = 'hist')"""


@query("dry_day_adaptation", _DRY + """
SELECT cell, month, count(*) AS n, round(min(v), 8) AS low, round(quantile_cont(v, 0.25), 8) AS q25, round(quantile_cont(v, 0.5), 8) AS q50,
  round(quantile_cont(v, 0.75), 8) AS q75, round(max(v), 8) AS high FROM h GROUP BY cell, month""", "roles")
def dry_day_adaptation(spark, d):
    def summary(rows):
        part = {role: rows[rows["role"] == role] for role in ("ref", "hist")}
        samples = [
            dict(adj.group_samples(p["doy"].to_numpy(), p["month"].to_numpy(), p["ord"].to_numpy(), p["v"].to_numpy(), "month", 0))
            for p in part.values()]
        found = []
        for month in sorted(samples[0].keys() & samples[1].keys()):
            _, hist = adj.adapt_dry_days(samples[0][month], samples[1][month], 0.1)
            found.append((int(rows["cell"].iloc[0]), month, hist.size, *linear_quantiles(hist, np.array([0.0, 0.25, 0.5, 0.75, 1.0]))))
        return pd.DataFrame(found, columns=["cell", "month", "n", *names])

    r, h, _ = series(spark, d, "pr")
    both = place_by(adj._tagged(r, "ref", "pr").unionByName(adj._tagged(h, "hist", "pr")), "cell")
    names = ("low", "q25", "q50", "q75", "high")
    out = both.groupBy("cell").applyInPandas(
        summary, "cell bigint, month bigint, n bigint, " + ", ".join(f"{n} double" for n in names))
    return rounded(out, 8, *names)


@query("qdm_precipitation_monthly", _DRY + f""",
fr AS (SELECT cell, month, quantile_cont(v, {_NODES}) AS rq FROM j WHERE role = 'ref' GROUP BY ALL),
fh AS (SELECT cell, month, quantile_cont(v, {_NODES}) AS hq FROM h GROUP BY ALL),
k AS (SELECT cell, ord, month, v, rank() OVER (PARTITION BY cell, month ORDER BY v) + (count(*) OVER (PARTITION BY cell, month, v) - 1) / 2 AS r,
  count(*) OVER (PARTITION BY cell, month) AS n FROM s WHERE role = 'sim'),
m AS (SELECT *, min(r) OVER (PARTITION BY cell, month) AS lo, max(r) OVER (PARTITION BY cell, month) AS hi FROM k),
t AS (SELECT *, CASE WHEN hi > lo THEN greatest(0, least(49, round_even((50 * (hi * (r - lo))) / ((hi - lo) * n) - 0.5, 0)))::BIGINT + 1 END AS i FROM m),
a AS (SELECT cell, ord, v * (rq[i] / hq[i]) AS x FROM t LEFT JOIN fr USING (cell, month) LEFT JOIN fh USING (cell, month))
SELECT cell, ord, round(CASE WHEN x >= 0.1 THEN x ELSE 0 END, 8) AS adjusted FROM a""", "roles")
def qdm_precipitation_monthly(spark, d):
    from ..functions import physics as ph

    out = adj.adjust(*series(spark, d, "pr"), "pr", "qdm", "multiplicative", "month", adapt_threshold=0.1)
    v = ph.threshold_to_bound(F.col("adjusted"), VARIABLES["pr"].adjust_bounds)
    return out.select("cell", "ord", F.round(v, 8).alias("adjusted"))


@query("preset_snow_ratio", _pool("ln(least(greatest(prsnratio, 0.0001::DOUBLE), 0.9999::DOUBLE) / (1 - least(greatest(prsnratio, 0.0001::DOUBLE), 0.9999::DOUBLE)))")
       + _RANK + """,
a AS (SELECT cell, ord, 1 / (1 + exp(-(v + (rq[i] - hq[i])))) AS x FROM t LEFT JOIN g USING (cell, doy)),
c AS (SELECT cell, ord, CASE WHEN x >= 0.0001 THEN x ELSE 0 END AS x FROM a),
e AS (SELECT cell, ord, CASE WHEN x <= 0.9999 THEN x ELSE 1 END AS x FROM c)
SELECT cell, ord, round(CASE WHEN prsnratio >= 0.9999 THEN 1 WHEN prsnratio > 0.0001 THEN x ELSE 0 END, 6) AS adjusted
FROM e JOIN (SELECT cell, ord, prsnratio FROM roles WHERE role = 'sim') USING (cell, ord)""", "roles")
def preset_snow_ratio(spark, d):
    out = adj.adjust_variable(*series(spark, d, "prsnratio"), "prsnratio", "prsnratio")
    return rounded(out.select("cell", "ord", "adjusted"), 6, "adjusted")


_RATIO_SQL = """
SELECT cell, ord, round(CASE WHEN x >= {edge} THEN x ELSE 0 END, {digits}) AS adjusted FROM (
  SELECT cell, ord, v * (rq[i] / hq[i]) AS x FROM t LEFT JOIN g USING (cell, doy))"""


@query("preset_wind", _pool("wind") + _RANK + _RATIO_SQL.format(edge="0.01::DOUBLE", digits=8), "roles")
def preset_wind(spark, d):
    out = adj.adjust_variable(*series(spark, d, "wind"), "wind", "sfcWind")
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")


@query("preset_tasrange", _pool("tasrange") + _RANK + _RATIO_SQL.format(edge="0.01::DOUBLE", digits=6), "roles")
def preset_tasrange(spark, d):
    out = adj.adjust_variable(*series(spark, d, "tasrange"), "tasrange", "tasrange")
    return rounded(out.select("cell", "ord", "adjusted"), 6, "adjusted")


@query("preset_precipitation_units", """
SELECT cell, ord, TRUE AS same FROM roles WHERE role = 'sim'""", "roles")
def preset_precipitation_units(spark, d):
    """Precipitation per second and per day adjusts to the same values, 86,400 apart, and rain survives."""
    daily = series(spark, d, "pr")
    a = adj.adjust_variable(*daily, "pr", "pr", unit="mm d-1").select("cell", "ord", F.col("adjusted").alias("day"))
    rate = [df.withColumn("pr", F.col("pr") / 86400.0) for df in daily]
    b = adj.adjust_variable(*rate, "pr", "pr").select("cell", "ord", F.col("adjusted").alias("second"))
    day, second = F.coalesce("day", F.lit(-1.0)), F.coalesce(F.col("second") * 86400.0, F.lit(-1.0))
    return a.join(b, ["cell", "ord"]).select("cell", "ord", (F.abs(day - second) <= 1e-6).alias("same"))


@query("role_coverage", """
SELECT role, sum(lines)::BIGINT AS lines, count(*) AS days, any_value(whole)::BIGINT AS whole FROM (
  SELECT CASE WHEN l_linestatus = 'O' AND year(l_shipdate) <= 1998 THEN 'ref' WHEN year(l_shipdate) <= 1998 THEN 'hist' ELSE 'sim' END AS role,
    l_partkey % (side * side) AS cell, CAST(l_shipdate AS DATE) AS day, count(*) AS lines, sum(count(*)) OVER () AS whole
  FROM lineitem, grid WHERE NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29) GROUP BY ALL) GROUP BY role""", "grid")
def role_coverage(spark, d):
    """Order lines and cell-days of each series; together they are all lines without 29 February."""
    counts = line_counts(spark, d)
    items = table(spark, d, "lineitem").where("NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29)")
    return counts.withColumn("whole", F.lit(items.count()))


_KT = "least(greatest(CASE WHEN ra <= 0 THEN 0 ELSE rsds / ra END, 0.0001::DOUBLE), 0.9999::DOUBLE)"


@query("preset_shortwave", TOP_SQL.replace("FROM cube)", "FROM roles)") + ",\n" + _pool(f"ln({_KT} / (1 - {_KT}))").replace("FROM roles)", "FROM top)", 1)
       + _RANK + """,
a AS (SELECT cell, ord, 1 / (1 + exp(-(v + (rq[i] - hq[i])))) AS x FROM t LEFT JOIN g USING (cell, doy)),
c AS (SELECT cell, ord, CASE WHEN x >= 0.0001 THEN x ELSE 0 END AS x FROM a),
e AS (SELECT cell, ord, CASE WHEN x <= 0.9999 THEN x ELSE 1 END AS x FROM c)
SELECT cell, ord, round(ra * CASE WHEN k >= 0.9999 THEN 1 WHEN k > 0.0001 THEN x ELSE 0 END, 6) AS adjusted
FROM e JOIN (SELECT cell, ord, ra, CASE WHEN ra <= 0 THEN 0 ELSE rsds / ra END AS k FROM top WHERE role = 'sim') USING (cell, ord)""", "roles")
def preset_shortwave(spark, d):
    """Adjusted in clearness-index space."""
    out = adj.adjust_variable(*series(spark, d, "rsds"), "rsds", "rsds")
    return rounded(out.select("cell", "ord", "adjusted"), 6, "adjusted")


@query("fit_cache_roundtrip", _pool("tas") + _RANK + """
SELECT cell, ord, round(v + (rq[i] - hq[i]), 8) AS adjusted FROM t LEFT JOIN g USING (cell, doy)""", "roles")
def fit_cache_roundtrip(spark, d):
    """The same adjustment through a stored fit: trained once, then read by its fingerprint."""
    r, h, s = series(spark, d, "tas")
    key = adj.fit_key({"tables": d, "variable": "tas", "method": "qdm", "window": 31, "quantiles": 50})
    path = f"{shared_directory(spark)}/fit-cache-{uuid.uuid4().hex}/tas"
    adj.cached_fit(spark, path, key, lambda: adj.train(r, h, "tas", "qdm", "additive"))
    out = adj.adjust(r, h, s, "tas", "qdm", "additive", "dayofyear", cache=(path, key))
    return rounded(out.select("cell", "ord", "adjusted"), 8, "adjusted")
