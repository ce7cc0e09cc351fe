"""One key holding a third of all rows: results stay whole and no task gathers the key."""

import numpy as np
import pandas as pd
import pytest

from zephyrgrid.operators import quantiles
from zephyrgrid.sources import cube


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    directory = tmp_path_factory.mktemp("skewed")
    rng = np.random.default_rng(0)
    n = 60000
    hot = np.arange(n) % 3 == 0
    dates = pd.Timestamp("1996-01-01") + pd.to_timedelta(np.where(hot, 100, rng.integers(0, 1500, n)), unit="D")
    pd.DataFrame({"p_partkey": np.arange(2000)}).to_parquet(directory / "part.parquet")
    pd.DataFrame({
        "l_partkey": np.where(hot, 7, rng.integers(0, 2000, n)), "l_quantity": rng.integers(1, 51, n).astype(float),
        "l_discount": rng.integers(0, 11, n) / 100, "l_tax": rng.integers(0, 9, n) / 100,
        "l_extendedprice": rng.integers(90000, 10500000, n) / 100, "l_linestatus": np.where(rng.random(n) < 0.5, "O", "F"),
        "l_shipdate": dates.astype("datetime64[us]"),
    }).to_parquet(directory / "lineitem.parquet")
    return str(directory)


def test_cube_is_whole_and_unique(spark, skewed):
    got = cube.daily_cube(spark, skewed, "tas", "wind").toPandas()
    assert not got.duplicated(["cell", "ord"]).any()
    items = pd.read_parquet(f"{skewed}/lineitem.parquet")
    items = items[~((items.l_shipdate.dt.month == 2) & (items.l_shipdate.dt.day == 29))]
    items["cell"] = items.l_partkey % 16
    want = items.groupby(["cell", items.l_shipdate.dt.date])["l_quantity"].mean() + 260
    assert len(got) == len(want)
    np.testing.assert_allclose(np.sort(got["tas"]), np.sort(want.to_numpy()), rtol=1e-12)


def test_partial_sums_come_before_the_shuffle(spark, skewed):
    plan = cube.daily_cube(spark, skewed, "tas")._jdf.queryExecution().executedPlan().toString()
    final, exchange, partial = (plan.index(k) for k in ("functions=[sum", "Exchange hashpartitioning", "partial_sum"))
    assert final < exchange < partial


def test_role_predicates_reach_the_scan(spark, skewed):
    plan = cube.role_series(spark, skewed, "ref", "tas")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(l_linestatus,O)" in pushed and "LessThan(l_shipdate" in pushed
    assert "l_extendedprice" not in plan  # only the needed columns are read


def test_quantiles_of_a_hot_value(spark, skewed):
    items = spark.read.parquet(f"{skewed}/lineitem.parquet")
    values = pd.read_parquet(f"{skewed}/lineitem.parquet")["l_partkey"].to_numpy()
    got = {r.p: r.quantile for r in quantiles.exact_quantiles(items, "l_partkey", [0.1, 0.3, 0.5, 0.9]).collect()}
    np.testing.assert_allclose([got[p] for p in (0.1, 0.3, 0.5, 0.9)], np.quantile(values, [0.1, 0.3, 0.5, 0.9]))
