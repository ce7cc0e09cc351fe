"""Command line over stores of cube rows: ``spark-submit -m zephyrgrid.cli`` or ``python -m zephyrgrid.cli``.

Every input is a Parquet store with (cell, fi, fj, lat, year, month, doy, ord)
and one column per variable; reports are printed as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import physics as ph
from .functions.presets import VARIABLES
from .operators import adjustment, downscale, packing, qc
from .operators.regrid import Axis
from .plans import pipeline
from .session import build_session, scalar_row
from .sources import stores


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="zephyrgrid", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)

    def command(name: str, help_text: str, *inputs: str, output: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help_text)
        for item in inputs:
            sub.add_argument(item)
        if output:
            sub.add_argument("output")
            sub.add_argument("--overwrite", action="store_true")
        return sub

    convert = command("convert", "copy a store, placed by the named columns", "input")
    convert.add_argument("--chunks", help="sizes such as cell=64,year=1 (only the names place files)")
    validate = command("validate", "check one variable", "input", output=False)
    validate.add_argument("--variable", required=True, choices=sorted(VARIABLES))
    validate.add_argument("--min-years", type=int)
    validate.add_argument("--min-valid-fraction", type=float, default=0.95)
    command("validate-dataset", "check linked variables", "input", output=False)
    command("derive", "add derived variables", "input")
    pack = command("pack", "publish one variable as scaled 16-bit codes", "input")
    pack.add_argument("--variable", required=True, choices=sorted({**packing.RANGES, **packing.STEPS}))
    adjust = command("adjust", "adjust a simulation to a reference", "reference", "historical", "simulation")
    adjust.add_argument("--variable", required=True, choices=sorted(VARIABLES))
    adjust.add_argument("--unit", help="unit of the inputs (default: the one the variable is stored in)")
    adjust.add_argument("--min-observation-years", type=int, help="refuse series with fewer years")
    adjust.add_argument("--quantiles", type=int, default=50)
    adjust.add_argument("--seed", type=int, default=0)
    spread = command("downscale", "spread a coarse simulation over the fine grid", "reference", "simulation")
    spread.add_argument("--variable", required=True, choices=sorted(VARIABLES))
    for name, kind in (("rows", int), ("columns", int), ("factor", int), ("south", float), ("step", float)):
        spread.add_argument(f"--{name}", type=kind, required=True, help="coarse size, nesting factor, or fine latitude axis")
    spread.add_argument("--unit", help="unit of the inputs (default: the one the variable is stored in)")
    spread.add_argument("--quantiles", type=int, default=50)
    spread.add_argument("--if-all-invalid-use", type=float, help="value for cells without any valid day (default: the variable's own)")
    spread.add_argument("--iterations", type=int, default=20)
    spread.add_argument("--seed", type=int, default=0)
    return root


def _check(df: DataFrame, variable: str, minimum_years: int | None, fraction: float) -> dict:
    name = "wind" if variable == "sfcWind" else variable
    df = df.withColumnRenamed(variable, name)
    days = scalar_row(df.agg(F.count_distinct("ord").alias("n")))["n"]
    report = scalar_row(qc.variable_report(df, [name], days, fraction)).asDict()
    times = qc.time_checks(df, ["cell"], minimum_years)
    flags = [c for c in times.columns if c not in ("cell", "days")]
    report.update(scalar_row(times.agg(*[F.bool_and(f).alias(f) for f in flags])).asDict())
    report["valid"] = bool(report["valid"]) and all(report[f] for f in flags)
    return report


def main(arguments: list[str] | None = None) -> int:
    options = parser().parse_args(arguments)
    spark = build_session()
    read = lambda path: stores.open_cube(spark, path, getattr(options, "variable", None))
    report: dict = {"valid": True}
    if options.command == "convert":
        names = list(stores.parse_chunks(options.chunks))
        df = read(options.input)
        stores.publish(df.repartition(*names) if names else df, options.output, overwrite=options.overwrite)
    elif options.command == "validate":
        report = _check(read(options.input), options.variable, options.min_years, options.min_valid_fraction)
    elif options.command == "validate-dataset":
        report = scalar_row(qc.linked_consistency(ph.derive_components(read(options.input)))).asDict()
    elif options.command == "derive":
        stores.publish(ph.derive_components(read(options.input)), options.output, overwrite=options.overwrite)
    elif options.command == "pack":
        report = pipeline.publish(read(options.input), options.variable, options.variable, options.output, options.overwrite)
    elif options.command == "adjust":
        inputs = [read(p) for p in (options.reference, options.historical, options.simulation)]
        if options.min_observation_years is not None:
            checked = pipeline.inputs_report(*inputs, options.variable, options.min_observation_years).collect()
            short = [r["input"] for r in checked if not (r["time_monotonic"] and r["time_unique"] and r["training_period_sufficient"])]
            if short:
                print(json.dumps({"valid": False, "insufficient": short}, sort_keys=True))
                return 1
        out = adjustment.adjust_variable(
            *inputs, options.variable, options.variable, options.quantiles, options.seed, unit=options.unit)
        stores.publish(out.select("cell", "ord", F.col("adjusted").alias(options.variable)), options.output, overwrite=options.overwrite)
    else:
        rules = VARIABLES[options.variable].in_unit(options.unit)
        fallback = rules.all_invalid_value if options.if_all_invalid_use is None else options.if_all_invalid_use
        out = downscale.downscale(
            read(options.reference), read(options.simulation), options.variable,
            Axis(options.south, options.step, options.rows * options.factor), options.rows, options.columns, options.factor,
            rules.downscale_bounds, options.iterations, options.quantiles, options.seed, fallback)
        stores.publish(out, options.output, overwrite=options.overwrite)
    print(json.dumps(report, sort_keys=True, default=str))
    return 0 if report.get("valid", report.get("valid_packing", True)) else 1


if __name__ == "__main__":
    sys.exit(main())
