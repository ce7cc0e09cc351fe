"""Per-variable settings of the ten primary variables (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from . import units


@dataclass(frozen=True)
class Bounds:
    lower: float | None = None
    lower_threshold: float | None = None
    upper: float | None = None
    upper_threshold: float | None = None

    def converted(self, source: str, target: str) -> Bounds:
        """The same bounds in another unit."""
        a, b = units.conversion(source, target)
        return Bounds(*[None if x is None else a * x + b for x in (
            self.lower, self.lower_threshold, self.upper, self.upper_threshold)])


@dataclass(frozen=True)
class VariableSettings:
    name: str
    unit: str
    regrid: str
    method: str
    kind: str
    adjust_bounds: Bounds
    downscale_bounds: Bounds
    transform: str | None = None
    adapt_threshold: float | None = None
    clip: tuple[float | None, float | None] = (None, None)
    window: int = 31
    revision: int = 1
    conservation_tolerance: float = 0.05
    all_invalid_value: float | None = None
    bounds_unit: str | None = None  # of bounds and dry-day threshold, where not ``unit``

    def in_unit(self, unit: str | None = None) -> VariableSettings:
        """These settings for data in ``unit`` (default: the variable's own): every limit is converted once, here.

        Bounds of transformed values have no unit and stay as they are.
        """
        unit = unit or self.unit
        source = self.bounds_unit or self.unit
        threshold = None if self.adapt_threshold is None else units.quantity(f"{self.adapt_threshold} {source}", unit)
        a, b = units.conversion(self.unit, unit)
        clip = tuple(None if x is None else a * x + b for x in self.clip)
        return replace(
            self, unit=unit, bounds_unit=unit, adapt_threshold=threshold, clip=clip,
            adjust_bounds=self.adjust_bounds if self.transform else self.adjust_bounds.converted(source, unit),
            downscale_bounds=self.downscale_bounds.converted(source, unit))


_UNIT_LOGIT = Bounds(0.0, 1e-4, 1.0, 0.9999)

# Method, bounds and physical limits of each variable; precipitation bounds in mm/day.
VARIABLES: dict[str, VariableSettings] = {
    v.name: v
    for v in (
        VariableSettings("hurs", "%", "linear", "bounded_qdm", "additive",
                         Bounds(0.0, 0.01, 100.0, 99.99), Bounds(0.0, 0.01, 100.0, 99.99),
                         revision=4),
        VariableSettings("pr", "kg m-2 s-1", "conservative", "qdm", "multiplicative",
                         Bounds(0.0, 0.1), Bounds(0.0, 0.1),
                         adapt_threshold=0.1, clip=(0.0, None), bounds_unit="mm d-1"),
        VariableSettings("prsnratio", "1", "linear", "qdm", "additive",
                         _UNIT_LOGIT, _UNIT_LOGIT, transform="logit",
                         clip=(0.0, 1.0), conservation_tolerance=0.15, all_invalid_value=0.0),
        VariableSettings("ps", "Pa", "linear", "dqm", "additive",
                         Bounds(), Bounds(), clip=(0.0, None)),
        VariableSettings("rlds", "W m-2", "linear", "dqm", "additive",
                         Bounds(), Bounds(), clip=(0.0, None)),
        VariableSettings("rsds", "W m-2", "linear", "qdm", "additive",
                         _UNIT_LOGIT, Bounds(0.0, 0.01),
                         transform="clearness_index", clip=(0.0, None)),
        VariableSettings("sfcWind", "m s-1", "linear", "qdm", "multiplicative",
                         Bounds(0.0, 0.01), Bounds(0.0, 0.01), clip=(0.0, None)),
        VariableSettings("tas", "K", "linear", "dqm", "additive",
                         Bounds(), Bounds(150.0, 150.0, 350.0, 350.0)),
        VariableSettings("tasrange", "K", "linear", "qdm", "multiplicative",
                         Bounds(0.0, 0.01), Bounds(0.0, 0.01), clip=(0.0, None)),
        VariableSettings("tasskew", "1", "linear", "qdm", "additive",
                         _UNIT_LOGIT, _UNIT_LOGIT, transform="logit",
                         clip=(0.0, 1.0)),
    )
}

# Value controls applied to finished fields.
PRECIPITATION_CEILING_MM_DAY = 3000.0
WIND_CEILING_M_S = 46.0
TEMPERATURE_VALID_RANGE_K = (130.0, 377.0)
STATIC_FLOOR_K = 150.0


def settings(variable: str) -> VariableSettings:
    try:
        return VARIABLES[variable]
    except KeyError:
        raise ValueError(f"no settings for variable {variable!r}") from None

# First and last year of the two periods every model provides.
PERIODS = {"hist": (1989, 2014), "projection": (2015, 2100)}


def expected_period(experiment: str, phase: str) -> tuple[int, int]:
    """Years of a collection folder; only the two-period layout is supported."""
    if (experiment == "historical") != (phase == "hist") or phase not in PERIODS:
        raise ValueError(f"unsupported layout {experiment}/{phase}")
    return PERIODS[phase]
