"""Slopes to fluxes: ideal-gas conversion, dilution correction, leaf-area basis, light."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from respira.functions.numeric import clip, ratio

# Physical constants, the two chamber builds and the date they changed.
PRESSURE_PA = 101325.0
GAS_CONSTANT = 8.314
KELVIN = 273.15
DEFAULT_TEMP_C = 25.0
RESIZE_DATE = "2025-07-01"
SMALL_CHAMBER = {"volume": 8.0, "area": 4.0}
LARGE_CHAMBER = {"volume": 96.0, "area": 16.0}
MIN_NET_VOLUME = 0.1
LEAF_AREA_PER_LEAF = {"conservative": 4.0, "literature_max": 12.0, "fixed": 6.0}
H2O_VALID_RANGE = (0.0, 60.0)
MAX_REL_DILUTION = 0.12
PAR_FRACTION = 0.45
PAR_UMOL_PER_W = 4.57


def _before_resize(at: Column) -> Column:
    return at < F.lit(RESIZE_DATE).cast("date")


def chamber_volume(at: Column) -> Column:
    small, large = F.lit(SMALL_CHAMBER["volume"]), F.lit(LARGE_CHAMBER["volume"])
    return F.when(at.isNotNull(), F.when(_before_resize(at), small).otherwise(large))


def floor_area(at: Column) -> Column:
    small, large = F.lit(SMALL_CHAMBER["area"]), F.lit(LARGE_CHAMBER["area"])
    return F.when(at.isNotNull(), F.when(_before_resize(at), small).otherwise(large))


def absolute_flux(slope: Column, temp_c: Column, at: Column, tree_volume: Column | None = None) -> Column:
    """Flux per ground area from a concentration slope, with the ideal-gas molar density at chamber temperature.

    Missing temperature counts as 25 degrees, missing tree volume as none; the air volume never falls below 0.1.
    """
    kelvin = F.coalesce(temp_c, F.lit(DEFAULT_TEMP_C)) + KELVIN
    tree = F.coalesce(tree_volume, F.lit(0.0)) if tree_volume is not None else F.lit(0.0)
    net = F.when(at.isNotNull(), F.greatest(chamber_volume(at) - tree, F.lit(MIN_NET_VOLUME)))
    return slope * (F.lit(PRESSURE_PA) / (F.lit(GAS_CONSTANT) * kelvin)) * net / floor_area(at)


def valid_h2o(h2o: Column) -> Column:
    """Water vapour inside the sensor's range, else null."""
    return F.when(h2o.between(*H2O_VALID_RANGE), h2o)


def dilution_factor(h2o: Column) -> Column:
    """Wet-to-dry factor 1 + w / (1000 - w)."""
    return F.when(h2o < 1000, 1.0 + h2o / (1000.0 - h2o))


def dilution_columns(co2: str, h2o: str) -> dict[str, Column]:
    """Dry mole fraction and the diagnostics kept beside it."""
    c, w = F.col(co2), valid_h2o(F.col(h2o))
    factor = dilution_factor(w)
    delta = c * factor - c
    return {
        "wpl_factor": factor,
        "co2_corrected": c * factor,
        "wpl_delta_ppm": delta,
        "wpl_rel_change": ratio(delta, c),
        "wpl_valid_input": F.when(w.isNotNull() & c.isNotNull(), 1).otherwise(0),
    }


def leaf_area(n_leaves: Column, method: str = "conservative") -> Column:
    return n_leaves * LEAF_AREA_PER_LEAF[method]


def leaf_basis_flux(flux: Column, lai: Column) -> Column:
    return F.when(lai > 0, flux / lai)


def par_from_radiation(rad: Column) -> Column:
    return rad * PAR_FRACTION * PAR_UMOL_PER_W


def closure_confidence(r2: Column, nrmse: Column, radiation: Column, rad_max: float = 800.0) -> Column:
    """Confidence that the chamber was closed: fit quality, discounted under strong light."""
    light = F.coalesce(clip(radiation / rad_max, 0.0, 1.0), F.lit(0.0))
    fit = F.coalesce(clip((r2 - 0.25) / 0.69, 0.0, 1.0), F.lit(0.0))
    noise = F.coalesce(clip(nrmse / 0.2, 0.0, 1.0), F.lit(0.0))
    return clip(fit - light * (1.0 - fit) * 0.4 - light * noise * 0.2, 0.0, 1.0)


def is_daytime(ts: str, radiation: str | None = None) -> Column:
    """Radiation of at least 10 where it is known, else the hours 6 to 17."""
    hours = F.hour(ts).between(6, 17)
    return F.coalesce(F.col(radiation) >= 10, hours) if radiation else hours
