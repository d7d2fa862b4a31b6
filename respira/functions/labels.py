"""Calendar derivations and report labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from respira.plans.series import micros

# Formulas as they appear in column names and how reports print them.
FORMULAS = {
    "CO2": "CO<sub>2</sub>",
    "Co2": "CO<sub>2</sub>",
    "co2": "CO<sub>2</sub>",
    "H2O": "H<sub>2</sub>O",
    "h2o": "H<sub>2</sub>O",
    "CH4": "CH<sub>4</sub>",
    "N2O": "N<sub>2</sub>O",
}
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.44
DAY_US = 86_400_000_000


def season(ts: str) -> Column:
    """Dry from May to September, else wet."""
    return F.when(F.month(ts).between(5, 9), "dry").otherwise("wet")


def age_days(ts: str, origin: Column) -> Column:
    return (micros(ts) - micros(origin)) / DAY_US


def age_years(ts: str, origin: Column) -> Column:
    return age_days(ts, origin) / DAYS_PER_YEAR


def months_after(ts: str, origin: Column) -> Column:
    return age_days(ts, origin) / DAYS_PER_MONTH


def age_bin(ts: str, origin: Column, width_days: int) -> Column:
    return (F.floor(F.floor(age_days(ts, origin)) / width_days) * width_days).cast("int")


def pretty_formula(text: Column) -> Column:
    """Known gas formulas with subscripts; sensor ids such as C1 are left alone."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), FORMULAS.items(), text)
