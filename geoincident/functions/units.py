"""Length and angle units."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kilometres per unit. A statute mile is 1.609344 km, a foot
# is 1/5280 mile, a nautical mile is 1.852 km.
KM_PER_UNIT = {
    "km": 1.0,
    "m": 0.001,
    "mi": 1.609344,
    "ft": 1.609344 / 5280.0,
    "nm": 1.852,
    "nmi": 1.852,
}
# Degrees per unit.
DEG_PER_UNIT = {
    "deg": 1.0,
    "rad": 180.0 / math.pi,
    "arcmin": 1.0 / 60.0,
    "arcsec": 1.0 / 3600.0,
}


def length_factor(src: str, dst: str) -> float:
    try:
        return KM_PER_UNIT[src] / KM_PER_UNIT[dst]
    except KeyError as exc:
        raise ValueError(f"unknown length unit {exc}; known: {sorted(KM_PER_UNIT)}") from None


def angle_factor(src: str, dst: str) -> float:
    try:
        return DEG_PER_UNIT[src] / DEG_PER_UNIT[dst]
    except KeyError as exc:
        raise ValueError(f"unknown angle unit {exc}; known: {sorted(DEG_PER_UNIT)}") from None


def convert_length(c, src: str, dst: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col * F.lit(length_factor(src, dst))


def convert_angle(c, src: str, dst: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col * F.lit(angle_factor(src, dst))
