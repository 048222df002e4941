"""Ellipsoidal (geodesic) distance and azimuths as Arrow-batched pandas UDFs.

Nearly spherical ellipsoids take Vincenty's (1975) iteration on the longitude
difference on the auxiliary sphere, vectorised with NumPy over a whole Arrow
batch: each round only touches the lanes that have not yet converged. Lanes
where it fails (nearly antipodal points), and all lanes of flatter or prolate
ellipsoids, where its series are too short, are solved on the start azimuth:
after reducing the problem so that |lat1| >= |lat2|, lat1 <= 0 and the
longitude difference is in [0, pi], the azimuth that leads there is bracketed
and found by Newton's method with the reduced length as slope; the integrals
for length and longitude are taken by Gauss-Legendre quadrature, for either
sign of the flattening.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from geoincident.functions.units import length_factor
from geoincident.session import ship_package

# Named ellipsoids as (major axis km, minor axis km, flattening).
ELLIPSOIDS = {
    "WGS-84": (6378.137, 6356.7523142, 1 / 298.257223563),
    "GRS-80": (6378.137, 6356.7523141, 1 / 298.257222101),
    "Airy (1830)": (6377.563396, 6356.256909, 1 / 299.3249646),
    "Intl 1924": (6378.388, 6356.911946, 1 / 297.0),
    "Clarke (1880)": (6378.249145, 6356.51486955, 1 / 293.465),
    "GRS-67": (6378.1600, 6356.774719, 1 / 298.25),
}

# lanes that the plain iteration has not settled by then go to the azimuth search
MAX_ROUNDS = 200
TOLERANCE = 1e-12
# Vincenty's series stay below a tenth of a millimetre up to this flattening
SERIES_FLATTENING = 1 / 250
# nodes and weights on [-1, 1]; enough for 1e-13 of an arc up to |f| = 0.2
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(24)


def ellipsoid_params(ellipsoid) -> tuple[float, float]:
    """(a, f) of a named ellipsoid or of an (a, b, f) tuple; b is not used."""
    if isinstance(ellipsoid, str):
        try:
            a, _b, f = ELLIPSOIDS[ellipsoid]
        except KeyError:
            raise ValueError(f"unknown ellipsoid {ellipsoid!r}; known: {sorted(ELLIPSOIDS)}") from None
    else:
        a, _b, f = ellipsoid
    return float(a), float(f)


def principal_radii(a: float, f: float) -> tuple[float, float]:
    """Smallest and largest principal radius of curvature on the ellipsoid.

    The metric M²dφ² + N²cos²φ dλ² has M between a(1-e²) at the equator and
    a/sqrt(1-e²) at the poles, N between a and a/sqrt(1-e²). Of an oblate
    ellipsoid (f > 0) the equator's M is the smallest radius and the poles' the
    largest; of a prolate one (f < 0) it is the other way round.
    """
    if not (a > 0.0 and math.isfinite(a) and f < 1.0 and math.isfinite(f)):
        raise ValueError(f"not an ellipsoid: a={a}, f={f}")
    e2 = f * (2.0 - f)
    ends = a * (1.0 - e2), a / math.sqrt(1.0 - e2)
    return min(ends), max(ends)


def ratio_bound(f: float) -> float:
    """Largest possible geodesic/great-circle ratio divided by the smallest, for any sphere radius."""
    lo, hi = principal_radii(1.0, f)
    return hi / lo


def vincenty_km(lat1, lon1, lat2, lon2, a: float, f: float,
                max_rounds: int = MAX_ROUNDS, tol: float = TOLERANCE) -> np.ndarray:
    """Geodesic length (km) for arrays of degrees; NaN only for input that is not finite."""
    return inverse(lat1, lon1, lat2, lon2, a, f, max_rounds, tol)[0]


def inverse(lat1, lon1, lat2, lon2, a: float, f: float, max_rounds: int = MAX_ROUNDS, tol: float = TOLERANCE
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length (km) and the azimuths (degrees clockwise from north, [0, 360)) in which the geodesic leaves the first
    point and goes on at the second one. NaN only for input that is not finite or beyond a pole; equal points have
    azimuth 0, and of several shortest lines (from pole to pole, say) any one counts."""
    lat1 = np.asarray(lat1, dtype=float)
    lat2 = np.asarray(lat2, dtype=float)
    lon1 = np.asarray(lon1, dtype=float)
    lon2 = np.asarray(lon2, dtype=float)
    usable = (np.isfinite(lat1) & np.isfinite(lat2) & np.isfinite(lon1) & np.isfinite(lon2)
              & (np.abs(lat1) <= 90.0) & (np.abs(lat2) <= 90.0))
    if abs(f) > SERIES_FLATTENING:
        out = tuple(np.full(lat1.shape, np.nan) for _ in range(3))
        lanes = np.nonzero(usable)[0]
        for whole, part in zip(out, _on_azimuth(lat1[lanes], lon1[lanes], lat2[lanes], lon2[lanes], a, f), strict=True):
            whole[lanes] = part
        return out
    lat1, lon1, lat2, lon2 = (np.where(usable, x, np.nan) for x in (lat1, lon1, lat2, lon2))
    b = a * (1.0 - f)
    dlon = np.radians(lon2 - lon1)
    L = np.arctan2(np.sin(dlon), np.cos(dlon))          # into (-pi, pi]
    U1 = np.arctan((1.0 - f) * np.tan(np.radians(lat1)))
    U2 = np.arctan((1.0 - f) * np.tan(np.radians(lat2)))
    sU1, cU1, sU2, cU2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)

    n = L.shape[0]
    lam = L.copy()
    sin_s = np.zeros(n)
    cos_s = np.ones(n)
    sigma = np.zeros(n)
    cos2a = np.ones(n)
    cos2sm = np.zeros(n)
    done = np.zeros(n, dtype=bool)
    done |= np.isnan(L) | np.isnan(U1) | np.isnan(U2)

    active = np.nonzero(~done)[0]
    for _ in range(max_rounds):
        if active.size == 0:
            break
        lm = lam[active]
        s_lm, c_lm = np.sin(lm), np.cos(lm)
        su1, cu1, su2, cu2 = sU1[active], cU1[active], sU2[active], cU2[active]
        ss = np.hypot(cu2 * s_lm, cu1 * su2 - su1 * cu2 * c_lm)
        cs = su1 * su2 + cu1 * cu2 * c_lm
        sg = np.arctan2(ss, cs)
        with np.errstate(divide="ignore", invalid="ignore"):
            sa = np.where(ss == 0.0, 0.0, cu1 * cu2 * s_lm / ss)
            c2a = 1.0 - sa * sa
            c2m = np.where(c2a == 0.0, 0.0, cs - 2.0 * su1 * su2 / c2a)
        C = f / 16.0 * c2a * (4.0 + f * (4.0 - 3.0 * c2a))
        new = L[active] + (1.0 - C) * f * sa * (
            sg + C * ss * (c2m + C * cs * (-1.0 + 2.0 * c2m * c2m)))
        sin_s[active], cos_s[active], sigma[active] = ss, cs, sg
        cos2a[active], cos2sm[active] = c2a, c2m
        conv = (np.abs(new - lm) < tol) | (ss == 0.0)
        lam[active] = new
        done[active[conv]] = True
        active = active[~conv]

    # evaluate the auxiliary-sphere terms once more at the converged lambda
    fin = np.nonzero(done & ~(np.isnan(L) | np.isnan(U1) | np.isnan(U2)))[0]
    if fin.size:
        lm = lam[fin]
        s_lm, c_lm = np.sin(lm), np.cos(lm)
        su1, cu1, su2, cu2 = sU1[fin], cU1[fin], sU2[fin], cU2[fin]
        ss = np.hypot(cu2 * s_lm, cu1 * su2 - su1 * cu2 * c_lm)
        cs = su1 * su2 + cu1 * cu2 * c_lm
        with np.errstate(divide="ignore", invalid="ignore"):
            sa = np.where(ss == 0.0, 0.0, cu1 * cu2 * s_lm / ss)
            c2a = 1.0 - sa * sa
            c2m = np.where(c2a == 0.0, 0.0, cs - 2.0 * su1 * su2 / c2a)
        sin_s[fin], cos_s[fin], sigma[fin] = ss, cs, np.arctan2(ss, cs)
        cos2a[fin], cos2sm[fin] = c2a, c2m

    u2 = cos2a * (a * a - b * b) / (b * b)
    A = 1.0 + u2 / 16384.0 * (4096.0 + u2 * (-768.0 + u2 * (320.0 - 175.0 * u2)))
    B = u2 / 1024.0 * (256.0 + u2 * (-128.0 + u2 * (74.0 - 47.0 * u2)))
    d_sigma = B * sin_s * (cos2sm + B / 4.0 * (
        cos_s * (-1.0 + 2.0 * cos2sm * cos2sm)
        - B / 6.0 * cos2sm * (-3.0 + 4.0 * sin_s * sin_s) * (-3.0 + 4.0 * cos2sm * cos2sm)))
    s = b * A * (sigma - d_sigma)
    azi1 = np.arctan2(cU2 * np.sin(lam), cU1 * sU2 - sU1 * cU2 * np.cos(lam))
    azi2 = np.arctan2(cU1 * np.sin(lam), cU1 * sU2 * np.cos(lam) - sU1 * cU2)
    azi1, azi2 = _degrees(azi1), _degrees(azi2)
    retry = np.nonzero(~done & usable)[0]
    if retry.size:
        s[retry], azi1[retry], azi2[retry] = _on_azimuth(lat1[retry], lon1[retry], lat2[retry], lon2[retry], a, f)
    for x in (s, azi1, azi2):
        x[~usable] = np.nan
    return s, azi1, azi2


def _degrees(angle: np.ndarray) -> np.ndarray:
    out = np.degrees(angle) % 360.0
    return np.where(out >= 360.0, 0.0, out)


class _Lanes:
    """Reduced problems: first point south and no nearer to the equator than the second, longitude difference in [0, pi]."""

    def __init__(self, beta1: np.ndarray, beta2: np.ndarray, f: float):
        self.f, self.ep2 = f, f * (2.0 - f) / (1.0 - f) ** 2
        self.sb1, self.cb1, self.sb2, self.cb2 = np.sin(beta1), np.cos(beta1), np.sin(beta2), np.cos(beta2)

    def take(self, at: np.ndarray) -> _Lanes:
        new = object.__new__(_Lanes)
        new.f, new.ep2 = self.f, self.ep2
        for name in ("sb1", "cb1", "sb2", "cb2"):
            setattr(new, name, getattr(self, name)[at])
        return new

    def shoot(self, alpha: np.ndarray) -> tuple[np.ndarray, ...]:
        """From the start azimuth: longitude difference at the second latitude and its slope, length and reduced length
        (over the minor axis), and the azimuth there."""
        f, sa1, ca1 = self.f, np.sin(alpha), np.cos(alpha)
        sa0 = sa1 * self.cb1
        k2 = self.ep2 * (ca1 * ca1 + (sa1 * self.sb1) ** 2)
        s1 = np.arctan2(self.sb1, ca1 * self.cb1)
        w1 = np.arctan2(sa0 * np.sin(s1), np.cos(s1))
        ca2cb2 = np.sqrt(np.maximum(0.0, (ca1 * self.cb1) ** 2 + (self.cb2 - self.cb1) * (self.cb2 + self.cb1)))
        s2 = np.arctan2(self.sb2, ca2cb2)
        w2 = np.arctan2(sa0 * np.sin(s2), np.cos(s2))
        half = 0.5 * (s2 - s1)
        at = 0.5 * (s1 + s2)[:, None] + half[:, None] * _NODES
        root = np.sqrt(1.0 + k2[:, None] * np.sin(at) ** 2)
        length = half * (root @ _WEIGHTS)
        lag = half * (((2.0 - f) / (1.0 + (1.0 - f) * root)) @ _WEIGHTS)
        bend = half * ((k2[:, None] * np.sin(at) ** 2 / root) @ _WEIGHTS)
        reduced = (np.sqrt(1.0 + k2 * np.sin(s2) ** 2) * np.cos(s1) * np.sin(s2)
                   - np.sqrt(1.0 + k2 * np.sin(s1) ** 2) * np.sin(s1) * np.cos(s2) - np.cos(s1) * np.cos(s2) * bend)
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = (1.0 - f) * reduced / ca2cb2
        return (w2 - w1) - f * sa0 * lag, slope, length, reduced, np.arctan2(sa0, ca2cb2)


def _on_azimuth(lat1, lon1, lat2, lon2, a: float, f: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverse problem by a bracketed Newton search for the start azimuth, for either sign of ``f``.

    The longitude difference is 0 for a start to the north and pi to the south. It goes through any value between once
    (a prolate one may pass pi just before, when the line over the pole is not the shortest). Two points on the equator
    leave the start azimuth open; the first one is moved south by 1e-12 degrees (a tenth of a micrometre) there.
    """
    dlon = np.radians(lon2 - lon1)
    L = np.arctan2(np.sin(dlon), np.cos(dlon))
    b1 = np.arctan((1.0 - f) * np.tan(np.radians(lat1)))
    b2 = np.arctan((1.0 - f) * np.tan(np.radians(lat2)))
    swap = np.abs(b1) < np.abs(b2)
    b1, b2 = np.where(swap, b2, b1), np.where(swap, b1, b2)
    flip = b1 > 0
    b1, b2 = np.where(flip, -b1, b1), np.where(flip, -b2, b2)
    east = np.where(L < 0, -1.0, 1.0)
    L = np.abs(L)
    # along the equator a line is the shortest up to there
    equator = (b1 == 0.0) & (L <= (1.0 - min(max(f, 0.0), 1.0)) * np.pi)
    b1 = np.minimum(b1, -math.radians(1e-12))
    lanes = _Lanes(b1, b2, f)

    alpha = np.where(L > 0, np.pi / 2, 0.0)
    lo, hi = np.zeros_like(L), np.full_like(L, np.pi)
    # the meridian over the pole, unless it is passed by its neighbours
    over = lanes.shoot(np.full_like(L, np.pi))
    meridian = (L >= np.pi - 1e-15) & (over[3] >= 0.0)
    alpha[meridian] = np.pi
    active = np.nonzero(~meridian & ~equator & (L > 0))[0]
    own = lanes.take(active)
    x, low, high, width = alpha[active], lo[active], hi[active], np.full(active.size, np.inf)
    while active.size:
        lam, slope, *_ = own.shoot(x)
        miss = lam - L[active]
        low, high = np.where(miss < 0, x, low), np.where(miss < 0, high, x)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = x - miss / slope
        # a step that leaves the bracket, does not halve the last one or is none though the mark is missed is replaced
        # by the middle
        good = ((slope > 0) & (step > low) & (step < high) & (np.abs(step - x) <= 0.5 * width)
                & ((np.abs(step - x) > 1e-15) | (np.abs(miss) <= 1e-13)))
        new = np.where(good, step, 0.5 * (low + high))
        moved = np.abs(new - x)
        width = np.where(good, moved, high - low)
        over_now = (miss == 0.0) | (good & (moved <= 1e-15)) | (high - low <= 1e-15)
        alpha[active] = np.where(miss == 0.0, x, new)
        left = ~over_now
        active, own = active[left], own.take(left)
        x, low, high, width = new[left], low[left], high[left], width[left]

    _, _, length, _, alpha2 = lanes.shoot(alpha)
    km = length * (a * (1.0 - f))
    km[equator] = a * L[equator]
    alpha[equator] = alpha2[equator] = np.pi / 2
    # back to the points as they were given
    first, second = np.where(swap, alpha2, alpha), np.where(swap, alpha, alpha2)
    turned = np.where(swap, -1.0, 1.0)
    south = np.where(flip, -1.0, 1.0)
    sign = np.where(swap, -east, east) * turned
    azi1 = np.arctan2(sign * np.sin(first), turned * south * np.cos(first))
    azi2 = np.arctan2(sign * np.sin(second), turned * south * np.cos(second))
    same = (lat1 == lat2) & (L == 0.0)
    km[same], azi1[same], azi2[same] = 0.0, 0.0, 0.0
    return km, _degrees(azi1), _degrees(azi2)


def geodesic_udf(ellipsoid="WGS-84", unit: str = "km"):
    """A ``pandas_udf(double)`` (lat1, lon1, lat2, lon2) → length in ``unit``."""
    a, f = ellipsoid_params(ellipsoid)
    principal_radii(a, f)  # rejects what is no ellipsoid
    scale = length_factor("km", unit)
    session = SparkSession.getActiveSession()
    if session is not None:
        ship_package(session)  # the workers import this module

    @F.pandas_udf("double")
    def _geodesic(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
        out = vincenty_km(lat1.to_numpy(float, na_value=np.nan), lon1.to_numpy(float, na_value=np.nan),
                          lat2.to_numpy(float, na_value=np.nan), lon2.to_numpy(float, na_value=np.nan),
                          a, f) * scale
        return pd.Series(out)

    return _geodesic


def geodesic_km(lat1, lon1, lat2, lon2, ellipsoid="WGS-84", unit: str = "km") -> Column:
    """Column expression: geodesic distance. Inputs are cast to double so that
    SQL decimal literals do not reach the UDF as Python Decimals."""
    cols = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in (lat1, lon1, lat2, lon2)]
    return geodesic_udf(ellipsoid, unit)(*cols)


def geodesic_inverse(lat1, lon1, lat2, lon2, ellipsoid="WGS-84", unit: str = "km") -> Column:
    """Column expression: struct of ``length`` and the ``azimuth`` in which the line leaves the first point and the
    ``final_azimuth`` in which it goes on at the second one, from one pass. Null where a coordinate is unusable."""
    a, f = ellipsoid_params(ellipsoid)
    principal_radii(a, f)
    scale = length_factor("km", unit)
    session = SparkSession.getActiveSession()
    if session is not None:
        ship_package(session)

    @F.pandas_udf("length double, azimuth double, final_azimuth double")
    def _inverse(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.DataFrame:
        km, first, last = inverse(*(x.to_numpy(float, na_value=np.nan) for x in (lat1, lon1, lat2, lon2)), a, f)
        return pd.DataFrame({"length": km * scale, "azimuth": first, "final_azimuth": last})

    cols = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in (lat1, lon1, lat2, lon2)]
    return _inverse(*cols)


def vincenty_sql(lat1: str, lon1: str, lat2: str, lon2: str, source: str,
                 keep: str, ellipsoid="WGS-84", rounds: int = 6, prefix: str = "vg") -> tuple[str, str]:
    """The same iteration as a chain of SQL CTEs with a fixed round count
    (for an independent SQL engine). Returns (cte_text, final_cte_name); the
    final CTE has the ``keep`` columns plus ``geodesic_km`` and the start ``azimuth``."""
    a, f = ellipsoid_params(ellipsoid)
    b = a * (1 - f)

    def dbl(x: float) -> str:  # exact double literal in any SQL dialect
        return f"CAST({x!r} AS DOUBLE)"

    ctes = [f"""{prefix}0 AS (
  SELECT {keep},
    atan2(sin(radians({lon2}) - radians({lon1})), cos(radians({lon2}) - radians({lon1}))) AS L,
    atan({dbl(1 - f)} * tan(radians({lat1}))) AS U1,
    atan({dbl(1 - f)} * tan(radians({lat2}))) AS U2
  FROM {source}),
{prefix}lam0 AS MATERIALIZED (SELECT *, L AS lam FROM {prefix}0)"""]
    prev = f"{prefix}lam0"
    for i in range(1, rounds + 1):
        name = f"{prefix}it{i}"
        ctes.append(f"""{name}_s AS (
  SELECT *, sqrt(power(cos(U2) * sin(lam), 2) + power(cos(U1) * sin(U2) - sin(U1) * cos(U2) * cos(lam), 2)) AS ss,
    sin(U1) * sin(U2) + cos(U1) * cos(U2) * cos(lam) AS cs
  FROM {prev}),
{name}_a AS (
  SELECT *, atan2(ss, cs) AS sg,
    CASE WHEN ss = 0 THEN CAST(0 AS DOUBLE) ELSE cos(U1) * cos(U2) * sin(lam) / ss END AS sa
  FROM {name}_s),
{name}_c AS (
  SELECT *, 1 - sa * sa AS c2a FROM {name}_a),
{name}_m AS (
  SELECT *, CASE WHEN c2a = 0 THEN CAST(0 AS DOUBLE) ELSE cs - 2 * sin(U1) * sin(U2) / c2a END AS c2m,
    {dbl(f)} / 16 * c2a * (4 + {dbl(f)} * (4 - 3 * c2a)) AS cc
  FROM {name}_c),
{name} AS MATERIALIZED (
  SELECT {keep}, L, U1, U2,
    L + (1 - cc) * {dbl(f)} * sa * (sg + cc * ss * (c2m + cc * cs * (-1 + 2 * c2m * c2m))) AS lam,
    ss AS ss_prev, cs AS cs_prev, sg AS sg_prev, c2a AS c2a_prev, c2m AS c2m_prev
  FROM {name}_m)""")
        prev = name
    ab = (a * a - b * b) / (b * b)
    ctes.append(f"""{prefix}u AS (
  SELECT *, c2a_prev * {dbl(ab)} AS usq FROM {prev}),
{prefix}ab AS (
  SELECT *, 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))) AS aa,
    usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) AS bb
  FROM {prefix}u),
{prefix}out AS (
  SELECT {keep}, {dbl(b)} * aa * (sg_prev - bb * ss_prev * (c2m_prev + bb / 4 * (
      cs_prev * (-1 + 2 * c2m_prev * c2m_prev)
      - bb / 6 * c2m_prev * (-3 + 4 * ss_prev * ss_prev) * (-3 + 4 * c2m_prev * c2m_prev)))) AS geodesic_km,
    (degrees(atan2(cos(U2) * sin(lam), cos(U1) * sin(U2) - sin(U1) * cos(U2) * cos(lam))) + 360) % 360 AS azimuth
  FROM {prefix}ab)""")
    return ",\n".join(ctes), f"{prefix}out"


def spherical_ratio_bounds(ellipsoid="WGS-84", radius_km: float = 6371.009) -> tuple[float, float]:
    """(lo, hi) with lo*gc <= geodesic <= hi*gc for great-circle distance gc
    on a sphere of ``radius_km`` (geodetic latitude used as spherical)."""
    a, f = ellipsoid_params(ellipsoid)
    lo, hi = principal_radii(a, f)
    return lo / radius_km, hi / radius_km
