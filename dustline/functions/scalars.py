"""Column expressions: physics, calendar, rounding and labels. Everything stays in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dustline import params as P


def lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---- clipping: greatest/least skip NULL, so a NULL input has to stay NULL explicitly ----
def at_least(x: Column, lower) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, lit(lower)))


def at_most(x: Column, upper) -> Column:
    return F.when(x.isNotNull(), F.least(x, lit(upper)))


def clip(x: Column, lower, upper) -> Column:
    return at_most(at_least(x, lower), upper)


def log_floor(x: Column, floor: float) -> Column:
    return F.ln(at_least(x, float(floor)))


def log1p_floor(x: Column, floor: float = 0.0) -> Column:
    return F.log1p(at_least(x, float(floor)))


def finite(x: Column) -> Column:
    """NaN and infinities become NULL."""
    bad = F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return F.when(~bad, x)


def sentinel_to_null(x: Column, at_or_below: float) -> Column:
    return F.when(x > at_or_below, x)


def js_round(x: Column) -> Column:
    return F.floor(x + 0.5)


# ---- wind ----
def wind_u(speed: Column, direction_deg: Column) -> Column:
    return -speed * F.sin(F.radians(direction_deg))


def wind_v(speed: Column, direction_deg: Column) -> Column:
    return -speed * F.cos(F.radians(direction_deg))


def wind_from_angle(u: Column, v: Column) -> Column:
    """Direction the wind blows from, radians."""
    return F.atan2(-u, -v)


def kmh_to_ms(x: Column) -> Column:
    return x / 3.6


# ---- moisture, pressure, radiation ----
def vapour_pressure_hpa(dew_point: Column) -> Column:
    return F.lit(6.112) * F.exp(F.lit(17.67) * dew_point / (dew_point + 243.5))


def specific_humidity_gkg(dew_point: Column, ps_kpa: Column) -> Column:
    e = vapour_pressure_hpa(dew_point)
    return F.lit(622.0) * e / (ps_kpa * 10 - F.lit(0.378) * e)


def boundary_layer_height(ps_kpa: Column, top: Column) -> Column:
    """Hypsometric depth; the layer top may come in kPa or Pa, implausible depths are NULL."""
    top_pa = F.when(top < 200, top * 1000.0).otherwise(top)
    depth = F.lit(8400.0) * F.ln(F.try_divide(ps_kpa * 1000.0, top_pa))
    return F.when(depth.between(0, 6000), depth)


def watts_to_kwh_day(x: Column) -> Column:
    return x * 24 / 1000.0


def dust_fraction(dust: Column, pm10: Column) -> Column:
    return dust / (pm10 + 1.0)


# ---- calendar ----
def year_phase(date: Column) -> Column:
    return F.lit(2 * math.pi) * F.dayofyear(date) / 365.25


def six_hour_block(ts: Column) -> Column:
    return F.floor(F.hour(ts) / 6).cast("int")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def season(date: Column) -> Column:
    m = F.month(date)
    return (F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM")
            .when(m.isin(6, 7, 8), "JJA").otherwise("SON"))


def product_tier(date: Column, today: Column) -> Column:
    age = F.datediff(today, date)
    return (F.when(age < 0, "forecast").when(age == 0, "nowcast").when(age < 7, "nrt").otherwise("final"))


def run_status(age_hours: Column) -> Column:
    return F.when(age_hours < 30, "Operational").when(age_hours < 72, "Delayed").otherwise("Stale")


# ---- labels ----
def sensor_family(network: Column) -> Column:
    n = F.lower(network)
    plantower = F.lit(False)
    for marker in P.PLANTOWER_MARKERS:
        plantower = plantower | n.contains(marker)
    return F.when(n.contains("clarity"), "clarity").when(plantower, "plantower-class").otherwise("other")


def network_key(country: Column, network: Column) -> Column:
    return F.concat_ws("|", country, network)


def aqi_category(pm: Column) -> Column:
    out = None
    for upper, label in P.AQI_CLASSES:
        out = F.when(pm <= upper, label) if out is None else out.when(pm <= upper, label)
    return F.when(pm.isNotNull(), out.otherwise(P.AQI_TOP_CLASS))


def aqi_value(pm: Column) -> Column:
    c = F.floor(pm * 10) / 10
    out = None
    for c_lo, c_hi, i_lo, i_hi in P.AQI_BREAKPOINTS:
        value = js_round(F.lit((i_hi - i_lo) / (c_hi - c_lo)) * (c - c_lo) + i_lo)
        out = F.when(c <= c_hi, value) if out is None else out.when(c <= c_hi, value)
    return F.when(pm.isNotNull(), out.otherwise(F.lit(500).cast("long"))).cast("int")


def exceeds(x: Column, threshold: float) -> Column:
    return x > threshold


def node_label(lat: Column, lon: Column) -> Column:
    """``lat_lon`` with two decimals; minus zero prints as zero."""
    return F.format_string("%.2f_%.2f", lat + F.lit(0.0), lon + F.lit(0.0))


def minute_of_day(granule_key: Column) -> Column:
    start = F.regexp_extract(granule_key, r"_s\d{8}(\d{6})", 1)
    return (F.substring(start, 1, 2).try_cast("int") * 60 + F.substring(start, 3, 2).try_cast("int")
            + F.substring(start, 5, 2).try_cast("int") / 60.0)


def in_overpass_window(minute: Column) -> Column:
    hit = F.lit(False)
    for start, end in P.OVERPASS_WINDOWS:
        hit = hit | minute.between(start, end) | (minute - 1440).between(start, end)
    return hit
