"""Column functions: parsing, angles, geography, predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
MERCATOR_RADIUS_M = 6_378_137.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Text or number as a double; null where it is neither, and for NaN."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def hhmmss_to_seconds(c: Column | str) -> Column:
    """`HHMMSS.ss` as seconds of the day, short values padded from the left."""
    parts = F.split(F.trim(col(c).cast("string")), r"\.")
    whole = F.lpad(parts[0], 6, "0")
    clock = (
        whole.substr(1, 2).try_cast("double") * 3600
        + whole.substr(3, 2).try_cast("double") * 60
        + whole.substr(5, 2).try_cast("double")
    )
    fraction = F.concat(F.lit("0."), F.coalesce(F.get(parts, 1), F.lit("0"))).try_cast("double")
    return clock + fraction


def parse_degree_minutes(c: Column | str, plain_float: bool = True) -> Column:
    """`24°44.742936 N` in signed degrees, south and west negative (P5)."""
    text = F.trim(col(c).cast("string"))
    # fixed value: the logger's format
    shape = r"^(\d+)\s*[°º]\s*([\d.]+)\s*'?\s*([NSEWnsew])"
    degrees = F.regexp_extract(text, shape, 1).try_cast("double")
    minutes = F.regexp_extract(text, shape, 2).try_cast("double")
    hemisphere = F.upper(F.regexp_extract(text, shape, 3))
    sign = F.when(hemisphere.isin("S", "W"), -1.0).otherwise(1.0)
    parsed = sign * (degrees + minutes / 60.0)
    return F.coalesce(parsed, text.try_cast("double")) if plain_float else parsed


def stamp_to_epoch(c: Column | str, utc_offset_h: int = 3, micros: bool = False) -> Column:
    """First `YYYY-MM-DD_HH-MM-SS[-fraction]` in a text as epoch seconds."""
    # fixed value: the recorder's file names
    shape = r"(\d{4}-\d{2}-\d{2})_(\d{2})-(\d{2})-(\d{2})(?:-(\d+))?"

    def part(n: int) -> Column:
        return F.regexp_extract(col(c), shape, n)

    day = F.datediff(part(1).try_cast("date"), F.lit("1970-01-01").cast("date"))
    clock = (
        part(2).try_cast("bigint") * 3600 + part(3).try_cast("bigint") * 60 + part(4).try_cast("bigint")
    )
    whole = day.cast("bigint") * 86_400 + clock - utc_offset_h * 3600
    if not micros:
        return whole.cast("double")
    fraction = F.coalesce(F.rpad(part(5), 6, "0").try_cast("double"), F.lit(0.0)) / 1e6
    return whole + fraction


def stamp_date(c: Column | str) -> Column:
    """The date inside a file name, as a date."""
    return F.regexp_extract(col(c), r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def wrapped_diff(h0: Column | str, h1: Column | str) -> Column:
    """Change of angle from h0 to h1 in [-180, 180) degrees (P10)."""
    return F.pmod(col(h1) - col(h0) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    dlat = F.radians(col(lat2) - col(lat1)) / 2
    dlon = F.radians(col(lon2) - col(lon1)) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * F.sin(
        dlon
    ) * F.sin(dlon)
    return F.asin(F.sqrt(a)) * 2 * EARTH_RADIUS_M


def web_mercator(lon, lat) -> Column:
    """Web-Mercator metres as struct<x, y>."""
    x = F.radians(col(lon)) * MERCATOR_RADIUS_M
    y = F.ln(F.tan(F.radians(col(lat)) / 2 + F.lit(0.7853981633974483))) * MERCATOR_RADIUS_M
    return F.struct(x.alias("x"), y.alias("y"))


def magnitude(*axes) -> Column:
    """Length of a vector."""
    return F.sqrt(reduce(lambda a, b: a + b, [col(a) * col(a) for a in axes]))


def clip(c, limit: float) -> Column:
    """Value held within +-limit."""
    return F.greatest(F.least(col(c), F.lit(float(limit))), F.lit(-float(limit)))


def in_bbox(lat, lon, box: Mapping[str, float]) -> Column:
    """Inside a latitude / longitude box; null coordinates are outside."""
    inside = col(lat).between(box["lat0"], box["lat1"]) & col(lon).between(box["lon0"], box["lon1"])
    return F.coalesce(inside, F.lit(False))


def validity(ranges: Mapping[str, tuple[float, float]], flags: Mapping[str, str]) -> dict[str, Column]:
    """`<column>_valid` columns from plausible ranges and dropout flags."""
    out = {}
    for c in [*ranges, *[f for f in flags if f not in ranges]]:
        ok = F.coalesce(F.col(c).between(*ranges[c]), F.lit(False)) if c in ranges else F.lit(True)
        if c in flags:
            ok = ok & ~F.coalesce(F.col(flags[c]), F.lit(True))
        out[f"{c}_valid"] = ok
    return out


def region_proxy(points: Sequence[tuple[str, str]], box: tuple[float, float, float, float], detected) -> Column:
    """Share of points inside a rectangle; null without a detection, a missing point is outside."""
    x0, x1, y0, y1 = box
    inside = [
        F.coalesce(col(x).between(x0, x1) & col(y).between(y0, y1), F.lit(False)).cast("double")
        for x, y in points
    ]
    share = reduce(lambda a, b: a + b, inside) / len(points)
    return F.when(col(detected), share)


def resolve_priority(masks: Sequence[tuple[str, Column | str]], default: str = "Normal") -> Column:
    """Class of the first true mask."""
    out = None
    for name, m in masks:
        out = (F if out is None else out).when(F.coalesce(col(m), F.lit(False)), F.lit(name))
    return out.otherwise(F.lit(default))


def time_to_frame(u, t0, fps) -> Column:
    """Frame shown at time `u` of a video that starts at `t0`."""
    rate = col(fps) if isinstance(fps, (str, Column)) else F.lit(float(fps))
    return F.greatest(F.lit(0).cast("bigint"), F.rint((col(u) - col(t0)) * rate).cast("bigint"))


def is_channel(c, prefixes: Sequence[str]) -> Column:
    """Whether a column or channel name starts with one of the prefixes (P20)."""
    return reduce(lambda a, b: a | b, [col(c).startswith(p) for p in prefixes])
