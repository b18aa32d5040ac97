"""Map-point column functions (NUM-13, NUM-14, STR-20)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col

GOLDEN_ANGLE = math.pi * (3 - math.sqrt(5))
DEG_PER_METRE = 0.00001  # the reference's flat-earth buffer: 0.00001 degree per metre

# Bulgarian -> Latin transliteration (the official streamlined system), lower case.
BG_LATIN = [
    ("а", "a"), ("б", "b"), ("в", "v"), ("г", "g"), ("д", "d"), ("е", "e"), ("ж", "zh"), ("з", "z"),
    ("и", "i"), ("й", "y"), ("к", "k"), ("л", "l"), ("м", "m"), ("н", "n"), ("о", "o"), ("п", "p"),
    ("р", "r"), ("с", "s"), ("т", "t"), ("у", "u"), ("ф", "f"), ("х", "h"), ("ц", "ts"), ("ч", "ch"),
    ("ш", "sh"), ("щ", "sht"), ("ъ", "a"), ("ь", "y"), ("ю", "yu"), ("я", "ya"),
]


def golden_offset(lon, lat, k, n, radius: float = 0.01, phase: float = 0.0) -> tuple[Column, Column]:
    """NUM-13: k-th of n points on a golden-angle spiral of ``radius`` degrees around (lon, lat)."""
    kk = as_col(k).cast("double")
    theta = kk * F.lit(GOLDEN_ANGLE) + F.lit(phase)
    r = F.lit(radius) * F.sqrt(kk / as_col(n).cast("double"))
    return as_col(lon) + r * F.cos(theta), as_col(lat) + r * F.sin(theta)


def buffer_points(lon, lat, metres, segments: int = 64) -> Column:
    """NUM-14: closed ring of ``segments`` points (16 a quarter circle) at ``metres`` (a number or column) × 0.00001°
    around a point (array of structs)."""
    r = (as_col(metres) if isinstance(metres, (str, Column)) else F.lit(metres)) * F.lit(DEG_PER_METRE)
    step = 2 * math.pi / segments
    idx = F.sequence(F.lit(0), F.lit(segments))
    return F.transform(
        idx,
        lambda i: F.struct(
            (as_col(lon) + r * F.cos(i.cast("double") * F.lit(step))).alias("x"),
            (as_col(lat) + r * F.sin(i.cast("double") * F.lit(step))).alias("y"),
        ),
    )


def ring_wkt(points, decimals: int | None = None) -> Column:
    """WKT polygon text of a ring (SNK-12 geometry column), coordinates in full or with a fixed number of decimals."""
    text = (lambda v: v.cast("string")) if decimals is None else (lambda v: v.cast(f"decimal(20,{decimals})").cast("string"))
    coords = F.transform(as_col(points), lambda p: F.concat_ws(" ", text(p["x"]), text(p["y"])))
    return F.concat(F.lit("POLYGON(("), F.array_join(coords, ", "), F.lit("))"))


def slugify_bg(c) -> Column:
    """STR-20: transliterate Bulgarian to Latin and slugify (lower, non-alphanumerics -> ``-``, trimmed).

    Null, empty and the text ``nan`` pass through unchanged.
    """
    s = F.lower(as_col(c))
    # multi-letter sounds first, then one translate for the one-to-one letters
    for cyr, lat in BG_LATIN:
        if len(lat) > 1:
            s = F.replace(s, F.lit(cyr), F.lit(lat))
    one = [(cyr, lat) for cyr, lat in BG_LATIN if len(lat) == 1]
    s = F.translate(s, "".join(c for c, _ in one), "".join(lt for _, lt in one))
    slug = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    raw = as_col(c)
    return F.when(raw.isNull() | raw.isin("", "nan"), raw).otherwise(slug)
