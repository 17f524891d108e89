"""British National Grid easting and northing to WGS84 latitude and longitude, as column arithmetic.

The steps are the published ones: inverse transverse Mercator on the Airy 1830 ellipsoid, a seven-parameter datum
shift, and cartesian to geodetic on the target ellipsoid. Both inversions that are usually iterated are done in closed
form, the footpoint latitude by its series and the geodetic latitude by Bowring's formula; the first is then sharpened
by one Newton step. So a row costs a dozen trigonometric calls, and the generated code stays small enough for the JIT
compiler, which it does not with unrolled iterations. Every step is a column of its own so that no expression is
repeated inside another one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import number

# Semi-axes of the Airy 1830 and the WGS84/GRS80 ellipsoids, in metres.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
WGS_A, WGS_B = 6378137.000, 6356752.3141
# Central scale and true origin of the grid.
SCALE = 0.9996012717
ORIGIN_LAT, ORIGIN_LON = math.radians(49.0), math.radians(-2.0)
ORIGIN_EASTING, ORIGIN_NORTHING = 400000.0, -100000.0
# Datum shift, in metres, parts per million and seconds of arc.
SHIFT_X, SHIFT_Y, SHIFT_Z = 446.448, -125.157, 542.060
SHIFT_PPM = -20.4894
TURN_X, TURN_Y, TURN_Z = 0.1502, 0.2470, 0.8421

AIRY_E2 = 1 - (AIRY_B * AIRY_B) / (AIRY_A * AIRY_A)
WGS_E2 = 1 - (WGS_B * WGS_B) / (WGS_A * WGS_A)
WGS_SECOND_E2 = (WGS_A * WGS_A) / (WGS_B * WGS_B) - 1
THIRD = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)


# Series of the meridian arc in the third flattening: factors of the latitude and of the sines of its multiples.
ARC = (
    AIRY_B * SCALE * (1 + THIRD + 5 / 4 * THIRD**2 + 5 / 4 * THIRD**3),
    AIRY_B * SCALE * (3 * THIRD + 3 * THIRD**2 + 21 / 8 * THIRD**3) / 2,
    AIRY_B * SCALE * (15 / 8 * THIRD**2 + 15 / 8 * THIRD**3) / 2,
    AIRY_B * SCALE * (35 / 24 * THIRD**3) / 2,
)


def _arc(lat, sin2, sin4, sin6):
    """Length of the meridian from the equator, of numbers or of columns."""
    return ARC[0] * lat - ARC[1] * sin2 + ARC[2] * sin4 - ARC[3] * sin6


ORIGIN_ARC = _arc(ORIGIN_LAT, *[math.sin(k * ORIGIN_LAT) for k in (2, 4, 6)])


def _with_airy_radians(df: DataFrame, easting: str, northing: str, lat: str, lon: str) -> DataFrame:
    """Adds latitude and longitude on the grid's own datum, in radians."""
    n = THIRD
    out = df.withColumn("_g_arc", number(northing) - ORIGIN_NORTHING + ORIGIN_ARC)
    out = out.withColumn("_g_mu", F.col("_g_arc") / ARC[0])
    out = out.withColumns({"_g_s": F.sin(2 * F.col("_g_mu")), "_g_c": F.cos(2 * F.col("_g_mu"))})
    s, c = F.col("_g_s"), F.col("_g_c")
    out = out.withColumn(
        "_g_foot",
        F.col("_g_mu")
        + (3 / 2 * n - 27 / 32 * n**3) * s
        + (21 / 16 * n**2 - 55 / 32 * n**4) * 2 * s * c
        + 151 / 96 * n**3 * s * (3 - 4 * s * s)
        + 1097 / 512 * n**4 * 4 * s * c * (1 - 2 * s * s),
    )
    foot = F.col("_g_foot")
    # One Newton step takes the footpoint from a tenth of a millimetre to the limit of the arc series.
    out = out.withColumns({"_g_s": F.sin(2 * foot), "_g_c": F.cos(2 * foot)})
    rest = F.col("_g_arc") - _arc(foot, s, 2 * s * c, s * (3 - 4 * s * s))
    out = out.withColumn("_g_foot", foot + rest * (1 / (AIRY_A * SCALE)))
    out = out.withColumns({"_g_sin": F.sin(foot), "_g_cos": F.cos(foot)})
    out = out.withColumn("_g_tan", F.col("_g_sin") / F.col("_g_cos"))
    out = out.withColumns({
        "_g_flat": 1 - AIRY_E2 * F.col("_g_sin") * F.col("_g_sin"),
        "_g_t2": F.col("_g_tan") * F.col("_g_tan"),
    })
    flat, t2 = F.col("_g_flat"), F.col("_g_t2")
    out = out.withColumns({
        "_g_u": (number(easting) - ORIGIN_EASTING) / (AIRY_A * SCALE) * F.sqrt(flat),
        # Ratio of the two radii of curvature.
        "_g_q": flat / (1 - AIRY_E2),
    })
    u, q = F.col("_g_u"), F.col("_g_q")
    out = out.withColumn("_g_u2", u * u)
    u2 = F.col("_g_u2")
    north_terms = (
        1
        - u2 / 12 * (5 + 3 * t2 + (q - 1) - 9 * t2 * (q - 1))
        + u2 * u2 / 360 * (61 + 90 * t2 + 45 * t2 * t2)
    )
    east_terms = (
        1
        - u2 / 6 * (q + 2 * t2)
        + u2 * u2 / 120 * (5 + 28 * t2 + 24 * t2 * t2)
        - u2 * u2 * u2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
    )
    return out.withColumns({
        lat: foot - F.col("_g_tan") * q * u2 / 2 * north_terms,
        lon: ORIGIN_LON + u / F.col("_g_cos") * east_terms,
    })


def with_wgs84(
    df: DataFrame, easting: str, northing: str, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Adds WGS84 latitude and longitude in degrees."""
    out = _with_airy_radians(df, easting, northing, "_g_lat", "_g_lon")
    out = out.withColumns({"_g_sin": F.sin("_g_lat"), "_g_cos": F.cos("_g_lat")})
    out = out.withColumn("_g_nu", AIRY_A / F.sqrt(1 - AIRY_E2 * F.col("_g_sin") * F.col("_g_sin")))
    out = out.withColumn("_g_r", F.col("_g_nu") * F.col("_g_cos"))
    out = out.withColumns({
        "_g_x": F.col("_g_r") * F.cos("_g_lon"),
        "_g_y": F.col("_g_r") * F.sin("_g_lon"),
        "_g_z": F.col("_g_nu") * (1 - AIRY_E2) * F.col("_g_sin"),
    })
    x, y, z = F.col("_g_x"), F.col("_g_y"), F.col("_g_z")
    grow = 1 + SHIFT_PPM * 1e-6
    rx, ry, rz = (math.radians(turn / 3600) for turn in (TURN_X, TURN_Y, TURN_Z))
    out = out.withColumns({
        "_g_x": SHIFT_X + grow * x - rz * y + ry * z,
        "_g_y": SHIFT_Y + rz * x + grow * y - rx * z,
        "_g_z": SHIFT_Z - ry * x + rx * y + grow * z,
    })
    out = out.withColumn("_g_p", F.sqrt(x * x + y * y))
    out = out.withColumn("_g_tan", z * (WGS_A / WGS_B) / F.col("_g_p"))
    out = out.withColumn("_g_cos", 1 / F.sqrt(1 + F.col("_g_tan") * F.col("_g_tan")))
    out = out.withColumn("_g_sin", F.col("_g_tan") * F.col("_g_cos"))
    sin, cos = F.col("_g_sin"), F.col("_g_cos")
    height = z + WGS_SECOND_E2 * WGS_B * sin * sin * sin
    distance = F.col("_g_p") - WGS_E2 * WGS_A * cos * cos * cos
    # The generator keeps filters on the position above this point; pushed down, they would unfold the whole chain.
    place = F.struct(
        F.degrees(F.atan2(height, distance)).alias(latitude), F.degrees(F.atan2(y, x)).alias(longitude)
    )
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in (latitude.lower(), longitude.lower())]
    return out.select(*kept, F.inline(F.array(place)))
