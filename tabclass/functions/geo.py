"""Great-circle distance."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabclass.functions.casts import ColumnOrName, _col

# Fixed value that must equal the reference: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName
) -> Column:
    """Haversine distance in km between two points given in degrees.

    ``1 - a`` is floored at 0: rounding can push ``a`` a hair above 1 for
    antipodal points, and the square root of a negative number is NaN, which a
    later ``dropna`` would silently remove.
    """
    p1, q1 = F.radians(_col(lat1)), F.radians(_col(lon1))
    p2, q2 = F.radians(_col(lat2)), F.radians(_col(lon2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((q2 - q1) / 2), 2)
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))
    return (F.lit(EARTH_RADIUS_KM) * c).cast("double")
