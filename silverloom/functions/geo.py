"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
UNITS = {"mi": 1.0, "km": 1.60934}


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    a1, o1, a2, o2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))
    half_chord = (
        F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    )
    return F.asin(F.sqrt(half_chord)) * (2 * EARTH_RADIUS_MILES * UNITS[unit])
