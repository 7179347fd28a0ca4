"""Unit conversions."""

from pyspark.sql import Column

# Fixed value: kilometres per mile.
KM_PER_MILE = 1.60934


def miles_to_km(miles: Column) -> Column:
    return (miles * KM_PER_MILE).cast("float")
