"""Value expressions: null handling, unit conversion, casts, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions._util import col


def zero_if_null(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def ms_to_kmh(c, strict: bool = True) -> Column:
    """m/s -> km/h; ``strict=False`` turns unparsable text into NULL."""
    v = col(c).cast("double") if strict else col(c).try_cast("double")
    return v * F.lit(3.6)


def estimate_int(c, strict: bool = False) -> Column:
    """Visitor estimate as int, a fraction cut off (12.7 -> 12); NULL on junk unless strict."""
    number = col(c).cast("decimal(38,9)") if strict else col(c).try_cast("decimal(38,9)")
    return number.cast("int") if strict else number.try_cast("int")


def json_in(c, schema) -> Column:
    """Parse JSON text; malformed text gives a struct of NULLs."""
    return F.from_json(col(c), schema)


def json_out(**fields) -> Column:
    """Serialise named columns as one JSON object."""
    return F.to_json(F.struct(*[col(v).alias(k) for k, v in fields.items()]))
