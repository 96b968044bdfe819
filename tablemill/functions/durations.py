"""Duration text such as ``90``, ``1.5h`` or ``3 d`` as seconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted form, and seconds per unit (no unit means seconds).
DURATION_FORM = r"^(\d+(?:\.\d+)?)\s*([smhdw]?)$"
SECONDS_PER_UNIT = {"": 1, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def duration_seconds(text: Column) -> Column:
    """Seconds as a double; text of any other form fails the query, NULL stays NULL."""
    tidy = F.lower(F.trim(text.cast("string")))
    number = F.regexp_extract(tidy, DURATION_FORM, 1).try_cast("double")
    unit = F.regexp_extract(tidy, DURATION_FORM, 2)
    scale = F.create_map(*[F.lit(part) for item in SECONDS_PER_UNIT.items() for part in item])
    bad = F.raise_error(F.concat(F.lit("not a duration: "), tidy)).cast("double")
    return F.when(tidy.isNull(), None).when(tidy.rlike(DURATION_FORM), number * scale[unit]).otherwise(bad)
