"""Gear text to gear number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions.text import strip_upper

UNKNOWN_GEAR = -1

# Accepted spellings of each gear, after trimming and upper-casing.
GEAR_SPELLINGS: dict[int, list[str]] = {
    -1: ["-1", "", "UNKNOWN", "NULL"],
    0: ["0", "P", "PARK"],
    1: ["1", "R", "REVERSE"],
    2: ["2", "N", "NEUTRAL"],
    3: ["3", "D", "DRIVE"],
    4: ["4", "L", "LOW"],
    5: ["5"],
    6: ["6"],
}
VALID_GEARS = sorted(GEAR_SPELLINGS)


def gear_number(c: Column) -> Column:
    """Null stays null; an unlisted spelling is the unknown gear."""
    lookup = F.create_map(
        *[F.lit(x) for n, texts in GEAR_SPELLINGS.items() for t in texts for x in (t, n)]
    )
    found = lookup[strip_upper(c)].cast("bigint")
    return F.when(c.isNotNull(), F.coalesce(found, F.lit(UNKNOWN_GEAR).cast("bigint")))
