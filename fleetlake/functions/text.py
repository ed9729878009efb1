"""Whitespace trimming beyond the blank-only ``trim``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points of the Unicode White_Space property.
UNICODE_SPACES = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Python's ``str.strip`` also removes the four separator control characters.
PYTHON_SPACES = UNICODE_SPACES + "".join(chr(c) for c in range(0x1C, 0x20))


def strip(c: Column) -> Column:
    """Both-end strip with Python's whitespace set; null stays null, blank becomes ``''``."""
    return F.btrim(c, F.lit(PYTHON_SPACES))


def strip_unicode(c: Column) -> Column:
    """Both-end strip with the Unicode White_Space set (column-wise cleaning in Silver)."""
    return F.btrim(c, F.lit(UNICODE_SPACES))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def pad2(c: Column) -> Column:
    """Left-pad with zeros to two characters; longer text is kept (``lpad`` alone would cut it)."""
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def is_one_value(text: Column) -> Column:
    """Whether the text holds one JSON value and nothing after it.

    JSON readers stop at the end of the first value. As the only item of a list, text after it
    breaks the list or adds an item, unless it begins with the list's end; then the text is
    also tried as the value of an object, where that is a fault.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    items = F.coalesce(F.json_array_length(listed), F.size(F.from_json(listed, "array<string>")))
    keyed = F.concat(F.lit('{"a":'), text, F.lit(',"b":1}'))
    keys = F.coalesce(F.size(F.json_object_keys(keyed)), F.size(F.from_json(keyed, "map<string,string>")))
    ends_list = text.rlike(r"[}\]]\s*\]")
    return F.coalesce((items == 1) & (~ends_list | (keys == 2)), F.lit(False))
