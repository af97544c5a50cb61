"""Reading counts out of short labels such as ``1.2K`` or ``34 Likes``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT = r"([0-9,.]+[\t-\r\x1c-\x20\x85\p{Z}]*[kKmMbB]?)"
STRICT_COUNT = r"([0-9,.]+(?:[\t-\r\x1c-\x20\x85\p{Z}]*[kKmMbB](?![\p{L}\p{N}_]))?)"


def parse_count(text: Column, strict_suffix: bool = False) -> Column:
    """First number of a label with its K/M/B suffix, as long; 0 when there is none.

    The suffix may be the first letter of the next word (``12 more`` is 12 million).
    ``strict_suffix`` only takes a suffix that ends its word.
    """
    raw = F.regexp_extract(text, STRICT_COUNT if strict_suffix else COUNT, 1)
    number = F.regexp_extract(F.replace(raw, F.lit(","), F.lit("")), r"^([0-9.]*)", 1).try_cast("double")
    suffix = F.lower(F.right(raw, F.lit(1)))
    scale = (
        F.when(suffix == "k", F.lit(1e3)).when(suffix == "m", F.lit(1e6)).when(suffix == "b", F.lit(1e9)).otherwise(1.0)
    )
    return F.coalesce((number * scale).try_cast("bigint"), F.lit(0).cast("bigint"))
