"""Change types of the feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, in upper case, of each change type.
SPELLINGS = {"I": ("I", "INSERT"), "U": ("U", "UPDATE"), "D": ("D", "DELETE")}


def change_type(text: Column) -> Column:
    """``I``, ``U`` or ``D``; any other text is an error when the row is evaluated."""
    upper = F.upper(text)
    parsed = F.lit(None).cast("string")
    for code, spellings in SPELLINGS.items():
        parsed = F.when(upper.isin(*spellings), code).otherwise(parsed)
    unknown = F.raise_error(F.concat(F.lit("unknown change type: "), F.coalesce(text, F.lit("null"))))
    return F.coalesce(parsed, unknown.cast("string"))
