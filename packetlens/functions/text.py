"""String helpers that agree with Python's ``str.strip`` and single-space splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points of every character ``str.strip`` removes.
WHITESPACE = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
              8232, 8233, 8239, 8287, 12288])
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def tokens(text: Column) -> Column:
    """Split on single spaces, keeping empty tokens."""
    return F.split(text, " ")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run once per row.

    A filter on a plain computed column is pushed below it and repeats its expression, which
    for string splitting costs more than the rows it saves. Generated columns stay put.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
