"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a word; what separates words is ASCII white space only
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"


def n_words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame) -> Column:
    """All columns of df as one struct, so that the columns an operator adds can't clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def unpacked(names: Sequence[str], without: Sequence[str] = (), row: str = "row") -> list[Column]:
    """The columns `names` of a packed row, but for those in `without`."""
    return [F.col(row).getField(c).alias(c) for c in names if c not in without]
