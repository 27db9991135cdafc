"""Small helpers on columns and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word, as in ledgerlens.llm.words, for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, lengthened until no column of the table has them."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def n_words(text: str) -> Column:
    """How many words a text has; none where it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return df[f"`{name.replace('`', '``')}`"]
