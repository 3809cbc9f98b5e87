from pyspark.sql import Column, functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c
