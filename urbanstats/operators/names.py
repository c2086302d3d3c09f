"""Names for helper columns."""

from pyspark.sql.types import StructType


def unused(base, *tables):
    """``base``, with underscores added until no table or schema has a column of that name."""
    taken = {name.lower() for t in tables for name in (t.names if isinstance(t, StructType) else t.columns)}
    while base.lower() in taken:
        base += "_"
    return base
