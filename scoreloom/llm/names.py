"""Names for columns that operators add for their own ends."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused_name(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
