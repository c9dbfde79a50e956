"""The join used wherever one key may hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys adaptive execution can split over several tasks.

    A side that was grouped or ranked by the key just before would lend its shuffle
    to a plain join, and only a shuffle made for the join itself is split. The hash
    of the key as one more join key makes Spark shuffle for the join. A side small
    enough to broadcast is still broadcast.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for key in keys:
        kinds = [df.schema[key].dataType for df in (left, right)]
        if kinds[0] != kinds[1]:
            raise TypeError(f"{key} is {kinds[0]} on one side and {kinds[1]} on the other")
    tag = F.xxhash64(*keys)
    joined = left.withColumn("_tag", tag).join(right.withColumn("_tag", tag), [*keys, "_tag"], how)
    return joined.drop("_tag")
