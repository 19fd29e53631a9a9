"""Is this side small enough to broadcast?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import BROADCAST_BYTES, setting


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Estimated size of everything the frame reads. Unlike the estimate of a join it does not multiply up."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def measured_bytes(df: DataFrame) -> int:
    """Row count and text lengths, from one aggregate that reads the narrow side only."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    width = 16 * len(df.columns)
    lengths = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("long") for c in text]
    per_row = reduce(lambda x, y: x + y, lengths, F.lit(width).cast("long"))
    return int(df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0])


def multiplies(df: DataFrame) -> bool:
    """Does the frame explode rows? The optimizer's estimate does not count what a generator adds: it is too low then."""
    open_nodes = [df._jdf.queryExecution().optimizedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        if node.nodeName() == "Generate":
            return True
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return False


def estimated_small(df: DataFrame) -> bool:
    """True if the estimate is below the broadcast limit of the session, and no generator makes it too low."""
    return estimated_bytes(df) <= setting(df.sparkSession, BROADCAST_BYTES) and not multiplies(df)


def measured_small(df: DataFrame) -> bool:
    """Same, but counts when the estimate is too high: filters and grouping make it far too pessimistic."""
    return estimated_small(df) or measured_bytes(df) <= setting(df.sparkSession, BROADCAST_BYTES)
