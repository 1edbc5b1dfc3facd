"""Running sums over groups of any size.

A window over a whole group would sort that group in one task. Here rows are range-sorted
into blocks of about equal size, even inside one group; windows run per block, and what
crosses block borders is carried by a second window over one row per block.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.plans.saved import save

# Rows of a block: enough to fill a task, few enough to sort in its memory.
BLOCK_ROWS = 2_000_000
# With fewer rows the session's partitions are used, down to this size.
LEAST_BLOCK_ROWS = 200_000
# Beyond this many blocks they grow instead; tasks then spill.
MOST_BLOCKS = 50_000


def block_count(spark: SparkSession, rows: int) -> int:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = min(partitions, math.ceil(rows / LEAST_BLOCK_ROWS))
    return min(MOST_BLOCKS, max(1, spread, math.ceil(rows / BLOCK_ROWS)))


def in_ordered_blocks(df: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """Stored copy of ``df`` with ``block``: rows of a key in a lower block sort first.

    ``order`` must name a total order; the range partitioner then splits heavy keys and runs
    of equal times alike. Block numbers depend on sampled bounds, hence the stored copy: every
    later read, also after lost executors, sees the same blocks. The result has one partition
    per block, so that windows per key and block need no further shuffle and no two blocks
    meet in one task.
    """
    n = block_count(df.sparkSession, rows)
    placed = df.repartitionByRange(n, *keys, *order).withColumn("block", F.spark_partition_id())
    # The null checks are those of later joins on key and block; with them stated here, all
    # uses of the blocks share one shuffle.
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "block"]])
    return save(placed, "blocks").filter(keyed).repartitionById(n, "block")
