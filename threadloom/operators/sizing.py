"""Size checks used before choosing a plan shape."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

_POWERS = {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}
_UNKNOWN = 1 << 60


def _bytes(text: str) -> int:
    """A Spark size setting such as ``10485760b``, ``10m`` or ``1gb`` in bytes."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", text).groups()
    return int(number) << _POWERS[unit.lower()[:1]]


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where there is none.

    Rows from local Python objects have no known size, which Catalyst writes as
    a number near the largest long.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    size = int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN else None


def scanned_bytes(df: DataFrame) -> int:
    """Sum of the sizes of the tables that ``df`` reads, as far as they are known.

    The estimate of a join is a product and says nothing; what enters a shuffle
    is about what was scanned.  Only files and tables count: checkpoints carry
    the estimate of the plan that made them.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return 0
    leaves = plan.queryExecution().optimizedPlan().collectLeaves()
    tables = (leaf for i in range(leaves.size()) if "Relation" in (leaf := leaves.apply(i)).nodeName())
    sizes = (int(str(leaf.stats().sizeInBytes())) for leaf in tables)
    return sum(size for size in sizes if size < _UNKNOWN)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast ``df`` under the session's threshold."""
    size = estimated_bytes(df)
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return size is not None and 0 <= size <= limit


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy per-row work on an input with too few splits.

    A large input already has more splits than the cluster has cores and is
    returned as it is; only an input below ``cores x maxPartitionBytes`` is
    redistributed, so the shuffle stays bounded.
    """
    spark = df.sparkSession
    size = estimated_bytes(df)
    if size is None:
        return df
    cores = spark.sparkContext.defaultParallelism
    splits = math.ceil(size / _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    return df.repartition(cores) if splits < cores else df


def dealt_anew(df: DataFrame, column: str) -> Column:
    """The values of a long, text or binary column under which ``df`` is not known to be dealt.

    Adaptive execution splits the hot key of a join only if both sides come
    straight out of shuffles made for that join.  An aggregate by the key would
    serve the join as it is, and keep every hot key of the other side in one task.
    """
    kind = dict(df.dtypes)[column]
    if kind == "bigint":
        return F.col(column).bitwiseXOR(F.lit(0).cast("long"))
    return F.concat(F.col(column), F.lit("").cast(kind))
