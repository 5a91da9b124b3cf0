"""Last known values along the log of a key, however much of the log one key has."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import workspace


def written(df: DataFrame, name: str = "scan") -> DataFrame:
    """``df`` written to the shared folder and read back, so that what follows does not compute it again."""
    path = workspace.path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_known(df: DataFrame, keys: list[str], order: list[str], values: dict[str, C], reset: C | None = None) -> DataFrame:
    """``df`` with a column per entry of ``values``: its last value that is not null, among the key's rows up to each row.

    Rows are in order of ``order``; after a row where ``reset`` holds nothing is
    known until there is a value again. A null key is a key.

    Rows are dealt by ranges of key and order, so a key with many rows is in many
    lots, and each lot is scanned for itself. Only the first and the last key of a
    lot can be in others too: what is known at their end is one row a lot, and is
    carried to the lots that follow.
    """
    named = df.withColumn("_reset", F.coalesce(reset, F.lit(False)) if reset is not None else F.lit(False))
    place = {n: i for i, n in enumerate(values)}
    named = named.withColumns({f"_v{place[n]}": v for n, v in values.items()})
    lots = written(named.repartitionByRange(*keys, *order).withColumn("_lot", F.spark_partition_id()))
    in_lot = Window.partitionBy(*keys, "_lot").orderBy(*order)
    rows = lots.withColumn(
        "_segment", F.coalesce(F.sum(F.col("_reset").cast("long")).over(in_lot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    so_far = Window.partitionBy(*keys, "_lot", "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_l{i}": F.last(f"_v{i}", ignorenulls=True).over(so_far) for i in place.values()})

    key = F.struct(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
    # Two rows a lot at most, so these tables may be broadcast.
    edges = lots.groupBy("_lot").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    at_edge = rows.withColumn("_key", key).join(F.broadcast(edges), "_lot").filter("_key = _first or _key = _last")
    end = F.struct(*(F.when(~F.col("_reset"), F.col(f"_l{i}")).alias(f"_e{i}") for i in place.values()))
    ends = at_edge.groupBy("_key", "_lot").agg(F.max_by(end, F.struct(*order)).alias("_end"), F.max("_reset").alias("_any"))
    earlier = Window.partitionBy("_key").orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_lot").alias("_to"), F.col("_key"),
        *(
            F.last(F.when(F.col("_any") | F.col(f"_end._e{i}").isNotNull(), F.struct(F.col(f"_end._e{i}").alias("v"))), ignorenulls=True).over(earlier).alias(f"_c{i}")
            for i in place.values()
        ),
    )
    known = reduce(lambda a, b: a | b, (F.col(f"_c{i}").isNotNull() for i in place.values()))
    carried = F.broadcast(written(carried.filter(known)))
    same = reduce(
        lambda a, i: a & F.col(keys[i]).eqNullSafe(F.col(f"_key._k{i}")), range(len(keys)), F.col("_lot") == F.col("_to")
    )
    out = {n: F.coalesce(f"_l{i}", F.when(F.col("_segment") == 0, F.col(f"_c{i}.v"))) for n, i in place.items()}
    return rows.join(carried, same, "left").select(*(F.col(f"`{c}`") for c in df.columns), *(v.alias(n) for n, v in out.items()))
