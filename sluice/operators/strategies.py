"""Write strategies as functions of (target, staged) to the target's new rows.

Keys compare with plain equality, so a row with a null key matches nothing and
is inserted by every load. Staged rows that repeat a key are reduced to the
latest one first where a strategy says so.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import BOOKKEEPING
from .dedup import has_repeats, latest
from .transforms import align

REPLACE, APPEND, DELETE_INSERT, MERGE, SCD2 = STRATEGIES = ("replace", "append", "delete+insert", "merge", "scd2")


def _one_per_key(staged: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """Latest row of each key; rows with a null in the key stay, since they equal nothing."""
    whole = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    one = latest(staged.filter(whole), keys, order)
    if any(f.nullable for f in staged.schema.fields if f.name in keys):
        return one.unionByName(staged.filter(~whole))
    return one


def replace(target: DataFrame | None, staged: DataFrame, keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """The staged rows alone, one per key if there are keys."""
    return _one_per_key(staged, keys, order) if keys else staged


def append(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Target and staged rows; nothing is looked up."""
    return target.unionByName(staged, allowMissingColumns=True)


def delete_insert(
    target: DataFrame, staged: DataFrame, key: str, low=None, high=None, keys: list[str] | None = None
) -> DataFrame:
    """Target rows within ``[low, high]`` of ``key`` give way to the staged ones.

    Without bounds the staged minimum and maximum are used; an empty load then
    changes nothing, while explicit bounds delete even without new rows. All
    staged rows go in, also those outside the bounds. A DATE key compares by date.
    """
    kind = target.schema[key].dataType
    rows = _one_per_key(staged, keys, key) if keys else staged
    if low is None and high is None:
        bounds = staged.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
        joined = target.join(F.broadcast(bounds))  # one row
        inside = F.col(key).between(F.col("_lo").cast(kind), F.col("_hi").cast(kind))
        left = joined.filter(~F.coalesce(inside, F.lit(False))).drop("_lo", "_hi")
    else:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(key) >= F.lit(low).cast(kind))
        if high is not None:
            inside = inside & (F.col(key) <= F.lit(high).cast(kind))
        left = target.filter(~F.coalesce(inside, F.lit(False)))
    return left.unionByName(rows, allowMissingColumns=True).select(target.columns)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(prefix + c) for c in df.columns), F.lit(True).alias(prefix))


def merge(target: DataFrame, staged: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Upsert: matched rows take all staged columns, unmatched ones are inserted, the rest stays.

    One full outer join, which keeps the partitioning of the staged rows'
    deduplication. Rows with a null in the key match nothing; they pass beside
    the join, so that they do not meet in one task. Columns that only the target
    has are kept on update and null on insert.
    """
    whole = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    t, s = _prefixed(target.filter(whole), "t_"), _prefixed(latest(staged.filter(whole), keys, order), "s_")
    match = reduce(lambda a, k: a & (F.col(f"t_{k}") == F.col(f"s_{k}")), keys, F.lit(True))
    joined = t.join(s, match, "full_outer")
    have = set(staged.columns)
    taken = lambda c: F.when(F.col("s_"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")) if c in have else F.col(f"t_{c}")
    merged = joined.select(*(taken(c).alias(c) for c in target.columns))
    for side in (target, staged):
        if any(f.nullable for f in side.schema.fields if f.name in keys):
            merged = merged.unionByName(side.filter(~whole), allowMissingColumns=True).select(target.columns)
    return merged


def merge_where(target: DataFrame, staged: DataFrame, keys: list[str], predicate: C, order: str | None = None) -> DataFrame:
    """Upsert in which only target rows that meet ``predicate`` can match.

    A staged row whose key exists only outside the predicate is inserted beside
    that row. Inserts are decided on the target before the update, so a row
    that the update moves out of the predicate is not inserted a second time.
    """
    open_rows = target.filter(predicate)
    closed = target.filter(~F.coalesce(predicate, F.lit(False)))
    return merge(open_rows, staged, keys, order).unionByName(closed)


def merge_into_empty(staged: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Staged rows as they are where no key repeats, else one per key."""
    return _one_per_key(staged, keys, order) if has_repeats(staged, keys) else staged


def upsert(target: DataFrame, staged: DataFrame, keys: list[str], order: str | None = None, predicate: C | None = None) -> DataFrame:
    """The merge that fits: into an empty target, with a predicate, or plain."""
    if target.isEmpty():
        return align(merge_into_empty(staged, keys, order), target.schema)
    return merge_where(target, staged, keys, predicate, order) if predicate is not None else merge(target, staged, keys, order)


SCD = (("_scd_valid_from", T.TimestampType()), ("_scd_valid_to", T.TimestampType()), ("_scd_is_current", T.BooleanType()))


def scd2_first(staged: DataFrame, stamp, incremental_key: str | None = None) -> DataFrame:
    """A history's first load: every staged row is current from its key's time, or the run's."""
    start = F.col(incremental_key).cast("timestamp") if incremental_key else F.lit(stamp).cast("timestamp")
    return staged.withColumns({"_scd_valid_from": start, "_scd_valid_to": F.lit(None).cast("timestamp"), "_scd_is_current": F.lit(True)})


def scd2(target: DataFrame, staged: DataFrame, keys: list[str], stamp, incremental_key: str | None = None) -> DataFrame:
    """Slowly changing history: changed current rows are closed and their successors added.

    A current row whose data differs, null-safely, from the staged row is closed at
    the successor's start. Without an incremental key, current rows that are
    missing from the load are closed at the run's time. Staged rows that have no
    current row after that are inserted. Staged rows that repeat a key are all
    used, as the history may hold several steps of one load.
    """
    data = [c for c in staged.columns if c not in keys and c.lower() not in BOOKKEEPING]
    new = scd2_first(staged, stamp, incremental_key)
    match = lambda a, b: reduce(lambda x, k: x & (F.col(f"{a}{k}") == F.col(f"{b}{k}")), keys, F.lit(True))
    old = target.filter(~F.coalesce("_scd_is_current", F.lit(False)))
    # Per current row: whether any staged row of its key differs, and the start of the first that does. The rows
    # of a key are joined and summed up with map-side combination, never gathered.
    t = _prefixed(target.filter("_scd_is_current").withColumn("_row", F.monotonically_increasing_id()), "t_")
    s = _prefixed(new.select(*keys, *data, "_scd_valid_from"), "s_")
    same = reduce(lambda a, c: a & F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")), data, F.lit(True))
    differs = F.coalesce(F.col("s_"), F.lit(False)) & ~same
    joined = t.join(s, match("t_", "s_"), "left").groupBy("t__row").agg(
        F.first(F.struct(*(f"t_{c}" for c in target.columns))).alias("_t"), F.max(differs).alias("_changed"),
        F.min(F.when(differs, F.col("s__scd_valid_from"))).alias("_end"), F.count("s_").alias("_seen"),
    ).select("_t.*", "_changed", "_end", "_seen")
    changed, missing = F.col("_changed"), (F.col("_seen") == 0) & F.lit(incremental_key is None)
    end = F.when(changed, F.col("_end")).when(missing, F.lit(stamp).cast("timestamp"))
    closed = changed | missing
    values = {
        "_scd_valid_to": F.when(closed, end).otherwise(F.col("t__scd_valid_to")),
        "_scd_is_current": ~closed,
    }
    kept = joined.select(*(values.get(c, F.col(f"t_{c}")).alias(c) for c in target.columns), (~closed).alias("_open"))
    still = kept.filter("_open").select(*keys).distinct()
    added = new.join(still, keys, "left_anti")
    return old.unionByName(kept.drop("_open")).unionByName(align(added, target.schema))


def resolve(explicit: str | None, source_default: str | None = None, streaming: bool = False, full_refresh: bool = False,
            is_cdc: bool = False, keys: list[str] | None = None) -> str:
    """The strategy of a load: explicit, else the source's, else the streaming default, else replace."""
    if full_refresh and not streaming:
        return REPLACE
    chosen = explicit or source_default or ((MERGE if keys else APPEND) if streaming else REPLACE)
    if is_cdc and chosen == REPLACE:
        return MERGE if keys else APPEND
    return chosen


def validate(strategy: str, keys: list[str] | None = None, incremental_key: str | None = None, start=None, end=None,
             streaming: bool = False, partition_by: str | None = None) -> None:
    """Arguments that cannot go together are errors."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy in (MERGE, SCD2) and not keys:
        raise ValueError(f"{strategy} needs a primary key")
    if strategy == DELETE_INSERT and not incremental_key:
        raise ValueError("delete+insert needs an incremental key")
    if start is not None and end is not None and not start < end:
        raise ValueError("the interval's start must lie before its end")
    if streaming and strategy not in (MERGE, APPEND):
        raise ValueError("streams load by merge or append")
    if strategy == SCD2 and partition_by and not incremental_key:
        raise ValueError("scd2 with partitioned extraction needs an incremental key")


#: Strategies by kind of sink.
SUPPORT = {
    "table": set(STRATEGIES), "file": {REPLACE, APPEND}, "keyvalue": {REPLACE, APPEND, MERGE}, "discard": set(STRATEGIES),
}


def check_support(sink: str, strategy: str) -> None:
    if strategy not in SUPPORT[sink]:
        raise ValueError(f"a {sink} sink does not load by {strategy}")


def touched(strategy: str, target: DataFrame, staged: DataFrame, parts: list[str], keys: list[str] | None = None,
            incremental_key: str | None = None, low=None, high=None) -> DataFrame:
    """Values of the partition columns ``parts`` whose rows a merge or delete+insert may change, repeats included.

    Those of the staged rows, and those of target rows that match a staged key or
    lie in the interval; of the target only these columns are read. Keys that hold
    all partition columns cannot match in another partition.
    """
    own = staged.select(parts)
    if strategy == MERGE and not set(parts) <= set(keys):
        return own.union(target.join(staged.select(keys), keys, "left_semi").select(parts))
    if strategy == DELETE_INSERT:
        inside = target.select(*dict.fromkeys([*parts, incremental_key]))
        kind = target.schema[incremental_key].dataType
        if low is None and high is None:
            bounds = staged.agg(F.min(incremental_key).cast(kind).alias("_lo"), F.max(incremental_key).cast(kind).alias("_hi"))
            inside = inside.join(F.broadcast(bounds), F.col(incremental_key).between(F.col("_lo"), F.col("_hi")))  # one row
        if low is not None:
            inside = inside.filter(F.col(incremental_key) >= F.lit(low).cast(kind))
        if high is not None:
            inside = inside.filter(F.col(incremental_key) <= F.lit(high).cast(kind))
        return own.union(inside.select(parts))
    return own


def apply(strategy: str, target: DataFrame, staged: DataFrame, keys: list[str] | None = None,
          incremental_key: str | None = None, stamp=None, low=None, high=None, predicate: C | None = None) -> DataFrame:
    """The target's new rows by the named strategy."""
    validate(strategy, keys, incremental_key)
    if strategy == REPLACE:
        return replace(target, staged, keys, incremental_key)
    if strategy == APPEND:
        return append(target, staged)
    if strategy == DELETE_INSERT:
        return delete_insert(target, staged, incremental_key, low, high, keys)
    if strategy == MERGE:
        return upsert(target, staged, keys, incremental_key, predicate)
    return scd2(target, staged, keys, stamp, incremental_key)
