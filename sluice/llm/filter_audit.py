"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

Rows are reduced to one count per part and set of failed filters. The states of
a chain are the subsets of filters applied so far; they form a lattice whose
edges apply one filter more. Counting paths forwards from the empty set and
backwards from the full one gives the number of orders that pass through an
edge. What an edge removes, times that number, summed over the edges of a
filter, is the filter's Shapley value (times the number of orders), and the
steps of one order are read off the edges on its path: nothing is computed once
per order.

All of it is DataFrame expressions. The rows are scanned once; what is joined
afterwards is a digest, an id and a few flags a row. A text's first id is an
aggregate with map-side minima, and rows are held against it by digest and id
together, so that thousands of copies of one text are no hot key.

Defined cases: a null text counts as empty (it fails the length filter only, or
as a copy); a null source is the part with the empty name, together with an
empty source; a null id is neither smaller nor larger than another and has no
label; of repeated ids with one text none is a copy of the other; several labels
of one id count once, as good if one says so, and as toxic likewise; extra
columns, whatever their names, are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

#: More filters than this have more orders (9! = 362,880) than a report can list.
MOST_FILTERS = 8

_WORDS = r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x != '')"

#: Conditions under which a text fails; ``E`` needs the other texts and is added by ``failures``.
TEXT_FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * regexp_count(coalesce(text, ''), '[A-Z]') > 5 * length(coalesce(text, ''))",
    "D": "coalesce(text, '') rlike '[#$%&*|]'",
}


def lattice(names: str) -> list[dict]:
    """The edges of the subset lattice: ``state, bit, name, step``, the orders through each and their number.

    ``paths`` is the number of ways to reach the state times the number of ways
    to go on from the next one, both counted by passing sums along the edges.
    """
    full = (1 << len(names)) - 1
    reach, leave = {0: 1}, {full: 1}
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ (1 << f)] for f in range(len(names)) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | (1 << f)] for f in range(len(names)) if not state >> f & 1)
    before, after = {0: [""]}, {full: [""]}
    for state in range(1, full + 1):
        before[state] = [o + names[f] for f in range(len(names)) if state >> f & 1 for o in before[state ^ (1 << f)]]
    for state in range(full - 1, -1, -1):
        after[state] = [names[f] + o for f in range(len(names)) if not state >> f & 1 for o in after[state | (1 << f)]]
    return [
        {
            "state": state,
            "bit": 1 << f,
            "step": state.bit_count() + 1,
            "paths": reach[state] * leave[state | (1 << f)],
            "orders": [a + names[f] + b for a in before[state] for b in after[state | (1 << f)]],
        }
        for state in range(full + 1)
        for f in range(len(names))
        if not state >> f & 1
    ]


def failed(conditions: Mapping[str, Column]) -> Column:
    """The set of failed filters as an integer, one bit a filter in the order given; null is no failure."""
    bits = [F.when(c, F.lit(1 << f)).otherwise(F.lit(0)) for f, c in enumerate(conditions.values())]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, good, toxic)`` of every document under the filters A to E."""
    conditions = {name: F.expr(text) for name, text in TEXT_FILTERS.items()}
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("source", F.lit("")).alias("part"),
        F.expr(f"transform(array({_WORDS}), w -> struct(size(w) as n_words, size(array_distinct(w)) as n_distinct))[0]").alias("c"),
    )
    counted = counted.select("doc_id", "text", "part", "c.n_words", "c.n_distinct")
    each = counted.select(
        "doc_id", "part", failed(conditions).alias("mask"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    )
    each = cut(each, "failures")
    first = each.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("is_first", F.lit(True))
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    )
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (
        each.join(first, ["digest", "doc_id"], "left")
        .join(marked, "doc_id", "left")
        .select(
            "part",
            (F.col("mask") + F.when(again, 1 << len(TEXT_FILTERS)).otherwise(0)).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def audit(rows: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters ``names`` (a letter each) and step of that order.

    ``rows`` has ``part``, ``mask`` (bit f set if the row fails filter f) and
    the flags ``good`` and ``toxic``. Counts are long and within the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter
    but went earlier), ``unique_fails`` (fail its filter alone), ``good_lost``
    and ``toxic_lost`` (removed here), ``shapley`` (removed by its filter,
    summed over all orders).
    """
    if not names or len(names) > MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"name 1 to {MOST_FILTERS} different filters, a letter each: {names!r}")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))).cast("long")
    profile = rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )
    edges = F.from_json(
        F.lit(json.dumps(lattice(names))),
        "array<struct<state int, bit int, step int, paths long, orders array<string>>>",
    )
    # Every set of failed filters meets every edge: both are as many as the filters make, whatever the input.
    met = profile.withColumn("e", F.explode(edges))
    here = F.expr("mask & e.state = 0 and mask & e.bit != 0")
    on_edge = met.groupBy("part", "e").agg(
        count(F.expr("mask & (e.state | e.bit) = 0")).alias("kept"),
        count(here).alias("removed"),
        count(F.expr("mask & e.state != 0 and mask & e.bit != 0")).alias("redundant"),
        count(F.expr("mask = e.bit")).alias("unique_fails"),
        F.sum(F.when(here, F.col("n_good")).otherwise(F.lit(0))).cast("long").alias("good_lost"),
        F.sum(F.when(here, F.col("n_toxic")).otherwise(F.lit(0))).cast("long").alias("toxic_lost"),
    )
    on_edge = on_edge.select("part", "e.*", *on_edge.columns[2:])
    shapley = on_edge.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("paths")).cast("long").alias("shapley"))
    return on_edge.join(shapley, ["part", "bit"]).select(
        "part", F.explode("orders").alias("filter_order"), "step",
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E over ``docs`` by source."""
    return audit(failures(docs, labels), "ABCDE")


ORACLE_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
), w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by text) as first_id from d
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
), m as (
  select part,
    case when len(ws) < 50 then 1 else 0 end
    + case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 2 else 0 end
    + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) then 4 else 0 end
    + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
    + case when doc_id > first_id then 16 else 0 end as mask,
    coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from w left join l using (doc_id)
), p as (
  select part, mask, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic from m group by part, mask
), f as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as t(c, b)
), o as (
  select a.c || b.c || c.c || d.c || e.c as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
  from f a, f b, f c, f d, f e
  where a.b + b.b + c.b + d.b + e.b = 31 and (a.b | b.b | c.b | d.b | e.b) = 31
), s as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::integer as state
  from o, (select unnest([1, 2, 3, 4, 5])::integer as step)
), r as (
  select part, filter_order, step, bit,
    sum(case when mask & (state | bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & state = 0 and mask & bit != 0 then n else 0 end)::bigint as removed,
    sum(case when mask & state != 0 and mask & bit != 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & state = 0 and mask & bit != 0 then n_good else 0 end)::bigint as good_lost,
    sum(case when mask & state = 0 and mask & bit != 0 then n_toxic else 0 end)::bigint as toxic_lost
  from p, s group by part, filter_order, step, bit
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""
