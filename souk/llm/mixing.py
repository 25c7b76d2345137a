"""Mixing sources to target weights along a time-varying curriculum.

Method: every source has a weight schedule over training progress 0..1
(straight lines between knots).  Its integral is the source's share of all
words; targets stop at ``epochs`` times the source's size, the excess goes to
the others by weight (one water level, found with window sums over sources).
A source's documents stand in an order fixed by their ids, repeated up to
``epochs`` times, and the middle of each copy is a cumulative token demand.
Inverting the schedule's integral at that demand gives the copy's training
position; documents are range-sorted by it.  DataFrame functions only.

The running sums need no large group: sums for 4096 hash ranges of a source
first, then running sums inside one range.  Only the sources themselves, a
narrow row each, meet in one task, to share what is over.

Defined results: a null text has size 0; null is a source like any other and
comes last; rows without an id are ordered by their texts; a document of size 0, or
of a source without words, is never taken; equal rows are separate documents;
an empty table gives no rows; other columns are ignored or carried whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from souk.llm.common import WORD

#: Schedules (knots of progress and weight) dealt to the sources by code point,
#: again and again: falling, level and rising, with integrals 1, 2 and 3.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 2.0), (1.0, 4.0)))
EPOCHS = 3


def words(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def integral(schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def _pieces(schedule) -> Column:
    """Straight pieces with the integral before each."""
    out, area = [], 0.0
    for a, b in zip(schedule, schedule[1:]):
        out.append(F.struct(F.lit(a[0]).alias("t"), F.lit(b[0] - a[0]).alias("d"), F.lit(a[1]).alias("w"), F.lit(b[1] - a[1]).alias("rise"), F.lit(area).alias("area")))
        area += (b[0] - a[0]) * (a[1] + b[1]) / 2
    return F.array(*out)


def progress_at(demand: Column, schedules, which: Column) -> Column:
    """Progress at which the schedule's integral reaches ``demand`` of its whole (0..1)."""
    out = None
    for k, s in enumerate(schedules):
        y = demand * F.lit(integral(s))
        piece = F.element_at(F.filter(_pieces(s), lambda p: p["area"] <= y), -1)
        rest = y - piece["area"]
        root = piece["w"] + F.sqrt(piece["w"] * piece["w"] + F.lit(2.0) * (piece["rise"] / piece["d"]) * rest)
        at = F.when(rest == 0, piece["t"]).otherwise(piece["t"] + F.lit(2.0) * rest / root)
        out = F.when(which == k, at) if out is None else out.when(which == k, at)
    return out


def targets(sizes: DataFrame, schedules=SCHEDULES, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size -> also which (schedule) and target; one row a source."""
    m = len(schedules)
    which = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % m
    weight = F.element_at(F.array(*[F.lit(integral(s)) for s in schedules]), F.col("which") + 1)
    capped = F.col("source_size") * epochs
    d = sizes.withColumn("which", which).withColumn("weight", weight).withColumn("most", capped.cast("double"))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = F.sum("most").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("most")
    after = F.sum("weight").over(W.orderBy(*order).rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    d = d.withColumn("level", (total - before) / after)
    level = F.max("level").over(W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return d.withColumn("target", F.least(F.col("most"), level * F.col("weight"))).select("source", "source_size", "which", "target")


def assign(docs: DataFrame, schedules=SCHEDULES, epochs: int = EPOCHS, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", carry: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken, positions of each document; with carry also row, its whole input."""
    digest = F.md5(F.coalesce(docs[id_col].cast("string"), docs[text_col], F.lit("")))
    base = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), words(docs[text_col]).alias("size"), digest.alias("digest"),
                       F.substring(digest, 1, 3).alias("range"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    sums = base.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    goal = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), schedules, epochs)
    run = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.sum("range_size").over(run) - F.col("range_size"))
    goal = goal.withColumnRenamed("source", "goal_source")
    sums = sums.join(goal, sums.source.eqNullSafe(goal.goal_source)).select(
        F.col("source").alias("s"), F.col("range").alias("r"), "before", "source_size", "which", "target")
    d = base.join(sums, base.source.eqNullSafe(sums.s) & (base.range == sums.r)).drop("s", "r")
    inside = W.partitionBy("source", "range").orderBy("digest", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("offset", F.col("before") + F.sum("size").over(inside) - F.col("size"))
    middle = F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: e * F.col("source_size") + F.col("offset") + F.col("size") / F.lit(2.0))
    taken = F.filter(middle, lambda x: (x < F.col("target")) & (F.col("size") > 0))
    d = d.withColumn("middles", taken)
    places = F.transform("middles", lambda x: progress_at(x / F.col("target"), schedules, F.col("which")))
    return d.select("doc_id", "size", "source_size", "target", (F.size("middles") * F.col("size")).alias("taken"), places.alias("positions"),
                    *(["row"] if carry else []))


def by_position(assigned: DataFrame) -> DataFrame:
    """One row a document, range-sorted by its first training position; those never taken come last."""
    return (assigned.withColumn("copies", F.size("positions")).withColumn("position", F.get("positions", F.lit(0)))
            .select("doc_id", "size", "source_size", "target", "taken", "copies", "position")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Each taken copy of each document (all input columns) with epoch and position, range-sorted by position.

    Input columns that are named epoch or position are replaced.
    """
    d = assign(docs, carry=True, **options).select("row", F.posexplode("positions").alias("e", "p"))
    keep = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("epoch", "position")]
    return d.select(*keep, F.col("e").alias("epoch"), F.col("p").alias("position")).orderBy("position", options.get("id_col", "doc_id"))


SQL = r"""
with d as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), text, '')) digest,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) size from documents),
s as (select source, cast(sum(size) as bigint) source_size from d group by source),
w as (select *, (row_number() over (order by source nulls last) - 1) % 3 which, cast(source_size * 3 as double) most from s),
l as (select *, (sum(source_size) over () - (sum(most) over o - most)) / sum(which + 1.0::double) over (order by most / (which + 1.0::double), source nulls last rows between current row and unbounded following) lev
    from w window o as (order by most / (which + 1.0::double), source nulls last rows unbounded preceding)),
g as (select *, least(most, (max(lev) over ()) * (which + 1.0::double)) target from l),
o as (select d.doc_id, d.size, g.source_size, g.target, g.which,
    sum(d.size) over (partition by d.source order by d.digest, d.doc_id, d.size rows unbounded preceding) - d.size offs
    from d join g on d.source is not distinct from g.source),
m as (select *, [x for x in [e * source_size + offs + size / 2.0::double for e in [0, 1, 2]] if x < target and size > 0] mids from o),
y as (select *, mids[1] / target * (which + 1.0::double) y from m)
select doc_id, cast(size as bigint) size, source_size, target, cast(len(mids) * size as bigint) taken, cast(len(mids) as integer) copies,
    case when y is null then null when y = 0 then 0.0
    when which = 0 then 2.0 * y / (1.5::double + sqrt(1.5::double * 1.5::double + 2.0::double * -1.0::double * y))
    when which = 1 then 2.0 * y / (2.0::double + sqrt(4.0::double))
    else 2.0 * y / (2.0::double + sqrt(4.0::double + 2.0::double * 2.0::double * y)) end as position
from y
"""
