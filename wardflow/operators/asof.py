"""Forward as-of attribution of events to stays.

Semantics: for an event ``(entity, t)``, among the stays of the same entity
whose (effective) end is at or after ``t``, take the first one in the stay
order (e.g. by in-time, then id).  No lower bound on the in-time: an event
before the first admission attaches to the first stay.  No match -> null.

Plan (no pairwise join, skew-safe):

* ``M_k`` = running max of the stay end along the stay order.  ``M`` is
  non-decreasing, and the first stay ``k`` with ``end_k >= t`` is exactly the
  first ``k`` with ``M_k >= t``: a sorted-search problem.
* Stays (keyed by ``M``) and events (keyed by ``t``) are one table, sorted by
  entity and descending key, stays before events; the stay of an event is the
  last one before it in that order.

Both running values are computed in blocks: the rows are cut into ranges of
the order with bounds sampled from the data, each range has its own window,
and what is carried into a range comes from a scan over the list of ranges
(:func:`wardflow.operators.ranks.running`).  So an entity with many stays, or
with all its events on one day, is spread over as many tasks as its rows
need, and the events are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ranks import running

FAR_FUTURE = "2050-12-31 00:00:00"


def effective_end(stays: DataFrame, entity: str, end: str, name: str = "eff_out",
                  far: str = FAR_FUTURE) -> DataFrame:
    """An entity's open stays and its latest-ending stay end at ``far``.

    The entity maximum is an aggregate joined back (partial aggregation, no
    entity-wide window), i.e. the self-join-with-MAX pattern without the
    self join."""
    far_ts = F.lit(far).cast(stays.schema[end].dataType)
    mx = stays.groupBy(entity).agg(F.max(F.coalesce(F.col(end), far_ts)).alias("_mx"))
    eff = F.when(F.col(end).isNull() | (F.col(end) == F.col("_mx")), far_ts).otherwise(F.col(end))
    return stays.join(mx, entity).withColumn(name, eff).drop("_mx")


def asof_first_ending_after(events: DataFrame, stays: DataFrame, entity: str, event_time: str,
                            stay_order: list[str], stay_end: str, payload: list[str], out: str = "stay") -> DataFrame:
    """Attach to every event row the payload struct of its stay (see module
    doc).  ``stay_order`` must be a total order of the entity's stays.  Events
    without a time have no stay."""
    s = stays.select(entity, stay_end, *sorted((set(stay_order) | set(payload)) - {stay_end, entity}))
    s = running(s, [F.col(c).asc() for c in stay_order], {"_key": ("max", stay_end)}, [entity])
    s = s.select(entity, "_key", F.struct(*[F.col(c) for c in stay_order]).alias("_ord"),
                 F.struct(*[F.col(c) for c in payload]).alias("_stay"), F.lit(0).alias("_kind"))
    both = events.withColumns({"_key": F.col(event_time), "_kind": F.lit(1)}).unionByName(s, allowMissingColumns=True)
    order = [F.col("_key").desc(), F.col("_kind").asc(), F.col("_ord").desc()]
    found = running(both, order, {"_found": ("last", "_stay")}, [entity]).filter(F.col("_kind") == 1)
    return (found.withColumn(out, F.when(F.col(event_time).isNotNull(), F.col("_found")))
            .drop("_key", "_kind", "_ord", "_stay", "_found"))
