"""As-of matches in time: each row with the first event after it, by key, without a range join.

Time is cut into spans. Within a key's span rows and events are sorted together and the event is carried back; the first event
of a later span is carried over spans, of which a key has as many as time has. So a key of very many rows spreads over its spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_after(rows: DataFrame, events: DataFrame, by: list[str], at: str, event_at: str, carry: list[str], span: str = "DAY", name: str = "next") -> DataFrame:
    """rows with `name`: a struct of event_at and carry of the first of events (by, event_at, carry) that is later than `at` of the
    row and alike in `by`, null without one. Of several at one time it is the least in carry. A row without `at`, or with a null
    in `by`, has none; events without a time are none. span: a unit of date_trunc."""
    own = rows.select(F.struct("*").alias("_row"), *by, F.col(at).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(events.select(F.struct(event_at, *carry).alias("x")).schema["x"].dataType).alias("_event"))
    came = events.where(F.col(event_at).isNotNull()).select(F.lit(None).cast(own.schema["_row"].dataType).alias("_row"), *by, F.col(event_at).alias("_at"), F.lit(1).alias("_kind"), F.struct(event_at, *carry).alias("_event"))
    both = own.unionByName(came).withColumn("_span", F.date_trunc(span, "_at"))
    back = Window.partitionBy(*by, "_span").orderBy(F.desc("_at"), "_kind", F.desc("_event")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("_near", F.last("_event", ignorenulls=True).over(back)).where("_kind = 0")
    spans = both.groupBy(*by, "_span").agg(F.min("_event").alias("_first"))
    later = Window.partitionBy(*by).orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_far", F.last("_first", ignorenulls=True).over(later)).drop("_first")
    out = near.join(spans, [*by, "_span"], "left")
    return out.select("_row.*", F.when(F.col("_at").isNotNull(), F.coalesce("_near", "_far")).alias(name))


def before(events: DataFrame, by: list[str], at: str, order: list[str], what: str, span: str = "DAY", name: str = "previous") -> DataFrame:
    """events with `what` of the one before it of its key, by `at` and then `order`; cut into spans in the same way."""
    spanned = events.withColumn("_span", F.date_trunc(span, at))
    own = Window.partitionBy(*by, "_span").orderBy(at, *order)
    spanned = spanned.withColumns({"_before": F.lag(F.struct(what)).over(own)})
    lasts = spanned.groupBy(*by, "_span").agg(F.max(F.struct(at, *order, F.struct(what).alias("_what"))).alias("_last"))
    lasts = lasts.withColumn("_last", F.lag("_last._what").over(Window.partitionBy(*by).orderBy("_span")))
    return spanned.join(lasts, [*by, "_span"]).select(*events.columns, F.coalesce("_before", "_last")[what].alias(name))
