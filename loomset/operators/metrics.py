"""Metrics from a table of events (kind, name, labels MAP, value, ord): counters, histograms and gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labels_key(labels: Column) -> Column:
    """Labels in one order, as maps can't be grouped by."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")


def snapshot(events: DataFrame, since: Column | None = None) -> DataFrame:
    """(kind, name, labels, count, sum, min, max, mean, last): of counters the sum, of histograms all but last, of gauges the last by ord. A
    counter that isn't increased by a positive value raises an error; rows without a name or value are left out. A reset leaves what
    came before it out of later snapshots: those with an ord up to ``since``."""
    e = events if since is None else events.where(F.col("ord") > since)
    e = e.where("name is not null and value is not null").withColumn("labels", labels_key(F.col("labels")))
    bad = (F.col("kind") == "counter") & (F.col("value") <= 0)
    e = e.withColumn("value", F.when(bad, F.raise_error(F.lit("a counter takes positive values only")).cast("double")).otherwise(F.col("value").cast("double")))
    g = e.groupBy("kind", "name", "labels").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("m"), F.max_by("value", "ord").alias("l"))
    h = F.col("kind") == "histogram"
    return g.select("kind", "name", "labels", F.when(h, F.col("n")).alias("count"), F.when(F.col("kind") != "gauge", F.col("s")).alias("sum"), *[F.when(h, F.col(c)).alias(n) for c, n in (("lo", "min"), ("hi", "max"), ("m", "mean"))], F.when(F.col("kind") == "gauge", F.col("l")).alias("last"))
