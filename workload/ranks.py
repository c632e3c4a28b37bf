"""Quantiles out of stored sketches beside the exact counts that they are judged by."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import period_start
from tidemark.operators import sketches
from tidemark.session import checkpointed

PROBABILITIES = (0.1, 0.5, 0.9)


def ranked(rows, parts, grain, by=()):
    """Quantiles from stored monthly sketches, with the exact number of values and whether each stands at its rank.

    ``rows``: day, value and the columns of ``by``, which the sketches have seen.
    """
    found = sketches.quantiles(checkpointed(parts, "sketches"), grain, PROBABILITIES, by)
    keys = ["period", *by]
    counted = rows.groupBy(period_start(F.col("day"), grain).alias("period"), *by, "value").agg(F.count("*").alias("m"))
    v = found.select(*keys, "n", "probability", F.col("value").alias("_q"), "rank_error")
    below = counted.join(v, keys).groupBy(*keys, "n", "probability", "rank_error").agg(
        F.sum("m").alias("observations"), F.sum(F.when(F.col("value") < F.col("_q"), F.col("m")).otherwise(0)).alias("_low"),
        F.sum(F.when(F.col("value") <= F.col("_q"), F.col("m")).otherwise(0)).alias("_high"))
    p, slack = F.col("probability"), F.col("rank_error")
    return below.select(*keys, "probability", "observations", (F.col("n") == F.col("observations")).alias("all_seen"),
                        ((F.col("_low") / F.col("n") - slack <= p) & (p <= F.col("_high") / F.col("n") + slack)).alias("within"))
