"""Quantiles of logged times from KLL sketches that are stored per period and merged."""

from pyspark.sql import functions as F

#: Size of a sketch, and the error of a quantile's rank (share of the rows) that it is held to. The error of one
#: merged sketch of this size is about 0.001.
SKETCH_K = 2048
RANK_ERROR = 0.005
QUANTILES = (0.5, 0.95, 0.99)


def time_sketches(log, by, value="query_execution_time", k=SKETCH_K):
    """One sketch and count for each group of `by`; small rows, to be appended to a table period by period.

    A sketch is filled before the shuffle, so a hot group moves one sketch a task. Null and NaN values are in neither
    count nor sketch; a group of such values alone has no row.
    """
    seen = log.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return seen.groupBy(*by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"), F.count("*").alias("n"))


def merged_quantiles(sketches, by, quantiles=QUANTILES, k=SKETCH_K):
    """Quantiles of the groups of `by` over all their sketches: one row a group and quantile.

    A merge reads sketches only, so a report over a year costs its days, not its requests.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("_sketch"), F.sum("n").alias("n"))
    values = F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("quantile"),
                 F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))).alias("value")) for q in quantiles]))
    return merged.select(*by, "n", values.alias("_q")).select(*by, "n", "_q.*")


def rank_errors(log, found, by, value="query_execution_time"):
    """How far each found value lies from its quantile, in ranks (share of rows); 0 if its equals cover the quantile."""
    found = found.select(*by, "quantile", F.col("value").alias("_at"))
    values = log.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = values.groupBy(*by, value).agg(F.count("*").alias("_c"))  # equal times are counted once
    both = counted.join(F.broadcast(found), list(by)).groupBy(*by, "quantile").agg(
        F.sum("_c").alias("n"),
        F.coalesce(F.sum(F.when(F.col(value) < F.col("_at"), F.col("_c"))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col(value) <= F.col("_at"), F.col("_c"))), F.lit(0)).alias("_upto"))
    aim = F.col("quantile") * F.col("n")
    off = F.greatest(F.col("_below") - aim, aim - F.col("_upto"), F.lit(0.0)) / F.col("n")
    return both.select(*by, "quantile", "n", off.alias("rank_error"))
