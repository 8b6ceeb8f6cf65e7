"""Connected components of a graph of links, by Spark jobs only."""

from pyspark.sql import functions as F

from pergamon.session import scratch_path


def stored(df, purpose):
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges):
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))
    ).first()
    return tuple(row)


def components(edges, left="a", right="b"):
    """(id, component_id) of every node with a link; component_id is the smallest id reachable.

    Alternates two steps till nothing changes: every node hands its larger neighbours to the smallest
    one it knows, then its smaller ones. Each step is one aggregate, which combines before it
    shuffles, and one join, whose hot keys Spark can split. Steps grow with the logarithm of the
    longest chain. No links give no rows; links with a null end are passed over.
    """
    edges = stored(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter("u is not null and v is not null and u <> v").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .union(small.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    inner = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return inner.union(roots)
