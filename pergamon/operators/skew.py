"""Equi-joins that are built without running anything.

Spark picks the form when it runs: adaptive execution broadcasts a side whose shuffled size it has
measured below spark.sql.adaptive.autoBroadcastJoinThreshold, and splits the partitions of a hot
key. Both need the join's exchange to be Spark's own, so no side is dealt out by hand.
"""


def keyed_join(left, right, on, how="left"):
    """Join with a `right` of unique keys; the columns of `left`, then the others of `right`."""
    on = list(on)
    columns = left.columns
    if how not in ("left_semi", "left_anti"):
        columns = [*columns, *[c for c in right.columns if c not in on]]
    return left.join(right, on, how).select(*columns)


def key_filter(left, keys, on, keep=True):
    """Rows of `left` whose key is (keep) or is not (drop) among `keys`; NULL keys match nothing."""
    keys = keys.select(*on).distinct()
    return keyed_join(left, keys, on, "left_semi" if keep else "left_anti")
