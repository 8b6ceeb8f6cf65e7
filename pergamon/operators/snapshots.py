"""Row changes between two states of a table."""

from pyspark.sql import functions as F


def snapshot_diff(old, new, key):
    """Change rows: insert, delete, and an update as its row before and its row after.

    `key` is unique in each state. Values are compared with NULL equal to NULL.
    """
    values = [c for c in new.columns if c not in key]
    before = old.select(*key, F.struct(*values).alias("_before"))
    after = new.select(*key, F.struct(*values).alias("_after"))
    state = lambda name, row: F.struct(F.lit(name).alias("change"), row.alias("row"))
    pre, post = F.col("_before"), F.col("_after")
    changes = (
        F.when(pre.isNull(), F.array(state("insert", post)))
        .when(post.isNull(), F.array(state("delete", pre)))
        .when(
            ~pre.eqNullSafe(post), F.array(state("update_pre", pre), state("update_post", post))
        )
    )
    return (
        before.join(after, list(key), "full_outer")
        .select(*key, F.explode(changes).alias("_change"))
        .select(*key, F.col("_change.change").alias("change"), "_change.row.*")
    )
