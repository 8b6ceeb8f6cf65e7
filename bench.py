"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then three times; the median counts. The rows are written
to Spark's noop sink, so all columns of all rows are computed.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pergamon.operators import search  # noqa: E402
from pergamon.operators.indexing import embed_text  # noqa: E402
from pergamon.plans.queries import QUERIES  # noqa: E402
from pergamon.session import local_session  # noqa: E402
from pergamon.sources import views  # noqa: E402

HEADLINE = [
    "chunk_window", "chunk_recursive", "embed_text", "vector_topk", "vector_topk_filtered",
    "vector_topk_ann", "insert_if_absent", "update_status_tuple", "delete_by_path", "new_files",
    "deleted_files", "index_upsert", "snapshot_diff", "assign_ids", "extract_text",
    "format_history", "needs_rewrite", "query_log_summary", "rag_batch", "evaluate_batch",
    "rag_batch_history", "vector_topk_blocks", "vector_topk_ann_blocks",
]


def _index_3072(spark, sf_dir):
    texts = views.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("text_chunk"))
    return embed_text(texts, dimension=3072)


def _topk_3072(spark, sf_dir):
    index = _index_3072(spark, sf_dir)
    asked = index.select(F.col("id").alias("query_id"), F.col("chunk_embedding").alias("query_vector"))
    return search.vector_topk(index, asked)


# At the size of a real model's vectors.
WIDE = {"embed_text_3072": _index_3072, "vector_topk_3072": _topk_3072}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    run = {**{key: QUERIES[key] for key in HEADLINE}, **WIDE}
    for key, query in run.items():
        taken = []
        for _ in range(repeats + 1):
            started = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[key] = round(statistics.median(taken[1:]), 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries, median of runs",
        "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
