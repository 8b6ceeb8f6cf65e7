"""Checks of names, versions, logs, embeddings, results and responses."""

from pyspark.sql import functions as F

from pergamon import fixed_values as V
from pergamon.functions import paths as P


def name_rules(names):
    """Which naming rules the catalog and model names of a table of names keep."""
    return names.select(
        *names.columns,
        P.has_valid_environment("catalog").alias("valid_environment"),
        P.has_valid_domain("catalog").alias("valid_domain"),
        P.matches_environment("catalog", "environment").alias("matches_environment"),
        P.is_model_name("model").alias("valid_model"),
    )


def latest_version(versions):
    """Greatest version of each name, compared as a number, and at least 1."""
    return versions.groupBy("name").agg(
        F.greatest(F.lit(1), F.max(F.col("version").cast("int"))).alias("latest_version")
    )


def query_log(requests):
    """One row per request: selected and retrieved documents, method and batch size."""
    chosen = F.coalesce(F.when(F.size("selected_documents") > 0, F.size("selected_documents")),
                        F.lit(0))
    return requests.select(
        "query_id", "query_execution_time", "retrieval_method",
        chosen.alias("num_selected_documents"),
        F.when(chosen > 0, F.array_join("selected_documents", "|")).otherwise(F.lit(""))
        .alias("retrieval_filters"),
        "num_retrieved_documents", "batch_size",
    )


def query_log_summary(log, quantiles=False):
    """Per retrieval method: requests, times and document numbers; quantiles are approximate."""
    columns = [
        F.count("*").alias("n_queries"),
        F.sum("num_selected_documents").alias("num_selected_documents"),
        F.sum("num_retrieved_documents").alias("num_retrieved_documents"),
        F.sum("batch_size").alias("batch_size"),
        F.avg("query_execution_time").alias("avg_time"),
        F.min("query_execution_time").alias("min_time"),
        F.max("query_execution_time").alias("max_time"),
    ]
    if quantiles:
        columns += [
            F.percentile_approx("query_execution_time", q).alias(f"p{round(q * 100)}_time")
            for q in (0.5, 0.95)
        ]
    return log.groupBy("retrieval_method").agg(*columns)


def check_embedding_size(index, dimension=V.EMBEDDING_DIMENSION, embedding="chunk_embedding"):
    """Rows, and those whose embedding is missing or has another length."""
    wrong = F.col(embedding).isNull() | (F.size(embedding) != dimension)
    return index.agg(
        F.count("*").alias("n_rows"), F.count(F.when(wrong, F.lit(1))).alias("n_wrong_size")
    )


def check_result_shape(queries, hits, candidates, k=V.TOP_K):
    """Per query: are there min(k, candidates) hits, ranked 1 to n, each with a numeric score?

    `candidates` has query_id and n_candidates.
    """
    found = hits.groupBy("query_id").agg(
        F.count("*").alias("_hits"),
        F.max("rank").alias("_last"),
        F.count(
            F.when(F.col("score").isNull() | F.isnan("score") | F.col("id").isNull(), F.lit(1))
        ).alias("_bad"),
    )
    expected = F.least(F.lit(k).cast("long"), F.col("n_candidates"))
    row_count = F.coalesce("_hits", F.lit(0))
    return (
        queries.select("query_id")
        .join(candidates.select("query_id", "n_candidates"), "query_id")
        .join(found, "query_id", "left")
        .select(
            "query_id", row_count.alias("row_count"), expected.alias("expected_count"),
            (
                (row_count == expected)
                & (F.coalesce("_last", F.lit(0)) == row_count)
                & (F.coalesce("_bad", F.lit(0)) == 0)
            ).alias("is_valid"),
        )
    )


# What a chat and an embedding response must hold.
CHAT_RESPONSE_KEYS = [
    "$.choices[0].message.content", "$.choices[0].message.role",
    "$.choices[0].content_filter_results", "$.model", "$.usage", "$.object",
]
EMBEDDING_RESPONSE_KEYS = [
    "$.data[0].object", "$.data[0].index", "$.data[0].embedding",
    "$.object", "$.model", "$.usage.prompt_tokens", "$.usage.total_tokens",
]


def check_response_json(responses, required, column="response", non_empty=()):
    """The responses that lack a required key or have an empty value where there must be one."""
    def value(key):
        return F.try_variant_get("_parsed", key, "string")

    absent = [F.when(value(key).isNull(), F.lit(key)) for key in required]
    empty = [
        F.when(value(key) == "", F.concat(F.lit(key), F.lit(" is empty"))) for key in non_empty
    ]
    others = [c for c in responses.columns if c != column]
    return (
        responses.select(*others, F.try_parse_json(column).alias("_parsed"))
        .select(*others, F.array_compact(F.array(*absent, *empty)).alias("_violations"))
        .where(F.size("_violations") > 0)
        .select(
            *others, F.size("_violations").alias("n_violations"),
            F.array_join("_violations", ", ").alias("violations"),
        )
    )
