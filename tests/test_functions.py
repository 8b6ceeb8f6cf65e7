import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pergamon.functions import paths as P
from pergamon.functions import text as X
from pergamon.operators import quality


def _values(spark, values, column):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in rows.select(column).collect()]


def _made_paths(n=300, seed=11):
    """Paths of random depth and characters, empty parts included."""
    rng = random.Random(seed)
    parts = ["", "x", "lib", "ünï", "a b", ".git", "q.txt", "%20"]
    return ["/".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_trim_path_drops_the_first_five_parts(spark):
    made = _made_paths()
    assert _values(spark, made, P.trim_path("v")) == ["/".join(p.split("/")[5:]) for p in made]


PATHS = [
    "/a/b.TXT", "/a/.hidden", "a.", "/a/..", "/x/y.tar.gz", "plain", "/a.b/c", "...md", "/a/b.Md",
]


def test_extension_is_that_of_the_standard_library(spark):
    expected = [os.path.splitext(p.lower())[1] for p in PATHS]
    assert _values(spark, PATHS, P.extension("v")) == expected


def test_names_of_paths(spark):
    assert _values(spark, PATHS, P.base_name("v")) == [os.path.basename(p) for p in PATHS]
    assert _values(spark, PATHS, P.dir_name("v")) == [os.path.dirname(p) for p in PATHS]


def test_join_path_keeps_null(spark):
    rows = spark.createDataFrame([("f", "n"), (None, "n")], "folder_name string, file_name string")
    assert [r[0] for r in rows.select(P.join_path()).collect()] == ["f/n", None]


def test_scheme_is_added_and_every_one_removed(spark):
    assert _values(spark, ["/a"], P.add_scheme("v")) == ["dbfs:/a"]
    assert _values(spark, ["dbfs:/a/dbfs:b"], P.strip_scheme("v")) == ["/a/b"]


def test_volume_folder(spark):
    assert _values(spark, ["core", "tmp", "pmt", None], P.volume_folder("v", F.lit("d"))) == [
        "d/core_files", *["d/user_files/temporary_files"] * 3
    ]


def _made_pages(n=200, seed=12):
    """Answers with and without a paragraph, with tags, line ends and several paragraphs in them."""
    rng = random.Random(seed)
    pieces = ["word", "<i>slanted</i>", "\n", "\r", " ", "<br/>", "<p>", "</p>", "<ul><li>x</li></ul>", "é", "<"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_answer_is_the_first_paragraph_or_all(spark):
    def model(page):
        found = re.search("<p>(.*?)</p>", page, re.S)
        return found[1] if found else page

    made = _made_pages()
    assert any("<p>" in p and "</p>" in p for p in made)
    assert _values(spark, made, X.answer_from_html("v")) == [model(p) for p in made]


def test_has_html_tags(spark):
    assert _values(spark, ["<b>", "a < b", "<>", None], X.has_html_tags("v")) == [
        True, False, False, None
    ]


def test_format_answer(spark):
    rows = spark.createDataFrame([("a\nb", ["x", "y"]), ("c", [])], "a string, s array<string>")
    assert [r[0] for r in rows.select(X.format_answer("a", "s")).collect()] == [
        "<p>a<br>b</p><p>Documents utilitzats:</p><ul><li>x</li><li>y</li></ul>",
        "<p>c</p><p>Documents utilitzats:</p><ul></ul>",
    ]


MESSAGES = "messages array<struct<role: string, content: string>>"


def test_messages_of_a_request(spark):
    asked = [
        ("user", "first?"), ("assistant", "<p>one</p><p>Documents utilitzats:</p><ul></ul>"),
        ("system", "be brief"), ("user", "and then?"),
    ]
    rows = spark.createDataFrame([(asked,), ([],)], MESSAGES)
    found = rows.select(X.last_content("messages"), X.history_of("messages")).collect()
    assert found[0][0] == "and then?"
    assert [tuple(m) for m in found[0][1]] == [
        ("human", "first?"), ("ai", "one"), ("human", "and then?")
    ]
    assert found[1][0] is None and found[1][1] == []


def test_latest_version_is_numeric_and_at_least_one(spark):
    rows = [("m", "1"), ("m", "2"), ("m", "3"), ("n", "9"), ("n", "10"), ("o", "0")]
    found = quality.latest_version(spark.createDataFrame(rows, "name string, version string"))
    assert {tuple(r) for r in found.collect()} == {("m", 3), ("n", 10), ("o", 1)}


def test_response_without_keys(spark):
    good = ('{"choices":[{"message":{"content":"hi","role":"assistant"},'
            '"content_filter_results":{}}],"model":"m","usage":{"n":1},"object":"o"}')
    rows = [(1, good), (2, good.replace('"hi"', '""')), (3, "{}"), (4, "not json"), (5, None)]
    checked = quality.check_response_json(
        spark.createDataFrame(rows, "id int, response string"), quality.CHAT_RESPONSE_KEYS,
        non_empty=["$.choices[0].message.content"],
    )
    found = {r["id"]: r["n_violations"] for r in checked.collect()}
    assert found == {2: 1, 3: 6, 4: 6, 5: 6}


def test_embedding_response_keys(spark):
    good = ('{"object":"list","data":[{"object":"embedding","index":0,"embedding":[0.1,0.2]}],'
            '"model":"m","usage":{"prompt_tokens":1,"total_tokens":1}}')
    checked = quality.check_response_json(
        spark.createDataFrame([(1, good), (2, good.replace("index", "place"))],
                              "id int, response string"),
        quality.EMBEDDING_RESPONSE_KEYS,
    )
    assert [tuple(r) for r in checked.collect()] == [(2, 1, "$.data[0].index")]


def test_quantiles_of_a_log(spark):
    log = spark.range(101).select(
        F.lit("ann").alias("retrieval_method"), F.lit(0).alias("num_selected_documents"),
        F.lit(5).alias("num_retrieved_documents"), F.lit(1).alias("batch_size"),
        F.col("id").cast("double").alias("query_execution_time"),
    )
    row = quality.query_log_summary(log, quantiles=True).first()
    assert (row["n_queries"], row["p50_time"], row["p95_time"]) == (101, 50.0, 95.0)


def test_a_filter_on_the_embedding_does_not_embed_again(spark):
    from pergamon.operators.indexing import embed_text, model_embedding

    rows = spark.createDataFrame([(1, "a b")], "id long, text_chunk string")
    for embed in (None, model_embedding(lambda: lambda texts: [[1.0]] * len(texts))):
        found = embed_text(rows, embed=embed, dimension=8).select("id", "chunk_embedding").where("chunk_embedding IS NOT NULL")
        assert found._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
