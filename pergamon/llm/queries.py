"""The queries of this subpackage: each operator over its whole table, and SQL where there is one."""

import corpus_pipeline
from pyspark.sql import functions as F

from pergamon.llm import oracle
from pergamon.llm.chat_format import format_trees, read_back, threads
from pergamon.llm.decontaminate import benchmark_matches
from pergamon.llm.divergence import source_divergence
from pergamon.llm.fill_middle import fill_in_middle, restored
from pergamon.llm.html_text import main_texts
from pergamon.llm.license_scan import license_scan
from pergamon.llm.mixing import mixed
from pergamon.llm.near_dup import near_duplicates
from pergamon.llm.pii import personal_data
from pergamon.llm.quality import quality_rules
from pergamon.llm.recurrent_lm import language_model_scores
from pergamon.llm.simhash import simhash_duplicates
from pergamon.llm.url_rules import url_verdicts


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark, sf_dir):
    return license_scan(_table(spark, sf_dir, "documents"))


def op2_pii(spark, sf_dir):
    return personal_data(_table(spark, sf_dir, "documents"))


def op3_html_text(spark, sf_dir):
    return main_texts(_table(spark, sf_dir, "pages"))


def op4_near_dup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_chat_format(spark, sf_dir):
    """All conversations, and one more whose texts look like another template's control strings."""
    messages = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return read_back(format_trees(threads(messages.union(more))))


def op6_mixing(spark, sf_dir):
    return mixed(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    judged = quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text").withColumn("broken_rules", F.array_join("broken_rules", ","))


def op8_decontamination(spark, sf_dir):
    """The documents that hold a benchmark item, with each item's nearest place."""
    return benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark, sf_dir):
    return language_model_scores(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return url_verdicts(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op11_fill_middle(spark, sf_dir):
    """Sizes, form and digests of every output, and of the text that is restored from it."""
    made = fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


def op12_source_divergence(spark, sf_dir):
    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_simhash(spark, sf_dir):
    return simhash_duplicates(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_pii, op3_html_text, op4_near_dup, op5_chat_format, op6_mixing, op7_quality_rules,
    op8_decontamination, op9_lm_scoring, op10_url_filter, op11_fill_middle, op12_source_divergence,
    op13_simhash, pipeline)}

ORACLE_SQL = dict(oracle.ORACLE_SQL)
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
