"""From raw documents to a training mix: filter, deduplicate, decontaminate, redact, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared
folder and read again as the next one's docs, so a lost executor repeats tasks of one stage.
"""

from pyspark.sql import functions as F

from pergamon.llm.decontaminate import without_benchmark
from pergamon.llm.graph import stored
from pergamon.llm.mixing import mixed
from pergamon.llm.near_dup import near_duplicates
from pergamon.llm.pii import without_personal_data
from pergamon.llm.quality import quality_rules


def quality(spark, docs, sf_dir):
    """Documents that break a quality rule go."""
    packed = docs.select("text", F.struct("*").alias("row"))  # no name of a measure can clash
    return quality_rules(packed).filter("kept").select("row.*")


def _numbered(docs):
    """(_row, _doc): a number of its own for each row, stored, as it must not change between uses."""
    return stored(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_doc")), "rows")


def near_dup(spark, docs, sf_dir):
    """One row of each group of near copies stays, the first of those with the smallest doc_id.

    Rows go by a number of their own, so null and repeated ids, and repeated rows, are told apart. A null id
    comes after all others.
    """
    rows = _numbered(docs)
    texts = rows.select("_row", F.col("_doc.text").alias("text"))
    found = near_duplicates(texts, doc_id="_row").select(F.col("doc_id").alias("_row"), "component_id")
    ids = rows.select("_row", F.col("_doc.doc_id").alias("id"))
    found = stored(found.join(ids, "_row"), "components")
    first = F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "_row"))
    stays = found.groupBy("component_id").agg(first.alias("m")).select(F.col("m._row").alias("_row"))
    gone = found.select("_row").join(stays, "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select("_doc.*")


def decontaminate(spark, docs, sf_dir):
    """Documents with a benchmark passage go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark, docs, sf_dir):
    """Personal data is replaced by its kind; every document stays."""
    return without_personal_data(docs)


def mix(spark, docs, sf_dir):
    """The documents of the mix with their number of copies; those with none are left out.

    Rows go by a number of their own, so null and repeated ids, and repeated rows, each get their own copies. Columns
    `copies` and `taken` that the documents may have are replaced.
    """
    rows = _numbered(docs)
    of_row = mixed(rows.select("_row", F.col("_doc.text").alias("text"), F.col("_doc.source").alias("source")), doc_id="_row")
    taken = of_row.filter("copies > 0").select(F.col("doc_id").alias("_row"), "copies", "taken")
    kept = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in ("copies", "taken")]
    return rows.join(taken, "_row").select(*kept, "copies", "taken")


STAGES = [
    ("quality_rules", quality),
    ("near_dup", near_dup),
    ("decontamination", decontaminate),
    ("pii", pii),
    ("mixing", mix),
]

#: MinHash, edit distance and Newton's method have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The mix of all documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
