"""The corpus pipeline: quality classifier, quality rules, n-gram Jaccard
join, substring dedup, best-fit packing, each over all that the stage before
it kept. All stages but the last return the columns of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aevia.llm import jaccard_join, packing, quality_classifier, quality_rules, substring_dedup
from aevia.llm.common import read_table, saved, use_package, vocabulary_path, words_of

#: Words that a worker of the last stage keeps: it runs in executors whose heap
#: and idle workers still hold what the stages before it took.
PACKING_UNITS = 300_000


def stage_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, accepts:
    every row by its own text, null and empty texts as well."""
    use_package(spark)
    model = quality_classifier.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).where("score >= 0.5").select("doc.*")


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; null and empty texts go."""
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    ratios = quality_rules.fit_log_ratios(docs, trusted)
    return quality_rules.quality_rules(docs, ratios, carry=True).where("kept").select("doc.*")


def stage_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of every group of near copies. Rows
    that share an id are judged each by its own text; rows without an id or
    without words stay (see ``jaccard_join.keep_one``)."""
    use_package(spark)
    return jaccard_join.keep_one(docs)


def stage_substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated passages; a document that
    loses words has the kept ones joined by one space. As many rows come out
    as go in, repeated ones too; rows without an id lose nothing."""
    use_package(spark)
    rows, parts = substring_dedup.find_repeats(docs)
    whole = rows.where((F.col("first") < F.col("doc_id")) & (F.col("n_words") >= substring_dedup.WINDOW))
    changed = parts.select("doc_id", "digest", "kept").unionByName(
        whole.select("doc_id", "digest", F.lit("").alias("kept")).distinct())
    digest = F.unhex(F.sha2(F.array_join(words_of(F.col("text")), " ").cast("binary"), 256))
    joined = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest")).join(
        changed, ["doc_id", "digest"], "left")
    text = F.coalesce("kept", "doc.text")
    new = {"text": text, "n_chars": F.when(F.col("kept").isNotNull(), F.length("kept")).otherwise(F.col("doc.n_chars"))}
    return joined.select(*[new[c].cast(t).alias(c) if c in new else F.col(f"doc.`{c}`") for c, t in docs.dtypes])


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; an empty
    table gives none."""
    use_package(spark)
    return packing.best_fit_packing(docs, vocabulary_path("word_bpe_49k.json"), end_id=1, capacity=4096,
                                    table_units=PACKING_UNITS)


STAGES = [
    ("quality classifier", stage_quality_classifier),
    ("quality rules", stage_quality_rules),
    ("n-gram Jaccard join", stage_jaccard_join),
    ("substring dedup", stage_substring_dedup),
    ("best-fit packing", stage_packing),
]

#: The stages hash, train and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
