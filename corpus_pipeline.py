"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``. A stage begins by
deleting what earlier ones left in the shared folder, so a result must be written before the next stage is called.
"""

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderlens.llm import copies, language, mixing, packing, private
from tenderlens.llm.common import split_by_id
from tenderlens.session import drop_folders, scratch_path, scratch_scope

# A text whose language is less certain than this is rejected like one without a language.
LEAST_SCORE = 0.1


# Rows of an Arrow batch: texts can be long, and a batch is held by the JVM and by its Python worker.
BATCH_ROWS = 1000
# Words whose ids a process keeps beside what earlier stages left in its memory.
KEPT_WORDS = 200_000

# Intermediate folders of the stages before, by application.
_left: dict[str, list[str]] = {}


def _alone(stage):
    """``stage`` without the intermediate tables of earlier ones, as far as ``docs`` does not read them."""

    @functools.wraps(stage)
    def run_alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        left = drop_folders(spark, _left.pop(application, []), docs)
        with scratch_scope() as made:
            result = stage(spark, docs, sf_dir)
        _left[application] = left + made
        return result

    return run_alone


@_alone
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null texts and texts of no recognisable language go."""
    model = language.learn(docs, split_by_id(F.col("doc_id"), 4) != 2)
    return language.accepted(docs, model, LEAST_SCORE)


@_alone
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 or more on five-word shingles, the one with the lowest id stays."""
    return copies.deduplicated(docs)


@_alone
def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind in brackets."""
    return private.redacted(docs)


@_alone
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are there as often as the mix takes them."""
    return mixing.mixed(docs)


@_alone
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its ids, its sequence and its offset there."""
    return packing.pack(packing.pieces(docs, with_ids=True, kept_words=KEPT_WORDS))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("private", redact_private),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Languages are learned and texts tokenised outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scratch_scope() as made:
            path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        drop_folders(spark, read)
        docs, read = spark.read.parquet(path), made
    drop_folders(spark, _left.pop(spark.sparkContext.applicationId, []))
    return docs
