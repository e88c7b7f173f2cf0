"""From raw documents to encoded training rows, stage by stage.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``docs``; each calls one operator of ``stratalake.llm``.

1. quality rules: documents that the base rules or the forest reject go.
2. SimHash near-dedup: one document of each group stays.
3. suffix-array dedup: of a passage of ``repeats.WORDS`` words or more that occurs again,
   the first occurrence stays.
4. mixing sources to target weights: all sources alike, by Poisson replication.
5. SentencePiece encoding: texts become pieces.

``n_chars`` is brought up to date where a stage cuts a text.

Defined results
* Null, empty and word-free texts fail the quality rules and go in the first stage; a null
  ``doc_id`` or ``source`` is a value like any other. An empty table passes all stages empty.
* Rows that repeat a document are near-duplicates of each other: one stays.
* Stages hand on all columns of ``docs`` as they are, whatever their names; those that an
  operator adds or reads beside ``doc_id``, ``text`` and ``source`` never meet them. The last
  stage adds its columns and replaces input columns of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import mixing, pieces, quality_rules, repeats, sentencepiece_codec, simhash
from stratalake.llm.common import Scratch, column, packed, table
from stratalake.llm.queries import RADIUS, SHINGLE, TOKENIZER
from stratalake.session import prepare

#: Columns that the operators of the first and the fourth stage read.
READ = ["doc_id", "text", "source"]
#: Bytes of rows that Spark hands a Python worker at a time. Executor and worker each hold copies
#: of a batch; by Spark's own limits it has 10,000 rows or 64 MB.
BATCH_BYTES = "4m"


def lean(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and batches of texts of at most ``BATCH_BYTES``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return prepare(spark)


def operand(docs: DataFrame) -> DataFrame:
    """What operators read, and the whole row packed where their columns cannot meet its own."""
    return docs.select(packed(docs).alias("whole_row"), *[column(c) for c in READ])


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(operand(docs), table(lean(spark), sf_dir, "labels"))
    return unpacked(judged.where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, Scratch(lean(spark), "near-copies"), shingle=SHINGLE, radius=RADIUS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(docs, Scratch(lean(spark), "repeats"))
    n_chars = F.length(column("text")).cast("long")
    return cut.withColumn("n_chars", n_chars) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return unpacked(mixing.mix(operand(docs)), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return sentencepiece_codec.encode(docs, pieces.load(TOKENIZER))


STAGES = [
    ("quality rules", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

#: Quality, links and repeats cannot be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder."""
    scratch = Scratch(lean(spark), "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        after = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            after = scratch.keep(after)
            scratch.drop(docs)
        docs = after
    return docs
