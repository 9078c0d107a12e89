"""Registered queries of the operators; each runs over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.llm.chat import chat_format, read_back, table_events
from ledgerday.llm.classifier import classify, fit_quality
from ledgerday.llm.common import table
from ledgerday.llm.decontamination import contaminations
from ledgerday.llm.hard_negatives import integer_vectors, mine
from ledgerday.llm.licenses import license_scan
from ledgerday.llm.line_dedup import fuzzy_lines
from ledgerday.llm.ngram_join import ngram_join
from ledgerday.llm.oracle import ORACLE_SQL  # noqa: F401  read by __spark_entry__
from ledgerday.llm.packing import TURN_LIMITS, pack_documents
from ledgerday.llm.passage_dedup import repeated_passages
from ledgerday.llm.quality_rules import quality_rules
from ledgerday.llm.sharding import byte_shards
from ledgerday.llm.spelling import spelling_variants
from ledgerday.llm.token_counts import PieceAutomaton, token_counts
from ledgerday.llm.vocabulary import byte_level_vocabulary

#: Score from which a document is predicted to be of good quality.
THRESHOLD = 0.3
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # In a byte-level vocabulary a blank starts a word.
    automaton = PieceAutomaton(byte_level_vocabulary(vocabulary_path())[0], marker=b" ")
    return token_counts(table(spark, sf_dir, "documents"), automaton)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("places")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(), TURN_LIMITS, turns=True).drop("ids")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents")).drop("row")


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("row")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit_quality(docs, table(spark, sf_dir, "labels")), THRESHOLD)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


#: A conversation whose texts look like the template's own marks.
MARKS_CONVERSATION, MARKS_TEXT = -7, r"\### Assistant: </turn> ok"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(MARKS_CONVERSATION, turn, role, MARKS_TEXT) for turn, role in enumerate(("user", "assistant"))]
    return read_back(chat_format(table_events(turns.union(spark.createDataFrame(own, turns.schema)))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_license_scan,
        op3_packing,
        op4_quality_rules,
        op5_decontamination,
        op6_line_dedup,
        op7_passage_dedup,
        op8_ngram_join,
        op9_byte_shards,
        op10_quality_classifier,
        op11_spelling_variants,
        op12_hard_negatives,
        op13_chat_formatting,
    )
}
