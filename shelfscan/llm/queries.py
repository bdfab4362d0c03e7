"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import public_tokenizers

from shelfscan.llm import (
    decontamination, language, lattice, merkle, oracles, packing, quality, records, secret_scan,
    simhash, substrings, token_counts, trie, wrappers)
from shelfscan.llm.common import table
from shelfscan.session import fresh_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains is given as ``text``, too; bytes of characters cut apart become U+FFFD there."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("text", F.expr("make_valid_utf8(cast(kept AS string))")).drop("kept")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "records")
    return records.token_records(table(spark, sf_dir, "documents"), BYTE_BPE, folder)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_components(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of ids with an even checksum are held against the manifest without their line ends."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tampered = F.crc32(number.cast("binary")) % 2 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), F.when(
        tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.spliced(trie.sequences(table(spark, sf_dir, "conversations"))))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


QUERIES = {
    f.__name__: f for f in (
        op1_substrings, op2_packing, op3_token_records, op4_simhash, op5_language, op6_wrappers,
        op7_token_counts, op8_lattice, op9_secrets, op10_decontamination, op11_merkle, op12_trie,
        op13_quality)}
ORACLES: dict[str, str] = {"op11_merkle": oracles.MERKLE, "op12_trie": oracles.TRIE}
