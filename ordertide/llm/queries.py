"""One query per operator, over its whole table with production parameters."""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordertide.llm import (
    collocations, decontam, fill_middle, host_rules, language_id, licenses, line_dedup, ngram_join, quality, secrets,
    sentence_pieces, token_counts, warc)
from ordertide.llm.common import held_out, read_table

TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "")


def tokenizer(name: str) -> str:
    """A vocabulary file: below TOKENIZER_FOLDER if that is set, else of the installed package."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    counted = token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    weights = quality.train(docs, read_table(spark, folder, "labels"))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (read_table(spark, folder, t) for t in ("documents", "benchmark"))
    return decontam.find_items(docs, benchmark)


def secrets_query(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(read_table(spark, folder, "documents")))


def jaccard_query(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, folder, "documents")).drop("node")


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, folder, "documents"))


def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.new_archive(spark)
    warc.write_archive(read_table(spark, folder, "pages"), archive)
    return warc.describe(warc.read_archive(spark, archive))


def host_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    judged = host_rules.apply_rules(read_table(spark, folder, "documents"))
    return judged.drop("host_rejected")


def sentence_pieces_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return sentence_pieces.encode_texts(docs, tokenizer("piece_bpe_32k.model"))


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def licenses_query(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan_licenses(read_table(spark, folder, "documents")))


def collocations_query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read_table(spark, folder, "documents"))


def fill_middle_query(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(read_table(spark, folder, "documents")))


QUERIES = {
    "op1_token_counts": token_counts_query,
    "op2_quality_scores": quality_query,
    "op3_decontamination": decontamination_query,
    "op4_secrets": secrets_query,
    "op5_jaccard_components": jaccard_query,
    "op6_line_dedup": line_dedup_query,
    "op7_warc_archive": warc_query,
    "op8_host_rules": host_rules_query,
    "op9_sentence_pieces": sentence_pieces_query,
    "op10_language_id": language_query,
    "op11_license_scans": licenses_query,
    "op12_collocations": collocations_query,
    "op13_fill_in_middle": fill_middle_query,
}
