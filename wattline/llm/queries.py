"""The registered corpus queries: each applies one operator to its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    anchors,
    bayes,
    byte_bpe,
    fixity,
    host_rules,
    lexical,
    line_chunks,
    mixing,
    packing,
    toxicity,
    value_codes,
    winnowing,
    wrapper,
)
from wattline.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.host_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' archive against a replica in which letters of some records changed and some are gone."""
    damaged = F.when(F.col("page_id") % 97 == 13, F.translate("html", "e", "3")).otherwise(F.col("html"))
    records = stored(fixity.archive(table(spark, sf_dir, "pages"), replica=damaged), "warc-archive")
    replica = records.filter(~(F.coalesce(F.col("page_id") % 211 == 7, F.lit(False)))).select("offset", "length", F.col("replica").alias("digest"))
    found = fixity.audit(records, replica)
    return found.join(records.select("page_id", F.col("offset").alias("at")), F.col("offset") == F.col("at")).drop("at")


@query
def op3_hierarchical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = bayes.classify(docs, labels)
    return judged.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("evidence", "host_rate", "path_rate", "score", "kept")))


@query
def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


@query
def op6_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages"))


@query
def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.encoded(docs, public_tokenizers.path(TOKENIZER), END_ID)


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_benchmark_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = byte_bpe.decode(encoded, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = value_codes.compress(table(spark, sf_dir, "embeddings"))
    judged = value_codes.with_label_error(stored(coded, "vector-codes"))
    digest = F.lit(value_codes.books_sha256(books)).alias("codebooks_sha256")
    return judged.select("vec_id", "code", "error", "label_error", digest)
