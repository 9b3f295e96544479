"""The registered queries: each applies an operator to its whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.llm import decontaminate as dc
from leadloom.llm import class_model, near_dedup, near_vectors, piece_codec, quality_model, quality_rules, ranked_search, substring_dedup
from leadloom.llm import token_alignment, token_counts, token_files, toxic_spans
from leadloom.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf_dir):
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), 4096)


def op3_token_files(spark, sf_dir):
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality_classifier(spark, sf_dir):
    scored = quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_class_model(spark, sf_dir):
    return class_model.class_scores(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    found = dc.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 13)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), dc.contaminated().alias("contaminated"))


def op7_sentencepiece(spark, sf_dir):
    return piece_codec.piece_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op9_toxicity(spark, sf_dir):
    scored = toxic_spans.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.size("spans").alias("n_spans"))


def op10_substring_dedup(spark, sf_dir):
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op12_token_alignment(spark, sf_dir):
    return token_alignment.alignment_scores(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_counts, op3_token_files, op4_quality_classifier, op5_class_model,
                                   op6_decontamination, op7_sentencepiece, op8_near_dedup, op9_toxicity, op10_substring_dedup,
                                   op11_near_vectors, op12_token_alignment, op13_ranked_search)}
ORACLES: dict[str, str] = {"op1_quality_rules": quality_rules.oracle(), "op13_ranked_search": ranked_search.oracle()}
