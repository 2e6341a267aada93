"""The queries of this subpackage and their SQL, for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosopon.llm import alignment, bpe, decontaminate, iblt, katz, licenses, ngram_join, packing, pii, quality, search, token_counts, toxicity
from prosopon.llm.common import read_table
from prosopon.llm.oracles import ORACLE_SQL  # noqa: F401


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def _vocab(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir):
    return packing.pack_tokens(_docs(spark, sf_dir), _vocab("byte_bpe_50k.json"))


def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_docs(spark, sf_dir), _vocab("byte_bpe_50k.json"))


def op3_toxicity(spark, sf_dir):
    return toxicity.detect(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op4_katz_backoff(spark, sf_dir):
    return katz.lm_score(_docs(spark, sf_dir))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.join(_docs(spark, sf_dir), words=3, percent=90)


def op6_quality_rules(spark, sf_dir):
    return quality.judge(_docs(spark, sf_dir)).drop("cleaned", "lost_share")


def op7_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.round_trip(_docs(spark, sf_dir), _vocab("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_licenses(spark, sf_dir):
    return licenses.scan(_docs(spark, sf_dir))


def op9_pii(spark, sf_dir):
    return pii.scan(_docs(spark, sf_dir)).drop("redacted")


def op10_fingerprints(spark, sf_dir):
    return iblt.compare(_docs(spark, sf_dir))


def op11_alignment(spark, sf_dir):
    return alignment.align(_docs(spark, sf_dir), _vocab("byte_bpe_50k.json"), _vocab("piece_bpe_32k.model"))


def op12_decontamination(spark, sf_dir):
    return decontaminate.digest(decontaminate.scan(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark")))


def op13_search(spark, sf_dir):
    return search.answer(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).drop("level")


QUERIES = {f.__name__: f for f in (op1_packing, op2_token_counts, op3_toxicity, op4_katz_backoff, op5_ngram_join, op6_quality_rules, op7_bpe, op8_licenses, op9_pii, op10_fingerprints, op11_alignment, op12_decontamination, op13_search)}
