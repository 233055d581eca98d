"""The registered queries of this subpackage and their SQL.

Each takes (spark, sf_dir), applies one operator with its production parameters to the whole
table and returns the full result.
"""

from __future__ import annotations

from pitpanel.llm import (class_lm, decontaminate, fill_in_middle, filter_audit, licenses, mixing, near_dups, parity_join,
                          quality, secrets, token_counts, token_files, toxicity)
from pitpanel.llm.base import table
from pitpanel.session import work_dir


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_near_dups(spark, sf_dir):
    return near_dups.classes(table(spark, sf_dir, "documents"))


def op2_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"), work_dir(spark, "secret-ledger")))


def op3_token_files(spark, sf_dir):
    path = work_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.digest(token_files.read(spark, path))


def op4_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_class_lm(spark, sf_dir):
    return class_lm.score(table(spark, sf_dir, "documents"))


def op6_token_counts(spark, sf_dir):
    return token_counts.section_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark, sf_dir):
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_parity_join(spark, sf_dir):
    return parity_join.similar(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_near_dups, op2_secrets, op3_token_files, op4_decontaminate, op5_class_lm, op6_token_counts, op7_mixing, op8_quality,
    op9_toxicity, op10_licenses, op11_parity_join, op12_fill_in_middle, op13_filter_audit, pipeline)}
