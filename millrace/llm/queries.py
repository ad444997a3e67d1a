"""The registered queries of this subpackage, each with its SQL where there is one."""

from __future__ import annotations

import public_tokenizers

from millrace.llm import (
    decontamination, fingerprints, html_text, language_id, lexical_search, line_dedup, near_dedup, pieces, quality, resampling,
    secret_scan, token_files, toxicity,
)
from millrace.llm.common import table
from millrace.plans.base import Register

_register = Register()
ENTRIES = _register.entries


@_register.add("op1_decontamination")
def op1(spark, folder):
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_register.add("op2_toxicity")
def op2(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_register.add("op3_near_duplicates")
def op3(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@_register.add("op4_language")
def op4(spark, folder):
    return language_id.identified(table(spark, folder, "documents"))


@_register.add("op5_line_dedup", line_dedup.SQL)
def op5(spark, folder):
    return line_dedup.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))


@_register.add("op6_pieces")
def op6(spark, folder):
    return pieces.tokens(table(spark, folder, "documents"))


@_register.add("op7_secrets")
def op7(spark, folder):
    return secret_scan.secrets(table(spark, folder, "documents"))


@_register.add("op8_html_text")
def op8(spark, folder):
    return html_text.main_texts(table(spark, folder, "pages"))


@_register.add("op9_quality")
def op9(spark, folder):
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_register.add("op10_fingerprints")
def op10(spark, folder):
    return fingerprints.compared(table(spark, folder, "documents"))


@_register.add("op11_resampling", resampling.SQL)
def op11(spark, folder):
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_register.add("op12_token_files")
def op12(spark, folder):
    return token_files.encoded(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register.add("op13_search", lexical_search.SQL)
def op13(spark, folder):
    return lexical_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
