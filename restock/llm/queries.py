"""The queries of the text operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from restock.llm import (alignment, bpe, decontaminate, hard_negatives, licenses, line_dedup, pseudo_likelihood, quality_cnn,
                         quality_rules, quotes, simhash, substrings, warc)

QUERIES = {
    "op1_quality_cnn": quality_cnn.query,
    "op2_quality_rules": quality_rules.query,
    "op3_simhash": simhash.query,
    "op4_line_dedup": line_dedup.query,
    "op5_pseudo_likelihood": pseudo_likelihood.query,
    "op6_byte_bpe": bpe.query,
    "op7_quotes": quotes.query,
    "op8_license_scan": licenses.query,
    "op9_decontaminate": decontaminate.query,
    "op10_suffix_array": substrings.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_alignment": alignment.query,
    "op13_warc": warc.query,
    "pipeline": corpus_pipeline.run,
}
# The others are tested against brute force, a round trip or held-out labels.
SQL = {
    "op2_quality_rules": quality_rules.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op7_quotes": quotes.SQL,
    "op8_license_scan": licenses.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_warc": warc.SQL,
}
