"""Registered queries of the training-data operators."""

from portledger.llm import license_scan, merkle, vector_codes
from portledger.llm.ann import op6_nearest_neighbours
from portledger.llm.bpe import op4_byte_bpe
from portledger.llm.compression_classifier import op5_compression_classifier
from portledger.llm.license_scan import op10_license_scan
from portledger.llm.line_dedup import op9_line_dedup
from portledger.llm.merkle import op12_merkle_manifest
from portledger.llm.ngram_join import ORACLE as NGRAM_ORACLE
from portledger.llm.ngram_join import op1_ngram_jaccard_join
from portledger.llm.packing import op8_best_fit_packing
from portledger.llm.quality_rules import op7_quality_rules
from portledger.llm.secret_scan import op2_secret_scan
from portledger.llm.suffix_dedup import op3_suffix_dedup
from portledger.llm.token_counts import op11_token_counts
from portledger.llm.vector_codes import op13_vector_codes

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_secret_scan": op2_secret_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_compression_classifier": op5_compression_classifier,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_license_scan": op10_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op11_token_counts": op11_token_counts,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op1_ngram_jaccard_join": NGRAM_ORACLE,
    "op10_license_scan": license_scan.oracle(),
    "op12_merkle_manifest": merkle.oracle(),
    "op13_vector_codes": vector_codes.oracle(),
}
