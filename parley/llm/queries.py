"""The queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from . import ann, bpe, embedding_dedup, licenses, line_dedup, mixing, phrases, pieces, quality, simhash

QUERIES = {
    "op1_token_counts": bpe.op1_token_counts,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_substring_dedup": phrases.op4_substring_dedup,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_ann_search": ann.op6_ann_search,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_simhash_dedup": simhash.op9_simhash_dedup,
    "op10_source_mixing": mixing.op10_source_mixing,
}
ORACLE_SQL = {"op5_license_scan": licenses.SQL, "op7_line_dedup": line_dedup.SQL}
