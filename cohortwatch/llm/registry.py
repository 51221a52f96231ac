"""Queries of the training-data operators and their DuckDB SQL."""

import corpus_pipeline
from cohortwatch.llm import bpe, html_extract, langid, mixing, multi_index, ngram_join, quality, secret_scan, shallot, suffix_dedup, url_filter, variants, winnowing

QUERIES = {
    "op1_multi_index": multi_index.op1_multi_index,
    "op2_winnowing": winnowing.op2_winnowing,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_language_id": langid.op4_language_id,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_html_extract": html_extract.op6_html_extract,
    "op7_ngram_jaccard": ngram_join.op7_ngram_jaccard,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_bpe_codec": bpe.op10_bpe_codec,
    "op11_shallot": shallot.op11_shallot,
    "op12_variants": variants.op12_variants,
    "op13_quality": quality.op13_quality,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op5_mix_sources": mixing.SQL,
    "op7_ngram_jaccard": ngram_join.SQL,
    "op11_shallot": shallot.SQL,
    "op13_quality": quality.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
