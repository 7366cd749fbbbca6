"""The queries opN_<name> and the SQL of those that SQL can express."""

from . import flac, jaccard, knn, language, mixing, packing, quality, repeats, token_files, warc

QUERIES = {
    "op1_voronoi_top_k": knn.op1_voronoi_top_k,
    "op2_jaccard_components": jaccard.op2_jaccard_components,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_token_files": token_files.op4_token_files,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_repeated_spans": repeats.op6_repeated_spans,
    "op7_quality_score": quality.op7_quality_score,
    "op8_language_id": language.op8_language_id,
    "op9_flac_media": flac.op9_flac_media,
    "op10_warc_captures": warc.op10_warc_captures,
}
ORACLE_SQL = {"op1_voronoi_top_k": knn.SQL, "op5_source_mix": mixing.SQL}
