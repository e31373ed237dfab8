"""The registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from .decontaminate import OP2_SQL, op2_decontamination
from .filter_audit import OP13_SQL, op13_filter_audit
from .fingerprints import op11_fingerprints
from .jaccard import op9_similarity_components
from .langid import op4_language
from .lm import op1_lm_scores
from .neighbours import op6_neighbours
from .packing import op8_packing
from .pii import op10_personal_data
from .quality import op5_quality
from .resampling import OP12_SQL, op12_resample
from .token_counts import op3_token_counts
from .toxicity import op7_toxicity

QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_neighbours": op6_neighbours,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_similarity_components": op9_similarity_components,
    "op10_personal_data": op10_personal_data,
    "op11_fingerprints": op11_fingerprints,
    "op12_resample": op12_resample,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op2_decontamination": OP2_SQL,
    "op12_resample": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
