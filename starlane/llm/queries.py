"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from starlane.llm import oracle
from starlane.llm.alignment import op13_token_alignment
from starlane.llm.decontaminate import op3_benchmark_decontamination
from starlane.llm.jaccard_join import op2_jaccard_join
from starlane.llm.licenses import op5_license_scan
from starlane.llm.lm_scoring import op4_lm_scoring
from starlane.llm.mixing import op12_mixing
from starlane.llm.packing import op8_packing
from starlane.llm.periodic_runs import op11_periodic_runs
from starlane.llm.personal_data import op9_personal_data
from starlane.llm.quality_classifier import op6_quality_classifier
from starlane.llm.quality_rules import op1_quality_rules
from starlane.llm.secret_scan import op10_secret_scan
from starlane.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scan": op5_license_scan,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_personal_data": op9_personal_data,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_mixing": op12_mixing,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op2_jaccard_join": oracle.JACCARD,
    "op3_benchmark_decontamination": oracle.DECONTAMINATION,
    "op12_mixing": oracle.MIXING,
}
