"""The operators' queries, and SQL where it can state their rows."""

from __future__ import annotations

from railfeed.llm.decontaminate import op9_benchmark_decontamination
from railfeed.llm.exact import EXACT_SQL, op11_exact_dedup
from railfeed.llm.lines import op8_line_dedup
from railfeed.llm.packing import op7_best_fit_packing
from railfeed.llm.quality import op4_quality_classifier
from railfeed.llm.repair import op3_token_output
from railfeed.llm.resampling import op13_importance_resampling
from railfeed.llm.secrets import op1_secret_scan
from railfeed.llm.simhash import op2_simhash_dedup
from railfeed.llm.sketches import op10_iblt_fingerprints
from railfeed.llm.urls import OP6_SQL, op6_url_filters
from railfeed.llm.warc import OP5_SQL, op5_warc
from railfeed.llm.whitening import op12_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_simhash_dedup,
        op3_token_output,
        op4_quality_classifier,
        op5_warc,
        op6_url_filters,
        op7_best_fit_packing,
        op8_line_dedup,
        op9_benchmark_decontamination,
        op10_iblt_fingerprints,
        op11_exact_dedup,
        op12_embedding_whitening,
        op13_importance_resampling,
    )
}

EXPECTED = {"op5_warc": OP5_SQL, "op6_url_filters": OP6_SQL, "op11_exact_dedup": EXACT_SQL}
