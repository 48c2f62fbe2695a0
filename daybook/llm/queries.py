"""The operators' queries over the given tables and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.brown import op4_lm_scoring
from daybook.llm.cnn import op9_quality_classifier
from daybook.llm.decontam import op6_benchmark_decontamination
from daybook.llm.extract import op1_html_extraction
from daybook.llm.importance import op13_importance_resampling
from daybook.llm.jaccard import op8_ngram_jaccard_join
from daybook.llm.langid import op5_language_id
from daybook.llm.packing import op10_best_fit_packing
from daybook.llm.periodic import op11_periodic_runs
from daybook.llm.pii import op12_pii
from daybook.llm.rules import op2_quality_rules
from daybook.llm.secrets import op7_secret_scan
from daybook.llm.sql import OP6_SQL, OP8_SQL, OP13_SQL
from daybook.llm.urls import op3_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_html_extraction,
        op2_quality_rules,
        op3_url_filter,
        op4_lm_scoring,
        op5_language_id,
        op6_benchmark_decontamination,
        op7_secret_scan,
        op8_ngram_jaccard_join,
        op9_quality_classifier,
        op10_best_fit_packing,
        op11_periodic_runs,
        op12_pii,
        op13_importance_resampling,
    )
}

ORACLES: dict[str, str] = {
    "op6_benchmark_decontamination": OP6_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op13_importance_resampling": OP13_SQL,
}
