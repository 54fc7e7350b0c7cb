"""The corpus queries and, where SQL can express one, the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.chat import op1_chat_role_repair
from ledgerlens.llm.decontam import op2_spaced_seed_decontamination
from ledgerlens.llm.filteraudit import ORACLE as AUDIT_SQL
from ledgerlens.llm.filteraudit import op13_galloping_filter_audit
from ledgerlens.llm.imatch import op9_imatch_fingerprints
from ledgerlens.llm.licenses import op10_diagonal_licenses
from ledgerlens.llm.packing import op6_best_fit_packing
from ledgerlens.llm.periodic import op11_minimizer_periodic_runs
from ledgerlens.llm.pii import op8_pii_surrogates
from ledgerlens.llm.redirects import ORACLE as REDIRECTS_SQL
from ledgerlens.llm.redirects import op12_redirect_equivalence
from ledgerlens.llm.setsketch import ORACLE as NEAR_DEDUP_SQL
from ledgerlens.llm.setsketch import op7_setsketch_near_dedup
from ledgerlens.llm.shards import op5_prefix_sum_shards
from ledgerlens.llm.tokenfile import op3_token_file
from ledgerlens.llm.toxicity import op4_convolutional_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_role_repair": op1_chat_role_repair,
    "op2_spaced_seed_decontamination": op2_spaced_seed_decontamination,
    "op3_token_file": op3_token_file,
    "op4_convolutional_toxicity": op4_convolutional_toxicity,
    "op5_prefix_sum_shards": op5_prefix_sum_shards,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_setsketch_near_dedup": op7_setsketch_near_dedup,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_imatch_fingerprints": op9_imatch_fingerprints,
    "op10_diagonal_licenses": op10_diagonal_licenses,
    "op11_minimizer_periodic_runs": op11_minimizer_periodic_runs,
    "op12_redirect_equivalence": op12_redirect_equivalence,
    "op13_galloping_filter_audit": op13_galloping_filter_audit,
}

ORACLES: dict[str, str] = {
    "op7_setsketch_near_dedup": NEAR_DEDUP_SQL,
    "op12_redirect_equivalence": REDIRECTS_SQL,
    "op13_galloping_filter_audit": AUDIT_SQL,
}
