"""Registered queries of the numbered operators, and the same questions in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sliceward.llm.block_anchors import OP5_SQL, op5_block_anchors
from sliceward.llm.blockmax_topk import OP7_SQL, op7_blockmax_topk
from sliceward.llm.column_repeats import OP9_SQL, op9_column_repeats
from sliceward.llm.deleted_interpolation import op2_deleted_interpolation
from sliceward.llm.kneser_ney_quality import op10_kneser_ney_quality
from sliceward.llm.latent_decontamination import op6_latent_decontamination
from sliceward.llm.license_scan import OP1_SQL, op1_license_scan
from sliceward.llm.merge_replay import op11_merge_replay
from sliceward.llm.pareto_mix import OP8_SQL, op8_pareto_mix
from sliceward.llm.rtree_negatives import OP12_SQL, op12_rtree_negatives
from sliceward.llm.simhash_anchors import op4_simhash_anchors
from sliceward.llm.spectral_whitening import op13_spectral_whitening
from sliceward.llm.toxicity_pu import op3_toxicity_pu

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_deleted_interpolation": op2_deleted_interpolation,
    "op3_toxicity_pu": op3_toxicity_pu,
    "op4_simhash_anchors": op4_simhash_anchors,
    "op5_block_anchors": op5_block_anchors,
    "op6_latent_decontamination": op6_latent_decontamination,
    "op7_blockmax_topk": op7_blockmax_topk,
    "op8_pareto_mix": op8_pareto_mix,
    "op9_column_repeats": op9_column_repeats,
    "op10_kneser_ney_quality": op10_kneser_ney_quality,
    "op11_merge_replay": op11_merge_replay,
    "op12_rtree_negatives": op12_rtree_negatives,
    "op13_spectral_whitening": op13_spectral_whitening,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": OP1_SQL,
    "op5_block_anchors": OP5_SQL,
    "op7_blockmax_topk": OP7_SQL,
    "op8_pareto_mix": OP8_SQL,
    "op9_column_repeats": OP9_SQL,
    "op12_rtree_negatives": OP12_SQL,
}
