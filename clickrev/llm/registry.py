"""The queries of this package, for the driver's entry."""
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from clickrev.llm.decontaminate import op5_qgram_decontamination
from clickrev.llm.fingerprint import op1_quartile_digest
from clickrev.llm.importance import op6_importance_resampling
from clickrev.llm.jaccard_join import op2_chosen_path_join
from clickrev.llm.language import op3_segmented_language
from clickrev.llm.packing import op7_retrieval_packing
from clickrev.llm.periodic import op11_lyndon_runs
from clickrev.llm.pii import op8_anchor_pii
from clickrev.llm.preference import PREFERENCE_SQL, op4_preference_format
from clickrev.llm.site_tree import op10_site_style_tree
from clickrev.llm.token_frames import op9_token_frames
from clickrev.llm.toxicity import op12_levenshtein_toxicity
from clickrev.llm.variants import op13_partenum_variants


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_quartile_digest,
        op2_chosen_path_join,
        op3_segmented_language,
        op4_preference_format,
        op5_qgram_decontamination,
        op6_importance_resampling,
        op7_retrieval_packing,
        op8_anchor_pii,
        op9_token_frames,
        op10_site_style_tree,
        op11_lyndon_runs,
        op12_levenshtein_toxicity,
        op13_partenum_variants,
    )
    return {query.__name__: query for query in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_preference_format": PREFERENCE_SQL}
