"""The engine's public names in one place. Tables are DataFrames; text and similarity functions are columns."""

from corvane.functions.similarity import *  # noqa: F403
from corvane.functions.text import (  # noqa: F401
    fingerprint_address,
    fingerprint_country,
    fingerprint_name,
    fingerprint_text,
    normalize_business_address,
    normalize_business_name,
    normalize_country,
    normalize_text,
)
from corvane.operators.blocking import (  # noqa: F401
    BlockingConfig,
    add_fingerprint_columns,
    add_normalized_columns,
    apply_key_frequency_cap,
    cap_key_frequency,
    fuse_candidate_pairs,
    generate_candidate_pairs,
    generate_candidates_for_target,
    run_composite_block,
    run_name_token_block,
    run_signature_block,
    run_single_key_block,
)
from corvane.operators.blocking import non_empty_fingerprint as non_empty_fingerprint_mask  # noqa: F401
from corvane.operators.contracts import (  # noqa: F401
    validate_candidate_ids,
    validate_candidate_pairs,
    validate_fingerprint_columns,
    validate_source,
)
from corvane.operators.decisions import ConflictEngine, OutputGenerator  # noqa: F401
from corvane.operators.evaluation import binary_metrics as calculate_binary_metrics  # noqa: F401
from corvane.operators.evaluation import candidate_distribution as calculate_candidate_distribution  # noqa: F401
from corvane.operators.evaluation import candidate_recall as calculate_candidate_recall  # noqa: F401
from corvane.operators.evaluation import classify_candidate_errors, label_candidate_pairs, summarize_candidates  # noqa: F401
from corvane.operators.evaluation import entity_metrics as calculate_entity_metrics  # noqa: F401
from corvane.operators.evaluation import is_true_match  # noqa: F401
from corvane.operators.evaluation import macro_metrics as calculate_macro_metrics  # noqa: F401
from corvane.operators.evaluation import retrieval_report as calculate_retrieval_report  # noqa: F401
from corvane.operators.evaluation import true_matches as get_true_matches  # noqa: F401
from corvane.operators.features import FeatureEngineer, get_feature_columns  # noqa: F401
from corvane.operators.matcher import EntityMatcher, ThresholdOptimizer, ThresholdResult, split_source1_entities  # noqa: F401
from corvane.plans.linkage import InferencePipeline, MatcherTrainer, TrainingResult  # noqa: F401
from corvane.sources.tsv import load_source, load_test_sources, load_training_sources, parse_ground_truth  # noqa: F401
