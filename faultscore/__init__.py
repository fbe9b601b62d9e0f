"""faultscore: leakage-aware rare-event classification on Spark DataFrames."""

from .operators.audit import audit_summary, feature_target, validate
from .operators.metrics import binary_metrics, confusion_matrix, ranking_metrics
from .operators.scoring import predict_rows, write_predictions
from .operators.split import allocate, hash_split, split_summary, stratified_split
from .operators.threshold import select_threshold, threshold_sweep
from .plans.experiment import prepare, run_experiment, train_candidates
from .schema import DOCUMENT_TASK, MACHINE_CSV_TASK, MACHINE_TASK, ORDER_TASK, TaskSpec
from .sources.bundle import Bundle, load_bundle, save_bundle

__all__ = [
    "Bundle", "DOCUMENT_TASK", "MACHINE_CSV_TASK", "MACHINE_TASK", "ORDER_TASK", "TaskSpec", "allocate", "audit_summary",
    "binary_metrics", "confusion_matrix", "feature_target", "hash_split", "load_bundle", "predict_rows",
    "prepare", "ranking_metrics", "run_experiment", "save_bundle", "select_threshold", "split_summary",
    "stratified_split", "threshold_sweep", "train_candidates", "validate", "write_predictions",
]
