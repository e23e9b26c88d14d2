"""Whole pipelines made of the operators."""

from .comparison import compare_stored, store_predictions, validation_predictions
from .etl import load_and_unify, load_sources
from .ml_dataset import build_ml_dataset, write_ml_dataset
from .prediction import batch_predict
from .sequence_study import SequenceStudy, read_study, sequence_study, write_study
from .summary_store import stored_summary, update_summary
from .training import Models, load_model, save_model, train_all, train_target

__all__ = [
    "Models", "SequenceStudy", "batch_predict", "build_ml_dataset", "compare_stored", "load_and_unify", "load_model",
    "load_sources", "read_study", "save_model", "sequence_study", "store_predictions", "stored_summary", "train_all",
    "train_target", "update_summary", "validation_predictions", "write_ml_dataset", "write_study",
]
