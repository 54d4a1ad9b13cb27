"""Tabular learning and analytics on Spark DataFrames."""

from tabml.operators.evaluate import evaluate
from tabml.operators.explain import explain
from tabml.operators.preprocess import TabularPreprocessor
from tabml.operators.profile import diagnose, profile_columns, profile_dataset
from tabml.operators.sampling import holdout, systematic_sample
from tabml.operators.training import train
from tabml.plans.pipeline import analyze, train_and_evaluate
from tabml.sources.delimited import read_table
from tabml.sources.rows import with_row_id

__all__ = [
    "TabularPreprocessor", "analyze", "diagnose", "evaluate", "explain", "holdout", "profile_columns", "profile_dataset",
    "read_table", "systematic_sample", "train", "train_and_evaluate", "with_row_id",
]
