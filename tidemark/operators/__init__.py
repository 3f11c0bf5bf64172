"""Operators: cleaning, snapshots, validation folds, ranking, metrics, models, diagnostics."""
