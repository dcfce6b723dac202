"""Demand forecast: clean, features, validation, folds, two-stage model, evaluation, scoring."""
