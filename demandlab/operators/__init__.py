"""Operators: panel building, features, sampling, statistics, estimators."""
