"""Operators of a training-data pipeline: deduplication, decontamination, classifiers, tokens and token files."""
