"""Operators of a training-data pipeline: filters, sampling, tokens, duplicates, archives, decontamination."""
