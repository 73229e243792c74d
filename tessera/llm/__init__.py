"""Operators of a training-data pipeline: dedup, mixing, decontamination, scoring, sharding, output."""
