"""Pipelines composed from operators."""
