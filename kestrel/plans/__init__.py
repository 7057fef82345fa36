"""Pipelines, one per source model: ``f(inputs, **params) -> DataFrame``."""
