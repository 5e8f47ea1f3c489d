"""Operators for training-data pipelines.

Self-contained: nothing outside this subpackage imports it, except the
guarded registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
