"""Operators for large training-data pipelines, and their queries.

Nothing outside this folder (and `corpus_pipeline.py`) imports it.
"""
