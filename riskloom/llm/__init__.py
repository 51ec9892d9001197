"""Operators for training-data pipelines over text and embedding tables.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
