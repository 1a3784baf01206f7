"""Operators of a training-data pipeline: one module per operator, ``queries`` registers them.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` uses it.
"""
