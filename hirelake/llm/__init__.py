"""Operators of a training-data pipeline (see the README's section on them).

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
