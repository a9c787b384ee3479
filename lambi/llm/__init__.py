"""Operators for preparing language-model training text on Spark.

Nothing outside this folder, its tests and ``corpus_pipeline.py`` imports it.
"""
