"""Operators of a training-data pipeline. Nothing outside this folder, corpus_pipeline.py and the entry file imports them."""
