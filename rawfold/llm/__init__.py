"""Operators of a training-data pipeline: dedup, decontamination, language and toxicity models,
n-gram scoring, licence scans, chat formatting, mixing and token output.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
