"""Operators that prepare training data: sharding, language ID, search, deduplication, toxicity, packing, BPE.

Nothing else in the package imports this folder; ``queries.py`` registers one query per operator.
"""
