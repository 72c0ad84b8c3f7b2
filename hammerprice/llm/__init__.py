"""Operators for preparing text corpora and embeddings at scale.

Nothing outside this folder imports it; ``queries`` registers each operator on the benchmark tables.
"""
