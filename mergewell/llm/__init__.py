"""Corpus-scale operators for training-data pipelines.

Nothing outside this subpackage imports it; ``queries`` lists the registered queries.
"""
