"""Operators of a training-data pipeline: cleaning, deduplication, mixing, tokens, search.

One module per operator; ``queries`` applies each to its whole table. Nothing else in the library
imports this folder.
"""
