"""Operators of a training-data pipeline (tokenising, dedup, decontamination, sharding, ...).

Nothing else in the library imports this subpackage; ``queries`` registers its queries.
"""
