"""Operators for preparing training corpora; their registered queries are in ``queries``."""
