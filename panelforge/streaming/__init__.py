"""Streaming use of the row-level derive steps (the reference itself has no streaming operators)."""
