"""Whole pipelines: the shift mart and the table loader."""
