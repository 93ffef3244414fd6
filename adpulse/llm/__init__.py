"""Operators of a training-data pipeline (one module each) and their queries.

Nothing outside this folder imports it; ``__spark_entry__`` registers
``queries.QUERIES`` when the folder is present.
"""
