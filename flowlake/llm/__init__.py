"""Operators for preparing training text: ten operators, their queries, and the corpus pipeline's parts."""
