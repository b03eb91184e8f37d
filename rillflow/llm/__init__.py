"""Operators for preparing training text: ten dealt operators, their queries and SQL."""
