"""Helpers shared by the test modules; conftest.py holds fixtures only."""


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)
