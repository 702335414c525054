"""Helpers of the tests."""


def rows(df, *by):
    """Rows as sorted tuples, for comparing small frames."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
