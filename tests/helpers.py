"""Frames and row sets for tests."""


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
