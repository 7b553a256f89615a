"""What several test modules share."""


def values(df, *cols):
    """Rows as tuples, for comparing small results."""
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
