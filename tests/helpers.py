def rows(df, *cols):
    """The rows as sorted tuples of the given (or all) columns."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
