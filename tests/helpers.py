def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns by default)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
