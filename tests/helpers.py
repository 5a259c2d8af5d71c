"""What the tests share besides fixtures."""


def rows(df, *columns):
    """Rows as sorted tuples, of the given columns or all."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.select(*names).collect()), key=repr)
