def rows(df, *columns):
    """Collected rows as tuples, in result order."""
    picked = df.select(*columns) if columns else df
    return [tuple(row) for row in picked.collect()]


def by_key(df, key, *columns):
    """Rows as a dictionary from key to the other columns."""
    return {row[0]: tuple(row[1:]) for row in df.select(key, *columns).collect()}
