"""Small conversions shared by the tests."""


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())


def mapping(df, keys, value):
    keys = [keys] if isinstance(keys, str) else keys
    out = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = r[value]
    return out
