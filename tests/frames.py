"""Reading of results; in a module of its own, since every test folder has a conftest."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples, nulls last."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: [(v is None, str(v)) for v in r])
