"""Shared by the tests (imported by name, so no test folder's conftest can shadow it)."""


def rows(df, *cols):
    """Collected rows as tuples (optionally of selected columns), sorted."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
