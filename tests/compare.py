"""Compares a registered query with its SQL check, as sets of rows with their types."""

from decimal import Decimal


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return float(value)
    return value


TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def row_counts(columns, rows) -> dict:
    """Rows as a multiset, columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    counts: dict = {}
    for row in rows:
        key = tuple(repr(_plain(row[i])) for i in order)
        counts[key] = counts.get(key, 0) + 1
    return counts


def differences(frame, connection, text: str) -> str | None:
    """What differs between a DataFrame and a DuckDB query; None when nothing does."""
    relation = connection.execute(text)
    names = [column[0] for column in relation.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(set(names) ^ set(frame.columns))}"
    kinds = {column[0]: TYPES.get(str(column[1]), str(column[1])) for column in relation.description}
    if kinds != dict(frame.dtypes):
        return f"types {sorted(set(kinds.items()) ^ set(frame.dtypes))}"
    expected = row_counts(names, relation.fetchall())
    found = row_counts(frame.columns, [tuple(row) for row in frame.collect()])
    if expected == found:
        return None
    extra = [key for key in found if found[key] != expected.get(key)][:2]
    lacking = [key for key in expected if expected[key] != found.get(key)][:2]
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"only here {extra}; only there {lacking}"
    )
