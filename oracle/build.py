"""Puts a check query together: the relations and fragments it names become its CTEs."""

import re

from pondside.sources.star import DERIVED, TABLES, relation_sql

# The documents that can be read; `raw_<relation>` keeps the others.
READABLE = """SELECT * REPLACE (CASE WHEN json_valid(data) AND json_type(data) = 'OBJECT' THEN data END AS data)
    FROM ({}) documents"""


def assemble(body: str, fragments: dict[str, str]) -> str:
    """`body` behind a WITH list of every `d_<relation>`, `raw_<relation>` and fragment it needs, in order."""
    parts: dict[str, str] = {}

    def add(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if word in parts:
                continue
            if word in fragments:
                add(fragments[word])
                parts[word] = fragments[word]
            elif word.startswith(("d_", "raw_")) and word.split("_", 1)[1] in DERIVED:
                text = relation_sql(word.split("_", 1)[1], {table: table for table in TABLES})
                readable = word.startswith("d_") and re.search(r"\bAS data\b", text)
                parts[word] = READABLE.format(text) if readable else text

    add(body)
    listed = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {listed}\n{body}"
