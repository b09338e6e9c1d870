"""Reading the JSON document of a complement."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pondside.schemas import PAYLOAD


def _fields(kind: T.DataType) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in kind.fields}


def with_payload(frame: DataFrame, schema: str) -> DataFrame:
    """Replace `data` by its typed fields, parsing each document once.

    A key that is absent, null or of another type gives NULL; the quality rule
    `dq_json_type` reports the last case. Stored complements keep typed fields beside the document; where those
    have all that is asked for, nothing is parsed, and only their columns are read.
    """
    kept = [name for name in frame.columns if name not in ("data", PAYLOAD)]
    wanted = _fields(T.DataType.fromDDL(schema))
    held = _fields(frame.schema[PAYLOAD].dataType) if PAYLOAD in frame.columns else {}
    if all(held.get(name) == kind for name, kind in wanted.items()):
        return frame.select(*kept, *[F.col(f"{PAYLOAD}.{name}").alias(name) for name in wanted])
    parsed = frame.select(*kept, F.from_json("data", schema).alias("_payload"))
    return parsed.select(*kept, "_payload.*")


def kept_payload(frame: DataFrame, schema: str) -> DataFrame:
    """Add the typed fields of `data` as one column, for storing."""
    return frame.withColumn(PAYLOAD, F.from_json("data", schema))


def one_each(frame: DataFrame, kept: Sequence[Column | str], values: Column, name: str) -> DataFrame:
    """The `kept` columns and one row per element of an array, as `name`; none for no element.

    Written with the outer form: for the inner one Spark adds a filter on the size of the array,
    and pushes it below the parse, so that every document would be parsed again for it.
    """
    rows = frame.select(*kept, F.posexplode_outer(values).alias("_position", name))
    return rows.where(F.col("_position").isNotNull()).drop("_position")


def json_text(value: Column | str) -> Column:
    """A VARIANT field as the JSON text it had: quotes kept, JSON null as `null`."""
    return F.to_json(value)


def unquoted(text: Column | str) -> Column:
    """JSON text without its double quotes."""
    return F.replace(text, F.lit('"'), F.lit(""))
