"""JSON messages: parsing with text leaves, casting, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.functions.once import with_once


CORRUPT = "_corrupt"


def with_parsed(df: DataFrame, name: str, text: Column, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Add JSON text as a struct column, parsed once per row.

    Bad JSON fails the job when strict, else gives NULL: the tolerant form asks Spark to
    mark corrupt records, because a line cut short would otherwise come back half filled.
    """
    if strict:
        return with_once(df, name, F.from_json(text, schema, {"mode": "FAILFAST"}))
    wire = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = with_once(df, name, F.from_json(text, wire, {"columnNameOfCorruptRecord": CORRUPT}))
    return parsed.withColumn(name, F.when(F.col(name)[CORRUPT].isNull(), F.col(name)))


def typed(struct: Column, fields: dict[str, str], strict: bool = False) -> list[Column]:
    """The struct's text leaves cast to their types; a bad value fails when strict, else NULL."""
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    return [cast(struct[name], kind).alias(name) for name, kind in fields.items()]


def json_text(keep_nulls: bool = False, **fields: Column) -> Column:
    """The given fields as JSON text, in the given order."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*(c.alias(name) for name, c in fields.items())), options)
