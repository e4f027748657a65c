"""Column expressions over text lines, templates and document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """NULL, empty, or whitespace only."""
    return text.isNull() | ~text.rlike(r"\P{javaWhitespace}")


def parts(text: Column, delimiter: str = ",") -> Column:
    """Split; trailing empty parts are dropped, inner and leading ones kept.

    An empty line has one empty part. A line of delimiters only has none.
    """
    kept = F.rtrim(text, F.lit(delimiter))
    none = F.array().cast("array<string>")
    return F.when((text != "") & (kept == ""), none).otherwise(F.split(kept, _literal(delimiter)))


def _literal(delimiter: str) -> str:
    if len(delimiter) != 1:
        raise ValueError("a delimiter is one character")
    return "[" + ("\\" + delimiter if delimiter in "\\^[]-" else delimiter) + "]"


def query_url(base: str, value: Column, param: str = "id") -> Column:
    """``<base>?<param>=<value>``"""
    return F.concat(F.lit(f"{base}?{param}="), value.cast("string"))


def braced_text(fields: dict[str, Column]) -> Column:
    """Record as the multi-line ``{key:value,}`` text of the behaviour messages (not JSON).

    A NULL prints as ``null``; the text starts and ends with a line break.
    """
    shown = [F.concat(F.lit(k + ":"), F.coalesce(v.cast("string"), F.lit("null"))) for k, v in fields.items()]
    return F.concat(F.lit("\n{\n"), F.concat_ws(",\n", *shown), F.lit("\n}\n"))


def doc_id(*parts_: Column) -> Column:
    """Document id: the parts joined by ``_``; NULL if any part is."""
    joined: list[Column] = []
    for p in parts_:
        joined += [F.lit("_"), p.cast("string")]
    return F.concat(*joined[1:])


def route_key(value: Column, prefix: str = "hp_") -> Column:
    """Table name of a device: the prefix, then the serial number with ``-`` as ``_``."""
    return F.concat(F.lit(prefix), F.translate(value, "-", "_"))


def _escaped(text: Column, specials: str) -> Column:
    return F.regexp_replace(text, "([" + specials + "])", r"\\$1")


def line_protocol(measurement: str, tags: dict[str, Column], fields: dict[str, Column]) -> Column:
    """Time-series line ``measurement,tag=v,... field=v,...`` with names in sorted order.

    Empty tags and NULL fields are left out; a row without any field gives NULL.
    Fields are printed as they are, so text fields need ``quoted``.
    """
    head = [
        F.when(
            v.isNotNull() & (v.cast("string") != ""),
            F.concat(F.lit(k + "="), _escaped(v.cast("string"), ",= ")),
        )
        for k, v in sorted(tags.items())
    ]
    body = F.concat_ws(
        ",", *(F.concat(F.lit(k + "="), v.cast("string")) for k, v in sorted(fields.items()))
    )
    return F.when(body != "", F.concat(F.concat_ws(",", F.lit(measurement), *head), F.lit(" "), body))


def quoted(text: Column) -> Column:
    """Text field of a time-series line."""
    return F.concat(F.lit('"'), _escaped(text, r'"\\'), F.lit('"'))
