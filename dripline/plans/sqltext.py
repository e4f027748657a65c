"""The text of SQL scripts: statements, and table declarations with connector options.

Only what Spark SQL does not read itself is looked at here. What can't be read fails by name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

_PIECE = re.compile(
    r"""(?P<quoted>'(?:[^']|'')*'|"(?:[^"]|"")*"|`(?:[^`]|``)*`)
      | (?P<comment>--[^\n]*|/\*.*?\*/)
      | (?P<end>;)
      | (?P<plain>[^'"`;/-]+|[/-](?!\*))
      | (?P<open>.)""",
    re.VERBOSE | re.DOTALL,
)
_TABLE = re.compile(
    r"CREATE\s+(?:TEMPORARY\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?`?(\w+)`?\s*\((.*)\)\s*WITH\s*\((.*)\)", re.I | re.DOTALL
)
_OPTION = re.compile(r"\s*'((?:[^']|'')*)'\s*=\s*'((?:[^']|'')*)'\s*(?:,|$)")
_WATERMARK = re.compile(r"WATERMARK\s+FOR\s+`?(\w+)`?\s+AS\s+`?\1`?(?:\s*-\s*INTERVAL\s+'(\d+)'\s+(\w+?)S?)?", re.I)
_COMPUTED = re.compile(r"`?(\w+)`?\s+AS\s+(.+)", re.I | re.DOTALL)
_COLUMN = re.compile(r"`?(\w+)`?\s+([A-Za-z]\w*(?:\s*\([\d\s,]*\))?)(?:\s+NOT\s+NULL)?", re.I)


def statements(script: str) -> list[str]:
    """The script's statements without comments; quotes may hold ``;``, ``--`` and ``/*``."""
    out = [""]
    for piece in _PIECE.finditer(script):
        if piece.lastgroup == "open":
            line = script.count("\n", 0, piece.start()) + 1
            raise ValueError(f"unmatched {script[piece.start() : piece.start() + 2].strip()!r} in line {line} of the script")
        if piece.lastgroup == "end":
            out.append("")
        else:
            out[-1] += " " if piece.lastgroup == "comment" else piece.group()
    return [s.strip() for s in out if s.strip()]


def comma_parts(body: str) -> list[str]:
    """Parts between the commas that stand outside of quotes and brackets."""
    parts, depth = [""], 0
    for piece in re.findall(r"'(?:[^']|'')*'|`[^`]*`|[^'`]", body):
        depth += (piece == "(") - (piece == ")")
        if piece == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += piece
    return [p.strip() for p in parts if p.strip()]


@dataclass
class Declared:
    """A declared table: typed columns, computed ones, its watermark and its options."""

    name: str
    columns: dict[str, str] = field(default_factory=dict)
    computed: dict[str, str] = field(default_factory=dict)
    watermark: dict[str, str] | None = None
    options: dict[str, str] = field(default_factory=dict)


def declared(statement: str) -> Declared | None:
    """What ``CREATE TABLE … (…) WITH (…)`` declares; None for any other statement."""
    found = _TABLE.fullmatch(statement)
    if found is None:
        return None
    table = Declared(found[1])
    for part in comma_parts(found[2]):
        if m := _WATERMARK.fullmatch(part):
            table.watermark = {"column": m[1], "delay": f"{m[2] or 0} {(m[3] or 'second').lower()}s"}
        elif m := _COMPUTED.fullmatch(part):
            table.computed[m[1]] = m[2]
        elif m := _COLUMN.fullmatch(part):
            table.columns[m[1]] = re.sub(r"(?i)^timestamp.*", "timestamp", m[2])
        else:
            raise ValueError(f"cannot read column {part!r} of table {table.name}")
    at = 0
    while at < len(found[3].rstrip()):
        m = _OPTION.match(found[3], at)
        if m is None:
            raise ValueError(f"cannot read option {found[3][at:].strip()!r} of table {table.name}")
        table.options[m[1].replace("''", "'")] = m[2].replace("''", "'")
        at = m.end()
    return table


def settings_of(table: Declared, sink: bool) -> dict[str, Any]:
    """The settings block that says the same as the options of a declared table."""
    rest = dict(table.options)
    connector = rest.pop("connector", None)
    if connector == "print" and sink:
        made = {"sink": "console"}
        if "print-identifier" in rest:
            made["prefix"] = rest.pop("print-identifier")
    elif connector == "filesystem":
        made = {"sink" if sink else "kind": rest.pop("format", "parquet"), "path": rest.pop("path")}
        for option in ("checkpoint", "trigger") if sink else ():
            if option in rest:
                made[option] = rest.pop(option)
    elif connector == "datagen" and not sink:
        made = {"kind": "datagen"}
        names = {"start": "start", "end": "end", "min": "low", "max": "high", "length": "length"}
        for option in list(rest):
            m = re.fullmatch(r"fields\.(f_sequence|f_random|f_random_str)\.(kind|start|end|min|max|length)", option)
            if option == "rows-per-second":
                made["rows_per_second"] = int(rest.pop(option))
            elif m and m[2] != "kind":
                made[names[m[2]]] = int(rest.pop(option))
            elif m and rest[option] == ("sequence" if m[1] == "f_sequence" else "random"):
                rest.pop(option)
            elif option == "number-of-rows":
                made["number_of_rows"] = int(rest.pop(option))
            elif (own := re.fullmatch(r"fields\.(\w+)\.(kind|start|end|min|max|length)", option)) and own[1] in table.columns:
                value = rest[option]
                if own[2] != "kind" or value in ("sequence", "random"):
                    rest.pop(option)
                    made.setdefault("fields", {}).setdefault(own[1], {})[own[2]] = value if own[2] == "kind" else int(value)
    else:
        raise ValueError(f"connector {connector!r} of table {table.name} is not offered as a {'sink' if sink else 'source'}")
    if rest:
        raise ValueError(f"unknown options of table {table.name}: {', '.join(sorted(rest))}")
    return made
