"""Job settings from YAML: connector blocks under ``app``, tables, named SQL scripts.

``${NAME}`` in a value is read from the environment, so a file holds no secrets.
"""

from __future__ import annotations

import os
import re
from typing import Any

import yaml

_NAME = re.compile(r"\$\{(\w+)\}")


def _filled(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: _filled(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_filled(v) for v in value]
    if isinstance(value, str):
        return _NAME.sub(lambda m: _from_env(m.group(1)), value)
    return value


def _from_env(name: str) -> str:
    if name not in os.environ:
        raise KeyError(f"the settings need the environment variable {name}")
    return os.environ[name]


def load_config(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        return parse_config(f.read())


def parse_config(text: str) -> dict[str, Any]:
    return _filled(yaml.safe_load(text) or {})


def block(config: dict[str, Any], name: str, instance: str | None = None) -> dict[str, Any]:
    """Settings of one connector, such as ``kafka.source``, or of one named instance of it.

    Keys may be written nested or with dots.
    """
    found: Any = config.get("app") or {}
    wanted = [*name.split("."), *([instance] if instance else [])]
    return _descend(found, wanted, name if instance is None else f"{name}.{instance}")


def _descend(node: Any, path: list[str], shown: str) -> Any:
    if not path:
        return node
    if isinstance(node, dict):
        for take in range(len(path), 0, -1):
            key = ".".join(path[:take])
            if key in node:
                return _descend(node[key], path[take:], shown)
        known = ", ".join(sorted(map(str, node))) or "none"
    else:
        known = "none"
    raise KeyError(f"no settings for {shown}; known here: {known}")
