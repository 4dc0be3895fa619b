"""Settings: defaults, then a JSON object, then the environment, then explicit values; blanks are ignored."""

from __future__ import annotations

import dataclasses
import json
import os
from typing import TypeVar

S = TypeVar("S")


def load(kind: type[S], text: str | None = None, prefix: str = "KB_", **explicit: object) -> S:
    """An instance of the dataclass `kind` from the layers; values from text and environment take the type of the default."""
    layers: list[dict[str, object]] = [json.loads(text) if text else {}, {f.name: os.environ.get(prefix + f.name.upper()) for f in dataclasses.fields(kind)}, explicit]
    chosen: dict[str, object] = {}
    for layer in layers:
        for f in dataclasses.fields(kind):
            value = layer.get(f.name)
            if value is None or value == "":
                continue
            if isinstance(value, str) and isinstance(f.default, bool):
                value = value.strip().lower() in ("1", "true", "yes", "on")
            elif isinstance(value, str) and isinstance(f.default, (int, float)):
                value = type(f.default)(value)
            chosen[f.name] = value
    return kind(**chosen)
