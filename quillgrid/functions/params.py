"""Parameters of steps as they come from a configuration: texts read as what a step's function takes."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Mapping
from functools import lru_cache

#: Readers by the names of types. Fixed names.
READERS: dict[str, Callable] = {
    "int": lambda v: int(float(v)), "float": float, "str": str, "bool": lambda v: str(v).strip().lower() in ("1", "true", "y", "yes", "t", "on"), "list": lambda v: v if not isinstance(v, str) else json.loads(v),
}


@lru_cache(maxsize=1024)
def kinds(f: Callable) -> dict[str, str]:
    """The reader's name for each parameter of a function that says what it takes."""
    out = {}
    for name, p in inspect.signature(f).parameters.items():
        note = p.annotation if isinstance(p.annotation, str) else p.annotation.__name__ if isinstance(p.annotation, type) else str(p.annotation)
        note = note.replace(" ", "").removesuffix("|None")
        if note in READERS:
            out[name] = note
        elif note.startswith(("Sequence", "list", "tuple")):
            out[name] = "list"
        elif p.default is not inspect.Parameter.empty and type(p.default).__name__ in READERS:
            out[name] = type(p.default).__name__
    return out


def typed(f: Callable, params: Mapping, types: Mapping[str, str] | None = None) -> dict:
    """params as f takes them: texts are read by its parameters' types, or by `types`; other values, and null, stay. A text that can't be read is an error that names it."""
    known, out = {**kinds(f), **(types or {})}, {}
    for name, value in params.items():
        if name in known and isinstance(value, str) and known[name] != "str":
            if value.strip().lower() in ("", "none", "null"):
                value = None
            else:
                try:
                    value = READERS[known[name]](value)
                except ValueError as e:
                    raise ValueError(f"{name} is no {known[name]}: {value}") from e
        elif name in known and known[name] == "int" and isinstance(value, float) and value.is_integer():
            value = int(value)
        out[name] = value
    return out
