"""Step lists: named steps with parameters applied in order; unknown names are skipped with a warning."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from quillgrid.functions.params import typed


@dataclass(frozen=True)
class Step:
    name: str
    param: Mapping = field(default_factory=dict)


@dataclass
class Registry:
    """Functions (DataFrame, **param) -> DataFrame by name, with the types their parameters are read as."""

    functions: dict[str, tuple[Callable[..., DataFrame], dict[str, str]]] = field(default_factory=dict)

    def add(self, name: str, **types: str):
        def register(f):
            self.functions[name] = (f, types)
            return f

        return register

    def run(self, df: DataFrame, steps: Sequence[Step], cache: dict[str, DataFrame] | None = None) -> DataFrame:
        """`cache` and `load` keep and bring back a DataFrame by key."""
        cache = {} if cache is None else cache
        for step in steps:
            if step.name == "cache":
                cache[step.param["key"]] = df
            elif step.name == "load":
                df = cache[step.param["key"]]
            elif step.name in self.functions:
                f, types = self.functions[step.name]
                df = f(df, **typed(f, step.param, types))
            else:
                warnings.warn(f"unknown step {step.name}", stacklevel=2)
        return df


CLEANSING = Registry()


@CLEANSING.add("remove_whitespace")
def _remove_whitespace(df, column="text"):
    from quillgrid.functions.text import remove_whitespace

    return df.withColumn(column, remove_whitespace(df[column]))


@CLEANSING.add("sanitize_text")
def _sanitize(df, column="text", keep_chars=":().", extra_chars="_ㆍ"):
    from quillgrid.functions.text import sanitize_text

    return df.withColumn(column, sanitize_text(df[column], keep_chars, extra_chars))


@CLEANSING.add("decimal")
def _decimal(df, column="text", pattern=""):
    from quillgrid.functions.text import decimal_text

    return df.withColumn(column, decimal_text(df[column], pattern))


#: Presets: what a pipeline stage usually runs.
PRESETS = {
    "cleansing": [Step("remove_whitespace"), Step("sanitize_text")],
    "decimal": [Step("remove_whitespace"), Step("decimal", {"pattern": r"[0-9]+(\.[0-9]+)?$"})],
}
