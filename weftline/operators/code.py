"""User code over named inputs: callables, `module.function` names, commands, row functions."""

from __future__ import annotations

import importlib
import importlib.util
import inspect
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, functions as F

from weftline.functions.columns import quote

# --- fixed values: names looked for in a module, in this order ---
SCRIPT_ENTRY_POINTS = ("main", "run", "execute")
FILE_ENTRY_POINTS = ("transform", "main")
# --- end of fixed values ---


def resolve(target: str | Callable, entry_points: tuple[str, ...] = FILE_ENTRY_POINTS + SCRIPT_ENTRY_POINTS[1:]) -> Callable:
    """A callable as it is, `package.module.function`, or the entry point of a `.py` file."""
    if callable(target):
        return target
    if "\n" in target or target.lstrip().startswith("def "):
        raise ValueError("code inside a spec is not run; register the function by name or give module.function")
    if target.endswith(".py"):
        path = Path(target)
        spec = importlib.util.spec_from_file_location(path.stem, path)
        if spec is None or not path.exists():
            raise FileNotFoundError(target)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        for name in entry_points:
            if callable(getattr(module, name, None)):
                return getattr(module, name)
        raise AttributeError(f"{target} defines none of {', '.join(entry_points)}")
    module_name, _, function = target.rpartition(".")
    if not module_name:
        raise ValueError(f"expected module.function, got {target!r}")
    return getattr(importlib.import_module(module_name), function)


def run_callable(target: str | Callable, inputs: dict[str, DataFrame], context: dict | None = None, **params) -> DataFrame:
    """Call with as much of (inputs, context, named parameters) as the function asks for.

    The function gets lazy DataFrames and returns one; no row reaches the driver.
    """
    fn, context = resolve(target), dict(context or {})
    signature = inspect.signature(fn)
    takes_any = any(p.kind is p.VAR_KEYWORD for p in signature.parameters.values())
    positional = [p for p in signature.parameters.values() if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)]
    args = [inputs] if positional else []
    named = {**params}
    names = {p.name for p in positional[1:]} | {p.name for p in signature.parameters.values() if p.kind is p.KEYWORD_ONLY}
    if "context" in names:
        named["context"] = context
    elif len(positional) > 1 and positional[1].name not in params and positional[1].default is inspect.Parameter.empty:
        args.append(context)
    named.update({k: v for k, v in context.items() if takes_any or k in names})
    if not takes_any:
        named = {k: v for k, v in named.items() if k in names}
    result = fn(*args, **named)
    if not isinstance(result, DataFrame):
        raise TypeError(f"{getattr(fn, '__name__', fn)} returned {type(result).__name__}, not a DataFrame")
    return result


def through_command(df: DataFrame, columns: list[str], command: str, schema: str) -> DataFrame:
    """Stream rows as tab-separated text through a command, one process per task."""
    view = "_through_command"
    df.select(*[F.col(quote(c)).cast("string") for c in columns]).createOrReplaceTempView(view)
    escaped = command.replace("\\", "\\\\").replace("'", "\\'")
    picked = ", ".join(quote(c) for c in columns)
    return df.sparkSession.sql(f"SELECT TRANSFORM({picked}) USING '{escaped}' AS ({schema}) FROM {view}")
