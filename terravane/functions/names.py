"""Column-name rules. Only the schema is touched; no data moves."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def _reject_clashes(names: list[str]) -> None:
    clashes = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clashes:
        raise ValueError(f"column names clash after renaming: {sorted(clashes)}")


def number_duplicates(names: list[str]) -> list[str]:
    """Give every member of a group of equal names a running suffix."""
    sizes, seen, out = Counter(names), Counter(), []
    for name in names:
        out.append(f"{name}_{seen[name]}" if sizes[name] > 1 else name)
        seen[name] += 1
    return out


def sanitize_columns(df: DataFrame, on_clash: str = "fail") -> DataFrame:
    """Replace each character that is not an ASCII letter or digit by ``_``."""
    names = [re.sub(r"[^a-zA-Z0-9]", "_", c) for c in df.columns]
    if on_clash == "suffix":
        names = number_duplicates(names)
    _reject_clashes(names)
    return df.toDF(*names)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case, turn white space into ``_``, drop every other odd character.

    Names that become equal are all numbered from zero.
    """
    cleaned = []
    for name in df.columns:
        name = re.sub(r"\s+", "_", name.lower())
        cleaned.append(re.sub(r"[^a-zA-Z0-9_]", "", name) or "unnamed_col")
    names = number_duplicates(cleaned)
    _reject_clashes(names)
    return df.toDF(*names)


def strip_column_names(df: DataFrame) -> DataFrame:
    names = [c.strip() for c in df.columns]
    _reject_clashes(names)
    return df.toDF(*names)


def landed_name(name: str) -> str:
    """The spelling a raw header has after landing."""
    return re.sub(r"[^a-zA-Z0-9]", "_", name)


def find_column(df: DataFrame, *names: str) -> str | None:
    """First of ``names`` present in ``df``, in its raw or its landed spelling."""
    for name in names:
        for spelling in (name, landed_name(name)):
            if spelling in df.columns:
                return spelling
    return None
