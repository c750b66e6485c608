"""Column names that cannot clash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unused(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores added where docs have such a column in any case."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def by_place(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns `names` as c0, c1, ..., and `text` as itself unless it is one of them."""
    picked = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]
    return docs.select(*picked, *([] if "text" in names else [F.col("text")]))
