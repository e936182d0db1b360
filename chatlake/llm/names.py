"""Column names of an operator's own, whatever the names in its input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """A name for each stem that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
