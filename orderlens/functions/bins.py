"""Labelled intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed_bin(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the interval ``(edge, next edge]`` the value falls in; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    cases = " ".join(
        f"WHEN {column} > {lo!r}D AND {column} <= {hi!r}D THEN '{label}'"
        for lo, hi, label in zip(map(float, edges), map(float, edges[1:]), labels)
    )
    return F.expr(f"CASE {cases} END")
