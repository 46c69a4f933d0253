"""Column expressions over score arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from intentloom.functions.text import let


def softmax(logits: str | Column) -> Column:
    """Softmax shifted by the row maximum, so large logits do not overflow."""
    source = F.col(logits) if isinstance(logits, str) else logits

    def shifted(x: Column) -> Column:
        return let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top)))

    def scaled(e: Column) -> Column:
        return let(
            F.aggregate(e, F.lit(0.0).cast("double"), lambda a, v: a + v), lambda s: F.transform(e, lambda v: v / s)
        )

    return let(let(source, shifted), scaled)


def argmax(values: str | Column) -> Column:
    """0-based position of the largest value; the first one on a tie."""
    source = F.col(values) if isinstance(values, str) else values
    return let(source, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def minmax(values: str | Column, epsilon: float = 1e-8) -> Column:
    """Scale an array to [0, 1]."""
    source = F.col(values) if isinstance(values, str) else values

    def scale(v: Column) -> Column:
        span = F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi"))
        return let(
            span, lambda s: F.transform(v, lambda x: (x - s["lo"]) / (s["hi"] - s["lo"] + F.lit(epsilon)))
        )

    return let(source, scale)


def fallback_name(name: str | Column, label: str | Column) -> Column:
    """The dictionary name, or ``class_<n>`` for a label the dictionary lacks."""
    shown = F.col(name) if isinstance(name, str) else name
    number = F.col(label) if isinstance(label, str) else label
    return F.coalesce(shown, F.concat(F.lit("class_"), number.cast("string")))
