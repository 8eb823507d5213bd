"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsearch.functions.text import let


def norm(v: Column | str) -> Column:
    """L2 norm, summed in double precision."""
    v = F.col(v) if isinstance(v, str) else v
    return F.sqrt(F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    ))


def normalise(v: Column | str) -> Column:
    """Vector of length one; a zero vector stays as it is."""
    v = F.col(v) if isinstance(v, str) else v
    return let(norm(v), lambda n: F.transform(
        v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x).cast("float")
    ))
