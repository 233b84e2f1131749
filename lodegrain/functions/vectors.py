"""Dense vectors in array columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; cosine for unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector at length one; a zero vector is null."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def is_zero(v: Column) -> Column:
    """Whether a vector is there and all of it is zero."""
    return v.isNotNull() & ~F.exists(v, lambda x: x != 0)


def quantise(v: Column, clip: Column) -> Column:
    """Components to -127 .. 127 relative to ``clip``, rounded half up, as tinyint."""
    return F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") / clip, F.lit(1.0)), F.lit(-1.0)) * 127 + 0.5).cast("tinyint"))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def half_precision(values: pd.Series) -> pd.Series:
    """Components rounded as 16-bit floats store them."""
    return values.map(lambda x: None if x is None else np.asarray(x, np.float16).astype(np.float32))
