"""Vector expressions over array columns. Products and sums are made in double."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType


def dot(a: Column, b: Column) -> Column:
    """Inner product; null if the lengths differ or a vector is null."""
    terms = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the angle; null for a zero vector."""
    length = norm(a) * norm(b)
    return F.when(length != 0, dot(a, b) / length)


def has_bad_values(a: Column) -> Column:
    """Whether a component is null, NaN or infinite."""
    return F.exists(a, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))


@F.pandas_udf(BinaryType())
def to_bytes(vector: pd.Series) -> pd.Series:
    """Little-endian 32 bit floats, for interchange; null stays null."""
    return vector.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())


@F.pandas_udf(ArrayType(FloatType()))
def from_bytes(blob: pd.Series) -> pd.Series:
    """The vector of ``to_bytes``; null if the length is no multiple of four."""
    return blob.map(lambda b: None if b is None or len(b) % 4 else np.frombuffer(b, "<f4"))


def principal_components(df: DataFrame, vector: str, k: int = 2, out: str = "components") -> DataFrame:
    """``df`` with the coordinates of its centred vectors on the first k axes of variance; vectors are neither null nor of unequal length."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.withColumn("_raw", array_to_vector(F.col(vector).cast("array<double>")))
    centred = StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False).fit(rows).transform(rows)
    made = PCA(k=k, inputCol="_centred", outputCol="_axes").fit(centred).transform(centred)
    return made.withColumn(out, vector_to_array("_axes")).drop("_raw", "_centred", "_axes")
