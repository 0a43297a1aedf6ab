"""Feature table of web behaviour, joined with the user by item matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.domains import TOP_DOMAINS, domain_vector
from ..operators.pivots import fill_zero
from ..operators.time_features import time_features


def feature_store(
    visits: DataFrame, matrix: DataFrame, n: int = TOP_DOMAINS, strip: str = "prefix"
) -> DataFrame:
    """``uid``, domain vector, working-time shares, weekday and hour counts, matrix columns.

    Every user with a web visit has one row; users missing in the matrix get 0 there. Each side
    is already grouped by ``uid``, so the joins reuse that partitioning.
    """
    vectors = domain_vector(visits, n, strip=strip)
    joined = vectors.join(time_features(visits), "uid").join(matrix, "uid", "left")
    return fill_zero(joined)
