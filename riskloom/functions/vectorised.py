"""The suspicion score as an Arrow UDF.

Kept to measure against the native expression in ``rules``, which is the one to use.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskloom.functions.rules import RISKY_CUSTOMER, RISKY_CUSTOMER_SCORE, SCORE_CAP, SCORE_SCALE


@F.arrow_udf(DoubleType())
def suspicion_score_batch(amount: pa.Array, customer_risk: pa.Array) -> pa.Array:
    """Same values as ``rules.suspicion_score``: a null amount scores 0, NaN stays NaN up to the cap's rule."""
    base = pc.divide(pc.fill_null(amount.cast(pa.float64()), 0.0), float(SCORE_SCALE))
    above = pc.fill_null(pc.greater(customer_risk.cast(pa.float64()), float(RISKY_CUSTOMER)), False)
    total = pc.add(base, pc.if_else(above, float(RISKY_CUSTOMER_SCORE), 0.0))
    return pc.if_else(pc.greater(total, float(SCORE_CAP)), float(SCORE_CAP), total)
