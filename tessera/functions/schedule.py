"""Learning-rate schedule as a column expression: linear warm-up, cosine
decay to a tenth of the base rate over ``total`` steps, floor afterwards."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def learning_rate(step, total, base: float, warmup: int = 0) -> Column:
    """``step < warmup``: ``base*step/warmup``; ``step > total``: ``base/10``;
    otherwise cosine from ``base`` down to ``base/10``. ``total = warmup``
    (no decay interval) gives the floor instead of dividing by zero."""
    s = F.col(step) if isinstance(step, str) else step
    t = F.col(total) if isinstance(total, str) else F.lit(total)
    floor = base / 10.0
    s_d = s.cast("double")
    ratio = (s_d - F.lit(float(warmup))) / (t.cast("double") - F.lit(float(warmup)))
    cosine = F.lit(floor) + F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * ratio)) * F.lit(base - floor)
    warm = (F.lit(float(base)) * s_d / F.lit(float(warmup))) if warmup > 0 else F.lit(None)
    return (F.when(s < F.lit(warmup), warm)
            .when(s > t, F.lit(floor))
            .when(t == F.lit(warmup), F.lit(floor))
            .otherwise(cosine))
