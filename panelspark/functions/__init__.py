"""Column-level helpers (scalar expressions, quantiles, distribution functions)."""

from panelspark.functions.scalar import (  # noqa: F401
    band_score, classify_bias, classify_importance, classify_overfit, classify_persistence,
    nan_to_null, trend_label, try_double,
)
from panelspark.functions.quantiles import exact_quantiles, medians_wide  # noqa: F401
