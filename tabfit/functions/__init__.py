"""Column-level helpers.  Everything here returns a pyspark ``Column`` built
from built-in functions, so it stays inside whole-stage codegen."""

from tabfit.functions.dates import date_parts, split_date_parts
from tabfit.functions.sentinels import fill_sentinels, mask_sentinel, optional_label
from tabfit.functions.metrics import Metric, METRICS, rmsle, logloss, error_rate, merror, mlogloss

__all__ = [
    "date_parts", "split_date_parts", "fill_sentinels", "mask_sentinel", "optional_label",
    "Metric", "METRICS", "rmsle", "logloss", "error_rate", "merror", "mlogloss",
]
