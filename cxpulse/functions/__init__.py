"""Column functions: pure expressions, no actions, no UDFs."""

from .dates import as_date, on_or_after, stamp, week_label, week_start, within
from .folding import fold
from .scores import combined, exact, mean, measures, n_rows, net_score, safe_ratio, share_of, sum_of_sums, target_or_default, target_pct, to_number
from .text import render

__all__ = [
    "as_date", "on_or_after", "stamp", "week_label", "week_start", "within",
    "fold", "combined", "exact", "mean", "measures", "n_rows", "net_score",
    "safe_ratio", "share_of", "sum_of_sums", "target_or_default", "target_pct",
    "to_number", "render",
]
