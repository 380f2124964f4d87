"""Column expressions: everything here takes and returns a Spark ``Column``."""

from ledgerloom.functions.dates import (
    is_quarter_four,
    month_index,
    month_of,
    tenure_months,
)
from ledgerloom.functions.labels import bin_fixed, full_name, padded_id
from ledgerloom.functions.numbers import as_number, half_even, mean_of, percent, ratio

__all__ = [
    "as_number",
    "bin_fixed",
    "full_name",
    "half_even",
    "is_quarter_four",
    "mean_of",
    "month_index",
    "month_of",
    "padded_id",
    "percent",
    "ratio",
    "tenure_months",
]
