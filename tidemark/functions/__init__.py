from tidemark.functions.aggregates import exact_sum, n_unique
from tidemark.functions.timestamps import parse_utc, to_utc_ntz

__all__ = ["exact_sum", "n_unique", "parse_utc", "to_utc_ntz"]
