"""Column-level helpers: hashing, null handling, time."""

from tabforge.functions.hashing import hash52, key_text, md5_parity, uniform
from tabforge.functions.nulls import PANDAS_NA_TOKENS, na_token_to_null, nan_to_null
from tabforge.functions.timefn import as_timestamp, epoch_ms, ts_text

__all__ = [
    "PANDAS_NA_TOKENS",
    "as_timestamp",
    "epoch_ms",
    "hash52",
    "key_text",
    "md5_parity",
    "na_token_to_null",
    "nan_to_null",
    "ts_text",
    "uniform",
]
