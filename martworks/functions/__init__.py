"""Scalar expressions: every function returns a Column built from native Spark functions."""

from martworks.functions.dates import add_units, boundaries_between, truncated
from martworks.functions.scalar import (
    cents_to_dollars,
    customer_type,
    haversine,
    is_true,
    safe_add,
    safe_divide,
    safe_subtract,
    single_value,
    slugify,
    surrogate_key,
    to_bool,
    width_bucket,
    width_bucket_macro,
)
from martworks.functions.web import url_host, url_parameter, url_path

__all__ = [
    "add_units", "boundaries_between", "cents_to_dollars", "customer_type", "haversine", "is_true", "safe_add",
    "safe_divide", "safe_subtract", "single_value", "slugify", "surrogate_key", "to_bool", "truncated", "url_host",
    "url_parameter", "url_path", "width_bucket", "width_bucket_macro",
]
