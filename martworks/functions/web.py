"""URL parts as text operations. The rules are purely textual (no URL grammar), so odd inputs give odd outputs:
a scheme is removed wherever it stands, fragments stay, and a parameter name matches as a substring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martworks.functions.scalar import ColumnOrName, as_column

# What counts as a scheme for hosts and for paths.
HOST_SCHEMES, PATH_SCHEMES = "android-app://|http://|https://", "http://|https://"


def _without(url: ColumnOrName, schemes: str) -> Column:
    return F.regexp_replace(as_column(url), schemes, "")


def url_host(url: ColumnOrName) -> Column:
    """Text up to the first `/` or `?` once the scheme is gone."""
    return F.regexp_extract(_without(url, HOST_SCHEMES), "^[^/?]*", 0)


def url_path(url: ColumnOrName) -> Column:
    """Text behind the first `/` up to the next `?`. A text without `/` has no path if it has a `?`, else it is all path."""
    shapes = r"(?s)^(?:[^/]*/([^?]*).*|([^/?]*)|.*)\z"
    return F.regexp_replace(_without(url, PATH_SCHEMES), shapes, "$1$2")


def _part(text: Column, separator: str, number: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(number))


def url_parameter(url: ColumnOrName, name: str) -> Column:
    """Text behind the first `name=` up to `&`; null when absent or empty."""
    return F.nullif(_part(_part(as_column(url), f"{name}=", 2), "&", 1), F.lit(""))
