"""Word tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidex.functions.scalars import as_column

# Fixed value: a token is a run of letters and digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(TOKEN_PATTERN), F.lit(0))
