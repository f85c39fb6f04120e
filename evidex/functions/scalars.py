"""Column expressions used by several operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (defaults the results depend on).
SNIPPET_CHARS = 240
SHORT_SNIPPET_CHARS = 96
SAMPLE_RESOLUTION = 1_000_000
VARIANT_RESOLUTION = 1_000
SEED = 42
HYBRID_WEIGHTS = (0.6, 0.2, 0.1, 0.1)
ANSWER_VARIANTS = ("answer_v1", "answer_v2")
NUMBER_PATTERN = r"-?[0-9]+(?:\.[0-9]+)?"
ISO_DATE_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"

COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "like": lambda c, v: c.like(v),
}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stable_id(*parts: Column | str) -> Column:
    """Hex SHA-256 of the joined parts; the same input always gives the same id."""
    return F.sha2(F.concat(*[as_column(p).cast("string") for p in parts]), 256)


def hash_bucket(text: Column, modulus: int) -> Column:
    """Uniform bucket in [0, modulus) from the first 32 bits of SHA-256."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint") % F.lit(modulus)


def ab_variant(text: Column | str, frac: float = 0.5, variants: tuple[str, str] = ANSWER_VARIANTS) -> Column:
    """Split by the hash of the text, in steps of one per mille."""
    cut = int(round(frac * VARIANT_RESOLUTION))
    bucket = hash_bucket(as_column(text).cast("string"), VARIANT_RESOLUTION)
    return F.when(bucket < cut, F.lit(variants[0])).otherwise(F.lit(variants[1]))


def snippet(text: Column | str, chars: int = SNIPPET_CHARS, strip_quotes: bool = False) -> Column:
    """One-line excerpt: line breaks (and quotes, if asked) become blanks, then the text is cut."""
    pattern = '[\n\r"]' if strip_quotes else "[\n\r]"
    return F.substring(F.regexp_replace(as_column(text), pattern, " "), 1, chars)


def clamp01(value: Column | str) -> Column:
    """Limit to [0, 1]; NULL stays NULL although least/greatest would skip it."""
    c = as_column(value)
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def hybrid_score(
    similarity: Column | str = "similarity",
    constraints_ok: Column | str = "constraints_ok",
    recency: Column | float = 0.0,
    pass_rate: Column | float = 0.0,
    weights: tuple[float, float, float, float] = HYBRID_WEIGHTS,
) -> Column:
    """Weighted sum of similarity, constraint flag, recency and validator pass rate."""
    a, b, c, d = weights
    ok = F.coalesce(as_column(constraints_ok).cast("int"), F.lit(0))
    extra = [x if isinstance(x, Column) else F.lit(float(x)) for x in (recency, pass_rate)]
    return F.lit(a) * as_column(similarity) + F.lit(b) * ok + F.lit(c) * extra[0] + F.lit(d) * extra[1]


def predicate(constraints: Iterable[tuple[str, str, object]]) -> Column:
    """AND of (field, operator, value) triples; no triple means true."""
    tests = []
    for field, op, value in constraints:
        if field.upper() == "TRUE":
            continue
        if op.lower() not in COMPARISONS:
            raise ValueError(f"operator {op!r} is not one of {sorted(COMPARISONS)}")
        tests.append(COMPARISONS[op.lower()](F.col(field), value))
    return reduce(lambda x, y: x & y, tests, F.lit(True))


def safe_date(text: Column | str) -> Column:
    """ISO date or NULL; malformed and impossible dates do not raise."""
    c = as_column(text)
    return F.when(c.rlike(rf"^{ISO_DATE_PATTERN}$"), F.try_to_date(c, "yyyy-MM-dd"))


def first_match(text: Column | str, pattern: str, group: int = 0) -> Column:
    """First match in the whole text, NULL instead of the empty string when there is none."""
    return F.nullif(F.regexp_extract(as_column(text), pattern, group), F.lit(""))


def first_number(text: Column | str, pattern: str = NUMBER_PATTERN, group: int = 0) -> Column:
    return first_match(text, pattern, group).try_cast("double")


def keep_allowed(items: Column, allowed: Column) -> Column:
    """Items that occur in `allowed`, in their order and with their repetitions."""
    return F.filter(items, lambda x: F.array_contains(allowed, x))


def null_if_empty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns so that later filters use their values.

    A filter on a plain projected column is pushed below the projection, which evaluates the expression again
    for every mention; a one-element `inline` keeps the filter above it.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
