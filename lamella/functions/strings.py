"""Scalar expressions on names, ids and codes, all inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDEFINED = "__undefined"
# Separators in the order in which they are tried.
SEPARATORS = ("", "-", "_")


def id_structure(market: Column, base: Column, quote: Column, separators: Sequence[str] = SEPARATORS) -> Column:
    """How an id is put together from base and quote ids.

    ``base<sep>quote`` or the same with a suffix, then the reverse, then
    ``base_only``, ``numeric``, else ``opaque``. A null or empty id or base is opaque.
    """
    out = F.when(F.coalesce(market, F.lit("")).isin("") | F.coalesce(base, F.lit("")).isin(""), "opaque")
    q = F.coalesce(quote, F.lit(""))
    for label, first, second in (("base{}quote", base, q), ("quote{}base", q, base)):
        for sep in separators:
            joined = F.concat(first, F.lit(sep), second)
            name = label.format(sep)
            usable = F.lit(True) if label.startswith("base") else q != ""
            out = out.when(usable & (market == joined), name).when(usable & (q != "") & market.startswith(joined), name + "+suffix")
    return out.when(market == base, "base_only").when(is_numeric(market), "numeric").otherwise("opaque")


def is_numeric(text: Column) -> Column:
    """A whole number with an optional sign, after any number of leading @."""
    return F.coalesce(text.rlike(r"\A@*[+-]?[0-9]+\z"), F.lit(False))


def letter_case(text: Column) -> Column:
    """upper, lower or mixed by the ASCII letters of a text; null without any."""
    letters = F.regexp_replace(text, "[^A-Za-z]", "")
    return F.when(letters.isNull() | (letters == ""), None).when(letters == F.upper(letters), "upper").when(letters == F.lower(letters), "lower").otherwise("mixed")


def pascal_case(text: Column) -> Column:
    """snake_case to PascalCase."""
    return F.concat_ws("", F.transform(F.split(text, "_"), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))))


def camel_join(parts: Column) -> Column:
    """Path segments as one camelCase name; segments split at anything but letters and digits, only first letters change."""
    words = F.filter(F.split(F.array_join(parts, " "), "[^A-Za-z0-9]+"), lambda x: x != "")
    capital = F.transform(words, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))))
    return F.array_join(capital, "")


def placeholders(path: Column) -> Column:
    """Names in braces, from left to right."""
    return F.regexp_extract_all(path, F.lit(r"\{([^{}]+)\}"), 1)


def strip_function(text: Column) -> Column:
    """``__function:Name`` to ``Name``; all else as it is."""
    return F.regexp_replace(text, r"\A__function:", "")


def precision_mode(code: Column) -> Column:
    """Names of the numeric precision and padding codes; null for others."""
    # Fixed values.
    names = {2: "DECIMAL_PLACES", 3: "SIGNIFICANT_DIGITS", 4: "TICK_SIZE", 5: "NO_PADDING", 6: "PAD_WITH_ZERO"}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in names.items():
        out = out.when(code == k, v)
    return out


def is_transactional(name: Column) -> Column:
    return ~name.startswith("fetch")


def is_on_chain(name: Column) -> Column:
    return name.startswith("withdraw")


def rate_limit_bucket(rate: Column, size: Column, cost: Column) -> Column:
    """Refill per second from a delay in ms, with size and cost 1 by default; a reason where the delay is unset or not positive."""
    refill = F.when(rate > 0, 1000.0 / rate)
    reason = F.when(rate.isNull(), "rate_limit_unset").when(rate <= 0, "rate_limit_nonpositive")
    return F.struct(refill.alias("refill_per_second"), F.coalesce(size, F.lit(1.0)).alias("max_size"), F.coalesce(cost, F.lit(1.0)).alias("cost"), reason.alias("reason"))


def rate_limit_algorithm(of_bucket: Column, of_entity: Column) -> Column:
    """Algorithm of a bucket: its own, else that of the entity, else the default."""
    return F.coalesce(of_bucket, of_entity, F.lit("leakyBucket"))


def strip_functions_at_depth(text: Column) -> Column:
    """``"__function:Name"`` to ``"Name"`` in all strings of a JSON text."""
    return F.regexp_replace(text, r'"__function:', '"')


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two texts: 1 for equal ones, 0 without a common character in reach."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    hit = np.zeros(len(b), bool)
    first = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit[j] and b[j] == ch:
                hit[j] = True
                first.append(ch)
                break
    m = len(first)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(first, (b[j] for j in np.flatnonzero(hit)))) // 2
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


@F.pandas_udf(T.DoubleType())
def jaro_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else jaro(x, y) for x, y in zip(a, b)], dtype="float64")


#: A number as text: an optional sign, digits with an optional point, an optional exponent; spaces around it aside.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def as_number(column: Column) -> Column:
    """The text's number; null for all other texts, also for those that a cast alone would take (``1.0d``, ``NaN``, ``0x1p3``)."""
    return F.when(column.rlike(NUMBER_TEXT), F.trim(column).try_cast("double"))
