"""Column helpers for text: trimming, searching, tokenising."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: one word, one digit, or one other visible character per token.
TOKEN_PATTERN = r"\p{L}+|[0-9]|[^ \t\n\f\r\p{L}0-9]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def starts(sizes: np.ndarray) -> np.ndarray:
    """Where each of neighbouring runs of the given sizes starts, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def relisted(rows: pa.Array, values: pa.Array, at: np.ndarray | None = None) -> pa.Array:
    """Lists like those of ``rows``, null where they are, of new values; ``at`` tells where those of each old value start,
    by default one stands for each."""
    ends = starts(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))
    ends = ends if at is None else at[ends]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=rows.is_null())


def explode_indexed(df: DataFrame, keys: list[str], array: str, idx: str, value: str) -> DataFrame:
    """One row per element of a computed array column, numbered from 0.

    The outer form is used on purpose: for the plain one the optimizer adds a size filter and pushes it below the
    expression, which then runs twice per row.
    """
    out = df.select(*keys, F.posexplode_outer(array).alias(idx, value)).where(F.col(idx).isNotNull())
    return out.withColumn(idx, F.col(idx).cast("bigint"))


def strip(c: Column) -> Column:
    """Trim every kind of white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def lstrip_newlines(c: Column) -> Column:
    return F.ltrim(c, F.lit("\n"))


def is_blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


def find(c: Column, needle: str | Column, start: Column | int = 0) -> Column:
    """0-based position of ``needle`` at or after ``start``, -1 if absent."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    start = F.lit(start) if isinstance(start, int) else start
    return F.call_function("locate", needle, c, (start + 1).cast("int")) - 1


def left(c: Column, n: Column) -> Column:
    return F.substr(c, F.lit(1), n.cast("int"))


def from_pos(c: Column, pos: Column) -> Column:
    """The text from 0-based ``pos`` on."""
    return F.substr(c, (pos + 1).cast("int"))


def strip_lines(c: Column) -> Column:
    """Array of the stripped, non-empty lines."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: F.length(x) > 0)


def nfkc(c: Column) -> Column:
    """Unicode compatibility form. Plain ASCII is its own form and never leaves the JVM."""

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.coalesce(compose(F.when(c.rlike(r"[^\x00-\x7f]"), c)), c)


def tokens(c: Column) -> Column:
    """Lower-cased token array; digits stand alone."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def has_cjk(c: Column) -> Column:
    """True when any character lies in the CJK block (router bound)."""
    return c.rlike("[\u4e00-\u9fff]")


def all_cjk(c: Column) -> Column:
    """True when every character lies in the narrower vocabulary bound; true for ''."""
    return c.rlike("\\A[\u4e00-\u9fa5]*\\z")
