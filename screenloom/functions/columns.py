"""Column functions: lenient casts, finite tests, class masks, packed counts, label seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def as_double(column: Column | str) -> Column:
    """A double, or null where the value is no finite number."""
    c = F.col(column) if isinstance(column, str) else column
    return finite(c.try_cast("double"))


def finite(column: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(column) & (F.abs(column) < INF), column)


def is_true(column: Column | str) -> Column:
    """A boolean kept as text: only ``true`` in any case and with blanks around is true."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(F.trim(c)) == "true", F.lit(False))


def says_perturbed(column: Column | str) -> Column:
    """A class text that contains ``ko`` or ``perturbed`` in any case; null does not."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(c).rlike("ko|perturbed"), F.lit(False))


def token_sum(column: Column | str) -> Column:
    """The sum of all whole numbers in a text, 0 if it has none, null for null."""
    c = F.col(column) if isinstance(column, str) else column
    tokens = F.regexp_extract_all(c, F.lit(r"(\d+)"), 1)
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda a, t: a + t.cast("bigint"))


def control_equals(column: Column | str, label: str) -> Column:
    """Whether a label is the control label; null is not."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c == F.lit(label), F.lit(False))


def label_seed(base: int, label: str) -> int:
    """A seed from a base seed and a label: the position-weighted sum of its code points."""
    return (base + sum(i * ord(c) for i, c in enumerate(label, 1))) % (2**32 - 1)


def neg_log10(column: Column | str, least: float = 1e-300) -> Column:
    """-log10 with small values raised to ``least``."""
    c = F.col(column) if isinstance(column, str) else column
    return -F.log10(F.greatest(c, F.lit(least)))


def lenient_decode(column: Column | str) -> Column:
    """Bytes as text in UTF-8; what is not valid becomes the replacement character."""
    c = F.col(column) if isinstance(column, str) else column
    return F.make_valid_utf8(c.cast("string"))


def p_column(columns: list[str]) -> str:
    """The column of p-values to test: the adjusted one, else the plain one; none is an error."""
    for c in ("pval_adj", "pval"):
        if c in columns:
            return c
    raise ValueError("neither pval_adj nor pval")
