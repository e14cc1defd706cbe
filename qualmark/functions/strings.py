"""String expressions: per-position byte codes, sample keys, value checks.

All are built from Spark SQL built-ins (higher-order ``transform`` over a
``sequence``), so they run as JVM expressions with no Python (higher-order
functions are evaluated outside whole-stage codegen, over a value's codes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Fixed values of the string model: sequence length and code alphabet size,
# and the code used by the 'space' overflow mode.
SEQ_LEN = 16
ENC_SIZE = 128
SPACE_CODE = 32

OVERFLOW_MODES = ("mod", "drop", "space")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def position_codes(value, seq_len: int | None = SEQ_LEN, size: int = ENC_SIZE, overflow: str = "mod",
                   unit: str = "byte", pad_md5: bool = False) -> Column:
    """Array of codes for the first ``seq_len`` units of ``value`` (None: all of them).

    ``unit='byte'`` reads UTF-8 bytes (0-255); ``unit='char'`` reads code
    points. Codes ``>= size`` are handled by ``overflow``:

    * ``mod``   - ``code % size``
    * ``drop``  - ``-1`` (the position stays, but has no hot cell)
    * ``space`` - replaced by 32
    Position ``i`` of the array (0-based) is position ``i`` of the string.
    ``pad_md5=True`` encodes ``value<TAB>md5(value)`` instead, as the
    reference's model did with an md5 export (short values padded by a tab
    and hash text).
    """
    if overflow not in OVERFLOW_MODES:
        raise ValueError(f"overflow must be one of {OVERFLOW_MODES}")
    v = _c(value)
    if pad_md5:
        v = F.concat(v, F.lit("\t"), F.md5(v.cast("string")))
    if unit == "byte":
        data = F.encode(v, "UTF-8")
        n = F.octet_length(data)

        def code_at(i):
            return F.conv(F.hex(F.substring(data, i, 1)), 16, 10).cast("int")
    elif unit == "char":
        n = F.length(v)

        def code_at(i):
            return F.ascii(F.substring(v, i, 1))
    else:
        raise ValueError("unit must be 'byte' or 'char'")

    def fix(code):
        if overflow == "mod":
            return F.pmod(code, F.lit(size))
        if overflow == "drop":
            return F.when(code < size, code).otherwise(F.lit(-1))
        return F.when(code < size, code).otherwise(F.lit(SPACE_CODE))

    n = n if seq_len is None else F.least(n, F.lit(seq_len))
    seq = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(seq, lambda i: fix(code_at(i)))


def hash_order_key(seed: str, *cols) -> Column:
    """Reproducible pseudo-random order key: md5 over the seed and the key columns.

    Each column adds ``|length:text``, or ``|NULL``, so no two different keys
    give the same text. Equal to DuckDB's ``md5`` on the same text.
    """
    parts = [F.lit(str(seed))]
    for c in cols:
        text = _c(c).cast("string")
        parts.append(F.coalesce(F.concat(F.lit("|"), F.length(text).cast("string"), F.lit(":"), text), F.lit("|NULL")))
    return F.md5(F.concat(*parts).cast("binary"))


# Decimal numbers only: type-suffixed text ('250d'), 'NaN' and 'inf' are not numbers.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_number(value) -> Column:
    """Text (or a number) to double; NULL for anything but a finite decimal number."""
    text = _c(value).cast("string")
    x = F.when(text.rlike(NUMBER), text).try_cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def number_column(df: DataFrame, column: str) -> Column:
    """``column`` of ``df`` as a finite double or NULL; only text needs parsing."""
    if isinstance(df.schema[column].dataType, NumericType):
        x = F.col(column).cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)
    return as_number(F.col(column))
