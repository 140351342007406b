"""Key expressions: vault hash keys and dimensional surrogate keys.

All return ``Column`` expressions built from Spark built-ins (``sha2``,
``md5``, ``concat_ws``), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, DoubleType, FloatType,
                               TimestampNTZType, TimestampType)

# Separators and NULL placeholders of the two key schemes.
HASH_SEPARATOR = "||"
HASH_NULL = "^^"
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(c, dtype=None) -> Column:
    """Text form of a key column, identical across engines.

    Timestamps print with millisecond precision; floating values are
    first fixed to ``decimal(18,2)`` so that ``-0.0`` and exponent
    notation never reach the hash.
    """
    c = _col(c)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_format(c, TIMESTAMP_TEXT)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.cast(DecimalType(18, 2)).cast("string")
    return c.cast("string")


def hash_key(*cols) -> Column:
    """Upper-case hex SHA-256 business key.

    One column: hash of its text, NULL stays NULL.  Several columns:
    texts joined by ``||`` with NULL replaced by ``^^`` (never NULL).
    """
    return F.upper(F.sha2(hash_text(*cols), 256))


def hash_text(*cols) -> Column:
    """The text that ``hash_key`` digests."""
    if len(cols) == 1:
        return _col(cols[0]).cast("string")
    return F.concat_ws(HASH_SEPARATOR, *[F.coalesce(_col(c).cast("string"), F.lit(HASH_NULL)) for c in cols])


def surrogate_key(*cols, types: dict | None = None) -> Column:
    """Lower-case hex MD5 of the columns' texts joined by ``-``.

    NULL inputs are replaced by a fixed placeholder, so the key is never
    NULL.  ``types`` maps column name to Spark type where the text form
    needs normalising (timestamps).
    """
    types = types or {}
    parts = []
    for c in cols:
        name = c if isinstance(c, str) else None
        parts.append(F.coalesce(key_text(c, types.get(name)), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def ts_surrogate_key(id_col, ts_col) -> Column:
    """Surrogate key of (business id, version timestamp)."""
    return F.md5(F.concat_ws(
        SURROGATE_SEPARATOR,
        F.coalesce(_col(id_col).cast("string"), F.lit(SURROGATE_NULL)),
        F.coalesce(F.date_format(_col(ts_col), TIMESTAMP_TEXT), F.lit(SURROGATE_NULL)),
    ))


def short_key(c) -> Column:
    """A key in half the bytes, for distinct counts: the 16 bytes of an MD5 text; any other
    text, as a placeholder, in its own bytes behind 17 zero bytes, so no two texts meet."""
    c = _col(c)
    return F.when(c.rlike("^[0-9a-f]{32}$"), F.unhex(c)).otherwise(F.concat(F.unhex(F.lit("00" * 17)), F.encode(c, "UTF-8")))


def packed_digest(c) -> Column:
    """A text in fewer bytes, for a shuffle: the bytes of an MD5 (lower case) or SHA-256 (upper
    case) in hex; any other text in its own bytes behind 33 zero bytes, longer than both."""
    c = _col(c)
    held, text = F.unhex(c), F.concat(F.unhex(F.lit("00" * 33)), c.cast("binary"))
    return (F.when((F.length(c) == 32) & (F.lower(F.hex(held)) == c), held)
            .when((F.length(c) == 64) & (F.hex(held) == c), held).otherwise(text))


def unpacked_digest(c) -> Column:
    """The text of ``packed_digest``."""
    c = _col(c)
    return (F.when(F.length(c) == 16, F.lower(F.hex(c))).when(F.length(c) == 32, F.hex(c))
            .otherwise(F.substring(c, 34, 2 ** 31 - 1).cast("string")))


def hashdiff(df, cols) -> Column:
    """Change-detection digest of descriptive attributes (satellites)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return surrogate_key(*cols, types=types)
