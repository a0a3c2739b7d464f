"""Text decoding, trimming and coercion of raw CSV fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The upper half of a single-byte code page, built from the codec itself. Spark 4 does not
# accept cp1250 as a charset, so files are read as ISO-8859-1 and mapped afterwards.
# Bytes without a cp1250 meaning become U+FFFD.
_HIGH = bytes(range(128, 256))
_LATIN1_HIGH = _HIGH.decode("latin-1")
_CP1250_HIGH = "".join(bytes([b]).decode("cp1250", errors="replace") for b in _HIGH)
_ENCODABLE = [(w, b) for w, b in zip(_CP1250_HIGH, _LATIN1_HIGH) if w != "\ufffd"]

# Code points of the white space removed around a field.
WHITE = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)

# Field texts read as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Sentinels that mean "no observation".
LEVEL_SENTINEL = 9999.0
FLOW_SENTINEL = 99999.999
TEMP_SENTINEL = 99.9
ICE_SENTINEL = 999.0


def decode_cp1250(c: Column) -> Column:
    """Turn text that was read as ISO-8859-1 into the cp1250 text it really is.

    Most fields are plain ASCII (as many bytes as characters) and skip the mapping.
    """
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, c).otherwise(F.translate(c, _LATIN1_HIGH, _CP1250_HIGH))


def encode_cp1250(c: Column) -> Column:
    """Inverse of :func:`decode_cp1250`; the result is to be written as ISO-8859-1."""
    return F.translate(c, "".join(w for w, _ in _ENCODABLE), "".join(b for _, b in _ENCODABLE))


def strip_white(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))


def _edged(c: Column) -> Column:
    """Whether the text starts or ends with what trimming removes."""
    edge = [*WHITE, '"']
    return F.left(c, F.lit(1)).isin(edge) | F.right(c, F.lit(1)).isin(edge)


def _trimmed(c: Column) -> Column:
    return strip_white(F.trim(strip_white(c), F.lit('"')))


def clean_text(c: Column) -> Column:
    """Trim, strip the outer quotes, trim again.

    Trimming by a character list copies the text, so fields that start and end with an ordinary
    character (nearly all of them) are passed through.
    """
    return F.when(_edged(c), _trimmed(c)).otherwise(c)


def missing_to_null(c: Column) -> Column:
    return F.when(c.isin(NA_TOKENS), F.lit(None)).otherwise(c)


# A number ends with a digit or a point, and Java skips control characters and blanks after it.
_NUMBER_ENDS = [*"0123456789.", *map(chr, range(0x21))]


def _parse(c: Column) -> Column:
    """Other texts are not tried: failing costs the JVM more than the rest of the row, and it also reads suffixed literals and the words for
    infinity and not-a-number."""
    return F.when(F.right(c, F.lit(1)).isin(_NUMBER_ENDS), c.try_cast("double"))


def to_number(c: Column) -> Column:
    """Number or null. Only text that does not parse as it stands and has something to trim is cleaned and tried again."""
    return F.coalesce(_parse(c), F.when(_edged(c), _parse(_trimmed(c))))


def sentinel_to_null(c: Column, hit: Column) -> Column:
    return F.when(hit, F.lit(None)).otherwise(c)


def level_value(c: Column) -> Column:
    return sentinel_to_null(c, c == LEVEL_SENTINEL)


def flow_value(c: Column) -> Column:
    return sentinel_to_null(c, c >= FLOW_SENTINEL)


def temp_value(c: Column) -> Column:
    return sentinel_to_null(c, c == TEMP_SENTINEL)


def ice_value(c: Column) -> Column:
    return sentinel_to_null(c, c == ICE_SENTINEL)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_integral(c: Column) -> Column:
    """True for null and for whole numbers within the 32-bit range."""
    return c.isNull() | ((c == F.floor(c)) & (F.abs(c) <= 2147483647.0))


def narrow(c: Column) -> Column:
    """32-bit integer or null; callers reject non-integral rows."""
    return c.try_cast("int")
