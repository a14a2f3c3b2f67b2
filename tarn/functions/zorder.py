"""Order-preserving encodings and z-order keys.

Each value is first turned, by Column arithmetic, into a signed BIGINT whose
order is the order of the values.  The bit interleaving of several such codes
is an Arrow function over whole batches; short codes that fit one BIGINT are
interleaved by Column bit operations alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType

_SIGN = np.uint64(1 << 63)


@F.arrow_udf(LongType())
def _double_code(values: pa.Array) -> pa.Array:
    clean = np.asarray(values.fill_null(0.0)) + 0.0  # -0.0 becomes 0.0
    bits = clean.view(np.int64)
    code = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
    return pa.array(code, mask=np.asarray(values.is_null()))


def text_word(col: Column, start: int, width: int) -> Column:
    """BIGINT whose order is the order of ``width`` (at most 8) bytes of a text or byte string from byte ``start`` on."""
    head = F.substring(col.cast("binary"), start + 1, width)
    text = F.rpad(F.hex(head), 16, "0")
    high = F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint") - F.lit(1 << 31)
    low = F.conv(F.substring(text, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def ordered_code(col: Column, data_type: str, width: int = 8) -> Column:
    """BIGINT whose order is the order of the value; strings count by their first ``width`` bytes, 8 at most.

    A decimal of up to 18 digits counts exactly, a longer one as a double.
    """
    kind = data_type.split("(")[0].lower()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return col.cast("bigint")
    if kind == "boolean":
        return col.cast("int").cast("bigint")
    if kind == "date":
        return F.unix_date(col).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(col.cast("timestamp"))
    if kind in ("float", "double"):
        return _double_code(col.cast("double"))
    if kind in ("string", "binary"):
        if not 1 <= width <= 8:
            raise ValueError("one BIGINT holds 1 to 8 bytes of a string; see ordered_words")
        return text_word(col, 0, width)
    if kind == "decimal":
        digits, _, scale = data_type.partition("(")[2].rstrip(") ").partition(",")
        if digits and int(digits) <= 18:
            return (col * F.lit(10 ** int(scale or 0)).cast("decimal(19,0)")).cast("bigint")
        return _double_code(col.cast("double"))
    raise ValueError(f"no ordered form for {data_type}")


def ordered_words(col: Column, data_type: str, width: int = 8) -> list[Column]:
    """BIGINTs that compare one after another as the values do; a string has one for every 8 of its first ``width`` bytes."""
    if data_type.split("(")[0].lower() not in ("string", "binary"):
        return [ordered_code(col, data_type)]
    if width < 1:
        raise ValueError("a string needs a width of at least 1")
    return [text_word(col, start, min(8, width - start)) for start in range(0, width, 8)]


def _interleaved(columns: list[list[Column]]) -> Column:
    """Bits of the columns in turn, highest first; a longer column goes on alone, a NULL sorts first."""
    bit_of = np.cumsum([0] + [64 * len(words) for words in columns])
    turns = sorted((bit, i) for i, words in enumerate(columns) for bit in range(64 * len(words)))
    order = np.array([bit_of[i] + bit for bit, i in turns])
    lowest, sign = np.iinfo(np.int64).min, _SIGN

    @F.arrow_udf(BinaryType())
    def interleave(*codes: pa.Array) -> pa.Array:
        rows = len(codes[0])
        filled = np.stack([np.asarray(c.fill_null(lowest)) for c in codes], axis=1).view(np.uint64) ^ sign
        bits = np.unpackbits(filled.astype(">u8").view(np.uint8).reshape(rows, -1), axis=1)
        packed = np.packbits(bits[:, order], axis=1)
        offsets = np.arange(rows + 1, dtype=np.int32) * packed.shape[1]
        return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(packed.tobytes())])

    return interleave(*[word for words in columns for word in words])


def zorder_key(columns: list[tuple[Column, str]], string_width: int = 8) -> Column:
    """Binary z-order key of (column, type) pairs; comparing keys compares z-values."""
    return _interleaved([ordered_words(c, t, string_width) for c, t in columns])


def clustering_columns(df: DataFrame, columns: list[tuple[Column, str]], string_width: int = 8) -> list[Column]:
    """Columns to range-partition and sort by for z-order.

    Full keys start with the many bits all rows share, which makes them slow to
    compare.  The smallest and largest code of each column, found in one pass
    over these columns, say below which bit the rows differ; only those bits are
    interleaved.  If they fit a BIGINT they are the whole order, else the
    highest of them go before the full key.  A NULL counts as the smallest value.
    Of strings wider than 8 bytes the first 8 are looked at, the full key has all.
    """
    words = [ordered_words(c, t, string_width) for c, t in columns]
    codes = [w[0] for w in words]
    ends = df.agg(*[f(c) for c in codes for f in (F.min, F.max)]).first()
    lows, highs = ends[::2], ends[1::2]
    differing = max(0 if low is None else ((low ^ high) & ((1 << 64) - 1)).bit_length() for low, high in zip(lows, highs))
    width = min(differing, 62 // len(codes))
    filled = [F.coalesce(c, F.lit(0 if low is None else low)) for c, low in zip(codes, lows)]
    unsigned = [c.bitwiseXOR(F.lit(-(1 << 63))) for c in filled]
    top = [F.shiftrightunsigned(c, differing - width).bitwiseAND(F.lit((1 << width) - 1)) for c in unsigned]
    key = small_zorder_key(top, width)
    whole = width == differing and all(len(w) == 1 for w in words)
    return [key] if whole else [key, _interleaved([[first, *w[1:]] for first, w in zip(filled, words)])]


def _spread(x: Column, gap: int, width: int) -> Column:
    """Move bit i of a non-negative code to bit i * gap."""
    out = F.lit(0).cast("bigint")
    for i in range(width):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1).cast("bigint")), i * gap))
    return out


def small_zorder_key(columns: list[Column], width: int) -> Column:
    """Z-value of non-negative codes below 2^width as one BIGINT, first column on the high bit."""
    k = len(columns)
    if k * width > 62:
        raise ValueError("codes do not fit one BIGINT")
    out = F.lit(0).cast("bigint")
    for i, col in enumerate(columns):
        out = out.bitwiseOR(F.shiftleft(_spread(col.cast("bigint"), k, width), k - 1 - i))
    return out
