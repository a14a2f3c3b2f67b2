"""Seed-0 murmur3 (32-bit, x86 variant) as Columns, on top of the JVM's ``hash``.

``F.hash`` is the same function but always starts from seed 42, and it treats
the last 1-3 bytes of a byte string differently.  Two facts get around both:

* it chains, the hash of one argument being the seed of the next, and murmur3 of
  a 4-byte integer is a bijection: one integer hashes to 0, and putting it first
  makes the chain go on from seed 0;
* the final mixing step is a bijection too.  Undoing it after the whole 4-byte
  words gives the inner state, from which the tail is mixed in as published.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import IntegerType

# Fixed values of the published murmur3_x86_32 algorithm.
C1, C2 = 0xCC9E2D51, 0x1B873593
ROUND_ADD = 0xE6546B64
FINAL_1, FINAL_2 = 0x85EBCA6B, 0xC2B2AE35
MASK = 0xFFFFFFFF


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 32)


def preimage_of_zero(seed: int) -> int:
    """The 4-byte integer whose murmur3 under the seed is 0, as a signed value."""

    def back_rotate(x: int, bits: int) -> int:
        return ((x >> bits) | (x << (32 - bits))) & MASK

    mixed = 4  # the finaliser maps 0 to 0 and first xors in the length 4
    k = back_rotate((mixed - ROUND_ADD) * _inverse(5) & MASK, 13) ^ seed
    k = back_rotate(k * _inverse(C2) & MASK, 15) * _inverse(C1) & MASK
    return k - (1 << 32) if k >> 31 else k


ZERO_FIRST = preimage_of_zero(seed=42)


def hash_word(value: Column) -> Column:
    """Hash of a BIGINT, DOUBLE or time value as its 8 bytes."""
    return F.hash(F.lit(ZERO_FIRST), value)


def _xor_shift(x: np.ndarray, bits: int) -> np.ndarray:
    return x ^ (x >> np.uint32(bits))


@F.arrow_udf(IntegerType())
def _with_tail(head: pa.Array, tail: pa.Array, length: pa.Array) -> pa.Array:
    """Hash of whole strings from the hash of their whole words, their last bytes as a number and their length."""
    size = np.asarray(length.fill_null(0)).astype(np.uint32)
    h = np.asarray(head.fill_null(0)).view(np.uint32)
    word = np.asarray(tail.fill_null(0)).astype(np.uint32)
    with np.errstate(over="ignore"):
        h = _xor_shift(h, 16) * np.uint32(_inverse(FINAL_2))
        h = (h ^ (h >> np.uint32(13)) ^ (h >> np.uint32(26))) * np.uint32(_inverse(FINAL_1))
        h = _xor_shift(h, 16) ^ (size - size % np.uint32(4))
        word *= np.uint32(C1)
        word = ((word << np.uint32(15)) | (word >> np.uint32(17))) * np.uint32(C2)
        h ^= word ^ size
        h = _xor_shift(_xor_shift(_xor_shift(h, 16) * np.uint32(FINAL_1), 13) * np.uint32(FINAL_2), 16)
    return pa.array(h.view(np.int32), mask=np.asarray(length.is_null()))


def hash_bytes(data: Column) -> Column:
    """Hash of a BINARY value.

    The JVM hashes the bytes; only three numbers per value go to Python.
    """
    length = F.octet_length(data)
    whole = length - length % 4
    head = F.hash(F.lit(ZERO_FIRST), F.substring(data, F.lit(1), whole))

    def byte(i: int) -> Column:
        value = F.conv(F.hex(F.substring(data, whole + (i + 1), F.lit(1))), 16, 10).cast("int")
        return F.shiftleft(F.when(whole + i < length, value).otherwise(0), 8 * i)

    return _with_tail(head, byte(0).bitwiseOR(byte(1)).bitwiseOR(byte(2)), length)


def sql_hash_bytes(data: str) -> str:
    """SQL text of :func:`hash_bytes` for a BINARY expression, as a non-negative BIGINT below 2^32, in the JVM alone.

    Products are made in two halves, since 32 by 32 bits overflow a BIGINT.
    """
    def let(value: str, name: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    def times(value: str, factor: int) -> str:
        return let(value, "m", f"(m * {factor & 0xFFFF} + shiftleft((m * {factor >> 16}) & 65535, 16)) & {MASK}L")

    def folded(value: str, *bits: int) -> str:
        return let(value, "f", "f" + "".join(f" ^ shiftright(f, {b})" for b in bits))

    def byte(i: int) -> str:
        return f"shiftleft(if(whole + {i} < octet_length(d), CAST(conv(hex(substring(d, whole + {i + 1}, 1)), 16, 10) AS BIGINT), 0L), {8 * i})"

    head = f"(CAST(hash({ZERO_FIRST}, substring(d, 1, whole)) AS BIGINT) & {MASK}L)"
    undone = folded(times(folded(times(folded(head, 16), _inverse(FINAL_2)), 13, 26), _inverse(FINAL_1)), 16)
    word = times(let(times(f"({byte(0)} | {byte(1)} | {byte(2)})", C1), "r", f"(shiftleft(r, 15) | shiftright(r, 17)) & {MASK}L"), C2)
    mixed = f"({undone} ^ whole ^ {word} ^ octet_length(d))"
    done = folded(times(folded(times(folded(mixed, 16), FINAL_1), 13), FINAL_2), 16)
    return let(data, "d", let("CAST(octet_length(d) - octet_length(d) % 4 AS INT)", "whole", done))
