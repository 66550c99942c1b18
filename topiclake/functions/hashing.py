"""Hash functions of the message log, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values of Murmur3 (x86, 32 bit).
C1, C2 = 0xCC9E2D51, 0x1B873593
FINAL_1, FINAL_2 = 0x85EBCA6B, 0xC2B2AE35
# Fixed value: hash() with this INT as first argument leaves 0 as the seed of the second.
SEED_ZERO = -1693959553

SLOTS = 65536
_MASK = 0xFFFFFFFF


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` any number of times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mul32(x: Column, factor: int) -> Column:
    """x * factor modulo 2**32; with a signed factor the product stays within BIGINT."""
    signed = factor - (1 << 32) if factor >= 1 << 31 else factor
    return (x * F.lit(signed)).bitwiseAND(F.lit(_MASK))


def _rotl(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.shiftright(x, 32 - bits))


def _fold(x: Column, *shifts: int) -> Column:
    """x ^ (x >> shift) ^ ..."""

    return let(x, lambda a: reduce(lambda out, shift: out.bitwiseXOR(F.shiftright(a, shift)), shifts, a))


def _finish(h: Column) -> Column:
    """The last mixing step."""
    return _fold(_mul32(_fold(_mul32(_fold(h, 16), FINAL_1), 13), FINAL_2), 16)


def _unfinish(h: Column) -> Column:
    """The inverse of the last mixing step."""
    undo_2, undo_1 = pow(FINAL_2, -1, 1 << 32), pow(FINAL_1, -1, 1 << 32)
    return _fold(_mul32(_fold(_mul32(_fold(h, 16), undo_2), 13, 26), undo_1), 16)


def _signed(h: Column) -> Column:
    top = F.lit(1 << 31)
    return h.bitwiseXOR(top) - top


def murmur3_32(data: Column) -> Column:
    """Murmur3 x86 32 bit with seed 0 of a BINARY column, signed, as BIGINT.

    Spark's hash() is the same function, up to the seed, when the length is a multiple of
    four, and differs in how the last one to three bytes are mixed in.  So it hashes
    the whole words; for other lengths its last step is undone, the rest is mixed in the
    standard way and the last step done again.  NULL gives NULL.
    """
    data = data.cast("binary")
    size = F.length(data)
    rest = size % 4
    words = F.hash(F.lit(SEED_ZERO), F.substring(data, 1, size - rest)).cast("bigint").bitwiseAND(F.lit(_MASK))
    body = F.when(size < 4, F.lit(0).cast("bigint")).otherwise(_unfinish(words).bitwiseXOR((size - rest).cast("bigint")))
    digits = F.rpad(F.hex(F.substring(data, size - rest + 1, 3)), 6, "0")
    tail = let(
        F.conv(digits, 16, 10).cast("bigint"),
        lambda v: F.shiftright(v, 16)
        .bitwiseOR(v.bitwiseAND(F.lit(0xFF00)))
        .bitwiseOR(F.shiftleft(v.bitwiseAND(F.lit(0xFF)), 16)),
    )
    mixed = let(_mul32(tail, C1), lambda k: _mul32(_rotl(k, 15), C2))
    full = _signed(_finish(body.bitwiseXOR(mixed).bitwiseXOR(size.cast("bigint"))))
    return (
        F.when(data.isNull(), F.lit(None).cast("bigint"))
        .when(rest == 0, F.hash(F.lit(SEED_ZERO), data).cast("bigint"))
        .otherwise(full)
    )


def key_slot(key: Column) -> Column:
    """Slot 0..65535 of a message key on the key-hash ring."""
    return murmur3_32(key).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def java_hash(text: Column) -> Column:
    """32-bit hash ``31 * h + c`` over the UTF-16 code units of a string, signed, as BIGINT."""
    units = let(
        F.hex(F.encode(text, "UTF-16BE")),
        lambda hexed: F.when(
            F.length(hexed) > 0,
            F.transform(
                F.sequence(F.lit(0), (F.length(hexed) / 4).cast("int") - 1),
                lambda i: F.conv(hexed.substr(i * 4 + 1, F.lit(4)), 16, 10).cast("bigint"),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return _signed(F.aggregate(units, F.lit(0).cast("bigint"), lambda acc, c: (acc * 31 + c).bitwiseAND(F.lit(_MASK))))
