"""Bit vectors: `array<boolean>` as the logical form, little-endian bytes as the packed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack_bits(bits: Column) -> Column:
    """Byte values of a bit vector: bit i is bit i % 8 of byte i / 8, the rest is zero."""
    ints = F.transform(bits, lambda b: b.cast("int"))
    last = F.ceil(F.size(bits) / 8).cast("int") - 1
    starts = F.when(F.size(bits) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def one_byte(byte: Column) -> Column:
        eight = F.slice(ints, byte * 8 + 1, F.lit(8))
        weighted = F.transform(eight, lambda bit, i: bit * F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), i + 1))
        return F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)

    return F.transform(starts, one_byte)


def to_binary(byte_values: Column) -> Column:
    return F.unhex(F.array_join(F.transform(byte_values, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


def to_bytes(packed: Column) -> Column:
    """Byte values of a BINARY column."""
    text = F.hex(packed)
    last = F.octet_length(packed) - 1
    return F.when(
        F.octet_length(packed) > 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.conv(F.substring(text, i * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    ).otherwise(F.when(packed.isNotNull(), F.array().cast("array<int>")))


def unpack_bits(byte_values: Column, count: Column | int) -> Column:
    """First `count` bits of a little-endian byte vector."""
    n = F.lit(count) if isinstance(count, int) else count
    positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        positions,
        lambda i: F.getbit(F.element_at(byte_values, F.floor(i / 8).cast("int") + 1), i % 8) == 1,
    )


def unpack_binary(packed: Column, count: Column | int) -> Column:
    """First `count` bits of a little-endian BINARY, seven bytes to a number; bits behind its end are NULL."""
    n = F.lit(count) if isinstance(count, int) else count
    text = F.hex(packed)
    words = F.ceil(F.octet_length(packed) / 7).cast("int")
    none = F.array().cast("array<bigint>")
    numbers = F.when(
        words > 0, F.transform(F.sequence(F.lit(0), words - 1), lambda w: F.conv(F.rpad(F.substring(text, w * 14 + 1, F.lit(14)), 14, "0"), 16, 10).cast("bigint"))
    ).otherwise(F.when(packed.isNotNull(), none))
    positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # Byte b of a number is its b-th from the top.
    bit = lambda i: (6 - F.floor(i % 56 / 8)).cast("int") * 8 + i % 8
    inside = lambda i: i < F.octet_length(packed) * 8
    return F.transform(positions, lambda i: F.when(inside(i), F.getbit(F.get(numbers, F.floor(i / 56).cast("int")), bit(i)) == 1))


def popcount_bytes(byte_values: Column) -> Column:
    return F.aggregate(byte_values, F.lit(0).cast("bigint"), lambda acc, x: acc + F.bit_count(x))


def popcount(bits: Column) -> Column:
    """Number of true elements."""
    return F.size(F.filter(bits, lambda b: b)).cast("bigint")


def full_mask(length: Column | int) -> Column:
    """A mask that names every detector."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.array_repeat(F.lit(True), n)


def xor_bits(a: Column, b: Column) -> Column:
    """Element-wise difference of two vectors of the same length."""
    return F.zip_with(a, b, lambda x, y: x != y)


def any_masked(bits: Column, mask: Column) -> Column:
    """True when a bit named by the mask is set; a NULL mask names none."""
    hit = F.exists(F.zip_with(bits, mask, lambda b, m: b & m), lambda x: x)
    return F.coalesce(hit, F.lit(False))


def has_gaps(bits: Column) -> Column:
    """Whether a vector is missing or holds NULL bits, as one unpacked from too few bytes does."""
    return F.coalesce(F.exists(bits, lambda b: b.isNull()), F.lit(True))


def reaches_behind(mask: Column, bits: Column) -> Column:
    """Whether a mask names a bit behind the end of a vector; a NULL mask names none."""
    rest = F.slice(mask, F.size(bits) + 1, F.greatest(F.size(mask), F.lit(1)))
    return F.coalesce(F.exists(rest, lambda m: m), F.lit(False))


# ---- packed words -------------------------------------------------------------

WORD_BYTES = 7


def bytes_for(count: Column | int) -> Column:
    return F.ceil((F.lit(count) if isinstance(count, int) else count) / 8).cast("int")


def words(packed: Column) -> Column:
    """A BINARY as whole numbers of seven bytes each, the last one filled up with zeros.

    Vectors of one declared length have the same layout, so AND, XOR and bit counts
    of words are those of the bits.
    """
    text, n = F.hex(packed), F.ceil(F.octet_length(packed) / WORD_BYTES).cast("int")
    number = lambda w: F.conv(F.rpad(F.substring(text, w * 2 * WORD_BYTES + 1, F.lit(2 * WORD_BYTES)), 2 * WORD_BYTES, "0"), 16, 10).cast("bigint")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).otherwise(F.array().cast("array<bigint>"))


def xor_words(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))


def any_masked_words(bits: Column, mask: Column) -> Column:
    """Whether a bit named by the mask is set; words that the mask does not reach are not named."""
    return F.coalesce(F.exists(F.zip_with(bits, mask, lambda b, m: F.coalesce(b.bitwiseAND(m), F.lit(0).cast("bigint"))), lambda x: x != 0), F.lit(False))


def popcount_words(bits: Column) -> Column:
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, x: acc + F.bit_count(x))


def ends_clean(packed: Column, count: Column | int) -> Column:
    """Whether no bit behind the declared length is set in the last byte that it uses."""
    n = F.lit(count) if isinstance(count, int) else count
    last = F.conv(F.substring(F.hex(packed), 2 * bytes_for(count) - 1, F.lit(2)), 16, 10).cast("int")
    return (n % 8 == 0) | F.coalesce(F.call_function("shiftright", last, (n % 8).cast("int")) == 0, F.lit(False))
