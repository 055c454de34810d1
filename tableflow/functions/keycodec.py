"""Binary keys of the key/value store, built and taken apart with binary expressions.

Layout: one byte segment length, the segment, two little-endian bytes holding the store
type in the upper four bits and the key length in the lower twelve, the key, the member.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Store types and the largest lengths the layout can hold.
STORE_TYPE_KV = 0
STORE_TYPE_DEDUP_SET = 2
STORE_TYPE_HASH = 4
MAX_SEGMENT_BYTES = 255
MAX_KEY_BYTES = 4095


def _number_bytes(number: Column, width: int) -> Column:
    """A non-negative number as ``width`` bytes, the highest first."""
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 2 * width, "0"))


def _as_bytes(value: Column, data_type: T.DataType | None = None) -> Column:
    # Text is UTF-8 inside Spark, so this cast copies bytes and encodes nothing.
    return value if isinstance(data_type, T.BinaryType) else value.cast("string").cast("binary")


def encode_key(segment: Column, store_type: Column, key: Column, member: Column | None = None,
               key_type: T.DataType | None = None, member_type: T.DataType | None = None) -> Column:
    """Encode one key; a missing key, segment or type and a length overflow fail the job.

    ``key_type`` and ``member_type`` tell binary input, which is taken as it is.
    """
    segment_bytes, key_bytes = _as_bytes(segment), _as_bytes(key, key_type)
    segment_length, key_length = F.octet_length(segment_bytes), F.octet_length(key_bytes)
    kind = store_type.cast("int").bitwiseAND(F.lit(0x0F))
    # Low byte of the length first, then the type above the length's high bits.
    flags = (F.shiftleft(key_length.bitwiseAND(F.lit(0xFF)), 8)
             .bitwiseOR(F.shiftleft(kind, 4)).bitwiseOR(F.shiftright(key_length, 8)))
    parts = [_number_bytes(segment_length, 1), segment_bytes, _number_bytes(flags, 2), key_bytes]
    if member is not None:
        parts.append(F.coalesce(_as_bytes(member, member_type), F.lit(b"")))

    def refuse(message: str) -> Column:
        return F.raise_error(F.lit(message)).cast("binary")

    return (F.when(key.isNull() | segment.isNull() | store_type.isNull(),
                   refuse("a key needs a segment, a store type and key text"))
            .when(segment_length > MAX_SEGMENT_BYTES,
                  refuse(f"segment is longer than {MAX_SEGMENT_BYTES} bytes"))
            .when(key_length > MAX_KEY_BYTES, refuse(f"key is longer than {MAX_KEY_BYTES} bytes"))
            .otherwise(F.concat(*parts)))


def _number_at(data: Column, position: Column) -> Column:
    return F.conv(F.hex(F.substring(data, position, F.lit(1))), 16, 10).cast("int")


def decode_key(data: Column) -> Column:
    """Take an encoded key apart: a struct of segment, storeType, key and member."""
    segment_length = _number_at(data, F.lit(1))
    low = _number_at(data, segment_length + 2)
    high = _number_at(data, segment_length + 3)
    key_length = F.shiftleft(high.bitwiseAND(F.lit(0x0F)), 8).bitwiseOR(low)
    key_start = segment_length + 4
    rest = F.octet_length(data) - (key_start + key_length) + 1
    return F.struct(
        F.substring(data, F.lit(2), segment_length).cast("string").alias("segment"),
        F.shiftright(high, 4).cast("tinyint").alias("storeType"),
        F.substring(data, key_start, key_length).cast("string").alias("key"),
        F.substring(data, key_start + key_length, rest).cast("string").alias("member"),
    )


def segment_prefix(segment: str) -> bytes:
    """The bytes all encoded keys of a segment start with."""
    data = segment.encode()
    if len(data) > MAX_SEGMENT_BYTES:
        raise ValueError(f"segment is longer than {MAX_SEGMENT_BYTES} bytes")
    return bytes([len(data)]) + data


def in_segment(data: Column, segment: str) -> Column:
    """Range condition for one segment, so that sorted files are pruned by their statistics."""
    low = segment_prefix(segment)
    condition = data >= F.lit(low)
    # The smallest byte string above every key with this prefix.
    trimmed = low.rstrip(b"\xff")
    if trimmed:
        condition = condition & (data < F.lit(trimmed[:-1] + bytes([trimmed[-1] + 1])))
    return condition


def shard_id(key: Column, shards: int) -> Column:
    """Shard of a key: the first 32 bits of its MD5, modulo the shard count."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(shards)).cast("int")
