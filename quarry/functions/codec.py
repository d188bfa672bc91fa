"""Binary codecs (F10, F11, F13, F14): built-ins where Spark has them, Arrow UDFs over whole batches otherwise."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base64_text(b) -> Column:
    """F10 encode: one-line base64 (Spark may wrap its output every 76 characters)."""
    return F.regexp_replace(F.base64(_col(b)), r"[\r\n]", "")


def from_base64_text(s) -> Column:
    """F10 decode (D17: lenient, like the reference's decoder)."""
    return F.unbase64(_col(s))


def utf8_lenient(b) -> Column:
    """F11 decode with malformed sequences replaced by U+FFFD (as a JVM ``new String`` does)."""
    return F.make_valid_utf8(_col(b).cast("string"))


def utf8(s) -> Column:
    """F11 encode."""
    return F.encode(_col(s), "UTF-8")


def be_long(b, start: int = 1) -> Column:
    """8 big-endian bytes at ``start`` (1-based) as a signed BIGINT."""
    return F.conv(F.hex(F.substring(_col(b), start, 8)), 16, -10).cast("long")


def long_be_bytes(x) -> Column:
    """BIGINT as 8 big-endian bytes (two's complement)."""
    return F.unhex(F.lpad(F.hex(_col(x).cast("long")), 16, "0"))


def _numbers(b: pa.Array, dtype: str) -> pa.Array:
    """Lists of fixed-width numbers over the buffer of a whole binary batch; a ragged value is an error."""
    b = b.cast(pa.binary())
    ends = np.frombuffer(b.buffers()[1], np.int32)[b.offset:b.offset + len(b) + 1]
    width = np.dtype(dtype).itemsize
    if (np.diff(ends) % width).any():
        raise ValueError(f"binary values are not whole {dtype} numbers")
    data = np.frombuffer(b.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]) // width, pa.int32()), pa.array(data.view(dtype)))
    return pc.if_else(b.is_valid(), lists, pa.scalar(None, lists.type)) if b.null_count else lists


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def le_int32_array(b: pa.Array) -> pa.Array:
    """bytes -> little-endian int32 values, a batch at a time."""
    return _numbers(b, "<i4")


@F.arrow_udf(T.ArrayType(T.FloatType()))
def le_float32_array(b: pa.Array) -> pa.Array:
    """Bytes -> little-endian float32 values, a batch at a time."""
    return _numbers(b, "<f4")


@F.arrow_udf(T.BinaryType())
def float32_le_bytes(a: pa.Array) -> pa.Array:
    """Float array -> little-endian float32 bytes, a batch at a time."""
    flat = a.flatten()
    sizes = np.diff(a.offsets.to_numpy())
    if a.null_count:
        sizes = np.where(a.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    ends = np.concatenate(([0], np.cumsum(sizes) * 4)).astype(np.int32)
    data = flat.to_numpy(zero_copy_only=False).astype("<f4").tobytes()
    out = pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
    return pc.if_else(a.is_valid(), out, pa.scalar(None, pa.binary())) if a.null_count else out
