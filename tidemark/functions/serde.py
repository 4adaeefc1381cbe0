"""Encoders and decoders of the eight key and message types, as column expressions.

Integers are big-endian and stay inside the JVM; floats go through a
vectorised Arrow function. A payload of the wrong length
decodes to null; NaN and the infinities are values like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULTS = {"string": "", "int32": 0, "int64": 0, "uint32": 0, "uint64": 0, "float32": 0.0, "float64": 0.0, "blob": b""}


def _float_decoder(kind: str, result: str):
    width = int(kind[2:])

    def decode(raw: pa.Array) -> pa.Array:
        size = pc.fill_null(pc.binary_length(raw), -1).to_numpy(zero_copy_only=False)
        good = raw.filter(pa.array(size == width))
        ends = np.frombuffer(good.buffers()[1], np.int32)[good.offset : good.offset + len(good) + 1]
        out = np.zeros(len(raw), kind[1:])
        out[size == width] = np.frombuffer(good.buffers()[2], kind, len(good), int(ends[0])) if len(good) else 0
        return pa.array(out, mask=size != width)  # a NaN is a value, not a null

    return F.arrow_udf(decode, result)


def _float_encoder(kind: str):
    width = int(kind[2:])

    def encode(values: pa.Array) -> pa.Array:
        raw = values.fill_null(0).to_numpy(zero_copy_only=False).astype(kind).tobytes()
        ends = pa.array(np.arange(len(values) + 1) * width, pa.int32())
        whole = pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, ends.buffers()[1], pa.py_buffer(raw)])
        return pc.if_else(values.is_null(), pa.scalar(None, pa.binary()), whole)

    return F.arrow_udf(encode, "binary")


def encode(value: Column, kind: str) -> Column:
    """The bytes of a column of the given type."""
    if kind == "string":
        return value.cast("string").cast("binary")
    if kind in ("int32", "uint32"):
        return F.unhex(F.right(F.lpad(F.hex(value.cast("long")), F.lit(16), F.lit("0")), F.lit(8)))
    if kind == "int64":
        return F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))
    if kind == "uint64":
        folded = F.when(value > F.lit("9223372036854775807").cast("decimal(20,0)"), value - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(value)
        return F.unhex(F.lpad(F.hex(folded.cast("long")), 16, "0"))
    if kind in ("float32", "float64"):
        return _float_encoder(">f4" if kind == "float32" else ">f8")(value.cast("double"))
    if kind == "blob":
        return value.cast("binary")
    raise ValueError(f"unsupported type {kind}")


def decode(raw: Column, kind: str) -> Column:
    """The value of bytes; null where they can't be one. Malformed UTF-8 gets replacement characters."""
    if kind == "string":
        return F.make_valid_utf8(raw.cast("string"))
    if kind in ("int32", "uint32"):
        value = F.when(F.octet_length(raw) == 4, F.conv(F.hex(raw), 16, 10).cast("long"))
        return value if kind == "uint32" else F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value).cast("int")
    if kind == "int64":
        return F.when(F.octet_length(raw) == 8, F.conv(F.hex(raw), 16, -10).cast("long"))
    if kind == "uint64":
        return F.when(F.octet_length(raw) == 8, F.conv(F.hex(raw), 16, 10).cast("decimal(20,0)"))
    if kind == "float32":
        return _float_decoder(">f4", "float")(raw)
    if kind == "float64":
        return _float_decoder(">f8", "double")(raw)
    if kind == "blob":
        return raw
    raise ValueError(f"unsupported type {kind}")


def or_default(value: Column, kind: str) -> Column:
    """A null key as the default of its type: unkeyed rows and rows keyed with the default look the same."""
    default = F.lit(DEFAULTS[kind]) if kind != "blob" else F.lit("").cast("binary")
    return F.coalesce(value, default.cast({"int32": "int", "uint32": "bigint", "int64": "bigint", "uint64": "decimal(20,0)", "float32": "float", "float64": "double", "string": "string", "blob": "binary"}[kind]))
