"""Framed Avro records (A2-A4, B1).

Wire format of one message value: magic byte 0x00, 4-byte big-endian schema
id, then the Avro binary body of one flat record (``int`` = zig-zag varint,
``double`` = 8-byte little-endian).

When the spark-avro package is on the classpath, bodies go through the JVM
``from_avro`` / ``to_avro``. Otherwise they are decoded/encoded on executors by
``mapInArrow`` with vectorised numpy over whole Arrow batches (no per-row
Python). Both paths keep the frame handling as plain Catalyst expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import UseCase

HEADER = 5

# ------------------------------------------------------------ frame (A2)


def strip_frame(value) -> Column:
    """Drop the 5-byte header of a framed binary value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.substring(v, HEADER + 1, 2**31 - 1)


def schema_id(value) -> Column:
    """The 4-byte big-endian schema id carried in the frame."""
    v = F.col(value) if isinstance(value, str) else value
    return F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("int")


def frame(body, sid: int) -> Column:
    """Prefix an Avro body with the frame header of schema id ``sid``."""
    b = F.col(body) if isinstance(body, str) else body
    header = F.unhex(F.lit("00" + format(int(sid), "08x")))
    return F.concat(header, b)


def spark_avro_available(spark) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:
        return False


# -------------------------------------------------- vectorised Avro codec


def _zigzag_varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int32 array -> (n x 5 byte matrix, byte lengths)."""
    z = ((x.astype(np.int64) << 1) ^ (x.astype(np.int64) >> 31)).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    out = np.zeros((len(z), 5), dtype=np.uint8)
    lens = np.ones(len(z), dtype=np.int64)
    rest = z.copy()
    for k in range(5):
        byte = (rest & np.uint64(0x7F)).astype(np.uint8)
        rest = rest >> np.uint64(7)
        more = rest > 0
        out[:, k] = byte | (more.astype(np.uint8) << 7)
        lens += more if k < 4 else 0
        if not more.any():
            break
    return out, lens


def encode_batch(batch: pa.RecordBatch, u: UseCase, sid: int | None) -> pa.Array:
    """Avro-encode every row of a batch of feature columns into one binary array.

    Rows with a null feature get a null value."""
    n = batch.num_rows
    missing = np.zeros(n, dtype=bool)
    mats, lens = [], []
    if sid is not None:
        head = np.frombuffer(b"\x00" + int(sid).to_bytes(4, "big"), dtype=np.uint8)
        mats.append(np.broadcast_to(head, (n, HEADER)))
        lens.append(np.full(n, HEADER, dtype=np.int64))
    for f, t in zip(u.features, u.feature_types):
        col = batch.column(batch.schema.get_field_index(f))
        if col.null_count:
            missing |= np.asarray(col.is_null().to_numpy(zero_copy_only=False), dtype=bool)
            col = col.fill_null(0)
        if t == "int":
            m, ln = _zigzag_varints(col.to_numpy(zero_copy_only=False).astype(np.int32))
        else:
            m = np.ascontiguousarray(col.to_numpy(zero_copy_only=False).astype("<f8")).view(np.uint8).reshape(n, 8)
            ln = np.full(n, 8, dtype=np.int64)
        mats.append(m)
        lens.append(ln)
    widths = [m.shape[1] for m in mats]
    mat = np.hstack(mats) if mats else np.zeros((n, 0), np.uint8)
    mask = np.hstack([np.arange(w)[None, :] < ln[:, None] for w, ln in zip(widths, lens)])
    flat = mat[mask]
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.sum(lens, axis=0), out=offsets[1:])
    out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])
    if missing.any():
        # a record with a null field has no Avro encoding (fields are not
        # nullable): it travels as a null message value and is quarantined
        out = pa.compute.if_else(pa.array(missing), pa.scalar(None, pa.binary()), out)
    return out


def decode_array(arr: pa.Array, u: UseCase, skip: int = 0) -> tuple[dict, np.ndarray]:
    """Binary array of Avro bodies -> ({feature: values}, ok mask).

    Decodes all rows at once, field by field. A body that is too short, too
    long or null yields ok = False (its fields become null downstream).
    """
    arr = arr.cast(pa.binary()) if arr.type != pa.binary() else arr
    n = len(arr)
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int32, count=n + 1, offset=arr.offset * 4).astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    valid = ~np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    pos = offsets[:-1] + skip
    end = offsets[1:]
    ok = valid & (pos <= end)
    # reads past a short body land in zero padding and are caught by the
    # length checks below
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    cap = len(padded) - 1
    out = {}
    for f, t in zip(u.features, u.feature_types):
        if t == "int":
            z = np.zeros(n, dtype=np.uint64)
            cont = np.ones(n, dtype=bool)
            used = np.zeros(n, dtype=np.int64)
            for k in range(5):
                b = padded[np.minimum(pos + k, cap)].astype(np.uint64)
                take = cont
                z |= np.where(take, (b & np.uint64(0x7F)) << np.uint64(7 * k), np.uint64(0))
                used += take
                cont = take & ((b & np.uint64(0x80)) != 0)
            ok &= ~cont  # more than 5 bytes: malformed
            vals = ((z >> np.uint64(1)).astype(np.int64) ^ -((z & np.uint64(1)).astype(np.int64))).astype(np.int32)
            out[f] = vals
            pos = pos + used
        else:
            idx = np.minimum(pos[:, None] + np.arange(8)[None, :], cap)
            out[f] = padded[idx].copy().view("<f8").reshape(n)
            pos = pos + 8
        ok &= pos <= end
    ok &= pos == end
    return out, ok


def _decode_fn(u: UseCase, col: str, skip: int, keep: list[str]):
    def fn(batches):
        for b in batches:
            vals, ok = decode_array(b.column(b.schema.get_field_index(col)), u, skip)
            mask = pa.array(~ok)
            arrays = [b.column(b.schema.get_field_index(k)) for k in keep]
            for f, t in zip(u.features, u.feature_types):
                typ = pa.int32() if t == "int" else pa.float64()
                arrays.append(pa.array(vals[f], type=typ, mask=np.asarray(~ok)))
            arrays.append(mask)
            yield pa.RecordBatch.from_arrays(arrays, names=keep + list(u.features) + ["_malformed"])

    return fn


def _encode_fn(u: UseCase, sid: int | None, keep: list[str]):
    def fn(batches):
        for b in batches:
            arrays = [b.column(b.schema.get_field_index(k)) for k in keep]
            arrays.append(encode_batch(b, u, sid))
            yield pa.RecordBatch.from_arrays(arrays, names=keep + ["value"])

    return fn


# --------------------------------------------------------- A3, A4, B1


def decode_avro(df: DataFrame, u: UseCase, col: str = "value", framed: bool = True, keep=()) -> DataFrame:
    """Framed (or bare) Avro values -> ``data`` struct of the record fields,
    plus ``_malformed``; ``keep`` columns pass through. Use ``flatten`` next.
    """
    keep = list(keep)
    spark = df.sparkSession
    if spark_avro_available(spark):
        from pyspark.sql.avro.functions import from_avro

        body = strip_frame(col) if framed else F.col(col)
        data = from_avro(body, u.avro_schema(), {"mode": "PERMISSIVE"})
        return df.select(*keep, data.alias("data")).withColumn("_malformed", F.col("data").isNull())
    fields = [T.StructField(k, df.schema[k].dataType, True) for k in keep]
    fields += [T.StructField(f, u.spark_type(f), True) for f in u.features]
    fields.append(T.StructField("_malformed", T.BooleanType(), False))
    out = df.select(*keep, col).mapInArrow(_decode_fn(u, col, HEADER if framed else 0, keep), T.StructType(fields))
    return out.select(*keep, F.struct(*u.features).alias("data"), "_malformed")


def flatten(df: DataFrame, struct: str = "data") -> DataFrame:
    """A4: the record fields as top-level columns."""
    others = [c for c in df.columns if c != struct]
    return df.select(*others, f"{struct}.*")


def encode_avro(df: DataFrame, u: UseCase, sid: int | None = 1, keep=()) -> DataFrame:
    """B1: feature columns -> framed Avro ``value`` (schema id ``sid``; None = bare body)."""
    keep = list(keep)
    typed = df.select(*keep, *[F.col(f).cast(u.spark_type(f)).alias(f) for f in u.features])
    spark = df.sparkSession
    if spark_avro_available(spark):
        from pyspark.sql.avro.functions import to_avro

        body = to_avro(F.struct(*u.features), u.avro_schema())
        complete = F.lit(True)
        for f in u.features:
            complete = complete & F.col(f).isNotNull()
        value = F.when(complete, frame(body, sid) if sid is not None else body)
        return typed.select(*keep, value.alias("value"))
    fields = [T.StructField(k, typed.schema[k].dataType, True) for k in keep] + [T.StructField("value", T.BinaryType(), True)]
    return typed.mapInArrow(_encode_fn(u, sid, keep), T.StructType(fields))
