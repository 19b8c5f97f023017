"""Framed Avro: encode/decode identity, frame header, malformed input."""

import struct

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.sources.framing import decode_array, decode_avro, encode_avro, encode_batch, flatten, schema_id, strip_frame
from tidemark.spec import CLOUD_GAMING, VIDEO_STREAMING

CLOUD = "id long, CPU_usage int, GPU_usage int, Bandwidth_MBps double, Latency_ms int, FrameRate_fps int, Jitter_ms int"


def test_cloud_wire_bytes():
    rb = pa.RecordBatch.from_pydict(
        {
            "CPU_usage": pa.array([50], pa.int32()),
            "GPU_usage": pa.array([40], pa.int32()),
            "Bandwidth_MBps": [25.5],
            "Latency_ms": pa.array([35], pa.int32()),
            "FrameRate_fps": pa.array([60], pa.int32()),
            "Jitter_ms": pa.array([3], pa.int32()),
        }
    )
    got = encode_batch(rb, CLOUD_GAMING, 7)[0].as_py()
    # zig-zag varints 100, 80 / LE double / 70, 120, 6 after the 5-byte frame
    assert got == b"\x00\x00\x00\x00\x07" + bytes([100, 80]) + struct.pack("<d", 25.5) + bytes([70, 120, 6])


def test_video_body_is_five_doubles():
    rb = pa.RecordBatch.from_pydict({f: [float(i)] for i, f in enumerate(VIDEO_STREAMING.features)})
    body = encode_batch(rb, VIDEO_STREAMING, None)[0].as_py()
    assert body == struct.pack("<5d", 0.0, 1.0, 2.0, 3.0, 4.0)


def test_roundtrip_extremes(spark):
    rows = [
        (1, 0, 0, 0.0, 0, 0, 0),
        (2, -1, 2**31 - 1, -0.0, -(2**31), 63, 64),
        (3, 100, -65, float("nan"), 8191, 8192, -8193),
        (4, 50, 40, float("inf"), 1, 2, 3),
    ]
    df = spark.createDataFrame(rows, CLOUD)
    msgs = encode_avro(df, CLOUD_GAMING, 42, keep=["id"]).withColumn("sid", schema_id("value"))
    back = flatten(decode_avro(msgs, CLOUD_GAMING, keep=["id", "sid"])).orderBy("id").collect()
    for r, orig in zip(back, rows):
        assert r.sid == 42 and not r._malformed
        got = (r.id, r.CPU_usage, r.GPU_usage, r.Bandwidth_MBps, r.Latency_ms, r.FrameRate_fps, r.Jitter_ms)
        assert repr(got) == repr(orig)


def test_null_field_travels_as_null_value(spark):
    df = spark.createDataFrame([(1, 50, 40, 1.0, None, 60, 3)], CLOUD)
    r = flatten(decode_avro(encode_avro(df, CLOUD_GAMING, 1, keep=["id"]), CLOUD_GAMING, keep=["id"])).first()
    assert r._malformed and r.CPU_usage is None


def test_malformed_bodies():
    good = encode_batch(pa.RecordBatch.from_pydict({f: [1.0] for f in VIDEO_STREAMING.features}), VIDEO_STREAMING, 1)[0].as_py()
    vals, ok = decode_array(pa.array([good, good[:-1], good + b"\x00", None, b""]), VIDEO_STREAMING, 5)
    assert list(ok) == [True, False, False, False, False]


def test_strip_frame_expression(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02abc"),)], "v binary")
    r = df.select(strip_frame("v").alias("b"), schema_id("v").alias("s")).first()
    assert bytes(r.b) == b"abc" and r.s == 258
