"""Whole-file JSON in parts: the members of a list or an object are found from prefix sums of quotes and brackets.

Members end at commas, so Spark deals the file out by commas. Whether a comma is inside a string follows from the quotes before
it that no backslash makes part of a string, and its depth from the brackets outside strings. A first scan gives, for each
byte range and for both ways it may begin (inside a string or not), how it ends and by how much the depth changes; put
together in order these tell how each range begins, and with that it finds the commas that part members.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_ranges import parts_of, records, segments

_RANGE = "file string, block long, start string, odd boolean, outside long, inside long"
_MEMBER = "file string, block long, number int, key string, value string, plain string"
_MEMBER_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("number", pa.int32()), ("key", pa.string()), ("value", pa.string()), ("plain", pa.string())])


def _scan(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: the number of string quotes up to it, and what it adds to the depth if it is outside strings."""
    codes = np.frombuffer(data, np.uint8)
    place = np.arange(len(codes))
    slash = codes == ord("\\")
    other = np.maximum.accumulate(np.where(slash, -1, place))  # the last byte that is no backslash
    escaped = np.zeros(len(codes), bool)
    escaped[1:] = (place[:-1] - other[:-1]) % 2 == 1
    quotes = np.cumsum((codes == ord('"')) & ~escaped)
    return quotes, np.isin(codes, list(b"[{")).astype(np.int64) - np.isin(codes, list(b"]}"))


def _joined(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """The parts with their commas, and where the commas stand."""
    texts = values.to_pylist()
    return b",".join([*texts, b""]), np.cumsum([len(t) + 1 for t in texts]) - 1


def begins(parts: DataFrame) -> dict[tuple[str, int], tuple[str, int, int]]:
    """For each byte range: the file's first sign, whether the range begins inside a string, and its depth there. One small row a range reaches the driver."""

    def summed(batches):
        now, row = None, None
        for file, block, values in segments(batches):
            if now != (file, block):
                if now:
                    yield pa.RecordBatch.from_pylist([row])
                now, row = (file, block), {"file": file, "block": block, "start": None, "odd": False, "outside": 0, "inside": 0}
            data, _ = _joined(values)
            if row["start"] is None and (text := data.lstrip(b" \t\r\n,\xef\xbb\xbf")):
                row["start"] = chr(text[0])
            quotes, depth = _scan(data)
            odd = (quotes & 1).astype(bool)
            a, b = int(depth[~odd].sum()), int(depth[odd].sum())
            if row["odd"]:
                a, b = b, a
            row["outside"], row["inside"], row["odd"] = row["outside"] + a, row["inside"] + b, row["odd"] ^ bool(len(odd) and odd[-1])
        if now:
            yield pa.RecordBatch.from_pylist([row])

    def fixed(batches):
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("start", pa.string()), ("odd", pa.bool_()), ("outside", pa.int64()), ("inside", pa.int64())])
        return (b.cast(schema) for b in summed(batches))

    out, now = {}, None
    for r in sorted(parts.mapInArrow(fixed, _RANGE).collect(), key=lambda r: (r["file"], r["block"])):
        if r["file"] != now:
            now, start, inside, depth = r["file"], r["start"], False, 0
        out[r["file"], r["block"]] = start, int(inside), depth
        depth += r["inside"] if inside else r["outside"]
        inside ^= r["odd"]
    return out


def members(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, number, key, value, plain): the members of the list or object that each file holds, in as many tasks as it has byte ranges.

    (file, block, number) is their order. key: that of an object's member, null in a list; value: the member as JSON; plain:
    its text if it is a string. An object's null members are left out, as are a list's; what is no list or object gives no rows.
    """
    parts = parts_of(spark, path, ",")
    sent = spark.sparkContext.broadcast(begins(parts))

    def begin(file, block):
        _, inside, depth = sent.value[file, block]
        state = [inside, depth]

        def ends(values: pa.Array) -> np.ndarray:
            data, commas = _joined(values)
            quotes, change = _scan(data)
            odd = (quotes + state[0]) & 1
            depth = state[1] + np.cumsum(np.where(odd == 0, change, 0))
            state[:] = int(odd[-1]), int(depth[-1])
            return (odd[commas] == 0) & (depth[commas] == 1)

        return ends, bool(block) and (inside, depth) != (0, 1)

    def parse(file, block, number, first, found):
        is_object, rows = sent.value[file, 0][0] == "{", []
        for i, raw in enumerate(found):
            text = raw.decode("utf-8", "replace").strip(" \t\r\n﻿")
            quotes, change = _scan(text.encode())
            depth = np.cumsum(np.where(quotes & 1 == 0, change, 0))
            if first and i == 0:
                whole = len(depth) and depth[-1] == 0
                text = text[1:-1] if whole else text[1:]
            elif len(depth) and depth[-1] < 0:
                text = text[:-1]
            text = text.strip()
            if not text:
                continue
            key, value = next(iter(json.loads(f"{{{text}}}").items())) if is_object else (None, json.loads(text))
            if value is not None:
                rows.append((file, block, min(number + i, (1 << 31) - 1), key, json.dumps(value, ensure_ascii=False), value if isinstance(value, str) else None))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MEMBER_ARROW)] if rows else [pa.array([], f.type) for f in _MEMBER_ARROW], schema=_MEMBER_ARROW)

    return records(parts, begin, b",", parse, _MEMBER).where(F.col("value").isNotNull())
