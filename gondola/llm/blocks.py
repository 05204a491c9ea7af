"""Documents dealt into blocks, and number columns packed into one binary value.

A block is a bounded group of whole documents that one task holds at a time; its texts travel
compressed. Sorted fingerprints are packed by their differences, byte plane by byte plane.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pack_texts(batches):
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        z = pa.array([squeeze.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], z], names=[*batch.schema.names[:-1], "z"])


def deal(src: DataFrame, keys: list[str], block_bytes: int) -> DataFrame:
    """``src`` (with a last column ``text``) as rows with ``block`` and the packed text ``z``, dealt by a hash of ``keys``."""
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(src.sparkSession.sparkContext.defaultParallelism, -(-size // block_bytes))
    names = [c for c in src.columns if c != "text"]
    out = src.select(*names, F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("block"), "text")
    schema = ", ".join(f"{c} {t}" for c, t in out.dtypes if c != "text") + ", z binary"
    return out.mapInArrow(_pack_texts, schema).repartition(blocks, "block")


def unpack_texts(column, at: int, size: int):
    """Bytes and offsets of some packed texts."""
    plain = zstandard.ZstdDecompressor()
    raw = [plain.decompress(z) for z in column.slice(at, size).to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of uint64 as one value; a sorted column is kept by its differences."""
    parts = [np.array([len(columns)] + [len(c) for c in columns], np.uint64).tobytes()]
    for c in columns:
        c = c.astype(np.uint64)
        rising = len(c) > 1 and bool((c[1:] >= c[:-1]).all())
        if rising:
            c = np.concatenate([c[:1], np.diff(c)])
        parts += [b"\1" if rising else b"\0", c.view(np.uint8).reshape(-1, 8).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, np.uint64, 1)[0])
    sizes = np.frombuffer(raw, np.uint64, n, 8).astype(np.int64)
    at, out = 8 * (n + 1), []
    for size in sizes.tolist():
        c = np.frombuffer(raw, np.uint8, 8 * size, at + 1).reshape(8, size).T.copy().view(np.uint64).reshape(-1)
        out.append(np.cumsum(c, dtype=np.uint64) if raw[at] else c)
        at += 1 + 8 * size
    return out
