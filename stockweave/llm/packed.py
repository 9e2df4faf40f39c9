"""Numpy records that cross a shuffle packed by bucket: a row holds all records of one task for one bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: What a record says: a key, what tells kinds under it apart, the 128-bit name of a text or set, a place, a size, a mark.
RECORD = np.dtype([("key", "<u8"), ("rest", "<u8"), ("d1", "<i8"), ("d2", "<i8"), ("at", "<u4"), ("n", "<u4"), ("many", "u1")])
PACKED = "bucket int, decided int, payload binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def records(key, rest, d1, d2, at, n, many=0) -> np.ndarray:
    out = np.empty(len(at), dtype=RECORD)
    for name, column in (("key", key), ("rest", rest), ("d1", d1), ("d2", d2), ("at", at), ("n", n), ("many", many)):
        out[name] = column
    return out


def join(parts: list[np.ndarray], kind: np.dtype = RECORD) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def groups(rows: np.ndarray, rest: str = "rest"):
    """Records in order of (key, ``rest``); first of each kind, size of its kind, kinds under its key, rank of kind in key."""
    r = rows[np.lexsort((rows[rest], rows["key"]))]
    new_key = np.concatenate([[True], r["key"][1:] != r["key"][:-1]])
    first = new_key | np.concatenate([[True], r[rest][1:] != r[rest][:-1]])
    kind, key = np.cumsum(first) - 1, np.cumsum(new_key) - 1
    kinds = np.bincount(key, weights=first).astype(np.int64)[key]
    rank = kind - kind[np.flatnonzero(new_key)][key]
    return r, first, np.bincount(kind)[kind], kinds, rank


def marked(rows: np.ndarray, status: np.ndarray) -> np.ndarray:
    """The records with a status, which takes the place of the mark."""
    out = rows[status > 0].copy()
    out["many"] = status[status > 0]
    return out


def dealt(rows: np.ndarray, spread: np.ndarray, decided: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, decided, payload); ``spread`` picks the bucket."""
    if not len(rows):
        return
    bucket = (mix(spread) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0, [True]]))
    # The payloads are the records themselves, not copies.
    ends = (cuts * rows.itemsize).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[cuts[:-1]], pa.int32()),
            pa.array(np.full(len(cuts) - 1, decided), pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(rows.view(np.uint8))]),
        ],
        ["bucket", "decided", "payload"],
    )


def opened(table: pa.Table, kind: np.dtype = RECORD) -> tuple[np.ndarray, np.ndarray]:
    """The records of a bucket: open and decided ones."""
    parts: list[list[np.ndarray]] = [[], []]
    for decided, payload in zip(table.column("decided").to_pylist(), table.column("payload"), strict=True):
        parts[decided].append(np.frombuffer(payload.as_buffer(), dtype=kind))
    return join(parts[0], kind), join(parts[1], kind)
