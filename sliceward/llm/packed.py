"""Packed keys and answers on their way between chunks and shards. Runs in Python workers; knows nothing of Spark."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

#: Added to the shard of the answers to a second question when both are handed to a chunk together.
SECOND = 1 << 30


def routed(chunk: int, shard_of: np.ndarray, columns: list[np.ndarray], extra: list[np.ndarray]) -> pa.Table:
    """Cut arrays that are sorted by shard. keys are raw bytes, extra is deflated; arrays of a shard stand in a row."""
    cuts = np.flatnonzero(np.diff(shard_of, prepend=-1)) if len(shard_of) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(shard_of)) if len(cuts) else cuts
    keys, extras = [], []
    for a, b in zip(cuts, ends, strict=True):
        keys.append(b"".join(np.ascontiguousarray(x[a:b]).tobytes() for x in columns))
        extras.append(zlib.compress(b"".join(np.ascontiguousarray(x[a:b]).tobytes() for x in extra), 1))
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(cuts), pa.int32()),
            "shard": pa.array(shard_of[cuts].astype(np.int32), pa.int32()),
            "keys": pa.array(keys, pa.binary()),
            "extra": pa.array(extras, pa.binary()),
        }
    )


def answered(table: pa.Table, sizes: list[int], values: np.ndarray) -> pa.Table:
    """One answer for each row of a ROUTED table, deflated; values hold them in a row."""
    cuts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    made = [zlib.compress(values[a:b].tobytes(), 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"chunk": table["chunk"], "shard": table["shard"], "answer": pa.array(made, pa.binary())})


def in_order(answers: pa.Table, dtype) -> np.ndarray:
    """The answers to one question of a chunk in the order of its keys."""
    order = np.argsort(answers["shard"].to_numpy(), kind="stable")
    column = answers["answer"]
    found = [zlib.decompress(column[int(i)].as_py()) for i in order]
    return np.frombuffer(b"".join(found), dtype)


def chunk_of(rows: pa.Table) -> int:
    return rows["__chunk"][0].as_py()


def by_id(rows: pa.Table) -> np.ndarray:
    return rows["__id"].to_numpy()


def part(answers: pa.Table, second: bool) -> pa.Table:
    at = answers["shard"].to_numpy()
    return answers.take(np.flatnonzero((at >= SECOND) == second))


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on: the upper bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    kind = np.dtype(dtype)
    return np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).reshape(-1)


def gaps(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, which need six bytes where keys are dense."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint16).reshape(-1, 4).T.tobytes()


def from_gaps(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint16).reshape(4, -1).T.copy().view(np.uint64).reshape(-1), dtype=np.uint64)


def small(columns: list[np.ndarray]) -> bytes:
    """Up to eight columns of whole numbers from 0, mostly 0 or 1: a byte a row tells which are above 0, then those less 1."""
    flags, above = np.zeros(len(columns[0]), np.uint8), []
    for k, column in enumerate(columns):
        some = column > 0
        flags |= some.astype(np.uint8) << np.uint8(k)
        values = column[some] - 1
        above.append(values.astype(np.min_scalar_type(int(values.max(initial=0)))))
    head = np.array([len(columns), len(flags), *(a.itemsize for a in above)], np.int64).tobytes()
    raw = head + flags.tobytes() + b"".join(planes(a) if len(a) else b"" for a in above)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def whole_numbers(data: bytes) -> list[np.ndarray]:
    """The columns that ``small`` packed."""
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    columns, size = np.frombuffer(raw, np.int64, 2).tolist()
    widths = np.frombuffer(raw, np.int64, columns, 16).tolist()
    at = 16 + 8 * columns
    flags, at, found = np.frombuffer(raw, np.uint8, size, at), at + size, []
    for k, width in enumerate(widths):
        some = np.flatnonzero(flags & (1 << k))
        made, end = np.zeros(size, np.int64), at + width * len(some)
        if len(some):
            made[some] = from_planes(raw[at:end], f"u{width}").astype(np.int64) + 1
        found.append(made)
        at = end
    return found
