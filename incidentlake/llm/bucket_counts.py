"""Corpus counts of hashed features: every document counts, the result has a fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import taken

_SLICES = 64
_SCHEMA = "slice long, counts binary"
Features = Callable[[list], Iterator[np.ndarray]]


def _packed(counts: np.ndarray) -> bytes:
    kind = np.uint8 if counts.max() < 1 << 8 else np.uint16 if counts.max() < 1 << 16 else np.int64
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 8: np.int64}[data[0]], offset=1).astype(np.int64)


def _rows(total: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"slice": np.arange(_SLICES), "counts": [_packed(x) for x in np.split(total, _SLICES)]})


def _summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of equal slices, of any number of tasks, in the memory of one result."""
    total: dict[int, np.ndarray] = {}
    for frame in taken(frames):
        for k, data in frame.itertuples(index=False):
            total[k] = total.get(k, 0) + _unpacked(data)
    if total:
        yield pd.DataFrame({"slice": list(total), "counts": [_packed(x) for x in total.values()]})


def bucket_counts(rows: DataFrame, size: int, features: Features, count_rows: bool = False) -> np.ndarray | tuple[np.ndarray, int]:
    """How often the ``features`` (bucket numbers of each ``text``) fall in each of ``size`` buckets; with ``count_rows`` also the rows.

    Each task sends one packed array in slices; a slice is summed by itself, so the sums spread over tasks at any number of them.
    """
    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(size, np.int64), 0
        for frame in taken(frames):
            waiting, held = [], 0
            n += len(frame)
            for found in features(list(frame["text"])):
                waiting.append(found)
                held += len(found)
                if held > size:
                    total += np.bincount(np.concatenate(waiting), minlength=size)
                    waiting, held = [], 0
            if held:
                total += np.bincount(np.concatenate(waiting), minlength=size)
        if n:
            yield pd.concat([_rows(total), pd.DataFrame({"slice": [-1], "counts": [_packed(np.array([n]))]})])

    parts = rows.select("text").mapInPandas(counted, _SCHEMA)
    found = {r["slice"]: r["counts"] for r in parts.repartition(_SLICES, "slice").mapInPandas(_summed, _SCHEMA).collect()}
    nothing = _packed(np.zeros(size // _SLICES, np.int64))
    counts = np.concatenate([_unpacked(bytes(found.get(k, nothing))) for k in range(_SLICES)])
    return (counts, int(_unpacked(bytes(found.get(-1, _packed(np.zeros(1, np.int64)))))[0])) if count_rows else counts
