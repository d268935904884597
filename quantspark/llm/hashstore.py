"""Sorted arrays in files of the shared folder, one per hash bucket, which workers map into memory."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions, so that a bucket's share stays as small as a partition's."""
    return max(1, min(65_536, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted unsigned 64-bit hashes that belong to one bucket each; buckets are ranges of hashes."""
    if len(hashes):
        of = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        ends = np.flatnonzero(np.diff(of)) + 1
        for a, b in zip([0, *ends], [*ends, len(of)], strict=True):
            yield int(of[a]), slice(int(a), int(b))


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Whole or not at all, so that a task that runs again just replaces the file by the same content."""
    os.makedirs(folder, exist_ok=True)
    part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, os.path.join(folder, f"{name}.npy"))


def load(folder: str, name: str, kind: type = np.uint64) -> np.ndarray:
    """Mapped into memory; an absent file is an empty array."""
    path = os.path.join(folder, f"{name}.npy")
    if not os.path.exists(path):
        return np.empty(0, kind)
    try:
        return np.load(path, mmap_mode="r")
    except ValueError:  # nothing to map
        return np.load(path)


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, or -1."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == wanted, at, -1)
