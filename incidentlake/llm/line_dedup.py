"""Line dedup by winnowing over line hashes.

A window is the shortest stretch of lines, from a given line on, with MIN_WORDS words (blank lines count for nothing). Its
fingerprint is the smallest line hash in it (the leftmost, if equal), so equal windows have equal fingerprints at equal places:
a repeated run of lines with MIN_WORDS words or more cannot be missed. Places that share a fingerprint are joined, and the
lines of a window that has stood before, in the order of (document, line), are deleted.

These windows cover a run from its first line to the end of the last window that fits; the rest has fewer than MIN_WORDS
words. A match is therefore extended by endings: from the starts of repeated windows, the stretches that are the shortest ones
with MIN_WORDS words up to their last line are compared in the same way. An ending can only repeat if the window from its first line
does. Of a run with MIN_WORDS words every line is in a window or in an ending inside the run, so the union of both that
have stood before is the whole later run. The first run stays.

Hot lines: groups are reduced to their first place in every task before the shuffle, and the joins back are plain equi-joins
that adaptive execution splits. No pairs of occurrences are made.

Defined cases: null and empty texts have no lines and stay as they are; lines are compared without outer white space; equal rows (same id and
text) count as one document, and each of them is treated alike; null ids come first in the order; a run that overlaps itself keeps its
first line; texts are whole at any length; other columns are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, narrowed, ship, taken

MIN_WORDS = 50


def lines_of(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def hashed_lines(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Number, hash and words of every line that is not blank."""
    numbers, hashes, words = [], [], []
    for k, line in enumerate(lines_of(text)):
        if stripped := line.strip():
            numbers.append(k)
            hashes.append(xxhash.xxh3_128_intdigest(stripped))
            words.append(len(stripped.split()))
    return numbers, hashes, words


def key_of(hashes: list[int]) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(b"".join(h.to_bytes(16, "little") for h in hashes))
    return whole >> 64, whole & (1 << 64) - 1


def windows(text: str | None, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, int, int]]:
    """(fingerprint, its line, key, key, first line, last line) of every window of a text."""
    numbers, hashes, words = hashed_lines(text)
    out = []
    stop, total = 0, 0
    for start in range(len(numbers)):
        while stop < len(numbers) and total < min_words:
            total += words[stop]
            stop += 1
        if total < min_words:
            break
        inside = hashes[start:stop]
        low = min(inside)
        out.append((low & (1 << 64) - 1, numbers[start + inside.index(low)], *key_of(inside), numbers[start], numbers[stop - 1]))
        total -= words[start]
    return out


def endings(text: str | None, starts: set[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """(key, key, first line, last line) of every shortest stretch up to a line that begins at one of ``starts`` and is no window."""
    numbers, hashes, words = hashed_lines(text)
    out = []
    start, total = 0, 0
    for stop in range(len(numbers)):
        total += words[stop]
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total - words[stop] >= min_words and numbers[start] in starts:
            out.append((*key_of(hashes[start:stop + 1]), numbers[start], numbers[stop]))
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with later repeated runs deleted from the text, and n_lines and n_removed (lines) behind."""
    ship(docs.sparkSession)
    names = docs.columns
    rows = docs.select(
        F.struct(*[docs[c] for c in names]).alias("row"), docs[id_col].alias("id"),
        F.xxhash64(docs[id_col], docs[text_col]).alias("row_key"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def fingerprints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in taken(frames):
            found = [windows(t, min_words) for t in frame["text"]]
            n = [len(f) for f in found]
            flat = np.array([w for f in found for w in f], np.uint64).reshape(-1, 6).view(np.int64)
            yield pd.DataFrame({"id": frame["id"].repeat(n), "row_key": np.repeat(frame["row_key"].to_numpy(), n)} | {
                c: flat[:, k] for k, c in enumerate(["low", "low_line", "a", "b", "first", "last"])})

    places = cut(rows.select("id", "row_key", "text").mapInPandas(
        fingerprints, f"id {id_type}, row_key bigint, low bigint, low_line bigint, a bigint, b bigint, first bigint, last bigint"))
    spot = F.struct("row_key", "low_line")
    shared = places.groupBy("low").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).filter("x <> y").select("low")
    matched = places.join(shared, "low", "left_semi")
    place = F.struct("id", "row_key", "first")

    def repeated(stretches: DataFrame) -> DataFrame:
        """The stretches that stand at several places, with the first of these."""
        earliest = stretches.groupBy("a", "b").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x <> y").select("a", "b", "x")
        return stretches.join(earliest, ["a", "b"]).select("id", "row_key", "first", "last", "x")

    again = cut(repeated(matched))
    starts = again.groupBy("row_key").agg(F.collect_set("first").alias("starts"))

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in taken(frames):
            found = [endings(t, set(s.tolist()), min_words) for t, s in zip(frame["text"], frame["starts"], strict=True)]
            n = [len(f) for f in found]
            flat = np.array([w for f in found for w in f], np.uint64).reshape(-1, 4).view(np.int64)
            yield pd.DataFrame({"id": frame["id"].repeat(n), "row_key": np.repeat(frame["row_key"].to_numpy(), n)} | {
                c: flat[:, k] for k, c in enumerate(["a", "b", "first", "last"])})

    held = narrowed(rows.select("id", "row_key", "text"), starts, "row_key").join(starts, "row_key").select("id", "row_key", "text", "starts")
    tails = cut(held.mapInPandas(ends, f"id {id_type}, row_key bigint, a bigint, b bigint, first bigint, last bigint"))
    later = again.union(repeated(tails)).filter(place > F.col("x"))
    gone = later.groupBy("row_key").agg(F.collect_set(F.struct("first", "last")).alias("gone"))

    def remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in taken(frames):
            texts, n_lines, n_removed = [], [], []
            for text, spans in zip(frame["text"], frame["gone"], strict=True):
                lines = lines_of(text)
                keep = np.ones(len(lines), bool)
                for s in spans if spans is not None else ():
                    keep[s["first"]:s["last"] + 1] = False
                texts.append(text if keep.all() else "\n".join(x for x, k in zip(lines, keep, strict=True) if k))
                n_lines.append(len(lines))
                n_removed.append(int((~keep).sum()))
            out = frame[["row"]].copy()
            out["text"], out["n_lines"], out["n_removed"] = texts, n_lines, n_removed
            yield out

    joined = rows.join(gone, "row_key", "left").select("row", "text", "gone")
    others = [c for c in names if c != text_col]
    slim = joined.select(F.struct(*[F.col("row")[c].alias(f"c{k}") for k, c in enumerate(others)]).alias("row"), "text", "gone")
    made = slim.mapInPandas(remove, f"row {slim.schema['row'].dataType.simpleString()}, text string, n_lines bigint, n_removed bigint")
    back = [F.col("text").alias(c) if c == text_col else F.col("row")[f"c{others.index(c)}"].alias(c) for c in names]
    return made.select(*back, "n_lines", "n_removed")
