"""Suffix-array dedup: bytes inside strings of LENGTH bytes that start anywhere else too.

Suffixes are ordered only through their first LENGTH bytes, most significant digit first, and a group that is
settled leaves the sort early; groups that are equal to the end are exactly the repeated strings. The digits of
the suffix at ``i`` are

1. the gram of GRAM bytes with the smallest hash within its LENGTH bytes (the leftmost, if equal). It depends on those
   bytes alone, so equal strings have equal grams at equal places. Neighbouring suffixes share it, so a row stands for a
   stretch of them: about one row for each (LENGTH - GRAM) / 2 bytes. Groups of one row hold nothing repeated.
2. all bytes that the suffixes of a stretch read. Equal stretches settle as repeated.
3. the LENGTH bytes of each suffix, only where digit 2 left a stretch alone in a group that digit 1 found shared. One stretch
   stands for all that are equal in digit 2. The bytes of a group's stretches meet in the task of their gram; a group of more than GROUP
   stretches is dealt out suffix by suffix instead.

Digits are hashes of 64 bits, in large groups 128. Documents are rows: equal rows count as documents of their own. Null and empty
texts have no bytes; matches never cross rows; a text of any length is worked through in pieces of PIECE bytes, and a
stretch cut at a piece's end is settled by digit 3. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, narrowed, rename, ship, without

LENGTH, GRAM = 200, 64
SPAN = LENGTH - GRAM + 1  # grams in LENGTH bytes
PIECE = 1 << 20
GROUP = 10_000  # stretches of a gram whose bytes meet in one task; the suffixes of larger groups are rows of their own
_LOW = np.uint64((1 << 21) - 1)
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Rolling:
    """Hashes of all substrings of a buffer: sums of byte codes times powers of an odd number, modulo 2**64."""

    _lanes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __init__(self, lane: int):
        if lane not in self._lanes:
            n = PIECE + LENGTH + 1
            base = _ODD[lane]
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            codes = np.random.default_rng(7 + lane).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
            self._lanes[lane] = codes, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
        self.codes, self.powers, self.inverse = self._lanes[lane]

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums along the last axis, one longer than the data."""
        out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
        np.cumsum(self.codes[data] * self.powers[:data.shape[-1]], axis=-1, out=out[..., 1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((sums[stop] - sums[start]) * self.inverse[start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def stretches(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that lie in ``data`` one after another: digit 1, digit 2, text, first suffix, further suffixes and gram's offset of each stretch."""
    roll = Rolling(0)
    sums = roll.sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = roll.between(sums, at, at + GRAM)
    best = sliding_min((grams & ~_LOW) | at.astype(np.uint64), SPAN)
    edge = np.zeros(len(data) + 1, np.int8)
    long = stops - starts >= LENGTH
    edge[starts[long]] += 1
    edge[stops[long] - LENGTH + 1] -= 1
    valid = np.flatnonzero(np.cumsum(edge[:len(best)]))
    gram = (best[valid] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(gram) != 0) | (np.diff(valid) != 1)]))
    first, last, gram = valid[new], valid[np.append(new[1:] - 1, len(valid) - 1)], gram[new]
    more, offset = last - first, gram - first
    whole = mixed(roll.between(sums, first, last + LENGTH) + (more * 256 + offset).astype(np.uint64) * np.uint64(_ODD[1]))
    return grams[gram], whole, np.searchsorted(starts, first, "right") - 1, first, more, offset


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of at most PIECE suffixes with (text, offset in the text, start, stop) of what they hold."""
    buffer: list[bytes] = []
    inside: list[tuple[int, int, int, int]] = []
    size = 0
    for k, text in enumerate(texts):
        for offset in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            part = text[offset:offset + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield b"".join(buffer), inside
                buffer, inside, size = [], [], 0
            buffer.append(part)
            inside.append((k, offset, size, size + len(part)))
            size += len(part)
    if inside:
        yield b"".join(buffer), inside


def _first_digits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``place`` packs the first suffix, the number of further suffixes and the gram's offset."""
    for frame in frames:
        rows = frame["row_key"].to_numpy()
        for data, inside in _pieces([(t or "").encode() for t in frame["text"]]):
            text, offset, start, stop = np.array(inside, np.int64).T
            gram, whole, piece, first, more, shift = stretches(np.frombuffer(data, np.uint8), start, stop)
            place = (first - start[piece] + offset[piece]) << 16 | more << 8 | shift
            yield pd.DataFrame({"gram": gram.view(np.int64), "whole": whole.view(np.int64), "row_key": rows[text[piece]], "place": place})


def _block(texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
    width = LENGTH + SPAN
    block = np.frombuffer(b"".join([t.ljust(width, b"\0") for t in texts]), np.uint8).reshape(-1, width)
    if (lengths > width).any():
        raise ValueError("a stretch is longer than its grams allow")
    return block


def _open_bytes(frames: Iterator[pd.DataFrame], column: str) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Row keys, places and bytes of the stretches named in ``column``."""
    for frame in frames:
        keys, data, places = [], [], []
        for row_key, text, open_ in frame[["row_key", "text", column]].itertuples(index=False):
            raw = (text or "").encode()
            for place in open_:
                first = place >> 16
                keys.append(row_key)
                places.append(place)
                data.append(raw[first:first + (place >> 8 & 255) + LENGTH])
        yield np.array(keys, np.int64), data, np.array(places, np.int64)


def _contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for keys, data, places in _open_bytes(frames, "open"):
        grams = [xxhash.xxh3_64_intdigest(d[o:o + GRAM]) - (1 << 63) for d, o in zip(data, (places & 255).tolist(), strict=True)]
        yield pd.DataFrame({"gram": grams, "row_key": keys, "place": places, "data": data})


def _resolved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeated suffixes of stretches that come sorted by gram; groups are kept whole across batches."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame["gram"].iloc[-1] if len(frame) else None
        rest = frame[frame["gram"] == last]
        yield _repeated(frame[frame["gram"] != last])
    if rest is not None:
        yield _repeated(rest)


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    """Places of the runs of suffixes that occur twice or more among stretches with equal grams."""
    roll, out = Rolling(0), []
    place = frame["place"].to_numpy(np.int64)
    if len(frame):
        more = place >> 8 & 255
        block = _block(list(frame["data"]), more + LENGTH)
        sums = roll.sums(block)
        keys = mixed((sums[:, LENGTH:LENGTH + SPAN] - sums[:, :SPAN]) * roll.inverse[:SPAN])
        keys = mixed(keys ^ frame["gram"].to_numpy(np.int64).view(np.uint64)[:, None] * np.uint64(_ODD[1]))
        inside = np.arange(SPAN)[None, :] <= more[:, None]
        values, index, count = np.unique(keys[inside], return_inverse=True, return_counts=True)
        twice = np.zeros((len(frame), SPAN + 2), np.int8)
        twice[:, 1:-1][inside] = (count > 1)[index]
        row, start = np.nonzero(np.diff(twice, axis=1) == 1)
        _, stop = np.nonzero(np.diff(twice, axis=1) == -1)
        out = ((place[row] >> 16) + start) << 16 | (stop - start - 1) << 8
        return pd.DataFrame({"row_key": frame["row_key"].to_numpy()[row], "place": out})
    return pd.DataFrame({"row_key": np.zeros(0, np.int64), "place": np.zeros(0, np.int64)})


def _last_digits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """128 bits and place of each suffix of the stretches of large groups."""
    lanes = Rolling(0), Rolling(1)
    for keys, data, places in _open_bytes(frames, "wide"):
        for some in np.array_split(np.arange(len(keys)), len(keys) // 2000 + 1):
            first, more = places[some] >> 16, places[some] >> 8 & 255
            block = _block([data[k] for k in some], more + LENGTH)
            inside = np.arange(SPAN)[None, :] <= more[:, None]
            found = []
            for roll in lanes:
                sums = roll.sums(block)
                found.append(mixed((sums[:, LENGTH:LENGTH + SPAN] - sums[:, :SPAN]) * roll.inverse[:SPAN])[inside].view(np.int64))
            yield pd.DataFrame({
                "a": found[0], "b": found[1], "row_key": np.broadcast_to(keys[some][:, None], inside.shape)[inside],
                "place": (first[:, None] + np.arange(SPAN))[inside] << 16})


def _removed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for text, some in frame[["text", "places"]].itertuples(index=False):
            data = np.frombuffer((text or "").encode(), np.uint8)
            places = np.asarray(some if some is not None else [], np.int64)
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, places >> 16, 1)
            np.add.at(edge, (places >> 16) + (places >> 8 & 255) + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            out.append((len(data), [{"start": int(s), "stop": int(e)} for s, e in turn.reshape(-1, 2)], data[~gone].tobytes()))
        yield pd.concat([frame[["id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])], axis=1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans (removed byte ranges, in order) and kept (the remaining bytes) of every document."""
    ship(docs.sparkSession)
    rows = rename(docs, id=id_col, text=text_col).withColumn("row_key", F.xxhash64("id", "text"))
    first = rows.select("row_key", "text").mapInPandas(_first_digits, "gram bigint, whole bigint, row_key bigint, place bigint")
    # counts first, then joins on them: no window over a gram that a third of all rows may share
    grams = first.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    shared = cut(first.join(grams, "gram", "left_semi"))
    by_whole = cut(shared.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "place")).alias("first")))
    settled = shared.join(by_whole.filter("n > 1"), ["gram", "whole"], "left_semi").select("row_key", F.lit("settled").alias("kind"), "place")
    unsettled = by_whole.groupBy("gram").agg(F.count("*").alias("kinds"), F.count_if(F.expr("n = 1")).alias("alone")).filter("alone > 0")
    open_ = by_whole.join(unsettled, "gram").select(
        "first.row_key", F.when(F.col("kinds") <= GROUP, "open").otherwise("wide").alias("kind"), "first.place")
    kinds = ("settled", "open", "wide")
    marks = cut(settled.union(open_).groupBy("row_key").agg(*[
        F.collect_set(F.when(F.col("kind") == k, F.col("place"))).alias(k) for k in kinds]))

    def asked(column: str) -> DataFrame:
        mine = marks.filter(F.size(column) > 0).select("row_key", column)
        return narrowed(rows.select("row_key", "text"), mine, "row_key").join(mine, "row_key").select("row_key", "text", column)

    by_gram = asked("open").mapInPandas(_contexts, "gram bigint, row_key bigint, place bigint, data binary") \
        .repartition("gram").sortWithinPartitions("gram")
    found = by_gram.mapInPandas(_resolved, "row_key bigint, place bigint")
    each = asked("wide").mapInPandas(_last_digits, "a bigint, b bigint, row_key bigint, place bigint")
    several = each.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    found = found.union(each.join(several, ["a", "b"], "left_semi").select("row_key", "place"))
    settled = marks.filter("size(settled) > 0").select("row_key", F.explode("settled").alias("place"))
    places = cut(settled.union(found).groupBy("row_key").agg(F.collect_set("place").alias("places")))

    touched = narrowed(rows, places, "row_key").join(places, "row_key").select("id", "text", "places")
    others = without(rows, places, "row_key").select("id", "text", F.lit(None).cast("array<bigint>").alias("places"))
    id_type = rows.schema["id"].dataType.simpleString()
    made = touched.union(others).mapInPandas(
        _removed, f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")
    return made.withColumnRenamed("id", id_col)


def digests(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return removed.select(
        id_col, "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
