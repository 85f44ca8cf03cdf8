"""Token counts by byte-pair merging: initial symbols less the merges, without ids.

A text's symbols are its characters. They lie in a linked list of places (a symbol ends where the next one starts), and a heap holds
the adjacent pairs that the vocabulary knows, by rank and then from the left. The best pair is popped and merged
until none is left; entries whose symbols have been merged since are skipped. Every merge makes one symbol less, so the
count is a subtraction. A character that is no piece and was never merged counts one for each of its bytes (byte fallback).

No merge crosses a place where no piece holds the two neighbouring characters side by side. If that is true of every character
before a space mark, texts are cut there and the counts of short parts are kept, up to CACHE_BYTES in a worker; otherwise a
text is one part. Counts do not depend on what is kept.

Defined cases: null and empty texts have no tokens; texts of any length are counted whole; equal rows and tied or null keys
give a row each; an empty table gives no rows; other columns are ignored. Strings of special pieces in a text are ordinary text, as in the library.
A vocabulary that normalises texts, has user-defined or unused pieces or lacks byte fallback is refused when it is loaded.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

SPACE = "▁"
#: Memory for the counts of parts in a worker, and the longest part whose count is kept.
CACHE_BYTES, KEPT_CHARS = 96 << 20, 64
#: What an entry of the cache takes besides its characters.
_ENTRY = 120
#: Texts that a vocabulary with a normaliser of its own would change.
_PROBES = ["a", " a  b ", "\t\n", "Ａﬁ①é", "</s> <s>", "▁x▁", "x" * 40 + "  ", "日本 é́"]
_LOADED: dict[str, Merges] = {}


class Merges(dict):
    """Ranks of the merged pieces of a model; as a dictionary, the counts of parts."""

    def __init__(self, model: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        if any(map(lib.is_unused, range(n))):
            raise ValueError("vocabularies with unused pieces are not supported")
        if not any(map(lib.is_byte, range(n))):
            raise ValueError("only vocabularies with byte fallback are supported")
        scores = {lib.id_to_piece(i): -lib.get_score(i) for i in range(n) if not (lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i))}
        order = {score: k for k, score in enumerate(sorted(set(scores.values())))}
        self.rank = {piece: order[score] for piece, score in scores.items()}
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scores)
        self.held = 0
        if any(self.count(probe) != len(lib.encode(probe)) for probe in _PROBES):
            raise ValueError("this vocabulary normalises texts or does not merge by score")

    def merged(self, part: str) -> int:
        """Symbols of a part after all merges."""
        n, rank, push, pop = len(part), self.rank.get, heapq.heappush, heapq.heappop
        stop = list(range(1, n + 1))  # where the symbol at a place ends; 0 inside a symbol
        start = list(range(-1, n))  # where the symbol that ends at a place starts
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(part[i:i + 2])) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            best = pop(heap)
            i = best & 0xFFFFFFFF
            j = stop[i]
            if not j or j == n or rank(part[i:(k := stop[j])]) != best >> 32:
                continue
            merges += 1
            stop[i], stop[j], start[k] = k, 0, i
            if k < n and (r := rank(part[i:stop[k]])) is not None:
                push(heap, r << 32 | i)
            if i and (r := rank(part[start[i]:k])) is not None:
                push(heap, r << 32 | start[i])
        alone = (c for i, c in enumerate(part) if stop[i] == i + 1 and rank(c) is None)
        return n - merges + sum(len(c.encode()) - 1 for c in alone)

    def __missing__(self, part: str) -> int:
        """Count of a part that is named without its first mark."""
        found = self.merged(SPACE + part)
        if len(part) <= KEPT_CHARS:
            self.held += _ENTRY + 4 * len(part)
            if self.held > CACHE_BYTES:
                self.clear()
                self.held = _ENTRY + 4 * len(part)
            self[part] = found
        return found

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuts:
            return self.merged(SPACE + text.replace(" ", SPACE))
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            parts = [p[1:] for p in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))]
        else:
            parts = text.split(" ")
        return sum(map(self.__getitem__, parts))


def loaded(model: bytes) -> Merges:
    key = hashlib.sha256(model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Merges(model)
    return _LOADED[key]


def count_tokens(df: DataFrame, model: bytes, text: str = "text", keys: tuple[str, ...] = ("doc_id",), limit: int = 4096) -> DataFrame:
    """``keys``, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each whole text.

    ``model`` holds the bytes of a model file (half a megabyte here); they travel with the task.
    """
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    kept = df.select(*keys, df[text].alias("__text"))
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = loaded(held.value)
        for batch in batches:
            sizes, counts = [], []
            for value in batch.column(n_keys):
                string = value.as_py()
                sizes.append(len(string.encode()) if string else 0)
                counts.append(merges.count(string))
            made = [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], *made], [*keys, "n_bytes", "n_tokens", "over_limit"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:n_keys]]
    return kept.mapInArrow(run, ", ".join([*fields, "n_bytes bigint, n_tokens bigint, over_limit boolean"]))
