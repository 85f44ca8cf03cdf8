"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words, as TF-IDF vectors over BUCKETS hashed words; document frequencies come from all documents. A
randomised SVD finds their latent space in one pass: the sketch ``Y = A'A S`` with a thin random ``S`` is summed over tasks, and by Nyström's
formula ``A'A ~ Y (S'Y)^-1 Y'``, whose eigenvectors follow from a thin factorisation. It is fitted on the windows of all documents and of the whole benchmark.

A window is a candidate for an item if its cosine with one of the item's windows reaches COSINE. Item windows start at every
word and document windows at every STRIDE-th, so a copied passage always holds a pair of windows that are equal. For each candidate's place
the longest common subsequence of words with the item must reach LCS of its length, and the answer
(the item's last sentence, or its last quarter if it is one sentence) must reach ANSWER of its own.

A bound that LCS implies comes first: a subsequence holds no more words than the item has words that occur anywhere in the text.
Texts are taken in chunks that hold every region of the exact check whole, and the words of an item that occur in a chunk are
counted for all chunks and items by products of blocks. Only windows of a chunk with LCS of the item's words or more are
compared with the item, so the bound loses no place that the exact check would accept. Before the product stands a bound on rare words: without
its most frequent words, as many as fall short of LCS by one, an item needs a certain number of the others in a chunk, which are counted one by one.

The benchmark is a stated query set: it is searched in blocks of ITEMS items, each of which is sent to the tasks; every block is one more scan of
the documents. All blocks share one latent space, so what is found for an item does not depend on its block.

Defined cases: null and empty texts and items match nothing; words are compared without case (A-Z) and punctuation; equal
rows and equal items give a row each; texts are whole at any length; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .bucket_counts import bucket_counts
from .common import rename, ship, taken, without
from .hashing import PLAIN, word_hashes

BUCKETS = 1 << 15
RANK, EXTRA = 48, 12
FIT_WORDS = 1 << 13  # words whose windows are summed at a time
WINDOW, STRIDE = 12, 4
COSINE, LCS, ANSWER = 0.7, 0.7, 0.6
CHUNK = 64  # words between the starts of chunks
ROUND = 8  # regions of the exact check start and end at multiples
LIGHT = 0.75  # of LCS: share of an item whose words are too frequent to tell chunks apart
ITEMS = 2000
SLICES = 64  # of the summed sketch


def buckets_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    for hashes in word_hashes(texts, PLAIN):
        yield (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _distinct_buckets(texts: list[str | None]) -> Iterator[np.ndarray]:
    for found in buckets_of(texts):
        yield np.unique(found)


def window_starts(n: int, width: int, stride: int) -> np.ndarray:
    """Starts of the windows of a text of n words; the last window ends with it, a short text is one window."""
    if n <= width:
        return np.zeros(1 if n else 0, np.int64)
    return np.append(np.arange(0, n - width, stride), n - width)


def _parts(buckets: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text whose windows are together the windows of the text, each once."""
    starts = window_starts(len(buckets), WINDOW, STRIDE)
    some = FIT_WORDS // STRIDE
    for k in range(0, len(starts) - 1, some):
        yield buckets[starts[k]:starts[min(k + some, len(starts) - 1) - 1] + WINDOW]
    yield buckets[starts[-1]:]


def _group_sums(rows: np.ndarray, source: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of groups of rows, whose numbers stand together in ``source``; the last row is zero and fills groups up to a power of two. Neighbours are added in rounds."""
    start, rounds = np.cumsum(counts) - counts, np.frexp(counts - 1)[1]
    out = np.zeros((len(counts), rows.shape[1]), rows.dtype)
    for k in np.unique(rounds).tolist():
        at = np.flatnonzero(rounds == k)
        place = np.arange(1 << k)
        inside = place < counts[at, None]
        x = rows.take(np.where(inside, source[np.where(inside, start[at, None] + place, 0)], len(rows) - 1).ravel(), axis=0)
        for _ in range(k):
            x = x[::2] + x[1::2]
        out[at] = x
    return out


def gram_product(texts: list[str | None], padded: np.ndarray, total: np.ndarray) -> None:
    """Add ``A' A thin`` of the passages of some texts, less the factor idf of each row, to ``total``; ``padded`` is idf times thin and a row of zeros."""
    waiting: list[np.ndarray] = []
    held = 0

    def add() -> None:
        # words in blocks of STRIDE: a window is WINDOW / STRIDE blocks in a row, but for the last one of a text, which ends with it
        sizes = np.array([len(x) for x in waiting])
        blocks = -(-sizes // STRIDE)
        first = np.concatenate([[0], np.cumsum(blocks)])
        t = np.full(first[-1] * STRIDE, BUCKETS)  # the rest of a text's last block is a word without weight
        at = np.arange(sizes.sum()) + np.repeat(first[:-1] * STRIDE - np.cumsum(sizes) + sizes, sizes)
        t[at] = np.concatenate(waiting)
        sums = padded.take(t[::STRIDE], axis=0)
        for k in range(1, STRIDE):
            sums += padded.take(t[k::STRIDE], axis=0)
        whole = np.maximum(-(-(sizes - WINDOW) // STRIDE), 0)
        begin = np.arange(whole.sum()) + np.repeat(first[:-1] - np.cumsum(whole) + whole, whole)
        passages = sums.take(begin, axis=0)
        for k in range(1, WINDOW // STRIDE):
            passages += sums.take(begin + k, axis=0)
        covering = np.zeros_like(sums)
        for k in range(WINDOW // STRIDE):
            covering[begin + k] += passages
        last = np.maximum(sizes - WINDOW, 0) + first[:-1] * STRIDE
        words = last[:, None] + np.minimum(np.arange(WINDOW), (np.minimum(sizes, WINDOW) - 1)[:, None])
        inside = np.arange(WINDOW) < sizes[:, None]
        ends = padded.take(np.where(inside, t[words], BUCKETS), axis=0).sum(axis=1)
        # what each word gets: the windows around its block, and the last window of its text if it stands there
        bucket = np.concatenate([t[at], t[words[inside]]])
        source = np.concatenate([at // STRIDE, len(covering) + np.nonzero(inside)[0]])
        often = np.bincount(bucket, minlength=BUCKETS)
        names = np.flatnonzero(often)
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        total[names] += _group_sums(np.vstack([covering, ends, np.zeros_like(ends[:1])]), source[order], often[names])
        waiting.clear()

    for x in buckets_of(texts):
        n = len(x)
        for part in _parts(x) if n > FIT_WORDS else [x] if n else []:
            waiting.append(part)
            held += len(part)
            if held >= FIT_WORDS:
                add()
                held = 0
    if waiting:
        add()


def latent_space(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Scaled right singular vectors (BUCKETS x RANK) of the passages of all texts."""
    spark = texts.sparkSession
    shape = BUCKETS, RANK + EXTRA
    sketch = np.random.default_rng(3).standard_normal(shape)
    held = spark.sparkContext.broadcast(np.vstack([idf[:, None] * sketch, np.zeros((1, shape[1]))]).astype(np.float32))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in taken(frames):
            gram_product(list(frame["text"]), held.value, total)
        if total.any():
            yield pd.DataFrame({"slice": np.arange(SLICES), "part": [x.astype(np.float32).tobytes() for x in np.split(total, SLICES)]})

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for frame in taken(frames):
            for k, part in frame.itertuples(index=False):
                totals[k] = totals.get(k, 0) + np.frombuffer(part, np.float32).astype(np.float64)
        if totals:
            yield pd.DataFrame({"slice": list(totals), "part": [x.astype(np.float32).tobytes() for x in totals.values()]})

    # a task sends an array of a fixed size in slices; each slice is summed by itself, so the sums spread over tasks
    sums = texts.mapInPandas(run, "slice int, part binary").repartition(SLICES, "slice").mapInPandas(summed, "slice int, part binary")
    found = {r["slice"]: np.frombuffer(bytes(r["part"]), np.float32) for r in sums.collect()}
    held.unpersist()
    nothing = np.zeros(shape[0] // SLICES * shape[1], np.float32)
    y = idf[:, None] * np.concatenate([found.get(k, nothing) for k in range(SLICES)]).reshape(shape)
    if not y.any():
        return np.zeros((BUCKETS, RANK))
    # a small shift keeps the inner matrix positive definite in single precision; it is taken off the eigenvalues again
    shift = 1e-6 * np.linalg.norm(y)
    y = y + shift * sketch
    inner = sketch.T @ y
    weights, axes = np.linalg.eigh((inner + inner.T) / 2)
    held_axes = weights > 1e-10 * weights[-1]
    vectors, singular, _ = np.linalg.svd(y @ axes[:, held_axes] / np.sqrt(weights[held_axes]), full_matrices=False)
    values = np.maximum(singular ** 2 - shift, 0)
    # directions that many passages share count for less: each is scaled to unit variance
    return vectors[:, :RANK] / np.sqrt(np.maximum(values[:RANK], 1e-9))


def answer_of(item: str) -> str:
    """The last sentence; the last quarter of the words if there is one sentence only."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", item.strip()) if re.search(r"\w", s)]
    if len(sentences) > 1:
        return sentences[-1]
    words = item.split()
    return " ".join(words[-max(1, len(words) // 4):])


def lcs_length(masks: dict[int, int], n: int, words: np.ndarray) -> int:
    """Longest common subsequence with a sequence of n words, given as bit masks of their places."""
    full = (1 << n) - 1
    row = full
    for w in words:
        if m := masks.get(w):
            hit = row & m
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Searcher:
    """The windows of a block of items in the latent space, and what the exact checks need."""

    def __init__(self, items: list[tuple[int, str]], idf: np.ndarray, space: np.ndarray):
        self.ids = [i for i, _ in items]
        texts = [t for _, t in items]
        self.words = [h.tolist() for h in word_hashes(texts, PLAIN)]
        self.answers = [h.tolist() for h in word_hashes([answer_of(t) for t in texts], PLAIN)]
        self.masks = [masks_of(w) for w in self.words]
        self.answer_masks = [masks_of(w) for w in self.answers]
        buckets = list(buckets_of(texts))
        sizes = np.array([len(b) for b in buckets], np.int64)
        self.reach = int((sizes + 2 * (sizes // 4 + 2)).max(initial=1)) + 2 * ROUND  # no region of the exact check is longer
        self.needed = np.where(sizes > 0, np.ceil(LCS * sizes - 1e-9), np.inf).astype(np.float32)
        known = np.unique(np.concatenate([*buckets, np.zeros(0, np.int64)]))
        self.column = np.full(BUCKETS, len(known))
        self.column[known] = np.arange(len(known))
        self.counts = np.zeros((len(known), len(items)), np.float32)
        for k, b in enumerate(buckets):
            np.add.at(self.counts[:, k], self.column[b], 1)
        # the most frequent words of an item, less than LCS of it, are not enough: of the others a chunk holds ``rest`` or more
        postings, self.rest = [np.zeros((3, 0))], np.full(len(items), np.inf)
        for k, b in enumerate(buckets):
            cells, times = np.unique(b, return_counts=True)
            order = np.argsort(idf[cells], kind="stable")
            light = np.cumsum(times[order]) <= LIGHT * self.needed[k]
            if len(cells):
                self.rest[k] = self.needed[k] - times[order][light].sum()
                rare = order[~light]
                postings.append(np.array([self.column[cells[rare]], np.full(len(rare), k), times[rare]]))
        column, self.holder, self.times = np.concatenate(postings, axis=1)[:, np.argsort(np.concatenate(postings, axis=1)[0], kind="stable")]
        self.holder = self.holder.astype(np.int64)
        self.first = np.searchsorted(column, np.arange(len(known) + 2))
        self.space = np.vstack([idf[:, None] * space, np.zeros((1, space.shape[1]))]).astype(np.float32)
        self.shapes = []
        for b in buckets:
            n = len(b)
            width = WINDOW if n >= WINDOW + STRIDE - 1 else max(1, (n + 1) // 2)
            tokens = np.array([b[s:s + width] for s in range(n - width + 1)]) if n else np.zeros((0, 1), np.int64)
            self.shapes.append((width, min(STRIDE, n - width + 1), self.unit(tokens).T.copy()))

    def unit(self, tokens: np.ndarray) -> np.ndarray:
        x = self.space[tokens].sum(axis=1)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def search(self, texts: list[str | None]) -> list[tuple]:
        """(text, item id, first word, words, cosine, common share, answer share) of what is found; the best place of each pair."""
        words = list(word_hashes(texts, PLAIN))
        best: dict[tuple[int, int], tuple] = {}
        for (k, j), chunks in self.possible(words).items():
            width, stride, matrix = self.shapes[j]
            tokens = np.append((words[k] & np.uint64(BUCKETS - 1)).astype(np.int64), [BUCKETS] * width)
            start = window_starts(len(words[k]), width, stride)
            inside = np.zeros(len(start), bool)
            for first in chunks:
                inside |= (start >= first) & (start < first + CHUNK + self.reach)
            start = start[inside]
            tried: list[tuple[int, int]] = []  # regions that failed
            for some in range(0, len(start), 1024):
                s = start[some:some + 1024]
                cosines = self.unit(tokens[s[:, None] + np.arange(width)]) @ matrix
                rows, offsets = np.nonzero(cosines >= COSINE)
                for row, offset in zip(rows.tolist(), offsets.tolist(), strict=True):
                    place = int(s[row]) - offset
                    first, last = self.region(len(words[k]), j, place)
                    if any(a <= first and last <= b for a, b in tried[-16:]):
                        continue
                    found = self.check(words[k], j, first, last)
                    if not found:
                        tried.append((first, last))
                    elif found[2] > best.get((k, j), (0, 0, 0, 0, 0))[2]:
                        best[k, j] = (*found[:2], found[2], found[3], float(cosines[row, offset]))
        return [(k, self.ids[j], f[0], f[1], f[4], f[2], f[3]) for (k, j), f in best.items()]

    def possible(self, words: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
        """First words of the chunks of each text that hold LCS of an item's words or more, by (text, item)."""
        owner, first, cells = [], [], []
        out: dict[tuple[int, int], list[int]] = {}

        def close() -> None:
            some = self.hopeful(cells)
            present = np.zeros((len(some), len(self.counts) + 1), np.float32)
            for row, k in enumerate(some):
                present[row, cells[k]] = 1
            rows, found = np.nonzero(present[:, :-1] @ self.counts >= self.needed)
            for row, j in zip(some[rows].tolist(), found.tolist(), strict=True):
                out.setdefault((owner[row], j), []).append(first[row])
            for x in owner, first, cells:
                x.clear()

        for k, hashes in enumerate(words):
            columns = self.column[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)]
            for start in range(0, max(len(hashes) - self.reach, min(len(hashes), 1)), CHUNK):
                owner.append(k)
                first.append(start)
                cells.append(columns[start:start + CHUNK + self.reach])
                if len(cells) == 1024:
                    close()
        close()
        return out

    def hopeful(self, cells: list[np.ndarray]) -> np.ndarray:
        """The chunks that hold enough of an item's rarer words; a word that a chunk repeats counts each time."""
        flat = np.concatenate([*cells, np.zeros(0, np.int64)])
        many = self.first[flat + 1] - self.first[flat]
        held = np.flatnonzero(many)
        many = many[held]
        size = len(cells) * len(self.rest)
        if many.sum() > 2 * size:  # no words are rare enough
            return np.arange(len(cells))
        chunk = np.repeat(np.arange(len(cells)), [len(c) for c in cells])[held]
        at = np.arange(many.sum()) + np.repeat(self.first[flat[held]] - np.cumsum(many) + many, many)
        hits = np.bincount(np.repeat(chunk, many) * len(self.rest) + self.holder[at], self.times[at], size)
        return np.flatnonzero((hits.reshape(len(cells), len(self.rest)) >= self.rest).any(axis=1))  # also of no chunks

    def region(self, n_words: int, j: int, place: int) -> tuple[int, int]:
        """The words that the exact check of an item at a place takes; slack on both sides is rounded out, so near places share it."""
        n = len(self.words[j])
        slack = n // 4 + 2
        return max(0, (place - slack) // ROUND * ROUND), min(n_words, -(-(place + n + slack) // ROUND) * ROUND)

    def check(self, words: np.ndarray, j: int, first: int, last: int) -> tuple | None:
        n = len(self.words[j])
        region = words[first:last].tolist()
        share = lcs_length(self.masks[j], n, region) / n
        if share < LCS:
            return None
        m = len(self.answers[j])
        answer = lcs_length(self.answer_masks[j], m, region) / m if m else 1.0
        return (first, len(region), share, answer) if answer >= ANSWER else None


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document and item whose passage it holds: place, cosine and shares; ``row_key`` tells equal ids apart."""
    spark = docs.sparkSession
    ship(spark)
    rows = rename(docs, id=id_col, text=text_col).withColumn("row_key", F.xxhash64("id", "text"))
    items = rename(benchmark, item=item_col, text=item_text_col).filter("text is not null")
    id_type, item_type = rows.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    schema = f"id {id_type}, row_key bigint, item {item_type}, first_word bigint, n_words bigint, cosine double, lcs double, answer double"
    df, n_rows = bucket_counts(rows, BUCKETS, _distinct_buckets, count_rows=True)
    idf = np.log((n_rows + 1) / (df + 1))
    blocks = -(-items.count() // ITEMS)
    space = latent_space(rows.select("text").union(items.select("text")), idf).astype(np.float32) if blocks else None
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        mine = [(r["item"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()]
        if mine:
            held = spark.sparkContext.broadcast((mine, idf, space))
            found = found.union(rows.mapInPandas(_search(held), schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def _search(held):  # noqa: ANN001, ANN202
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searcher = Searcher(*held.value)
        for frame in taken(frames):
            ids, keys = frame["id"].to_numpy(), frame["row_key"].to_numpy()
            for start in range(0, len(frame), 1000):
                out = searcher.search(list(frame["text"].iloc[start:start + 1000]))
                if out:
                    yield pd.DataFrame(
                        [(ids[start + k], keys[start + k], *rest) for k, *rest in out],
                        columns=["id", "row_key", "item", "first_word", "n_words", "cosine", "lcs", "answer"])

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, unchanged."""
    found = leaks(docs, benchmark, id_col, text_col).select("row_key")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.xxhash64(docs[id_col], docs[text_col]).alias("row_key"))
    return without(keyed, found, "row_key").select("row.*")
