"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by score (ties: the leftmost) and
merges the best pair until none is left. A text falls apart where no vocabulary entry holds
the two neighbouring characters side by side: no merge can cross such a place, so the parts
are encoded apart and repeated parts come from a bounded cache. The ids of each part are decoded once, by joining their pieces;
runs of byte pieces become characters. Every part that is encoded anew, and one whole text of each Arrow batch, is
compared with the sentencepiece library in both directions; a difference is an error, not a row that goes on.
A vocabulary with a space mark behind another character in a piece is refused, since merges could cross spaces there.

Null and empty texts have no pieces (only the end id, if wanted). Texts of any length are
taken whole. Repeated rows and ties in ``doc_id`` give one row each; an empty table gives no rows. Only the keys and the text are
read, so other columns cannot clash with the outputs unless a key has an output's name, which is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import CACHES, ship, taken

SPACE = "▁"
#: Parts kept by a worker (about 250 bytes each, and none longer than KEPT_CHARS); beyond it the cache starts anew. Results do not depend on it.
CACHE_PARTS, KEPT_CHARS = 1_500_000, 100
_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_MARKS = ".,;:!?#*$%&|)\"'"
_CODECS: dict[str, Codec] = {}
CACHES["sentencepiece"] = _CODECS.clear

TYPES = {
    "ids": "array<int>", "decoded": "string", "n_tokens": "bigint",
    "ids_sha256": "string", "decoded_sha256": "string",
}
ARROW = {
    "ids": pa.list_(pa.int32()), "decoded": pa.string(), "n_tokens": pa.int64(),
    "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
}


class Codec:
    """Vocabulary of a model file and the two directions."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        if any(map(lib.is_unused, range(n))):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(n) if lib.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        if len(self.id_of_byte) != 256:
            raise ValueError("only vocabularies with byte fallback are supported")
        plain = [i for i in range(n) if i not in self.silent and i not in self.byte_of and i != lib.unk_id()]
        self.ids = {self.pieces[i]: i for i in plain}
        order = {v: k for k, v in enumerate(sorted({-lib.get_score(i) for i in plain}))}
        self.rank = {self.pieces[i]: order[-lib.get_score(i)] for i in plain}
        self.neighbours = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        if any(pair[1] == SPACE != pair[0] for pair in self.neighbours):
            raise ValueError("pieces that go on behind a space are not supported")
        self.piece_of = {str(i): "" if i in self.silent else self.pieces[i] for i in range(n)}  # by decimal id
        self.byte_decimals = set(map(str, self.byte_of))
        self.decimal: dict[str, str] = {}  # ids of a part, as decimals
        self.runs: dict[str, str] = {}  # the same of what parts fall into
        self.spelled: dict[str, str] = {}  # decoded texts of those parts whose ids do not decode to the part itself

    def merged(self, part: str) -> list[str]:
        """Pieces of a part: the best-scored adjacent pair is merged first, then the next."""
        symbols: list[str | None] = list(part)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        rank, push, pop = self.rank.get, heapq.heappush, heapq.heappop
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank(part[i:i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            best = pop(agenda)
            i = best & 0xFFFFFFFF
            if (a := symbols[i]) is None or (j := right[i]) >= n or rank(pair := a + symbols[j]) != best >> 32:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank(pair + symbols[k])) is not None:
                    push(agenda, r << 32 | i)
            if (h := left[i]) >= 0 and (r := rank(symbols[h] + pair)) is not None:
                push(agenda, r << 32 | h)
        return [s for s in symbols if s is not None]

    def run_decimal(self, run: str) -> str:
        if (found := self.runs.get(run)) is None:
            ids: list[int] = []
            for piece in self.merged(run):
                if (i := self.ids.get(piece)) is not None:
                    ids.append(i)
                else:
                    ids += [self.id_of_byte[b] for b in piece.encode()]
            found = " ".join(map(str, ids))
            if len(run) <= KEPT_CHARS:
                self.runs[run] = found
        return found

    def part_decimal(self, key: str) -> str:
        """Ids of a part, which is named without its first mark. Its last marks are a run of their own if no piece crosses there."""
        part = SPACE + key
        core = part.rstrip(_MARKS)
        if core != part and part[len(core) - 1:len(core) + 1] not in self.neighbours:
            found = self.run_decimal(core) + " " + self.run_decimal(part[len(core):])
        else:
            found = self.run_decimal(part)
        if (text := self.text_of_decimal(found)) != part.replace(SPACE, " "):
            self.spelled[key] = text
        return found

    def text_of(self, ids: list[int]) -> str:
        """Text of ids, the mark of the first word included."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            if i not in self.silent:
                out.append(self.pieces[i])
        if run:
            out.append(_utf8(run))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self.text_of(ids).removeprefix(" ")

    def text_of_decimal(self, decimal: str) -> str:
        """``text_of`` of ids that are given as decimals."""
        ids = decimal.split()
        if not self.byte_decimals.isdisjoint(ids):
            return self.text_of(list(map(int, ids)))
        return "".join(map(self.piece_of.__getitem__, ids)).replace(SPACE, " ")

    def decoded(self, decimal: str) -> str:
        return self.text_of_decimal(decimal).removeprefix(" ")

    def joined(self, parts: list[str]) -> str:
        """The decoded text of parts, each as its ids were decoded."""
        if not self.spelled or self.spelled.keys().isdisjoint(parts):
            return " ".join(parts).replace(SPACE, " ")
        return "".join([self.spelled.get(p) or " " + p.replace(SPACE, " ") for p in parts]).removeprefix(" ")

    def parts(self, text: str | None) -> list[str]:
        """The parts between spaces, each without its first mark."""
        if not text:
            return []
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return [p[1:] for p in _PARTS.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def compare(self, fresh: dict[str, str]) -> None:
        """The library must agree on the ids of texts, and on what these decode to."""
        texts = list(filter(None, fresh))  # a lone mark has no pairs
        theirs = self.library.encode(texts, num_threads=1)
        back = self.library.decode(theirs, num_threads=1)
        for text, ids, decoded in zip(texts, theirs, back, strict=True):
            if fresh[text] != " ".join(map(str, ids)) or self.decoded(fresh[text]) != decoded:
                raise ValueError(f"the library encodes or decodes {text[:200]!r} differently")

    def forget(self) -> None:
        if len(self.decimal) + len(self.runs) > CACHE_PARTS or len(self.spelled) > CACHE_PARTS // 100:
            for held in (self.decimal, self.runs, self.spelled):
                held.clear()


def _utf8(run: bytearray) -> str:
    """Bytes as text; each byte that is not valid UTF-8 becomes one replacement mark."""
    try:
        return run.decode()
    except UnicodeDecodeError as e:
        return run[:e.start].decode() + "�" + _utf8(run[e.start + 1:])


def codec(model: bytes) -> Codec:
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_batch(c: Codec, texts: list[str | None], outputs: list[str], begin: list[int], end: list[int]) -> list[pa.Array]:
    c.forget()
    columns: list[list] = [[] for _ in outputs]
    fresh: dict[str, str] = {}
    edges = [" ".join(map(str, x)) for x in (begin, end)]
    whole = None
    for text in texts:
        parts = c.parts(text)
        found = list(map(c.decimal.get, parts))
        if None in found:
            for k, part in enumerate(parts):
                if found[k] is None and (known := c.decimal.get(part) or fresh.get(part)) is None:
                    known = fresh[part] = c.part_decimal(part)
                    if len(part) <= KEPT_CHARS:
                        c.decimal[part] = known
                if found[k] is None:
                    found[k] = known
        inner = " ".join(found)
        if text and whole is None:
            whole = text, inner
        decimal = " ".join(edges[:1] * bool(begin) + [inner] * bool(found) + edges[1:] * bool(end))
        decoded = c.joined(parts) if "decoded" in outputs or "decoded_sha256" in outputs else ""
        for out, column in zip(outputs, columns, strict=True):
            if out == "ids":
                column.append(list(map(int, decimal.split())))
            elif out == "decoded":
                column.append(decoded)
            elif out == "n_tokens":
                column.append(decimal.count(" ") + 1 if decimal else 0)
            else:
                column.append(_sha(decimal if out == "ids_sha256" else decoded))
    c.compare(fresh)
    if whole:
        c.compare(dict([whole]))
    return [pa.array(v, ARROW[o]) for o, v in zip(outputs, columns, strict=True)]


def encode(df: DataFrame, model: bytes, text: str = "text", keys: tuple[str, ...] = ("doc_id",), outputs: tuple[str, ...] = ("ids", "decoded"), bos: bool = False, eos: bool = True) -> DataFrame:
    """``keys`` and, of each whole text, what ``outputs`` names: ids, decoded, n_tokens, ids_sha256, decoded_sha256.

    ``model`` holds the bytes of a model file (half a megabyte here); they travel with the task.
    """
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    outputs = list(outputs)
    kept = df.select(*keys, df[text].alias("__text"))
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(held.value)
        begin = [c.library.bos_id()] if bos else []
        end = [c.library.eos_id()] if eos else []
        for batch in taken(batches, "sentencepiece"):
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                columns = encode_batch(c, part.column(n_keys).to_pylist(), outputs, begin, end)
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keys], *columns], [*keys, *outputs])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:n_keys]]
    return kept.mapInArrow(run, ", ".join([*fields, *[f"{o} {TYPES[o]}" for o in outputs]]))


def decode(df: DataFrame, model: bytes, ids: str = "ids", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``decoded``: the text of an array of ids (null: empty)."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    kept = df.select(*keys, df[ids].alias("__ids"))
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(held.value)
        for batch in taken(batches, "sentencepiece"):
            texts = [c.decode(x or []) for x in batch.column(n_keys).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], pa.array(texts, pa.string())], [*keys, "decoded"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:n_keys]]
    return kept.mapInArrow(run, ", ".join([*fields, "decoded string"]))
