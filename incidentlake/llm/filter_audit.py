"""Interaction of five filters: what each one removes in every order, from the survivors of all subsets.

Each document becomes a 32-bit word: bit ``S`` is set if the document fails none of the filters in the subset ``S`` (bit k of
``S`` is filter k). How many documents of a part survive each subset is the positional popcount of its words. Tasks hold
it in carry-save counters: plane ``k`` has bit ``k`` of all 32 sums in one word, and three words of a plane become one (their
exclusive or) and a carry for the next plane (their majority). Equal documents travel as one word with a count and enter at
the planes of the count's binary digits, so a text with a third of all rows is a single word. The 32 sums per part and label class
hold the whole answer: every order, step, redundancy and Shapley sum is a difference of them.

Only digests are shuffled, never texts. Filter E (the text also has a smaller id) takes the smallest id of a text's digest
(128 bits) after rows that are alike have been counted in their tasks, so no group is gathered.

Defined cases: null and empty texts are equal and have no words; a null part is the part ``''``; a null id is neither smaller than
another nor has smaller ones; equal rows count one each and do not fail E for each other; a document is good (toxic) if any of its
labels says so, labels that are null or name no document change nothing; an empty table has no parts, so no rows; texts
are whole at any length; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import rename, ship

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
#: Parts whose counters a task holds at a time; with more it sends what it has and starts anew.
HELD = 10_000
_COUNTS = pa.schema([("part", pa.string()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("survivors", pa.list_(pa.int64()))])


def failures(text: str) -> Column:
    """Bits 0 to 3: the conditions A to D on a text column without nulls."""
    words = rf"filter(split({text}, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
    return F.expr(f"""aggregate(array({words}), 0, (a, w) ->
        if(size(w) < {MIN_WORDS}, 1, 0)
        + if(100 * size(array_distinct(w)) < {MIN_DISTINCT} * size(w), 2, 0)
        + if(100L * regexp_count({text}, '[A-Z]') > {MAX_CAPITALS}L * length({text}), 4, 0)
        + if({text} rlike '[#$%&*|]', 8, 0))""")


def survival_words() -> list[int]:
    """For every set of failed filters, the word of the subsets that such a document survives."""
    return [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)]


class CarrySave:
    """Positional popcounts of 32-bit words, one word a plane."""

    def __init__(self) -> None:
        self.planes: list[np.uint32] = []

    def add(self, words: np.ndarray, counts: np.ndarray) -> None:
        """``words[i]`` is counted ``counts[i]`` times."""
        level, carried = 0, np.zeros(0, np.uint32)
        while len(carried) or (counts >> level).any():
            now = np.concatenate([carried, words[(counts >> level & 1).astype(bool)], self.planes[level:level + 1]]).astype(np.uint32)
            carried = np.zeros(0, np.uint32)
            while len(now) > 1:
                now = np.append(now, np.zeros(-len(now) % 3, np.uint32))
                a, b, c = now.reshape(3, -1)
                half = a ^ b
                majority = a & b | half & c
                carried = np.append(carried, majority[majority != 0])
                now = half ^ c
            self.planes[level:level + 1] = list(now) or [np.uint32(0)]
            level += 1

    def totals(self) -> list[int]:
        return [sum((int(plane) >> s & 1) << k for k, plane in enumerate(self.planes)) for s in range(SUBSETS)]


def subset_survivors(words: DataFrame) -> DataFrame:
    """part, good, toxic, survivors (by subset) from part, good, toxic, word, n."""
    ship(words.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, CarrySave] = {}

        def sent() -> pa.RecordBatch:
            rows = [dict(zip(_COUNTS.names, (*key, c.totals()), strict=True)) for key, c in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(rows, _COUNTS)

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            word, n = batch.column(3).to_numpy().astype(np.uint32), batch.column(4).to_numpy()
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(keys):
                places.setdefault(key, []).append(i)
            for key, at in places.items():
                held.setdefault(key, CarrySave()).add(word[at], n[at])
            if len(held) > HELD:
                yield sent()
        if held:
            yield sent()

    return words.select("part", "good", "toxic", "word", "n").mapInArrow(counted, "part string, good boolean, toxic boolean, survivors array<bigint>")


def _words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, word and how many documents are alike in these."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("text", text).select(
        "id", F.coalesce("part", F.lit("")).alias("part"), failures("text").alias("failed"),
        F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("digest"))
    alike = rows.groupBy("id", "part", "failed", "digest").agg(F.count("*").alias("n"))
    marks = labels.filter("id is not null").groupBy("id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    known = alike.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # of each text and class of labels: the smallest id with its rows, and all rows; ids that are null are kept apart
    classes = known.groupBy("digest", "part", "failed", "good", "toxic", F.col("id").isNull().alias("unnamed")).agg(
        F.min(F.struct("id", "n")).alias("first"), F.sum("n").alias("n"))
    lowest = classes.withColumn("lowest", F.expr("min(first.id) over (partition by digest)"))
    firsts = F.expr("if(unnamed, n, if(first.id = lowest, first.n, 0L))")
    several = lowest.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("failed"), firsts.alias("n")), F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - firsts).alias("n")))).alias("x"))
    table = F.array(*[F.lit(w) for w in survival_words()])
    return several.filter("x.n > 0").groupBy("part", "good", "toxic", F.element_at(table, F.col("x.failed") + 1).alias("word")).agg(F.sum("x.n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row for each part, order of the filters and step. ``labels`` has id, good and toxic (booleans)."""
    counted = subset_survivors(_words(rename(docs, id=id_col, text=text_col, part=part_col), labels))
    sums = [F.sum(F.when(F.expr(keep), F.col("survivors")[s])).alias(f"{name}{s}") for name, keep in (("n", "true"), ("g", "good"), ("t", "toxic")) for s in range(SUBSETS)]
    parts = counted.groupBy("part").agg(*sums).select("part", *[
        F.array(*[F.coalesce(f"{name}{s}", F.lit(0)) for s in range(SUBSETS)]).alias(name) for name in "ngt"])
    weights = {s: _orders(s.bit_count()) for s in range(SUBSETS)}
    shapley = [sum(((F.col("n")[s] - F.col("n")[s | 1 << k]) * w for s, w in weights.items() if not s >> k & 1), F.lit(0)) for k in range(len(FILTERS))]
    parts = parts.select("part", "n", "g", "t", F.array(*shapley).alias("shapley"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("k", F.expr("ascii(substr(filter_order, step, 1)) - 65"))
    steps = steps.withColumn("before", F.expr("aggregate(filter(sequence(0, step), i -> i > 0 and i < step), 0, (a, i) -> a | shiftleft(1, ascii(substr(filter_order, i, 1)) - 65))"))
    return steps.withColumns({"after": F.expr("before | shiftleft(1, k)"), "others": F.expr(f"{SUBSETS - 1} - shiftleft(1, k)")}).selectExpr(
        "part", "filter_order", "step", "n[after] as kept", "n[before] - n[after] as removed",
        "n[0] - n[shiftleft(1, k)] - n[before] + n[after] as redundant", f"n[others] - n[{SUBSETS - 1}] as unique_fails",
        "g[before] - g[after] as good_lost", "t[before] - t[after] as toxic_lost", "shapley[k] as shapley")


def _orders(before: int) -> int:
    """Orders in which a filter comes right after a given set of ``before`` others."""
    def factorial(n: int) -> int:
        return n * factorial(n - 1) if n > 1 else 1
    return factorial(before) * factorial(len(FILTERS) - 1 - before) if before < len(FILTERS) else 0


def sql() -> str:
    """The audit in DuckDB's SQL, from ``documents`` and ``labels``: documents are counted one by one, without words of subsets."""
    names = ", ".join(f"'{f}'" for f in FILTERS)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
lowest AS (SELECT text, min(doc_id) AS low FROM w GROUP BY 1),
d AS (SELECT part, len(words) < {MIN_WORDS} AS a, 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words) AS b,
    100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(w.text) AS c, regexp_matches(w.text, '[#$%&*|]') AS d,
    coalesce(doc_id > low, false) AS e,
    coalesce((SELECT bool_or(quality = 1) FROM labels WHERE labels.doc_id = w.doc_id), false) AS good,
    coalesce((SELECT bool_or(toxic = 1) FROM labels WHERE labels.doc_id = w.doc_id), false) AS bad
  FROM w JOIN lowest ON w.text = lowest.text),
f AS (SELECT part, good, bad, list_concat(if(a, ['A'], []), if(b, ['B'], []), if(c, ['C'], []), if(d, ['D'], []), if(e, ['E'], [])) AS failed, count(*) AS n FROM d GROUP BY ALL),
l AS (SELECT unnest([{names}]) AS f),
o AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order FROM l v, l w, l x, l y, l z
  WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = {len(FILTERS)}),
s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f, string_split(left(filter_order, step - 1), '') AS earlier FROM o, range(1, {len(FILTERS) + 1}) AS r(step)),
p AS (SELECT DISTINCT part FROM f),
x AS (SELECT p.part, filter_order, step, s.f, n, good, bad, list_contains(failed, s.f) AS fails, len(failed) = 1 AS alone,
    list_has_any(failed, earlier) AND step > 1 AS gone
  FROM s, p JOIN f ON f.part = p.part),
r AS (SELECT part, filter_order, step, f, sum(if(gone OR fails, 0, n))::BIGINT AS kept, sum(if(fails AND NOT gone, n, 0))::BIGINT AS removed,
    sum(if(fails AND gone, n, 0))::BIGINT AS redundant, sum(if(fails AND alone, n, 0))::BIGINT AS unique_fails,
    sum(if(fails AND NOT gone AND good, n, 0))::BIGINT AS good_lost, sum(if(fails AND NOT gone AND bad, n, 0))::BIGINT AS toxic_lost
  FROM x GROUP BY ALL)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM r"""
