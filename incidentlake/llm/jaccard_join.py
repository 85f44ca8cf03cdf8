"""N-gram Jaccard join: which documents are linked, directly or through others, by near-equal shingle sets.

Sets are joined exactly. Equal sets are one node from the start. The tokens of a set are ordered by how often their
bucket occurs in the corpus (rarest first; any fixed order is right) and only the first ``n - ceil(t * n) + NEEDED`` are
indexed. Index lists hold positions and sizes. Set relations then save most of the work:

* Round 1: each list names its smallest set as pivot, and a set is compared with the pivot it shares most lists with. That
  is one comparison a set, and it settles most groups of copies, whatever their size.
* Sets that are known to be connected need no further comparison, and two sets whose sizes are too far apart cannot be linked. So only those
  blocks of a list go on (a list is cut in blocks by size) that hold several groups together with the blocks whose sizes allow a link. Places too
  late in a set for a first common token go before that: a token that stands late in all its sets has no list at all.
* Round 2: each such list names another pivot, and a set is compared with the one whose bitmap is nearest. Bitmaps hold
  the parity of the tokens in BITS classes; they differ in at most as many places as the sets, so they also rule pairs out. The pivot is a
  set in which the token stands first: near copies have rare tokens of their own before it, the text they were made from has the fewest.
* Round 3: what still holds several groups is joined with itself, block by block, as far as sizes and bitmaps allow a link. Two sets are found by the
  first token they have in common, and behind it each must have as many tokens left as a link takes. What rounds 1 and 2 computed rules
  out more: sets whose distances to a common pivot differ by more than ``1 - t`` cannot be linked (triangle inequality). The pairs that are left are
  compared. The join makes only pairs that bitmaps allow; bitmaps of sets that share a list and are in no way linked still meet pair by pair.

The answer of a set is its component: which of the linked sets of a component are linked directly is not told, since a group of
n different near copies has up to n * n links and only n memberships.

Tokens and sets are 64-bit hashes. Texts are lower-cased (A-Z) and split at white space. A text with fewer words than a shingle
is one shingle; null, empty and blank texts have none and are linked with nothing. Equal rows and equal texts are linked; a null id gives way to any
other as the name of its component. Texts are whole at any length; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .bucket_counts import bucket_counts
from .common import BROADCAST_KEYS, checked, cut, narrowed, rename, ship, taken, without
from .components import components
from .hashing import mixed, word_hashes

NEEDED = 3
SKETCH = 1 << 20  # buckets of the corpus counts
BITS = 256
LONG = 64  # entries of a list that meet before bitmaps are looked at
PARTNERS = 64  # texts that meet the text of a set in one group


def shingle_sets(texts: Iterable[str | None], words: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    for hashes in word_hashes(texts):
        n = len(hashes)
        size = min(n, words)
        out = np.full(max(n - words + 1, 1 if n else 0), size, np.uint64)
        for k in range(size):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(out)])
        yield np.unique(out)


def _buckets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    for tokens in shingle_sets(texts, words):
        yield (tokens & np.uint64(SKETCH - 1)).astype(np.int64)


def _bitmap(tokens: np.ndarray) -> list[int]:
    """Parities of the numbers of tokens in BITS classes, as 64-bit integers."""
    odd = np.bincount((tokens >> np.uint64(40) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _ceil(a: str, b: str) -> str:
    return f"(({a} + {b} - 1) div {b})"


def _distance(a: str, b: str) -> str:
    return "(" + " + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(BITS // 64)) + ")"


class Threshold:
    """``den * intersection >= num * union``, with what follows from it."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def indexed(self, n: int) -> int:
        return min(n, n + self.num * -n // self.den + NEEDED)

    def overlap(self, a: str, b: str) -> str:
        """The least intersection of linked sets of these sizes."""
        return _ceil(f"({self.num} * ({a} + {b}))", str(self.num + self.den))

    def possible(self, n: str, pos: str, m: str, at: str) -> Column:
        """Sizes and places of a common token allow a link."""
        return F.expr(
            f"{self.num} * greatest({n}, {m}) <= {self.den} * least({n}, {m})"
            f" and least({pos}, {at}) + least({n} - {pos}, {m} - {at}) >= {self.overlap(n, m)}")

    def block(self, n: str) -> str:
        """Sizes in ranges of the factor 1 / t; never falling with the size."""
        return f"cast(floor(ln({n}) / ln({self.den / self.num}D)) as int)"

    def last(self, n: str) -> str:
        """The block of the largest set that may be linked with one of this size."""
        return self.block(f"(cast({n} as bigint) * {self.den} div {self.num})")

    def reach(self, n: str) -> str:
        """The blocks of the sets of this size or more that may be linked with it."""
        return f"sequence({self.block(n)}, {self.last(n)})"

    def first_common(self, n: str, pos: str, m: str, at: str) -> Column:
        """A token at these places can be the first that linked sets have in common."""
        return F.expr(f"least({n} - {pos}, {m} - {at}) >= {self.overlap(n, m)}")

    def leading(self) -> Column:
        """A token at this place of a set can be the first that it has in common with a linked set, whatever the other's size."""
        return F.expr(f"{self.den} * (n - pos) >= {self.num} * n")

    def near(self, a: str, n: str, b: str, m: str) -> Column:
        """Bitmaps differ in no more places than linked sets do."""
        return F.expr(f"{_distance(a, b)} <= {n} + {m} - 2 * {self.overlap(n, m)}")

    def enough(self, common: str, n: str, m: str) -> Column:
        return F.expr(f"{common} >= least({NEEDED}, {self.overlap(n, m)})")


def _verified(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, t: Threshold) -> DataFrame:
    """(a, b, common, n, m, linked) of pairs of sets, from their texts.

    The texts of all partners of a set meet the set's own in groups of at most about PARTNERS; they stream past it, one text at a time.
    Texts are sent compressed.
    """
    pairs = cut(pairs)
    named = pairs.join(nodes.selectExpr("node as a", "row_key as ra"), "a").join(nodes.selectExpr("node as b", "row_key as rb"), "b")
    groups = cut(pairs.groupBy("a").agg(F.expr(f"count(*) div {PARTNERS} + 1").alias("parts")))
    named = cut(named.join(groups, "a").selectExpr("a", "b", "ra", "rb", "pmod(xxhash64(b), parts) as part"))
    asked = cut(named.selectExpr("rb as row_key", "a", "part", "b", "1 as turn").union(named.selectExpr("ra", "a", "part", "a", "0").distinct()))
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS // 4 else asked
    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in taken(frames):
            raw = [(x or "").encode() for x in frame["text"]]
            frame["size"], frame["text"] = [len(x) for x in raw], [pa.compress(x, codec="zstd", asbytes=True) for x in raw]
            yield frame[["a", "part", "b", "turn", "size", "text"]]

    met = rows.select("row_key", "text").join(asked, "row_key").drop("row_key") \
        .mapInPandas(packed, "a bigint, part bigint, b bigint, turn int, size bigint, text binary") \
        .repartition("a", "part").sortWithinPartitions("a", "part", "turn", "b")  # a set, then its partners

    def texts(frame: pd.DataFrame) -> Iterator[str]:
        for raw, size in zip(frame["text"], frame["size"].tolist(), strict=True):
            yield pa.decompress(raw, size, "zstd", asbytes=True).decode()

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, own, last = None, np.zeros(0, np.uint64), None
        for frame in taken(frames):
            out = []
            for a, part, b, turn, tokens in zip(*[frame[c].tolist() for c in ("a", "part", "b", "turn")], shingle_sets(texts(frame), words), strict=True):
                if not turn:
                    group, own, last = (a, part), tokens, None
                elif (a, part) != group:
                    raise ValueError("partners without their set")
                elif b != last:  # equal rows come more than once
                    last = b
                    out.append((a, b, len(np.intersect1d(own, tokens, assume_unique=True)), len(own), len(tokens)))
            if out:
                made = pd.DataFrame(out, columns=["a", "b", "common", "n", "m"])
                made["linked"] = t.den * made["common"] >= t.num * (made["n"] + made["m"] - made["common"])
                yield made

    return cut(met.mapInPandas(compare, "a bigint, b bigint, common bigint, n bigint, m bigint, linked boolean"))


def _mixed(entries: DataFrame, t: Threshold) -> DataFrame:
    """The entries that share a list with an entry of another label and a size that allows a link.

    A list is cut in blocks by size. Linked sets stand in one block or the larger one in a block that the smaller one reaches, which is the next or,
    by a logarithm that is rounded, the one behind it. The entries are shuffled once; in its list each looks at the labels of the blocks it
    reaches and of those below that reach it.
    """
    def found(low: int, high: int, of: str = "label", when: str = "true") -> str:
        frame = f"over (partition by token order by block range between {_bound(low)} and {_bound(high)})"
        return f"{when} and (min({of}) {frame} < label or max({of}) {frame} > label)"

    placed = entries.selectExpr("*", f"{t.block('n')} as block", f"{t.last('n')} - {t.block('n')} as steps")
    others = [found(0, 0)] + [found(k, k, when=f"steps >= {k}") for k in (1, 2)] + [found(-k, -k, f"if(steps >= {k}, label, null)") for k in (1, 2)]
    return placed.withColumn("mixed", F.expr(" or ".join(f"coalesce({x}, false)" for x in others))).filter("mixed").drop("block", "steps", "mixed")


def _bound(k: int) -> str:
    return "current row" if not k else f"{abs(k)} {'preceding' if k < 0 else 'following'}"


def _hooked(links: DataFrame) -> DataFrame:
    """(v, up) of links: the smallest neighbour below each vertex, followed upwards a few times."""
    up = cut(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("up")).filter("v > up").groupBy("v").agg(F.min("up").alias("up")))
    for _ in range(2):
        up = up.join(up.selectExpr("v as up", "up as further"), "up", "left").select("v", F.coalesce("further", "up").alias("up"))
    return cut(up)


def _relabelled(entries: DataFrame, up: DataFrame) -> DataFrame:
    """Entries with the label that ``up`` gives to their label."""
    return entries.join(up.withColumnRenamed("v", "label"), "label", "left").withColumn("label", F.coalesce("up", "label")).drop("up")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """id, n_shingles and component_id of every document.

    ``row_key`` and ``component_key`` name the row and the first row of its component where ids repeat or are null.
    """
    spark = docs.sparkSession
    ship(spark)
    t = Threshold(num, den)
    rows = rename(docs, id=id_col, text=text_col).withColumn("row_key", F.xxhash64("id", "text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in taken(frames):
            out = frame[["id", "row_key"]].copy()
            told = [(len(s), xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63), _bitmap(s)) for s in shingle_sets(list(frame["text"]), words)]
            out["n"], out["node"], out["bits"] = [x[0] for x in told], [x[1] for x in told], [x[2] for x in told]
            yield out

    members = cut(rows.select("id", "row_key", "text").mapInPandas(sizes, f"id {id_type}, row_key bigint, n bigint, node bigint, bits array<bigint>"))
    nodes = cut(members.filter("n > 0").groupBy("node").agg(F.min("row_key").alias("row_key"), F.any_value("bits").alias("bits")))
    counts = bucket_counts(rows, SKETCH, lambda texts: _buckets(texts, words))
    held = spark.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32))  # 4 MB

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies of a set give one entry a task, or one more each time this is emptied
        for frame in taken(frames):
            token, node, n, pos = [], [], [], []
            for tokens in shingle_sets(list(frame["text"]), words):
                size = len(tokens)
                name = xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
                if not size or name in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(name)
                k = t.indexed(size)
                often = held.value[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]
                first = np.lexsort((tokens, often))[:k]
                token.append(tokens[first].view(np.int64))
                node.append(np.full(k, name))
                n.append(np.full(k, size, np.int32))
                pos.append(np.arange(k, dtype=np.int32))
            if token:
                yield pd.DataFrame({"token": np.concatenate(token), "node": np.concatenate(node), "n": np.concatenate(n), "pos": np.concatenate(pos)})

    entries = rows.select("text").mapInPandas(index, "token bigint, node bigint, n int, pos int")
    # most tokens have one set: whether there are more is found from two numbers a token
    several = entries.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x <> y").select("token")
    shared = cut(narrowed(entries, several, "token").groupBy("token", "node", "n", "pos").agg(F.lit(1).alias("one")).drop("one"))
    lists = shared.groupBy("token").agg(F.min(F.struct("node", "n", "pos")).alias("p"))

    votes = shared.join(lists, "token").filter("node <> p.node").filter(t.possible("n", "pos", "p.n", "p.pos")) \
        .groupBy("node", "n", F.expr("p.node as pivot"), F.expr("p.n as m")).agg(F.count("*").alias("common")) \
        .filter(t.enough("common", "n", "m"))
    first = votes.groupBy("node").agg(F.max(F.struct("common", "pivot")).alias("best")).selectExpr("best.pivot as a", "node as b")
    answers = _verified(rows, nodes, first, words, t)
    held.unpersist()
    links = answers.filter("linked").select("a", "b")

    # from here on only places that can hold a first common token, so a token that stands late in its sets has no list at all;
    # labels tell which sets are known to be connected, not yet whole components
    labelled = _relabelled(shared.filter(t.leading()).withColumn("label", F.col("node")), _hooked(links))
    entries = cut(_mixed(labelled, t).join(nodes.select("node", "bits"), "node"))
    order = F.xxhash64("token", "node")
    pivots = entries.groupBy("token").agg(F.min(F.struct("pos", order, "node", "n", "bits", "label")).alias("p"))
    second = entries.join(pivots, "token").filter("label <> p.label").filter(t.possible("n", "pos", "p.n", "p.pos")) \
        .filter(t.near("bits", "n", "p.bits", "p.n")).groupBy("node").agg(
            F.min(F.struct(F.expr(_distance("bits", "p.bits")).alias("far"), F.col("p.node").alias("pivot"), "label", F.col("p.label").alias("other"))).alias("best"))
    second = cut(second.selectExpr("best.pivot as a", "node as b", "best.label as lb", "best.other as la"))
    more = _verified(rows, nodes, second.select("a", "b"), words, t)
    answers = answers.union(more)
    links = links.union(more.filter("linked").select("a", "b"))
    groups = more.filter("linked").select("a", "b").join(second, ["a", "b"]).selectExpr("la as a", "lb as b")

    open_ = cut(_mixed(_relabelled(entries.drop("bits"), _hooked(groups)), t))
    met = ["token", "node as a", "n", "pos", "label as la", f"explode({t.reach('n')}) as block"]
    meeting = ["token", "node as b", "n as m", "pos as at", "label as lb", f"{t.block('n')} as block"]
    bits = nodes.select("node", "bits")

    def joined(lists: DataFrame, *more: str) -> DataFrame:
        left, right = lists.selectExpr(*met, *[f"{c} as xa" for c in more]), lists.selectExpr(*meeting, *[f"{c} as xb" for c in more])
        return left.join(right, ["token", "block"]).filter("la <> lb and (n < m or n = m and a < b)").filter(t.first_common("n", "pos", "m", "at"))

    # entries of long lists carry their bitmaps into the join, so that its rows do not grow with the square of a list
    long = checked(open_.groupBy("token").agg(F.count("*").alias("size")).filter(f"size > {LONG}"), "token")
    pairs = joined(open_.join(long, "token", "left_anti")).select("a", "b", "n", "m").distinct() \
        .join(bits.toDF("a", "xa"), "a").join(bits.toDF("b", "xb"), "b").filter(t.near("xa", "n", "xb", "m")).select("a", "b")
    pairs = cut(pairs.union(joined(open_.join(long, "token", "left_semi").join(bits, "node"), "bits").filter(t.near("xa", "n", "xb", "m")).select("a", "b")).distinct())
    done = answers.selectExpr("a", "b").union(answers.selectExpr("b", "a"))
    known = answers.selectExpr("b as v", "a as pivot", "1 - common / (n + m - common) as far")
    apart = f"pa = pb and abs(fa - fb) > {1 - num / den + 1e-9}"
    ruled_out = pairs.join(known.selectExpr("v as a", "pivot as pa", "far as fa"), "a") \
        .join(known.selectExpr("v as b", "pivot as pb", "far as fb"), "b").filter(apart).select("a", "b")
    left_pairs = pairs.join(done, ["a", "b"], "left_anti").join(ruled_out, ["a", "b"], "left_anti")
    more = _verified(rows, nodes, left_pairs, words, t).filter("linked").select("a", "b")
    label = cut(components(links.union(more), "a", "b"))

    placed = members.join(label, members["node"] == label["v"], "left").drop("v").select(
        "id", "row_key", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label"))
    # the smallest id names the component; nulls only if there is no other
    names = placed.filter("label is not null").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "row_key")).alias("first"))
    return placed.join(names, "label", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        "row_key", F.coalesce("first.row_key", "row_key").alias("component_key"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Of each component the row with the smallest id, unchanged; of equal rows one. Rows without words stay."""
    linked = jaccard_components(docs, id_col, text_col, words, num, den)
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(docs[id_col], docs[text_col]).alias("row_key"))
    left = without(keyed, linked.filter("row_key <> component_key").select("row_key"), "row_key")
    # equal rows of one key: only those keys that occur more than once are gathered
    twice = linked.filter("n_shingles > 0").groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1").select("row_key")
    single, several = without(left, twice, "row_key"), narrowed(left, twice, "row_key")
    return single.unionByName(several.dropDuplicates(["row_key"])).select("row.*")
