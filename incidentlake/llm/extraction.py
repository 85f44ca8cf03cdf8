"""HTML extraction: boilerplate of a host is what its suffix array shows to be repeated on many of its pages.

The token streams of a host's pages (block marks and words, outside the marked main text) are put one after
another, and the suffixes are ordered as far as ``RUN`` tokens. Suffixes with equal first ``RUN`` tokens
stand side by side in that order, so the groups of equal keys are the runs of the array whose common prefixes
are that long. A run is boilerplate if it stands on at least PAGES distinct pages of the host and on a share of SHARE of them;
pages with equal HTML count as one. An article that is copied or quoted on a few pages is none. Covered tokens are
cut and the unique runs of a block are kept.

Rows of such an array are grouped by key (host and tokens, 64 bits) with sums in each task before the shuffle, so a host
with a third of all pages sends a row per key and task. A match never crosses two pages.

Every page is judged so, marked main text (``article``, ``main``) included: a run of it that is boilerplate is cut. What is boilerplate is learned
outside the marked main text, because passages that many articles of a host share would otherwise be lost; for runs inside it, page
titles do not count either, as an article repeats its own. Marks are the check that follows: of a page that marks its main text the unique runs of just that
are kept, and blocks inside menus, headers, footers, sidebars, notices, adverts, forms and comments go even where a host has a single page.

Defined cases: a null or empty page has an empty text; a null or odd URL belongs to the host ``''``; equal rows count as
one page and give a row each; an empty table gives no rows; other columns are ignored; texts are whole at any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, narrowed, rename, ship, without
from .markup import blocks

#: Tokens (block marks and words) that a repeated run has at least.
RUN = 8
#: Distinct pages of a host that hold a run of boilerplate: at least so many, and at least this share of all.
PAGES, SHARE = 3, 0.5

#: Keys of runs inside the marked main text are told from others by these bits; blocks whose runs are not looked for there.
_MAIN, _TITLES = 0x5BD1E9955BD1E995, ("head", "title")

_BLOCKS = "array<struct<text:string, tag:string, aside:boolean>>"
_PARSED = f"row_key bigint, has_main boolean, main {_BLOCKS}, outside {_BLOCKS}"


def _tokens(outside: list) -> tuple[list[str], list[int]]:
    """The stream of the blocks and the block that each token belongs to."""
    stream, owner = [], []
    for k, b in enumerate(outside):
        words = [f"<{b['tag']}>", *b["text"].split()]
        stream += words
        owner += [k] * len(words)
    return stream, owner


def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for page in frame["html"]:
            found, has_main = blocks(page)
            parts = [[{"text": t, "tag": tag, "aside": aside} for tag, t, in_main, aside in found if in_main == wanted] for wanted in (True, False)]
            out.append((has_main, *parts))
        made = pd.DataFrame(out, columns=["has_main", "main", "outside"], dtype=object)
        yield pd.concat([frame.drop(columns="html").reset_index(drop=True), made], axis=1)


def _keys(host: str, outside: list) -> np.ndarray:
    """Of each suffix of at least RUN tokens, the key of the host and the first RUN tokens."""
    stream, _ = _tokens(outside)
    n = len(stream) - RUN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    codes = np.array([xxhash.xxh64_intdigest(t) for t in stream], np.uint64)
    mixed = np.full(n, xxhash.xxh64_intdigest(host), np.uint64)
    for k in range(RUN):
        mixed = (mixed ^ codes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(0, np.int64)])


def page_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each key of a page and its host, and whether a run with it touches no title."""
    for frame in frames:
        found, plain = [], []
        for h, outside in frame[["host", "outside"]].itertuples(index=False):
            keys, place = np.unique(_keys(h, outside), return_inverse=True)
            titles = np.cumsum([0, *[outside[k]["tag"] in _TITLES for k in _tokens(outside)[1]]])
            of_key = np.zeros(len(keys), bool)
            of_key[place[(titles[RUN:] == titles[:-RUN])[:len(place)]]] = True
            found.append(keys)
            plain.append(of_key)
        yield pd.DataFrame({"key": _joined(found), "host_key": np.repeat(frame["host_key"].to_numpy(), [len(x) for x in found]),
                            "plain": np.concatenate([*plain, np.zeros(0, bool)])})


def suffixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each suffix: its key, page and place; places inside the main text are counted down from -1."""
    for frame in frames:
        found, places = [], []
        for h, main, outside in frame[["host", "main", "outside"]].itertuples(index=False):
            inside, keys = _keys(h, main) ^ np.int64(_MAIN), _keys(h, outside)
            found.append(np.concatenate([inside, keys]))
            places.append(np.concatenate([-1 - np.arange(len(inside)), np.arange(len(keys))]).astype(np.int32))
        yield pd.DataFrame({"key": _joined(found), "row_key": np.repeat(frame["row_key"].to_numpy(), [len(x) for x in found]),
                            "place": _joined(places).astype(np.int32)})


def _unique(part: list, places: np.ndarray) -> list[str]:
    """Texts of blocks without the runs that begin at the places; aside blocks and those that have nothing left go."""
    stream, _ = _tokens(part)
    covered = np.zeros(len(stream), bool)
    for p in places:
        covered[p:p + RUN] = True
    texts, at = [], 0
    for b in part:
        words = b["text"].split()
        left = [w for w, gone in zip(words, covered[at + 1:at + 1 + len(words)], strict=True) if not gone]  # the first token is the mark
        at += 1 + len(words)
        if left and not b["aside"]:
            texts.append(" ".join(left))
    return texts


def assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The text of each page: its runs that are not boilerplate, of its marked main text if it has one."""
    for frame in frames:
        texts, counts = [], []
        for has_main, main, outside, places in zip(frame["has_main"], frame["main"], frame["outside"], frame["places"], strict=True):
            places = np.sort(np.asarray(places if places is not None else [], np.int64))
            beside = places[places >= 0]
            counts.append(int(np.minimum(np.diff(beside), RUN).sum()) + RUN * bool(len(beside)))
            texts.append("\n".join(_unique(main, -1 - places[places < 0]) if has_main else _unique(outside, beside)))
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_repeated": counts})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page, url, text, n_chars, and n_repeated: tokens outside the main text that are boilerplate of the host."""
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1))
    kept = rename(pages, page_id=id_col, url=url_col, html=html_col).withColumns({"row_key": F.xxhash64("page_id", "url", "html"), "host": host})
    kept = kept.withColumn("host_key", F.xxhash64("host"))
    id_type = kept.schema["page_id"].dataType.simpleString()

    def parsed(rows: DataFrame) -> DataFrame:
        return rows.select("page_id", "url", "html", "host", "host_key", "row_key").mapInPandas(parse, f"page_id {id_type}, url string, host string, host_key bigint, {_PARSED}")

    # one page of those with equal HTML, and how many of them a host has
    distinct = cut(kept.groupBy("host_key", F.md5(F.coalesce("html", F.lit(""))).alias("content")).agg(F.min("row_key").alias("row_key")))
    sizes = cut(distinct.groupBy("host_key").agg(F.count("*").alias("pages")).filter(f"pages >= {PAGES}"))
    twice = cut(kept.groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1"))  # only rows that are repeated are gathered by their key
    chosen = narrowed(kept, distinct, "row_key")
    counted = parsed(without(chosen, twice, "row_key").unionByName(narrowed(chosen, twice, "row_key").dropDuplicates(["row_key"])))
    many = counted.mapInPandas(page_keys, "key bigint, host_key bigint, plain boolean").groupBy("key", "host_key") \
        .agg(F.count("*").alias("n"), F.count_if("plain").alias("plain")).filter(f"n >= {PAGES}").join(sizes, "host_key")
    inside = F.when((F.col("plain") >= PAGES) & (F.col("plain") >= SHARE * F.col("pages")), F.col("key").bitwiseXOR(F.lit(_MAIN)))
    repeated = many.filter(f"n >= {SHARE} * pages").select(F.explode(F.array("key", inside)).alias("key")).filter("key is not null")
    covered = narrowed(parsed(kept).mapInPandas(suffixes, "key bigint, row_key bigint, place int"), repeated, "key") \
        .groupBy("row_key").agg(F.collect_set("place").alias("places"))
    # a page with marked main text needs no more than the number of its covered tokens
    slim = parsed(kept).select("page_id", "url", "row_key", "has_main", "main", F.when(~F.col("has_main"), F.col("outside")).alias("outside"))
    joined = slim.join(covered, "row_key", "left").select("page_id", "url", "has_main", "main", "outside", "places")
    made = joined.mapInPandas(assemble, f"page_id {id_type}, url string, text string, n_repeated bigint")
    return made.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
