"""URL filters: rules first, then naive Bayes over the words of host and path.

Host names are split into words by unigram Viterbi. The unigram model counts, over all hosts, in how many
of them a word stands between marks (``cheap`` and ``pills`` of ``cheap-pills.example.org``) or as a path word;
the given seed words belong to it too. Only substrings that really occur in a name meet the model, in a join on the
word, so no dictionary is broadcast.

Multinomial naive Bayes then scores a URL's words. Its training labels come from the seed words: URLs that hold one
are examples of ``block``, all others of ``allow``; so words that keep company with seed words count
against a URL even where no seed word stands. Words are hashed into a fixed number of buckets, so the model is an array of a proven size.

Defined cases: null URLs and URLs without ``://`` have an empty host and path and no rule; the model then has the prior
alone. Hosts and paths of any length are taken whole. Equal rows give equal rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, rename, ship

#: Fixed values of the contract: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Words that label training URLs.
SEEDS = ("spam", "pills", "casino", "viagra", "porn", "xxx", "warez", "malware", "phishing", "scam", "betting", "lottery")
SEED_HOSTS = 50  # hosts that a seed word counts for in the unigram model
LONGEST = 24  # letters of the longest word of the unigram model
BUCKETS = 1 << 16
SMOOTHING = 0.1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def segment(name: str, edges: dict[tuple[int, int], float], unseen: float) -> list[str]:
    """Viterbi: the split of a name with the largest sum of log probabilities.

    ``edges`` has the log probabilities of the known words by place. A stretch that is not known costs ``unseen`` and
    2.3 (a tenth) for each letter; so does a known word's rival, the name left whole.
    """
    n = len(name)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for start, end in edges:
        ends[end].append(start)
    known, open_ = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1)  # best up to here, outside and inside an unknown stretch
    known_from, open_from = [0] * (n + 1), [0] * (n + 1)
    best, back = [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        begin = best[i - 1] + unseen
        if begin >= open_[i - 1]:
            open_[i], open_from[i] = begin - 2.3, i - 1
        else:
            open_[i], open_from[i] = open_[i - 1] - 2.3, open_from[i - 1]
        for start in ends[i]:
            if (p := best[start] + edges[start, i]) > known[i]:
                known[i], known_from[i] = p, start
        best[i], back[i] = max((known[i], known_from[i]), (open_[i], open_from[i]))
    words = []
    while n:
        words.append(name[back[n]:n])
        n = back[n]
    return words[::-1]


def _substrings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = [(name, s, e, name[s:e]) for name in frame["name"] for s in range(len(name)) for e in range(s + 2, min(len(name), s + LONGEST) + 1)]
        if out:
            yield pd.DataFrame(out, columns=["name", "start", "stop", "word"])


def segmented(names: DataFrame, words: DataFrame, total: float) -> DataFrame:
    """(name, words) of distinct names; ``words`` has (word, hosts)."""
    unseen = math.log(1 / max(total, 1.0))
    found = names.mapInPandas(_substrings, "name string, start int, stop int, word string").join(words, "word")
    edges = found.groupBy("name").agg(F.collect_list(F.struct("start", "stop", "hosts")).alias("edges"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, es in zip(frame["name"], frame["edges"], strict=True):
                logs = {(e["start"], e["stop"]): math.log(e["hosts"] / total) for e in (es if es is not None else ())}
                out.append(segment(name, logs, unseen))
            yield pd.DataFrame({"name": frame["name"], "words": out})

    return names.join(edges, "name", "left").mapInPandas(run, "name string, words array<string>")


def host_words(hosts: DataFrame, path_words: DataFrame, seeds=SEEDS) -> DataFrame:
    """(host, words): the words of every distinct host, its labels segmented. ``path_words`` has (host, word)."""
    labels = hosts.select("host", F.posexplode(F.split("host", r"[^\p{L}\p{N}-]+")).alias("at", "label")).filter("label <> ''")
    parts = labels.select("host", "at", "label", F.posexplode(_words(F.col("label"))).alias("sub", "name"))
    marked = parts.filter(F.col("label").contains("-")).select("host", F.col("name").alias("word"))
    seen = marked.union(path_words).filter(F.col("word").rlike(rf"^\p{{L}}{{2,{LONGEST}}}$")).distinct()
    given = hosts.sparkSession.createDataFrame([(w, SEED_HOSTS) for w in seeds], "word string, hosts bigint")
    words = cut(seen.groupBy("word").agg(F.count("*").alias("hosts")).union(given).groupBy("word").agg(F.sum("hosts").alias("hosts")))
    total = float(words.agg(F.sum("hosts")).first()[0])
    split = segmented(parts.select("name").distinct(), words, total)
    return parts.join(split, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "sub", "words"))).alias("all")) \
        .select("host", F.flatten("all.words").alias("host_words"))


def train(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds (block against allow) of each bucket, and of the prior. ``rows``: tokens, hit, n. At most two counts a bucket are collected."""
    bucket = F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int").alias("bucket")
    counts = rows.select("hit", "n", F.explode("tokens").alias("token")).groupBy("hit", bucket).agg(F.sum("n").alias("n")).collect()
    table = np.zeros((2, BUCKETS))
    for r in counts:
        table[int(r.hit), r.bucket] += r.n
    seen = table.any(axis=0).sum()
    table = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * max(seen, 1))
    size = dict(rows.groupBy("hit").agg(F.sum("n")).collect())
    prior = math.log((size.get(True, 0) + 1) / (size.get(False, 0) + 1))
    return np.log(table[1]) - np.log(table[0]), prior


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, seeds=SEEDS) -> DataFrame:
    """page, host, path, rule, verdict, and the method's ``log_odds`` of every row."""
    spark = pages.sparkSession
    ship(spark)
    kept = rename(pages, page_id=id_col, url=url_col)
    host, path = host_path(F.col("url"))
    parsed = kept.select("page_id", host.alias("host"), path.alias("path"))
    # distinct (host, path) pairs with counts: hot hosts and copies shrink in each task before the shuffle
    distinct = cut(parsed.groupBy("host", "path").agg(F.count("*").alias("n")))
    hosts = distinct.select("host").distinct()
    path_words = distinct.select("host", F.explode(_words(F.col("path"))).alias("word"))
    words = cut(host_words(hosts, path_words, seeds))
    seed_list = F.array(*map(F.lit, seeds))

    def tokens(df: DataFrame) -> DataFrame:
        both = F.concat(F.coalesce("host_words", F.array().cast("array<string>")), _words(F.col("path")))
        # the host words are few and alike for all rows of a host: the hot host's side is split by the adaptive join
        return df.join(words, "host", "left").withColumn("tokens", both)

    log_odds, prior = train(tokens(distinct).select("tokens", "n", F.arrays_overlap("tokens", seed_list).alias("hit")))
    held = spark.sparkContext.broadcast(log_odds)  # 512 KB, whatever the input

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["page_id", "host", "path"]].copy()
            out["log_odds"] = [prior + float(held.value[b].sum()) if len(b) else prior for b in (np.asarray(x, np.int64) for x in frame["buckets"])]
            yield out

    buckets = F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
    id_type = kept.schema["page_id"].dataType.simpleString()
    scored = tokens(parsed).select("page_id", "host", "path", buckets.alias("buckets")).mapInPandas(
        run, f"page_id {id_type}, host string, path string, log_odds double")
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select(
        F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(decision, F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"), "log_odds")


def base_sql(rules=RULES) -> str:
    """Host, path and rule in DuckDB's SQL, and the verdict where a rule fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    case = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{pattern}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
  coalesce(regexp_extract(url, '{pattern}', 2), '') AS path FROM pages)
SELECT page_id, host, path, {case(1)} AS rule, {case(2)} AS verdict FROM u"""


