"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Every document gets base counts. Labelled documents that pass the base rules are the
holdout. For each stratum and rule the cutoffs are tested from the loosest to the strictest
(fixed sequence): a cutoff is valid if the exact binomial probability of seeing so few false
rejections, were the true rate ``alpha / rules``, is at most ``delta / (strata * rules)``
(Bonferroni over strata and rules). So with probability ``1 - delta`` all rules together
reject at most a share ``alpha`` of the good documents of every stratum. Of the valid
cutoffs the one with the largest difference between rejected shares of bad and good is used,
the loosest if several are equal. A stratum without enough labels rejects nothing.

Null texts have no words; null or unlisted strata count as ``other``; null ids, labels that
are null or name no document, repeated rows and ties need no special care: the verdict is a
function of a row's text and stratum, and a label that is given twice counts twice. An empty table gives no rows; columns that the
operator does not name are not read, so their names cannot clash; texts are whole at any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_dir
from .common import cut, rename

#: Strata of their own; all other values are pooled, so the table of cutoffs stays small.
STRATA = ("en", "de", "fr", "es")
ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Steps of each rule: a rule's bin is ``floor(steps * amount / base)``, at most TOP.
TOP = 40
RULES = {
    "symbols": (40, "n_symbols", "n_words"),
    "repeats": (40, "n_repeat_words", "n_words"),
    "dup_lines": (40, "n_dup_lines", "n_lines"),
    "capitals": (40, "n_capitals", "word_chars"),
    "shouts": (40, "n_shouts", "n_words"),
    "long_words": (2, "word_chars", "n_words"),
    "short_words": (40, "n_words", "word_chars"),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(df: DataFrame) -> DataFrame:
    """Adds to a frame with ``text`` the counts of every text; nothing is shuffled."""
    carried = df.columns
    df = df.withColumn("words", F.expr(r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
    df = df.withColumn("lines", F.expr(r"filter(split(coalesce(text, ''), '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    eight = ", ".join(f"get(words, i + {k})" for k in range(WINDOW))  # slice() would copy the whole array each time
    df = df.withColumn("windows", F.expr(
        f"if(size(words) > {WINDOW}, transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({eight})), array())"))
    df = df.withColumn("ordered", F.expr(
        "if(size(array_distinct(windows)) < size(windows), array_sort(transform(windows, (h, i) -> struct(h, i))), array())"))
    df = df.withColumn("repeated", F.expr(
        "array_sort(transform(filter(transform(ordered, (s, k) -> struct(s.i as i,"
        " coalesce(get(ordered, k - 1).h = s.h, false) or coalesce(get(ordered, k + 1).h = s.h, false) as twice)),"
        " x -> x.twice), x -> x.i))"))
    counts = [
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr("cast(size(split(coalesce(text, ''), '[#*$%&|<>]', -1)) - 1 as bigint)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr(f"cast(aggregate(transform(repeated, (p, k) -> least({WINDOW}, coalesce(get(repeated, k + 1) - p, {WINDOW}))), 0, (a, x) -> a + x) as bigint)").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("cast(size(split(coalesce(text, ''), '[A-Z]', -1)) - 1 as bigint)").alias("n_capitals"),
        F.expr("cast(size(split(coalesce(text, ''), '!', -1)) - 1 as bigint)").alias("n_shouts"),
    ]
    # a generator, so that filters on counts are not pushed below, where they would evaluate all of this again and again
    return df.select(*carried, F.inline(F.array(F.struct(*counts)))
    ).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def _bin(rule: str) -> Column:
    steps, amount, base = RULES[rule]
    return F.expr(f"least({TOP}, ({steps} * {amount}) div greatest({base}, 1))")


def _pool(stratum: Column) -> Column:
    return F.when(stratum.isin(*STRATA), stratum).otherwise(F.lit("other"))


def _log_gamma(x: str) -> str:
    """ln Γ(x) for x >= 1: Stirling's series after a shift by eight."""
    z = f"({x} + 8D)"
    shift = " * ".join(f"({x} + {k}D)" for k in range(8))
    return f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3)) + 1 / (1260 * pow({z}, 5)) - ln({shift}))"


def binomial_tail(k: str, n: str, rate: float) -> Column:
    """P(Bin(n, rate) <= k), summed from the largest term down; 1 from the mean on.

    60 standard deviations below the first term nothing is left to add in double precision.
    """
    first = f"exp({_log_gamma(f'({n} + 1D)')} - {_log_gamma(f'({k} + 1D)')} - {_log_gamma(f'({n} - {k} + 1D)')} + {k} * ln({rate}D) + ({n} - {k}) * ln(1 - {rate}D))"
    terms = f"cast(least({k}, 100 + 60 * sqrt({n} * {rate}D)) as int)"
    ratio = f"({k} - i + 1) * {1 - rate}D / (({n} - {k} + i) * {rate}D)"
    return F.expr(f"""if({k} >= {n} * {rate}D, 1D, {first} * aggregate(
        if({terms} > 0, sequence(1, {terms}), array()), struct(1D as term, 1D as total),
        (a, i) -> struct(a.term * ({ratio}) as term, a.total + a.term * ({ratio}) as total), a -> a.total))""")


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> list[tuple[str, str, int]]:
    """(stratum, rule, cutoff) of the rules in force; at most one for each stratum and rule.

    ``labels`` has ``id`` and ``good`` (boolean). Only counts per stratum, rule and bin leave the executors.
    """
    holdout = measured.filter("not base_failed").join(labels.filter("good is not null"), "id").select(
        _pool(F.col("stratum")).alias("stratum"), "good",
        F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), _bin(r))])).alias("rule", "bin"))
    counts = holdout.groupBy("stratum", "rule", "bin").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    tests = counts.selectExpr(
        "*", "sum(good) over (partition by stratum, rule order by bin desc) as good_hit",
        "sum(bad) over (partition by stratum, rule order by bin desc) as bad_hit",
        "sum(good) over (partition by stratum, rule) as n_good", "sum(bad) over (partition by stratum, rule) as n_bad")
    valid = tests.filter("bin >= 1 and n_good > 0").filter(
        binomial_tail("good_hit", "n_good", alpha / len(RULES)) <= delta / ((len(STRATA) + 1) * len(RULES)))
    best = valid.withColumn("gain", F.expr("bad_hit * n_good - good_hit * n_bad")).filter("gain > 0") \
        .groupBy("stratum", "rule").agg(F.max(F.struct("gain", "bin")).alias("best"))
    return sorted((r.stratum, r.rule, r.bin) for r in best.select("stratum", "rule", "best.bin").collect())


def verdict(found: list[tuple[str, str, int]]) -> Column:
    """kept: not failed by the base rules and below every cutoff of its stratum."""
    rejected = F.lit(False)
    for stratum, rule, bin_ in found:
        rejected = rejected | ((_pool(F.col("stratum")) == stratum) & (_bin(rule) >= bin_))
    return ~F.col("base_failed") & ~rejected


def prepared(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    return measures(rename(docs, id=id_col, stratum=stratum_col, text=text_col))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """id, base counts, base_failed and kept of every document. Texts are read once; the counts are checkpointed."""
    measured = cut(prepared(docs, id_col, text_col, stratum_col).drop("text"))
    found = cutoffs(measured, labels, alpha, delta)
    return measured.select(F.col("id").alias(id_col), *BASE, "base_failed", verdict(found).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.

    Texts are measured once: rows go to a scratch table together with their counts, the cutoffs are found from its narrow columns,
    and the verdict is a filter while it is read again.
    """
    spark = docs.sparkSession
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    path = scratch_dir(spark, "measured")
    measures(docs.select(row, docs[id_col].alias("id"), docs[stratum_col].alias("stratum"), docs[text_col].alias("text"))).drop("text").write.parquet(path)
    measured = spark.read.parquet(path)
    return measured.filter(verdict(cutoffs(measured, labels, alpha, delta))).select("row.*")


def sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """The verdicts in DuckDB's SQL, from ``documents`` and ``labels``."""
    level, rate = delta / ((len(STRATA) + 1) * len(RULES)), alpha / len(RULES)
    bins = ", ".join(f"least({TOP}, ({steps} * {amount}) // greatest({base}, 1)) AS {rule}" for rule, (steps, amount, base) in RULES.items())
    long = " UNION ALL ".join(f"SELECT stratum, good, '{rule}' AS rule, {rule} AS bin FROM holdout" for rule in RULES)
    hit = " OR ".join(f"coalesce({rule} >= (SELECT min(bin) FROM best b WHERE b.stratum = m.stratum AND b.rule = '{rule}'), false)" for rule in RULES)
    marks = lambda text, chars: f"length(regexp_replace({text}, '[^{chars}]', '', 'g'))"
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS key
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k.k) AS n FROM twice, range({WINDOW}) AS k(k) GROUP BY 1),
c AS (SELECT w.doc_id, CASE WHEN lang IN {STRATA} THEN lang ELSE 'other' END AS stratum, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars, {marks('text', '#*$%&|<>')}::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, {marks('text', 'A-Z')}::BIGINT AS n_capitals, {marks('text', '!')}::BIGINT AS n_shouts
  FROM w LEFT JOIN covered USING (doc_id)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, {bins} FROM c),
holdout AS (SELECT m.*, quality = 1 AS good FROM m JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IS NOT NULL),
counts AS (SELECT stratum, rule, bin, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad FROM ({long}) GROUP BY ALL),
tests AS (SELECT stratum, rule, bin, sum(good) OVER down AS good_hit, sum(bad) OVER down AS bad_hit,
    sum(good) OVER whole AS n_good, sum(bad) OVER whole AS n_bad FROM counts
  WINDOW down AS (PARTITION BY stratum, rule ORDER BY bin DESC), whole AS (PARTITION BY stratum, rule)),
p AS (SELECT *, CASE WHEN good_hit >= n_good * {rate} THEN 1.0 ELSE list_sum([
    exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({rate}) + (n_good - i) * ln(1 - {rate}))
    FOR i IN range(0, good_hit::BIGINT + 1)]) END AS p FROM tests WHERE bin >= 1 AND n_good > 0),
best AS (SELECT stratum, rule, bin FROM p WHERE p <= {level} AND bad_hit * n_good > good_hit * n_bad
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad_hit * n_good - good_hit * n_bad DESC, bin DESC) = 1)
SELECT doc_id, {', '.join(BASE)}, base_failed, NOT base_failed AND NOT ({hit}) AS kept FROM m"""
