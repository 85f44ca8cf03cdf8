"""Executive summary of an incident table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import is_missing, is_true_bool

# Columns whose missing share is reported; the numeric ones also count NaN.
CHECKED = [
    "primary_type", "district", "ward", "community_area", "latitude", "longitude",
    "location_description", "arrest", "domestic",
]
CHECKED_NUMERIC = ("latitude", "longitude")

_NONE = "n/a"


def _leaders(df: DataFrame, ts: str) -> DataFrame:
    """One row with the leading values of each dimension as arrays of (value, n).

    All dimensions are counted in one scan by grouping sets; the ranking only sees
    grouped rows, and only the first three per dimension leave the map side.
    """
    dims = {
        "kind": F.col("primary_type"),
        "hour": F.hour(ts),
        "day": F.to_date(ts),
        "district": F.col("district"),
        "place": F.col("location_description"),
    }
    # rows are grouped on raw values; only the groups are written out
    shown = {
        "hour": F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00")),
        "day": F.col("day").cast("string"), "district": F.col("district").cast("string"),
    }
    # ties go to the smaller value: by number where there is one, else by text
    numbers = {"hour": F.col("hour").cast("double"), "day": F.unix_date("day").cast("double"),
               "district": F.col("district").try_cast("double")}
    keys = [c.alias(n) for n, c in dims.items()]
    counts = (
        df.select(*keys).groupingSets([[F.col(n)] for n in dims], *[F.col(n) for n in dims])
        .agg(F.grouping_id(*dims).alias("gid"), F.count("*").alias("n"))
    )
    # grouping_id has a 0 bit for the one column that is grouped
    full = 2 ** len(dims) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    number = F.lit(None).cast("double")
    for i, d in enumerate(dims):
        mine = F.col("gid") == full - 2 ** (len(dims) - 1 - i)
        name = F.when(mine, F.lit(d)).otherwise(name)
        value = F.when(mine, shown.get(d, F.col(d))).otherwise(value)
        if d in numbers:
            number = F.when(mine, numbers[d]).otherwise(number)
    named = counts.select(name.alias("dim"), value.alias("value"), number.alias("number"), "n")
    # days are ranked from both ends, so each day also enters with its count negated
    both = F.array(F.struct("dim", F.col("n").alias("score")),
                   F.struct(F.lit("day_least").alias("dim"), (-F.col("n")).alias("score")))
    one = F.array(F.struct("dim", F.col("n").alias("score")))
    scored = named.filter("value is not null").select(
        "value", "number", "n", F.explode(F.when(F.col("dim") == "day", both).otherwise(one)).alias("s")
    ).select("value", "number", "n", "s.*")
    best_first = Window.partitionBy("dim").orderBy(F.desc("score"), "number", "value")
    kept = scored.withColumn("rank", F.row_number().over(best_first)).filter("rank <= 3")

    def pick(d):
        rows = F.collect_list(F.when(F.col("dim") == d, F.struct("rank", "value", "n")))
        return F.array_sort(rows).alias(d)

    return kept.agg(*[pick(d) for d in [*dims, "day_least"]])


def _totals(df: DataFrame, ts: str, checked: Sequence[str]) -> DataFrame:
    year = F.year(ts)
    return df.agg(
        F.count("*").alias("rows"),
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.count_if(is_true_bool("arrest")).alias("arrests"),
        F.count_if(is_true_bool("domestic")).alias("domestics"),
        F.array(*[
            F.struct(F.count_if(is_missing(c, c in CHECKED_NUMERIC)).alias("n"),
                     F.lit(c).alias("column"))
            for c in checked
        ]).alias("missing"),
    )


def _pct(n, rows) -> Column:
    return F.when(rows > 0, F.round(100.0 * n / rows, 1)).otherwise(0.0)


def eda_summary(df: DataFrame, ts: str = "date_ts", checked: Sequence[str] = CHECKED) -> DataFrame:
    """(position, finding, detail) rows from two scans: grouped counts and totals."""
    checked = [c for c in checked if c in df.columns]
    top = _leaders(df, ts).agg(F.first(F.struct("*"))).scalar()
    one = _totals(df, ts, checked).select("*", top.alias("t"))

    def nth(dim, i, part):
        return F.get(F.col(f"t.{dim}"), F.lit(i))[part]

    def counted(dim):
        text = F.concat(nth(dim, 0, "value"), F.lit(" ("),
                        nth(dim, 0, "n").cast("string"), F.lit(" incidents)"))
        return F.coalesce(text, F.lit(_NONE))

    def listing(dim, k):
        values = F.slice(F.transform(f"t.{dim}", lambda r: r["value"]), 1, k)
        return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(_NONE)

    def flagged(n):
        return F.concat(_pct(F.col(n), F.col("rows")).cast("string"), F.lit("% ("),
                        F.col(n).cast("string"), F.lit(" incidents)"))

    # most missing first, ties to the earlier column name
    worst = F.get(F.array_sort(
        "missing",
        lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1)
        .when(a["column"] < b["column"], -1).when(a["column"] > b["column"], 1).otherwise(0),
    ), F.lit(0))
    kind_share = _pct(nth("kind", 0, "n"), F.col("rows")).cast("string")
    findings = [
        ("Record count", F.concat(F.col("rows").cast("string"), F.lit(" rows"))),
        ("Years in sample", F.coalesce(
            F.concat_ws("-", F.col("first_year").cast("string"),
                        F.col("last_year").cast("string")), F.lit(_NONE))),
        ("Busiest calendar day", counted("day")),
        ("Quietest calendar day", counted("day_least")),
        ("Most common crime", F.coalesce(F.concat(
            nth("kind", 0, "value"), F.lit(" ("), nth("kind", 0, "n").cast("string"),
            F.lit(" incidents, "), kind_share, F.lit("% of rows)")), F.lit(_NONE))),
        ("Peak hours", listing("hour", 2)),
        ("Highest-crime districts", listing("district", 3)),
        ("Arrest rate", flagged("arrests")),
        ("Domestic flag", flagged("domestics")),
        ("Most common location", counted("place")),
        ("Largest missingness", F.concat(
            worst["column"], F.lit(" - "),
            F.when(F.col("rows") > 0, F.round(worst["n"] / F.col("rows") * 100, 2))
            .otherwise(0.0).cast("string"), F.lit("% null"))),
    ]
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("finding"),
                 detail.alias("detail"))
        for i, (name, detail) in enumerate(findings, start=1)
    ])).alias("f")).select("f.*")
