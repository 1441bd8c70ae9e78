"""Archive questions: profiles, distinct values, top tags, publishing times."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from presslake.functions.dates import iso_weekday

TOP_TAGS = 20
HOURS = list(range(24))


# -- counts and distinct values ---------------------------------------------
def column_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column, one row."""
    return df.agg(*(F.count(F.col(name)).alias(name) for name in df.columns))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``; every task keeps only its own first rows."""
    return df.orderBy(*order).limit(n)


def in_batches(df: DataFrame, rows: int) -> Iterator[list[Row]]:
    """Consume a result in lists of ``rows`` rows; the driver holds one partition at a time."""
    waiting = df.toLocalIterator()
    while batch := list(islice(waiting, rows)):
        yield batch


def n_unique_rows(df: DataFrame) -> DataFrame:
    """Number of distinct rows; NULLs are equal, and so are ``0.0`` and ``-0.0``."""
    return df.distinct().agg(F.count("*").alias("n_unique"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column; NULL is a value."""
    return df.select(column).distinct()


# -- tags ---------------------------------------------------------------------
def tag_counts(articles: DataFrame) -> DataFrame:
    """Rows per tag. Empty and NULL lists have no tag, so a plain explode will do."""
    tags = articles.select(F.explode("tags").alias("tag")).filter("tag is not null")
    return tags.groupBy("tag").agg(F.count("*").alias("frequency"))


def top_tags(articles: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """The ``k`` most frequent tags, ties by tag."""
    return tag_counts(articles).orderBy(F.desc("frequency"), "tag").limit(k)


def top_tags_share(articles: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """Each top tag's share of the top-``k`` total (the window sees ``k`` rows)."""
    total = F.sum("frequency").over(Window.partitionBy())
    return top_tags(articles, k).withColumn("share", F.round(F.col("frequency") / total, 6))


# -- publishing times -----------------------------------------------------------
def heatmap(articles: DataFrame, ts: str = "date_parsed") -> DataFrame:
    """Articles per ISO weekday and hour; unparsed dates form their own group."""
    parts = articles.select(iso_weekday(ts).alias("weekday"), F.hour(ts).alias("hour"))
    return parts.groupBy("weekday", "hour").agg(F.count("*").alias("article_count"))


def heatmap_pivot(articles: DataFrame, ts: str = "date_parsed") -> DataFrame:
    """The same as a weekday x hour matrix with columns ``h0`` .. ``h23``."""
    wide = heatmap(articles, ts).groupBy("weekday").pivot("hour", HOURS).agg(F.sum("article_count"))
    cells = (F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("long").alias(f"h{h}") for h in HOURS)
    return wide.select("weekday", *cells)


def on_month_day(articles: DataFrame, month: int, day: int) -> DataFrame:
    """Distinct (url, content) of the articles of one calendar day of every year."""
    return articles.sparkSession.sql(
        """select distinct url, content from {articles}
           where extract(month from date_parsed) = {month}
             and extract(day from date_parsed) = {day}""",
        articles=articles,
        month=month,
        day=day,
    )


def content_like(articles: DataFrame, word: str) -> DataFrame:
    """Content of the articles that contain ``word``, character by character."""
    return articles.sparkSession.sql(
        "select content from {articles} where contains(content, {word})",
        articles=articles.select("content"),
        word=word,
    )


# -- profile ------------------------------------------------------------------
def _micros(column: str) -> str:
    return f"""timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00',
                             cast(`{column}` as timestamp_ntz))"""


def _from_micros(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(micros))


def _is_time(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName().startswith("timestamp")


# A driver may rank this many distinct values itself.
RANKED_VALUES = 100_000


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], margin: float = 0.0001, stats: Sequence[Column] = ()
) -> tuple[dict[str, list[object | None]], dict[str, object]]:
    """Exact quantiles (nearest rank) of numeric and timestamp columns, and ``stats`` over ``df``.

    Three passes serve all columns. The first computes ``stats``, counts, and
    approximate percentiles on either side of each rank; the second counts the
    values below and up to each such range exactly; the third counts the values
    inside. A range that missed its rank is widened, one that still holds more
    than ``RANKED_VALUES`` distinct values is narrowed by percentiles of its own,
    each for another round. The driver ranks the few values that are left.
    """
    shown = {name: _micros(name) if _is_time(df, name) else f"`{name}`" for name in wanted}
    values = df.selectExpr("*", *(f"{sql} as `_v {name}`" for name, sql in shown.items()))
    first = list(stats)
    for name, probabilities in wanted.items():
        around = [q for p in probabilities for q in (max(p - margin, 0.0), min(p + margin, 1.0))]
        first.append(F.count(f"_v {name}").alias(f"_n {name}"))
        first.append(F.percentile_approx(f"_v {name}", around, 50000).alias(f"_around {name}"))
    result = values.agg(*first).first().asDict()
    found: dict[tuple[str, int], object] = {}
    ranges: dict[tuple[str, int], list] = {}  # low, high, rank
    for name, probabilities in wanted.items():
        n, bounds = result.pop(f"_n {name}"), result.pop(f"_around {name}")
        for i, p in enumerate(probabilities):
            if n == 0:
                found[name, i] = None
            else:
                ranges[name, i] = [bounds[2 * i], bounds[2 * i + 1], math.floor((n - 1) * p + 0.5)]
    while ranges:
        _narrow(values, ranges, found)
    quantiles = {}
    for name, probabilities in wanted.items():
        got = [found[name, i] for i in range(len(probabilities))]
        quantiles[name] = [_from_micros(v) if v is not None and _is_time(df, name) else v for v in got]
    return quantiles, result


def _narrow(values: DataFrame, ranges: dict[tuple[str, int], list], found: dict[tuple[str, int], object]) -> None:
    """One round over all open ranges: settle them, or make them wider or narrower."""
    counts = []
    for (name, i), (low, high, _) in ranges.items():
        v = F.col(f"_v {name}")
        counts += [F.count_if(v < low).alias(f"below {i} {name}"), F.count_if(v <= high).alias(f"upto {i} {name}")]
    counts = values.agg(*counts).first().asDict()
    inside = []
    for key, (low, high, rank) in list(ranges.items()):
        name, i = key
        below, upto = counts[f"below {i} {name}"], counts[f"upto {i} {name}"]
        if not below <= rank < upto:  # rare: the approximation was off; take the whole range
            ranges[key][:2] = values.agg(F.min(f"_v {name}"), F.max(f"_v {name}")).first()
        elif low == high:
            found[key] = low
            del ranges[key]
        else:
            v = F.col(f"_v {name}")
            inside.append((key, below, (v >= low) & (v <= high)))
    if not inside:
        return
    held = F.array(
        *(
            F.when(test, F.struct(F.lit(j).alias("j"), F.col(f"_v {key[0]}").cast("string").alias("v")))
            for j, (key, _, test) in enumerate(inside)
        )
    )
    hits = values.select(F.explode(F.array_compact(held)).alias("hit")).select("hit.*")
    histogram = hits.groupBy("j", "v").agg(F.count("*").alias("n")).limit(RANKED_VALUES * len(inside) + 1).collect()
    if len(histogram) > RANKED_VALUES * len(inside):
        for key, below, test in inside:
            low, high, rank = ranges[key]
            _, upto = below, counts[f"upto {key[1]} {key[0]}"]
            at = (rank - below) / max(upto - below - 1, 1)
            part = values.where(test).agg(
                F.percentile_approx(f"_v {key[0]}", [max(at - 0.001, 0.0), min(at + 0.001, 1.0)], 50000)
            )
            ranges[key][:2] = part.first()[0]
        return
    for j, (key, below, _) in enumerate(inside):
        parse = type(ranges[key][0])
        rank = ranges.pop(key)[2] - below
        for v, n in sorted((parse(row["v"]), row["n"]) for row in histogram if row["j"] == j):
            if rank < n:
                found[key] = v
                break
            rank -= n


QUARTILES = (("25%", 0.25), ("50%", 0.5), ("75%", 0.75))
STATISTICS = ("count", "null_count", "mean", "std", "min", *(q for q, _ in QUARTILES), "max")


def column_kinds(df: DataFrame) -> dict[str, str]:
    """``number``, ``time`` or the type's name, for each column."""
    kinds = {}
    for field in df.schema:
        kind = field.dataType.typeName()
        numeric = isinstance(field.dataType, T.NumericType)
        kinds[field.name] = "number" if numeric else "time" if kind.startswith("timestamp") else kind
    return kinds


def describe(df: DataFrame) -> DataFrame:
    """Nine statistics per column, one row each.

    Numeric columns give DOUBLE values, all others text. Lists have counts
    only, strings no mean and quartiles, timestamps no standard deviation.
    """
    kinds, wanted = column_kinds(df), []
    for name, kind in kinds.items():
        col = F.col(f"`{name}`")
        wanted += [F.count(col).alias(f"count {name}"), F.count_if(col.isNull()).alias(f"null_count {name}")]
        if kind in ("number", "time", "string"):
            wanted += [F.min(col).alias(f"min {name}"), F.max(col).alias(f"max {name}")]
        if kind == "number":
            wanted += [F.avg(col).alias(f"mean {name}"), F.stddev_samp(col).alias(f"std {name}")]
        if kind == "time":
            mean = F.avg(F.expr(_micros(name)).cast("decimal(20,0)"))
            wanted.append(F.floor(mean).cast("long").alias(f"mean {name}"))
    ranked = {name: [p for _, p in QUARTILES] for name, kind in kinds.items() if kind in ("number", "time")}
    quartiles, stats = exact_quantiles(df, ranked, stats=wanted)
    return described(df.sparkSession, kinds, stats, quartiles)


def described(
    spark: SparkSession, kinds: dict[str, str], stats: dict[str, object], quartiles: dict[str, list[object | None]]
) -> DataFrame:
    """The rows of ``describe`` from statistics by ``"<statistic> <column>"`` and quartiles by column."""
    stats = dict(stats)
    for name, kind in kinds.items():
        if name in quartiles:
            stats.update({f"{q} {name}": v for (q, _), v in zip(QUARTILES, quartiles[name])})
        if kind == "time" and stats[f"mean {name}"] is not None:
            stats[f"mean {name}"] = _from_micros(stats[f"mean {name}"])

    def cell(statistic: str, name: str):
        value = stats.get(f"{statistic} {name}")
        if value is None:
            return None
        if kinds[name] == "number":
            return round(float(value), 6)
        return value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else str(value)

    ddl = ", ".join(
        f"`{name}` {'double' if kind == 'number' else 'string'}" for name, kind in kinds.items()
    )
    rows = [(s, *(cell(s, name) for name in kinds)) for s in STATISTICS]
    return spark.createDataFrame(rows, f"statistic string, {ddl}")


# -- quality -----------------------------------------------------------------
def quality_issues(articles: DataFrame) -> DataFrame:
    """(issue, url) of articles with empty content or without an author."""
    empty, no_author = F.col("content") == "", F.col("author").isNull()
    issues = F.array_compact(
        F.array(F.when(empty, "empty_content"), F.when(no_author, "no_author"))
    )
    return articles.filter(empty | no_author).select(F.explode(issues).alias("issue"), "url")
