"""Profiles of columns that are kept per part of a dataset and merged.

A part (a batch, a partition, a run) has one row of counts, extremes, moments and
KLL sketches. Merging rows gives everything ``describe`` shows but the exact
quartiles, and ranges that hold those; one pass over the data then settles them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F

from presslake.operators import analytics
from presslake.operators.analytics import QUARTILES, RANKED_VALUES

SKETCH_K = 2048
MARGIN = 0.004  # of all ranks; more than twice the sketches' error at SKETCH_K


def _value(df: DataFrame, name: str, kind: str) -> str:
    return analytics._micros(name) if kind == "time" else f"`{name}`"


def profile_parts(df: DataFrame, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One row per part (columns ``by``) with a struct for each other column of ``df``.

    Rows may be stored, added to and replaced part by part; ``merged_profile`` reads
    them. ``k`` is the size of the sketches: about ``3 * k`` values a column.
    """
    columns = []
    names = [name for name in df.columns if name not in by]
    kinds = analytics.column_kinds(df.select(*names))
    for name, kind in kinds.items():
        col = F.col(f"`{name}`")
        fields = [F.count(col).alias("count"), F.count_if(col.isNull()).alias("null_count")]
        if kind in ("number", "time", "string"):
            fields += [F.min(col).alias("min"), F.max(col).alias("max")]
        if kind == "number":
            x = F.expr(f"cast(`{name}` as double)")
            fields += [F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2")]
            fields += [F.count_if(F.isnan(x)).alias("nans"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch")]
        if kind == "time":
            x = F.expr(_value(df, name, kind))
            fields += [F.sum(x.cast("decimal(38,0)")).alias("total"), F.kll_sketch_agg_bigint(x, F.lit(k)).alias("sketch")]
        columns.append(F.struct(*fields).alias(name))
    return df.groupBy(*by).agg(*columns)


def merged_profile(parts: DataFrame, kinds: dict[str, str]) -> dict[str, Row]:
    """The profile of all parts together, by column; ``bounds`` has two values a quartile."""
    first = []
    for name, kind in kinds.items():
        c = F.col(f"`{name}`")
        fields = [F.coalesce(F.sum(c[f]), F.lit(0)).alias(f) for f in ("count", "null_count")]
        if kind in ("number", "time", "string"):
            fields += [F.min(c["min"]).alias("min"), F.max(c["max"]).alias("max")]
        if kind == "number":
            fields += [(F.sum(c["mean"] * c["count"]) / F.sum(F.when(c["count"] > 0, c["count"]))).alias("mean")]
            fields += [F.coalesce(F.sum(c["nans"]), F.lit(0)).alias("nans"), F.kll_merge_agg_double(c["sketch"]).alias("sketch")]
        if kind == "time":
            fields += [F.sum(c["total"]).alias("total"), F.kll_merge_agg_bigint(c["sketch"]).alias("sketch")]
        first.append(F.struct(*fields).alias(name))
    merged = parts.agg(*first)
    ranks = F.array(*(F.lit(q) for _, p in QUARTILES for q in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))))
    shown = []
    for name, kind in kinds.items():
        c = F.col(f"`{name}`")
        if kind in ("number", "time"):
            get, n = (
                (F.kll_sketch_get_quantile_double, F.kll_sketch_get_n_double)
                if kind == "number"
                else (F.kll_sketch_get_quantile_bigint, F.kll_sketch_get_n_bigint)
            )
            bounds = F.when(n(c["sketch"]) > 0, get(c["sketch"], ranks))
            c = c.withField("bounds", bounds).dropFields("sketch")
        shown.append(c.alias(name))
    found = merged.select(*shown).first().asDict()
    # The squares around the common mean, from those around the parts' own means.
    numbers = [n for n, kind in kinds.items() if kind == "number" and found[n]["mean"] is not None]
    if numbers:
        squares = parts.agg(
            *(
                F.sum(F.expr(f"`{n}`.m2 + `{n}`.count * power(`{n}`.mean - double('{found[n]['mean']!r}'), 2)")).alias(n)
                for n in numbers
            )
        ).first()
        for n in numbers:
            found[n] = Row(**found[n].asDict(), m2=squares[n])
    return found


def _refined(df: DataFrame, kinds: dict[str, str], merged: dict[str, Row]) -> dict[str, list]:
    """Exact quartiles: one pass counts what lies below each range and the values inside."""
    ranges, settled = {}, {}
    for name, kind in kinds.items():
        if kind not in ("number", "time"):
            continue
        row = merged[name]
        nans = row["nans"] if kind == "number" else 0
        for i, (_, p) in enumerate(QUARTILES):
            rank = math.floor((row["count"] - 1) * p + 0.5) if row["count"] else None
            if rank is None:
                settled[name, i] = None
            elif rank >= row["count"] - nans:
                settled[name, i] = math.nan
            else:
                ranges[name, i] = [*row["bounds"][2 * i : 2 * i + 2], rank]
    keys = list(ranges)
    values = df.selectExpr(*(f"{_value(df, n, kinds[n])} as `_v {n}`" for n in {n for n, _ in keys}))
    marks = []
    for j, (name, i) in enumerate(keys):
        low, high, _ = ranges[name, i]
        v = F.col(f"_v {name}")
        # Below the range only the count matters, so the value is left out.
        marks.append(F.when(v < low, F.struct(F.lit(j).alias("j"), F.lit(None).cast("string").alias("v"))))
        marks.append(F.when((v >= low) & (v <= high), F.struct(F.lit(j).alias("j"), v.cast("string").alias("v"))))
    histogram = []
    if keys:
        hits = values.select(F.explode(F.array_compact(F.array(*marks))).alias("hit")).select("hit.*")
        limit = RANKED_VALUES * len(keys) + 1
        histogram = hits.groupBy("j", "v").agg(F.count("*").alias("n")).limit(limit).collect()
    missed = {}
    for j, key in enumerate(keys):
        parse, rank = type(ranges[key][0]), ranges[key][2]
        own = [r for r in histogram if r["j"] == j]
        rank -= sum(r["n"] for r in own if r["v"] is None)
        inside = sorted((parse(r["v"]), r["n"]) for r in own if r["v"] is not None)
        if len(histogram) > RANKED_VALUES * len(keys) or not 0 <= rank < sum(n for _, n in inside):
            missed.setdefault(key[0], []).append(key[1])
            continue
        for value, n in inside:
            if rank < n:
                settled[key] = value
                break
            rank -= n
    if missed:  # the sketch was off, or a range holds too many values for the driver
        probabilities = {name: [QUARTILES[i][1] for i in at] for name, at in missed.items()}
        exact, _ = analytics.exact_quantiles(df, probabilities)
        for name, at in missed.items():
            settled.update({(name, i): value for i, value in zip(at, exact[name])})
    out = {}
    for name, kind in kinds.items():
        if kind in ("number", "time"):
            got = [settled[name, i] for i in range(len(QUARTILES))]
            out[name] = [analytics._from_micros(v) if kind == "time" and isinstance(v, int) else v for v in got]
    return out


def describe_merged(df: DataFrame, parts: DataFrame) -> DataFrame:
    """What ``describe`` shows of ``df``, from the stored profiles of its parts and one pass over it."""
    kinds = analytics.column_kinds(df)
    merged = merged_profile(parts, kinds)
    stats = {}
    for name, kind in kinds.items():
        row = merged[name].asDict()
        stats |= {f"{s} {name}": row[s] for s in ("count", "null_count", "min", "max") if s in row}
        if kind == "number":
            stats[f"mean {name}"] = row["mean"]
            stats[f"std {name}"] = math.sqrt(row["m2"] / (row["count"] - 1)) if row["count"] > 1 else None
        if kind == "time":
            stats[f"mean {name}"] = int(row["total"] // row["count"]) if row["count"] else None
    return analytics.described(df.sparkSession, kinds, stats, _refined(df, kinds, merged))
