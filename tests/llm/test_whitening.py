import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from presslake.llm.queries import QUERIES
from presslake.llm.whitening import whiten

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("x", T.BinaryType()),
        T.StructField("n", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("whitened", T.DoubleType()),
    ]
)


def vectors(spark, rows):
    full = [(i, v and [c if c is None else float(c) for c in v], bytearray(b"x"), "n", "l", 0.5) for i, v in rows]
    return spark.createDataFrame(full, SCHEMA)


def brute(rows, counted=True, components=32):
    """Fit and whitened rows by exact fractions up to the covariance, then one dense decomposition."""
    out = {}
    whole = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    for length in {len(v) for _, v in whole}:
        grid = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in whole if len(v) == length]
        fit = [x for _, x in grid] if counted else [list(x) for x in {tuple(x) for _, x in grid}]
        n = len(fit)
        sums = [sum(col) for col in zip(*fit)]
        centred = [[x - Fraction(s, n) for x, s in zip(row, sums)] for row in fit]
        cov = [[float(sum(r[i] * r[j] for r in centred) / n) for j in range(length)] for i in range(length)]
        values, axes = np.linalg.eigh(np.array(cov))
        order = np.argsort(-values)[:components]
        for i, x in grid:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            z = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)]) @ axes[:, order]
            out.setdefault((i, length), []).append((n, deviation, z, values[order], values.sum()))
    return out


def check(found, expected):
    assert len(found) == sum(len(z) for rows in expected.values() for _, _, z, _, _ in rows)
    signs = {}
    for r in found:
        n, deviation, z, values, trace = next(iter(expected[r.vec_id, r.length]))
        c = r.component - 1
        assert (r.n, int(r.deviation)) == (n, deviation)
        if values[c] <= values.max() * 1e-13:
            assert r.whitened is None and r.explained == 0
            continue
        assert abs(r.explained - values[c] / trace) <= 1e-9
        assert r.identity_error <= 1e-9
        want = z[c] / math.sqrt(values[c])
        if abs(want) > 1e-6:
            sign = signs.setdefault((r.length, c), math.copysign(1, want * r.whitened))
            assert r.whitened == pytest.approx(sign * want, abs=1e-7)


def with_length(df, source):
    lengths = source.selectExpr("vec_id", "size(embedding) as length").distinct()
    return df.join(lengths, "vec_id").collect()


@pytest.mark.parametrize("counted", [True, False])
def test_matches_brute_force(spark, counted):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 6)) * [3, 1, 0.5, 2, 0.2, 1]
    rows = [(i, base[rng.integers(0, 40)].tolist()) for i in range(120)]
    rows += [(1000 + i, base[0].tolist()) for i in range(80)]  # one vector in many rows
    rows += [(2000, None), (2001, [1.0, None, 0, 0, 0, 0]), (2002, [math.nan, 1, 1, 1, 1, 1]), (2003, [math.inf] * 6)]
    rows += [(3000 + i, rng.normal(size=40).tolist()) for i in range(60)]  # another length, more than 32 components
    df = vectors(spark, rows)
    check(with_length(whiten(df, counted=counted), df), brute(rows, counted))


def test_edge_rows(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, None), (2, []), (3, [None])])).count() == 0
    same = whiten(vectors(spark, [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same] == [(3, 0, None, 0.0, 0.0)] * 6
    # One direction only; entries on the grid's edges and far away from each other.
    flat = whiten(vectors(spark, [(1, [0.0, 0.0]), (2, [1 / 64, 1 / 64]), (3, [-1e-9, -1e-9])])).collect()
    assert {r.whitened is None for r in flat if r.component == 2} == {True}
    far = whiten(vectors(spark, [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [3e300, 0.0])])).collect()
    assert {r.vec_id for r in far} == {1, 2}
    assert {int(r.deviation) for r in far} == {(64 * 2 * 10**15) ** 2 + 64**2}


def test_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r[0], [float(c) for c in r[1]]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = QUERIES["op13_whitening"](spark, sf_dir)
    assert set(found.columns) >= {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["n"] == "bigint"
    df = vectors(spark, rows[:0]).select("vec_id", "embedding").unionByName(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    fast = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows])
    centred = fast - fast.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fast))
    expected = {
        (i, 64): [(len(fast), int(((len(fast) * x - fast.sum(axis=0)) ** 2).sum()), (x - fast.mean(axis=0)) @ axes[:, ::-1][:, :32], values[::-1][:32], values.sum())]
        for (i, _), x in zip(rows, fast)
    }
    check(with_length(found, df), expected)
