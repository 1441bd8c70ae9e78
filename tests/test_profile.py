import datetime as dt
import math
import random

import pytest

from presslake.operators import profile
from presslake.operators.analytics import describe
from presslake.operators.profile import describe_merged, profile_parts

DDL = "part int, i long, x double, t timestamp_ntz, s string, l array<int>, e double"


def rows(n, seed=1):
    rng = random.Random(seed)
    for k in range(n):
        x = None if k % 11 == 0 else math.nan if k % 13 == 0 else rng.gauss(0, 1e3)
        t = None if k % 7 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**13))
        yield rng.randrange(5), rng.randrange(50) ** 3, x, t, rng.choice(["a", "b", None]), [1], None


def shown(df):
    return [tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()]


def same(a, b):
    for x, y in zip(shown(a), shown(b), strict=True):
        assert [v if not isinstance(v, float) else pytest.approx(v, rel=1e-12, abs=2e-6) for v in x] == list(y)


@pytest.mark.parametrize("n", [0, 1, 2, 400, 30_000])
def test_equals_the_plain_profile(spark, n):
    df = spark.createDataFrame(list(rows(n)), DDL)
    same(describe_merged(df.drop("part"), profile_parts(df, ["part"])), describe(df.drop("part")))


def test_parts_may_come_in_any_cut(spark, tmp_path):
    df = spark.createDataFrame(list(rows(3000)), DDL)
    path = str(tmp_path / "parts")
    for cut in ("i < 1000", "i >= 1000 and i < 50000", "i >= 50000", "i < 0"):
        profile_parts(df.where(cut), ["part"]).write.mode("append").parquet(path)
    same(describe_merged(df.drop("part"), spark.read.parquet(path)), describe(df.drop("part")))


def test_small_sketches_and_crowded_ranges_fall_back(spark, monkeypatch):
    df = spark.createDataFrame(list(rows(20_000)), DDL)
    expected = describe(df.drop("part"))
    same(describe_merged(df.drop("part"), profile_parts(df, ["part"], k=8)), expected)
    monkeypatch.setattr(profile, "RANKED_VALUES", 5)
    same(describe_merged(df.drop("part"), profile_parts(df, ["part"])), expected)
