import random
from urllib.parse import unquote

from pyspark.sql import functions as F

from presslake.functions.text import (
    WHITESPACE,
    host_of,
    in_domain,
    label_for,
    last_segment,
    media_provider,
    url_key,
    ustrip,
)
from presslake.schema import CATEGORY_LABELS


def column(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, s string")


def apply(spark, values, expression):
    rows = column(spark, values).select("i", expression.alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def test_whitespace_is_pythons():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_ustrip_equals_python(spark):
    rng = random.Random(7)
    alphabet = list(WHITESPACE) + ["a", "é", "ق", "​", "\U0001d11e"]
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(3000)]
    assert apply(spark, values, ustrip("s")) == [v.strip() for v in values]


def test_url_key_equals_python(spark):
    rng = random.Random(8)
    parts = ["a", "+", "%20", "%zz", "%", "%4", "%D8%A7", "ا", " ", " ", "/", "?", "%FF", "%E2%82", "%2B", "%25"]
    values = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(3000)]
    assert apply(spark, values, url_key("s")) == [unquote(v.strip()) for v in values]


def test_host_and_domain(spark):
    cases = {
        "http://example.com/x": ("example.com", True),
        "https://WWW.Example.com:8080/x": ("www.example.com", True),
        "https://u:p@img.example.com?q=1": ("img.example.com", True),
        "https://notexample.com/": ("notexample.com", False),
        "https://example.com.evil.org/": ("example.com.evil.org", False),
        "https://example.com/a b": ("example.com", True),
        "/relative": (None, None),
        "": (None, None),
    }
    assert apply(spark, cases, host_of("s")) == [host for host, _ in cases.values()]
    assert apply(spark, cases, in_domain("s", "example.com")) == [own for _, own in cases.values()]


def test_media_provider(spark):
    cases = {
        "https://img.example.com/1.jpg": "internal",
        "https://cdn.other.com/static/1.jpg": "internal",
        "https://www.videos.org/embed/x": "external",
        "": "unknown",
    }
    assert apply(spark, cases, media_provider(F.col("s"), "example.com")) == list(cases.values())
    assert apply(spark, [None], media_provider(F.col("s"), "example.com")) == ["unknown"]


def test_last_segment(spark):
    urls = ["https://x/a/b", "b", "https://x/a/", "a/ب"]
    assert apply(spark, urls, last_segment("s")) == [u.split("/")[-1] for u in urls]


def test_labels(spark):
    keys = ["art", "nope", None]
    assert apply(spark, keys, label_for(F.col("s"), CATEGORY_LABELS)) == ["فن", "unknown", "unknown"]
