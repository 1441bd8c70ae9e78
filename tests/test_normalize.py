"""The record truth table: one line in, one article or one reject reason out."""

import json

from pyspark.sql import functions as F

from presslake.operators.normalize import classify, normalize, reject_report
from presslake.schema import ARTICLE_COLUMNS

GOOD = {"article_id": "1", "url": "http://x/1"}


# line -> reject reason
REASONS = {
    "": "malformed",
    "   ": "malformed",
    '{"article_id": 1, "url"': "malformed",
    '{"article_id": 1, "url": "u"} trailing': "malformed",
    '{"article_id": 1, "url": "u"} }': "malformed",
    '{"article_id": 1, "url": "u"}{"article_id": 2, "url": "u"}': "malformed",
    '{"article_id": 1, "url": "u"},{"article_id": 2, "url": "u"}': "malformed",
    '{"article_id": 1, "url": "u"}}': "malformed",
    "null x": "malformed",
    "{'article_id': 1, 'url': 'u'}": "malformed",
    '{"article_id": NaN, "url": "u"}': "malformed",
    '{"article_id": "1", "url": "a\tb"}': "malformed",
    "null": "falsy",
    "{}": "falsy",
    "{ }": "falsy",
    "[]": "falsy",
    "0": "falsy",
    "0.0": "falsy",
    '""': "falsy",
    "false": "falsy",
    "5": "not_object",
    '"x"': "not_object",
    "[1]": "not_object",
    '[{"article_id": "1", "url": "u"}]': "not_object",
    "true": "not_object",
    '{"article_id": null, "url": "u"}': "ghost",
    '{"article_id": "\\u00a0 ", "url": "u"}': "ghost",
    '{"article_id": "1"}': "ghost",
    '{"Article_ID": "1", "url": "u"}': "ghost",
    '{"article_id": "1", "url": "u"}': "ok",
    '  {"article_id": "1", "url": "u"} \r': "ok",
}

# JSON value -> text
TEXTS = {
    "123": "123",
    "-0": "0",
    "1.0": "1.0",
    "1.50": "1.5",
    "0.1": "0.1",
    "12345678.9": "12345678.9",
    "1e5": "100000.0",
    "1e16": "1e+16",
    "1.5e-7": "1.5e-07",
    "2.5e10": "25000000000.0",
    "1e-4": "0.0001",
    "1E400": "inf",
    "-1e999": "-inf",
    "100000000000000000000.0": "1e+20",
    "12345678901234567890": "12345678901234567890",
    "1e100": "1e+100",
    "true": "True",
    "false": "False",
    '"true"': "true",
    '"1.0E16"': "1.0E16",
    '"1.0"': "1.0",
    '" a b "': "a b",
    '"\\u00a0x\\u3000"': "x",
}

IMG = {"type": "image", "url": "i", "alt": "a", "caption": None, "provider": "external"}
OLD = {"type": "featured", "url": "o", "alt": None, "caption": "c"}
IMG_ROW = ("image", "i", "a", None, "external")
OLD_ROW = ("featured", "o", None, "c", "internal")

# extra fields of a record -> expected fields of the article
RECORDS = [
    ({"title": "  ", "author": None, "category": " c "}, {"title": None, "author": None, "category": "c"}),
    ({"title": {"a": [1, 2]}}, {"title": '{"a":[1,2]}'}),
    ({"tags": ["a ", None, 3, "", 1.0]}, {"tags": ["a", "3", "", "1.0"]}),
    ({"tags": ["a ", None, True, "true", 1e20]}, {"tags": ["a", "True", "true", "1e+20"]}),
    ({"tags": "[1]"}, {"tags": []}),
    ({"tags": None}, {"tags": []}),
    ({"tags": 7}, {"tags": []}),
    ({"tags": {"a": 1}}, {"tags": []}),
    ({"tags": []}, {"tags": []}),
    ({}, {"tags": [], "media": []}),
    ({"media": [IMG]}, {"media": [IMG_ROW]}),
    ({"images": [OLD]}, {"media": [OLD_ROW]}),
    *(({"media": falsy, "images": [IMG]}, {"media": [IMG_ROW]}) for falsy in ([], {}, "", 0, 0.0, False, None)),
    *(({"media": truthy, "images": [IMG]}, {"media": []}) for truthy in ({"a": 1}, "x", 5, True)),
    ({"media": [IMG, None, OLD]}, {"media": [IMG_ROW, OLD_ROW]}),
    (
        {"media": [IMG, "text", 5, None, {"url": 7}, {"url": "n", "provider": None, "extra": 1}]},
        {"media": [IMG_ROW, (None, "7", None, None, "internal"), (None, "n", None, None, None)]},
    ),
    ({"images": [{"url": "n", "provider": None}]}, {"media": [(None, "n", None, None, None)]}),
    ({"content": "\n x\ny "}, {"content": "x\ny"}),
]


def as_lines(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq long, value string").coalesce(1)


def articles(spark, values):
    return {row.seq: row for row in normalize(as_lines(spark, values)).collect()}


def test_reasons(spark):
    lines = as_lines(spark, REASONS)
    got = [row.reason for row in classify(lines).orderBy("seq").collect()]
    assert dict(zip(REASONS, got)) == REASONS
    assert normalize(lines).count() == list(REASONS.values()).count("ok")


def test_scalar_text_is_python_str(spark):
    for raw, text in TEXTS.items():
        assert str(json.loads(raw)).strip() == text
    rows = articles(spark, ['{"article_id": %s, "url": "u"}' % raw for raw in TEXTS])
    assert dict(zip(TEXTS, (rows[i].article_id for i in range(len(TEXTS))))) == TEXTS


def test_records(spark):
    lines = [json.dumps({**GOOD, **extra}, ensure_ascii=False) for extra, _ in RECORDS]
    rows = articles(spark, lines)
    for i, (extra, expected) in enumerate(RECORDS):
        got = rows[i].asDict()
        got["media"] = [tuple(item) for item in got["media"]]
        assert {name: got[name] for name in expected} == expected, extra


def test_duplicate_keys_last_wins(spark):
    lines = [
        '{"article_id":"1","article_id":"2","url":"u"}',
        '{"article_id":"1","article_id":"2","url":"u","tags":[true]}',
    ]
    assert [r.article_id for r in articles(spark, lines).values()] == ["2", "2"]


def test_schema_and_idempotence(spark):
    lines = as_lines(spark, [json.dumps({**GOOD, "tags": ["a"], "media": [IMG], "zzz": 1})])
    once = normalize(lines).select(*ARTICLE_COLUMNS)
    again = normalize(once.select(F.to_json(F.struct(*ARTICLE_COLUMNS)).alias("value")))
    assert once.collect() == again.collect()


def test_line_is_parsed_once(spark):
    plan = normalize(as_lines(spark, ["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # the typed reading, and the second look at odd records


def test_reject_report(spark):
    ok = json.dumps(GOOD)
    lines = as_lines(spark, ["", "null", "5", '{"a":1}', ok, ok, ok, json.dumps({**GOOD, "article_id": 2})])
    got = {r.reason: r.n_lines for r in reject_report(lines.withColumn("f", F.lit("x")), ["f"]).collect()}
    assert got == {"malformed": 1, "falsy": 1, "not_object": 1, "ghost": 1, "ok": 2, "duplicate": 2}


def test_long_values_are_kept(spark):
    """Long strings and numbers, in plain and in odd records, whatever columns are read."""
    body, digits = "x" * 25_000_000, "9" * 1100
    lines = [
        '{"article_id":"1","url":"u","content":"%s"}' % body,
        '{"article_id":true,"url":"u","content":"%s"}' % body,
        '{"article_id":"3","url":"u","other":%s,"title":%s}' % (digits, digits),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = {r.article_id: r for r in classify(df).selectExpr("article_id", "reason", "length(content) as n", "title").collect()}
    assert {k: (r.reason, r.n) for k, r in rows.items()} == {
        "1": ("ok", 25_000_000), "True": ("ok", 25_000_000), "3": ("ok", None)
    }
    assert rows["3"].title == digits
    for columns in (["article_id"], ["article_id", "tags"], ["content"]):
        kept = normalize(df, columns=columns)
        assert kept.count() == 3


def test_a_huge_member_that_is_not_needed_loses_nothing(spark):
    """Odd records are read again as VARIANT, which ends at 128 MiB; members that nobody asked for do not count."""
    huge = F.concat(F.lit('{"article_id": true, "url": " u", "extra": "'), F.expr("repeat('x', 140000000)"), F.lit('"}'))
    row = normalize(spark.range(1).select(huge.alias("value")), columns=["article_id", "url"]).first()
    assert (row.article_id, row.url) == ("True", "u")
