"""Random records, each field made together with the value it must become."""

import json
import random

import pytest

from presslake.operators.normalize import classify
from presslake.schema import SCALAR_FIELDS

# JSON text -> text of the article field (None: no value).
SCALARS = {
    "null": None, '""': None, '"  "': None, '"\\u3000\\n"': None,
    '"a"': "a", '" a "': "a", '"\\u3000x\\n"': "x", '"ق "': "ق", '"null"': "null", '"\\"q\\\\"': '"q\\',
    '"true"': "true", '"1.0"': "1.0", '"1E5"': "1E5", '"1.0E16"': "1.0E16", '"[1]"': "[1]",
    "true": "True", "false": "False",
    "0": "0", "7": "7", "-12": "-12", "12345678901234567890": "12345678901234567890",
    "1.0": "1.0", "1.5": "1.5", "-2.25": "-2.25", "123456.789": "123456.789",
    "1e16": "1e+16", "1.5e-7": "1.5e-07", "2E3": "2000.0", "1e400": "inf", "-1E400": "-inf",
    "100000000000000000000.0": "1e+20", "0.1": "0.1",
}
NESTED = {"[]": "[]", "{}": "{}", '[1,"x"]': '[1,"x"]', '{"k":null}': '{"k":null}', "[[]]": "[[]]"}
# A tag keeps what a text field would turn into NULL, but for null itself.
TAGS = {k: v for k, v in SCALARS.items() if v is not None} | {'""': "", '"  "': "", "null": None}
NO_TAGS = ["null", '"a"', '"[1]"', "5", "{}", '{"a":1}', "true", "[]"]
# JSON text of a media item -> its row (None: dropped).
ITEMS = {
    "null": None, '"text"': None, "5": None, "true": None, "[]": None, "[1]": None,
    "{}": (None, None, None, None, "internal"),
    '{"provider":null}': (None,) * 5,
    '{"provider":" p ","extra":1}': (None, None, None, None, " p "),
    '{"type":"image","url":"u","alt":"","caption":" v "}': ("image", "u", "", " v ", "internal"),
    '{"url":3,"alt":null,"provider":"external"}': (None, "3", None, None, "external"),
}
FALSY = ["null", '""', "0", "false", "{}", "[]"]
TRUTHY = ['"x"', "1", "true", '{"a":1}']


def items(rng):
    chosen = [rng.choice(list(ITEMS)) for _ in range(rng.randint(1, 3))]
    return f"[{','.join(chosen)}]", [ITEMS[c] for c in chosen if ITEMS[c] is not None]


def media(rng):
    """JSON of the two media fields, and the media rows."""
    kind = rng.randrange(5)
    if kind == 0:
        return {}, []
    text, rows = items(rng)
    other, _ = items(rng)
    if kind == 1:
        return {"media": text, "images": other}, rows
    if kind == 2:
        return {"media": rng.choice(FALSY), "images": text}, rows
    if kind == 3:
        return {"images": text}, rows
    return {"media": rng.choice(TRUTHY), "images": text}, []


def record(rng):
    """A line, and the reason and the article it must give."""
    fields, article = {}, dict.fromkeys(SCALAR_FIELDS)
    for name in SCALAR_FIELDS:
        if name in ("article_id", "url") and rng.random() < 0.8:
            fields[name], article[name] = '" k"', "k"
        elif rng.random() < 0.5:
            pool = SCALARS | (NESTED if name in ("title", "author") else {})
            fields[name] = rng.choice(list(pool))
            article[name] = pool[fields[name]]
    article["tags"] = []
    if rng.random() < 0.3:
        fields["tags"] = rng.choice(NO_TAGS)
    elif rng.random() < 0.7:
        chosen = [rng.choice(list(TAGS)) for _ in range(rng.randint(1, 4))]
        fields["tags"] = f"[{','.join(chosen)}]"
        article["tags"] = [TAGS[c] for c in chosen if TAGS[c] is not None]
    more, article["media"] = media(rng)
    fields |= more
    pairs = [f'"{name}":{value}' for name, value in fields.items()]
    rng.shuffle(pairs)
    alive = article["article_id"] is not None and article["url"] is not None
    reason = "falsy" if not pairs else "ok" if alive else "ghost"
    return "{" + rng.choice([",", ", "]).join(pairs) + "}", reason, article


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_random_records(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_random_records(spark)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def check_random_records(spark):
    rng = random.Random(11)
    made = [record(rng) for _ in range(3000)]
    lines = [line if rng.random() < 0.9 else f" {line}\t" for line, _, _ in made]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, value string").repartition(8)
    rows = {row.seq: row for row in classify(df).collect()}
    for seq, (line, reason, article) in enumerate(made):
        row = rows[seq]
        assert row.reason == reason, line
        if reason == "falsy":
            continue
        for name in SCALAR_FIELDS:
            assert row[name] == article[name], (name, line)
        assert row.tags == article["tags"], line
        assert [tuple(m) for m in row.media] == article["media"], line
    assert sum(reason == "ok" for _, reason, _ in made) > 1500


def test_random_damage_is_never_an_article(spark):
    """Cut or extended lines are malformed exactly where Python's reader rejects them."""
    rng = random.Random(12)
    whole = [json.dumps({"article_id": i, "url": "u", "tags": ["a"], "media": [{"url": "m"}]}) for i in range(60)]
    damaged = []
    for line in whole:
        cut = rng.randint(1, len(line) - 1)
        damaged += [line[:cut], line[cut:], line[:cut] + rng.choice('{}[]",:x 0') + line[cut:], line + rng.choice('}],"x0{')]
    df = spark.createDataFrame(list(enumerate(damaged)), "seq long, value string").coalesce(4)
    rows = {row.seq: row.reason for row in classify(df).collect()}
    for seq, line in enumerate(damaged):
        try:
            json.loads(line)
        except json.JSONDecodeError:
            assert rows[seq] == "malformed", line
        else:
            assert rows[seq] != "malformed", line
