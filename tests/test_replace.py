import random
import re

import pytest

from presslake.functions.replace import replace_many, trie_pattern


def brute(text, keys):
    out, i = [], 0
    while i < len(text):
        hit = max((k for k in keys if text.startswith(k, i)), key=len, default=None)
        out.append(keys[hit] if hit else text[i])
        i += len(hit) if hit else 1
    return "".join(out)


@pytest.mark.parametrize(
    ("keys", "cases"),
    [
        ({"a": "b", "b": "c"}, {"ab": "bc", "aab": "bbc", "": "", "x": "x"}),
        ({"ab": "1", "abc": "2", "bcd": "3"}, {"abcd": "2d", "abd": "1d", "abbcd": "13", "bcabc": "bc2"}),
        ({".": "-", "a.b": "+", "$": "$1\\", "\\": "/", "[": "(", "a-z": "q"}, {"a.b.$\\[a-z": "+-$1\\/(q", "axb": "axb"}),
        ({"يناير": "01", "يونيو": "06", "يوليو": "07", "يو": "?"}, {"1 يوليو 2": "1 07 2", "يونيو": "06", "يوم": "?م"}),
        ({"😀": "s", "\n": " ", "é": "e"}, {"a😀\né": "as e"}),
        ({"x": ""}, {"xx": "", "axb": "ab"}),
    ],
)
def test_cases(spark, keys, cases):
    rows = spark.createDataFrame(list(cases.items()), "text string, expected string")
    for row in rows.select("text", "expected", replace_many("text", keys).alias("got")).collect():
        assert row.got == row.expected == brute(row.text, keys)


def test_random_keys(spark):
    rng = random.Random(4)
    for _ in range(6):
        keys = {"".join(rng.choice("ab.|") for _ in range(rng.randint(1, 4))): rng.choice(["", "a", "$0", "b."]) for _ in range(8)}
        texts = ["".join(rng.choice("abc.|") for _ in range(rng.randint(0, 30))) for _ in range(100)]
        rows = spark.createDataFrame([(t,) for t in texts], "text string")
        assert [r.got for r in rows.select(replace_many("text", keys).alias("got")).collect()] == [brute(t, keys) for t in texts]


def test_null_and_empty_keys(spark):
    rows = spark.createDataFrame([(None,)], "text string")
    assert rows.select(replace_many("text", {"a": "b"})).first()[0] is None
    for keys in ({}, {"": "x"}):
        with pytest.raises(ValueError):
            replace_many("text", keys)


def test_words_share_their_beginnings():
    words = ["abc", "abd", "ab", "x"]
    pattern = trie_pattern(words)
    assert pattern == "(?:ab(?:c|d)?|x)" and all(re.fullmatch(pattern, w) for w in words)
