import random
import re
from urllib.parse import parse_qsl, quote


from pyspark.sql import functions as F

from presslake.functions.urls import canonical_url, url_fingerprint

CASES = [
    ("http://a.com", "http://a.com/"),
    ("HTTP://User@A.Com:80/", "http://User@a.com/"),
    ("https://a.com:443/x", "https://a.com/x"),
    ("https://a.com:80/x", "https://a.com:80/x"),
    ("http://a.com:/x", "http://a.com/x"),
    ("http://a.com:8080", "http://a.com:8080/"),
    ("ftp://a.com:21/x", "ftp://a.com/x"),
    ("http://[::1]:80/x", "http://[::1]/x"),
    ("http://a.com/a/./b", "http://a.com/a/b"),
    ("http://a.com/a/../b", "http://a.com/b"),
    ("http://a.com/../../b", "http://a.com/b"),
    ("http://a.com/a/b/..", "http://a.com/a/"),
    ("http://a.com/a/.", "http://a.com/a/"),
    ("http://a.com/a/%2e%2E/b", "http://a.com/b"),
    ("http://a.com/...", "http://a.com/..."),
    ("http://a.com/a//b/", "http://a.com/a//b/"),
    ("http://a.com/%7euser/%41", "http://a.com/~user/A"),
    ("http://a.com/a%2fb", "http://a.com/a%2Fb"),
    ("http://a.com/قصة", "http://a.com/%D9%82%D8%B5%D8%A9"),
    ("http://a.com/%d9%82", "http://a.com/%D9%82"),
    ("http://a.com/a b", "http://a.com/a%20b"),
    ("http://a.com/100%", "http://a.com/100%25"),
    ("http://a.com/%zz", "http://a.com/%25zz"),
    ("http://a.com/(x);y=1,2*3!$&'+@:", "http://a.com/(x);y=1,2*3!$&'+@:"),
    ("http://a.com/?b=2&a=1", "http://a.com/?a=1&b=2"),
    ("http://a.com/?a=2&a=1&a", "http://a.com/?a=&a=1&a=2"),
    ("http://a.com/?a-b=1&a=1", "http://a.com/?a=1&a-b=1"),
    ("http://a.com/?&&a=1&", "http://a.com/?a=1"),
    ("http://a.com/?", "http://a.com/"),
    ("http://a.com/?q=a+b%20c%2Bd", "http://a.com/?q=a+b+c%2Bd"),
    ("http://a.com/?u=http://b.com/?x", "http://a.com/?u=http%3A%2F%2Fb.com%2F%3Fx"),
    ("http://a.com/?x=a=b", "http://a.com/?x=a%3Db"),
    ("http://a.com/#top", "http://a.com/"),
    ("http://a.com/x#a?b=1", "http://a.com/x"),
    ("  http://a.com/x \n", "http://a.com/x"),
    ("mailto:A@b.com", "mailto:A@b.com"),
    ("../x", "../x"),
    ("", ""),
    (None, None),
]


def canonical(spark, urls):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, url string")
    return [r.c for r in rows.select("i", canonical_url("url").alias("c")).orderBy("i").collect()]


def test_cases(spark):
    assert canonical(spark, [u for u, _ in CASES]) == [c for _, c in CASES]


def test_normal_form_is_stable(spark):
    once = [c for _, c in CASES if c]
    assert canonical(spark, once) == once


def test_random_paths_and_queries_like_the_standard_library(spark):
    rng = random.Random(7)
    path_parts = ["a", "b c", "..", ".", "%7E", "%2f", "é", "x%", "", "~", "%e9"]
    values = ["", "1", "a b", "a+b", "%20", "%41", "é", "=", "%26", "~*"]
    urls, expected = [], []
    for _ in range(400):
        path = "/" + "/".join(rng.choice(path_parts) for _ in range(rng.randint(1, 6)))
        query = "&".join(rng.choice("xyz") + rng.choice(["", "="]) + rng.choice(values) for _ in range(rng.randint(0, 4)))
        urls.append(f"http://h.com{path}?{query}#f")
        known = re.sub(r"%([0-9a-fA-F]{2})", lambda m: chr(int(m[1], 16)) if re.match(r"[A-Za-z0-9._~-]", chr(int(m[1], 16))) else m[0].upper(), path)
        known = quote(re.sub(r"%(?![0-9A-F]{2})", "%25", known), safe="%/!$&'()*+,;=:@")
        joined = known
        if re.search(r"(^|/)\.\.?(/|$)", known):
            out = []
            for segment in known.split("/")[1:]:
                if segment == "..":
                    out = out[:-1]
                elif segment != ".":
                    out.append(segment)
            if known.split("/")[-1] in (".", ".."):
                out.append("")
            joined = "/" + "/".join(out)
        pairs = sorted((quote(k.encode("latin-1"), safe="").replace("%20", "+"), quote(v.encode("latin-1"), safe="").replace("%20", "+"))
                       for k, v in parse_qsl(query.encode("utf-8").decode("latin-1"), keep_blank_values=True, encoding="latin-1"))
        tail = "&".join(f"{k}={v}" for k, v in pairs)
        expected.append(f"http://h.com{joined}" + (f"?{tail}" if tail else ""))
    assert canonical(spark, urls) == expected


def test_fingerprints(spark):
    rows = spark.createDataFrame([("http://a.com/?b&a=1#x",), ("HTTP://A.com:80/./?a=1&b=",), ("http://a.com/?a=1",), (None,)], "url string")
    found = [r[0] for r in rows.select(url_fingerprint("url")).collect()]
    assert found[0] == found[1] != found[2] and len(found[0]) == 32 and found[3] is None


def test_random_escapes_like_a_walk_over_the_text(spark):
    """Stray per cent signs, escapes beside each other and escapes in lower case, one character at a time."""
    own = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")

    def walked(text):
        out, at = "", 0
        while at < len(text):
            if re.match("%[0-9A-Fa-f]{2}", text[at:]):
                char = chr(int(text[at + 1 : at + 3], 16))
                out, at = out + (char if char in own else text[at : at + 3].upper()), at + 3
            else:
                out, at = out + quote(text[at], safe="!$&'()*+,;=:@~"), at + 1
        return out

    rng = random.Random(11)
    texts = ["x" + "".join(rng.choice(["%", "%", "4", "1", "a", "F", "%7e", "%c3", "%25", "~", "é", "😀", " ", "*", "+", ","]) for _ in range(25)) + "x" for _ in range(400)]
    assert canonical(spark, [f"http://h.com/{t}" for t in texts]) == [f"http://h.com/{walked(t)}" for t in texts]


def test_a_url_is_encoded_once_a_part(spark):
    """The path, and the name and value of a parameter; the path once more where there is no host."""
    rows = spark.createDataFrame([("http://a.com/./x?b=1",)], "url string").select(canonical_url("url").alias("c"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("UrlCodec.encode(") <= 4
