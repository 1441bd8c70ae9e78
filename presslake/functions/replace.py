"""Simultaneous replacement of many patterns, as one Column expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

_SPECIAL = set("\\^$.|?*+()[]{}-&#~ \t\n\r\f\v")


def _quoted(char: str) -> str:
    return f"\\x{{{ord(char):x}}}" if char in _SPECIAL else char


def trie_pattern(words: list[str]) -> str:
    """A regular expression for exactly these words that takes the longest one at a place.

    Words that begin alike share their beginning, so a place is tried once for all
    of them, not once for each word.
    """
    if not words or any(not word for word in words):
        raise ValueError("patterns must not be empty")
    trie: dict = {}
    for word in words:
        node = trie
        for char in word:
            node = node.setdefault(char, {})
        node[""] = True

    def spelled(node: dict) -> str:
        branches = [_quoted(char) + spelled(node[char]) for char in sorted(k for k in node if k)]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else f"(?:{'|'.join(branches)})"
        return body + ("?" if "" in node else "")

    return spelled(trie)


def replace_many(col: Column | str, replacements: Mapping[str, str]) -> Column:
    """``col`` with every key replaced by its value, all at once.

    Matches are taken from left to right, do not overlap, and at one place the
    longest key wins. What was put in is not looked at again: with ``a`` to ``b``
    and ``b`` to ``c``, ``ab`` becomes ``bc``. The text is searched twice with one
    expression, however many keys there are; NULL stays NULL.
    """
    pattern = F.lit(trie_pattern(list(replacements)))
    texts = F.create_map(*[F.lit(x) for item in replacements.items() for x in item])
    between = F.split(col, pattern, -1)
    found = F.transform(F.regexp_extract_all(col, pattern, F.lit(0)), lambda match: texts[match])
    parts = F.zip_with(between, found, lambda text, new: F.concat(text, F.coalesce(new, F.lit(""))))
    return F.array_join(parts, "")
