"""Rows that every operator on documents must survive."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        T.StructField("key", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("node", T.LongType()),
        T.StructField("label", T.IntegerType()),
    ]
)


def documents(spark, rows):
    """A documents table with clashing extra columns from ``(doc_id, text)`` or ``(doc_id, text, lang)``."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), "k", 0.5, 7, 1) for r in rows
    ]
    return spark.createDataFrame(full, DOCUMENTS)


LONG = " ".join(f"word{i % 977} Über{i % 31}" for i in range(60_000))

EDGES = [
    (None, "A text without an id, long enough to be compared with others by its words and bytes."),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "12 34 !?"),
    (5, "One two three."),
    (6, "The very same text stands in several rows of this table, and it is not short."),
    (7, "The very same text stands in several rows of this table, and it is not short."),
    (7, "The very same text stands in several rows of this table, and it is not short."),
    (8, "THE VERY same text stands in several rows of this table, and it is not short."),
    (8, "Another text under the same id; it has words of its own and nothing is shared."),
    (9, LONG),
    (10, "日本語のテキスト и кириллица mixed with ASCII words here and there today."),
]
