"""The pipeline on small tables, stage by stage against brute force."""

import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from cases import EDGES, documents
from presslake.llm.bpe import read_ranks
from test_decontaminate import brute as contaminated
from test_exact_dedup import LOWER
from test_near_dup import brute as near

COLUMNS = documents.__globals__["DOCUMENTS"].fieldNames()


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoin shrdlu".replace(" ", "")) for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(30, 90)))) for i in range(60)]
    rows += [(100 + i, rows[i][1].upper()) for i in range(8)]
    rows += [(200 + i, rows[10 + i][1] + " addition") for i in range(8)]
    rows += [(300, "!!! 123 ???"), (301, None), (302, ""), (303, "")]
    rows += [(400, rows[40][1] + " " + BENCH[0][1] + " tail"), (401, rows[41][1])]
    return rows


BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "zz yy")]


@pytest.fixture
def tables(spark, tmp_path):
    def write(rows):
        documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return write


def expected(rows):
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    last = {}
    for i, t in rows:
        last[t.translate(LOWER)] = max(i, last.get(t.translate(LOWER), i))
    rows = [r for r in rows if last[r[1].translate(LOWER)] == r[0]]
    classes = near(rows)
    rows = [r for r in rows if classes[r[0]][0] == r[0]]
    hit = {doc for doc, _, n, _ in contaminated(rows, BENCH) if n}
    return [r for r in rows if r[0] not in hit]


def test_against_brute_force(spark, tables):
    rows = corpus()
    out = corpus_pipeline.run(spark, tables(rows)).collect()
    kept = expected(rows)
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in kept)
    known = tiktoken.Encoding(
        "t",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    texts = dict(kept)
    assert all(list(r.ids) == known.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in out)


def test_every_stage_on_edge_rows(spark, tables):
    sf_dir = tables(EDGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == COLUMNS
        assert out.count() <= docs.count()
    kept = corpus_pipeline.exact(spark, docs, sf_dir).select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.text[:3]) for r in kept if r.doc_id in (6, 7, 8)) == [(8, "Ano"), (8, "THE")]
    assert sum(r.doc_id is None for r in kept) == 1  # the null text without id is an empty text, like rows 1 and 2


def test_near_stage_tells_rows_of_one_id_apart(spark, tables):
    rows = corpus()
    texts = [rows[i][1] for i in range(3)]
    sf_dir = tables([(1, texts[0]), (5, texts[0] + " addition"), (5, texts[1]), (None, texts[0] + " more"), (7, texts[2])])
    kept = corpus_pipeline.near(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(
        [("1", texts[0]), ("5", texts[1]), ("None", texts[0] + " more"), ("7", texts[2])]
    )


def test_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables([])).count() == 0
