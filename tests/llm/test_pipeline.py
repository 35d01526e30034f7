import os
import random

import corpus_pipeline
import pytest

from riskweave.llm import bpe
from riskweave.llm.queries import vocabulary_path
from riskweave.session import scratch_dir
from tests.llm.test_similarity import components, leaked
from tests.llm.test_text_filters import sentences


@pytest.fixture
def folder(spark, make, tmp_path):
    r = random.Random(3)
    rows = [(i, sentences("aa", 60, i), "aa", "h") for i in range(12)] + [(20 + i, sentences("cc", 60, 50 + i), "cc", "h") for i in range(12)]
    item = sentences("aa", 30, 99)
    rows += [(40, rows[0][1], "aa", "h"), (41, rows[0][1] + " extra", "aa", "k"), (42, sentences("cc", 80, 7) + " " + item, "cc", "h")]
    rows += [(43, "".join(chr(0x4E00 + r.randrange(4000)) for _ in range(200)), None, None), (44, None, "aa", None), (45, "", "aa", "h")]
    rows += [(50 + i, f"{sentences('aa', 20, 300 + i)}\ncopyright line number {i} of this site here", "aa", "h") for i in range(6)]
    rows += [(60, rows[1][1], "aa", "h"), (60, rows[1][1], "aa", "h"), (61, sentences("aa", 30, 5000), "aa", "h"), (61, sentences("aa", 30, 5000), "aa", "h")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, item


def stage(spark, name, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages_keep_columns_and_run_chains_them(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, fn in corpus_pipeline.STAGES[:-1]:
        assert fn(spark, docs, path).columns == docs.columns, name
    ids = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, path).collect())
    assert ids == sorted([*range(12), *range(20, 32), *range(50, 56), 61])


def test_each_stage_against_brute_force(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(stage(spark, "language identification", docs, path)) == sorted(r[0] for r in rows if r[0] not in (43, 44, 45))
    best = {i: c for i, _, c in components([r[:2] for r in rows])}
    near = sorted({r[0] for r in rows if best[r[0]] == r[0]})
    assert ids(stage(spark, "n-gram near duplicates", docs, path)) == near
    bad = {d for d, *_ in leaked([r[:2] for r in rows], [(0, item)])}
    assert bad == {42} and ids(stage(spark, "benchmark decontamination", docs, path)) == sorted(r[0] for r in rows if r[0] not in bad)
    lines = {r["doc_id"]: r["text"] for r in stage(spark, "line deduplication", docs, path).collect()}
    assert "copyright" in lines[50] and not any("copyright" in lines[i] for i in range(51, 56)) and lines[3] == rows[3][1]
    codec = bpe.Codec(open(vocabulary_path(), "rb").read())
    for r in stage(spark, "BPE encoding", docs, path).collect():
        assert r["n_tokens"] in {len(codec.encode(t or "")) for i, t, *_ in rows if i == r["doc_id"]}


def test_empty_tables(spark, folder):
    path, _, _ = folder
    none = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, fn in corpus_pipeline.STAGES:
        assert fn(spark, none, path).count() == 0, name


def test_an_id_with_two_texts_loses_only_the_copy(spark, make, folder):
    a, b = sentences("aa", 60, 1), sentences("aa", 60, 2)
    docs = make([(1, a), (5, a), (5, b), (None, a), (None, b), (7, b), (7, b), (None, None), (None, None), (9, "")])
    kept = stage(spark, "n-gram near duplicates", docs, folder[0]).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(1, a), (5, b), (None, None), (9, "")], key=str)


def test_stored_copies_go_with_the_stage_that_made_them(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    scratch = os.path.join(scratch_dir(spark), "riskweave").removeprefix("file:")
    for name, kept in (("line deduplication", {"placed"}), ("n-gram near duplicates", {"near-duplicates", "gone"})):
        before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
        done = stage(spark, name, docs, path)
        assert {x.rpartition("-")[0] for x in set(os.listdir(scratch)) - before} == kept
        assert done.count() > 0


def test_small_tables_are_kept(spark, make, folder):
    for n in (1, 9, 20):
        docs = make([(i, sentences("aa", 60, i), "aa", "h") for i in range(n)] + [(100 + i, sentences("cc", 60, 500 + i), "cc", "h") for i in range(n)])
        assert stage(spark, "language identification", docs, folder[0]).count() == 2 * n
