import json
import os
import random

import pytest
from pyspark.sql import functions as F

from riskweave.llm import bpe
from riskweave.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
try:
    PATH = vocabulary_path()
except ModuleNotFoundError:
    pytest.skip("no public vocabulary here", allow_module_level=True)


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return tokenizers.Tokenizer.from_file(PATH)


def content():
    with open(PATH, "rb") as file:
        return file.read()


PARTS = ["a", "b", "the", "ing", "'s", "'re", "'", "!", "  ", " ", "\n", "\t", "é", "ü", "日本", "😀", "9", "12", "...", "<|endoftext|>",
         "<|", " ", "x" * 40, "ab" * 30, "　", "!'", "s", "re", "\r\n"]


def test_tree_concatenation_equals_the_library(library):
    codec, r = bpe.Codec(content(), limit=16), random.Random(4)
    for _ in range(3000):
        some = r.sample(PARTS, r.choice([2, 3, 5, 12]))
        text = "".join(r.choice(some) for _ in range(r.choice([5, 40, 200])))
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == want, text
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


def test_very_long_words(library):
    codec, r = bpe.Codec(content()), random.Random(5)
    for text in ("a" * 100_001, "".join(r.choice("abcdeéüxyz日") for _ in range(60_000)), "ab" * 30_000 + " end", "\n" * 9000 + "x" * 9000):
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_bytes_decode_like_the_library(library):
    codec, r = bpe.Codec(content()), random.Random(6)
    for _ in range(300):
        ids = [r.randrange(50_257) for _ in range(8)]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_documents(make, library):
    rows = [(1, "plain text"), (2, None), (3, ""), (4, "<|endoftext|> é"), (4, "<|endoftext|> é"), (None, "x" * 20_000)]
    docs = make(rows).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit("clash"))
    done = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in done.collect()), key=str)
    assert got == sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows), key=str)
    assert bpe.digests(done.limit(0)).count() == 0


def test_other_vocabularies_are_refused():
    model = json.loads(content())
    model["model"]["merges"] = model["model"]["merges"][::-1]
    with pytest.raises(ValueError):
        bpe.Codec(json.dumps(model).encode())


def test_one_worker_encodes_and_decodes(spark, make):
    docs = make([(1, "a b  c"), (2, None), (3, ""), (4, "é" * 9000), (4, "<|endoftext|> x"), (None, "\ud7ff z")])
    both = bpe.round_trip(docs, PATH)
    apart = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    rows = lambda df: sorted(map(str, df.collect()))
    assert both.schema == apart.schema and rows(both) == rows(apart)
    assert bpe.digests(both)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
