import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import collocations as C


def brute(rows, at_least, best):
    """``rows``: (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(zip(*[w[i:] for i in range(k)]))
    out = []
    for lang, count in f.items():
        cands = {p: a for p, a in count.items() if len(p) > 1 and a >= at_least}
        inside = defaultdict(int)
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        found = []
        for p, a in cands.items():
            if inside[p] < a:
                score, _, le, ri = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), le, ri))
        out += [(lang, i + 1, p.decode(), -a, le, ri, n[lang], -s) for i, (s, a, p, le, ri) in enumerate(sorted(found)[:best])]
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "é", "日本", "a", "b\x0bc", "x" * 60, "y" * 49 + "é"] + [f"w{i}" for i in range(30)]
    phrases = ["new york city hall", "a b a b a b", "the the the the the the the", "x y z, x y z", "in  the\tend"]
    rows = []
    for i in range(n):
        parts = [r.choice(phrases) if r.random() < 0.4 else r.choice(words) for _ in range(r.choice([0, 1, 5, 40]))]
        rows.append((r.choice([" ", "  ", ". ", "\n"]).join(parts), r.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("alone", "xx"), ("hot pair " + " hot pair ".join(f"v{i}" for i in range(600)), "en")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("at_least, best", [(20, 2000), (5, 7)])
def test_collocations_equal_brute_force(spark, at_least, best):
    rows = corpus(at_least, 300)
    docs = frame(spark, rows).withColumns({c: F.lit(1) for c in ("p", "a", "n", "word", "h", "rank")}).repartition(4)
    assert result(C.collocations(docs, at_least, best)) == brute(rows, at_least, best)


def test_small_chunks_and_hot_routes_change_nothing(spark, monkeypatch):
    rows = corpus(3, 200)
    texts = frame(spark, rows).select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    words, seed = C.vocabulary(texts, 5)
    stored = C.materialize(C.suffixes(texts, seed, C.frequent_pairs(texts, seed, 5), 6), "suffixes")
    counts = lambda df: {(tuple(r["p"]), r["a"]) for r in df.collect()}
    whole = counts(C.phrase_counts(stored, 5))
    rows = C.materialize(C.unpacked(stored), "rows")
    assert rows.count() == stored.agg(F.sum("rows")).first()[0] and len(whole) > 50
    for size in (3, 20, 100):  # buckets of four times as many rows are routed by more words
        assert counts(C.phrase_counts(stored, 5, route_rows=size)) == whole, size
    deep = {r["deep"] for r in C.routed(rows, 20).select("deep").distinct().collect()}
    assert min(deep) == 2 and max(deep) > 2


def test_equal_parts_against_counting():
    r = np.random.default_rng(5)
    keys = r.integers(0, 4, (3000, C.LONGEST))
    keys *= np.cumprod(keys > 0, axis=1)  # nothing follows the end
    n = r.integers(1, 4, len(keys))
    got = {tuple(keys[i, :size].tolist()): c for i, size, c in C.equal_parts(keys, n, np.full(len(keys), 2), 50)}
    want = Counter()
    for row, c in zip(keys.tolist(), n.tolist()):
        for size in range(2, C.LONGEST + 1):
            if all(row[:size]):
                want[tuple(row[:size])] += c
    assert got == {p: c for p, c in want.items() if c >= 50}


def test_long_text_copies_and_empty_table(spark):
    text = ("alpha beta gamma " * 70_000).strip()  # one megabyte
    rows = [(text, "en")] + [("copy of words here", "fr")] * 120
    assert result(C.collocations(frame(spark, rows))) == brute(rows, 100, 2000)
    assert C.collocations(frame(spark, rows).limit(0)).count() == 0
    assert C.collocations(frame(spark, [(None, None)])).count() == 0


def test_a_shared_hash_takes_another_seed(spark, monkeypatch):
    real = C.word_counts

    def clash(texts, seed):
        found = real(texts, seed)
        return found.withColumn("h", F.when(F.col("h") != 0, F.lit(5)).otherwise(F.lit(0))) if seed == 1 else found

    monkeypatch.setattr(C, "word_counts", clash)
    _, seed = C.vocabulary(frame(spark, [("a b c", "en")]), 1)
    assert seed == 2
