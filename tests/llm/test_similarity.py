import random
import re
import tracemalloc

from pyspark.sql import functions as F

from riskweave.llm import decontam, graph, ngram_join
from riskweave.llm.shingles import shingle_hashes, word_hashes


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    best = [i for i, _ in rows]
    alike = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a][1] and sets[b][1]
             and 100 * len(sets[a][1] & sets[b][1]) >= 75 * len(sets[a][1] | sets[b][1])]
    moved = True
    while moved:
        moved = False
        for a, b in alike:
            low = min((x for x in (best[a], best[b]) if x is not None), default=None)
            for k in (a, b):
                if best[k] != low:
                    best[k], moved = low, True
    return sorted(((i, len(s), c) for (i, s), c in zip(sets, best)), key=str)


def family_rows(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 5)))
    common = [word() for _ in range(40)]
    out = []
    for f in range(6):
        base = [word() for _ in range(r.choice([12, 40, 120]))]
        for _ in range(n):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                k = r.randrange(len(w))
                w[k:k + r.choice([0, 1, 1])] = [word()]
            if r.random() < 0.3:
                w += common
            out.append(" ".join(w))
    out += [" ".join(word() for _ in range(r.randrange(1, 9))) for _ in range(20)]
    r.shuffle(out)
    return list(enumerate(out))


def test_words_and_shingles_follow_the_definition():
    texts = ["", "  ", "A b\tc", "one two three four five six", "one two three four five six", "É é", "a b c d e", "x" * 5000]
    _, counts = word_hashes([t.encode() for t in texts])
    assert counts.tolist() == [len(words(t)) for t in texts]
    hashes, owners = shingle_hashes([t.encode() for t in texts])
    own = lambda i: set(hashes[owners == i].tolist())
    assert [len(own(i)) for i in range(len(texts))] == [len(shingles(t)) for t in texts]
    assert own(3) == own(4) and not own(2) & own(6)


def test_join_agrees_with_brute_force(make):
    rows = family_rows(1, 40)
    got = ngram_join.ngram_join(make(rows, 7), 75)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == components(rows)


def test_join_edge_cases(make):
    same = "one two three four five six seven"
    rows = [(5, same), (4, same.upper()), (4, same.upper()), (7, None), (8, ""), (9, " \n"), (10, "a b"), (3, "A\tb"), (11, "b a"),
            (None, same), (None, "only here"), (20, "w " * 40_000), (21, "w " * 40_000)]
    docs = make(rows).withColumn("tokens", F.lit("clash")).withColumn("rid", F.lit(1))
    got = sorted((tuple(r) for r in ngram_join.ngram_join(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == components(rows)
    assert ngram_join.ngram_join(make([])).count() == 0


def test_a_batch_is_packed_in_little_memory():
    r = random.Random(4)
    texts = [" ".join(f"{r.randrange(10**6)}" for _ in range(1000)) for _ in range(500)]
    # the first batch compiles and caches
    list(ngram_join._pack(0, [[0, 0]], texts[:1], 8))
    tracemalloc.start()
    sent = [b.nbytes for b in ngram_join._pack(0, [[i, i] for i in range(500)], texts, 8)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sent) >= 8 * 500 * 996 and max(sent) <= 2 * ngram_join.SEND_BYTES
    assert peak < 40 << 20, peak


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 1 for i in range(1, 61)) and all(found[i] == 100 for i in range(100, 160)) and all(found[200 + i] == 200 for i in range(9))


def leaked(docs, items, percent=75):
    own = {i: shingles(t) for i, t in items if i is not None}
    return sorted((d, i, len(s), len(s & shingles(t))) for d, t in set(docs) for i, s in own.items() if s and 100 * len(s & shingles(t)) >= percent * len(s))


def test_items_are_found_in_long_documents(spark, make):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(r.choice([3, 6, 20, 90])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, items[4][1]), (3, items[3][1])]
    docs = []
    for d in range(80):
        w = [word() for _ in range(r.choice([0, 30, 3000]))]
        for _ in range(r.choice([0, 1, 2])):
            own = words(items[r.randrange(25)][1])
            for _ in range(r.choice([0, 0, 1, 3])):
                own[r.randrange(len(own))] = word()
            at = r.randrange(len(w) + 1)
            w[at:at] = own
        docs.append((d, " ".join(w)))
    docs += [(500, items[0][1]), (500, items[0][1]), (501, None), (502, "")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("k", F.lit("clash"))
    rows = make(docs).withColumn("w", F.lit("clash")).withColumn("at", F.lit(3))
    found = decontam.leaks(rows, table)
    assert sorted(tuple(x) for x in found.select("doc_id", "item_id", "n_item", "n_shared").collect()) == leaked(docs, items)
    bad = {x[0] for x in leaked(docs, items)}
    clean = decontam.decontaminate(rows, table)
    assert sorted(x["doc_id"] for x in clean.collect()) == sorted(d for d, _ in docs if d not in bad) and clean.columns == rows.columns
    assert decontam.leaks(make([]), table).count() == 0 and decontam.leaks(rows, table.limit(0)).count() == 0


def test_no_leak_is_lost_at_unlucky_sizes(spark, make):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(8))
    items = [(i, " ".join(word() for _ in range(n + 4))) for i, n in enumerate([17, 33] * 30)]
    docs = []
    for i, text in items:
        w = text.split()
        n = len(w) - 4
        part = w[:-(-3 * n // 4) + 4]
        docs += [(100 * i + c, " ".join([word() for _ in range(c)] + part + [word() for _ in range(120)])) for c in range(100)]
    found = decontam.leaks(make(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((x["doc_id"], x["item_id"]) for x in found.collect()) == [(d, d // 100) for d, _ in docs]


def test_large_items_are_found_by_their_signatures(spark, make):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(8))
    items = [(i, " ".join(word() for _ in range(n + 4))) for i, n in enumerate([1, 2, 63, 64, 65, 128, 129, 400] * 4)]
    docs = []
    for i, text in items:
        w = text.split()
        n = len(w) - 4
        for c, share in enumerate((100, 75, 74, 40)):
            keep = -(-share * n // 100) + 4 if n > 4 else len(w)
            # the part that is kept lies in two places of a long text
            half = keep // 2 + 2
            cut = w[:half + 4] + [word() for _ in range(2000)] + w[half:keep]
            docs.append((10 * i + c, " ".join(cut if n > 4 else w)))
    want = leaked(docs, items)
    found = decontam.leaks(make(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(x) for x in found.select("doc_id", "item_id", "n_item", "n_shared").collect()) == want and len(want) > 40
    assert decontam._matches(75) == 4 and decontam._matches(10) == 1
    shingled = decontam.item_shingles(spark.createDataFrame(items, "item_id long, text string"))
    for x in decontam.signatures(shingled, 75).groupBy("item_id", "part", "need").count().collect():
        n = len(shingles(dict(items)[x["item_id"]]))
        exact = n <= 2 ** decontam.SMALL
        assert n <= 2 ** x["part"] and x["count"] == (n - -(-75 * n // 100) + 1 if exact else decontam.HASHES) and x["need"] == (1 if exact else 4)
