import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from riskweave.llm import chat, quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + s for i, w in enumerate(windows) if count[w] > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_agree_with_brute_force(make):
    r = random.Random(3)
    parts = ["a", "b", "cé", "日", " ", "  ", "\n", "\t", "#", "<|", "word", "\x0b", "\x1c"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.choice([0, 5, 60, 400])))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "x " * 30000), (902, "x " * 30000), (None, "a b c"), (903, "q" * 70000)]
    docs = make(rows).withColumn("n_words", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("t", F.lit(1))
    got = sorted((tuple(x) for x in quality.measure(docs).select("key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_hosts_are_shrunk_and_joined_back(spark, make):
    good = "alpha beta gamma delta " * 2 + " ".join(f"w{i}" for i in range(80))
    rows = [(i, "short", None, "bad") for i in range(30)] + [(30, good, None, "bad")]
    rows += [(100 + i, f"{good} {i}", None, f"fine{i % 4}") for i in range(80)] + [(300, "short", None, "once"), (301, good, None, None)]
    done = {r["key"]: r for r in quality.quality(make(rows)).collect()}
    assert done[30]["host_failed"] and not done[30]["base_failed"] and not done[30]["kept"]
    assert all(done[100 + i]["kept"] for i in range(80)) and done[301]["kept"]
    assert not done[300]["kept"] and len(done) == len(rows)
    rates = {r["host"]: r["rate"] for r in quality.host_rates(quality.measure(make(rows))).where("rule = 'base'").collect()}
    assert rates["once"] < 1 and rates["fine0"] > 0 and None not in rates


def test_empty_documents_table(make):
    assert quality.quality(make([])).count() == 0


def conversation(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))


def read_back(done):
    return {r["conv_id"]: r for r in done.select("conv_id", "formatted", "segments", "state", "valid", chat.parse_chats(F.col("formatted")).alias("turns")).collect()}


def test_chats_read_back_exactly(spark):
    r = random.Random(1)
    parts = ["<|im_end|>", "<|im_start|>", "<|", "|>", "\\", "\\\\", "\n", "<\\|", "a", "é", "<", "$1", "assistant\n"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "a\nb", "<|x", "\\", ""]), "".join(r.choice(parts) for _ in range(r.randrange(12))))
            for c in range(60) for t in range(r.randrange(1, 6))]
    done = read_back(chat.format_chats(conversation(spark, rows)))
    for c in {x[0] for x in rows}:
        own = sorted((t, role, text) for d, t, role, text in rows if d == c)
        assert [(x["role"], x["text"]) for x in done[c]["turns"]] == [(role, text) for _, role, text in own]
        assert "".join(s["text"] for s in done[c]["segments"]) == done[c]["formatted"]
        assert sum(s["loss"] for s in done[c]["segments"]) == sum(role == "assistant" for _, role, _ in own)


def test_turn_order_is_checked_and_null_is_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "assistant", "x"), (3, 0, "system", "s"), (3, 1, "user", "u"),
            (4, 0, "user", "a"), (4, 1, "user", "b"), (4, 2, "assistant", "c"), (None, None, None, None), (5, 0, "user", "q"), (5, 0, "user", "q")]
    done = read_back(chat.format_chats(conversation(spark, rows)))
    assert {c: d["valid"] for c, d in done.items()} == {1: True, 2: False, 3: False, 4: False, None: False, 5: False}
    assert done[4]["state"] == "invalid" and done[1]["turns"][1]["text"] == "" and len(done[5]["turns"]) == 2
    assert chat.format_chats(conversation(spark, rows).limit(0)).count() == 0


def test_query_digests_the_injected_conversation(spark, tmp_path):
    from riskweave.llm.queries import MARKS_INSIDE, op2_chat_formatting

    conversation(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]).drop("formatted").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in op2_chat_formatting(spark, str(tmp_path)).collect()}
    whole = "".join(f"{role}\n{MARKS_INSIDE}\n" for role in ("user", "assistant"))
    assert got[-1]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[-1]["n_turns"] == 2
    assert got[-1]["loss_sha256"] == hashlib.sha256(MARKS_INSIDE.encode()).hexdigest() and got[-1]["loss_chars"] == len(MARKS_INSIDE)
