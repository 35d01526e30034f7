"""Byte-level BPE encoding and decoding with a given vocabulary.

Text is encoded by the installed library. A stretch without white space may be arbitrarily
long; it is cut into halves down to ``LIMIT`` characters, the pieces are encoded in parallel
threads, and neighbours are joined again by re-encoding a growing window around each join
until it begins with tokens of the left side and ends with tokens of the right side. Two
adjacent tokens of a BPE encoding stay as they are whatever stands around them, so beyond
the agreeing tokens nothing can change, and the result is that of one encoding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import small_batches
from riskweave.session import ship_package

#: The word pattern of byte-level vocabularies of this kind (a fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LIMIT = 4096
WINDOW = 8


def _byte_of_char() -> dict[str, int]:
    """The format writes a byte as a printable character; the others are numbered from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder made from the JSON file of a byte-level BPE vocabulary."""

    def __init__(self, content: bytes, limit: int = LIMIT):
        import tiktoken

        model = json.loads(content)
        if model["normalizer"] or model["model"]["type"] != "BPE" or model["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("not a plain byte-level BPE vocabulary")
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        to_byte, vocab = _byte_of_char(), model["model"]["vocab"]
        tokens = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items() if t not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
            raise ValueError("ids are not in the order of the merges")
        self.core = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})
        self.special, self.limit = special, limit
        self.long = re.compile(r"[^ \n]{%d,}" % (limit + 1))
        longest_first = sorted(special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        size = max([*tokens, *special.values()]) + 1
        table = np.empty(size, dtype=object)
        for i, t in tokens.items():
            table[i] = t
        for t, i in special.items():
            table[i] = t.encode()
        self.bytes_of = table
        self.pool = ThreadPoolExecutor(2)

    def plain(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, disallowed_special=())

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens become their ids."""
        if self.marks is None or not self.marks.search(text):
            return self._segment(text)
        parts = [np.array([self.special[p]], dtype=np.uint32) if p in self.special else self._segment(p)
                 for p in self.marks.split(text) if p]
        return np.concatenate(parts)

    def _segment(self, text: str) -> np.ndarray:
        """Cut where a space or line feed follows a visible ASCII character: no word spans that."""
        found, done = [], 0
        for run in self.long.finditer(text):
            if run.start() < done:
                continue
            begin, end = run.start(), run.end()
            while begin > done and not (text[begin] in " \n" and "!" <= text[begin - 1] <= "~"):
                begin -= 1
            while end < len(text) and not (text[end] in " \n" and "!" <= text[end - 1] <= "~"):
                end += 1
            if begin > done:
                found.append(self.plain(text[done:begin]))
            found.append(self._tree(text[begin:end]))
            done = end
        if not found:
            return self.plain(text)
        if done < len(text):
            found.append(self.plain(text[done:]))
        return np.concatenate(found)

    def _tree(self, text: str) -> np.ndarray:
        """Encode pieces in parallel and join neighbours, level by level."""
        count = 1
        while len(text) > count * self.limit:
            count *= 2
        cuts = [len(text) * i // count for i in range(count + 1)]
        level = list(self.pool.map(self.plain, (text[a:b] for a, b in zip(cuts, cuts[1:]))))
        while len(level) > 1:
            level = list(self.pool.map(self._join, level[::2], level[1::2]))
        return level[0]

    def _join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Encoding of the text of both sides, each of which is the encoding of its own text."""
        a = b = WINDOW
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            tail, head = left[len(left) - a:], right[:b]
            text, cut, stop = self._whole(left, right, a, b)
            if text is None:  # the window would cut a character
                a, b = a + cut, b + stop
                continue
            seen = self.plain(text)
            fits_left = a == len(left) or seen[0] == tail[0]
            fits_right = b == len(right) or seen[-1] == head[-1]
            if fits_left and fits_right:
                return np.concatenate([left[: len(left) - a], seen, right[b:]])
            a, b = a * (1 if fits_left else 2), b * (1 if fits_right else 2)

    def _whole(self, left: np.ndarray, right: np.ndarray, a: int, b: int) -> tuple[str | None, int, int]:
        """Text of the window, or how far to move its ends so that they fall between characters."""
        data = self.raw(np.concatenate([left[len(left) - a:], right[:b]]))
        bad_start = a < len(left) and data[0] & 0xC0 == 0x80
        bad_end = b < len(right) and self.bytes_of[right[b]][0] & 0xC0 == 0x80
        return (None if bad_start or bad_end else data.decode(), int(bad_start), int(bad_end))

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[ids])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens included; bytes that are no text become U+FFFD."""
        return self.raw(np.asarray(ids, dtype=np.int64)).decode("utf-8", "replace")


_CODECS: dict[tuple[int, int], Codec] = {}


def codec_of(content: bytes, limit: int = LIMIT) -> Codec:
    """One codec per process and vocabulary."""
    key = (hash(content), limit)
    if key not in _CODECS:
        _CODECS[key] = Codec(content, limit)
    return _CODECS[key]


class Vocabulary:
    """A vocabulary file read by the driver and sent to the executors (its size is fixed, some MB)."""

    def __init__(self, spark: SparkSession, path: str, limit: int = LIMIT):
        ship_package(spark)
        small_batches(spark, 500)
        with open(path, "rb") as file:
            self._content = spark.sparkContext.broadcast(file.read())
        self._limit = limit

    def encode(self, text: Column | str) -> Column:
        """Array of token ids; NULL text counts as empty."""
        content, limit = self._content, self._limit

        @F.pandas_udf("array<int>")
        def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = codec_of(content.value, limit)
            for texts in batches:
                yield pd.Series([codec.encode(t or "").astype(np.int32) for t in texts])

        return encoded(text)

    def both(self, text: Column | str) -> Column:
        """Struct of the token ids of a text (``ids``) and of the text decoded from these ids (``decoded``)."""
        content, limit = self._content, self._limit

        @F.pandas_udf("ids array<int>, decoded string")
        def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            codec = codec_of(content.value, limit)
            for texts in batches:
                ids = [codec.encode(t or "").astype(np.int32) for t in texts]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([codec.decode(r) for r in ids], dtype=object)})

        return encoded(text)

    def decode(self, ids: Column | str) -> Column:
        """Text of an array of token ids; NULL gives an empty text."""
        content, limit = self._content, self._limit

        @F.pandas_udf("string")
        def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = codec_of(content.value, limit)
            for rows in batches:
                yield pd.Series([codec.decode(r if r is not None else ()) for r in rows])

        return decoded(ids)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` of every row, as :func:`encode_documents` and :func:`decode_documents` give them.

    Ids are decoded by the worker that made them, so that a task needs one worker with the vocabulary, not two.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)
    return docs.select(F.col(key), vocabulary.both(F.col(text)).alias("both")).select(key, "both.ids", "both.decoded")


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` of every row; other columns are left out, so names cannot clash."""
    vocabulary = Vocabulary(docs.sparkSession, path)
    return docs.select(F.col(key), vocabulary.encode(F.col(text)).alias("ids"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with its ``decoded`` text."""
    vocabulary = Vocabulary(encoded.sparkSession, path)
    return encoded.withColumn("decoded", vocabulary.decode("ids"))


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text."""
    return decoded.select(
        key, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
