"""Removal of repeated byte strings of ``LENGTH`` bytes or more, across and within documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier, in a document with
a smaller doc_id or before in the same one.

1. *Anchors.* Every string of ``LENGTH`` bytes contains a smallest hash among its ``K``-byte
   pieces, and equal strings contain it at the same place. Anchors that occur once in all
   documents belong to no repeated string; the others are found by ranges of their keys (the
   hashes mixed again: smallest hashes themselves crowd the low ranges).
2. *Windows.* Around every other anchor lies the window of all strings in which its hash is the
   smallest, at most ``2 * LENGTH - K`` bytes. Equal windows of a batch are sent once, by their
   first place, to the range of their anchor. Where an anchor has more than ``CROWD`` windows,
   each is divided into parts of fewer strings, which are sent by what these strings share: the
   more windows, the more of the string decides where it goes.
3. *Columns.* The windows around an anchor are a collection of short documents whose sorted
   order is built column by column: every round inserts one symbol per window, sorts stably by
   it (the positional Burrows-Wheeler transform), and updates the length that neighbours have
   in common. Neighbours with ``LENGTH`` common symbols hold the same string, whose
   first place stays. A task sorts the windows of a few anchors at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import small_batches
from riskweave.llm.shingles import mix, powers
from riskweave.session import materialize, ship_package

LENGTH, K = 100, 32
REACH = LENGTH - K
WIDTH = LENGTH + REACH
#: Bytes that a batch holds at most (one document may hold more), and documents.
BATCH_BYTES, BATCH_DOCS = 1 << 21, 1 << 15
#: Windows of an anchor from which they are divided; windows that are sorted, or made, at once; bytes of a row.
CROWD, SORTED, ROW_BYTES = 1 << 15, 1 << 15, 1 << 15
#: Bytes hashed at once, and windows cut out at once.
BLOCK, CUT = 1 << 16, 1 << 12

_rng = np.random.default_rng(7)
_SYMBOL = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(powers(2)[1])
_INVERSE = pow(_BASE, -1, 2**64)
_PACKED = "batch long, bucket long, kind int, payload binary"
#: An entry has the leading bits of a key below those of its bucket, a count or level, and the document.
_COUNT, _OWNER = np.uint64(5), np.uint64(15)
_TAIL = _COUNT + _OWNER
#: A token has the known bits of a key, its last three the level by which its windows are divided.
_LEVEL = 7
_KNOWN = np.dtype([("token", "<u8"), ("owner", "<u2")])
#: One occurrence of a window: place of its anchor, and where the document's bytes lie in it.
RECORD = np.dtype([("null", "u1"), ("doc", "<i8"), ("mark", "<i8"), ("at", "<i8"), ("left", "u1"), ("right", "u1"), ("window", "u1", (WIDTH,))])
SPAN = np.dtype([("null", "u1"), ("doc", "<i8"), ("mark", "<i8"), ("start", "<i8"), ("end", "<i8")])


class Bytes:
    """The texts of a batch in one array, with sums that give the hash of any piece."""

    def __init__(self, texts: list[str | None]):
        held = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.size = np.array([len(h) for h in held], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.padded = np.frombuffer(b"".join([bytes(REACH), *held, bytes(LENGTH)]), dtype=np.uint8)
        self.data = self.padded[REACH:-LENGTH]
        n = len(self.data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        weight = powers(n)[:n]
        for i in range(0, n, BLOCK):
            weight[i:i + BLOCK] *= _SYMBOL[self.data[i:i + BLOCK]]
        np.cumsum(weight, out=self.sums[1:], dtype=np.uint64)
        del weight
        self.inverse = np.full(n + 1, _INVERSE, dtype=np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``a`` up to ``b``, for arrays of both."""
        return mix((self.sums[b] - self.sums[a]) * self.inverse[a] + (b - a).astype(np.uint64))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and document indexes of all anchors; the smallest hash of the string at every byte, between ``REACH`` zeros."""
        n, pieces = len(self.data), REACH + 1
        if n < LENGTH:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(2 * REACH, np.uint64)
        top = np.uint64(2**64 - 1)
        owner = np.repeat(np.arange(len(self.size), dtype=np.int32), self.size)
        smallest = np.zeros(n - LENGTH + 1 + 2 * REACH, dtype=np.uint64)
        found = []
        for begin in range(0, n - K + 1, BLOCK):
            end = min(begin + BLOCK, n - K + 1)
            low, high = max(0, begin - REACH), min(end + REACH, n - K + 1)
            places = np.arange(low, high)
            value = np.minimum(np.maximum(self.hashes(places, places + K), np.uint64(1)), top - np.uint64(1))
            value[owner[low:high] != owner[low + K - 1:high + K - 1]] = top
            least = _sliding(value, pieces, np.minimum) if len(value) >= pieces else value[:0]
            least[owner[low:low + len(least)] != owner[low + LENGTH - 1:low + LENGTH - 1 + len(least)]] = 0
            smallest[low + REACH:low + REACH + len(least)] = least
            most = _sliding(smallest[begin:end + REACH], pieces, np.maximum)
            value = value[begin - low:end - low]
            at = np.flatnonzero(most == value)
            found.append((at + begin, value[at]))
        at, value = map(np.concatenate, zip(*found))
        return at, value, owner[at].astype(np.int64), smallest


def _sliding(x: np.ndarray, width: int, combine: Callable) -> np.ndarray:
    """``combine`` over every ``width`` neighbours, by doubling."""
    out, done = x, 1
    while 2 * done <= width:
        out = combine(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return combine(out[: len(out) - rest], out[rest:]) if rest else out.copy()


def _cuts(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of every run of equal values."""
    cut = np.flatnonzero(np.diff(values)) + 1
    return zip([0, *cut], [*cut, len(values)]) if len(values) else iter(())


def _table(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["batch", "bucket", "kind", "payload"])


def _rows(batch: int, bucket: np.ndarray, kind: int, values: np.ndarray) -> pa.RecordBatch:
    """A row for every run of equal buckets, or several of at most ``ROW_BYTES``, with the bytes of its values."""
    n, size = len(values), values.dtype.itemsize
    new = np.ones(n, dtype=bool)
    new[1:] = bucket[1:] != bucket[:-1]
    start = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    cut = np.flatnonzero(within % max(1, ROW_BYTES // size) == 0)
    ends = np.append(cut, n).astype(np.int32) * np.int32(size)
    payload = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])
    columns = [pa.array(np.full(len(cut), batch, dtype=np.int64)), pa.array(bucket[cut].astype(np.int64)), pa.array(np.full(len(cut), kind, dtype=np.int32)), payload]
    return pa.record_batch(columns, ["batch", "bucket", "kind", "payload"])


def _payloads(table: pa.Table, kind: int, dtype: np.dtype) -> list[np.ndarray]:
    """Values of the payloads of a kind; of batches without other kinds where they lie."""
    out = []
    for batch in table.to_batches():
        own = pc.equal(batch["kind"], kind)
        found = batch["payload"] if pc.all(own).as_py() else batch.filter(own)["payload"]
        _, offsets, data = found.buffers()
        if len(found) and data is not None:
            width = np.int64 if pa.types.is_large_binary(found.type) else np.int32
            ends = np.frombuffer(offsets, dtype=width)[found.offset:found.offset + len(found) + 1]
            out.append(np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]].view(dtype))
    return out


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for batch in rows:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            size += len(row[2] or "")
            if size >= BATCH_BYTES or len(held) == BATCH_DOCS:
                yield held
                held, size = [], 0
    if held:
        yield held


# --- anchors that occur more than once ------------------------------------------------------


def _unknown(bits: int) -> np.uint64:
    """Bits of a key that its token does not have."""
    return np.uint64(2 ** max(int(_TAIL) - bits, 3) - 1)


def _anchor_packer(bits: int):
    unknown = _unknown(bits)

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for held in _batches(rows):
            text = Bytes([r[2] for r in held])
            at, hashes, owners, _ = text.anchors()
            keys = mix(hashes)
            order = np.argsort(keys, kind="stable")
            at, keys, owners = at[order], keys[order], owners[order]
            new = np.ones(len(keys), dtype=bool)
            new[1:] = keys[1:] != keys[:-1]
            group = np.cumsum(new) - 1
            known = np.bincount(group)[group] > 1 if len(group) else new
            new_owner = new.copy()
            new_owner[1:] |= owners[1:] != owners[:-1]
            count = _surroundings(text, at, owners, group, known)
            entry = keys[new] << np.uint64(bits) >> _TAIL << _TAIL | count << _OWNER | owners[new].astype(np.uint64)
            chosen = known & new_owner
            shared = np.empty(np.count_nonzero(chosen), dtype=_KNOWN)
            shared["token"], shared["owner"] = keys[chosen] & ~unknown, owners[chosen]
            ids = np.array([(r[0] is None, r[0] or 0, r[1]) for r in held], dtype=np.int64)
            anywhere = int(mix(np.array([number], dtype=np.uint64))[0] >> np.uint64(64 - bits))
            yield _table([(number, anywhere, 0, ids.tobytes()), (number, anywhere, 2, shared.tobytes())])
            yield _rows(number, keys[new] >> np.uint64(64 - bits), 1, entry)
            number += 1

    return pack


def _surroundings(text: Bytes, at: np.ndarray, owners: np.ndarray, group: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Binary logarithm, rounded up, of the number of different surroundings of every anchor of a batch."""
    count = np.ones(int(group[-1]) + 1 if len(group) else 0)
    several = np.flatnonzero(known)
    start = text.start[owners[several]]
    end = start + text.size[owners[several]]
    around = text.hashes(np.maximum(at[several] - REACH, start), np.minimum(at[several] + LENGTH, end))
    order = np.lexsort((around, group[several]))
    around, own = around[order], group[several][order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (around[1:] != around[:-1])
    found = np.bincount(own[new], minlength=len(count))
    return np.ceil(np.log2(np.maximum(count, found))).astype(np.uint64)


def levels(windows: np.ndarray, crowd: int = CROWD) -> np.ndarray:
    """How often windows are halved, by their number around an anchor: once above ``crowd``, and again for four times as many."""
    return np.clip(np.ceil(np.log2(windows / crowd) / 2), 0, _LEVEL).astype(np.uint64)


def _repeated(frame: pd.DataFrame, crowd: int) -> pd.DataFrame:
    """Of a range of keys: entries of anchors that several batches have, with their level; the rest is passed on."""
    own = frame[frame["kind"] == 1]
    out = [frame[frame["kind"] != 1]]
    if len(own) > 1:
        parts = [np.frombuffer(p, dtype=np.uint64) for p in own["payload"]]
        entry, ends = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        order = np.argsort(entry >> _TAIL, kind="stable")
        value = entry[order] >> _TAIL
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(value)))
        count = np.ldexp(1.0, (entry[order] >> _OWNER & np.uint64(31)).astype(np.int64))
        level = levels(np.add.reduceat(count, first), crowd) if len(first) else np.empty(0, np.uint64)
        shared = np.empty(len(entry), dtype=bool)
        shared[order] = np.repeat(times > 1, times)
        made = np.empty(len(entry), dtype=np.uint64)
        made[order] = value << _TAIL | np.repeat(level, times) << _OWNER
        made |= entry & np.uint64(2 ** int(_OWNER) - 1)
        found = [made[a:b][shared[a:b]].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        out.append(own.assign(payload=found)[[len(f) > 0 for f in found]])
    return pd.concat(out)[["batch", "bucket", "kind", "payload"]]


def _anchor_collector(bits: int):
    unknown = _unknown(bits)

    def collect(frame: pd.DataFrame) -> pd.DataFrame:
        ids, known, rest = (frame[frame["kind"] == k] for k in (0, 2, 1))
        ids = np.frombuffer(ids["payload"].iloc[0], dtype=np.int64).reshape(-1, 3)
        known = np.concatenate([np.frombuffer(p, dtype=_KNOWN) for p in known["payload"]])
        parts = [np.frombuffer(p, dtype=np.uint64) for p in rest["payload"]]
        entry = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        bucket = np.repeat(rest["bucket"].to_numpy().astype(np.uint64), [len(p) for p in parts])
        token = (bucket << np.uint64(64 - bits) | entry >> _TAIL << _TAIL >> np.uint64(bits)) & ~unknown
        level = entry >> _OWNER & np.uint64(31)
        owner = entry & np.uint64(2 ** int(_OWNER) - 1)
        # anchors that this batch alone has repeatedly stay whole
        order = np.argsort(token)
        near = np.searchsorted(token[order], known["token"])
        found = np.append(token[order], np.uint64(0))[near] == known["token"]
        found &= near < len(token)
        given = np.where(found, np.append(level[order], np.uint64(0))[near], np.uint64(0))
        token = np.concatenate([token | level, known["token"] | given])
        place = np.concatenate([owner.astype(np.int64), known["owner"].astype(np.int64)])
        order = np.lexsort((token, place))
        token, place = token[order].view(np.int64), place[order]
        runs = list(_cuts(place))
        at = [int(place[a]) for a, _ in runs]
        doc = pd.Series(ids[at, 1]).astype("Int64").mask(ids[at, 0] == 1)
        return pd.DataFrame({"doc_id": doc, "mark": ids[at, 2], "anchors": [np.unique(token[a:b]) for a, b in runs]})

    return collect


# --- windows --------------------------------------------------------------------------------


class Windows:
    """Windows of a batch: place of the anchor, document, first byte and end, and the key that deals them out."""

    def __init__(self, text: Bytes, ids: np.ndarray, order: np.ndarray, *fields: np.ndarray):
        self.text, self.ids, self.order, self.fields = text, ids, order, fields
        self.at, self.owner, self.a, self.b, self.key = fields

    def take(self, chosen: np.ndarray) -> Windows:
        return Windows(self.text, self.ids, self.order, *(x[chosen] for x in self.fields))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that a window lacks on the left and on the right."""
        return self.a - (self.at - REACH), (self.at + LENGTH) - self.b

    def once(self) -> tuple[np.ndarray, bytes]:
        """Indexes of the first by place of all equal windows, by key, and spans of the others."""
        left, right = self.edges()
        offset = self.at - self.text.start[self.owner]
        place = (self.order[self.owner] << 40) | offset
        same = mix(self.text.hashes(self.a, self.b) + (left << 8 | right).astype(np.uint64))
        order = np.lexsort((place, same, self.key))
        same, key, place = same[order], self.key[order], place[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (same[1:] != same[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.empty(0, np.int64)
        again = np.flatnonzero(~new)
        # equal hashes are checked byte by byte; a window that differs after all is sent on its own
        equal = np.ones(len(again), dtype=bool)
        for i in range(0, len(again), CUT):
            x, y = order[again[i:i + CUT]], order[first[again[i:i + CUT]]]
            equal[i:i + CUT] = (left[x] == left[y]) & (right[x] == right[y]) & (self.bytes(x) == self.bytes(y)).all(axis=1)
        new[again[~equal]] = True
        sure = again[equal]
        sure = order[sure[place[sure] != place[first[sure]]]]
        begin = self.text.start[self.owner[sure]]
        return order[new], _spans(self.ids, self.owner[sure], self.a[sure] - begin, self.b[sure] - begin)

    def bytes(self, chosen: np.ndarray) -> np.ndarray:
        """Windows as rows; 0 where they lack bytes."""
        out = np.lib.stride_tricks.sliding_window_view(self.text.padded, WIDTH)[self.at[chosen]]
        left, right = (x[chosen, None] for x in self.edges())
        column = np.arange(WIDTH)
        out[(column < left) | (column >= WIDTH - right)] = 0
        return out

    def divided(self, level: int) -> Windows:
        """Parts of all windows, with a ``2 ** level``-th of their strings each, keyed by what these have in common."""
        bounds = np.linspace(0, REACH + 1, min(1 << level, REACH + 1) + 1).astype(np.int64)
        made = []
        for part, (low, high) in enumerate(zip(bounds[:-1], bounds[1:] - 1)):
            start = self.at - REACH
            a, b = np.maximum(self.a, start + low), np.minimum(self.b, start + high + LENGTH)
            held = np.flatnonzero(b - a >= LENGTH)
            x = self.take(held)
            shared = self.text.hashes(x.at - REACH + high, x.at - REACH + low + LENGTH)
            made.append((x.at, x.owner, a[held], b[held], mix(x.key + mix(shared + np.uint64(part)))))
        return Windows(self.text, self.ids, self.order, *map(np.concatenate, zip(*made)))

    def rows(self, bits: int) -> Iterator[pa.RecordBatch]:
        """Windows that are sorted by key as rows."""
        for i in range(0, len(self.at), SORTED):
            x = self.take(slice(i, i + SORTED))
            record = np.zeros(len(x.at), dtype=RECORD)
            record["null"], record["doc"], record["mark"] = self.ids[x.owner].T
            record["at"] = x.at - self.text.start[x.owner]
            record["left"], record["right"] = x.edges()
            for j in range(0, len(x.at), CUT):
                record["window"][j:j + CUT] = x.bytes(np.arange(j, min(j + CUT, len(x.at))))
            yield _rows(0, x.key >> np.uint64(64 - bits), 1, record)


def _order(ids: np.ndarray) -> np.ndarray:
    """Rank of documents by id, NULL last, and mark; rows of one document have the same."""
    order = np.lexsort(ids.T[[2, 1, 0]])
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]).any(axis=1)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _window_packer(bits: int):
    unknown = _unknown(bits)

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _batches(rows):
            text = Bytes([r[2] for r in held])
            at, hashes, owners, least = text.anchors()
            keys = mix(hashes)
            # the bits that tokens lack are left out of the comparison, too
            short = (keys & ~unknown).view(np.int64)
            level = np.full(len(at), -1)
            for a, b in _cuts(owners):
                wanted = np.asarray(held[owners[a]][3], dtype=np.int64)
                if len(wanted):
                    near = wanted[np.minimum(np.searchsorted(wanted & ~_LEVEL, short[a:b]), len(wanted) - 1)]
                    level[a:b] = np.where(near & ~_LEVEL == short[a:b], near & _LEVEL, -1)
            hit = level >= 0
            level, at = level[hit], at[hit]
            ids = np.array([(r[0] is None, r[0] or 0, r[1]) for r in held], dtype=np.int64)
            found = Windows(text, ids, _order(ids), at, owners[hit], *_reach(least, at, hashes[hit]), keys[hit])
            first, later = found.once()
            laters = [later]
            yield from found.take(first[level[first] == 0]).rows(bits)
            for k in np.unique(level[first][level[first] > 0]).tolist():
                whole = found.take(first[level[first] == k])
                step = max(1, SORTED >> k)
                for i in range(0, len(whole.at), step):
                    parts = whole.take(slice(i, i + step)).divided(k)
                    kept, later = parts.once()
                    laters.append(later)
                    yield from parts.take(kept).rows(bits)
            if any(laters):
                spread = int(keys[0] >> np.uint64(64 - bits))
                yield _table([(0, spread, 2, later) for later in laters if later])

    return pack


def _reach(least: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of the first, and end of the last string in which an anchor has the smallest hash.

    Both depend on these strings alone, so equal strings lie in the windows of all their copies.
    """
    first, last = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    around = np.lib.stride_tricks.sliding_window_view(least, REACH + 1)
    for i in range(0, len(at), CUT):
        own = around[at[i:i + CUT]] == hashes[i:i + CUT, None]
        first[i:i + CUT] = at[i:i + CUT] - REACH + own.argmax(axis=1)
        last[i:i + CUT] = at[i:i + CUT] - own[:, ::-1].argmax(axis=1)
    return first, last + LENGTH


def _spans(ids: np.ndarray, owners: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """Spans of at least ``LENGTH`` bytes, merged per document."""
    keep = end - start >= LENGTH
    owners, start, end = owners[keep], start[keep], end[keep]
    order = np.lexsort((start, owners))
    owners, start, end = owners[order], start[order], end[order]
    if not len(owners):
        return b""
    reach = np.maximum.accumulate(end + owners * np.int64(2**40)) - owners * np.int64(2**40)
    new = np.ones(len(owners), dtype=bool)
    new[1:] = (owners[1:] != owners[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    out = np.zeros(len(at), dtype=SPAN)
    out["null"], out["doc"], out["mark"] = ids[owners[at]].T
    out["start"], out["end"] = start[at], np.maximum.reduceat(end, at)
    return out.tobytes()


# --- columns --------------------------------------------------------------------------------


def _least_between(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest of ``x[a + 1 .. b]`` for arrays of ``a < b``."""
    level = (np.frexp(b - a)[1] - 1).astype(np.uint8)
    by = np.argsort(level, kind="stable")
    a, b = a[by], b[by]
    found = np.empty(len(a), dtype=x.dtype)
    row, span, done = x, 1, 0
    for n in np.bincount(level).tolist():
        to = done + n
        np.minimum(row[a[done:to] + 1], row[b[done:to] - (span - 1)], out=found[done:to])
        done = to
        if 2 * span <= len(x):
            row = np.minimum(row[: len(row) - span], row[span:])
        span *= 2
    out = np.empty(len(a), dtype=x.dtype)
    out[by] = found
    return out


def later_strings(windows: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For every window and start, whether that string of ``LENGTH`` symbols has an earlier place.

    ``rank`` orders the windows by place. Strings that reach beyond ``left`` or ``right`` do not count.
    """
    n, width = windows.shape
    columns, left, right = map(np.ascontiguousarray, (windows.T, left, right))
    order, common = np.arange(n), np.zeros(n, dtype=np.int16)
    late = np.zeros((width - LENGTH + 1, n), dtype=bool)
    none = np.iinfo(np.int64).max
    for column in range(width):
        symbol = columns[column][order]
        step = np.argsort(symbol, kind="stable")
        longer = np.zeros(n, dtype=np.int16)
        sorted_symbol = symbol[step]
        pair = np.flatnonzero(sorted_symbol[1:] == sorted_symbol[:-1]) + 1
        if len(pair):
            longer[pair] = np.minimum(_least_between(common, step[pair - 1], step[pair]) + 1, LENGTH)
        order, common = order[step], longer
        start = column - LENGTH + 1
        if start >= 0:
            runs = np.flatnonzero(common < LENGTH)
            valid = (left[order] <= start) & (width - right[order] > column)
            ranks = np.where(valid, rank[order], none)
            first = np.repeat(np.minimum.reduceat(ranks, runs), np.diff(np.append(runs, n)))
            late[start, order] = valid & (ranks > first)
    return late.T


def _collections(parts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Windows of a few anchors at a time, all of an anchor together; those alone around theirs equal no other."""
    keys = np.empty(sum(map(len, parts)), dtype=np.uint64)
    ends = np.cumsum([0, *map(len, parts)])
    for a, b, part in zip(ends[:-1], ends[1:], parts):
        anchor = np.ascontiguousarray(part["window"][:, REACH:REACH + K]).view(np.uint64)
        keys[a:b] = 0
        for column in anchor.T:
            keys[a:b] = mix(keys[a:b] + column)
    order = np.argsort(keys)
    value = keys[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.empty(0, np.int64)
    times = np.diff(np.append(first, len(value)))
    several = np.where(times > 1, times, 0)
    number = np.where(times > 1, (np.cumsum(several) - several) // SORTED, -1)
    keys[order] = np.repeat(number, times).view(np.uint64)
    numbers = keys.view(np.int64)
    for k in np.unique(number[number >= 0]).tolist():
        yield np.concatenate([part[numbers[a:b] == k] for a, b, part in zip(ends[:-1], ends[1:], parts)])


def _late_spans(record: np.ndarray) -> np.ndarray:
    """Spans of strings that have an earlier place in a collection."""
    place = np.stack([record["null"].astype(np.int64), record["doc"], record["mark"], record["at"]], axis=1)
    order = np.lexsort(place.T[::-1])
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (place[order][1:] != place[order][:-1]).any(axis=1)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    late = later_strings(record["window"], record["left"], record["right"], rank)
    edge = np.zeros((len(late), 1), dtype=bool)
    turn = np.diff(np.concatenate([edge, late, edge], axis=1).view(np.int8), axis=1)
    row, first = np.nonzero(turn == 1)
    last = np.nonzero(turn == -1)[1] - 1
    out = np.zeros(len(row), dtype=SPAN)
    for name in ("null", "doc", "mark"):
        out[name] = record[name][row]
    out["start"], out["end"] = record["at"][row] - REACH + first, record["at"][row] - REACH + last + LENGTH
    return out


def _mark(table: pa.Table) -> pa.Table:
    """Spans of bytes to remove, from the windows of a range of keys and from what batches have found."""
    parts = [*_payloads(table, 2, SPAN), *map(_late_spans, _collections(_payloads(table, 1, RECORD)))]
    spans = np.concatenate(parts) if parts else np.empty(0, dtype=SPAN)
    columns = {"doc_id": pa.array(spans["doc"].astype(np.int64), mask=spans["null"] == 1)}
    return pa.table(columns | {name: pa.array(spans[name].astype(np.int64)) for name in ("mark", "start", "end")})


# --- the operator ---------------------------------------------------------------------------


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text) and ``text``, the form that both joins shuffle once."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def repeated_spans(rows: DataFrame, bits: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Of rows from :func:`documents`: ``doc_id``, ``mark`` (hash of the text), ``spans``: sorted, disjoint (start, end) in bytes.

    Rows with equal doc_id and text are one document, so they do not remove each other. A NULL
    doc_id comes last in the order. Anchors with more than ``crowd`` windows have them divided.
    """
    spark = rows.sparkSession
    ship_package(spark)
    small_batches(spark)
    bits = bits or max(8, min(30, (8 * rows.rdd.getNumPartitions()).bit_length()))
    packed = rows.mapInArrow(_anchor_packer(bits), _PACKED).groupBy("bucket").applyInPandas(lambda frame: _repeated(frame, crowd), _PACKED)
    anchors = packed.groupBy("batch").applyInPandas(_anchor_collector(bits), "doc_id long, mark long, anchors array<long>")
    anchors = materialize(anchors, "anchors").dropDuplicates(["doc_id", "mark"]).select(
        F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "anchors")
    both = rows.join(anchors, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")))
    sent = both.select("doc_id", "mark", "text", "anchors").mapInArrow(_window_packer(bits), _PACKED)
    marks = sent.groupBy("bucket").applyInArrow(_mark, "doc_id long, mark long, start long, end long")
    spans = marks.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("all"))

    def merge(done, x):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(F.coalesce(x["start"] <= last["end"], F.lit(False)), grown).otherwise(F.concat(done, F.array(x)))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return spans.select("doc_id", "mark", F.aggregate("all", none, merge).alias("spans"))


def without_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id``, ``kept`` (remaining bytes), ``n_bytes``, ``spans`` for every row from :func:`documents`."""
    found = spans.select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "spans")
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left")
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for text, spans_ in zip(texts, removed):
            kept, done = [], 0
            for s in spans_ if spans_ is not None else ():
                kept.append(text[done:s["start"]])
                done = s["end"]
            out.append(b"".join([*kept, text[done:]]))
        return pd.Series(out)

    changed = F.col("spans").isNotNull()
    return rows.select(
        "doc_id", F.when(changed, cut(data, F.col("spans"))).otherwise(data).alias("kept"),
        F.octet_length(data).cast("long").alias("n_bytes"), "spans")


def suffix_dedup(docs: DataFrame, bits: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Every row of ``docs`` without its repeated strings; see :func:`without_spans`.

    NULL text counts as empty; other columns are left out, so their names cannot clash.
    """
    rows = documents(docs)
    return without_spans(rows, repeated_spans(rows, bits, crowd))
