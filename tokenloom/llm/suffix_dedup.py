"""Suffix-array dedup (operator 9): every byte of a 200-byte string that also starts elsewhere.

Each place of a text has one 200-byte window; its anchor is the 32-byte string
of least hash inside it (the last of equals), so equal windows have equal
anchors at equal offsets.  The windows of one anchor place are consecutive and
make a context of about 285 bytes.

1. Tasks send the hashes of anchors; each range of hash slots becomes a bit map
   of the slots met more than once, written to the shared folder.
2. Tasks read the texts again, look their anchors up in the memory-mapped bit
   maps, and send the contexts of anchors that may repeat, by anchor.
3. A task takes the contexts of many anchors at a time, as one text of block
   symbols, and sorts its suffixes by linear grouping (suffix_groups.py).
   Neighbours in that order with equal contexts are repeats throughout.  For
   the distinct contexts that remain under one anchor, every window is checked
   exactly enough by a 64-bit hash of its 200 bytes.
4. The repeated byte spans are merged for each text and cut out.

What a task holds is bounded by BATCH contexts and by one anchor's contexts.
Hash equality stands for string equality (64 bits, over the contexts of a batch).
The order of the suffixes only brings equal contexts together: windows that
contexts share in part are found by their hashes (see the README on why).

Defined results: null text is empty; a text below 200 bytes keeps all; repeated
rows are documents of their own, so each repeats the other; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import new_folder
from .lm_trie import read_arrays, write_arrays
from .suffix_groups import suffix_order

LENGTH = 200
GRAM = 32
BLOCK = 64  # bytes of a context that make one symbol
SEGMENT = 1 << 19  # windows of a text handled at a time
BATCH = 40_000  # contexts sorted at a time
SLOT_BITS = 16  # slots for each anchor expected
RANGE_BITS = 28  # slots of one bit map, a byte each while its task counts
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


class Hasher:
    """Hashes of all strings of one length in a byte array."""

    def __init__(self, size: int):
        self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def __call__(self, data: np.ndarray, length: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        n = len(data) - length + 1
        x = (sums[length:] - sums[:n]) * self.down[:n]
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return x ^ (x >> np.uint64(31))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` keys."""
    n = len(keys) - width + 1
    rows = -(-len(keys) // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[: len(keys)] = keys
    grid = grid.reshape(rows, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, hasher: Hasher) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each segment: (its first byte, first window and number of windows of each anchor, anchor hash)."""
    for first in range(0, len(data) - LENGTH + 1, SEGMENT):
        part = data[first : first + SEGMENT + LENGTH - 1]
        h = hasher(part, GRAM)
        low = np.uint64(20)
        keys = ((h >> low) << low) | (np.uint64((1 << 20) - 1) - np.arange(len(h), dtype=np.uint64))
        best = _least(keys, LENGTH - GRAM + 1)
        at = ((1 << 20) - 1) - (best & np.uint64((1 << 20) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        yield first, starts, np.diff(np.append(starts, len(at))), h[at[starts]]


def _hasher() -> Hasher:
    return Hasher(SEGMENT + LENGTH)


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    """Slots spread evenly: anchors are least hashes, so the hash itself is not."""
    return ((h * np.uint64(_BASE)) >> np.uint64(64 - bits)).astype(np.int64)


def _filter(texts: DataFrame, bits: int, parts: int, folder: str) -> None:
    """Write the bit maps of slots that more than one anchor falls to, one file for each range of slots."""
    span = (1 << bits) // parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = _hasher(), [], 0

        def packed() -> pa.RecordBatch:
            slots, n = np.unique(np.concatenate(held), return_counts=True)
            twice = np.repeat(slots, np.minimum(n, 2))
            edges = np.searchsorted(twice, np.arange(parts + 1) * span)
            some = [k for k in range(parts) if edges[k + 1] > edges[k]]
            blobs = [(twice[edges[k] : edges[k + 1]] - k * span).astype("<u4").tobytes() for k in some]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "slots"])

        for batch in batches:
            for text in batch.column(batch.schema.names.index("text")).to_pylist():
                for _, _, _, h in anchors(np.frombuffer(text.encode(), np.uint8), hasher):
                    held.append(_slots(h, bits))
                    size += len(h)
                if size >= 1_000_000:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = None, None

        def finished() -> pa.RecordBatch:
            size = write_arrays(f"{folder}/{part}.bits", [np.packbits(seen >= 2, bitorder="little")])
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], names=["size"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part:
                    if part is not None:
                        yield finished()
                    part, seen = r["part"], np.zeros(span, dtype=np.uint8)
                slots, n = np.unique(np.frombuffer(r["slots"], "<u4"), return_counts=True)
                seen[slots] = np.minimum(seen[slots] + n, 2)
        if part is not None:
            yield finished()

    sent = texts.select("text").mapInArrow(send, "part int, slots binary")
    sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(write, "size long").agg(F.sum("size")).collect()


def _contexts(texts: DataFrame, bits: int, parts: int, folder: str) -> DataFrame:
    """id, key, anchor, first (byte), windows, bytes: contexts whose anchor's slot was met more than once."""
    span = (1 << bits) // parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, maps = _hasher(), {}

        def repeated(h: np.ndarray) -> np.ndarray:
            slots = _slots(h, bits)
            part, out = slots // span, np.zeros(len(h), dtype=bool)
            for k in np.unique(part).tolist():
                if k not in maps:
                    maps[k] = read_arrays(f"{folder}/{k}.bits")[0]
                own = np.flatnonzero(part == k)
                rest = slots[own] - k * span
                out[own] = (maps[k][rest >> 3] >> (rest & 7)) & 1
            return out

        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                for begin, starts, windows, h in anchors(np.frombuffer(raw, np.uint8), hasher):
                    hit = np.flatnonzero(repeated(h))
                    firsts = begin + starts[hit]
                    counts = windows[hit]
                    for a, s, n in zip(h[hit].view(np.int64).tolist(), firsts.tolist(), counts.tolist()):
                        rows.append((key, a, s, n, raw[s : s + n - 1 + LENGTH]))
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "anchor", "first", "windows", "bytes"])

    return texts.select("key", "text").mapInArrow(send, "key long, anchor long, first long, windows int, bytes binary")


def repeated_windows(rows: list[tuple[int, bytes]], hasher: Hasher) -> list[np.ndarray | None]:
    """For each (anchor, context): None if all its windows repeat, else a flag for each window.

    All contexts of an anchor must be among the rows.
    """
    out: list[np.ndarray | None] = [np.zeros(len(b) - LENGTH + 1, dtype=bool) for _, b in rows]
    # one text: a context's blocks as symbols, then a separator; 0 ends it
    seen: dict[bytes, int] = {}
    text: list[int] = []
    starts = {}
    for i, (anchor, b) in enumerate(rows):
        starts[len(text)] = i
        for k in range(0, len(b), BLOCK):
            block = b[k : k + BLOCK]
            text.append(seen.setdefault(block, len(seen) + 2))
        text.append(1)
    text.append(0)
    before, kept = None, []
    for at in suffix_order(text):
        i = starts.get(at)
        if i is None:
            continue
        if before is not None and rows[before] == rows[i]:
            out[before] = out[i] = None
        else:
            kept.append(i)  # the first of equal contexts
        before = i
    by_anchor: dict[int, list[int]] = {}
    for i in kept:
        by_anchor.setdefault(rows[i][0], []).append(i)
    members = [g for g in by_anchor.values() if len(g) > 1]
    if not members:
        return out
    # windows of the distinct contexts that share an anchor
    for lo, hi in _cuts(members, 8 << 20, rows):
        part = [i for g in members[lo:hi] for i in g]
        hashes, owner = [], []
        for i in part:
            hashes.append(hasher(np.frombuffer(rows[i][1], np.uint8), LENGTH))
            owner.append(len(hashes[-1]))
        _, which, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        flags, at = times[which] > 1, 0
        for i, n in zip(part, owner):
            if out[i] is not None:
                out[i] = flags[at : at + n].copy()
            at += n
    return out


def _cuts(groups: list[list[int]], limit: int, rows: list) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups of about `limit` bytes."""
    lo, size = 0, 0
    for k, g in enumerate(groups):
        size += sum(len(rows[i][1]) for i in g)
        if size >= limit:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(groups):
        yield lo, len(groups)


def _spans(contexts: DataFrame, parts: int) -> DataFrame:
    """key, start, stop: repeated byte spans."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        held: list[tuple] = []  # key, first, anchor, bytes

        def result(rows: list[tuple]) -> pa.RecordBatch:
            keys, a, b = [], [], []
            for (key, first, _, data), flags in zip(rows, repeated_windows([(r[2], r[3]) for r in rows], hasher)):
                if flags is None:
                    runs = [(0, len(data) - LENGTH)]
                else:
                    at = np.flatnonzero(flags)
                    if not len(at):
                        continue
                    cut = np.flatnonzero(np.diff(at) > LENGTH)
                    runs = zip(at[np.concatenate(([0], cut + 1))].tolist(), at[np.concatenate((cut, [len(at) - 1]))].tolist())
                for s, e in runs:
                    keys.append(key)
                    a.append(first + s)
                    b.append(first + e + LENGTH)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, a, b)], names=["key", "start", "stop"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "anchor", "bytes"))):
                if len(held) >= BATCH and held[-1][2] != r[2]:
                    yield result(held)
                    held = []
                held.append(r)
        if held:
            yield result(held)

    return contexts.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(find, "key long, start long, stop long")


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", clean: bool = False) -> DataFrame:
    """id_col, n_bytes, n_removed, spans (removed bytes: start, stop), kept_sha256.

    clean: the documents themselves instead, their text what is left (a cut character's bytes go with it).
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    others = [c for c in docs.columns if c not in (id_col, "text")] if clean else []
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(1), F.col(id_col), text).alias("key"), text.alias("text"), rest.alias("rest"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a power of two of slots, in as many ranges; a range has 2 ** RANGE_BITS slots at most, so offsets fit 32 bits
    bits = max((SLOT_BITS * size // 85).bit_length(), 16)
    range_bits = max(max(parts - 1, 1).bit_length(), bits - RANGE_BITS)
    ranges, bits = 1 << range_bits, max(bits, range_bits + 1)
    folder = new_folder(spark, "anchor-bits")
    _filter(texts.where(F.octet_length("text") >= LENGTH), bits, ranges, folder)
    spans = _spans(_contexts(texts.where(F.octet_length("text") >= LENGTH), bits, ranges, folder), parts)
    by_text = spans.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")).withColumnRenamed("key", "span_key")
    joined = texts.join(by_text, texts["key"] == F.col("span_key"), "left")
    id_type, dtype = to_arrow_type(docs.schema[id_col].dataType), docs.schema[id_col].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, spans, digests, cleaned = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                runs = merged((s["start"], s["stop"]) for s in found or ())
                left, last = [], 0
                for a, b in runs:
                    left.append(raw[last:a])
                    last = b
                rest = b"".join([*left, raw[last:]])
                n_bytes.append(len(raw))
                removed.append(len(raw) - len(rest))
                spans.append([{"start": a, "stop": b} for a, b in runs])
                digests.append(hashlib.sha256(rest).hexdigest())
                cleaned.append(rest.decode("utf-8", "ignore") if clean else None)
            columns = [batch.column(0).cast(id_type), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span_type), pa.array(digests, pa.string())]
            names = [id_col, "n_bytes", "n_removed", "spans", "kept_sha256"]
            if clean:
                columns += [pa.array(cleaned, pa.string()), batch.column(3)]
                names += ["text", "rest"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {dtype}, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    if not clean:
        return joined.select("id", "text", "spans").mapInArrow(cut, schema)
    kind = joined.schema["rest"].dataType.simpleString()
    out = joined.select("id", "text", "spans", "rest").mapInArrow(cut, f"{schema}, text string, rest {kind}")
    return out.select(*[F.col(f"rest.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])
