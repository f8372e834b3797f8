"""N-gram Jaccard join (operator 3) with Bayesian candidate pruning.

Documents whose five-word shingle sets are equal form a class; only classes are
compared.  Classes that agree on a band of MinHash values are linked to the
band's least class; the components of these links hold every candidate pair
(a pair at the threshold shares none of the 32 bands of 4 values with
probability 5e-8).  A component is cut into blocks by hash, and each pair of
blocks is one group of rows: MinHash values are compared 32 at a time, a pair is
dropped once the posterior probability that its Jaccard reaches the threshold
(uniform prior) is below TOLERANCE, and what remains is verified exactly on the
shingle sets.  Pairs stay inside the task; a row leaves it for each class, with
its number of linked documents and the least class it is linked with there.

Memory: two blocks of about BLOCK classes at a time, whatever a component's
size.  Equal documents never multiply.

Defined results: words are those of operator 2, lower-cased; a text of one to
four words has one shingle of all its words; null text and text without words
is linked to nothing and is its own class; repeated ids are documents of their
own with a common id; null ids are passed over where a least id is taken, a
class or group without any id has null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.salting import attach
from .common import checkpointed
from .components import components
from .decontaminate import words_of

SHINGLE = 5
THRESHOLD = 0.8
HASHES, STEP, ROWS = 128, 32, 4  # MinHash values, compared at a time, in a band
TOLERANCE = 1e-12
BLOCK = 1024
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _family() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of the MinHash functions."""
    seeds = _mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(h) - SHINGLE + 1, 1)
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(min(SHINGLE, len(h))):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(_mixed(acc))


def signature(s: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """HASHES MinHash values (uint32) of a non-empty shingle set."""
    a, b = family
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(s), 2048):
        v = (s[i : i + 2048, None] * a + b) >> np.uint64(32)
        out = np.minimum(out, v.min(axis=0).astype(np.uint32))
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values: the fewest matches with which a pair stays.

    With a uniform prior, m matches of n leave P(J >= t) = P(Bin(n + 1, t) <= m).
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _candidates(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of signature rows that outlast the pruning."""
    xs, ys = [], []
    for i in range(0, len(a), 256):
        part = a[i : i + 256]
        hits = np.zeros((len(part), len(b)), dtype=np.uint8)
        for k in range(STEP):
            hits += part[:, k, None] == b[None, :, k]
        x, y = np.nonzero(hits >= least[STEP])
        x += i
        if same:
            x, y = x[x < y], y[x < y]
        xs.append(x)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    for n in range(2 * STEP, HASHES + 1, STEP):
        keep = [np.zeros(0, dtype=bool)]
        for i in range(0, len(x), 200_000):
            p, q = x[i : i + 200_000], y[i : i + 200_000]
            keep.append((a[p, :n] == b[q, :n]).sum(axis=1) >= least[n])
        keep = np.concatenate(keep)
        x, y = x[keep], y[keep]
    return x, y


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections a[x] and b[y]."""
    if len(x) < 4 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in zip(x.tolist(), y.tolist())], dtype=np.int64)
    sets = a + b
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    common = np.zeros((len(a), len(b)), dtype=np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[owner[lo:hi], column[lo:hi] - first] = 1
        common += m[: len(a)] @ m[len(a) :].T
    return common[x, y].astype(np.int64)


def _linked(rows: list[tuple], diagonal: bool, threshold: float, least: dict[int, int]) -> list[tuple[int, int, int]]:
    """(class, linked documents, least linked class) of one group; rows: class, size, on the left, signature, shingles."""
    left = [r for r in rows if r[2]]
    right = left if diagonal else [r for r in rows if not r[2]]
    members = left if diagonal else left + right
    links, parent = dict.fromkeys([r[0] for r in members], 0), {r[0]: r[0] for r in members}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    if left and right:
        sa, sb = np.stack([r[3] for r in left]), np.stack([r[3] for r in right])
        x, y = _candidates(sa, sb, diagonal, least)
        a, b = [r[4] for r in left], [r[4] for r in right]
        common = _overlaps(a, b, x, y)
        na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
        good = common >= threshold * (na[x] + nb[y] - common) - 1e-9
        for i, j in zip(x[good].tolist(), y[good].tolist()):
            p, q = left[i], right[j]
            links[p[0]] += q[1]
            links[q[0]] += p[1]
            u, v = root(p[0]), root(q[0])
            if u != v:
                parent[max(u, v)] = min(u, v)
    return [(r[0], links[r[0]], root(r[0])) for r in members]


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: id_col, class_id (least id with the same shingle set), group_id (least id in the
    component of links), n_links (other documents at the threshold or above, equal ones included)."""
    return grouped(docs, threshold, id_col).drop("hash", "group_hash")


def grouped(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """jaccard_join's rows with hash (of the text) and group_hash: group_id and group_hash name the group's first
    document, by id (null last) and hash, so groups with a common least id stay apart."""
    family, least = _family(), least_matches(threshold)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands = [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                keys.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s, family)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "hash", "key", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("hash"))
    found = checkpointed(rows.mapInArrow(features, f"id {kind}, hash long, key string, bands array<long>"))
    # a class has a node of its own, fixed by the checkpoint: ids may be null or another text's too
    classes = checkpointed(
        found.where("key is not null").groupBy("key")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "bands")).alias("first"), F.count(F.lit(1)).alias("size"))
        .select(F.monotonically_increasing_id().alias("node"), "key", "size", "first.none", F.col("first.id").alias("class"), F.col("first.hash").alias("class_hash"), "first.bands")
    )
    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top").select("band", "b")
    near = components(bands.join(shared, "band").select(F.col("node").alias("a"), "b").where("a <> b").distinct())

    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("n")).select("root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # one component may hold most nodes: its rows are dealt over many tasks wherever its root is the key
    members = attach(near, sizes, "root", [F.col("node")]).join(classes.select("node", "size", "key", "class", "class_hash"), "node")
    with_id = rows.join(members, (rows["id"] == members["class"]) & (rows["hash"] == members["class_hash"]))
    id_less = rows.where("id is null").select("text", "hash").dropDuplicates(["hash", "text"])
    id_less = id_less.join(members.where("class is null"), F.col("hash") == F.col("class_hash"))
    wanted = ["node", "size", "root", "blocks", "key", "text"]
    texts = with_id.select(*wanted).unionByName(id_less.select(*wanted))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t) for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            # equal hashes may be another text's too: only the class's own set counts
            own = [i for i, (s, k) in enumerate(zip(made, batch.column("key").to_pylist())) if xxhash.xxh3_128_hexdigest(s.tobytes()) == k]
            rest = [batch.column(c).take(pa.array(own, pa.int64())) for c in ("node", "size", "root", "blocks", "block")]
            sigs, packed = [signature(made[i], family).tobytes() for i in own], [made[i].tobytes() for i in own]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sigs, pa.binary()), pa.array(packed, pa.binary())], names=["node", "size", "root", "blocks", "block", "sig", "set"])

    wide = texts.select("node", "size", "root", "blocks", block.alias("block"), "key", "text").mapInArrow(
        sets, "node long, size long, root long, blocks int, block int, sig binary, set binary"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = wide.select("*", other).select(
        "node", "size", "root", "blocks", "sig", "set",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left"),
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                yield from batch.to_pylist()

        def result(group: list[tuple], key: tuple) -> pa.RecordBatch:
            out = _linked(group, key[1] == key[2], threshold, least)
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([key[3]] * len(out), pa.int32())],
                names=["node", "links", "least", "blocks"],
            )

        key, group = None, []
        for r in rows():
            k = (r["root"], r["i"], r["j"], r["blocks"])
            if k != key:
                if group:
                    yield result(group, key)
                key, group = k, []
            if group and group[-1][0] == r["node"] and group[-1][2] == r["left"]:
                continue  # a repeated row of the class's document
            group.append((r["node"], r["size"], r["left"], np.frombuffer(r["sig"], np.uint32), np.frombuffer(r["set"], np.uint64)))
        if group:
            yield result(group, key)

    compared = checkpointed(
        pairs.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "node", "left")
        .mapInArrow(compare, "node long, links long, least long, blocks int")
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("links"), F.min("least").alias("least"), F.max("blocks").alias("blocks"))
    split = compared.where("blocks > 1 and node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    groups = links.where("blocks = 1").select("node", F.col("least").alias("root"))
    if not split.isEmpty():
        groups = groups.unionByName(components(split))
    first = F.struct("none", F.col("class").alias("id"), F.col("class_hash").alias("hash"))
    by_node = (
        classes.select("node", "key", "class", "size", first.alias("first"))
        .join(links.select("node", "links"), "node", "left").join(groups, "node", "left")
    )
    leasts = by_node.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    by_class = attach(by_node, leasts, "root", [F.col("node")]).select("key", "class", "size", "links", F.coalesce("least", "first").alias("group"))
    out = found.select("id", "hash", "key").join(by_class, "key", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class")).alias("class_id"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("group.id")).alias("group_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("size", F.lit(1)) - 1).cast("long").alias("n_links"),
        "hash",
        F.when(F.col("key").isNull(), F.col("hash")).otherwise(F.col("group.hash")).alias("group_hash"),
    )
