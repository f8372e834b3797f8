"""LM scoring (operator 10): a bigram model in a sharded Elias-Fano trie (lm_trie.py).

Counting: tasks count words and word pairs of the training documents in blocks
of BLOCK_TOKENS tokens and send each shard (by the context word's hash) one
packed, sorted array per block.  A shard's task sums them, discounts the pairs
(absolute discounting; every pair is stored), and writes its trie into the shared
folder.  What is gathered
grows with the corpus; the driver gets two numbers a shard.

Scoring: tasks look up a block's distinct words and pairs, shard by shard, in
the memory-mapped files.  P(w | u) = gain(u, w) + backoff(u) * P(w), and P(w) is
the base model, (c + 0.1) / (N + 0.1 * (V + 1)).

Words are 64-bit hashes, successors 40-bit ones; probabilities are quantised to
16 bits of their logarithm.

Defined results: null text is empty; an empty text is the end token alone;
with no training documents N and V are 0 and every document's tokens are
unknown; repeated rows are trained on and scored each; a null id counts as the
text '' for the split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import new_folder
from .lm_trie import ID_BITS, Shard, read_arrays, write_arrays

BLOCK_TOKENS = 3_000_000
DISCOUNT = 0.75
LEAST_PAIR = 1  # every pair that was counted
END, BEGIN = xxhash.xxh3_64_intdigest(b"\nend"), xxhash.xxh3_64_intdigest(b"\nbegin")  # no words: they hold white space
_ID = np.uint64((1 << ID_BITS) - 1)


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def token_hashes(text: str) -> np.ndarray:
    """The text's words, ASCII lower-cased, and the end token."""
    words = text.encode().lower().split()
    words.append(b"\nend")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _sums(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts (None: 1 each)."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _pair_sums(contexts: np.ndarray, ids: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, contexts))
    contexts, ids = contexts[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], (contexts[1:] != contexts[:-1]) | (ids[1:] != ids[:-1]))))
    if counts is None:
        sums = np.diff(np.append(first, len(ids)))
    else:
        sums = np.add.reduceat(counts[order], first)
    return contexts[first], ids[first], sums


def _pack_ids(ids: np.ndarray) -> bytes:
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : ID_BITS // 8].tobytes()


def _unpack_ids(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, ID_BITS // 8)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, : ID_BITS // 8] = raw
    return wide.reshape(-1).view(np.uint64)


class Model:
    """Where the trie's shards are, and the corpus totals."""

    def __init__(self, folder: str, shards: int, tokens: int, distinct: int):
        self.folder, self.shards, self.tokens, self.distinct = folder, shards, tokens, distinct

    def path(self, shard: int) -> str:
        return f"{self.folder}/shard-{shard:05d}.trie"


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def train(docs: DataFrame, shard_bits: int | None = None) -> Model:
    """Count the words and pairs of all rows' texts and write the trie."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(parts - 1, 1).bit_length() if shard_bits is None else shard_bits
    folder = new_folder(spark, "lm-trie")
    model = Model(folder, bits, 0, 0)

    def packed(tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        words = np.concatenate(tokens)
        ends = np.cumsum([len(t) for t in tokens])
        contexts = np.concatenate(([np.uint64(BEGIN)], words[:-1]))
        contexts[ends[:-1]] = BEGIN
        keys, counts = _sums(words)
        c, ids, pairs = _pair_sums(contexts, words & _ID, None)
        heads = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        runs = np.diff(np.append(heads, len(c))).astype(np.uint32)
        c = c[heads]
        starts = np.concatenate((heads, [len(ids)]))
        edges = [shard_of(keys, bits), shard_of(c, bits)]
        rows = []
        for s in np.union1d(edges[0], edges[1]).tolist():
            (a, b), (x, y) = (np.searchsorted(e, [s, s + 1]) for e in edges)
            lo, hi = int(starts[x]), int(starts[y])
            rows.append((s, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes(), c[x:y].tobytes(), runs[x:y].tobytes(), _pack_ids(ids[lo:hi]), _small(pairs[lo:hi])))
        types = [pa.int32(), *[pa.binary()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows), types)], names=list("swnckip"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                t = token_hashes(text)
                held.append(t)
                size += len(t)
                if size >= BLOCK_TOKENS:
                    yield from packed(held)
                    held, size = [], 0
        if held:
            yield from packed(held)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(shard: int, got: list[dict]) -> pa.RecordBatch:
            words, counts = _sums(np.concatenate([np.frombuffer(r["w"], np.uint64) for r in got]), np.concatenate([np.frombuffer(r["n"], np.uint32) for r in got]).astype(np.int64))
            contexts = np.concatenate([np.repeat(np.frombuffer(r["c"], np.uint64), np.frombuffer(r["k"], np.uint32)) for r in got])
            ids = np.concatenate([_unpack_ids(r["i"]) for r in got])
            pairs = np.concatenate([_large(r["p"]) for r in got])
            got.clear()
            contexts, ids, pairs = _pair_sums(contexts, ids, pairs) if len(ids) else (contexts, ids, pairs)
            tokens, distinct = int(counts.sum()), len(words)
            every = np.union1d(words, contexts)
            all_counts = np.zeros(len(every), dtype=np.int64)
            all_counts[np.searchsorted(every, words)] = counts
            start = shard << (64 - bits) if bits else 0
            size = write_arrays(model.path(shard), Shard.build(every, all_counts, contexts, ids, pairs, start, 64 - bits, DISCOUNT, LEAST_PAIR))
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (tokens, distinct, size)], names=["tokens", "distinct", "size"])

        shard, got = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["s"] != shard and got:
                    yield finished(shard, got)
                shard = r["s"]
                got.append(r)
        if got:
            yield finished(shard, got)

    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    blocks = text.mapInArrow(count, "s int, w binary, n binary, c binary, k binary, i binary, p binary")
    done = blocks.repartition(parts, "s").sortWithinPartitions("s").mapInArrow(build, "tokens long, distinct long, size long")
    total = done.agg(F.sum("tokens"), F.sum("distinct")).first()  # one row a shard, summed
    model.tokens, model.distinct = total[0] or 0, total[1] or 0
    return model


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes; 255 stands for one that follows, four bytes each."""
    big = counts >= 255
    return np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<u4").tobytes() + int(big.sum()).to_bytes(4, "little")


def _large(data: bytes) -> np.ndarray:
    many = int.from_bytes(data[-4:], "little")
    body = len(data) - 4 - 4 * many
    counts = np.frombuffer(data, np.uint8, body).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u4", many, body)
    return counts


def score(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_tokens, n_known, train_tokens, base_score, score."""
    id_type, dtype = to_arrow_type(docs.schema[id_col].dataType), docs.schema[id_col].dataType.simpleString()
    total = model.tokens + 0.1 * (model.distinct + 1)

    def looked_up(tokens: list[np.ndarray], before: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums over each array of tokens: known tokens, base and model log10 probabilities."""
        words = np.concatenate(tokens)
        starts = np.cumsum([0] + [len(t) for t in tokens[:-1]])
        contexts = np.concatenate(([np.uint64(0)], words[:-1]))
        contexts[starts] = np.array(before, dtype=np.uint64)
        kinds, which = np.unique(np.concatenate([words, np.array([BEGIN], dtype=np.uint64), contexts[starts]]), return_inverse=True)
        which, of_starts = which[: len(words)], which[len(words) + 1 :]
        context = np.concatenate(([0], which[:-1]))
        context[starts] = of_starts
        pairs, pair = np.unique(context * np.int64(len(kinds)) + which, return_inverse=True)
        pair_context, pair_word = pairs // len(kinds), pairs % len(kinds)
        count, weight, gain = np.zeros(len(kinds), dtype=np.int64), np.ones(len(kinds)), np.zeros(len(pairs))
        shards = shard_of(kinds, model.shards)
        edges = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True])))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):  # words and pairs are sorted by shard
            shard = opened(int(shards[a]))
            if shard is None:
                continue
            place, count[a:b], weight[a:b] = shard.word(kinds[a:b])
            x, y = np.searchsorted(pair_context, [a, b])
            at = place[pair_context[x:y] - a]
            known = np.flatnonzero(at >= 0)
            gain[x:y][known] = shard.gain(at[known], kinds[pair_word[x:y][known]] & _ID)
        single = (count + 0.1) / total
        both = gain + weight[pair_context] * single[pair_word]
        base, full = np.log10(single)[which], np.log10(both)[pair]
        return np.add.reduceat((count > 0)[which].astype(np.int64), starts), np.add.reduceat(base, starts), np.add.reduceat(full, starts)

    def opened(shard: int) -> Shard | None:
        try:
            return Shard(read_arrays(model.path(shard)), shard << (64 - model.shards) if model.shards else 0, 64 - model.shards)
        except FileNotFoundError:  # no training word fell to it
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums = [], []  # of the documents held: tokens, known, base, model
        parts, before, owner, held = [], [], [], 0

        def flush() -> None:
            nonlocal held
            for d, t, known, base, full in zip(owner, parts, *looked_up(parts, before)):
                s = sums[d]
                sums[d] = (s[0] + len(t), s[1] + int(known), s[2] + float(base), s[3] + float(full))
            parts.clear()
            before.clear()
            owner.clear()
            held = 0

        def rows() -> pa.RecordBatch:
            columns = [pa.array(ids, id_type), *(pa.array([s[k] for s in sums], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64())))]
            ids.clear()
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = token_hashes(text)
                ids.append(doc)
                sums.append((0, 0, 0.0, 0.0))
                for i in range(0, len(tokens), BLOCK_TOKENS):
                    parts.append(tokens[i : i + BLOCK_TOKENS])
                    before.append(int(tokens[i - 1]) if i else BEGIN)
                    owner.append(len(ids) - 1)
                    held += len(parts[-1])
                    if held >= BLOCK_TOKENS:
                        flush()
                if not parts:
                    yield rows()
        if parts:
            flush()
        if ids:
            yield rows()

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce("text", F.lit("")).alias("text"))
    out = rows.mapInArrow(run, f"`{id_col}` {dtype}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def lm_score(docs: DataFrame, id_col: str = "doc_id", shard_bits: int | None = None) -> DataFrame:
    """Train on the rows that are not held out, score all rows.

    shard_bits: the model has 2 ** shard_bits shards of at most 2 ** 24 distinct
    words each; by default about as many as there are shuffle partitions.
    """
    model = train(docs.where(~held_out(id_col)), shard_bits)
    return score(docs, model, id_col).withColumn("held_out", held_out(id_col))
