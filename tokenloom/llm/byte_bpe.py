"""Byte-level BPE encoding and decoding (operator 7) by corpus-level merge replay.

A task reads its documents in blocks.  The distinct pre-tokens of a block that
are not yet known are replayed together (merge_replay.py): an inverted index
from token pair to places applies every merge in rank order and updates only
the touched neighbours.  The ids of known pre-tokens stay in a memo of bounded
size; a document's ids are its pre-tokens' ids in order.

Documents are encoded where they are read: no shuffle.  The rank table (bounded
by the vocabulary) is broadcast.

Defined results: null text is empty; an empty text has no ids and decodes to no
bytes; repeated rows are encoded each; ids that the table lacks cannot arise,
as each byte is a token.  Other columns are ignored by `encode`.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import blocks, opened, shared
from .merge_replay import Ranks, pair_key, replay

MEMO = 250_000
#: Unicode white space, as the pattern's \s has it
WS = r"\u0009-\u000d \u0085   -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def white_space(pattern: str) -> str:
    """The pattern with \\s and \\S spelled out, so that every library reads them alike."""
    return pattern.replace(r"[^\s", "[^" + WS).replace(r"\S", f"[^{WS}]").replace(r"\s", f"[{WS}]")


class ByteModel:
    """Ranks, and the rank of every pair of tokens that joins to a token."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        get = self.ranks.get
        self.pairs = Ranks({
            pair_key(get(t[:i], -1), get(t[i:], -1)): r
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        })
        self.byte = np.array([get(bytes([b])) for b in range(256)], dtype=np.int64)
        self.made = np.arange(max(self.ranks.values()) + 1)  # a pair becomes the token of its rank

    def encode(self, words) -> dict[str, list[int]]:
        """The ids of each word, by one replay of all those that are no token themselves."""
        get, out, rest, spelled = self.ranks.get, {}, [], []
        for w in words:
            b = w.encode()
            whole = get(b)
            if whole is not None:
                out[w] = [whole]
            else:
                rest.append(w)
                spelled.append(b)
        if rest:
            symbols = self.byte[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
            ids, sizes = replay(symbols, np.array([len(b) for b in spelled], dtype=np.int64), self.pairs, self.made)
            ids, stops = ids.tolist(), np.cumsum(sizes).tolist()
            start = 0
            for w, stop in zip(rest, stops):
                out[w] = ids[start:stop]
                start = stop
        return out


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, ids (array of int): the whole text's token ids."""
    return _encoded(docs, ranks_path, pattern, id_col, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes they decode to."""
    return _encoded(docs, ranks_path, pattern, id_col, True)


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, digest: bool) -> DataFrame:
    held = shared(docs.sparkSession, ByteModel(ranks_path))
    dtype = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    splitter = white_space(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(held)
        find, memo = regex.compile(splitter).findall, {}
        spell = {i: b for b, i in model.ranks.items()}
        for ids, texts in blocks(batches):
            split = [find(t) for t in texts]
            fresh = set().union(*split).difference(memo)
            if len(memo) + len(fresh) > MEMO:
                memo.clear()
                fresh = set().union(*split)
            new = model.encode(fresh)
            if not digest:
                memo.update(new)
                coded = pa.array([[i for w in words for i in memo[w]] for words in split], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), coded], names=[id_col, "ids"])
                continue
            for w, x in new.items():  # number of ids, their digits, the bytes they decode to
                memo[w] = (len(x), b" ".join([b"%d" % i for i in x]), b"".join([spell[i] for i in x]))
            n, coded, decoded = [], [], []
            for words in split:
                got = [memo[w] for w in words]
                n.append(sum([g[0] for g in got]))
                coded.append(hashlib.sha256(b" ".join([g[1] for g in got])).hexdigest())
                decoded.append(hashlib.sha256(b"".join([g[2] for g in got])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    results = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"
    return rows.mapInArrow(run, f"`{id_col}` {dtype}, {results}")


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with `decoded` (binary) in place of the ids; null ids decode to null."""
    held = encoded.sparkSession.sparkContext.broadcast({i: b for b, i in read_ranks(ranks_path).items()})

    @F.pandas_udf("binary")
    def joined(column):
        spell = held.value
        return column.map(lambda x: None if x is None else b"".join(spell[int(i)] for i in x))

    return encoded.withColumn("decoded", joined(F.col(ids))).drop(ids)
