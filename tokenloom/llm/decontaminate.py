"""Benchmark decontamination (operator 2): an FM-index for each training shard.

A task cuts its documents into shards of bounded size.  A shard's words become
symbols (words that no test phrase holds share one, and runs of them count
once); the shard's suffix order gives the FM-index (fm_index.py).  Every test
phrase is searched backward through the wavelet matrix's ranks, its occurrences
are located by the sampled suffix positions, and the phrases' spans are merged
for each document.  A document longer than a shard is cut into pieces that
overlap by a phrase less one word, so no occurrence is lost.

Test phrases: WINDOW consecutive words of an item; a shorter item is one
phrase.  They are broadcast while they are below MAX_ITEM_BYTES of text; a
larger benchmark goes in several passes, each with a part of the items, over
rows that are numbered and written once; the passes' spans are merged by row,
and the text is cut once after that.

Defined results: null text and text without words has no words and no hit; an
empty benchmark or one without words hits nothing; repeated documents and items
are judged each, an item id counts once; null item ids count as ''.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpointed, opened, shared
from .fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1_000_000
MAX_ITEM_BYTES = 32 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A-Z to a-z, bytes that part words to spaces
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
OTHER = 1


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


class Phrases:
    """Test phrases as rows of symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(len(words) - window, 0) + 1 if words else 0):
                found.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.vocabulary = {w: i + OTHER + 1 for i, w in enumerate(sorted({w for p in found for w in p}))}
        self.top = len(self.vocabulary) + OTHER
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.rows = np.zeros((len(found), window), dtype=np.int64)
        for i, p in enumerate(found):
            self.rows[i, : len(p)] = [self.vocabulary[w] for w in p]


def search_shard(phrases: Phrases, pieces: list[np.ndarray]) -> list[list[tuple[int, int]]]:
    """For each piece (its words' symbols), the (word, phrase) of every occurrence."""
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    text = np.concatenate([x for p in pieces for x in (p, [OTHER])]).astype(np.int64)
    kept = np.concatenate(([True], (text[1:] != OTHER) | (text[:-1] != OTHER)))
    kept = np.flatnonzero(kept)
    if not len(phrases.rows) or not (text != OTHER).any():
        return out
    index = FMIndex(text[kept], phrases.top)
    lo, hi = index.search(phrases.rows, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    counts = (hi - lo)[found]
    which = np.repeat(found, counts)
    rows = np.repeat(lo[found] - np.cumsum(counts) + counts, counts) + np.arange(len(which))
    places = kept[index.locate(rows)]
    starts = np.cumsum([0] + [len(p) + 1 for p in pieces])
    piece = np.searchsorted(starts, places, side="right") - 1
    for k, word, phrase in zip(piece.tolist(), (places - starts[piece]).tolist(), which.tolist()):
        out[k].append((word, phrase))
    return out


def merged_spans(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of (from, to) spans that overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in re.finditer(WORD, text.translate({c: c + 32 for c in range(65, 91)}))]
    keep, last = [], 0
    for a, b in spans:
        keep.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join(keep) + text[last:]


def _pass(docs: DataFrame, phrases: Phrases, id_col: str, window: int, clean: bool) -> DataFrame:
    held_phrases = shared(docs.sparkSession, phrases)
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = opened(held_phrases)
        sizes = phrases.lengths.tolist()
        get = phrases.vocabulary.get
        docs_: list[list] = []  # id, words, hits, text, other columns; all but the last are complete
        pieces: list[tuple[int, int, np.ndarray]] = []  # document, first word, symbols
        held = 0

        def flush() -> None:
            nonlocal held
            for (d, first, _), found in zip(pieces, search_shard(phrases, [p for _, _, p in pieces])):
                docs_[d][2].update((first + w, k) for w, k in found)
            pieces.clear()
            held = 0

        def rows() -> pa.RecordBatch:
            spans = [merged_spans([(w, w + sizes[k]) for w, k in hits]) for _, _, hits, *_ in docs_]
            columns = [
                pa.array([d[0] for d in docs_], id_type),
                pa.array([d[1] for d in docs_], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array([sorted({i for _, k in hits for i in phrases.items[k]}) for _, _, hits, *_ in docs_], pa.list_(pa.string())),
            ]
            names = [id_col, "n_words", "spans", "items"]
            if clean:
                columns.append(pa.array([without_spans(d[3], s) if s else d[3] for d, s in zip(docs_, spans)], pa.string()))
                columns.append(pa.array([d[4] for d in docs_], rest_type))
                names += ["text", "rest"]
            docs_.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for doc, text, rest in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = words_of(text)
                symbols = np.fromiter(map(get, words, repeat(OTHER)), np.int32, len(words))
                docs_.append([doc, len(words), set(), text if clean else None, rest])
                for first in range(0, max(len(symbols), 1), SHARD_WORDS):
                    piece = symbols[first : first + SHARD_WORDS + window - 1]
                    pieces.append((len(docs_) - 1, first, piece))
                    held += len(piece)
                    if held >= SHARD_WORDS:
                        flush()
                if held == 0:
                    yield rows()
        if docs_:
            if pieces:
                flush()
            yield rows()

    text = F.coalesce(F.col("text"), F.lit("")).alias("__text")
    others = [c for c in docs.columns if c not in (id_col, "text")] if clean else []
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    rows_in = docs.select(F.col(id_col).alias("__id"), text, rest.alias("rest"))
    kind = rows_in.schema["rest"].dataType.simpleString()
    rest_type = to_arrow_type(rows_in.schema["rest"].dataType)
    schema = f"`{id_col}` {dtype}, n_words long, spans array<struct<start:long,stop:long>>, items array<string>"
    if not clean:
        return rows_in.mapInArrow(run, schema)
    out = rows_in.mapInArrow(run, f"{schema}, text string, rest {kind}")
    return out.select(*[F.col(f"rest.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, clean: bool = False, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_words, spans (merged word spans start, stop), items (ids that occur).

    clean: the documents themselves instead, their text without its spans.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // MAX_ITEM_BYTES) or 1

    def phrases(k: int) -> Phrases:
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k) if passes > 1 else items
        return Phrases([tuple(r) for r in part.collect()], window)

    if passes == 1:
        return _pass(docs, phrases(0), id_col, window, clean)
    # a row has a key of its own, fixed by the checkpoint: ids may be null or repeated
    own = [id_col, "text", *(c for c in docs.columns if clean and c not in (id_col, "text"))]
    numbered = checkpointed(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*own).alias("doc")))
    texts = numbered.select("key", F.col("doc.text").alias("text"))
    found = _pass(texts, phrases(0), "key", window, False)
    for k in range(1, passes):
        found = found.unionByName(_pass(texts, phrases(k), "key", window, False))
    spans = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.array().cast("array<struct<start:long,stop:long>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    merged = found.groupBy("key").agg(
        F.max("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    rows = numbered.join(merged, "key")
    if not clean:
        return rows.select(F.col(f"doc.`{id_col}`").alias(id_col), "n_words", "spans", "items")
    return _cut(rows.select("doc", "spans")).select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def _cut(rows: DataFrame) -> DataFrame:
    """doc and text: doc's text without the spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text").to_pylist()
            cut = [without_spans(t or "", [(x["start"], x["stop"]) for x in s]) if s else t or "" for t, s in zip(texts, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.string())], names=["doc", "text"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
