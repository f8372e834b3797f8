"""Token counts (operator 6): a whole-token shortcut for a BPE with word ends.

Offline, on the driver, every vocabulary string that is a pre-token by itself
is merged once by the rank rules; those that come out as the one token they
spell form a table of strings known to cost one token.  In the tasks a
pre-token found in that table counts as 1 without any merging; only the rest
are merged, and their counts kept in a memo of bounded size.

The table is bounded by the vocabulary.  Each text is counted whole, in the
task that reads it: no shuffle.

Defined results: null text is empty; an empty text has 0 bytes and 0 tokens;
repeated rows are counted each; a special token's string inside a text is one
token, as the tokenizer's default has it.  Other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import blocks, opened, shared
from .merge_replay import Ranks, pair_key, replay

MEMO = 500_000
#: Unicode white space, as the tokenizer's \s has it
WS = r"\u0009-\u000d \u0085   -     　"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WS}\p{{L}}\p{{N}}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


class WordModel:
    """Symbols, merges, special strings and the proven one-token strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end, alphabet = model["end_of_word_suffix"] or "", byte_alphabet()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ranks = Ranks({pair_key(vocab[a], vocab[b]): r for r, (a, b) in reversed(list(enumerate(pairs)))})
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.byte = np.array([vocab[c] for c in alphabet], dtype=np.int64)
        self.last_byte = np.array([vocab[c + end] for c in alphabet], dtype=np.int64)
        self.one = self._proven(vocab, end, {c: b for b, c in enumerate(alphabet)})

    def _proven(self, vocab: dict[str, int], end: str, back: dict[str, int]) -> dict[str, int]:
        """Strings that are one pre-token and merge to the single token they spell."""
        whole, strings = regex.compile(PRETOKEN), {}
        for token, i in vocab.items():
            if token.endswith(end):
                try:
                    text = bytes(back[c] for c in token[: len(token) - len(end)]).decode()
                except (KeyError, UnicodeDecodeError):
                    continue
                if whole.fullmatch(text):
                    strings[text] = i
        texts = list(strings)
        ids, sizes = self.merge(texts)
        first = np.cumsum(sizes) - sizes
        return {t: 1 for t, n, i in zip(texts, sizes.tolist(), ids[first].tolist()) if n == 1 and i == strings[t]}

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word), by one replay of all words."""
        spelled = [w.encode() for w in words]
        raw = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        lengths = np.array([len(b) for b in spelled], dtype=np.int64)
        symbols, ends = self.byte[raw], np.cumsum(lengths) - 1
        symbols[ends] = self.last_byte[raw[ends]]
        return replay(symbols, lengths, self.ranks, self.made)


def normal(text: str) -> str:
    """NFC, white space to spaces (they part words either way), lower case by character."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a final sigma is context, not a character
    return text.lower()


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit, n_whole (pre-tokens counted by the shortcut)."""
    held = shared(docs.sparkSession, WordModel(tokenizer_path))
    dtype = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(held)
        find, one, memo = regex.compile(PRETOKEN).findall, model.one, {}
        special = regex.compile("|".join(map(regex.escape, model.special))) if model.special else None
        for ids, texts in blocks(batches):
            n_bytes, n_special, n_whole, rests = [], [], [], []
            for text in texts:
                parts = special.split(text) if special and "<|" in text else (text,)
                words = [w for part in parts for w in find(normal(part))]
                rest = [w for w in words if w not in one]
                n_bytes.append(len(text.encode()))
                n_special.append(len(parts) - 1)
                n_whole.append(len(words) - len(rest))
                rests.append(rest)
            fresh = set().union(*rests).difference(memo)
            if len(memo) + len(fresh) > MEMO:
                memo.clear()
                fresh = set().union(*rests)
            if fresh:
                fresh = list(fresh)
                memo.update(zip(fresh, model.merge(fresh)[1].tolist()))
            n_tokens = [s + n + sum(map(memo.__getitem__, rest)) for s, n, rest in zip(n_special, n_whole, rests)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *(pa.array(x, pa.int64()) for x in (n_bytes, n_tokens, n_whole))],
                names=[id_col, "n_bytes", "n_tokens", "n_whole"],
            )

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    out = rows.mapInArrow(count, f"`{id_col}` {dtype}, n_bytes long, n_tokens long, n_whole long")
    return out.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_whole")
