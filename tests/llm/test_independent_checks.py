"""The queries without SQL, and the whole pipeline, against plain Python on a small fixture."""

import base64
import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers as P  # noqa: E402
import tiktoken  # noqa: E402
import xxhash  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tokenloom.llm import byte_bpe, quality_rules, suffix_dedup, token_counts, weak_quality  # noqa: E402

rng = random.Random(11)
VOCAB = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(900)]
ITEM = " ".join(rng.choice(VOCAB) for _ in range(24))
PASSAGE = " ".join(rng.choice(VOCAB) for _ in range(70))


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def changed(text, k):
    w = text.split(" ")
    w[k] = "Changed"
    return " ".join(w)


BASE = [prose(300) for _ in range(6)]
DOCS = [
    (10, BASE[0]), (3, BASE[0]), (11, changed(BASE[0], 40)), (12, changed(BASE[0], 200)),  # a group of near copies
    (20, BASE[1]), (21, prose(60) + "\n" + PASSAGE + "\n" + prose(60)), (22, prose(90) + " " + PASSAGE),  # a shared passage
    (23, BASE[2][:200] + " " + ITEM.upper() + " " + prose(80)), (24, prose(55)), (25, prose(20)),  # a benchmark item; too short
    (26, "spam spam spam " * 60), (27, None), (28, ""), (29, "# $ % & " * 40 + prose(60)), (None, prose(80)), (None, BASE[3]), (30, BASE[3]),
    (31, "é ü 🎉 " + prose(100)), (31, prose(120)), (32, BASE[4]), (32, BASE[4]),
]
LABELS = [*((i, 1, 0) for i in (10, 3, 11, 12, 20, 21, 22, 23, 30, 32)), (26, 0, 0), (31, 1, 1), (None, 1, 0)]
BENCH = [(1, ITEM), (2, None), (3, "!!"), (4, "nowhere to be found in any of the documents at all here")]
SCHEMA = "doc_id long, text string, lang string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", None if t is None else len(t)) for i, t in DOCS], SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality long, toxic long").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


# --- plain forms ---------------------------------------------------------------------------------------------------

SPACE, WORD = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def bins_of(words):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    h = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in words]

    def both(a, b):
        seed = xxhash.xxh64(struct.pack("<q", a), seed=42).intdigest()
        return xxhash.xxh64(struct.pack("<q", b), seed=seed).intdigest()

    return [x & 16383 for x in h] + [both(a, b) & 16383 for a, b in zip(h, h[1:])]


def quality(docs, trusted):
    """(score, base_failed) of each row."""
    raw, target = collections.Counter(), collections.Counter()
    grams = [bins_of(SPACE.findall(t or "")) for _, t in docs]
    for (i, _), g in zip(docs, grams):
        raw.update(g)
        if i is not None and i in trusted:
            target.update(g)
    n, m = sum(raw.values()), sum(target.values())
    weight = [math.log((target[b] + 0.5) / (m + 0.5 * 16384)) - math.log((raw[b] + 0.5) / (n + 0.5 * 16384)) for b in range(16384)]
    out = []
    for (_, t), g in zip(docs, grams):
        w = SPACE.findall(t or "")
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        again = {k + d for k, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for d in range(3)}
        out.append((sum(weight[b] for b in g) / len(g) if g else 0.0, len(w) < 50 or 100 * len(again) > 50 * len(w)))
    return out


def near_groups(docs):
    """One document of each group of texts that links of Jaccard 0.8 connect: the least id, then the row order kept."""
    sets = []
    for _, t in docs:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else None)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] is not None and sets[b] is not None and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    kept = []
    for k, (i, t) in enumerate(docs):
        group = [j for j in range(len(docs)) if find(j) == find(k)]
        ids = [docs[j][0] for j in group if docs[j][0] is not None]
        if i is None or i == min(ids):
            kept.append((i, t))
    seen, out = set(), []
    for i, t in kept:
        if i is None or (i, t) not in seen:
            out.append((i, t))
        seen.add((i, t))
    return out


def without_repeats(docs):
    raw = [(t or "").encode() for _, t in docs]
    seen = collections.Counter(x[k:k + 200] for x in raw for k in range(len(x) - 199))
    out = []
    for (i, _), x in zip(docs, raw):
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - 199):
            if seen[x[k:k + 200]] > 1:
                gone[k:k + 200] = True
        out.append((i, bytes(np.frombuffer(x, np.uint8)[~gone]).decode("utf-8", "ignore"), gone))
    return out


def without_items(docs):
    phrases = set()
    for _, t in BENCH:
        w = WORD.findall(lower(t))
        phrases |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1))} if w else set()
    out = []
    for i, t in docs:
        places = [m.span() for m in WORD.finditer(lower(t))]
        w = [lower(t)[a:b] for a, b in places]
        hit = {k + d for p in phrases for k in range(len(w) - len(p) + 1) if tuple(w[k:k + len(p)]) == p for d in range(len(p))}
        text, last = [], 0
        for k in sorted(hit):
            if k - 1 not in hit:
                text.append(t[last:places[k][0]])
            last = places[k][1]
        out.append((i, "".join(text) + t[last:]))
    return out


def encoding():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(docs):
    lib, out = encoding(), []
    for i, t in docs:
        ids = lib.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


# --- checks --------------------------------------------------------------------------------------------------------

def same_rows(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_pipeline_by_plain_python(spark, tables):
    import corpus_pipeline

    trusted = {i for i, q, toxic in LABELS if q == 1 and toxic == 0}
    scores = quality(DOCS, trusted)
    assert all(abs(s - quality_rules.THRESHOLD) > 1e-6 for s, _ in scores)
    kept = [d for d, (s, failed) in zip(DOCS, scores) if not failed and s >= quality_rules.THRESHOLD]
    assert 8 <= len(kept) < len(DOCS) - 4, len(kept)
    alone = near_groups(kept)
    assert len(alone) < len(kept)
    cut = [(i, t) for i, t, _ in without_repeats(alone)]
    clean = without_items(cut)
    assert [t for _, t in clean] != [t for _, t in cut] != [t for _, t in alone]
    out = corpus_pipeline.run(spark, tables).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    same_rows(map(tuple, out.collect()), coded(clean))


def test_pipeline_stages_on_empty_tables(spark, tables, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:  # empty labels and benchmark, and every column of the documents
        assert stage(spark, docs, str(tmp_path)).schema.names == docs.columns


def test_quality_scores(spark, tables):
    trusted = {i for i, q, toxic in LABELS if q == 1 and toxic == 0}
    ids = spark.createDataFrame([(i,) for i in trusted if i is not None] + [(None,)], "doc_id long")
    rows = quality_rules.quality_rules(spark.read.parquet(f"{tables}/documents.parquet"), ids).collect()
    want = [(i, t, round(s, 9), not f and s >= quality_rules.THRESHOLD) for (i, t), (s, f) in zip(DOCS, quality(DOCS, trusted))]
    same_rows([(r.doc_id, r.text, round(r.score, 9), r.kept) for r in rows], want)


def test_byte_bpe_round_trip(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = byte_bpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    same_rows(map(tuple, out.collect()), coded(DOCS))


def test_token_counts_and_limits(spark, tables):
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    long = [(i, (t or "") * 12 if t is not None else None) for i, t in DOCS]
    df = spark.createDataFrame(long, "doc_id long, text string")
    want = []
    for i, t in long:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    got = token_counts.token_counts(df, path)
    same_rows([tuple(r)[:4] for r in got.collect()], want)
    assert any(w[3] for w in want) and not all(w[3] for w in want)


@pytest.mark.parametrize("segment", [None, 300])
def test_suffix_dedup_spans(spark, tables, monkeypatch, segment):
    if segment:  # texts of many segments
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rows = suffix_dedup.suffix_dedup(spark.read.parquet(f"{tables}/documents.parquet")).collect()
    want = []
    for (i, t), (_, _, gone) in zip(DOCS, without_repeats(DOCS)):
        raw = (t or "").encode()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = [tuple(x) for x in edges.reshape(-1, 2).tolist()]
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        want.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    same_rows([(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in rows], want)


def test_label_model_by_loops():
    """Expectation-maximisation written out for each pattern, class and labeller."""
    patterns = ["".join(rng.choice("01--") for _ in range(weak_quality.LABELLERS)) for _ in range(60)]
    counts = {p: rng.randint(1, 50) for p in patterns}
    got = weak_quality.LabelModel(counts, rounds=9).posterior
    good = {p: (p.count("1") + 1) / (p.count("1") + p.count("0") + 2) for p in counts}
    total = sum(counts.values())
    for _ in range(9):
        share = {c: {p: n * (good[p] if c else 1 - good[p]) for p, n in counts.items()} for c in (0, 1)}
        prior = {c: (sum(share[c].values()) + 1) / (total + 2) for c in (0, 1)}
        said = {}
        for c in (0, 1):
            for k in range(weak_quality.LABELLERS):
                n = {v: 1 + sum(s for p, s in share[c].items() if p[k] == v) for v in "01"}
                for v in "01":
                    said[c, k, v] = n[v] / (n["0"] + n["1"])
        for p in counts:
            log = [math.log(prior[c]) + sum(math.log(said[c, k, v]) for k, v in enumerate(p) if v != "-") for c in (0, 1)]
            good[p] = 1 / (1 + math.exp(max(-50, min(50, log[0] - log[1]))))
    assert got.keys() == good.keys() and all(abs(got[p] - good[p]) < 1e-9 for p in good)


def test_classifier_scores_follow_its_parts(spark, tables):
    """The scores are those of a scorer trained on the posteriors of the sampled rows, computed here from the parts."""
    docs = [d for d in DOCS if d[0] is not None]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = weak_quality.weak_quality(df).collect()
    counts = collections.Counter(weak_quality.votes(t or "") for _, t in docs)
    posterior = weak_quality.LabelModel(dict(counts)).posterior
    chosen = {}
    for i, t in docs:  # of an id's texts the one of least (votes, hash)
        h = xxhash.xxh64((t or "").encode(), seed=42).intdigest()
        key = (weak_quality.votes(t or ""), h - (1 << 64) if h >> 63 else h)
        if i not in chosen or key < chosen[i][0]:
            chosen[i] = (key, t or "")
    x = np.stack([weak_quality.features(t, {}).astype(np.float16) for _, t in chosen.values()]).astype(np.float32)
    w = weak_quality.fit(x, np.array([posterior[k[0]] for k, _ in chosen.values()], np.float32))
    for r in rows:
        text = next(t or "" for i, t in docs if i == r.doc_id and weak_quality.votes(t or "") == r.votes)
        assert abs(r.posterior - posterior[r.votes]) < 1e-12
        found = [1 / (1 + math.exp(-float(weak_quality.features(t or "", {}) @ w[:-1] + w[-1]))) for i, t in docs if i == r.doc_id]
        assert min(abs(r.score - f) for f in found) < 1e-3, text
