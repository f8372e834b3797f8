"""The ten operators on small tables: brute force, the tokenizer libraries, and odd rows."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers as P  # noqa: E402

from tokenloom.llm import (  # noqa: E402
    byte_bpe, chat_format, decontaminate, fm_index, jaccard_join, lm_score, quality_rules, suffix_dedup, suffix_groups,
    token_counts, url_rules, weak_quality,
)

random.seed(3)
VOCAB = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7))) for _ in range(60)]
LONG = " ".join(random.choice(VOCAB) for _ in range(400))


def prose(n):
    return " ".join(random.choice(VOCAB) for _ in range(n))


def near(text):
    words = text.split()
    words[len(words) // 2] = "changed"
    return " ".join(words)


TEXTS = [LONG, LONG, near(LONG), "start " + LONG[300:900] + " end", None, "", " \n\t ", "x", "a b c", "é ß Σ 日本 🎉 <|endoftext|> it's 12",
         prose(80), prose(80) + "\n" + prose(30), "spam " * 90, "# $ % & | < > * " * 20, "z" * 700, prose(3000)]
SCHEMA = "doc_id long, text string, rest string, key long, spans string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "r", 1, None) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_suffix_order_is_the_order_of_suffixes():
    for _ in range(400):
        x = [random.randint(1, random.randint(1, 4)) for _ in range(random.randint(0, 30))] + [0]
        assert suffix_groups.suffix_order(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_fm_index_finds_and_locates():
    import numpy as np

    text = np.array([random.randint(1, 5) for _ in range(500)])
    index = fm_index.FMIndex(text, 5)
    for n in (1, 2, 4):
        for _ in range(30):
            p = [random.randint(1, 5) for _ in range(n)]
            lo, hi = index.search(np.array([p + [0] * (4 - n)]), np.array([n]))
            got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
            assert got == [i for i in range(500 - n + 1) if text[i : i + n].tolist() == p]


def test_quality_classifier(docs, none):
    got = by_id(weak_quality.weak_quality(docs))
    assert len(got) == len(TEXTS) and got[0]["votes"] == got[1]["votes"]
    assert all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= weak_quality.KEEP) for r in got.values())
    assert got[4]["votes"] == got[5]["votes"] == "0" * weak_quality.LABELLERS
    assert weak_quality.weak_quality(none).count() == 0


def test_quality_classifier_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    found = weak_quality.weak_quality(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"))
    rows = found.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.97 * len(rows)


def test_decontamination(spark, docs, none):
    items = [(1, " ".join(LONG.split()[20:45]).upper()), (2, "A, b C"), (3, None), (4, "x"), (4, "x"), (5, "nowhere to be found")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.decontaminate(docs, bench))
    phrases = collections.defaultdict(set)
    for i, t in items:
        w = re.findall(decontaminate.WORD, (t or "").lower())
        for k in range(max(len(w) - 9, 1) if w else 0):
            phrases[tuple(w[k : k + 10])].add(str(i))
    for i, t in enumerate(TEXTS):
        w = re.findall(decontaminate.WORD, (t or "").lower())
        hit, ids = set(), set()
        for p, who in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    ids |= who
        assert (got[i]["n_words"], sum(s["stop"] - s["start"] for s in got[i]["spans"]), got[i]["items"]) == (len(w), len(hit), sorted(ids))
    clean = by_id(decontaminate.decontaminate(docs, bench, clean=True))
    assert clean[8]["text"] == "" and clean[10]["text"] == TEXTS[10] and clean[10].asDict().keys() == set(docs.columns)
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert all(not r["items"] for r in decontaminate.decontaminate(docs, bench.limit(0)).collect())


def test_decontamination_in_several_passes(spark, monkeypatch):
    words = LONG.split()
    items = [(k, " ".join(words[k : k + 14])) for k in range(20, 90, 7)] + [(900, "a b c"), (901, TEXTS[10])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    ids = [1, 1, None, None, 2, 2, 3, 4, 5]
    texts = [LONG, TEXTS[10], LONG, "a b c", LONG, LONG, None, "x A, b C y", prose(50)]
    df = spark.createDataFrame([(i, t, f"r{k}") for k, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, rest string").repartition(3)
    shown = lambda found: sorted(map(repr, found.collect()))
    want = shown(decontaminate.decontaminate(df, bench)), shown(decontaminate.decontaminate(df, bench, clean=True))
    monkeypatch.setattr(decontaminate, "MAX_ITEM_BYTES", 250)
    assert sum(len(t) for _, t in items) > 3 * 250
    clean = decontaminate.decontaminate(df, bench, clean=True)
    assert (shown(decontaminate.decontaminate(df, bench)), shown(clean)) == want
    assert clean.columns == df.columns and len(want[0]) == len(ids)
    by_rest = {r["rest"]: r["text"] for r in clean.collect()}
    assert by_rest["r1"] == by_rest["r3"] == "" and by_rest["r7"] == "x  y" and by_rest["r8"] == texts[8]


def test_jaccard_join(docs, none):
    got = by_id(jaccard_join.jaccard_join(docs))
    sets = {}
    for i, t in enumerate(TEXTS):
        w = decontaminate.words_of(t or "")
        if w:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))}
    for i in range(len(TEXTS)):
        links = [j for j in sets if j != i and i in sets and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
        same = [j for j in links if sets[i] == sets[j]]
        assert (got[i]["n_links"], got[i]["class_id"]) == (len(links), min([i, *same])), i
    assert got[2]["group_id"] == got[1]["group_id"] == 0 and got[5]["group_id"] == 5
    assert jaccard_join.jaccard_join(none).count() == 0


def test_jaccard_join_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    base = prose(200).split()
    rows = [(i, " ".join(base[:i] + ["odd%d" % i] + base[i + 1 :])) for i in range(60)]
    got = by_id(jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(r["n_links"] == 59 and r["group_id"] == 0 for r in got.values())


def test_jaccard_join_of_null_ids(spark):
    rows = [*((i, LONG) for i in range(5, 45)), (None, LONG), (50, near(LONG)), (None, prose(60)), (None, TEXTS[10]), (None, near(TEXTS[10]))]
    out = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hot = [r for r in out if r["n_links"] == 41]
    assert sorted(r["doc_id"] or 0 for r in hot) == [0, *range(5, 45), 50]
    assert {r["group_id"] for r in hot} == {5} and {r["class_id"] for r in hot if r["doc_id"] != 50} == {5}
    assert sorted((r["doc_id"], r["class_id"], r["group_id"], r["n_links"]) for r in out if r["n_links"] < 41) == [(None, None, None, 0), (None, None, None, 1), (None, None, None, 1)]


def test_near_duplicates_of_null_ids(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(i, LONG) for i in [None, *range(7, 30)]], "doc_id long, text string")
    out = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted(r["doc_id"] or 0 for r in out) == [0, 7]


def test_repeated_ids_of_different_texts(spark):
    import corpus_pipeline

    other = prose(90)
    rows = [(5, LONG), (5, other), (5, other), (6, near(LONG)), (7, near(other)), (7, TEXTS[10]), (7, TEXTS[10]), (8, TEXTS[11])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.jaccard_join(df).collect()
    assert sorted((r["doc_id"], r["group_id"], r["n_links"]) for r in out) == [(5, 5, 1), (5, 5, 2), (5, 5, 2), (6, 5, 1), (7, 5, 2), (7, 7, 1), (7, 7, 1), (8, 8, 0)]
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == sorted([(5, LONG), (5, other), (7, TEXTS[10]), (8, TEXTS[11])])


def test_chat_format_round_trip(spark):
    rows = [(1, 0, "user", "<|im_end|>\\n<|"), (1, 1, "user", "a<|im_sep|>"), (1, 2, "assistant", None), (1, 2, None, "tie"),
            (2, None, "ro\nle\\n", "x\\|y"), (2, 300, "assistant", "last"), (2, 5, "assistant", "<"), (None, 0, "user", ""), (2, 5, "assistant", "<")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    out = chat_format.chat_format(df)
    from pyspark.sql import functions as F

    for r in out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).collect():
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert chat_format.chat_format(df.limit(0)).count() == 0


def test_quality_rules(spark, docs, none):
    trusted = spark.createDataFrame([(0,), (10,), (None,), (99,)], "doc_id long")
    got = by_id(quality_rules.quality_rules(docs, trusted))
    for i, t in enumerate(TEXTS):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + d for k, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit))
        assert tuple(got[i][c] for c in quality_rules.RESULTS[:5]) == want, i
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["score"] >= quality_rules.THRESHOLD)
    assert got[13]["score"] < got[10]["score"] and got[0]["rest"] == "r"
    assert {r["score"] for r in quality_rules.quality_rules(docs, None).collect()} == {0.0}
    assert quality_rules.quality_rules(none, trusted).count() == 0


def test_token_counts_as_the_library(docs, none):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    lib, got = Tokenizer.from_file(path), by_id(token_counts.token_counts(docs, path))
    for i, t in enumerate(TEXTS):
        assert (got[i]["n_bytes"], got[i]["n_tokens"]) == (len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids))
    assert token_counts.token_counts(none, path).count() == 0


def test_byte_bpe_as_the_library(docs, none):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded, digest = by_id(byte_bpe.encode(docs, path, P.PATTERN)), by_id(byte_bpe.round_trip(docs, path, P.PATTERN))
    back = by_id(byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path))
    for i, t in enumerate(TEXTS):
        assert coded[i]["ids"] == lib.encode_ordinary(t or "")
        assert bytes(back[i]["decoded"]) == (t or "").encode()
        assert digest[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.round_trip(none, path, P.PATTERN).count() == 0


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://Example.ORG/es/x", "http://a.example.org/en/1?q", "http://example.org", "https://org/en/1", "ftp://x.com/fr/#a",
            "http://com/de/", "http://badexample.org/es/", "http://a.example.org/en/1?q", "http://sub.a.example.org:80/es/"]
    rules = [*url_rules.RULES, ("a.example.org", "/", "block"), ("org", "/", "allow"), ("", "/", "block"), (None, "/", "block")]
    pages = spark.createDataFrame([(i, u, "mine", "k") for i, u in enumerate(urls)], "page_id long, url string, verdict string, top string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = by_id(url_rules.url_rules(pages, table), "page_id")
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path, host = re.match(r"[^?#]*", rest[len(host):])[0], host.lower()
        fits = [(len(h + p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, best[1], best[2]), u
    assert url_rules.url_rules(pages.limit(0), table).count() == 0
    assert {r["rule"] for r in url_rules.url_rules(pages, table.limit(0)).collect()} == {None}


def test_suffix_dedup(docs, none):
    got = by_id(suffix_dedup.suffix_dedup(docs))
    raw = [(t or "").encode() for t in TEXTS]
    seen = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    for i, x in enumerate(raw):
        gone = set()
        for k in range(len(x) - 199):
            if seen[x[k : k + 200]] > 1:
                gone |= set(range(k, k + 200))
        kept = bytes(b for k, b in enumerate(x) if k not in gone)
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (len(gone), hashlib.sha256(kept).hexdigest()), i
    clean = by_id(suffix_dedup.suffix_dedup(docs, clean=True))
    assert clean[0]["text"] == "" and clean[10]["text"] == TEXTS[10] and clean[10]["rest"] == "r"
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_lm_scoring(docs, none):
    got = by_id(lm_score.lm_score(docs.select("doc_id", "text")))
    tokens = [(t or "").encode().lower().split() + [None] for t in TEXTS]
    train = [w for i, w in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10]
    count, pairs, heads = collections.Counter(), collections.Counter(), collections.Counter()
    for w in train:
        count.update(w)
        pairs.update(zip([b""] + w, w))
        heads.update([b""] + w[:-1])
    total, rest = sum(count.values()) + 0.1 * (len(count) + 1), collections.defaultdict(lambda: 1.0)
    gain = {p: (n - lm_score.DISCOUNT) / heads[p[0]] for p, n in pairs.items() if n >= lm_score.LEAST_PAIR}
    for p, g in gain.items():
        rest[p[0]] -= g
    for i, w in enumerate(tokens):
        base = sum(math.log10((count[x] + 0.1) / total) for x in w)
        full = sum(math.log10(gain.get(p, 0) + rest[p[0]] * (count[p[1]] + 0.1) / total) for p in zip([b""] + w, w))
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(w), sum(x in count for x in w), sum(count.values()))
        assert abs(got[i]["base_score"] - base) < 1e-6 and abs(got[i]["score"] - full) < 1e-3 * len(w)
    assert lm_score.lm_score(none.select("doc_id", "text")).count() == 0


def test_lm_scoring_of_pairs_seen_once(spark):
    texts = [(i, f"left{i} right{i} left{i + 1}") for i in range(20)]
    rows = spark.createDataFrame([*texts, (100, "left3 right3"), (101, "left3 right4")], "doc_id long, text string")
    train = [t.encode().split() + [None] for _, t in texts]
    count = collections.Counter(w for t in train for w in t)
    total, heads = sum(count.values()) + 0.1 * (len(count) + 1), collections.Counter(w for t in train for w in [b""] + t[:-1])
    pairs = collections.Counter(p for t in train for p in zip([b""] + t, t))
    gain = {p: (n - lm_score.DISCOUNT) / heads[p[0]] for p, n in pairs.items()}
    rest = {h: 1 - sum(g for p, g in gain.items() if p[0] == h) for h in heads}
    model = lm_score.train(rows.where("doc_id < 100"))
    got = by_id(lm_score.score(rows.where("doc_id >= 100"), model))
    for i, t in ((100, [b"left3", b"right3", None]), (101, [b"left3", b"right4", None])):
        want = sum(math.log10(gain.get(p, 0) + rest[p[0]] * (count[p[1]] + 0.1) / total) for p in zip([b""] + t, t))
        assert abs(got[i]["score"] - want) < 1e-3 * len(t)
    assert pairs[(b"left3", b"right3")] == 1 and got[100]["score"] > got[101]["score"] + 0.5


def test_pipeline_by_stages(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    by_row = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, quality_rules.trusted_ids(spark.read.parquet(f"{d}/labels.parquet"))).collect()}
    kept = [i for i, r in by_row.items() if r["kept"]]
    near = by_id(jaccard_join.jaccard_join(docs.where(docs["doc_id"].isin(kept))))
    alone = {i for i, r in near.items() if r["group_id"] == i}
    out = by_id(corpus_pipeline.run(spark, d))
    assert set(out) == alone
