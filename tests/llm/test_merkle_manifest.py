"""Merkle manifests against trees built in plain Python."""

import hashlib

import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tokenloom.llm import merkle_manifest as M  # noqa: E402

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, i long, p string, leaf string, root string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(hashes, fanout):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def expected(rows, fanout):
    """Rows (doc_id, leaf, subroot, root, siblings) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[v])], fanout) for v in langs]
    top = tree([t[-1][0] for t in trees], fanout)
    out = []
    for place, (v, t) in enumerate(zip(langs, trees)):
        for i, (known, n, h) in enumerate(sorted(groups[v])):
            path = []
            for levels, j in ((t, i), (top, place)):
                for level in levels[:-1]:
                    first = j // fanout * fanout
                    path.append(("".join(level[first:j]), "".join(level[j + 1:first + fanout])))
                    j //= fanout
            out.append((n if known else None, h, t[-1][0], top[-1][0], path))
    return sorted(out, key=repr)


def manifest(spark, rows, fanout=2):
    df = spark.createDataFrame([(*r, "g", 7, "p", "l", "r") for r in rows], SCHEMA).repartition(5)
    hashed = df.withColumn("own", M.leaf_hash([F.col(c) for c in COLUMNS]))
    return M.merkle_manifest(hashed, "lang", "doc_id", "own", ["text"], fanout)


ROWS = [
    *[(i, f"s{i % 3}", "en", i * 2, f"text é {i}") for i in range(53)],
    *[(i, None, None, None, None) for i in range(100, 117)],
    (None, "s", "en", 4, "no id"), (None, "s", "en", 4, "no id"), (7, "s1", "en", 14, "other text"), (3, "s0", "en", 6, "text é 3"),
    (500, "x", "de", 1, ""), (501, "x", "", 1, "z" * 5000),
    *[(i, "q", "es", 1, "a") for i in range(600, 616)], *[(i, "q", "ü", 1, "a") for i in range(700, 702)],
]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_plain_trees(spark, fanout):
    got = manifest(spark, ROWS, fanout)
    rows = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["siblings"]]) for r in got.collect()]
    assert sorted(rows, key=repr) == expected(ROWS, fanout)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "siblings", "text"]


def test_folding_tells_tampered_leaves(spark):
    got = manifest(spark, ROWS).withColumn("folded", M.fold(F.col("leaf"), F.col("siblings")))
    assert all(r["folded"] == r["root"] for r in got.collect())
    bad = got.withColumn("folded", M.fold(F.sha2(F.concat("leaf", F.lit("x")), 256), F.col("siblings")))
    assert all(r["folded"] != r["root"] for r in bad.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 33])
def test_sizes_around_a_pivot(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    got = manifest(spark, rows).select("doc_id", "leaf", "subroot", "root", "siblings").collect()
    rows = sorted([(*r[:4], [tuple(s) for s in r[4]]) for r in got], key=repr)
    assert rows == (expected(rows=rows, fanout=2) if not n else expected([(i, "s", "en", i, "t") for i in range(n)], 2))


def test_proof_hash_of_a_lone_leaf(spark):
    row = manifest(spark, [(1, "s", "en", 2, "t")]).select("leaf", "subroot", "root", M.proof_hash(F.col("siblings")).alias("h")).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["h"] == sha("")
