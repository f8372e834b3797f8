"""HTML extraction: the main text of pages, with a suffix array over the token streams of each host.

Pages are cut into blocks of text (html_blocks.py).  The blocks' elements and
words, page after page, are the token stream of a host.  Its suffixes are sorted
up to the least length of a repeat; neighbours that agree so far are repeats, and
those on enough distinct pages are boilerplate.  Markup then has the last word,
since repeats alone can't tell an article that other pages quote from a menu, nor
a menu of a host with one page from its article:

- blocks that the markup names menus, headers, footers, sidebars, notices,
  adverts, forms or comments go;
- of a page with an article (else a main part) all other blocks outside it go, and
  its paragraphs, headings, lists, tables and quotations stay;
- every other block, and on a page without such a part each block, goes if
  repeats cover all of it and stays otherwise.

A repeat counts if it is on `min_pages` distinct pages of its host and on `share`
of the host's distinct pages or more, whatever the host's size.  Equal pages are
one distinct page; a stretch of repeats longer than half of its page is a copy of
the page and no boilerplate.

The pages of a host above GROUP_CHARS characters lie in several groups, by the hash
of their blocks, so equal pages meet in one.  Such a host's repeats are counted
first: each group tells its substrings that are on more than two thirds of `share`
of its pages, which no substring that counts escapes in every group, and the counts
are summed up.  Where pages that groups haven't told could matter they are looked
up.  What counts goes to all groups of the host.  So the result is that of the host
in one piece.  Telling, looking up and judging read the same shuffled pages.

Defined cases: a null or empty page has an empty text; a null url's host is
empty; equal rows and null ids are rows of their own; other columns are not read,
so their names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, new_folder
from .html_blocks import OUTSIDE, PROSE, Block, page_blocks

#: characters of a host's pages that one group takes, about
GROUP_CHARS = 2_000_000
#: pages that a group of a large host takes at least, about: with few, `share` of them is less than a page and all is told
GROUP_PAGES = 300
#: times GROUP_CHARS that a group takes for the sake of that
GROUP_MOST = 8
#: of the hashes of substrings
FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)
#: characters of pages that one task takes, about
TASK_CHARS = 8_000_000


def suffix_order(tokens: np.ndarray, stop: np.ndarray, depth: int, often: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(order, agree): suffixes sorted by their first `depth` tokens, and whether each agrees so far with the one before.

    tokens are numbers from 0; a suffix ends at `stop`, its page's end, and
    those shorter than depth are left out.  So are those whose first `depth` tokens
    have a part that is in fewer than `often` places: the longer the sorted heads,
    the fewer suffixes are left to sort.
    """
    n = len(tokens)
    rank, length = tokens.astype(np.int64), 1
    alive = np.bincount(rank, minlength=1)[rank] >= often
    rest = stop - np.arange(n)
    while length < depth:
        step = min(length, depth - length)
        at = np.flatnonzero(alive[:n - step] & alive[step:] & (rest[:n - step] >= length + step)) if step < n else np.zeros(0, np.int64)
        # the first `length` tokens, then as many from `step` on: together length + step
        heads = rank[at] * (int(rank.max(initial=0)) + 1) + rank[at + step]
        _, heads, places = np.unique(heads, return_inverse=True, return_counts=True)
        rank, alive = np.zeros(n, np.int64), np.zeros(n, bool)
        rank[at] = heads
        alive[at] = places[heads] >= often
        length += step
    whole = np.flatnonzero(alive & (rest >= depth))
    order = whole[np.argsort(rank[whole], kind="stable")]
    return order, np.append(False, rank[order][1:] == rank[order][:-1])[:len(order)]


def repeats(tokens: np.ndarray, page: np.ndarray, content: np.ndarray, least: int, often: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group, pages): places of the substrings of `least` tokens, sorted; the number of each one's group of equal
    ones; the distinct pages of each group.  Substrings that are in fewer than `often` places may be left out.

    page: the number of each token's page, ascending; content: a number for each
    page, equal for equal pages.
    """
    start = np.flatnonzero(np.diff(page, prepend=-1))
    size = np.diff(start, append=len(tokens))
    order, agree = suffix_order(tokens, np.repeat(start + size, size), least, often)
    if not len(order):
        return order, order, order
    group = np.cumsum(~agree) - 1
    both = np.unique(group * (int(content.max()) + 1) + content[page[order]])
    return order, group, np.bincount(both // (int(content.max()) + 1), minlength=int(group[-1]) + 1)


def covered_tokens(hits: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """Which tokens lie in the substrings of `least` tokens at `hits`, but for stretches longer than half of their page."""
    n = len(page)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + least, -1)
    covered = np.cumsum(edge[:n]) > 0
    size = np.diff(np.flatnonzero(np.diff(page, prepend=-1)), append=n)
    first = np.flatnonzero(np.diff(covered * (page + 1), prepend=-1))
    length = np.diff(first, append=n)
    copies = covered[first] & (2 * length > np.repeat(size, size)[first])
    covered[np.repeat(copies, length)] = False
    return covered


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, content: np.ndarray, least: int, min_pages: int, share: float) -> np.ndarray:
    """Which tokens lie in a substring of `least` tokens that is on enough distinct pages (see `repeats`)."""
    if len(tokens) == 0:
        return np.zeros(0, bool)
    enough = max(min_pages, int(np.ceil(share * len(np.unique(content)))))
    order, group, pages = repeats(tokens, page, content, least, enough)
    return covered_tokens(order[pages[group] >= enough], page, least)


def _stream(pages: list[list[Block]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, tokens, page, content) of the pages of one group: tokens are numbers of words."""
    same: dict[bytes, int] = {}
    content = np.array([same.setdefault(_digest(blocks), len(same)) for blocks in pages])
    shown = pc.split_pattern(pa.array([" ".join(_shown(blocks)) for blocks in pages if blocks], pa.string()), " ")
    sizes = np.zeros(len(pages), np.int64)
    sizes[[k for k, blocks in enumerate(pages) if blocks]] = np.diff(shown.offsets.to_numpy())
    coded = shown.values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(pages)), sizes), content


def _shown(blocks: list[Block]) -> list[str]:
    return [f"<{b.tag} {b.text}" for b in blocks]


def _digest(blocks: list[Block]) -> bytes:
    return hashlib.blake2b("".join(_shown(blocks)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _own(words: pa.Array) -> np.ndarray:
    """Two columns, a 128-bit hash of each word."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words.cast(pa.binary()).to_pylist()]), "<u8").reshape(-1, 2)


def _keys(words: pa.Array, tokens: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """Two columns, a 128-bit hash of the `least` tokens from each place: the same in every group."""
    used, which = np.unique(tokens[at[:, None] + np.arange(least)], return_inverse=True)
    own, which = _own(words.take(pa.array(used))), which.reshape(-1, least)
    out = np.zeros((len(at), 2), np.uint64)
    for k in range(least):
        out = out * FACTORS + own[which[:, k]]
    return out.view(np.int64)


def _windows(pages: list[list[Block]], keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of the substrings that are among the keys, their keys, page, content) of one group."""
    words, tokens, page, content = _stream(pages)
    n = len(tokens) - least + 1
    if n < 1 or not len(keys):
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64), page, content
    own, inside = _own(words)[tokens], page[:n] == page[least - 1:]
    mine = np.zeros((2, n), np.uint64)
    for half, one, factor in zip(mine, np.ascontiguousarray(own.T), FACTORS):
        for k in range(least):
            half *= factor
            half += one[k:k + n]
    asked = keys[np.lexsort((keys[:, 1], keys[:, 0].astype(np.uint64)))].astype(np.uint64)
    some, mask = np.zeros(2 ** 20, bool), np.uint64(2 ** 20 - 1)
    some[asked[:, 0] & mask] = True  # few places are left to look up
    at = np.flatnonzero(some[mine[0] & mask] & inside)
    first, hits = np.searchsorted(asked[:, 0], mine[0][at]), np.zeros(len(at), bool)
    for k in range(int(np.unique(asked[:, 0], return_counts=True)[1].max())):
        hits |= (asked[np.minimum(first + k, len(asked) - 1)] == mine[:, at].T).all(1)
    at = at[hits]
    return at, np.ascontiguousarray(mine[:, at].T).view(np.int64), page, content


def _slack(distinct: int, share: float) -> int:
    """The most pages of a group of so many distinct ones that a substring is on untold.

    It is less than `share` of them, so a substring on `share` of all pages is told by one group or more.
    """
    return int(2 * share * distinct / 3)


def _told(pages: list[list[Block]], least: int, share: float) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(distinct pages, slack, keys, pages of each) of one group: its substrings on more pages than the slack."""
    words, tokens, page, content = _stream(pages)
    distinct = len(np.unique(content))
    slack = _slack(distinct, share)
    order, group, on = repeats(tokens, page, content, least, slack + 1)
    first = order[np.flatnonzero(np.diff(group, prepend=-1))][on > slack]
    return distinct, slack, _keys(words, tokens, first, least), on[on > slack]


def _untold(pages: list[list[Block]], keys: np.ndarray, least: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, pages of each) of one group: of the substrings asked for, those that `_told` left out."""
    at, mine, page, content = _windows(pages, keys, least)
    if not len(at):
        return mine, at
    found, which = np.unique(mine, axis=0, return_inverse=True)
    most = int(content.max()) + 1
    on = np.bincount(np.unique(which.reshape(-1) * most + content[page[at]]) // most, minlength=len(found))
    few = on <= _slack(len(np.unique(content)), share)
    return found[few], on[few]


def _judge(pages: list[list[Block]], least: int, min_pages: int, share: float, keys: np.ndarray | None = None) -> list[tuple[str, int, int]]:
    """(text, tokens, repeated tokens) of the pages of one group; keys: of the substrings that count, where the host has more groups."""
    if keys is None:
        _, tokens, page, content = _stream(pages)
        covered = repeated_tokens(tokens, page, content, least, min_pages, share)
    else:
        at, _, page, _ = _windows(pages, keys, least)
        covered = covered_tokens(at, page, least)
    out, at = [], 0
    for blocks in pages:
        main = max((b.place for b in blocks if not b.chrome), default=OUTSIDE)
        kept, begin = [], at
        for b in blocks:
            end = at + 2 + b.text.count(" ")
            if not b.chrome and b.place == main:
                if (main != OUTSIDE and b.tag in PROSE) or not covered[at:end].all():
                    kept.append(b.text)
            at = end
        out.append((" ".join(kept), at - begin, int(covered[begin:at].sum())))
    return out


def _pack(blocks: list[Block]) -> bytes:
    """A page's blocks, a line each; their tags and texts hold no white space but single spaces between words."""
    lines = "\n".join(f"{b.place}{b.chrome:d}{b.tag} {b.text}" for b in blocks)
    return zlib.compress(lines.encode("utf-8", "surrogatepass"), 1)


def _unpack(packed: bytes) -> list[Block]:
    out = []
    for line in zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n"):
        if line:
            mark, _, text = line.partition(" ")
            out.append(Block(mark[2:], int(mark[0]), mark[1] == "1", text))
    return out


def _host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "^[\\s\\S]*?://([^/?#]*)", 1)), F.lit(""))


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 8,
                 min_pages: int = 3, share: float = 0.01, group_chars: int = GROUP_CHARS) -> DataFrame:
    """A row for each page: id, url, text, n_chars, n_tokens (words and blocks of the page), n_repeated (those in repeats)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"),
                        _host(F.col(url_col)).alias("host"))
    folder = new_folder(spark, "hosts")
    rows.groupBy("host").agg(F.sum(F.length("html")).alias("chars"), F.count("*").alias("pages")).write.parquet(f"{folder}/all")
    hosts = spark.read.parquet(f"{folder}/all")
    size = F.least(F.lit(GROUP_MOST * group_chars), F.greatest(F.lit(group_chars), F.col("chars") * GROUP_PAGES / F.col("pages")))
    hosts.where(f"chars > {group_chars}").select(
        F.col("host").alias("large"), F.ceil(F.col("chars") / size).alias("parts")).write.parquet(f"{folder}/large")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(hosts.agg(F.sum("chars")).first()[0] or 0) // TASK_CHARS))
    large = spark.read.parquet(f"{folder}/large")  # Spark knows its size and chooses the join
    kind = rows.schema["id"].dataType.simpleString()
    judged = f"id {kind}, url string, text string, n_tokens bigint, n_repeated bigint, n_chars bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                some = batch.slice(k, 200)
                found = [page_blocks(h) for h in some.column(2).to_pylist()]
                parts = [int.from_bytes(_digest(f)[:8], "big") % n for f, n in zip(found, some.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*map(some.column, (0, 1, 3)), pa.array(parts, pa.int64()), pa.array(map(_pack, found), pa.binary())],
                    ["id", "url", "host", "part", "packed"])

    def dealt(some: DataFrame) -> DataFrame:
        """Pages' blocks, the groups whole in their tasks."""
        blocks = some.select("id", "url", "html", "host", "parts").mapInArrow(cut, f"id {kind}, url string, host string, part bigint, packed binary")
        return blocks.repartition(tasks, "host", "part")

    def result(ids: pa.Array, urls: pa.Array, pages: list[list[Block]], keys: np.ndarray | None = None) -> list[pa.Array]:
        found = _judge(pages, least, min_pages, share, keys)
        return [ids, urls, pa.array([f[0] for f in found], pa.string()),
                *(pa.array(c, pa.int64()) for c in ([f[1] for f in found], [f[2] for f in found], [len(f[0]) for f in found]))]

    names = ["id", "url", "text", "n_tokens", "n_repeated", "n_chars"]

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, pa.Array, list[list[Block]]]]:
        """(host, ids, urls, pages) of each group; its rows follow each other."""
        held, key, types = [], None, None
        for batch in batches:
            types = batch.column(0).type, batch.column(1).type
            for i, url, host, part, packed in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (host, part) and held:
                    yield key[0], *(pa.array([h[k] for h in held], types[k]) for k in (0, 1)), [_unpack(h[2]) for h in held]
                    held = []
                key = (host, part)
                held.append((i, url, packed))
        if held:
            yield key[0], *(pa.array([h[k] for h in held], types[k]) for k in (0, 1)), [_unpack(h[2]) for h in held]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, urls, pages in grouped(batches):
            yield pa.RecordBatch.from_arrays(result(ids, urls, pages), names)

    small = rows.join(large, rows["host"] == large["large"], "left_anti").withColumn("parts", F.lit(1).cast("bigint"))
    out = dealt(small).sortWithinPartitions("host", "part").mapInArrow(judge, judged)
    if not large.isEmpty():
        # all steps take these pages as they are, with all columns, so that Spark shuffles them once
        near = dealt(rows.join(large, rows["host"] == large["large"]))

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A row without key for each group, and one for each of its substrings that are told."""
            for host, _, _, pages in grouped(batches):
                distinct, slack, keys, on = _told(pages, least, share)
                n = len(keys) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * n, pa.string()), *(pa.array([None, *keys[:, k].tolist()], pa.int64()) for k in (0, 1)),
                     pa.array([distinct, *on.tolist()], pa.int64()), pa.array([slack] * n, pa.int64()), pa.array([0] + [1] * (n - 1), pa.int64())],
                    ["host", "high", "low", "pages", "slack", "keyed"])

        told = near.sortWithinPartitions("host", "part").mapInArrow(
            tell, "host string, high bigint, low bigint, pages bigint, slack bigint, keyed bigint")
        # `keyed` is no key of the sum, so both uses of the sum share one shuffle
        sums = told.groupBy("host", "high", "low").agg(F.sum("pages").alias("pages"), F.sum("slack").alias("slack"), F.max("keyed").alias("keyed"))
        need = sums.where("keyed = 0").select(
            F.col("host").alias("of"), F.col("slack").alias("most"),
            F.greatest(F.lit(min_pages), F.ceil(F.col("pages") * F.lit(float(share)))).cast("bigint").alias("need"))
        known = sums.where("keyed = 1").join(F.broadcast(need), F.col("host") == F.col("of")).where(
            "pages + most - slack >= need").select("host", "high", "low", "pages", "need")

        def sent(keys: DataFrame) -> DataFrame:
            """The keys for each group of their host."""
            return keys.join(large, keys["host"] == large["large"]).select(
                keys["host"].alias("host"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
                "high", "low").repartition(tasks, "host", "part")

        def both(keys: DataFrame):
            return near.groupBy("host", "part").cogroup(sent(keys).groupBy("host", "part"))

        def of(left: pa.Table, right: pa.Table) -> tuple[list[list[Block]], np.ndarray]:
            return [_unpack(x) for x in left["packed"].to_pylist()], np.ascontiguousarray(np.stack([right[c].to_numpy() for c in ("high", "low")], 1), np.int64)

        def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            keys, on = _untold(*of(left, right), least, share) if left.num_rows and right.num_rows else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
            return pa.table([pa.array([key[0].as_py()] * len(keys), pa.string()), *(pa.array(c, pa.int64()) for c in (keys[:, 0], keys[:, 1], on))],
                            names=["host", "high", "low", "pages"])

        def judge_part(left: pa.Table, right: pa.Table) -> pa.Table:
            return pa.table(result(left["id"].combine_chunks(), left["url"].combine_chunks(), *of(left, right)), names=names)

        more = both(known.where("pages < need")).applyInArrow(look_up, "host string, high bigint, low bigint, pages bigint")
        repeated = known.unionByName(more.withColumn("need", F.lit(None).cast("bigint"))).groupBy("host", "high", "low").agg(
            F.sum("pages").alias("pages"), F.max("need").alias("need")).where("pages >= need")
        out = out.unionByName(both(repeated).applyInArrow(judge_part, judged))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_tokens", "n_repeated")
