"""The merge replay against merging word by word, for small and large index entries."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tokenloom.llm import merge_replay as M  # noqa: E402


def plain(word, by_pair, made):
    """Lowest rank first, leftmost first."""
    w = list(word)
    while True:
        found = [(by_pair[p], k) for k, p in enumerate(zip(w, w[1:])) if p in by_pair]
        if not found:
            return w
        r, k = min(found)
        w[k:k + 2] = [made[r]]


@pytest.mark.parametrize("many", [1, 4, 1 << 30])
def test_replay_equals_merging_word_by_word(monkeypatch, many):
    monkeypatch.setattr(M, "MANY", many)
    rng = random.Random(many)
    for _ in range(60):
        symbols = rng.randint(2, 6)
        pairs = list({(rng.randrange(symbols + 8), rng.randrange(symbols + 8)) for _ in range(rng.randint(0, 25))})
        rng.shuffle(pairs)
        by_pair = {p: r for r, p in enumerate(pairs)}
        made = [rng.randrange(symbols, symbols + 8) for _ in pairs] or [0]  # a merge may make a pair of lower rank
        if rng.random() < 0.5:  # as trained: each merge makes a new symbol of symbols known by then
            by_pair = {}
            while len(by_pair) < 12:
                by_pair.setdefault((rng.randrange(symbols + len(by_pair)), rng.randrange(symbols + len(by_pair))), len(by_pair))
            made = [symbols + r for r in range(12)]
        ranks = M.Ranks({M.pair_key(a, b): r for (a, b), r in by_pair.items()})
        words = [[rng.randrange(symbols) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 40))]
        out, sizes = M.replay(np.array(sum(words, []), np.int64), np.array([len(w) for w in words]), ranks, np.array(made))
        stops = np.cumsum(sizes)
        got = [out[b - n:b].tolist() for b, n in zip(stops, sizes)]
        # one rank at a time over all words equals word by word, since words do not touch
        assert got == [plain(w, by_pair, made) for w in words]


def test_places_come_from_the_index(monkeypatch):
    """Without its entries nothing merges: there is no other way to a place."""
    ranks, made = M.Ranks({M.pair_key(0, 1): 0}), np.array([2])
    assert M.replay(np.array([0, 1, 0, 1]), np.array([2, 2]), ranks, made)[0].tolist() == [2, 2]
    monkeypatch.setattr(M, "heappush", lambda heap, rank: None)
    assert M.replay(np.array([0, 1, 0, 1]), np.array([2, 2]), ranks, made)[0].tolist() == [0, 1, 0, 1]
