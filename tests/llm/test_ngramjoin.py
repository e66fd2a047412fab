"""The n-gram join against all pairs."""

import itertools
import random

import numpy as np
import pytest

from tests.llm.frames import documents, prose, rows
from tidemark.llm import ngramjoin
from tidemark.llm.common import U64, WordCodes


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))}


def plain(data):
    sets = [plain_set(t) for _, t, _ in data]
    label = list(range(len(data)))
    for i, j in itertools.combinations(range(len(data)), 2):
        if data[i][0] is None or data[j][0] is None or label[i] == label[j] or not sets[i] or not sets[j]:
            continue
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    least = {}
    for k, x in enumerate(label):
        if data[k][0] is not None:
            least[x] = min(least.get(x, data[k][0]), data[k][0])
    return sorted(((i, len(s), None if i is None else least[x]) for (i, _, _), s, x in zip(data, sets, label, strict=True)), key=str)


def changed(text, at, k):
    words = text.split()
    for j in range(k):
        words[(at + 13 * j) % len(words)] = f"own{at}x{j}"
    return " ".join(words)


def planted():
    data = rows()
    passage = prose(99, 60)
    for base in range(5):
        text = prose(200 + base, 120 + 60 * base)
        data += [(100 + 30 * base + k, changed(text, 7 * k, k % 4), None) for k in range(15)]
        data += [(400 + base, text + " " + prose(base, 12 + 5 * base), None), (410 + base, text.upper(), None)]
    data += [(500 + k, prose(300 + k, 60) + " " + passage, None) for k in range(25)]  # a passage is not enough
    data += [(600, "too few", None), (601, "Too  FEW", None), (602, "too many", None), (9, "too few", None)]
    return data


def found(spark, data):
    return sorted(map(tuple, ngramjoin.jaccard_components(documents(spark, data)).collect()), key=str)


def test_components_equal_all_pairs(spark):
    data = planted()
    want = plain(data)
    assert found(spark, data) == want
    assert len({c for _, _, c in want}) < len(data) - 50


@pytest.mark.parametrize("slots, group_tokens", [(1, 200), (1 << 14, 1 << 15)])
def test_the_matrix_alone_finds_every_link(spark, monkeypatch, slots, group_tokens):
    """Without links from buckets, and with shingles in no useful order, groups cut small."""
    data = planted()
    monkeypatch.setattr(ngramjoin, "LEAST_AGREEMENT", 13)
    monkeypatch.setattr(ngramjoin, "SLOTS", slots)
    monkeypatch.setattr(ngramjoin, "CHUNK", slots)
    monkeypatch.setattr(ngramjoin, "GROUP_TOKENS", group_tokens)
    assert found(spark, data) == plain(data)


def test_links_just_at_the_threshold(spark):
    rng, data = random.Random(5), []
    for k in range(60):
        text, cut = prose(1000 + k, 40 + k), rng.randint(2, 12)
        data += [(2 * k, text, None), (2 * k + 1, " ".join(text.split()[:-cut]), None)]
    want = plain(data)
    assert found(spark, data) == want
    links = len(data) - len({c for _, _, c in want})
    assert 10 < links < 50


def test_a_chain_of_copies_and_an_empty_table(spark):
    data = [(0, prose(7, 200), None)]
    for k in range(1, 25):
        data.append((k * 10, changed(data[-1][1], 8 * k, 2), None))
    random.Random(1).shuffle(data)
    assert found(spark, data) == plain(data)
    assert ngramjoin.jaccard_components(documents(spark, [])).count() == 0
    assert found(spark, [(None, "a b c d e", None), (None, None, None)]) == [(None, 0, None), (None, 2, None)]


def test_prefixes_and_bounds_are_exact():
    for x in range(1, 60):
        for y in range(x, 80):
            least = next(c for c in range(x + y, -1, -1) if 100 * (c - 1) < 85 * (x + y - c + 1))
            assert ngramjoin.least_overlap(x, y) == least
            if least <= x:  # such a link is possible
                assert ngramjoin.prefix_size(x) >= x - least + 1 and ngramjoin.prefix_size(y) >= y - least + 1
                assert ngramjoin.reachable(x, y, least) and ngramjoin.reachable(y, x, least) and not ngramjoin.reachable(x, y, least - 1)


def test_words_are_forgotten_by_bytes():
    words = WordCodes(limit=1000)
    first = words.of([b"a", b"x" * 2000])
    assert words.of([b"a"])[0] == first[0] and b"x" * 2000 not in words.known
    assert ngramjoin.shared(np.array([1, 5, 9], U64), np.array([5, 9, 11, 12], U64)) == 2
