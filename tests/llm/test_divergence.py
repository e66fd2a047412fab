"""The source audit against sums over all terms."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.frames import LONG, prose
from tidemark.llm import divergence


def plain(data, least, top):
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in data:
        lang, source = lang or "", source or ""
        terms = re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), "pair") for o in sources if o != s]
            terms = [(p[s][t] - q[t], t, "term") for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for some, limit in ((pairs, None), (terms, top)):
                for rank, (value, item, part) in enumerate(sorted(some, key=lambda x: (-x[0], x[1]))[:limit], 1):
                    out.append((lang, s, part, item.decode(), value, rank))
    return sorted(out)


def frame(spark, data):
    made = [(k, t, g, s, k, 1, "x") for k, (t, g, s) in enumerate(data)]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n long, g int, term string")


def some(n, seed=0):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("é", "X", "日本", "zz", "Q")]
    return [
        (" ".join(rng.choice(words[: rng.randint(3, 40)]) for _ in range(rng.randint(0, 60))), rng.choice(["aa", "bb", None]), f"s{rng.randint(0, 6)}")
        for _ in range(n)
    ]


def test_audit_equals_sums_over_all_terms(spark, monkeypatch):
    data = some(150) + [
        (None, "aa", "s1"), ("", "aa", "empty"), (None, None, None), (LONG, "aa", None), ("1 2 3", "cc", "s1"), ("x", "cc", "s2"),
        (prose(1, 50), "dd", "alone"),
    ]
    data += data[:20]  # repeated rows
    for least, top in ((1, 3), (12, 50), (10_000, 50)):
        found = divergence.divergence(frame(spark, data), least, top)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, found.collect())) == plain(data, least, top)
    # Many blocks, parts of rows, pieces of a scatter and hand-overs inside a task give the same.
    for name, value in (("BLOCK_PAIRS", 50), ("PEERS", 2), ("AT_ONCE", 4), ("FLUSH_BYTES", 500)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(map(tuple, divergence.divergence(frame(spark, data), 1, 3).collect())) == plain(data, 1, 3)
    assert divergence.divergence(frame(spark, [])).count() == 0


def test_shares_do_not_overflow(spark):
    made = spark.createDataFrame([(10**15, 3 * 10**15, 7)], "n long, total long, terms long")
    want = 1 + 1_000_000_000 * (10**15 + 5) // (3 * 10**15 + 35)
    assert made.selectExpr(divergence.share("n", "total", "terms") + " AS p").first()["p"] == want


def test_scatter_against_all_pairs():
    rng = np.random.default_rng(1)
    rows = [(t, g, int(rng.integers(1, 99)), g * 3) for t in range(30) for g in range(9) if rng.random() < 0.4]
    term, group, p, base = (np.array(c) for c in zip(*rows))
    got = {(g, int(h)): int(v) for g, hs, vs in divergence.scatter(term, group, p, base, slice(0, 9), 9) for h, v in zip(hs, vs)}
    want = defaultdict(int)
    for a, b in itertools.combinations(rows, 2):
        if a[0] == b[0]:
            want[a[1], b[1]] += abs(a[2] - b[2]) - abs(a[2] - b[3]) - abs(b[2] - a[3]) + abs(a[3] - b[3])
    assert got == want
