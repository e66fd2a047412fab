"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.frames import documents, prose, rows
from tidemark.llm import resample


def plain_buckets(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return len(words), [
        zlib.crc32(b" ".join(words[i : i + n])) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)
    ]


def plain(data, target, percent=5):
    found = [(i, *plain_buckets(t)) for i, t, _ in data]
    s, t = Counter(), Counter()
    for _, _, b in found:
        s.update(b)
    for text in target:
        t.update(plain_buckets(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, n, b in found:
        weight = sum(
            c * math.floor(1000 * math.log((t[k] + 1) * (all_s + 10_000) / ((s[k] + 1) * (all_t + 10_000))))
            for k, c in Counter(b).items()
        )
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(b), weight, score, n])
    able = sorted((x for x in out if x[3] is not None and x[4] >= 20), key=lambda x: (-x[3], x[0], x[1]))
    ranks = {id(x): k + 1 for k, x in enumerate(able[: percent * len(able) // 100])}
    return sorted((tuple(x[:4]) + (ranks.get(id(x)),) for x in out), key=str)


def test_resampling_equals_a_plain_version(spark):
    data = rows() + [(100 + k, prose(k, 15 + k), None) for k in range(60)] + [(200, "x" * 300 + " é日本 B2b\u0130" * 20, None)] * 3
    target = [prose(3, 30), "Wide open fields", None, "", "x" * 300]
    made = spark.createDataFrame([(str(k), t, 1.0) for k, t in enumerate(target)], "item_id string, text string, weight double")
    for percent in (5, 40, 100, 0):
        found = resample.resample(documents(spark, data), made, percent=percent)
        assert sorted(map(tuple, found.collect()), key=str) == plain(data, target, percent)


def test_resampling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "text string")
    assert resample.resample(documents(spark, []), empty).count() == 0
    none = resample.resample(documents(spark, [(1, None, None), (2, "few words", None)]), empty).collect()
    assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in none) == [(1, 0, None), (2, 3, None)]
    assert {r["weight"] for r in none if r["doc_id"] == 1} == {0}


def test_crc_of_joined_words():
    tables, rng = resample.shift_tables(), np.random.default_rng(0)
    for n in (0, 1, 5, 64, 65, 200):
        a, b = rng.bytes(7), rng.bytes(n)
        moved = resample.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([n]), tables)
        assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_quickselect_finds_every_place(spark):
    keys = [(k * 37 % 11, k % 3, 0, k) for k in range(60)]
    made = spark.createDataFrame(keys, "_down long, doc_id long, n_features long, _row long").cache()
    for k in (1, 2, 17, 30, 59, 60):
        assert tuple(resample.kth_key(made, k, pivots=3)) == sorted(keys)[k - 1]
    assert resample.kth_key(made, 61) is None and resample.kth_key(made, 0) is None
