"""Archive, near duplicates, language model and the pipeline."""

import base64
import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import LONG, documents, prose, rows
from tidemark.llm import hmm, neardup, warc
from tidemark.llm.common import BITMAP_BITS, bitmap, in_bitmap, is_training, without_ids
from tidemark.session import shared_path


def pages(spark, data):
    return spark.createDataFrame(
        [(i, u, h, b"x", 1) for i, u, h in data], "page_id long, url string, html string, digest binary, owner long"
    )


PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/: x", "<p>one</p>"), (3, None, None), (4, "u\r\nv", ""),
    (5, "http://c/", "é" * 10), (6, "http://d/", LONG), (7, "http://e/", "<p>one</p>"), (7, "http://e/", "<p>one</p>"),
    (None, "http://f/", "<p>one</p>"), (None, "http://g/", "alone"),
]


def test_archive_gives_back_every_record(spark):
    found = warc.archived_pages(pages(spark, PAGES)).collect()
    owner = {}
    for i, _, h in PAGES:
        body = (h or "").encode()
        owner[body] = max([x for x in (owner.get(body), i) if x is not None], default=None)
    want = []
    for i, _, h in PAGES:
        body = (h or "").encode()
        own = i == owner[body]
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), sha, "response" if own else "revisit", None if own else owner[body]))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_archive_stores_each_payload_once_and_exact_headers(spark):
    path = shared_path(spark, "warc-test")
    warc.write_archive(pages(spark, PAGES), path)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({(h or "") for _, _, h in PAGES})
    records = {r["page_id"]: r for r in warc.read_archive(spark, path).collect() if r["page_id"] is not None}
    assert records[6]["payload"] == LONG.encode() and records[2]["payload"] == b"<p>one</p>"
    assert records[2]["header"].startswith(b"WARC/1.1\r\nWARC-Type: revisit\r\n")
    assert records[2]["header"].endswith(b"WARC-Refers-To: <urn:record:7>\r\nContent-Length: 0\r\n\r\n")
    assert records[2]["url"] == "http://b/: x" and records[4]["url"] == "u%0A%0Av" and records[3]["url"] is None


def test_small_payloads_are_all_responses(spark):
    path = shared_path(spark, "warc-test")
    warc.write_archive(pages(spark, PAGES), path, min_dedupe_bytes=100)
    assert warc.read_archive(spark, path).where("record_type = 'revisit'").count() == 0


def test_a_damaged_payload_is_noticed(spark):
    import zstandard

    batch = {"digest": [b"x" * 32], "header": [b""], "packed": [zstandard.ZstdCompressor().compress(b"abc")]}
    import pyarrow as pa

    with pytest.raises(warc.DigestMismatch):
        list(warc.unpack([pa.RecordBatch.from_pydict(batch)]))
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_dart_signatures_agree_as_the_weighted_similarity():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 2**63, size=60).astype(np.uint64)
    for scale in (1, 0.2, 7):
        one = rng.random(60) * scale
        two = one * rng.choice([1, 0.5, 2], 60)
        true = np.minimum(one, two).sum() / np.maximum(one, two).sum()
        a, b = (neardup.dart_signatures([codes], [w], 3000)[0] for w in (one, two))
        assert abs((a == b).mean() - true) < 0.04
    assert (neardup.dart_signatures([codes[:0]], [np.empty(0)], 10) == 0).all()


def changed(text, k):
    words = text.split()
    for j in range(k):
        words[(j + 1) * len(words) // (k + 1)] = f"new{j}"
    return " ".join(words)


def brute_classes(data):
    """Connected components of all pairs of rows with words and at least 0.8 similarity."""
    named = [(i, neardup.shingles(t, {})) for i, t, _ in data if i is not None]
    label = {i: i for i, _ in named}
    for (i, x), (j, y) in itertools.combinations(named, 2):
        if neardup.weighted_jaccard(x, y) >= 0.8 and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_near_duplicate_classes_against_all_pairs(spark):
    data = rows()
    shared = prose(99, 40)
    for base in range(6):
        text = prose(200 + base, 150 + 40 * base)
        data += [(100 + 20 * base + k, changed(text, k % 4), None) for k in range(12)]
    data += [(500 + k, prose(300 + k, 60) + " " + shared, None) for k in range(25)]  # a passage is not enough
    data += [(600, "too few", None), (601, "too few", None), (602, "too many", None)]
    found = neardup.near_duplicates(documents(spark, data)).collect()
    assert len(found) == len(data)
    want = brute_classes(data)
    assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None} == want
    assert all(r["class_id"] is None for r in found if r["doc_id"] is None)
    assert len(set(want.values())) < len(want) - 40


def one_changed(text, at, k):
    """`k` words changed close together, at a place of its own."""
    words = text.split()
    for j in range(k):
        words[(at + 17 * j) % len(words)] = f"own{at}x{j}"
    return " ".join(words)


def test_copies_of_an_original_in_the_middle_of_the_ids(spark):
    original, second = prose(700, 200), prose(701, 200)
    data = [(k, original if k == 60 else one_changed(original, k, 4), None) for k in range(120)]
    # Two originals whose copies meet in no common centre, linked by one text between them.
    data += [(1000 + k, second if k == 20 else one_changed(second, 3 * k, 4), None) for k in range(40)]
    data += [(2000 + k, one_changed(one_changed(second, 3 * k, 4), 3 * k + 7, 2), None) for k in range(40)]
    want = brute_classes(data)
    assert {want[k] for k in range(120)} == {0}
    found = neardup.near_duplicates(documents(spark, data)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == want


@pytest.mark.parametrize("limit", ["BLOCK", "BLOCK_BYTES"])
def test_blocks_of_a_bucket_are_compared_in_full(spark, monkeypatch, limit):
    monkeypatch.setattr(neardup, limit, 4 if limit == "BLOCK" else 4000)
    texts = [prose(800 + k, 100) for k in range(30)]
    texts[17] = changed(texts[23], 2)
    texts[5] = texts[9] = texts[29]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sketches = neardup.signature_rows(docs, neardup.BANDS, neardup.ROWS).select(F.col("doc_id").alias("rep"), "sketch")
    members = spark.createDataFrame([(1, k) for k in range(30)] + [(2, 3), (2, 4)], "key long, rep long")
    labels = spark.createDataFrame([(9, 5), (5, 5)], "node long, label long")
    links = {tuple(r) for r in neardup.crossing(members, labels, sketches, docs, 0.8, 100).collect()}
    assert (17, 23) in links and links & {(5, 29), (9, 29)} and links <= {(17, 23), (5, 29), (9, 29)}


def test_links_of_two_blocks_span_their_classes():
    """Members alike in pairs: as many links as join the classes, and none between classes that nothing links."""
    rng, k = np.random.default_rng(3), 40
    base = rng.integers(0, 2**63, size=(4, 300)).astype(np.uint64)
    elements = []
    for m in range(k):
        own = base[m % 4].copy()
        own[rng.choice(300, m % 25, replace=False)] = rng.integers(0, 2**63, size=m % 25)
        elements.append(np.sort(own))
    sketch = np.tile(np.arange(120, dtype="<u2"), (k, 1))  # signatures drop nothing
    label = np.arange(k)
    left, right = np.arange(k // 2), np.arange(k // 2, k)
    for one, two in ((left, right), (np.arange(k), np.arange(k))):
        links = neardup.block_links(np.arange(k), label, sketch, elements, one, two, 0.8)
        want, got = (list(range(k)) for _ in range(2))
        join = lambda of, a, b: [of[b] if x == of[a] else x for x in of]
        for a in one:
            for b in two:
                both = len(np.intersect1d(elements[a], elements[b]))
                if a != b and both >= 0.8 * (600 - both):
                    want = join(want, a, b)
        for a, b in links:
            assert got[a] != got[b]  # no link is implied by the ones before
            got = join(got, a, b)
        assert len({tuple(x) for x in zip(want, got)}) == len(set(want)) == len(set(got)) < k


def test_repeats_count_as_elements():
    codes, counts = np.array([3, 9], np.uint64), np.array([2, 1])
    more = neardup.counted_apart(codes, np.array([1, 4]))
    assert len(np.unique(neardup.counted_apart(codes, counts))) == 3 and len(more) == 5
    assert len(np.intersect1d(neardup.counted_apart(codes, counts), more)) == 2


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    labels = {r["node"]: r["label"] for r in neardup.components(links).collect()}
    assert labels == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_bit_table_and_rows_without_ids(spark):
    values = [3, -5, 2**62, BITMAP_BITS + 3]
    bits = bitmap(spark.createDataFrame([(v,) for v in [*values, None]], "v long"), "v")
    assert in_bitmap(bits, np.array([*values, 4, -6])).tolist() == [True] * 4 + [False] * 2
    docs = documents(spark)
    ids = spark.createDataFrame([(1,), (None,), (BITMAP_BITS + 2,)], "doc_id long")
    left = [r["doc_id"] for r in without_ids(docs, ids, once=True).collect()]
    assert Counter(left) == Counter([2, 3, 4, 5, 6, 7, 8, None, None, 10, 11])


def test_rows_of_one_id_and_different_texts_stay(spark):
    docs = documents(spark, [(1, "a b", None), (1, "c d", None), (1, "a b", None), (2, "e", None)])
    left = without_ids(docs, spark.createDataFrame([(2,)], "doc_id long"), once=True)
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, "a b"), (1, "c d")]


def plain_hmm(model, sequence):
    """Likelihood and expected counts by summing over all state paths."""
    k, total = len(model.start), 0.0
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((k, len(model.emit)))
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for a, b, s in zip(path, path[1:], sequence[1:], strict=False):
            p *= model.move[a, b] * model.emit[s, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:], strict=False):
            move[a, b] += p
        for a, s in zip(path, sequence, strict=True):
            emit[a, s] += p
    return total, np.concatenate([start, move.ravel(), emit.ravel()]) / total


def test_recursions_against_all_paths(monkeypatch):
    rng = np.random.default_rng(0)
    model = hmm.Hmm.first(3, rng.integers(0, 9, size=7).astype(float))
    sequences = [rng.integers(0, 7, size=n).astype(np.uint16) for n in (1, 2, 6, 3, 5, 4)]
    plain = [plain_hmm(model, s) for s in sequences]
    logs = [math.log10(p) for p, _ in plain]
    assert np.allclose(model.log10_likelihoods(sequences), logs)
    assert np.allclose(model.expected(sequences), sum(c for _, c in plain))
    monkeypatch.setattr(hmm, "AT_ONCE", 4)  # groups, and blocks of a long sequence
    assert np.allclose(model.log10_likelihoods(sequences), logs)


def test_language_model_counts_base_and_likelihood(spark, monkeypatch):
    data = [(k, prose(k % 40, 30 + k % 7) + (" Rare%d" % k if k % 3 == 0 else ""), None) for k in range(90)] + rows()
    docs = documents(spark, data)
    kept = {}
    update = hmm.Hmm.updated
    monkeypatch.setattr(hmm.Hmm, "updated", lambda s, c, z: kept.setdefault("model", update(s, c, z)))
    words = {}
    found_vocabulary = hmm.vocabulary
    monkeypatch.setattr(hmm, "vocabulary", lambda *a: words.setdefault("v", found_vocabulary(*a)))
    found = hmm.language_model(
        docs, is_training("doc_id", 7, 2), states=2, rounds=1, head=20, own_classes=6, suffix_classes=5
    ).collect()
    train = [(i, t) for i, t, _ in data if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for _, t in train for w in hmm.tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    model, vocabulary = kept["model"], words["v"]
    assert vocabulary.sizes.sum() == n
    kinds = Counter(vocabulary.class_of(w) for w in counts)
    want = []
    for i, t, _ in data:
        tokens = hmm.tokens_of(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        inner, alpha, logs = 0.0, None, 0.0
        for w in tokens:
            at = vocabulary.class_of(w)
            if w not in vocabulary.own:
                inner += math.log10((counts[w] + 1) / (vocabulary.sizes[at] + kinds[at] + 1))
            alpha = (model.start if alpha is None else alpha @ model.move) * model.emit[at]
            logs += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        want.append((i or -1, len(tokens), sum(w in counts for w in tokens), n, base, inner + logs))
    got = sorted((r["doc_id"] or -1, *r[1:]) for r in found)
    assert np.allclose(np.array(got, float), np.array(sorted(want), float), rtol=1e-9)


def test_language_model_without_training_rows(spark):
    docs = documents(spark, [(None, "a b", None), (None, None, None)])
    found = sorted(tuple(r) for r in hmm.language_model(docs, is_training("doc_id", 7, 2)).select("n_tokens", "n_known", "train_tokens", "base_score").collect())
    assert found == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert hmm.language_model(documents(spark, []), is_training("doc_id", 7, 2)).count() == 0


def test_training_raises_the_likelihood_of_held_out_texts(spark):
    data = [(k, prose(k, 50), None) for k in range(120)]
    scores = [
        hmm.language_model(documents(spark, data), is_training("doc_id", 7, 2), rounds=r).agg({"score": "sum"}).first()[0]
        for r in (0, 3)
    ]
    assert scores[1] > scores[0]
