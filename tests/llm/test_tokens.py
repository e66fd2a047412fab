"""Token files, counts and byte-level BPE against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.frames import LONG, documents, prose, rows
from tidemark.llm import bpe, tokencount, tokenfiles
from tidemark.session import shared_path

WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", "   ", "a   b", "x\x1c y!\x1c z", "<|endoftext|> hi<|ENDOFTEXT|>", "don't STOP  \n\n now...", "!!!\x1f ok",
    "naïve ét́ ΣΑΣ ß İ", "日本語テキスト。" * 9, " \t　 mixed   sp ",
    "1234 56,7.8% \r\n\r\n x", "Hello.,World it's I'LL we'RE", ".", "can't.", "   x", "UPPER lower École", "a" * 300,
]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_files_hold_the_library_s_ids(spark):
    docs = documents(spark)
    found = tokenfiles.token_files(docs, WORD_BPE, end_id=2).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want, start = [], 0
    for key, text, _ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*ids_of(tokenizer, text), 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want


def test_letters_that_compose_in_lower_case_only():
    encoder, tokenizer = tokenfiles.WordEncoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    words = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "aJ\u030cB", "É", "E\u0301T"]
    texts = [*words, "Some PLAIN " + " ".join(words) + " Words"]
    want = [ids_of(tokenizer, t) for t in texts]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == want


def test_token_files_keep_ids_in_one_flat_sequence(spark):
    path = shared_path(spark, "tokens-test")
    data = [(k, prose(k, 30), None) for k in range(50)]
    parts = tokenfiles.write_token_files(documents(spark, data).repartition(6), path, WORD_BPE, 2)
    flat = np.concatenate([np.fromfile(f"{path}/part-{p['part']:06d}.bin", "<u2") for p in parts])
    tokenizer = Tokenizer.from_file(WORD_BPE)
    assert flat.tolist() == [i for _, t, _ in data for i in [*ids_of(tokenizer, t), 2]]
    assert [p["base"] for p in parts] == np.cumsum([0] + [p["n_tokens"] for p in parts])[:-1].tolist()


def test_words_are_encoded_as_whole_texts_are():
    encoder, tokenizer = tokenfiles.WordEncoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for text, packed in zip(ODD, encoder.encode(ODD), strict=True):
        assert np.frombuffer(packed, encoder.dtype).tolist() == ids_of(tokenizer, text), text


def test_bounded_tables_forget_and_stay_right(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_WORDS", 5)
    monkeypatch.setattr(tokencount, "CACHE_UNITS", 5)
    encoder, counter = tokenfiles.WordEncoder(WORD_BPE), tokencount.UnitCounter(BYTE_BPE)
    words, bytes_ = Tokenizer.from_file(WORD_BPE), Tokenizer.from_file(BYTE_BPE)
    for seed in range(4):
        text = prose(seed, 40)
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == ids_of(words, text)
        assert counter.count([text]) == [len(ids_of(bytes_, text))]


def test_counts_equal_the_library_s(spark):
    data = [*rows(), *[(100 + k, t, None) for k, t in enumerate(ODD)]]
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    found = tokencount.token_counts(documents(spark, data), BYTE_BPE, 512, chunk=200, overlap=16).collect()
    want = [(i, len((t or "").encode()), n, n > 512) for i, t, _ in data for n in [len(ids_of(tokenizer, t))]]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_splicing_widens_until_the_encodings_agree():
    tokenizer, calls = Tokenizer.from_file(BYTE_BPE), []

    def encode(piece):
        calls.append(len(piece))
        return tokencount.spans_of(tokenizer, piece)

    rng = random.Random(4)
    texts = [" ".join(rng.sample(ODD, len(ODD))) for _ in range(4)] + ["ab" * 900 + " x " + "q" * 700, LONG[:5000]]
    for text in texts:
        for chunk, overlap in ((50, 10), (300, 40), (700, 5)):
            assert tokencount.count_spliced(text, encode, chunk, overlap) == len(ids_of(tokenizer, text))
    calls.clear()
    assert tokencount.count_spliced("x" * 400, encode, 50, 10) == len(ids_of(tokenizer, "x" * 400))
    assert max(calls) == 400  # no place to cut: one piece in the end


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, library):
    data = [*rows(), *[(100 + k, t, None) for k, t in enumerate(ODD)]]
    found = bpe.bpe(documents(spark, data), RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    want = []
    for key, text, _ in data:
        ids = library.encode_ordinary(text or "")
        sums = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((key, len(ids), *sums, ids))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_words_of_one_letter_and_long_words_merge_as_ranked(library):
    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    words = ["aaaaaaa", "the" * 50, "".join(rng.choice("abcde") for _ in range(400)), "x"]
    assert coder.encode_words([w.encode() for w in words]) == [library.encode_ordinary(w) for w in words]
    assert coder.decode([b"", np.array(library.encode_ordinary("ab c"), "<i4").tobytes()]) == [b"", b"ab c"]


def test_empty_tables(spark):
    empty = documents(spark, []).select("doc_id", "text")
    assert tokenfiles.token_files(empty, WORD_BPE, 2).count() == 0
    assert tokencount.token_counts(empty, BYTE_BPE, 512).count() == 0
    assert bpe.bpe(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_recent_values_come_back_from_the_older_generation():
    from tidemark.llm.common import Recent

    recent, learned = Recent(3), []

    def ask(keys):
        for key in recent.missing(set(keys)):
            learned.append(key)
            recent.known[key] = key.upper()
        assert all(recent.known[k] == k.upper() for k in keys)
        recent.trim(set(keys))

    for keys in ("ab", "cd", "a", "ef", "a", "ghij", "b"):
        ask(keys)
    assert len(recent.known) + len(recent.old) <= 2 * 3 + 4
    assert learned.count("a") == 1 and learned.count("b") == 2


RARE = "\x1c\x1f\x85\xa0\u1680\u2000\u200a\u2028\u202f\u205f\u3000"
NEAR = "\x1b\xa1\u200b\u1681\u3001\u0085\u0080\U00010000"  # next to them, or ending in the same bytes
SPACES = [" \t", *(f"a{c} b {c}c\t{c}\n {c}d {c}" for c in RARE + NEAR)]


def test_bounds_in_bytes_equal_the_units_of_texts():
    import pyarrow as pa

    from tidemark.llm.common import text_bytes, unit_bounds, units

    texts = [*ODD, None, *SPACES, "", prose(3, 50), *SPACES]
    for some in (texts, [], [""], [None, "", None], *([t] for t in texts)):
        for kind in (pa.string(), pa.large_string()):
            letters, bounds = text_bytes(pa.array(["left out", *some], kind)[1:])
            places, first = unit_bounds(letters, bounds)
            cut = [letters[a:b].tobytes().decode() for a, b in zip(places[:-1], places[1:], strict=True)]
            assert [cut[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [units(t or "") for t in some]


class CountedPattern:
    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def findall(self, text):
        self.calls += 1
        return self.pattern.findall(text)


def test_new_units_are_searched_and_decoded_together(library):
    import pyarrow as pa

    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    coder.pattern = CountedPattern(coder.pattern)
    texts = [*ODD, *SPACES, "", *(" ".join(f"{w}{k}'s.," for w in prose(k, 30).split()) for k in range(40))]
    ids, bounds = coder.encode(pa.array([*texts, None]))
    want = [library.encode_ordinary(t) for t in [*texts, ""]]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    assert coder.pattern.calls < 100  # of more than 1,200 units
    assert coder.decode_ids(ids, bounds) == [t.encode() for t in [*texts, ""]]
    assert [x.tolist() for x in coder.encode(pa.array(["", None]))] == [[], [0, 0, 0]]
    assert coder.decode_ids(np.empty(0, np.int32), np.zeros(3, np.int64)) == [b"", b""]


def test_ids_are_decoded_in_pieces_and_in_any_order_of_the_engine(library, monkeypatch):
    coder = bpe.DuckBpe(RANKS, public_tokenizers.PATTERN)
    texts = [prose(k, 60) for k in range(9)] + ["", "日本語" * 40]
    packed = [np.array(library.encode_ordinary(t), "<i4").tobytes() for t in texts]
    monkeypatch.setattr(bpe, "IDS_AT_ONCE", 50)
    assert coder.decode(packed) == [t.encode() for t in texts]
    monkeypatch.setattr(bpe, "DECODE", bpe.DECODE.replace("ORDER BY spot", "ORDER BY spot DESC"))
    assert coder.decode(packed) == [t.encode() for t in texts]


def test_words_in_bytes_equal_the_words_of_texts():
    import pyarrow as pa

    from tidemark.llm.common import text_bytes

    def plain(text):
        raw = text.encode()
        return raw.split() if b"<|" in raw else [w.lower() if w.isascii() else w for w in raw.split()]

    texts = [*ODD, None, *SPACES, "", "A <|B C|> Dé", "Zé ZE @[`{ <", "|X Y", "<", "|Q", prose(3, 50)]
    for some in (texts, texts[::-1], [], ["", None], *([t] for t in texts)):
        words, places, first = tokenfiles.cut_words(*text_bytes(pa.array(["left OUT<|", *some], pa.string())[1:]))
        cut = [words[a:b].tobytes() for a, b in zip(places[:-1], places[1:], strict=True)]
        assert [cut[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [plain(t or "") for t in some]


class CountedTokenizer:
    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []
        self.model = self

    def tokenize(self, word):
        self.asked.append(word)
        return self.tokenizer.model.tokenize(word)

    def encode_batch_fast(self, words, **how):
        self.asked += words
        return self.tokenizer.encode_batch_fast(words, **how)


def test_letters_are_looked_up_once_whatever_their_case_and_marks(monkeypatch):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    encoder = tokenfiles.WordEncoder(WORD_BPE)
    encoder.tokenizer = CountedTokenizer(tokenizer)
    texts = [f"{w}{m}" for w in ("hören", "Hören", "ÉTÉ", "été", "Straße", "plain", "PLAIN") for m in ("", ".", ",!!", "$$$", "<|", "'s.", "1")]
    texts += [" ".join(texts), "<| " + " ".join(texts)]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [ids_of(tokenizer, t) for t in texts]
    assert len(encoder.encode(texts)) == len(texts)
    assert len(encoder.tokenizer.asked) <= 4 + 4 + 2 * 7  # letters, marks, and words that are neither

    monkeypatch.setattr(tokenfiles, "CACHE_WORDS", 40)
    encoder = tokenfiles.WordEncoder(WORD_BPE)
    encoder.tokenizer = CountedTokenizer(tokenizer)
    letters = "abcdefghij"
    for a in letters:
        encoder.encode(["common"])
        encoder.encode([" ".join(f"{a}{b}{c}" for b in letters[:3] for c in letters)])
    assert encoder.tokenizer.asked.count("common</w>" if "common</w>" in encoder.tokenizer.asked else "common") == 1
