"""Repetition, language, toxicity and benchmark leaks."""

import random
import zlib

import numpy as np

from tests.llm.frames import WORDS, documents, prose, rows
from tidemark.llm import decontam, langid, quality, toxicity
from tidemark.llm.common import is_remainder, is_training


def plain_quality(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [line for line in (text or "").split("\n") if line.strip(quality.SPACES)]
    seen, dups = set(), 0
    for line in lines:
        dups += line in seen
        seen.add(line)
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dups, len(inside),
        len(words) < 10 or 100 * len(inside) > 20 * len(words),
    )


def test_repeats_against_all_pairs_of_positions():
    rng = np.random.default_rng(1)
    for _ in range(150):
        lengths = rng.integers(0, 25, size=rng.integers(1, 5))
        codes = rng.integers(0, rng.integers(1, 4), size=lengths.sum())
        windows, covered, longest = quality.repeats(codes, lengths, 5, 3)
        start = 0
        for d, n in enumerate(lengths):
            x = codes[start : start + n].tolist()
            start += n

            def common(i, j, x=x, n=n):
                k = 0
                while max(i, j) + k < n and x[i + k] == x[j + k]:
                    k += 1
                return k

            best = [max([0] + [common(i, j) for j in range(n) if j != i]) for i in range(n)]
            inside = {i + k for i in range(n) if best[i] >= 5 for k in range(5)}
            spans = {i + k for i in range(n) if best[i] >= 3 for k in range(best[i])}
            assert (windows[d], covered[d], longest[d]) == (len(inside), len(spans), max(best, default=0))


def test_quality_counts_and_verdict(spark):
    twice = prose(3, 120)
    data = [r for r in rows() if r[0] != 7] + [
        (20, "a line here\nother\na line here\n\n \n", None),
        (21, prose(5, 900) + " " + twice + " " + prose(6, 900) + " " + twice, None),
        (22, "\x1cone two three #|<", None),
    ]
    found = {r["doc_id"]: r for r in quality.quality(documents(spark, data)).collect()}
    for key, text, _ in data:
        if key is not None:
            r = found[key]
            assert tuple(r[1:7]) == plain_quality(text), key
    assert found[21]["longest_repeat"] >= 120 and not found[21]["base_failed"] and not found[21]["kept"]
    assert found[1]["kept"] and not found[4]["kept"]


def test_quality_of_a_text_that_is_one_repeated_phrase(spark):
    found = {r["doc_id"]: r for r in quality.quality(documents(spark)).collect()}
    assert found[7]["n_words"] == 120_000 and found[7]["n_repeat_words"] == 120_000 and found[7]["base_failed"]
    assert quality.quality(documents(spark, [])).count() == 0


SOUNDS = {"aa": "ka lo mi fa den".split(), "bb": "ür öst gäch schu pf".split(), "cc": "cción eño lla que ía".split()}


def spoken(lang, seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_of_held_out_texts(spark):
    data = [(k, spoken(lang, k, 4 + k % 80), lang) for k, lang in enumerate(list(SOUNDS) * 70)]
    data += [(None, spoken("aa", 1, 9), "aa"), (900, None, "aa"), (901, "12 !!", "bb"), (902, spoken("cc", 2, 3000), None)]
    docs = documents(spark, data)
    found = langid.languages(docs, is_training("doc_id", 5, 0)).withColumn("held_out", is_remainder("doc_id", 5, 0)).collect()
    lang = {i: g for i, _, g in data}
    assert len(found) == len(data) and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    own = [r for r in found if r["held_out"] and r["doc_id"] < 210]
    assert len(own) > 25 and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in own]) > 0.95
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (900, 901)} == {
        900: ("und", 0.0), 901: ("und", 0.0)
    }
    assert [r["lang_pred"] for r in found if r["doc_id"] == 902] == ["cc"]


def test_language_without_labels(spark):
    docs = documents(spark, [(1, "some words", None), (2, None, "aa")])
    found = langid.languages(docs, is_training("doc_id", 5, 0)).collect()
    assert {r["lang_pred"] for r in found} == {"und"}
    assert langid.languages(documents(spark, []), is_training("doc_id", 5, 0)).count() == 0


def test_convolution_gradient_lowers_the_loss():
    rows_ = [(lang, spoken(lang, k, 30)) for k in range(30) for lang in SOUNDS]
    net = langid.fit(sorted(SOUNDS), rows_)
    windows = np.stack([langid.windows_of(t.encode())[0] for _, t in rows_])
    assert (net.predict(windows).argmax(1) == [sorted(SOUNDS).index(g) for g, _ in rows_]).mean() > 0.97


def test_folding_meets_disguised_words():
    plain = toxicity.fold("idiot loser")
    assert toxicity.fold("1d10t L0S3R") == toxicity.fold("іdiоt löѕer") == plain
    assert toxicity.fold("lo$er") == toxicity.fold("loser") and toxicity.fold("idiot$$$") == toxicity.fold("idiot") + "$$$"


def test_matches_are_whole_words_outside_exceptions():
    matcher = toxicity.Matcher({toxicity.fold("clown"): 2.0, toxicity.fold("trash"): 1.0}, ("clown fish",))
    weigh = lambda text: sum(w for _, _, w in matcher.hits(toxicity.fold(text)))
    assert weigh("you CL0WN, trash!") == 3 and weigh("a clown fish") == 0 and weigh("clownish trashy") == 0
    assert toxicity.Matcher({}, ()).hits("x") == []
    stems = toxicity.Matcher({"grobn*": 1.0, "grobnik": 3.0, "robn*": 5.0}, ())
    assert [h[2] for h in stems.hits("grobnel grobnik robn ungrobn")] == [1.0, 3.0, 5.0]


def test_toxicity_is_learned_from_training_labels_only(spark):
    bad = "grobnik mulpot varsh"
    rng = random.Random(7)
    data, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = prose(k, 40).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad.split()))
        data.append((k, " ".join(words), None))
        labels.append((k, 1, int(toxic) if zlib.crc32(str(k).encode()) % 5 else 1 - int(toxic)))
    data += [(1000, "", None), (1001, None, None), (1002, prose(1, 9000) + " mulpot grobnik mulpot" * 200, None), (1003, "you MULP0T", None)]
    labels += [(1000, 1, None), (None, 1, 1), (5, 0, 0)]
    docs = documents(spark, data)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, marks, is_training("doc_id", 5, 0))).collect()}
    assert len(found) == len(data) and all(0 <= r["score"] <= 1 for r in found.values())
    assert np.mean([found[k]["predicted"] == (k % 4 == 0) for k in range(400)]) > 0.97
    assert [found[k]["predicted"] for k in (1000, 1001, 1002, 1003)] == [0, 0, 1, 1]


def test_a_rare_insult_among_common_ones_is_a_term(spark):
    bad = [["grobnik", "mulpot", "varsh"][k % 3] if k >= 25 else "zquolt" for k in range(600)]
    data = [(k, prose(k, 30) + " " + (bad[k // 2] if k % 2 else "calm"), k % 2) for k in range(1200)]
    weights = toxicity.lexicon(spark.createDataFrame(data, "doc_id long, text string, toxic int"))
    assert {toxicity.fold(w) for w in ("zquolt", "grobnik", "mulpot", "varsh")} <= set(weights)
    assert not {toxicity.fold(w) for w in [*WORDS, "calm"]} & set(weights)
    assert weights[toxicity.fold("zquolt")] < weights[toxicity.fold("grobnik")]


def test_toxicity_without_labels(spark):
    docs, marks = documents(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, marks, is_training("doc_id", 5, 0))).collect()
    assert len(found) == len(rows()) and {r["score"] for r in found} == {0.0}


QUESTION = "Maria has 12 apples and gives 5 of them to Peter who then walks 3 miles home with Maria before dinner"


def leaked(spark, texts, items, **options):
    docs = documents(spark, [(k, t, None) for k, t in enumerate(texts)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench, **options).collect()}


def test_exact_and_re_parameterised_questions_leak(spark):
    other = QUESTION.replace("Maria", "Ann").replace("Peter", "Tom").replace("12", "40").replace("5", "seven")
    inconsistent = QUESTION.replace("Maria has", "Ann has").replace("with Maria", "with Olga")
    texts = [
        prose(1, 50) + ". Well, " + QUESTION + ". " + prose(2, 50),
        "Note: " + other.replace("miles", "km") + " " + prose(3, 20),
        "Note: " + inconsistent,
        prose(4, 100), None, "", prose(5, 3000) + ". So " + other,
    ]
    assert leaked(spark, texts, ["So " + QUESTION, prose(9, 40)]) == {(0, 0), (1, 0), (6, 0)}


def test_leaks_of_short_null_and_repeated_items(spark):
    short = "the blue river runs north today"
    texts = [prose(1, 20) + " " + short + " " + prose(2, 20), prose(3, 30)]
    assert leaked(spark, texts, [short, None, "", "two words", short]) == {(0, 0), (0, 4)}
    assert leaked(spark, texts, []) == set() and leaked(spark, [], [short]) == set()


def test_part_of_an_item_below_the_share_is_no_leak(spark):
    item = prose(31, 60)
    words = item.split()
    texts = [prose(1, 20) + " " + " ".join(words[:12]), prose(2, 20) + " " + " ".join(words[10:45])]
    assert leaked(spark, texts, [item]) == {(1, 0)}
    assert len(WORDS) > 30


def test_one_changed_value_leaves_out_only_its_windows(spark):
    item = "The ship left in 1912 " + prose(41, 30) + " and nobody saw the ship of 1912 " + prose(42, 30)
    texts = ["Well, " + item.replace("of 1912", "of 1913"), "Well, " + item.replace("in 1912", "in 1910").replace("of 1912", "of 1913")]
    assert leaked(spark, texts, [item]) == {(0, 0)}


def test_a_long_passage_leaks_whatever_the_item_is_long(spark):
    item = prose(51, 1000)
    words = item.split()
    texts = [prose(k, 20) + " " + " ".join(words[300 : 300 + n]) + " " + prose(k + 9, 20) for k, n in ((1, 50), (2, 40))]
    assert leaked(spark, texts, [item]) == {(0, 0)}


def test_first_words_and_unspaced_scripts_are_found(spark):
    items = ["Who wrote the novel about whales?", "谁写了这本关于鲸鱼的小说，它是哪一年出版的？", "Peter sailed the great grey whale home"]
    texts = ["Question: " + items[0], "请回答" + items[1], "Then came, " + items[2].replace("Peter", "Olga"), items[0], "鲸鱼的小说很多"]
    assert leaked(spark, texts, items) == {(0, 0), (3, 0), (1, 1), (2, 2)}
