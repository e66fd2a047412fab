"""Term weights, multinomial naive Bayes and lexicon sentiment as joins and aggregates.

Vocabulary, model and documents all stay distributed tables: nothing grows on the
driver with the number of words. `hashed_classifier` is the fixed-width variant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.functions.text import words
from tidemark.operators.relational import lookup
from tidemark.operators.skew import hot_among, salted_join
from tidemark.session import via_table


def term_frequency(docs: DataFrame, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc, keep, token, tf)."""
    listed = words(docs.select(doc, *keep, text), text)
    return listed.groupBy(doc, *keep, "token").agg(F.count("*").alias("tf"))


def token_rows(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, token, tf): every token by itself, for counts that do not ask for documents; nothing is grouped by them first."""
    return words(docs.select(*keep, text), text).select(*keep, "token", F.lit(1).cast("bigint").alias("tf"))


def document_frequency(terms: DataFrame) -> DataFrame:
    return terms.groupBy("token").agg(F.count("*").alias("df"))


def idf_weights(terms: DataFrame, n_docs) -> DataFrame:
    """(token, df, idf) with idf = ln((m + 1) / (df + 1)) over m documents."""
    return document_frequency(terms).withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)))


def tfidf(terms: DataFrame, weights: DataFrame) -> DataFrame:
    """Term rows with their weight; frequent tokens are spread over several tasks."""
    frequent = hot_among(weights, "token", "df")
    joined = salted_join(terms, weights, "token", F.col("doc_id"), hot=frequent)
    return joined.withColumn("weight", F.col("tf") * F.col("idf"))


def nb_priors(docs: DataFrame, label: str, smoothing: float = 1.0) -> DataFrame:
    """(label, n, log_prior) with log_prior = ln((n + s) / (N + K s))."""
    counts = docs.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n") + smoothing * F.count("*")).scalar()
    return counts.withColumn("log_prior", F.log((F.col("n") + smoothing) / total))


def nb_counts(terms: DataFrame, label: str) -> DataFrame:
    return terms.groupBy(label, "token").agg(F.sum("tf").alias("n"))


def nb_theta(counts: DataFrame, label: str, smoothing: float = 1.0) -> DataFrame:
    """(label, token, n, theta): smoothed log likelihood of the tokens seen with a label."""
    vocabulary = counts.agg(F.count_distinct("token")).scalar()
    totals = counts.groupBy(label).agg(F.sum("n").alias("_total"))
    # One row per label: the label set is the class list of the model.
    return counts.join(F.broadcast(totals), label).select(
        label, "token", "n", F.log((F.col("n") + smoothing) / (F.col("_total") + smoothing * vocabulary)).alias("theta")
    )


@dataclass
class TokenBayes:
    """A fitted model: one table row per token, and one (class, log prior, mass) per class."""

    tokens: DataFrame
    classes: list[tuple[str, float, float]]
    smoothing: float


def nb_fit(docs: DataFrame, terms: DataFrame, label: str, smoothing: float = 1.0) -> TokenBayes:
    """Count tokens per class. The token table is written once; only the class rows reach the driver."""
    per_class = F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("counts")
    tokens = via_table(
        nb_counts(terms, label).groupBy("token").agg(per_class, F.sum("n").alias("uses")), "token-model"
    )
    vocabulary = tokens.count()
    totals = tokens.select(F.explode("counts").alias("cls", "n")).groupBy("cls").agg(F.sum("n").alias("total"))
    priors = nb_priors(docs, label, smoothing).join(totals, F.col(label) == F.col("cls"), "left")
    classes = [
        (row[label], row.log_prior, (row.total or 0) + smoothing * vocabulary) for row in priors.orderBy(label).collect()
    ]
    return TokenBayes(tokens, classes, smoothing)


def nb_scores(model: TokenBayes, terms: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, class, score): log prior plus the summed log likelihoods of the known tokens.

    Scoring is one equi-join on the token, then one sum per document that carries a
    column for each class. Tokens the model never saw are ignored.
    """
    frequent = hot_among(model.tokens, "token", "uses")
    known = salted_join(terms, model.tokens.drop("uses"), "token", F.col("doc_id"), hot=frequent)

    def gain(cls, mass):
        seen = F.coalesce(F.try_element_at("counts", F.lit(cls)), F.lit(0)) + model.smoothing
        return F.sum(F.col("tf") * F.log(seen / mass))

    sums = known.groupBy("doc_id").agg(*[gain(c, mass).alias(f"_s{i}") for i, (c, _, mass) in enumerate(model.classes)])
    # A document without any known token still gets its priors.
    every = docs.select("doc_id").join(sums, "doc_id", "left")
    rows = [
        F.struct(F.lit(c).alias("cls"), (F.coalesce(f"_s{i}", F.lit(0.0)) + prior).alias("score"))
        for i, (c, prior, _) in enumerate(model.classes)
    ]
    return every.select("doc_id", F.explode(F.array(*rows)).alias("_r")).select("doc_id", "_r.cls", "_r.score")


def nb_predict(scores: DataFrame) -> DataFrame:
    """(doc, prediction, score): the class with the highest score, the first by name on ties."""
    best = F.min_by(F.struct("cls", "score"), F.struct(-F.col("score"), F.col("cls")))
    return scores.groupBy("doc_id").agg(best.alias("_b")).select(
        "doc_id", F.col("_b.cls").alias("prediction"), F.col("_b.score").alias("score")
    )


def hashed_classifier(label: str, features: int = 1 << 20, smoothing: float = 1.0, weighted: bool = True) -> Pipeline:
    """Unfitted estimator over a `tokens` column: hashed counts, IDF, naive Bayes, label names."""
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")
    stages = [HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features)]
    if weighted:
        stages.append(IDF(inputCol="tf", outputCol="features"))
    stages.append(NaiveBayes(featuresCol="features" if weighted else "tf", labelCol="label", smoothing=smoothing))
    return Pipeline(stages=[indexer, *stages])


def label_names(labels: list[str]) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels)


def sentences(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, pos, sentence, n_chars): sentences in order; runs of end marks and line ends separate them."""
    parts = F.filter(F.transform(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s)), lambda s: s != "")
    return docs.select(*key, F.posexplode(parts).alias("pos", "sentence")).withColumn("n_chars", F.length("sentence"))


def sentence_scores(parts: DataFrame, key: list[str], lexicon: DataFrame) -> DataFrame:
    """Sentence rows with a class 0..4: neutral plus the polarity of its words."""
    spread = words(parts.select(*key, "pos", "sentence"), "sentence")
    counted = spread.groupBy(*key, "pos", "token").agg(F.count("*").alias("_n"))
    polar = lookup(counted, lexicon, "token", "inner")
    sums = polar.groupBy(*key, "pos").agg(F.sum(F.col("_n") * F.col("polarity")).alias("_s"))
    score = F.greatest(F.lit(0), F.least(F.lit(4), 2 + F.coalesce("_s", F.lit(0)))).cast("int")
    return parts.join(sums, [*key, "pos"], "left").withColumn("score", score).drop("_s", "sentence")


def document_sentiment(docs: DataFrame, key: list[str], lexicon: DataFrame, text: str = "text") -> DataFrame:
    """(key, score, css, rating, is_empty): the longest sentence decides, the first one on ties.

    Empty or missing text is class 0 and is flagged.
    """
    scored = sentence_scores(sentences(docs, key, text), key, lexicon)
    longest = scored.groupBy(*key).agg(F.max_by("score", F.struct("n_chars", -F.col("pos"))).alias("score"))
    score = F.coalesce("score", F.lit(0))
    return (
        docs.select(*key)
        .join(longest, key, "left")
        .select(
            *key,
            score.alias("score"),
            scalar.sentiment_css(score).alias("css"),
            scalar.sentiment_rating(score).alias("rating"),
            F.col("score").isNull().alias("is_empty"),
        )
    )


def learned_lexicon(docs: DataFrame, low: float = 0.8, high: float = 0.95, support: int = 5) -> DataFrame:
    """(token, polarity): words of labelled documents that go with good (+1) or poor (-1) quality."""
    seen = term_frequency(docs, keep=("quality",))
    shares = seen.groupBy("token").agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
    share = F.col("good") / F.col("n")
    polarity = F.when(share >= high, 1).when(share <= low, -1)
    return shares.filter(F.col("n") >= support).select("token", polarity.alias("polarity")).dropna()
