"""Tokens, term weights, naive Bayes and sentiment on documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import text
from tidemark.functions.stopwords import ENGLISH
from tidemark.operators.relational import stratified_folds
from tidemark.plans import textmodel
from tidemark.session import via_table
from tidemark.sources.tables import POSTS_SQL, documents, posts, table


@query(
    "wordcount",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM documents)
    WHERE word != '' GROUP BY 1""",
)
def wordcount(spark, folder):
    listed = text.tokens(documents(spark, folder).select("text"), "text", "word", r"[ \n]")
    return listed.groupBy("word").agg(F.count("*").alias("n"))


@query(
    "tokens",
    f"WITH {POSTS_SQL} SELECT event_id, token FROM (SELECT event_id, unnest(string_split(text, ' ')) AS token FROM posts) WHERE token != ''",
)
def tokens(spark, folder):
    return text.tokens(posts(spark, folder).select("event_id", "text"))


@query(
    "hashtag_extract",
    f"""WITH {POSTS_SQL} SELECT event_id, topic FROM (SELECT event_id, unnest(string_split(text, ' ')) AS topic FROM posts)
    WHERE topic LIKE '#%'""",
)
def hashtag_extract(spark, folder):
    return text.hashtags(posts(spark, folder).select("event_id", "text"))


@query(
    "keyword_tokens",
    """SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents)
    WHERE contains(token, 'tion') GROUP BY 1""",
)
def keyword_tokens(spark, folder):
    listed = text.tokens(documents(spark, folder).select("text"))
    return listed.filter(F.col("token").contains("tion")).groupBy("token").agg(F.count("*").alias("n"))


STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"


@query(
    "stopword_filter",
    rf"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \n]')) AS word FROM documents)
    WHERE word != '' AND word NOT IN {STOP_SQL} GROUP BY 1""",
)
def stopword_filter(spark, folder):
    lowered = documents(spark, folder).select(F.lower("text").alias("text"))
    listed = text.tokens(lowered, "text", "word", r"[ \n]")
    return listed.filter(~F.col("word").isin(*ENGLISH)).groupBy("word").agg(F.count("*").alias("n"))


@query(
    "clean_text",
    """SELECT conv_id, turn, lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')) AS spaced,
    length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) AS n_letters FROM conversations""",
)
def clean_text(spark, folder):
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        text.spaced_letters(F.col("text")).alias("spaced"),
        F.length(text.letters_only(F.col("text"))).cast("bigint").alias("n_letters"),
    )


@query(
    "token_clean",
    r"""SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '[ \n]'),
    lambda t: regexp_full_match(t, '\p{L}+') AND length(t) > 2), lambda t: lower(t)), ' ') AS cleaned FROM documents""",
)
def token_clean(spark, folder):
    return documents(spark, folder).select("doc_id", text.clean_tokens(F.col("text")).alias("cleaned"))


# --- term weights -------------------------------------------------------------

TERMS_SQL = r"""terms AS (SELECT doc_id, token, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}{3,}')) AS token FROM documents) GROUP BY 1, 2)"""


@query("term_frequency", f"WITH {TERMS_SQL} SELECT doc_id, token, tf FROM terms")
def term_frequency(spark, folder):
    return textmodel.term_frequency(documents(spark, folder))


IDF_SQL = f"""WITH {TERMS_SQL}, idf AS (SELECT token, count(*) AS df,
  ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM terms GROUP BY 1)"""


def weights(docs, terms):
    return textmodel.idf_weights(terms, docs.agg(F.count("*")).scalar())


@query("idf_weights", IDF_SQL + " SELECT token, df, round(idf, 6) AS idf FROM idf")
def idf_weights(spark, folder):
    docs = documents(spark, folder)
    return weights(docs, textmodel.term_frequency(docs)).select("token", "df", F.round("idf", 6).alias("idf"))


@query("tfidf", IDF_SQL + " SELECT doc_id, token, tf, round(tf * idf, 6) AS weight FROM terms JOIN idf USING (token)")
def tfidf(spark, folder):
    docs = documents(spark, folder)
    terms = via_table(textmodel.term_frequency(docs), "terms")
    return textmodel.tfidf(terms, weights(docs, terms)).select(
        "doc_id", "token", "tf", F.round("weight", 6).alias("weight")
    )


# --- naive Bayes ----------------------------------------------------------------


@query(
    "nb_priors",
    """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1)
    SELECT lang, n, round(ln((n + 1.0) / (sum(n) OVER () + count(*) OVER ())), 6) AS log_prior FROM c""",
)
def nb_priors(spark, folder):
    priors = textmodel.nb_priors(table(spark, folder, "documents"), "lang")
    return priors.select("lang", "n", F.round("log_prior", 6).alias("log_prior"))


NB_SQL = r"""WITH terms AS (SELECT doc_id, lang, token, count(*) AS tf
  FROM (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}{3,}')) AS token FROM documents) GROUP BY 1, 2, 3),
c AS (SELECT lang, token, CAST(sum(tf) AS BIGINT) AS n FROM terms GROUP BY 1, 2),
t AS (SELECT lang, sum(n) AS total FROM c GROUP BY 1),
v AS (SELECT count(DISTINCT token) AS v FROM c)"""


@query(
    "nb_theta",
    NB_SQL + " SELECT lang, token, n, round(ln((n + 1.0) / (total + v)), 6) AS theta FROM c JOIN t USING (lang), v",
)
def nb_theta(spark, folder):
    terms = textmodel.term_frequency(documents(spark, folder, "lang"), keep=("lang",))
    theta = textmodel.nb_theta(via_table(textmodel.nb_counts(terms, "lang"), "token-counts"), "lang")
    return theta.select("lang", "token", "n", F.round("theta", 6).alias("theta"))


NB_PREDICT_SQL = (
    NB_SQL
    + """, p AS (SELECT lang AS cls, ln((count(*) + 1.0) / ((SELECT count(*) FROM documents)
        + (SELECT count(DISTINCT lang) FROM documents))) AS log_prior FROM documents GROUP BY 1),
    g AS (SELECT doc_id, p.cls, sum(tf * ln((coalesce(c.n, 0) + 1.0) / (t.total + v))) AS s
      FROM terms, p, v JOIN t ON t.lang = p.cls LEFT JOIN c ON c.token = terms.token AND c.lang = p.cls GROUP BY 1, 2),
    r AS (SELECT d.doc_id, d.lang, p.cls, log_prior + coalesce(s, 0) AS score FROM documents d, p
      LEFT JOIN g ON g.doc_id = d.doc_id AND g.cls = p.cls),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS rn FROM r)
    SELECT doc_id, lang AS label, cls AS prediction, round(score, 3) AS score FROM b WHERE rn = 1"""
)


@query("nb_predict", NB_PREDICT_SQL)
def nb_predict(spark, folder):
    docs = documents(spark, folder, "lang")
    terms = via_table(textmodel.term_frequency(docs, keep=("lang",)), "terms")
    scores = textmodel.nb_scores(textmodel.nb_fit(docs, terms, "lang"), terms.drop("lang"), docs)
    return textmodel.nb_predict(scores).join(docs.select("doc_id", F.col("lang").alias("label")), "doc_id").select(
        "doc_id", "label", "prediction", F.round("score", 3).alias("score")
    )


@query("nb_hashed")
def nb_hashed(spark, folder):
    """Fixed-width classifier: accuracy per language on the held-out third of the folds."""
    docs = stratified_folds(documents(spark, folder, "lang"), "lang", "doc_id", 3)
    listed = docs.select("doc_id", "lang", "fold", text.letter_words(F.col("text")).alias("tokens"))
    model = textmodel.hashed_classifier("lang", features=1 << 20).fit(listed.filter(F.col("fold") != 0))
    scored = model.transform(listed.filter(F.col("fold") == 0))
    return scored.groupBy("lang").agg(
        F.count("*").alias("n"), F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy")
    )


# --- sentiment -------------------------------------------------------------------

LEXICON_SQL = r"""labelled AS (SELECT d.doc_id, text, quality FROM documents d JOIN labels USING (doc_id)),
seen AS (SELECT DISTINCT doc_id, quality, unnest(regexp_extract_all(lower(text), '\p{L}{3,}')) AS token FROM labelled),
lexicon AS (SELECT token, CASE WHEN sum(quality) / count(*) >= 0.95 THEN 1 WHEN sum(quality) / count(*) <= 0.8 THEN -1 END AS polarity
  FROM seen GROUP BY 1 HAVING count(*) >= 5 AND (sum(quality) / count(*) >= 0.95 OR sum(quality) / count(*) <= 0.8))"""


def lexicon(spark, folder):
    labelled = documents(spark, folder).join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    return textmodel.learned_lexicon(labelled)


@query("lexicon", f"WITH {LEXICON_SQL} SELECT token, polarity FROM lexicon")
def lexicon_query(spark, folder):
    return lexicon(spark, folder)


@query(
    "sentiment_select",
    f"""WITH {LEXICON_SQL},
    parts AS (SELECT conv_id, turn, list_filter(list_transform(regexp_split_to_array(text, '[.!?\\n]+'), lambda s: trim(s)),
      lambda s: s != '') AS ss FROM conversations),
    s AS (SELECT conv_id, turn, unnest(ss) AS sentence, unnest(range(0, len(ss))) AS pos FROM parts),
    w AS (SELECT conv_id, turn, pos, unnest(regexp_extract_all(lower(sentence), '\\p{{L}}{{3,}}')) AS token FROM s),
    p AS (SELECT conv_id, turn, pos, sum(polarity) AS pol FROM w JOIN lexicon USING (token) GROUP BY 1, 2, 3),
    c AS (SELECT s.conv_id, s.turn, s.pos, length(sentence) AS len,
      CAST(greatest(0, least(4, 2 + coalesce(pol, 0))) AS INT) AS score FROM s LEFT JOIN p USING (conv_id, turn, pos)),
    b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY len DESC, pos) AS rn FROM c),
    r AS (SELECT v.conv_id, v.turn, coalesce(b.score, 0) AS score, b.score IS NULL AS is_empty
      FROM conversations v LEFT JOIN b ON b.conv_id = v.conv_id AND b.turn = v.turn AND rn = 1)
    SELECT conv_id, turn, score, is_empty, 'sentiment : ' || (['very negative', 'negative', 'neutral', 'positive', 'very positive'])[score + 1] AS css,
      CAST(score + 1 AS DOUBLE) AS rating FROM r""",
)
def sentiment_select(spark, folder):
    talks = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return textmodel.document_sentiment(talks, ["conv_id", "turn"], lexicon(spark, folder))
