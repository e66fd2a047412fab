"""Classifier queries: the language of a document from its letter shares."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import scalar
from tidemark.operators import evaluate
from tidemark.operators.relational import stratified_folds
from tidemark.plans import classify, cluster, discretize, pruning
from tidemark.session import shared_path, via_table
from tidemark.sources.tables import descriptors, documents, table

WIDTH = len(classify.LETTERS)


def shares(spark, folder):
    """(doc_id, lang, vec), computed once from the whole texts."""
    docs = documents(spark, folder, "lang")
    return via_table(classify.with_letter_shares(docs), "letter-shares")


def prepared(spark, folder):
    rows = shares(spark, folder)
    classes = classify.class_list(rows, "lang")
    split = scalar.random_split_name(F.col("doc_id"), {"train": 0.7, "test": 0.3})
    return classify.labelled(rows, "lang", classes).withColumn("split", split), classes


def parts(rows):
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")


SHARES_SQL = f"""WITH l AS (SELECT unnest(range(0, {WIDTH})) AS i, unnest(string_split('{classify.LETTERS}', '')) AS c),
n AS (SELECT doc_id, lang, i, length(lower(text)) - length(replace(lower(text), c, '')) AS n FROM documents, l),
s AS (SELECT doc_id, lang, i, n / greatest(sum(n) OVER (PARTITION BY doc_id), 1) AS x FROM n)"""


@query(
    "gaussian_nb",
    SHARES_SQL
    + " SELECT lang, CAST(i AS INT) AS i, round(avg(x), 8) AS mean, round(var_pop(x), 8) AS variance FROM s GROUP BY ALL",
)
def gaussian_nb(spark, folder):
    docs = documents(spark, folder, "lang")
    learned = classify.gaussian_parameters(classify.with_letter_shares(docs), "lang")
    return learned.withColumns({"mean": F.round("mean", 8), "variance": F.round("variance", 8)})


@query(
    "cv_folds",
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 13 > 0 THEN lang END AS lang FROM documents),
    r AS (SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang
      ORDER BY ((doc_id % 1000003) * 7919) % 1000003, doc_id) - 1) % 4 AS fold FROM d) SELECT lang, fold, count(*) AS n, min(doc_id) AS first_doc, CAST(sum(doc_id) AS BIGINT) AS doc_sum FROM r GROUP BY 1, 2""",
)
def cv_folds(spark, folder):
    """Even folds per language; documents without a label are a group of their own."""
    labelled = F.when(F.col("doc_id") % 13 > 0, F.col("lang"))
    docs = table(spark, folder, "documents").select("doc_id", labelled.alias("lang"))
    return stratified_folds(docs, "lang", "doc_id", 4).groupBy("lang", "fold").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("doc_sum")
    )


@query("cv_report")
def cv_report(spark, folder):
    """Rates per class over the pooled held-out folds, Gaussian and discretised naive Bayes beside each other."""
    rows, classes = prepared(spark, folder)
    dealt = via_table(stratified_folds(rows, "lang", "doc_id", 4), "folds")
    pooled = classify.pooled_folds(
        dealt, 4, {"gaussian": lambda train: classify.gaussian_bayes().fit(train), "discretized": classify.discretized_bayes}
    )
    reports = [
        evaluate.class_report(pooled.filter(F.col("model") == m)).withColumn("model", F.lit(m))
        for m in ("gaussian", "discretized")
    ]
    return reports[0].unionByName(reports[1]).withColumn("cls", scalar.category_name(F.col("cls"), classes))


@query("cv_confusion")
def cv_confusion(spark, folder):
    """Pooled confusion counts of the 4-fold cross validation."""
    rows, _ = prepared(spark, folder)
    dealt = via_table(stratified_folds(rows, "lang", "doc_id", 4), "folds")
    pooled = classify.pooled_folds(dealt, 4, {"gaussian": lambda train: classify.gaussian_bayes().fit(train)})
    return evaluate.confusion_counts(pooled)


@query("tree_classify")
def tree_classify(spark, folder):
    rows, _ = prepared(spark, folder)
    train, test = parts(rows)
    scored = classify.discretized_tree(train).transform(test)
    return evaluate.confusion_counts(scored.select("label", "prediction"))


@query("tree_pruned")
def tree_pruned(spark, folder):
    """The tree over supervised cuts, pruned: confusion counts of the held-out rows, and leaves before and after."""
    rows, classes = prepared(spark, folder)
    train, test = parts(rows)
    cuts = discretize.supervised_cuts(train, len(classes), WIDTH)
    grown = classify.Discretized(cuts, max(map(len, cuts)) + 1, hot=False)
    tree = DecisionTreeClassifier(impurity="entropy", maxDepth=12, seed=1).fit(grown.prepare(train))
    grown.model = tree
    small = pruning.prune(grown, tree, train, len(classes))
    counts = evaluate.confusion_counts(small.transform(test).select("label", "prediction"))
    return counts.withColumns({"leaves": F.lit(len(small.answers)), "pruned_leaves": F.lit(small.leaves)})


@query("rf_grid")
def rf_grid(spark, folder):
    """All trials with error and confusion counts; the best one's parameters are fitted again and tested."""
    rows, _ = prepared(spark, folder)
    train, test = parts(rows)
    trials, best = classify.forest_grid(train, test)
    again = classify.forest(*best).fit(train).transform(test)
    return trials.withColumn("best_error", F.lit(evaluate.error_rate(again).first()["error_rate"]))


@query("rf_score")
def rf_score(spark, folder):
    """Language guessed for the held-out documents by a forest trained on the training split."""
    rows, classes = prepared(spark, folder)
    train, test = parts(rows)
    name = scalar.category_name(F.col("prediction"), classes)
    return classify.forest().fit(train).transform(test).select("doc_id", "lang", name.alias("predicted_lang"))


@query("rf_evaluate")
def rf_evaluate(spark, folder):
    rows, classes = prepared(spark, folder)
    train, test = parts(rows)
    scored = classify.forest().fit(train).transform(test)
    named = scored.select(
        F.col("lang").alias("label"), scalar.category_name(F.col("prediction"), classes).alias("prediction")
    )
    accuracy = evaluate.error_rate(named).first()["accuracy"]
    return evaluate.confusion_matrix(named, classes).withColumn("accuracy", F.lit(accuracy))


@query("model_roundtrip", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM documents")
def model_roundtrip(spark, folder):
    """A saved and re-loaded model scores every row as the fitted one does."""
    rows, _ = prepared(spark, folder)
    model = Pipeline(stages=[classify.forest()]).fit(rows)
    path = shared_path(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first = model.transform(rows).select("doc_id", F.col("prediction").alias("a"))
    second = again.transform(rows).select("doc_id", F.col("prediction").alias("b"))
    different = F.sum((F.col("a") != F.col("b")).cast("bigint"))
    return first.join(second, "doc_id").agg(F.count("*").alias("n_rows"), different.alias("n_different"))


CODEBOOK = 400


@query("image_forest")
def image_forest(spark, folder):
    """Images from descriptors to classes: codebook and forest from training images, score of the held-out ones."""
    tagged = descriptors(spark, folder).withColumn(
        "split", scalar.random_split_name(F.col("image_id"), {"train": 0.7, "test": 0.3})
    )
    rows = via_table(tagged, "descriptors")
    fitted = cluster.fit_kmeans(rows.filter(F.col("split") == "train").select("vec"), CODEBOOK)
    codebook = [list(map(float, c)) for c in fitted.clusterCenters()]
    counts = rows.groupBy("image_id", "split", "label").agg(F.count("*").alias("n"))
    labels = counts.groupBy("image_id", "split").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"))
    images = cluster.features(cluster.histogram_vectors(rows, codebook).join(labels, "image_id"))
    train, test = parts(via_table(images.withColumn("label", F.col("label").cast("double")), "histograms"))
    return classify.forest().fit(train).transform(test).select("image_id", "label", "prediction")
