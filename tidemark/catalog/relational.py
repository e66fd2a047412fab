"""Ratings, rankings, joins, friend graph, and running state on the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import scalar, sqlnames
from tidemark.functions.text import path_id, path_label
from tidemark.operators import counted, evaluate, graph, ordered, relational, sketches
from tidemark.session import via_table
from tidemark.sources.tables import POSTS_SQL, RATINGS_SQL, friend_links, posts, rating_value, ratings, table

# --- ratings and their split ------------------------------------------------


@query(
    "rating_profile",
    f"WITH {RATINGS_SQL} SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, "
    "count(DISTINCT item_id) AS n_items FROM ratings",
)
def rating_profile(spark, folder):
    return evaluate.rating_profile(ratings(spark, folder))


SPLIT_SQL = "CASE WHEN digit < 6 THEN 'train' WHEN digit < 8 THEN 'validation' ELSE 'test' END"


@query(
    "rating_split",
    f"""WITH {RATINGS_SQL} SELECT {SPLIT_SQL} AS split, count(*) AS n, count(DISTINCT (user_id, item_id)) AS n_pairs,
    CAST(sum(rating) AS DOUBLE) AS rating_sum FROM ratings GROUP BY 1""",
)
def rating_split(spark, folder):
    tagged = ratings(spark, folder).withColumn("split", scalar.digit_split_name(F.col("digit")))
    return (
        tagged.groupBy("split", "user_id", "item_id")
        .agg(F.count("*").alias("_n"), F.sum("rating").alias("_s"))
        .groupBy("split")
        .agg(F.sum("_n").alias("n"), F.count("*").alias("n_pairs"), F.sum("_s").alias("rating_sum"))
    )


@query(
    "random_split",
    """SELECT CASE WHEN ((o_orderkey % 1000003) * 7919) % 1000003 % 100 < 70 THEN 'train' ELSE 'test' END AS split,
    count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1""",
)
def random_split(spark, folder):
    orders = table(spark, folder, "orders")
    return (
        orders.withColumn("split", scalar.random_split_name(F.col("o_orderkey"), {"train": 0.7, "test": 0.3}))
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    )


@query(
    "train_union",
    f"""WITH {RATINGS_SQL}, all_rows AS (
      SELECT user_id, item_id, rating FROM ratings WHERE digit < 6
      UNION ALL SELECT user_id, item_id, rating FROM ratings WHERE user_id = 0)
    SELECT user_id, count(*) AS n, sum(rating) AS rating_sum FROM all_rows GROUP BY 1""",
)
def train_union(spark, folder):
    rows = ratings(spark, folder)
    train = rows.filter(F.col("digit") < 6).select("user_id", "item_id", "rating")
    personal = rows.filter(F.col("user_id") == 0).select("user_id", "item_id", "rating")
    return train.unionByName(personal).groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum("rating").alias("rating_sum")
    )


# --- predictions beside ratings ----------------------------------------------


def item_mean_predictions(rows):
    """Each rated pair outside the training split with the item's training mean; unknown items drop out."""
    means = rows.filter(F.col("digit") < 6).groupBy("item_id").agg(F.avg("rating").alias("prediction"))
    pairs = rows.filter(F.col("digit") >= 6).select("user_id", "item_id").distinct()
    return pairs.join(means, "item_id")


PREDICTED_SQL = f"""WITH {RATINGS_SQL},
means AS (SELECT item_id, avg(rating) AS prediction FROM ratings WHERE digit < 6 GROUP BY 1),
predictions AS (SELECT user_id, item_id, prediction
  FROM (SELECT DISTINCT user_id, item_id FROM ratings WHERE digit >= 6) JOIN means USING (item_id)),
test AS (SELECT * FROM ratings WHERE digit >= 6),
joined AS (SELECT user_id, item_id, rating, prediction FROM test JOIN predictions USING (user_id, item_id))"""


def joined_ratings(spark, folder):
    """The large join once, as a table that all branches of a query read."""
    return via_table(ratings(spark, folder), "ratings")


def held_out(rows):
    return rows.filter(F.col("digit") >= 6)


@query("rating_pred_join", PREDICTED_SQL + " SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM joined")
def rating_pred_join(spark, folder):
    rows = joined_ratings(spark, folder)
    joined = held_out(rows).join(item_mean_predictions(rows), ["user_id", "item_id"])
    return joined.select("user_id", "item_id", "rating", F.round("prediction", 6).alias("prediction"))


@query("mse", PREDICTED_SQL + " SELECT count(*) AS n_pairs, round(avg(pow(rating - prediction, 2)), 6) AS mse FROM joined")
def mse(spark, folder):
    rows = joined_ratings(spark, folder)
    result = evaluate.mse(held_out(rows), item_mean_predictions(rows))
    return result.select("n_pairs", F.round("mse", 6).alias("mse"))


@query(
    "rmse_fixed_n",
    PREDICTED_SQL
    + """ SELECT (SELECT count(*) FROM test) AS n_rows, count(*) AS n_pairs,
    round(sqrt(sum(pow(rating - prediction, 2)) / (SELECT count(*) FROM test)), 6) AS rmse FROM joined""",
)
def rmse_fixed_n(spark, folder):
    rows = joined_ratings(spark, folder)
    result = evaluate.rmse_over(held_out(rows), item_mean_predictions(rows))
    return result.select("n_rows", "n_pairs", F.round("rmse", 6).alias("rmse"))


@query(
    "baseline_rmse",
    PREDICTED_SQL
    + """, mean AS (SELECT avg(rating) AS m FROM ratings WHERE digit < 6),
    e AS (SELECT (SELECT sqrt(avg(pow(rating - m, 2))) FROM test, mean) AS b,
                 (SELECT sqrt(sum(pow(rating - prediction, 2)) / (SELECT count(*) FROM test)) FROM joined) AS r)
    SELECT round(b, 6) AS baseline_rmse, round(r, 6) AS model_rmse, round((b - r) / b * 100, 4) AS improvement FROM e""",
)
def baseline_rmse(spark, folder):
    rows = joined_ratings(spark, folder)
    test = held_out(rows)
    model = evaluate.rmse_over(test, item_mean_predictions(rows)).select("rmse").scalar()
    result = evaluate.baseline(rows.filter(F.col("digit") < 6), test, model)
    return result.select(
        F.round("baseline_rmse", 6).alias("baseline_rmse"),
        F.round("model_rmse", 6).alias("model_rmse"),
        F.round("improvement", 4).alias("improvement"),
    )


@query(
    "best_trial",
    """WITH t AS (SELECT CAST(l_linenumber AS BIGINT) AS trial, avg(pow(l_discount - 0.05, 2)) AS error
      FROM lineitem GROUP BY 1)
    SELECT trial, round(error, 8) AS error FROM t ORDER BY t.error, trial LIMIT 1""",
)
def best_trial(spark, folder):
    gap = F.col("l_discount") - 0.05
    trials = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_linenumber").cast("bigint").alias("trial"))
        .agg(F.avg(gap * gap).alias("error"))
    )
    return relational.best_trial(trials, "error", "trial").select("trial", F.round("error", 8).alias("error"))


# --- class predictions --------------------------------------------------------

CLASSES = ["A", "N", "R"]


def scored_lines(spark, folder):
    """Return flags beside a rule that guesses them from the quantity."""
    guess = F.when(F.col("l_quantity") < 17, "A").when(F.col("l_quantity") < 34, "N").otherwise("R")
    return table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


SCORED_SQL = """WITH scored AS (SELECT l_returnflag AS label,
  CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS prediction FROM lineitem)"""


@query(
    "error_rate",
    SCORED_SQL
    + """ SELECT count(*) AS n_rows, CAST(sum(CAST(label != prediction AS INT)) AS BIGINT) AS n_wrong,
    round(avg(CAST(label != prediction AS INT)), 6) AS error_rate,
    round(1 - avg(CAST(label != prediction AS INT)), 6) AS accuracy FROM scored""",
)
def error_rate(spark, folder):
    return evaluate.error_rate(scored_lines(spark, folder)).select(
        "n_rows", "n_wrong", F.round("error_rate", 6).alias("error_rate"), F.round("accuracy", 6).alias("accuracy")
    )


@query(
    "confusion_matrix",
    SCORED_SQL
    + """ SELECT label, count(*) FILTER (prediction = 'A') AS A, count(*) FILTER (prediction = 'N') AS N,
    count(*) FILTER (prediction = 'R') AS R FROM scored GROUP BY 1""",
)
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(scored_lines(spark, folder), CLASSES)


@query("overall_f", SCORED_SQL + " SELECT round(avg(CAST(label = prediction AS INT)), 6) AS f_measure FROM scored")
def overall_f(spark, folder):
    """The overall F-measure of a single-label classifier equals its accuracy."""
    return evaluate.error_rate(scored_lines(spark, folder)).select(F.round("accuracy", 6).alias("f_measure"))


@query(
    "class_report",
    SCORED_SQL
    + """, c AS (SELECT unnest(['A', 'N', 'R']) AS cls),
    s AS (SELECT cls, count(*) FILTER (label = cls) AS actual, count(*) FILTER (prediction = cls) AS predicted,
      count(*) FILTER (label = cls AND prediction = cls) AS hit, count(*) AS total FROM scored, c GROUP BY 1)
    SELECT cls, round(hit / actual, 6) AS tp_rate, round((predicted - hit) / (total - actual), 6) AS fp_rate,
      round(hit / predicted, 6) AS precision, round(hit / actual, 6) AS recall,
      round(2 * hit / (actual + predicted), 6) AS f_measure FROM s""",
)
def class_report(spark, folder):
    report = evaluate.class_report(scored_lines(spark, folder))
    return report.select("cls", *[F.round(c, 6).alias(c) for c in report.columns if c != "cls"])


@query(
    "roc_area",
    """WITH s AS (SELECT l_quantity AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
    g AS (SELECT score, sum(y) AS p, sum(1 - y) AS n FROM s GROUP BY 1),
    w AS (SELECT p, n, sum(n) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - n / 2 AS below FROM g)
    SELECT round(CAST(sum(p * below) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)), 6) AS roc_area FROM w""",
)
def roc_area(spark, folder):
    scored = table(spark, folder, "lineitem").select(
        "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    area = evaluate.roc_area(scored, "returned", "l_quantity")
    return area.select(F.round("roc_area", 6).alias("roc_area"))


# --- joins, rankings and sets ---------------------------------------------------


@query(
    "broadcast_lookup",
    """SELECT n_name, r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def broadcast_lookup(spark, folder):
    balances = (
        table(spark, folder, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count("*").alias("n_customers"), F.sum("c_acctbal").alias("balance"))
    )
    nations = table(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    named = relational.lookup(balances, nations, "n_nationkey", "inner")
    named = relational.lookup(named, table(spark, folder, "region"), "r_regionkey", "inner")
    return named.select("n_name", "r_name", "n_customers", F.round("balance", 2).alias("balance"))


@query(
    "topn_titles",
    f"""WITH {RATINGS_SQL}, s AS (SELECT item_id, count(*) AS n, sum(rating) / count(*) AS score FROM ratings GROUP BY 1)
    SELECT row_number() OVER (ORDER BY score DESC, n DESC, item_id) AS rank, item_id, p_name AS title,
      round(score, 6) AS score FROM (SELECT * FROM s ORDER BY s.score DESC, n DESC, item_id LIMIT 50)
    LEFT JOIN part ON p_partkey = item_id""",
)
def topn_titles(spark, folder):
    """The 50 best rated items with rank and title; titles are looked up for those 50 only."""
    scores = (
        ratings(spark, folder)
        .groupBy("item_id")
        .agg(F.count("*").alias("n"), (F.sum("rating") / F.count("*")).alias("score"))
    )
    best = relational.top_rows(scores, [F.col("score").desc(), F.col("n").desc(), F.col("item_id")], 50)
    top = via_table(best, "top-items")
    titles = table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    # Both broadcasts hold at most 50 rows; the titles are filtered where they are scanned.
    needed = titles.join(F.broadcast(top.select("item_id")), "item_id", "left_semi")
    named = top.join(F.broadcast(needed), "item_id", "left")
    return named.select("rank", "item_id", "title", F.round("score", 6).alias("score"))


@query("user_items", f"WITH {RATINGS_SQL} SELECT item_id, rating FROM ratings WHERE user_id = 1")
def user_items(spark, folder):
    return ratings(spark, folder).filter(F.col("user_id") == 1).select("item_id", "rating")


@query(
    "unrated_items",
    f"""WITH {RATINGS_SQL} SELECT p_partkey AS item_id, p_name AS title FROM part
    WHERE p_partkey NOT IN (SELECT item_id FROM ratings WHERE user_id = 1)""",
)
def unrated_items(spark, folder):
    items = table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return relational.not_rated(items, ratings(spark, folder).filter(F.col("user_id") == 1), "item_id")


@query(
    "liked_category_matches",
    f"""WITH {RATINGS_SQL}, r AS (SELECT p_type AS tag, count(*) AS n FROM ratings JOIN part ON p_partkey = item_id
      WHERE rating = 5 GROUP BY 1), p AS (SELECT p_type AS tag, count(*) AS n FROM part GROUP BY 1)
    SELECT tag, r.n * p.n AS n_matches FROM r JOIN p USING (tag)""",
)
def liked_category_matches(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_type").alias("tag"))
    liked = ratings(spark, folder).filter(F.col("rating") == 5).groupBy("item_id").agg(F.count("*").alias("n"))
    tags = liked.join(parts, "item_id").groupBy("tag").agg(F.sum("n").alias("n_recommended"))
    predicted = parts.groupBy("tag").agg(F.count("*").alias("n_predicted"))
    return tags.join(predicted, "tag").select("tag", (F.col("n_recommended") * F.col("n_predicted")).alias("n_matches"))


@query(
    "aligned_zip",
    """WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS position FROM customer),
    o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders)
    SELECT position, c_custkey, o_orderkey FROM c JOIN o USING (position)""",
)
def aligned_zip(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    orders = table(spark, folder, "orders").select("o_orderkey")
    return relational.zipped(customers, orders, "c_custkey", "o_orderkey")


@query(
    "cross_catalog",
    """WITH i AS (SELECT DISTINCT p_type AS item FROM part), b AS (SELECT DISTINCT p_brand AS brand FROM part)
    SELECT row_number() OVER (ORDER BY brand, item) AS seq, item, brand FROM i, b""",
)
def cross_catalog(spark, folder):
    parts = table(spark, folder, "part")
    return relational.catalog_product(
        parts.select(F.col("p_type").alias("item")), parts.select(F.col("p_brand").alias("brand")), "item", "brand"
    )


@query(
    "top_item_brand",
    """SELECT p_type AS item, p_brand AS brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2 ORDER BY n DESC, item, brand LIMIT 1""",
)
def top_item_brand(spark, folder):
    sold = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("_n"))
    counts = (
        sold.join(table(spark, folder, "part"), "p_partkey")
        .groupBy(F.col("p_type").alias("item"), F.col("p_brand").alias("brand"))
        .agg(F.sum("_n").alias("n"))
    )
    return counts.orderBy(F.col("n").desc(), "item", "brand").limit(1)


@query(
    "label_map",
    """SELECT lang AS label, row_number() OVER (ORDER BY lang) - 1 AS label_index
    FROM (SELECT DISTINCT lang FROM documents)""",
)
def label_map(spark, folder):
    """0-based numbers for the distinct labels, in alphabetical order."""
    from pyspark.sql import Window

    labels = table(spark, folder, "documents").select(F.col("lang").alias("label")).distinct()
    return labels.withColumn("label_index", (F.row_number().over(Window.orderBy("label")) - 1).cast("bigint"))


# --- friends ----------------------------------------------------------------------


@query(
    "mutual_friends",
    """WITH p AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS u1, greatest(l_partkey, l_suppkey) AS u2
      FROM lineitem WHERE l_partkey != l_suppkey),
    d AS (SELECT u1 AS u, u2 AS f FROM p UNION ALL SELECT u2, u1 FROM p),
    m AS (SELECT p.u1, p.u2, count(*) AS n, min(a.f) AS lo, max(a.f) AS hi, CAST(sum(a.f) AS BIGINT) AS s
      FROM p JOIN d a ON a.u = p.u1 JOIN d b ON b.u = p.u2 AND a.f = b.f GROUP BY 1, 2)
    SELECT u1, u2, coalesce(n, 0) AS n_mutual, lo AS first_friend, hi AS last_friend, coalesce(s, 0) AS friend_sum
    FROM p LEFT JOIN m USING (u1, u2)""",
)
def mutual_friends(spark, folder):
    return graph.mutual_friend_counts(friend_links(spark, folder))


# --- state along time ----------------------------------------------------------------


@query(
    "running_sum",
    """WITH e AS (SELECT event_id, nullif(user_id % 7, 0) AS user_id, value,
      CASE WHEN event_id % 11 > 0 THEN ts END AS ts FROM events)
    SELECT event_id, user_id, CAST(sum(CAST(trunc(value) AS INT)) OVER (PARTITION BY user_id
      ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM e""",
)
def running_sum(spark, folder):
    """Seven long timelines, one of them of events without a user; some events have no time."""
    user = F.nullif(F.col("user_id") % 7, F.lit(0))
    timed = F.when(F.col("event_id") % 11 > 0, F.col("ts"))
    events = table(spark, folder, "events").select("event_id", user.alias("user_id"), timed.alias("ts"), "value")
    whole = F.col("value").cast("int").cast("bigint")
    out = ordered.running_sum(events, ["user_id"], ["ts", "event_id"], whole, "running")
    return out.select("event_id", "user_id", "running")


@query(
    "asof_running_state",
    """WITH s AS (SELECT event_id, user_id, event_type, value,
      CAST(sum(CASE WHEN event_type = 'view' THEN CAST(trunc(value) AS INT) ELSE 0 END) OVER w AS BIGINT) AS turned,
      last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w AS last_click
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
    SELECT event_id, user_id, value, turned, last_click FROM s WHERE event_type = 'purchase'""",
)
def asof_running_state(spark, folder):
    """Every purchase with the state its user had reached: turned so far, and the latest click."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    turn = F.when(F.col("event_type") == "view", F.col("value").cast("int")).otherwise(0).cast("bigint")
    click = F.when(F.col("event_type") == "click", F.col("value"))
    state = ordered.running(events, ["user_id"], ["ts", "event_id"], sums={"turned": turn}, lasts={"last_click": click})
    return state.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "value", "turned", "last_click"
    )


@query(
    "event_demux",
    """SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN value END AS click,
    CASE WHEN event_type = 'error' THEN value END AS error, CASE WHEN event_type = 'purchase' THEN value END AS purchase,
    CASE WHEN event_type = 'signup' THEN value END AS signup, CASE WHEN event_type = 'view' THEN value END AS view
    FROM events""",
)
def event_demux(spark, folder):
    events = table(spark, folder, "events")
    kinds = ["click", "error", "purchase", "signup", "view"]
    return events.select(
        "event_id", "user_id", *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds]
    )


# --- scalar expressions ------------------------------------------------------------


@query(
    "category_index",
    """SELECT p_partkey, CAST(coalesce(list_position(['ECONOMY', 'MEDIUM', 'PROMO', 'SMALL'], p_type), 0) - 1 AS BIGINT)
    AS type_index FROM part""",
)
def category_index(spark, folder):
    index = scalar.category_index(F.col("p_type"), ["ECONOMY", "MEDIUM", "PROMO", "SMALL"])
    return table(spark, folder, "part").select("p_partkey", index.alias("type_index"))


@query(
    "category_name",
    "SELECT c_custkey, (['AFRICA', 'AMERICA', 'ASIA', 'EUROPE'])[c_nationkey % 5 + 1] AS category FROM customer",
)
def category_name(spark, folder):
    name = scalar.category_name(F.col("c_nationkey") % 5, ["AFRICA", "AMERICA", "ASIA", "EUROPE"])
    return table(spark, folder, "customer").select("c_custkey", name.alias("category"))


@query(
    "drop_first_column",
    "SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def drop_first_column(spark, folder):
    customers = table(spark, folder, "customer")
    return customers.drop(customers.columns[0])


@query(
    "grid_snap",
    """SELECT CAST(trunc(c_acctbal / 100) AS INT) AS cell_x, CAST(c_nationkey AS INT) AS cell_y, count(*) AS n
    FROM customer GROUP BY 1, 2""",
)
def grid_snap(spark, folder):
    """Positions truncated to whole numbers."""
    cell = (F.col("c_acctbal") / 100).cast("int")
    return (
        table(spark, folder, "customer")
        .groupBy(cell.alias("cell_x"), F.col("c_nationkey").cast("int").alias("cell_y"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "json_threshold_label",
    """SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 50 THEN 'positive'
    ELSE 'negative' END AS label FROM events""",
)
def json_threshold_label(spark, folder):
    reached = scalar.json_threshold(F.col("props"), "$.k", 50.0)
    return table(spark, folder, "events").select(
        "event_id", F.when(reached, "positive").otherwise("negative").alias("label")
    )


@query(
    "sentiment_map",
    """WITH s AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) % 7 - 1 AS score FROM events)
    SELECT event_id, score, CASE score WHEN 0 THEN 'sentiment : very negative' WHEN 1 THEN 'sentiment : negative'
      WHEN 2 THEN 'sentiment : neutral' WHEN 3 THEN 'sentiment : positive' WHEN 4 THEN 'sentiment : very positive'
      ELSE '' END AS css, CAST(CASE WHEN score BETWEEN 0 AND 4 THEN score + 1 ELSE 0 END AS DOUBLE) AS rating,
      CASE WHEN score IN (0, 1, 3, 4) THEN score ELSE -1 END AS decided FROM s""",
)
def sentiment_map(spark, folder):
    score = F.get_json_object("props", "$.k").cast("int") % 7 - 1
    return table(spark, folder, "events").select("event_id", score.alias("score")).select(
        "event_id",
        "score",
        scalar.sentiment_css(F.col("score")).alias("css"),
        scalar.sentiment_rating(F.col("score")).alias("rating"),
        scalar.decided_sentiment(F.col("score")).alias("decided"),
    )


@query("clock_format", "SELECT strftime(ts, '%H:%M') AS clock, count(*) AS n FROM events GROUP BY 1")
def clock_format(spark, folder):
    clock = F.date_format("ts", "HH:mm")
    return table(spark, folder, "events").groupBy(clock.alias("clock")).agg(F.count("*").alias("n"))


@query(
    "path_label",
    """SELECT page_id, string_split(url, '/')[-2] AS label, string_split(url, '/')[-1] AS id FROM pages""",
)
def path_label_query(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", path_label(F.col("url")).alias("label"), path_id(F.col("url")).alias("id"))


@query(
    "user_letter_id",
    """WITH s AS (SELECT supp, lower(substr(regexp_replace(supp, '[^a-zA-Z]', '', 'g'), 1, 1)) AS c
      FROM (SELECT p_name AS supp FROM part UNION ALL SELECT p_brand FROM part UNION ALL SELECT CAST(p_size AS VARCHAR) FROM part))
    SELECT CASE WHEN c != '' THEN ascii(c) - 96 END AS user_id, count(*) AS n FROM s GROUP BY 1""",
)
def user_letter_id(spark, folder):
    """Number of the first letter; names without letters count under null."""
    from tidemark.functions.text import letter_number

    parts = table(spark, folder, "part")
    names = parts.select(F.explode(F.array("p_name", "p_brand", F.col("p_size").cast("string"))).alias("name"))
    return names.groupBy(letter_number(F.col("name")).alias("user_id")).agg(F.count("*").alias("n"))


@query(
    "distinct_sketches",
    """SELECT year(o_orderdate) AS year, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, true AS within
    FROM orders GROUP BY 1""",
)
def distinct_sketches(spark, folder):
    """Customers per year from sketches stored per day, within four standard errors of the exact number."""
    orders = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    days = via_table(sketches.distinct_sketches(orders, ["day"], ["o_custkey"]), "daily-sketches")
    merged = sketches.union(days, [F.year("day").alias("year")], ["o_custkey"])
    estimated = sketches.estimates(merged, ["o_custkey"])
    exact = orders.groupBy(F.year("day").alias("year")).agg(F.count_distinct("o_custkey").alias("n_customers"))
    off = F.abs(F.col("o_custkey") - F.col("n_customers"))
    within = off <= F.greatest(F.lit(1.0), 4 * sketches.standard_error() * F.col("n_customers"))
    return estimated.join(exact, "year").select(F.col("year").cast("bigint").alias("year"), F.col("n_rows").alias("n_orders"), "n_customers", within.alias("within"))


@query(
    "dropped_counts",
    r"""WITH n AS (SELECT unnest([p_name, p_brand, CAST(p_size AS VARCHAR)]) AS name FROM part),
    v AS (SELECT len(list_filter(embedding, lambda x: x > 0.35)) AS k FROM embeddings)
    SELECT (SELECT count(*) FROM n) AS captions, (SELECT count(*) FROM n WHERE NOT regexp_matches(name, '[a-zA-Z]')) AS captions_dropped,
      (SELECT count(*) FROM v) AS images, (SELECT count(*) FROM v WHERE k = 0) AS images_dropped""",
)
def dropped_counts(spark, folder):
    """Captions without a letter in their user's name and images without descriptors, counted while the rest is written."""
    names = table(spark, folder, "part").select(F.explode(F.array("p_name", "p_brand", F.col("p_size").cast("string"))).alias("username"))
    vectors = table(spark, folder, "embeddings").select(F.filter("embedding", lambda x: x > 0.35).alias("vec"))
    captions, of_captions = counted.user_numbers(names)
    images, of_images = counted.described(vectors)
    via_table(captions, "captions")
    via_table(images, "images")
    row = [of_captions.get["rows"], of_captions.get["dropped"], of_images.get["rows"], of_images.get["dropped"]]
    return spark.createDataFrame([row], "captions long, captions_dropped long, images long, images_dropped long")


@query(
    "sql_functions",
    rf"""WITH {POSTS_SQL}, t AS (SELECT event_id, unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) - 1 AS position FROM posts)
    SELECT CAST(position AS INT) AS position, regexp_matches(token, '^\p{{L}}+$') AS word, regexp_replace(token, '[^a-zA-Z]', '', 'g') AS letters, count(*) AS n
    FROM t GROUP BY ALL""",
)
def sql_functions(spark, folder):
    """Tokens with their places and named functions, all called from SQL."""
    sqlnames.register(spark)
    posts(spark, folder).createOrReplaceTempView("posts_for_sql")
    return spark.sql(
        """SELECT position, is_word(token) AS word, letters_of(token) AS letters, count(*) AS n
        FROM posts_for_sql, LATERAL words_of(text) GROUP BY ALL"""
    )
