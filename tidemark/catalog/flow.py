"""From captions to recommendations: sentiment ratings, factors, and the classes predicted for images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.classes import image_forest
from tidemark.catalog.registry import query
from tidemark.catalog.text import lexicon
from tidemark.functions.scalar import category_name
from tidemark.functions.text import letter_number
from tidemark.operators import relational
from tidemark.plans import recommend, textmodel
from tidemark.session import via_table
from tidemark.sources.tables import table

# Names of the image classes, which captions carry as tags (numbered from 1 there, from 0 as classes).
TAGS = ["bag", "boot", "coat", "dress", "pullover", "sandal", "shirt", "sneaker", "top", "trouser"]


def caption_ratings(captions: DataFrame, key: list[str], polarity: DataFrame) -> DataFrame:
    """(user_id, item_id, rating) of every caption: the user's letter, the tag, and the sentiment of the caption.

    `captions` is (key, username, caption, tag_id). Captions whose user has no letter have no user and drop out; an
    empty caption rates 1.
    """
    rated = textmodel.document_sentiment(captions.select(*key, "caption"), key, polarity, "caption").select(*key, "rating")
    users = captions.select(*key, letter_number(F.col("username")).cast("long").alias("user_id"), F.col("tag_id").cast("long").alias("item_id"))
    return users.where("user_id IS NOT NULL").join(rated, key).select("user_id", "item_id", "rating")


def recommended_tags(ratings: DataFrame, user: int, names: list[str]) -> DataFrame:
    """(tag, score): a row for every rating of the user, as the fitted factors score its tag."""
    model = recommend.fit_als(recommend.one_per_pair(ratings), rank=12, iters=20, reg=0.1)
    scores = recommend.user_scores(model, ratings, user)
    return scores.select(category_name(F.col("item_id") - 1, names).alias("tag"), F.col("prediction").alias("score"))


def turns(spark, folder) -> DataFrame:
    """Conversation turns read as captions: the role is the user's name, the conversation picks the tag."""
    talks = table(spark, folder, "conversations")
    return talks.select(
        "conv_id", "turn", F.col("role").alias("username"), F.col("text").alias("caption"), (F.col("conv_id") % len(TAGS) + 1).alias("tag_id")
    )


@query("caption_recommendations")
def caption_recommendations(spark, folder):
    """How often each tag is both recommended to user 1 and predicted for a held-out image, with its mean score."""
    ratings = via_table(caption_ratings(turns(spark, folder), ["conv_id", "turn"], lexicon(spark, folder)), "caption-ratings")
    liked = via_table(recommended_tags(ratings, 1, TAGS), "recommended-tags")
    classes = image_forest(spark, folder).select(category_name(F.col("prediction"), TAGS).alias("tag"))
    matches = relational.matching_names(liked, classes, "tag")
    return matches.join(liked.groupBy("tag").agg(F.avg("score").alias("score")), "tag")
