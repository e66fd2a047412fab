"""File formats: the tables are written in each format and scanned back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.text import NB_SQL
from tidemark.functions import vectors
from tidemark.plans import textmodel
from tidemark.session import shared_path, via_table
from tidemark.sources import files
from tidemark.sources.tables import RATINGS_SQL, descriptors, ratings, table


def timed_ratings(spark, folder):
    rows = ratings(spark, folder)
    return rows.select("user_id", "item_id", "rating", (F.col("digit") + 1_400_000_000).alias("ts"))


@query("scan_ratings", f"WITH {RATINGS_SQL} SELECT user_id, item_id, rating, digit + 1400000000 AS ts FROM ratings")
def scan_ratings(spark, folder):
    path = shared_path(spark, "ratings")
    files.write_delimited(timed_ratings(spark, folder), path, "::")
    return files.read_ratings(spark, path)


@query("scan_items", "SELECT p_partkey AS item_id, p_name || ': ' || p_brand AS title FROM part")
def scan_items(spark, folder):
    path = shared_path(spark, "items")
    title = F.concat_ws(": ", "p_name", "p_brand")
    files.write_delimited(table(spark, folder, "part").select("p_partkey", title.alias("title")), path, "::")
    return files.read_items(spark, path)


@query("scan_triples", f"WITH {RATINGS_SQL} SELECT user_id, item_id, rating FROM ratings")
def scan_triples(spark, folder):
    path = shared_path(spark, "triples")
    ratings(spark, folder).select("user_id", "item_id", "rating").write.csv(path)
    return files.read_triples(spark, path)


@query(
    "scan_feature_csv",
    """SELECT 'line' || l_orderkey AS name, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
)
def scan_feature_csv(spark, folder):
    path, columns = shared_path(spark, "features"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    name = F.concat(F.lit("line"), "l_orderkey").alias("name")
    table(spark, folder, "lineitem").select(name, *columns).write.csv(path, header=True)
    return files.read_feature_csv(spark, path, columns)


@query(
    "scan_captions",
    r"""SELECT role || conv_id AS username, trim(regexp_replace(text, '\s+', ' ', 'g')) AS caption, role AS tag,
    CAST(turn AS INT) AS tag_id, 'http://example.org/"' || conv_id || '";x' AS link FROM conversations""",
)
def scan_captions(spark, folder):
    path = shared_path(spark, "captions")
    talks = table(spark, folder, "conversations").select(
        F.concat("role", "conv_id").alias("username"),
        F.trim(F.regexp_replace("text", r"\s+", " ")).alias("caption"),
        F.col("role").alias("tag"),
        F.col("turn").cast("int").alias("tag_id"),
        F.concat(F.lit('http://example.org/"'), "conv_id", F.lit('";x')).alias("link"),
    )
    talks.write.csv(path, sep=";", header=True, quoteAll=True, escape='"')
    return files.read_captions(spark, path)


def digest(rows):
    vec = vector_to_array("features")
    return [F.size(vec).alias("width"), F.round(vectors.total(vec), 6).alias("total")]


VECTOR_SQL = "SELECT CAST(len(embedding) AS INT) AS width, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total"


@query("scan_vectors", VECTOR_SQL + " FROM embeddings")
def scan_vectors(spark, folder):
    path = shared_path(spark, "vectors")
    line = F.concat(vectors.to_text("vec"), F.lit(" "))
    descriptors(spark, folder).select(line.alias("value")).write.text(path)
    rows = files.read_vectors(spark, path)
    return rows.select(*digest(rows))


@query("scan_labeled_vectors", VECTOR_SQL + ", CAST(label AS DOUBLE) AS label FROM embeddings")
def scan_labeled_vectors(spark, folder):
    path = shared_path(spark, "labelled-vectors")
    line = F.concat_ws(",", "label", vectors.to_text("vec"))
    descriptors(spark, folder).select(line.alias("value")).write.text(path)
    rows = files.read_labelled_vectors(spark, path)
    return rows.select("label", *digest(rows))


RECORD_END = "\x1e"
FILE_DOCS = 1000  # a file is read as one row


def documents_by_folder(spark, folder):
    """One folder per language; a task writes files of at most FILE_DOCS whole documents into each."""
    path = shared_path(spark, "documents")
    docs = table(spark, folder, "documents").select("text", "lang")
    docs.write.partitionBy("lang").option("lineSep", RECORD_END).option("maxRecordsPerFile", FILE_DOCS).text(path)
    return path


@query(
    "scan_whole_files",
    "SELECT 'lang=' || lang AS label, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1",
)
def scan_whole_files(spark, folder):
    rows = files.read_whole_files(spark, documents_by_folder(spark, folder))
    n_docs = F.size(F.split("text", RECORD_END)) - 1
    return rows.groupBy("label").agg(
        F.sum(n_docs).cast("bigint").alias("n_docs"), F.sum(F.length("text") - n_docs).cast("bigint").alias("n_chars")
    )


@query(
    "scanned_nb_theta",
    NB_SQL + " SELECT lang, token, n, round(ln((n + 1.0) / (total + v)), 6) AS theta FROM c JOIN t USING (lang), v",
)
def scanned_nb_theta(spark, folder):
    """Naive Bayes weights learned from scanned files, labelled by the folder they lie in."""
    rows = files.read_whole_files(spark, documents_by_folder(spark, folder))
    docs = rows.select(
        F.regexp_replace("label", "^lang=", "").alias("lang"), F.explode(F.split("text", RECORD_END)).alias("text")
    )
    terms = textmodel.token_rows(docs, keep=("lang",))
    theta = textmodel.nb_theta(via_table(textmodel.nb_counts(terms, "lang"), "token-counts"), "lang")
    return theta.select("lang", "token", "n", F.round("theta", 6).alias("theta"))


@query(
    "list_files",
    """SELECT 'lang=' || lang AS parent, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes
    FROM documents GROUP BY 1""",
)
def list_files(spark, folder):
    """Bytes per folder from the listing alone; every document ends with one mark of a byte."""
    listed = files.list_files(spark, documents_by_folder(spark, folder))
    return listed.filter(F.col("name").endswith(".txt")).groupBy("parent").agg(F.sum("length").alias("n_bytes"))


@query(
    "load_personal_ratings",
    f"WITH {RATINGS_SQL} SELECT user_id, item_id, rating - 1 AS rating, digit + 1400000000 AS ts FROM ratings WHERE rating > 1",
)
def load_personal_ratings(spark, folder):
    """Ratings moved down by one, so that the lowest ones become the zeros the loader drops; a title follows."""
    path = shared_path(spark, "personal")
    rows = timed_ratings(spark, folder).withColumn("rating", F.col("rating") - 1)
    files.write_delimited(rows.withColumn("title", F.concat(F.lit("Item: "), "item_id")), path, "::")
    return files.load_personal_ratings(spark, path)


HEADER = r"""@relation lines

@attribute price numeric
@attribute flag {A,N,R}
@attribute note string
@attribute shipped date yyyy-MM-dd
@attribute parts relational
@attribute parts.amount numeric
@attribute parts.status {F,O}
@end parts

@data"""


@query(
    "scan_header_typed",
    """SELECT l_extendedprice AS price, l_returnflag AS flag, 'line ' || l_linenumber || ', order ' || l_orderkey AS note,
    strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_quantity + l_linenumber AS amount,
    l_linestatus || l_linestatus AS statuses FROM lineitem""",
)
def scan_header_typed(spark, folder):
    path = shared_path(spark, "typed")
    lines = table(spark, folder, "lineitem")
    nested = F.format_string("'%s,%s\\n%s,%s'", F.col("l_quantity"), "l_linestatus", "l_linenumber", "l_linestatus")
    note = F.format_string("'line %s, order %s'", "l_linenumber", "l_orderkey")
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
    body = lines.select(F.concat_ws(",", "l_extendedprice", "l_returnflag", note, shipped, nested).alias("value"))
    body.write.text(path)
    spark.createDataFrame([(HEADER,)], "value string").write.text(f"{path}-header")
    rows = files.read_header_typed(spark, path, f"{path}-header")
    return rows.select(
        "price",
        "flag",
        "note",
        F.date_format("shipped", "yyyy-MM-dd").alias("shipped"),
        F.aggregate("parts.parts_amount", F.lit(0.0), lambda s, x: s + x).alias("amount"),
        F.array_join("parts.parts_status", "").alias("statuses"),
    )


@query(
    "materialize_once",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(1 AS INT) AS runs FROM events GROUP BY 1",
)
def materialize_once(spark, folder):
    """Asked for twice, computed once."""
    path, runs = shared_path(spark, "daily"), []

    def stage():
        runs.append(1)
        days = F.date_format("ts", "yyyy-MM-dd").alias("day")
        return table(spark, folder, "events").groupBy(days).agg(F.count("*").alias("n"))

    files.materialize_once(spark, path, stage)
    return files.materialize_once(spark, path, stage).withColumn("runs", F.lit(len(runs)))
