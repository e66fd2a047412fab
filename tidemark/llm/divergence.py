"""Source divergence audit: how far each source's term shares are from every other source of its language.

Shares. Every (lang, source) group gives each kept term of its language a whole-number share p in billionths,
smoothed, so that a term the group never uses has the group's baseline share. The distance of two groups g and h
is the sum of |p_g - p_h| over all kept terms, also those neither of them uses.

Gustavson row accumulation. The counts are a sparse matrix, a row per group, a column per kept term. Terms are dealt
to blocks; a block holds its part of the term-major index (term -> groups with their shares). Each group of
a block scatters its terms through that index into a dense accumulator with a place per peer, and only the
accumulator's filled places are handed on: one row per block and pair of groups, never one per pair of postings.
What is accumulated corrects the zero baselines where both groups use a term:
|p_g - p_h| - |p_g - base_h| - |p_h - base_g| + |base_g - base_h|. The rest of the sum needs no pairs: a group's
terms against a peer's baseline come from the group's distinct shares and their prefix sums, for all peers at
once, and the terms neither uses are |base_g - base_h| times their number. All arithmetic is exact: shares are integer
divisions of decimals, sums are 64-bit integers (the shares of a group add up to at most 10^9 + V).

Sizes. Counting is a grouped sum over pre-aggregated rows, so a frequent term or source is no large group. A kept
term's postings and a language's baselines have one entry per source; the result itself has one row for every two
sources of a language. Blocks are bounded by the number of scattered pairs and rows of a block by PEERS,
so one task works on about BLOCK_PAIRS pairs and BLOCK_ROWS postings however many sources there are.

Defined cases: null text, lang and source are ''; repeated rows count each time; a language without a kept term
has distance 0 between its sources and no term rows; a group without terms has only baselines; an empty table
gives an empty table; further columns, null ids and their clashing names do not matter, as only text, lang and source are read.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.session import via_table

TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8
LEAST_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP_TERMS = 50
FLUSH_BYTES = 24 << 20  # of counted terms in one task before they are handed on
BLOCK_PAIRS, BLOCK_ROWS = 1 << 24, 1 << 18  # scattered pairs and postings of one block, about
PEERS = 2048  # groups of one language that are rows of the same task
AT_ONCE = 1 << 20  # pairs of postings expanded at once

COUNTED = "lang string, source string, term string, n long, docs long"


def counted_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; every group also has a row with a null term."""

    def rows(groups: dict):
        at = pa.array(np.repeat(np.arange(len(groups)), [len(n) + 1 for n, _ in groups.values()]))
        each = chain.from_iterable
        terms = list(each(chain((None,), n) for n, _ in groups.values()))
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang for lang, _ in groups], pa.string()).take(at),
                "source": pa.array([source for _, source in groups], pa.string()).take(at),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array(np.fromiter(each(chain((0,), n.values()) for n, _ in groups.values()), np.int64, len(at))),
                "docs": pa.array(np.fromiter(each(chain((0,), map(d.__getitem__, n)) for n, d in groups.values()), np.int64, len(at))),
            }
        )

    def run(batches):
        groups, size = {}, 0
        for batch, texts in text_slices(batches):
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts, strict=True):
                n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                words = TERM.findall((text or "").encode().lower())
                own = set(words)
                size += sum(200 + len(t) for t in own - n.keys())
                n.update(words)
                d.update(own)
            if size > FLUSH_BYTES:
                yield from rows(groups)
                groups, size = {}, 0
        if groups:
            yield from rows(groups)

    named = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        "text",
    )
    return (
        named.mapInArrow(run, COUNTED)
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(n: str, total: str, terms: str) -> str:
    """SQL of a smoothed share in billionths, in exact whole numbers."""
    return (
        f"1L + (cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))) "
        f"div (cast({total} as decimal(20,0)) + {SMOOTH} * cast({terms} as decimal(18,0)))"
    )


def expanded(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def scatter(term: np.ndarray, group: np.ndarray, p: np.ndarray, base: np.ndarray, rows: slice, peers: int):
    """(g, h, value) for g < h: the corrections of all shared terms of one block, g within `rows`.

    `term`, `group`, `p`, `base` are the block's postings; `peers` is the number of groups.
    """
    order = np.lexsort((group, term))
    group_of, p_of, base_of = group[order], p[order], base[order]  # term-major index
    start = np.searchsorted(term[order], np.arange(term.max() + 2))
    by_row = np.argsort(group, kind="stable")
    at, ends = np.unique(group[by_row], return_index=True)
    ends = np.append(ends, len(by_row))
    for k, g in enumerate(at):
        if not rows.start <= g < rows.stop:
            continue
        own = by_row[ends[k] : ends[k + 1]]
        total, shared = np.zeros(peers, np.int64), np.zeros(peers, np.int64)
        lengths = start[term[own] + 1] - start[term[own]]
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // AT_ONCE)) + 1
        for some in np.split(np.arange(len(own)), cuts):
            mine, n = own[some], lengths[some]
            there = expanded(start[term[mine]], n)
            p_g, base_g = np.repeat(p[mine], n), base[mine[0]] if len(mine) else 0
            h, p_h, base_h = group_of[there], p_of[there], base_of[there]
            later = h > g
            h, p_g, p_h, base_h = h[later], p_g[later], p_h[later], base_h[later]
            np.add.at(total, h, abs(p_g - p_h) - abs(p_g - base_h) - abs(p_h - base_g) + abs(base_g - base_h))
            shared += np.bincount(h, minlength=peers)
        filled = np.flatnonzero(shared)
        yield int(g), filled, total[filled]


def shared_corrections(postings: DataFrame) -> DataFrame:
    """(lang, g, h, value) of every two groups that share terms, one row per block."""
    dealt = postings.withColumns(
        {
            "block": F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"),
            "part": F.explode(F.expr(f"sequence(0, cast((groups - 1) div {PEERS} as int))")),
        }
    )
    blocks = dealt.groupBy("lang", "block", "part").agg(
        F.first("groups").alias("groups"), F.collect_list(F.struct("term", "g", "p", "base")).alias("rows")
    )

    def run(batches):
        for batch in batches:
            for lang, part, groups, rows in zip(*(batch.column(c) for c in ("lang", "part", "groups", "rows")), strict=True):
                flat = rows.values.flatten()
                term = flat[0].dictionary_encode().indices.to_numpy()
                group, p, base = (c.to_numpy(zero_copy_only=False) for c in flat[1:])
                first = part.as_py() * PEERS
                for g, h, value in scatter(term, group, p, base, slice(first, first + PEERS), groups.as_py()):
                    n = len(h)
                    if n:
                        yield pa.RecordBatch.from_pydict(
                            {"lang": pa.array([lang.as_py()] * n), "g": pa.array(np.full(n, g)), "h": pa.array(h), "value": pa.array(value)}
                        )

    return blocks.select("lang", "part", "groups", "rows").mapInArrow(run, "lang string, g long, h long, value long")


def against_baselines(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, g, h, value), g < h, once from either side: the side's terms against the other's baseline.

    The side with the smaller number also brings the terms that neither uses, as if no term were shared.
    """
    distinct = postings.groupBy("lang", "g", "p").agg(F.count("*").alias("m"))
    own = distinct.groupBy("lang", "g").agg(F.sort_array(F.collect_list(F.struct("p", "m"))).alias("own"))
    peers = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("g", "base", "used"))).alias("peers"))
    sides = groups.select("lang", "g", "base", "used", "terms").join(own, ["lang", "g"], "left").join(peers, "lang")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                g, base, used, terms = (batch.column(c)[k].as_py() for c in ("g", "base", "used", "terms"))
                peer = batch.column("peers")[k].values.flatten()
                h, base_h, used_h = (c.to_numpy(zero_copy_only=False) for c in peer)
                value = np.zeros(len(h), np.int64)
                if batch.column("own")[k].is_valid:
                    p, m = (c.to_numpy(zero_copy_only=False) for c in batch.column("own")[k].values.flatten())
                    low_n, low_sum = np.append(0, np.cumsum(m)), np.append(0, np.cumsum(m * p))
                    at = np.searchsorted(p, base_h)
                    value = base_h * low_n[at] - low_sum[at] + (low_sum[-1] - low_sum[at]) - base_h * (low_n[-1] - low_n[at])
                value = value + np.where(h > g, abs(base - base_h) * (terms - used - used_h), 0)
                other = h != g
                n = int(other.sum())
                if n:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([batch.column("lang")[k].as_py()] * n),
                            "g": pa.array(np.minimum(h, g)[other]),
                            "h": pa.array(np.maximum(h, g)[other]),
                            "value": pa.array(value[other]),
                        }
                    )

    return sides.select("lang", "g", "base", "used", "terms", "own", "peers").mapInArrow(
        run, "lang string, g long, h long, value long"
    )


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's peers by distance and its terms by excess."""
    counted = via_table(counted_terms(docs), "counted")
    kept = (
        counted.where("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    )
    kept = via_table(kept, "kept")
    rows = via_table(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"), "rows")
    m = F.col("m").cast("double")
    langs = (
        rows.groupBy("lang", "term").agg(F.count("*").alias("m"), F.first("all_n").alias("all_n")).groupBy("lang")
        .agg(
            F.count("*").alias("terms"), F.sum("all_n").alias("lang_total"),
            F.ceil(F.sum(m * (m / BLOCK_PAIRS + 1 / BLOCK_ROWS))).cast("int").alias("blocks"),
        )
    )
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    zero = F.lit(0).cast("long")
    # Groups of a language are numbered in one window: the result has a row for every two of them anyway.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = (
        counted.where("term IS NULL").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", "blocks", *[F.coalesce(c, zero).alias(c) for c in ("total", "used", "terms", "lang_total")])
        .withColumns({"g": number, "groups": F.count("*").over(Window.partitionBy("lang"))})
        .withColumn("base", F.expr(f"CASE WHEN terms > 0 THEN {share('0L', 'total', 'terms')} ELSE 0L END"))
    )
    groups = via_table(groups, "groups")
    shares = (
        rows.join(groups, ["lang", "source"])
        .withColumns({"p": F.expr(share("n", "total", "terms")), "q": F.expr(share("all_n", "lang_total", "terms"))})
    )
    shares = via_table(shares.select("lang", "source", "term", "g", "groups", "blocks", "base", "p", "q"), "shares")
    values = shared_corrections(shares.drop("source", "q")).unionAll(against_baselines(groups, shares))
    sums = values.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    pairs = sums.select(
        "lang", "value", F.explode(F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h")))).alias("e")
    ).select("lang", "value", "e.g", "e.h")
    name = groups.select("lang", "g", "source")
    pairs = pairs.join(name, ["lang", "g"]).join(
        name.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"]
    )
    excess = shares.where(F.col("p") > F.col("q")).withColumn("value", F.col("p") - F.col("q"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda df, part: df.withColumn("rank", place).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )
    terms = ranked(excess.withColumnRenamed("term", "item"), "term").where(F.col("rank") <= top)
    return ranked(pairs, "pair").unionAll(terms)


SQL = r"""WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
words AS (SELECT lang, source, row, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY 1, 2 HAVING count(DISTINCT row) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT f.lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY f.lang, source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (all_n + 5)) // (total + 5 * v) AS q
  FROM full_counts f JOIN v ON v.lang = f.lang),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
