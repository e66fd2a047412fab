"""Signal features of every embedding, read as a recording of 64 samples."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions import signals
from tidemark.operators import evaluate
from tidemark.operators import signals as across
from tidemark.operators.relational import stratified_folds
from tidemark.plans import classify
from tidemark.session import via_table
from tidemark.sources.tables import recordings

FRAME = 32

REC_SQL = "r AS (SELECT vec_id AS rec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS s FROM embeddings)"


def spectrum_sql(n: int, samples: str) -> str:
    """Magnitudes of bins 0 .. n/2 by the plain definition of the discrete Fourier transform."""

    def part(wave):
        return f"list_sum(list_transform(range(0, {n}), lambda i: {samples}[i + 1] * {wave}(2 * pi() * k * i / {n})))"

    return f"list_transform(range(0, {n // 2 + 1}), lambda k: sqrt(pow({part('cos')}, 2) + pow({part('sin')}, 2)))"


MAGS_SQL = f"WITH {REC_SQL}, m AS (SELECT rec_id, {spectrum_sql(64, 's')} AS m FROM r)"
FRAMES_SQL = f"""WITH r AS (SELECT vec_id AS rec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN embedding[1:20]
  WHEN vec_id % 5 = 0 THEN embedding[1:40] ELSE embedding END AS DOUBLE[]) AS s FROM embeddings),
f AS (SELECT rec_id, f AS frame, list_concat(s, list_transform(range(0, 64), lambda i: 0.0))[f * 32 + 1:f * 32 + 32] AS s
  FROM r, (SELECT unnest([0, 1]) AS f) WHERE f * 32 < len(s)),
m AS (SELECT rec_id, frame, {spectrum_sql(32, 's')} AS m FROM f)"""


def cut_recordings(spark, folder):
    """Some recordings cut to 40 samples, which fill their last frame in part, and some to 20, less than a frame."""
    length = F.when(F.col("rec_id") % 7 == 0, 20).when(F.col("rec_id") % 5 == 0, 40).otherwise(F.size("samples"))
    return recordings(spark, folder).withColumn("samples", F.slice("samples", F.lit(1), length))


def shaped_spectra(spark, folder):
    return recordings(spark, folder).select("rec_id", "sample_rate", signals.magnitudes("samples").alias("mags"))


def spectra(spark, folder):
    return recordings(spark, folder).select("rec_id", signals.magnitudes("samples").alias("mags"))


def feature(name, column, sql, digits=6):
    """Register a query that gives one number per recording from its magnitudes."""

    @query(f"sig_{name}", sql)
    def run(spark, folder):
        value = column(F.col("mags"))
        return spectra(spark, folder).select("rec_id", (F.round(value, digits) if digits else value).alias(name))

    return run


feature(
    "centroid",
    signals.centroid,
    MAGS_SQL
    + """ SELECT rec_id, round(list_sum(list_transform(range(0, 33), lambda k: k * m[k + 1] * m[k + 1]))
      / list_sum(list_transform(m, lambda x: x * x)), 6) AS centroid FROM m""",
)
feature(
    "rolloff",
    signals.rolloff,
    MAGS_SQL
    + """, c AS (SELECT rec_id, list_transform(range(1, 34), lambda k: list_sum(list_transform(m[1:k], lambda x: x * x))) AS c FROM m)
    SELECT rec_id, CAST(len(list_filter(c, lambda x: x < 0.85 * c[33])) AS INT) AS rolloff FROM c""",
    digits=0,
)
feature(
    "compactness",
    signals.compactness,
    MAGS_SQL
    + """, l AS (SELECT rec_id, list_transform(m, lambda x: 20 * log10(greatest(x, 1e-12))) AS l FROM m)
    SELECT rec_id, round(list_sum(list_transform(range(2, 33), lambda k: abs(l[k] - (l[k - 1] + l[k] + l[k + 1]) / 3))), 4)
      AS compactness FROM l""",
    digits=4,
)
feature(
    "variability",
    signals.variability,
    MAGS_SQL + " SELECT rec_id, round(list_stddev_pop(m), 6) AS variability FROM m",
)


@query(
    "sig_flux",
    FRAMES_SQL
    + """ SELECT a.rec_id, round(list_sum(list_transform(range(1, 18), lambda k: pow(b.m[k] - a.m[k], 2))), 6) AS flux
    FROM m a LEFT JOIN m b ON a.rec_id = b.rec_id AND b.frame = 1 WHERE a.frame = 0""",
)
def sig_flux(spark, folder):
    frames = across.frame_spectra(cut_recordings(spark, folder), "rec_id", "samples", FRAME)
    return across.flux(frames, "rec_id").withColumn("flux", F.round("flux", 6))


@query(
    "sig_rms",
    f"WITH {REC_SQL} SELECT rec_id, round(sqrt(list_sum(list_transform(s, lambda x: x * x)) / len(s)), 6) AS rms FROM r",
)
def sig_rms(spark, folder):
    value = signals.root_mean_square(F.col("samples"))
    return recordings(spark, folder).select("rec_id", F.round(value, 6).alias("rms"))


@query(
    "sig_low_energy",
    f"""WITH {REC_SQL}, e AS (SELECT rec_id, list_transform(range(0, 8),
      lambda f: sqrt(list_sum(list_transform(s[f * 8 + 1:f * 8 + 8], lambda x: x * x)) / 8)) AS e FROM r)
    SELECT rec_id, len(list_filter(e, lambda x: x < list_avg(e))) / 8.0 AS low_energy FROM e""",
)
def sig_low_energy(spark, folder):
    value = signals.low_energy_share(F.col("samples"), 8)
    return recordings(spark, folder).select("rec_id", value.alias("low_energy"))


@query(
    "sig_zero_crossings",
    f"""WITH {REC_SQL} SELECT rec_id, CAST(list_sum(list_transform(range(1, 64),
    lambda i: CAST((s[i] >= 0) != (s[i + 1] >= 0) AS INT))) AS BIGINT) AS zero_crossings FROM r""",
)
def sig_zero_crossings(spark, folder):
    return recordings(spark, folder).select(
        "rec_id", signals.zero_crossings(F.col("samples")).alias("zero_crossings")
    )


BEAT_SQL = f"""WITH {REC_SQL}, e AS (SELECT rec_id, list_transform(range(0, 16),
  lambda f: sqrt(list_sum(list_transform(s[f * 4 + 1:f * 4 + 4], lambda x: x * x)) / 4)) AS e FROM r),
c AS (SELECT rec_id, list_transform(e, lambda x: x - list_avg(e)) AS c FROM e),
h AS (SELECT rec_id, list_transform(range(1, 9), lambda g: greatest(0,
  list_sum(list_transform(range(1, 17 - g), lambda i: c[i] * c[i + g])) / 16)) AS h FROM c)"""


def beats(spark, folder):
    histogram = signals.beat_histogram(F.col("samples"), 4, 8)
    return recordings(spark, folder).select("rec_id", histogram.alias("beats"))


@query("sig_strongest_beat", BEAT_SQL + " SELECT rec_id, CAST(list_position(h, list_max(h)) AS BIGINT) AS strongest_beat FROM h")
def sig_strongest_beat(spark, folder):
    return beats(spark, folder).select("rec_id", signals.strongest_beat(F.col("beats")).alias("strongest_beat"))


@query("sig_beat_sum", BEAT_SQL + " SELECT rec_id, round(list_sum(h), 8) AS beat_sum FROM h")
def sig_beat_sum(spark, folder):
    return beats(spark, folder).select("rec_id", F.round(signals.total("beats"), 8).alias("beat_sum"))


def weights_sql(matrix, vec):
    return f"list_transform({matrix!r}, lambda w: list_sum(list_transform(list_zip(w, {vec}), lambda p: p[1] * p[2])))"


def spread(column, n, name):
    return [F.round(F.get(column, i), 5).alias(f"{name}{i}") for i in range(n)]


def spread_sql(column, n, name, first=1):
    return ", ".join(f"round({column}[{i + first}], 5) AS {name}{i}" for i in range(n))


MEL_SQL = f"""{MAGS_SQL}, p AS (SELECT rec_id, list_transform(m, lambda x: x * x) AS p FROM m),
b AS (SELECT f, k, 700 * (pow(10, (f + 0) * t / 14 / 2595) - 1) AS low, 700 * (pow(10, (f + 1) * t / 14 / 2595) - 1) AS mid,
    700 * (pow(10, (f + 2) * t / 14 / 2595) - 1) AS high FROM (SELECT 2595 * log10(1 + 32 / 700) AS t),
    (SELECT unnest(range(0, 13)) AS f), (SELECT unnest(range(0, 33)) AS k)),
w AS (SELECT f, k, greatest(0, least((k - low) / (mid - low), (high - k) / (high - mid))) AS w FROM b),
e AS (SELECT rec_id, f, ln(greatest(sum(w * p[k + 1]), 1e-12)) AS e FROM p, w GROUP BY 1, 2),
c AS (SELECT rec_id, c, sum(e * cos(pi() * c * (f + 0.5) / 13)) AS v FROM e, (SELECT unnest(range(0, 5)) AS c) GROUP BY 1, 2)
SELECT rec_id, {', '.join(f'round(max(v) FILTER (c = {i}), 5) AS mfcc{i}' for i in range(5))} FROM c GROUP BY 1"""


@query("sig_mfcc", MEL_SQL)
def sig_mfcc(spark, folder):
    found = shaped_spectra(spark, folder)
    rows = found.select("rec_id", signals.cepstra()(F.col("mags"), F.col("sample_rate")).alias("c"))
    return rows.select("rec_id", *spread(F.col("c"), 5, "mfcc"))


@query(
    "sig_constant_q",
    f"""{MAGS_SQL}, q AS (SELECT i, 2 * pow(2, i / 3) AS mid, 2 * pow(2, i / 3) * (pow(2, 1 / 3) - 1) AS half
      FROM (SELECT unnest(range(0, 12)) AS i)),
    v AS (SELECT rec_id, i, sum(m[k + 1] * greatest(0, 1 - abs(k - mid) / greatest(half, 1))) AS v
      FROM m, q, (SELECT unnest(range(0, 33)) AS k) GROUP BY 1, 2)
    SELECT rec_id, {', '.join(f'round(max(v) FILTER (i = {i}), 5) AS q{i}' for i in range(12))} FROM v GROUP BY 1""",
)
def sig_constant_q(spark, folder):
    found = shaped_spectra(spark, folder)
    rows = found.select("rec_id", signals.constant_qs()(F.col("mags"), F.col("sample_rate")).alias("c"))
    return rows.select("rec_id", *spread(F.col("c"), 12, "q"))


LPC_SQL = f"""WITH RECURSIVE {REC_SQL}, c AS (SELECT rec_id, list_transform(range(0, 11),
  lambda g: list_sum(list_transform(range(1, 65 - g), lambda i: s[i] * s[i + g]))) AS r FROM r),
lev AS (SELECT rec_id, r, 0 AS n, CAST([] AS DOUBLE[]) AS a, r[1] AS e FROM c
  UNION ALL SELECT rec_id, r, n + 1, list_append(list_transform(range(1, n + 1), lambda j: a[j] - k * a[n + 1 - j]), k), e * (1 - k * k)
  FROM (SELECT *, (r[n + 2] - coalesce(list_sum(list_transform(range(1, n + 1), lambda j: a[j] * r[n + 2 - j])), 0)) / e AS k
    FROM lev WHERE n < 10))"""


@query("sig_lpc1", LPC_SQL + f" SELECT rec_id, {spread_sql('a', 10, 'lpc')} FROM lev WHERE n = 10")
def sig_lpc1(spark, folder):
    solved = signals.linear_prediction(F.col("samples"), 10)
    return recordings(spark, folder).select("rec_id", solved.alias("c")).select("rec_id", *spread(F.col("c"), 10, "lpc"))


@query(
    "sig_moments",
    f"""{MAGS_SQL}, c AS (SELECT rec_id, m, list_sum(m) AS w,
      list_sum(list_transform(range(0, 33), lambda k: k * m[k + 1])) / list_sum(m) AS c FROM m),
    d AS (SELECT rec_id, w, c, list_transform([2, 3, 4], lambda o: list_sum(list_transform(range(0, 33),
      lambda k: pow(k - c, o) * m[k + 1])) / w) AS d FROM c)
    SELECT rec_id, round(w, 5) AS moment0, round(c, 5) AS moment1, round(d[1], 5) AS moment2,
      round(d[2] / pow(d[1], 1.5), 5) AS moment3, round(d[3] / (d[1] * d[1]), 5) AS moment4 FROM d""",
)
def sig_moments(spark, folder):
    rows = spectra(spark, folder).select("rec_id", signals.spectrum_moments(F.col("mags")).alias("c"))
    return rows.select("rec_id", *spread(F.col("c"), 5, "moment"))


@query(
    "sig_peaks",
    MAGS_SQL
    + """, k AS (SELECT rec_id, list_filter(range(1, 32), lambda k: m[k + 1] > m[k] AND m[k + 1] > m[k + 2]
      AND m[k + 1] >= 0.1 * list_max(m)) AS k FROM m)
    SELECT rec_id, CAST(len(k) AS INT) AS n_peaks, array_to_string(k, ' ') AS bins FROM k""",
)
def sig_peaks(spark, folder):
    rows = spectra(spark, folder).select("rec_id", signals.peaks(F.col("mags")).alias("k"))
    return rows.select("rec_id", F.size("k").alias("n_peaks"), F.array_join(F.col("k").cast("array<string>"), " ").alias("bins"))


@query(
    "sig_area_moments",
    FRAMES_SQL
    + """, t AS (SELECT rec_id, frame AS x, list_sum(m) AS m, list_sum(list_transform(range(0, 17), lambda k: k * m[k + 1])) AS y FROM m)
    SELECT rec_id, round(sum(m), 5) AS area, round(sum(x * m) / sum(m), 5) AS x_mean, round(sum(y) / sum(m), 5) AS y_mean,
      round(sum(x * y) / sum(m), 5) AS xy FROM t GROUP BY 1""",
)
def sig_area_moments(spark, folder):
    frames = across.frame_spectra(cut_recordings(spark, folder), "rec_id", "samples", FRAME)
    rows = across.area_moments(frames, "rec_id")
    return rows.select("rec_id", *[F.round(c, 5).alias(c) for c in ("area", "x_mean", "y_mean", "xy")])


@query(
    "sig_feature_rows",
    LPC_SQL
    + """ SELECT rec_id, CAST(list_sum(list_transform(range(1, 64), lambda i: CAST((s[i] >= 0) != (s[i + 1] >= 0) AS INT))) AS BIGINT)
      AS zero_crossings, round(a[1], 5) AS lpc1, CASE WHEN label < 9 THEN label END AS label_index
    FROM lev JOIN r USING (rec_id) WHERE n = 10""",
)
def sig_feature_rows(spark, folder):
    """Label 9 stands for a recording of unknown class."""
    rows = across.feature_rows(recordings(spark, folder), list(range(9)))
    return rows.withColumn("lpc1", F.round("lpc1", 5))


def labelled_recordings(spark, folder):
    """Two features per recording, bound for a classifier; label 9 stands for an unknown class."""
    rows = via_table(across.feature_rows(recordings(spark, folder), list(range(9))), "feature-rows")
    vec = F.array(F.col("zero_crossings").cast("double"), "lpc1")
    return rows.select("rec_id", F.col("label_index").cast("double").alias("label"), array_to_vector(vec).alias("features"))


@query("audio_report")
def audio_report(spark, folder):
    """Rates per class of the recordings, pooled over four folds, each scored by a model that did not see it."""
    known = labelled_recordings(spark, folder).dropna(subset=["label"])
    dealt = via_table(stratified_folds(known, "label", "rec_id", 4), "folds")
    pooled = classify.pooled_folds(dealt, 4, {"gaussian": lambda train: classify.gaussian_bayes().fit(train)})
    return evaluate.class_report(pooled)


@query("audio_unseen", "SELECT vec_id AS rec_id, true AS answered FROM embeddings WHERE label = 9")
def audio_unseen(spark, folder):
    """Every recording of unknown class gets one of the known classes."""
    rows = labelled_recordings(spark, folder)
    model = classify.gaussian_bayes().fit(rows.dropna(subset=["label"]))
    scored = model.transform(rows.filter(F.col("label").isNull()).select("rec_id", "features"))
    return scored.select("rec_id", F.col("prediction").between(0, 8).alias("answered"))
