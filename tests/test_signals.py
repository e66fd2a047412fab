import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import signals
from tidemark.operators import signals as across

RNG = np.random.default_rng(11)
ROWS = {
    1: RNG.normal(size=64).tolist(),
    2: [0.0] * 64,
    3: [1.0, -1.0] * 32,
    4: [0.5],
    5: np.sin(2 * np.pi * 8 * np.arange(64) / 64).tolist(),
}


@pytest.fixture(scope="module")
def recordings(spark):
    rows = [(i, "a" if i < 4 else "unknown", x) for i, x in ROWS.items()]
    return spark.createDataFrame(rows, "rec_id bigint, label string, samples array<double>")


def values(recordings, column):
    return {r[0]: r[1] for r in recordings.select("rec_id", column).collect()}


def test_time_domain(recordings):
    rms = values(recordings, signals.root_mean_square(F.col("samples")))
    crossings = values(recordings, signals.zero_crossings(F.col("samples")))
    for i, x in ROWS.items():
        assert rms[i] == pytest.approx(np.sqrt(np.mean(np.square(x))))
        assert crossings[i] == sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:]))
    low = values(recordings, signals.low_energy_share(F.col("samples"), 8))
    assert low[2] == 0 and low[4] == 0  # one frame, filled up with zeros


def test_spectra(recordings):
    spectra = recordings.withColumn("mags", signals.magnitudes("samples"))
    centroid = values(spectra, signals.centroid(F.col("mags")))
    rolloff = values(spectra, signals.rolloff(F.col("mags")))
    assert centroid[5] == pytest.approx(8) and rolloff[5] == 8
    assert centroid[2] is None and centroid[3] == pytest.approx(32)
    mags = np.abs(np.fft.rfft(ROWS[1]))
    assert values(spectra, signals.variability(F.col("mags")))[1] == pytest.approx(mags.std())
    peaks = values(spectra, signals.peaks(F.col("mags")))
    assert peaks[5] == [8] and peaks[2] == [] and peaks[4] == []
    moments = values(spectra, signals.spectrum_moments(F.col("mags")))
    bins = np.arange(33)
    mean = (bins * mags).sum() / mags.sum()
    assert moments[1][1] == pytest.approx(mean)
    assert moments[1][2] == pytest.approx((((bins - mean) ** 2) * mags).sum() / mags.sum())


def test_banks(recordings):
    spectra = recordings.filter("rec_id = 1").withColumn("mags", signals.magnitudes("samples"))
    mags = np.abs(np.fft.rfft(ROWS[1]))
    bank = np.array(signals.mel_bank(33, 64.0, 13))
    want = np.array(signals.cosine_rows(5, 13)) @ np.log(np.maximum(bank @ mags**2, 1e-12))
    assert values(spectra, signals.mfcc(F.col("mags"), 33, 64.0))[1] == pytest.approx(list(want))
    kernel = np.array(signals.constant_q_kernel(33, 2.0, 3, 12))
    assert values(spectra, signals.constant_q(F.col("mags"), 33))[1] == pytest.approx(list(kernel @ mags))


def test_linear_prediction(recordings):
    got = values(recordings, signals.linear_prediction(F.col("samples"), 4))
    x = np.array(ROWS[1])
    r = np.array([x[: 64 - s] @ x[s:] for s in range(5)])
    system = np.array([[r[abs(i - j)] for j in range(4)] for i in range(4)])
    assert system @ np.array(got[1]) == pytest.approx(r[1:])
    assert got[2] == [0.0] * 4 and got[4] == [0.0] * 4


def test_across_frames(recordings):
    spectra = across.frame_spectra(recordings, "rec_id", "samples", 16)
    frames = np.abs(np.fft.rfft(np.array(ROWS[1]).reshape(4, 16)))
    flux = values(across.flux(spectra, "rec_id"), "flux")
    assert flux[1] == pytest.approx(np.square(np.diff(frames, axis=0)).sum(axis=1).mean())
    assert flux[4] is None  # one frame has no successor
    area = {r.rec_id: r for r in across.area_moments(spectra, "rec_id").collect()}[1]
    assert area.x_mean == pytest.approx((np.arange(4)[:, None] * frames).sum() / frames.sum())
    assert area.y_mean == pytest.approx((np.arange(9)[None, :] * frames).sum() / frames.sum())


def test_beats(spark):
    pulse = ([1.0] * 4 + [0.0] * 12) * 4  # energy repeats every four frames of four samples
    row = spark.createDataFrame([(pulse,)], "samples array<double>")
    beats = row.select(signals.beat_histogram(F.col("samples"), 4, 8).alias("b"))
    assert beats.select(signals.strongest_beat(F.col("b"))).first()[0] == 4


def test_feature_rows(recordings):
    rows = {r.rec_id: r for r in across.feature_rows(recordings, ["a", "b"]).collect()}
    assert rows[1].label_index == 0 and rows[5].label_index is None
    assert rows[3].zero_crossings == 63


def test_last_frame_is_filled_up(spark):
    x = RNG.normal(size=40)
    rows = spark.createDataFrame([(1, x.tolist()), (2, []), (3, None)], "rec_id bigint, samples array<double>")
    found = across.frame_spectra(rows, "rec_id", "samples", 32).orderBy("rec_id", "frame").collect()
    frames = np.abs(np.fft.rfft(np.append(x, np.zeros(24)).reshape(2, 32)))
    assert [r.rec_id for r in found] == [1, 1, 2, 3]
    assert np.allclose([r.mags for r in found[:2]], frames)
    flux = values(across.flux(across.frame_spectra(rows, "rec_id", "samples", 32), "rec_id"), "flux")
    assert flux[1] == pytest.approx(np.square(frames[1] - frames[0]).sum()) and flux[2] is None and flux[3] is None
    area = {r.rec_id: r.area for r in across.area_moments(across.frame_spectra(rows, "rec_id", "samples", 32), "rec_id").collect()}
    assert area[1] == pytest.approx(frames.sum()) and set(area) == {1, 2, 3}


def test_banks_follow_length_and_rate(spark):
    data = [(k, rate, RNG.normal(size=n).tolist()) for k, (n, rate) in enumerate([(64, 64.0), (40, 64.0), (64, 100.0), (40, 8000.0)])]
    rows = spark.createDataFrame(data, "rec_id bigint, sample_rate double, samples array<double>")
    spectra = rows.withColumn("mags", signals.magnitudes("samples"))
    got = values(spectra, signals.cepstra()(F.col("mags"), F.col("sample_rate")))
    for k, rate, x in data:
        mags = np.abs(np.fft.rfft(x))
        bank = np.array(signals.mel_bank(len(mags), rate, 13))
        want = np.array(signals.cosine_rows(5, 13)) @ np.log(np.maximum(bank @ mags**2, 1e-12))
        assert got[k] == pytest.approx(list(want))


def test_a_thousand_lengths_and_missing_rates(spark):
    data = [(k, 44100.0 + k % 3, RNG.normal(size=20 + k).tolist()) for k in range(1000)]
    data += [(2000, None, [1.0] * 30), (2001, 8000.0, []), (2002, 8000.0, None), (2003, 8000.0, [1.0])]
    rows = spark.createDataFrame(data, "rec_id bigint, sample_rate double, samples array<double>")
    spectra = rows.withColumn("mags", signals.magnitudes("samples"))
    cepstra = values(spectra, signals.cepstra()(F.col("mags"), F.col("sample_rate")))
    tones = values(spectra, signals.constant_qs()(F.col("mags"), F.col("sample_rate")))
    for k, rate, x in data[:1000:97]:
        mags = np.abs(np.fft.rfft(x))
        bank = np.array(signals.mel_bank(len(mags), rate, 13))
        assert np.allclose(signals.mel_matrix(len(mags), rate, 13), bank)
        assert cepstra[k] == pytest.approx(list(np.array(signals.cosine_rows(5, 13)) @ np.log(np.maximum(bank @ mags**2, 1e-12))))
        assert tones[k] == pytest.approx(list(np.array(signals.constant_q_kernel(len(mags), 2.0, 3, 12)) @ mags))
    assert all(cepstra[k] is None for k in range(2000, 2004)) and len(cepstra) == 1004
