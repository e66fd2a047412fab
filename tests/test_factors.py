import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from tidemark.plans import factors, recommend


def scores(spark, holes=()):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(40) for i in range(25) if (u + 3 * i) % 4 and u not in holes]
    rows += [(7, i, 2.0) for i in range(25, 60)]  # one user with many ratings
    return spark.createDataFrame(rows, "user_id_no int, item_id_no int, rating double")


def by_number(side, n):
    return side.rows(np.arange(n))


def test_rounds_find_the_factors_of_the_library(spark, monkeypatch):
    monkeypatch.setattr(factors, "CHUNK", 50)
    monkeypatch.setattr(factors, "AT_ONCE", 20)
    monkeypatch.setattr(factors, "PART", 16)
    coded = scores(spark, holes=(3, 16, 39))
    found = recommend._fit(coded, 4, 6, 0.1, 42)
    als = ALS(rank=4, maxIter=6, regParam=0.1, seed=42, userCol="user_id_no", itemCol="item_id_no", ratingCol="rating")
    want = als.fit(coded)
    for side, table, n in ((found.users, want.userFactors, 40), (found.items, want.itemFactors, 60)):
        got = by_number(side, n)
        rows = {r.id: r.features for r in table.collect()}
        assert {k for k in range(n) if not np.isnan(got[k]).any()} == set(rows)
        assert all(got[k] == pytest.approx(v, abs=1e-3) for k, v in rows.items())
    strangers = spark.createDataFrame([(3, 1), (7, 59), (500, 1), (7, 60)], "user_id_no int, item_id_no int")
    assert factors.predicted(strangers, found.users, found.items).count() == 1


def test_further_rounds_shuffle_nothing_more(spark):
    ready = recommend.pack(scores(spark))
    made = lambda: spark.sparkContext._jsc.sc().newShuffleId()
    used = []
    for iters in (1, 6):
        before = made()
        recommend._fit(ready, 4, iters, 0.1, 42)
        used.append(made() - before)
    assert used[0] == used[1]


def test_only_the_last_factors_stay(spark):
    from pathlib import Path

    from tidemark.session import shared_root

    ready = recommend.pack(scores(spark))
    folder = Path(shared_root(spark))
    before = set(folder.glob("factors-*"))
    found = recommend._fit(ready, 4, 5, 0.1, 42)
    assert {str(p) for p in set(folder.glob("factors-*")) - before} == {found.users.path, found.items.path}
