"""Invariants over generated inputs (hypothesis), checked through Spark."""

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardline.functions import rules as R
from wardline.functions.columns import avg_round2, hundredths
from wardline.operators import outliers as Z
from wardline.operators import staging as ST
from wardline.operators import upsert as U

FEW = settings(max_examples=8, deadline=None)


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=40))
def test_zscore_bound(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    sizes = {}
    for g, _ in rows:
        sizes[g] = sizes.get(g, 0) + 1
    for r in Z.zscore(df, "g", "v").collect():
        n = sizes[r.g]
        assert abs(r.z_score) <= (n - 1) / math.sqrt(n) + 1e-6


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-1000, 5000)), min_size=1, max_size=30))
def test_age_buckets_are_total(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "days_since_published long")
    got = [r.b for r in df.select(ST.age_bucket().alias("b")).collect()]
    assert len(got) == len(days) and set(got) <= set(R.AGE_LABELS)


@FEW
@given(st.lists(st.integers(0, 2000), min_size=1, max_size=30))
def test_rounded_average_is_exact_half_up(spark, cents):
    df = spark.createDataFrame([(c / 100.0,) for c in cents], "x double")
    got = df.agg(avg_round2(F.sum(hundredths("x")), F.count("x")).alias("a")).first().a
    exact = (Decimal(sum(cents)) / Decimal(len(cents)) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == float(exact)


@FEW
@given(st.dictionaries(st.integers(0, 50), st.integers(0, 9), max_size=20),
       st.dictionaries(st.integers(0, 50), st.integers(0, 9), max_size=20))
def test_upsert_twice_equals_once(spark, target, source):
    t = spark.createDataFrame([(str(k), v) for k, v in target.items()], "k string, v long")
    s = spark.createDataFrame([(str(k), v) for k, v in source.items()], "k string, v long")
    once = U.upsert(t, s, "k")
    twice = U.upsert(once, s, "k")
    want = {**{str(k): v for k, v in target.items()}, **{str(k): v for k, v in source.items()}}
    assert {r.k: r.v for r in once.collect()} == want
    assert sorted(once.collect()) == sorted(twice.collect())
