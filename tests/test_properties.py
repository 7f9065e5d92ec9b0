"""Property tests: the scale-oriented implementations equal their brute-force
window definitions on random inputs (nulls, ties, hot keys)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from pharmaflow.ml.split import hash_key, stratified_rank
from pharmaflow.operators.dedup import keep_first

rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]),      # key (hot: few values)
                          st.integers(0, 5),                        # order part 1 (ties)
                          st.integers(0, 1000)),                    # order part 2 / payload
                min_size=1, max_size=60)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows)
def test_keep_first_equals_row_number(spark, data):
    df = spark.createDataFrame([(k, o, p, i) for i, (k, o, p) in enumerate(data)],
                               "k string, o int, p int, i int")
    got = Counter(tuple(r) for r in keep_first(df, ["k"], ["o", "i"]).collect())
    w = Window.partitionBy("k").orderBy("o", "i")
    ref = (df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn"))
    assert got == Counter(tuple(r) for r in ref.collect())


@SETTINGS
@given(rows)
def test_keep_first_mixed_direction_equals_row_number(spark, data):
    df = spark.createDataFrame([(k, o, p, i) for i, (k, o, p) in enumerate(data)],
                               "k string, o int, p int, i int")
    got = Counter(tuple(r) for r in keep_first(df, ["k"], [("o", False), ("i", True)]).collect())
    w = Window.partitionBy("k").orderBy(F.col("o").desc(), "i")
    ref = (df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn"))
    assert got == Counter(tuple(r) for r in ref.collect())


@SETTINGS
@given(rows, st.sampled_from([1, 3, 100]))
def test_bucketed_rank_equals_row_number(spark, data, limit):
    df = spark.createDataFrame([(k, i) for i, (k, _o, _p) in enumerate(data)], "k string, id int")
    got = {r.id: r._rank for r in stratified_rank(df, "k", ["id"], seed=3, bucket_rows=limit, digits=1).collect()}
    w = Window.partitionBy("k").orderBy(hash_key(["id"], 3), "id")
    ref = {r.id: r.rk for r in df.withColumn("rk", F.row_number().over(w) - 1).collect()}
    assert got == ref


values = st.lists(st.tuples(st.sampled_from(["x", "y"]),
                            st.one_of(st.none(), st.sampled_from([5.0, 5.0, 5.0]),  # hot value
                                      st.floats(-100, 100, allow_nan=False), st.floats(-1e-300, 1e300))),
                  min_size=1, max_size=120)


@SETTINGS
@given(values, st.sampled_from([4, 11, 16]))
def test_quantiles_equal_percentile(spark, data, bits):
    from pharmaflow.operators.quantiles import quantiles
    df = spark.createDataFrame(data, "feature string, value double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.feature: [r[f"q{i}"] for i in range(5)]
           for r in quantiles(df, probs, bits=bits).collect()}
    ref = {r.feature: r.q for r in df.where("value is not null").groupBy("feature")
           .agg(F.percentile("value", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert set(got) == set(ref)
    for k in ref:
        for a, b in zip(got[k], ref[k]):
            assert abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, got[k], ref[k])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 30)), max_size=60))
def test_prefix_sums_equal_a_window(spark, data):
    from pharmaflow.operators.prefix import dense_ids, prefix_sums
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(dict.fromkeys(data))], "g string, o int, v long")
    got = {(r.g, r.o): r.s for r in prefix_sums(df, ["g"], ["o"], {"v": "s"}).collect()}
    want = {(g, o): sum(v for v, (h, p) in enumerate(dict.fromkeys(data)) if h == g and p < o) for g, o in data}
    assert got == want
    ids = {(r.g, r.o): r.id for r in dense_ids(spark.createDataFrame(data, "g string, o int"), ["g"], ["o"]).collect()}
    assert ids == {(g, o): len({p for h, p in data if h == g and p < o}) for g, o in data}
