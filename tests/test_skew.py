"""Hot-key behaviour: one key / value holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from pharmaflow.operators import quantiles as QT
from pharmaflow.operators.dedup import keep_first


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_keep_first_combines_map_side(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = keep_first(df, ["k"], ["o"])
    plan = _plan(out)
    # the group limit runs before the shuffle too, so the hot key ships one
    # candidate per input partition (the tree is printed from the result down)
    tree = plan[:plan.index("(1)\n")] if "(1)\n" in plan else plan
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange") > tree.index("WindowGroupLimit")
    hot = out.where("k = 0").first()
    assert (hot.o, hot.v) == (0, 0)
    assert out.count() == 2001


@pytest.mark.parametrize("bits", [3, 8, 16])
def test_quantiles_of_a_hot_value(spark, bits):
    rows = [("x", 7.0 if i % 3 == 0 else float(i % 1000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "feature string, value double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    ref = df.agg(F.percentile("value", F.array(*[F.lit(p) for p in probs]))).first()[0]
    got = QT.quantiles(df, probs, bits=bits).first()
    assert [got[f"q{i}"] for i in range(len(probs))] == pytest.approx(ref, rel=0, abs=1e-9)


def test_quantiles_only_count_rows(spark):
    """Nothing sorts or gathers the values, whatever their number."""
    import inspect
    source = inspect.getsource(QT)
    assert ".collect(" not in source and "toPandas" not in source and "percentile(" not in source
    df = spark.createDataFrame([(g, float(i * (g or 7))) for g in (1, 2, None) for i in range(50)], "feature int, value double")
    got = {r.feature: (r.q0, r.q1) for r in QT.quantiles(df, [0.0, 0.5]).collect()}
    assert got == {1: (0.0, 24.5), 2: (0.0, 49.0)}
    assert QT.quantiles(df.limit(0), [0.5]).count() == 0
    with pytest.raises(ValueError):
        QT.quantiles(df, [1.5])


def test_order_keys_sort_like_doubles(spark):
    import math
    import struct
    small = 5e-324
    vs = [0.0, -0.0, small, -small, 3 * small, 2.0 ** -1022, 2.0 ** -1022 - small, 1.0, math.nextafter(1, 0), math.nextafter(1, 2), 8.0,
          math.nextafter(8, 0), math.nextafter(8, 9), 2.0 ** 49, math.nextafter(2.0 ** 49, 0), 0.1, 1e300, -1e300, 1.7976931348623157e308,
          float("inf"), float("-inf"), -123.456, 2.0 ** 1023, math.nextafter(2.0 ** 1023, 0)]
    vs += [math.nextafter(2.0 ** e, t) for e in range(-1000, 1000, 37) for t in (0, math.inf)] + [2.0 ** e for e in range(-1074, 1023, 13)]
    df = QT.with_order_key(spark.createDataFrame([(v,) for v in vs], "v double"), "v", "k")
    for r in df.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-bits if r.v < 0 else bits), r
    nan, top = QT.with_order_key(spark.createDataFrame([(float("nan"),), (float("inf"),)], "v double"), "v", "k").collect()
    assert nan.k > top.k


def test_scale_conf_sizes_partitions():
    from pharmaflow.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert c["spark.sql.shuffle.partitions"] == "409600"
    assert int(c["spark.sql.autoBroadcastJoinThreshold"]) == 64 * 1024 * 1024
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "1"


def test_one_order_with_a_third_of_all_lines(spark, tmp_path):
    """Its report stays one report, with all its drugs."""
    from pharmaflow.plans import etl as E
    sf = "/root/testdata/sf0.001"
    for name in ("orders", "lineitem"):
        d = spark.read.parquet(f"{sf}/{name}.parquet")
        if name == "lineitem":
            d = d.withColumn("l_orderkey", F.when(F.xxhash64("l_partkey", "l_suppkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey")).cast("long"))
            n = d.where("l_orderkey = 1").count()
        d.write.parquet(f"{tmp_path}/{name}.parquet")
    got = E.s1_report_source(spark, str(tmp_path)).where("safetyreportid = '1'").collect()
    assert [r.n_drugs for r in got] == [n] and n > 1000


def test_keep_first_follows_the_lines_of_a_file(spark, tmp_path):
    """Equal keys on several lines of one file: the first line wins."""
    from pharmaflow.operators.flatten import reports_to_events
    from pharmaflow.sources.files import read_report_files
    line = ('{"results": [{"safetyreportid": "1", "receivedate": "%d", "patient": {"reaction": [{"reactionmeddrapt": "x"}], '
            '"drug": [{"medicinalproduct": "p"}]}}]}')
    (tmp_path / "a.json").write_text("\n".join(line % (20240101 + i) for i in (7, 3, 5)))
    assert [r.receivedate for r in reports_to_events(read_report_files(spark, str(tmp_path))).collect()] == ["20240108"]


def test_values_that_oracles_do_not_hold(spark):
    from pharmaflow.functions import age_bucket
    from pharmaflow.ml.evaluate import regression_metrics
    from pharmaflow.operators.drift import prediction_histogram
    from pharmaflow.operators.quality import basic_quality, quality_report
    y = spark.createDataFrame([(1e9 + i, 1e9 + i + 0.5) for i in range(4)], "label double, prediction double")
    assert regression_metrics(y).first().r2 == pytest.approx(0.8)
    y = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0)], "label double, prediction double")
    assert regression_metrics(y).first().mape == pytest.approx(50.0)
    d = spark.createDataFrame([(float("nan"), "a"), (None, "a"), (1.0, "b")], "x double, t string")
    assert [r.missing for r in quality_report(d).collect()] == [2, 0]
    assert [r.observed for r in basic_quality(d, "t").where("check = 'missing_ratio' AND column = 'x'").collect()] == [pytest.approx(2 / 3)]
    with pytest.raises(ValueError):
        prediction_histogram(spark.createDataFrame([(-1,), (2,)], "p int"), "p")
    ages = spark.createDataFrame([("99999999999",), ("34",), ("x",)], "a string")
    assert [r[0] for r in ages.select(age_bucket("a")).collect()] == [None, 30, None]


def test_a_part_without_a_class_keeps_the_numbers(spark):
    from pharmaflow.ml.models import class_values, estimator, prepare_label
    full = spark.createDataFrame([("a",), ("b",), ("c",)], "y string")
    part = full.where("y <> 'a'")
    got = prepare_label(part, "y", classes=class_values(full, "y"))[0].collect()
    assert sorted((r.y, r.label) for r in got) == [("b", 1.0), ("c", 2.0)]
    with pytest.raises(ValueError):
        estimator("random_forest", 10, 2, {"max_depth": 31})
    with pytest.raises(ValueError):
        estimator("random_forest", 10, 2, {"max_leafs": 3})
    assert estimator("random_forest", 10, 2, {"min_samples_leaf": 4}).getMinInstancesPerNode() == 4
