import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens import schemas as S
from flowlens.functions.columns import split_list, with_derived
from flowlens.ml.preprocess import FlowPreprocessor, FlowPreprocessorModel
from flowlens.session import scratch_path
from flowlens.sources.files import parse_records, read_flows_csv, read_reference, split_records, write_batch_csv


def test_derived_is_idempotent(small_flows):
    once = with_derived(small_flows)
    marked = once.withColumn("bytes_ratio", F.lit(-1.0))
    assert with_derived(marked).columns == once.columns
    assert with_derived(marked).agg(F.max("bytes_ratio")).first()[0] == -1.0


def test_derived_formulas(spark):
    df = spark.createDataFrame([(100.0, 0.0, -1.0), (-5.0, 4.0, 0.0)], "src_bytes double, dst_bytes double, duration double")
    a, b = with_derived(df.withColumns({"count": F.lit(2.0), "packet_rate": F.lit(0.0)})).collect()
    assert a["bytes_ratio"] == pytest.approx(100 / 1e-6) and a["src_bytes_log"] == pytest.approx(math.log(101))
    assert b["src_bytes_log"] == 0.0 and a["duration_log"] == 0.0 and a["bytes_per_packet"] == 0.0


def test_transform_shape_and_persistence(spark, small_flows):
    model = FlowPreprocessor().fit(small_flows)
    out = model.transform(small_flows).select(vector_to_array("features").alias("x"))
    row = out.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi"),
                  F.max(F.exists("x", lambda v: F.isnan(v) | v.isNull())).alias("bad")).first()
    assert row["lo"] == row["hi"] == model.width > 12 and not row["bad"]
    path = scratch_path(spark, "pre")
    model.write().save(path)
    again = FlowPreprocessorModel.load(path).transform(small_flows).select(vector_to_array("features").alias("x"))
    assert out.exceptAll(again).count() == 0


def test_missing_constant_and_unseen(spark):
    fit = spark.createDataFrame(
        [(1.0, 5.0, "a"), (2.0, 5.0, "a"), (3.0, 5.0, "b"), (None, 5.0, None)], "x double, c double, k string"
    )
    model = FlowPreprocessor(numericCols=["x", "c"], categoricalCols=["k"]).fit(_flowish(fit))
    new = spark.createDataFrame([(None, 7.0, "zzz"), (4.0, 5.0, None)], "x double, c double, k string")
    got = [r["v"] for r in model.transform(_flowish(new)).select(vector_to_array("features").alias("v")).collect()]
    # Median 2 also fills the hole at fit time; quartiles of 1, 2, 2, 3 are 1.75 and 2.25.
    assert got == [[0.0, 2.0, 0.0, 0.0], [4.0, 0.0, 1.0, 0.0]]


def _flowish(df):
    return df.withColumns({c: F.lit(1.0) for c in S.NUMERIC})


def test_csv_round_trip(spark, small_flows, tmp_path):
    path = write_batch_csv(small_flows, str(tmp_path), "b1")
    assert read_flows_csv(spark, path).exceptAll(small_flows.select(read_flows_csv(spark, path).columns)).count() == 0
    with pytest.raises(FileNotFoundError, match="needs a header"):
        read_flows_csv(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="no reference at"):
        read_reference(spark, str(tmp_path / "none"))


def test_records(spark):
    texts = ['{}', '{"duration": 3, "service": "dns"}', '{"duration": -1}', '{"same_srv_rate": 1.2}', '{"count": "x"}',
             '{"count": "7"}', '{"src_bytes": null}', 'nonsense', '[1]', '{"duration": "NaN"}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    got = {r["i"]: r for r in parse_records(df, "body", "i").collect()}
    assert [i for i in got if got[i]["valid"]] == [0, 1, 5]
    assert (got[0]["protocol"], got[0]["service"], got[0]["flag"], got[0]["duration"]) == ("tcp", "http", "SF", 0.0)
    assert got[1]["service"] == "dns" and got[5]["count"] == 7.0
    good, bad = split_records(parse_records(df, "body", "i"))
    assert good.count() == 3 and bad.count() == 7


def test_split_list(spark):
    df = spark.createDataFrame([("a,b",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(split_list("x")).collect()] == [["a", "b"], [], []]
