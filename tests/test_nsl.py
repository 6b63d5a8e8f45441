import pytest

from flowlens import schemas as S
from flowlens.operators import nsl
from flowlens.sources.files import read_nsl_csv


def rows(spark, *overrides, n=1):
    base = {c: "0" for c in S.NSL_COLUMNS} | {
        "duration": "12", "protocol_type": "tcp", "service": "http", "flag": "SF", "src_bytes": "4216",
        "dst_bytes": "10864", "count": "5", "srv_count": "5", "same_srv_rate": "1.0", "label": "normal",
    }
    names = [*S.NSL_COLUMNS, "label"]
    data = [tuple((base | o)[c] for c in names) for o in (overrides or ({},)) for _ in range(n)]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in names))


def test_label_table_is_complete():
    assert len(nsl.LABEL_CLASS) == 40
    assert set(nsl.LABEL_CLASS.values()) == set(S.LABELS)


def test_direct_and_derived_columns(spark):
    row = nsl.map_flows(rows(spark), 1)[0].first()
    assert (row["duration"], row["src_bytes"], row["count"], row["protocol"]) == (12.0, 4216.0, 5.0, "tcp")
    assert row["packet_rate"] == pytest.approx(5 / 12) and row["bytes_per_packet"] == pytest.approx(15080 / 5)
    assert row["src_port_entropy"] > 0 and row["connection_duration_std"] == 0.0


def test_unreadable_numbers_take_defaults(spark):
    bad = {"duration": "x", "count": "", "srv_count": "-3", "protocol_type": "SCTP"}
    row = nsl.map_flows(rows(spark, bad), 1)[0].first()
    assert (row["duration"], row["count"], row["srv_count"], row["protocol"]) == (0.0, 1.0, 1.0, "tcp")
    assert row["packet_rate"] == pytest.approx(1000.0)


def test_folding(spark):
    df = rows(spark, {"service": "domain_u"}, {"service": "HTTP_443"}, {"service": "weird"}, {"flag": "rstr"}, {"flag": "S3"})
    got = nsl.map_flows(df, 1)[0].collect()
    assert sorted(r["service"] for r in got) == ["dns", "http", "http", "https", "other"]
    assert sorted(r["flag"] for r in got) == ["RSTO", "S0", "SF", "SF", "SF"]


def test_classes_and_unknown(spark):
    names = ["neptune", " Smurf ", "satan", "guess_passwd", "buffer_overflow", "normal", "zero_day_xyz"]
    out, stats = nsl.map_flows(rows(spark, *[{"label": n} for n in names]), 1)
    assert {r[S.LABEL] for r in out.collect()} == set(S.LABELS)
    assert stats["unknown_labels_dropped"] == 1 and stats["rows_in"] == 7 and stats["rows_out"] == 6


def test_rare_class_dropped(spark):
    df = rows(spark, n=50).unionByName(rows(spark, {"label": "perl"}))
    out, stats = nsl.map_flows(df, 30)
    assert out.count() == 50 and stats["rare_classes_dropped"] == {"botnet": 1}


def test_clipping(spark):
    out, stats = nsl.map_flows(rows(spark, {"duration": "999999", "src_bytes": "99000000"}, n=10), 1)
    row = out.first()
    assert row["duration"] == 600.0 and row["src_bytes"] == 5e6
    assert stats["clipped"] == {"duration": 10, "src_bytes": 10, "bytes_per_packet": 10}


def test_widths(spark, tmp_path):
    base = rows(spark, n=2)
    base.write.csv(str(tmp_path / "w42"))
    base.selectExpr("*", "'21' AS difficulty").write.csv(str(tmp_path / "w43"))
    base.drop("land").write.csv(str(tmp_path / "w41"))
    assert read_nsl_csv(spark, str(tmp_path / "w42")).columns == [*S.NSL_COLUMNS, "label"]
    assert "difficulty" in read_nsl_csv(spark, str(tmp_path / "w43")).columns
    with pytest.raises(ValueError, match="42 or 43"):
        read_nsl_csv(spark, str(tmp_path / "w41"))


def test_downsample_keeps_ratios(spark):
    df = rows(spark, {}, {"label": "neptune"}, n=100)
    out, stats = nsl.ingest(df, 1, max_rows=50)
    assert stats["downsampled_to"] == 50 and out.count() == 50
    assert {r[S.LABEL]: r["count"] for r in out.groupBy(S.LABEL).count().collect()} == {"normal": 25, "ddos": 25}
