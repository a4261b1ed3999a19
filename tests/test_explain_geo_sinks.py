import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from panelkit.errors import ContractError, MissingInputError
from panelkit.operators import explain, geo, profile
from panelkit.sinks import record, tables
from panelkit.sources import readers

D = dt.date(2024, 1, 1)


def contributions(spark, **values):
    return spark.createDataFrame(
        [("1", D, f, v) for f, v in values.items()],
        "zip string, month date, feature string, contribution double")


def test_top_and_residual_reconcile(spark):
    df = contributions(spark, a=0.1, b=-0.5, c=0.3, d=0.02, e=-0.01)
    top = [(r.feature, r.contribution) for r in explain.top_contributions(df, 2).orderBy("place").collect()]
    assert top == [("b", -0.5), ("c", 0.3)]
    parts = {r.feature: r.contribution for r in explain.with_residual(df, 2).collect()}
    assert parts[explain.OTHER] == pytest.approx(0.11) and sum(parts.values()) == pytest.approx(-0.09)
    assert {r.feature for r in explain.with_residual(df, 9).collect()} == set("abcde")


def sentence(spark, **values):
    return explain.driver_sentences(contributions(spark, **values)).first().sentence


def test_sentences(spark):
    assert sentence(spark, price_mom_3m=0.3, HOUST=0.2, odd=0.1, zhvi=0.0001) == (
        "**3-month price momentum, housing starts and odd** push this forecast up.")
    assert sentence(spark, price_mom_3m=0.3, HOUST=-0.2, odd=-0.1) == (
        "**3-month price momentum** push this forecast up , while "
        "**housing starts and odd** pull it down.")
    assert sentence(spark, a=-0.3) == "**a** pull it down."
    assert sentence(spark, a=0.0) == (
        "The top features contribute almost nothing to this forecast.")


def test_peer_medians(spark):
    rows = [("1", D, 0.10), ("2", D, 0.02), ("3", D, 0.06), ("4", D, 9.0), ("5", D, 7.0)]
    snap = spark.createDataFrame(rows, "zip string, month date, HOUST double")
    lookup = spark.createDataFrame(
        [("1", "M"), ("2", "M"), ("3", "M"), ("4", "N")], "zip string, metro string")
    for limit in (1_000_000, 2):
        got = {r.zip: r for r in explain.peer_medians(snap, lookup, ["HOUST"], limit).collect()}
        assert got["1"].metro_median == 0.06 and got["1"].this_zip == 0.10
        assert got["5"].metro_median == 0.10 and got["1"].feature == "housing starts"


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("zip"), F.lit(D).alias("month"))
    a = {r.zip for r in explain.seeded_sample(df, 50, 1).collect()}
    b = {r.zip for r in explain.seeded_sample(df.repartition(7), 50, 1).collect()}
    assert a == b and len(a) == 50
    assert a != {r.zip for r in explain.seeded_sample(df, 50, 2).collect()}
    assert explain.seeded_sample(df, 900, 1).count() == 500


def square(x, y, s=1.0):
    return [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]


@pytest.fixture(scope="module")
def shapes(spark, tmp_path_factory):
    body = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"zip": " 501"}, "geometry": {
            "type": "Polygon", "coordinates": [square(0, 0)]}},
        {"type": "Feature", "properties": {"zip": "94110"}, "geometry": {
            "type": "MultiPolygon", "coordinates": [[square(10, 5)], [square(-3, 2)]]}}]}
    path = tmp_path_factory.mktemp("geo") / "g.geojson"
    path.write_text(json.dumps(body))
    return readers.read_geometries(spark, str(path))


def test_bounds_of_mixed_depths(shapes, spark):
    assert {r.id for r in shapes.collect()} == {"00501", "94110"}
    assert tuple(geo.bounds(shapes).first()) == (-3.0, 0.0, 11.0, 6.0)
    drawn = spark.createDataFrame([("00501",), ("x",)], "zip string")
    one = geo.subset_geometries(shapes, drawn)
    row = geo.padded_ranges(geo.bounds(one)).first()
    assert (row.lon_from, row.lon_to) == pytest.approx((-0.08, 1.08))
    assert tuple(geo.bounds(shapes.limit(0)).first()) == (None,) * 4


def test_bounds_of_any_depth_and_form(spark):
    """Collections in collections, positions with a height, members that hold no place, typed columns."""
    docs = [
        {"type": "Point", "coordinates": [3, -4, 100]},
        {"type": "GeometryCollection", "bbox": [-99, -99, 99, 99], "geometries": [
            {"type": "LineString", "coordinates": [[0.5, 1], [2, 8.25]]},
            {"type": "GeometryCollection", "geometries": [{"type": "MultiPolygon", "coordinates": [[square(-7, 2)], [square(1, 1)]]}]}]},
        {"type": "Odd", "coordinates": [[[[[[[12.0, 0.0]]]]]]]},
        {"type": "Polygon", "coordinates": []}, {"type": "Point"}]
    rows = spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate(docs)] + [("n", None), ("b", "{")], "id string, geometry string")
    assert tuple(geo.bounds(rows).first()) == (-7.0, -4.0, 12.0, 8.25)
    typed = spark.createDataFrame([("a", ("Polygon", [square(1.0, 2.0)]))], "id string, geometry struct<type:string,coordinates:array<array<array<double>>>>")
    assert tuple(geo.bounds(typed).first()) == (1.0, 2.0, 2.0, 3.0)
    assert geo.points(rows.limit(0)).count() == 0


def test_small_box_gets_the_least_margin(spark):
    box = spark.createDataFrame([(0.0, 0.0, 0.1, 0.1)], "lon_min double, lat_min double, lon_max double, lat_max double")
    assert geo.padded_ranges(box).first().lon_from == pytest.approx(-0.05)


def test_key_coverage_counts_repeats(spark, shapes):
    asked = spark.createDataFrame([("00501",), ("00501",), ("9",), ("9",), ("8",)], "zip string")
    have = shapes.select(F.col("id").alias("zip"))
    row = geo.key_coverage(asked, have).first()
    assert (row.requested, row.matched, row.unmatched, row.match_rate) == (5, 2, 2, 0.4)
    assert [r.zip for r in geo.unmatched_keys(asked, have).collect()] == ["8", "9"]
    assert geo.key_coverage(asked.limit(0), have).first().match_rate == 0.0


def test_missing_profile(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3, None)], "a int, b int, c int")
    got = [(r.column_name, r.missing_pct) for r in profile.missing_profile(df).collect()]
    assert got == [("c", 100.0), ("b", 50.0)]


def test_table_can_be_rewritten_from_itself(spark, tmp_path):
    root = str(tmp_path / "features")
    tables.publish(spark.range(3).toDF("x"), root, "001")
    current = tables.read_latest(spark, root)
    tables.publish(current.withColumn("split", F.lit("train")), root, "002")
    assert tables.read_latest(spark, root).columns == ["x", "split"]
    tables.publish(current.limit(1), root, "003", promote=False)
    assert tables.latest_path(spark, root).endswith("002")
    assert tables.versions(spark, root).count() == 3
    with pytest.raises(MissingInputError):
        tables.latest_path(spark, str(tmp_path / "none"))


def test_section_is_replaced_not_stacked(spark, tmp_path):
    path = str(tmp_path / "report")
    tables.write_section(spark.createDataFrame([(1.0,)], "v double"), path, "join")
    tables.write_section(spark.createDataFrame([(2.0,)], "v double"), path, "split")
    tables.write_section(spark.createDataFrame([(3.0,)], "v double"), path, "join")
    got = {r.section: r.v for r in tables.read_sections(spark, path).collect()}
    assert got == {"join": 3.0, "split": 2.0}
    tables.write_section(spark.createDataFrame([], "v double"), path, "join")
    assert {r.section for r in tables.read_sections(spark, path).collect()} == {"split"}


def test_a_failed_write_or_check_changes_nothing(spark, tmp_path):
    path, root = str(tmp_path / "s"), str(tmp_path / "t")
    good = spark.createDataFrame([(1.0,)], "v double")
    tables.write_section(good, path, "a/b=c")
    tables.publish(good, root, "v1")
    broken = spark.createDataFrame([(0,)], "n int").select(F.raise_error(F.lit("lost")).cast("double").alias("v"))

    def refuse(df):
        raise ContractError("not good enough")

    for rows, check in ((broken, None), (good, refuse)):
        with pytest.raises(Exception, match="lost|not good enough"):
            tables.write_section(rows, path, "a/b=c", check)
        with pytest.raises(Exception, match="lost|not good enough"):
            tables.publish(rows, root, f"w{check is None}", check=check)
        assert [tuple(r) for r in tables.read_sections(spark, path).collect()] == [(1.0, "a/b=c")]
        assert tables.latest_path(spark, root).endswith("v1")
    with pytest.raises(ContractError, match="not to be written"):
        tables.replace_sections(good.withColumn("section", F.lit("x")), path, ["y"])


def test_of_two_writers_one_is_first(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.publish(spark.range(1), root, "v1")
    seen = record.last_number(spark, root)
    commit = record.reserve(spark, root)
    tables.publish(spark.range(2), root, "v2", after=seen)
    with pytest.raises(record.Outrun):
        tables.publish(spark.range(3), root, "v3", after=seen)
    with pytest.raises(record.Outrun):
        commit({"version": "v4", "path": "x", "promoted": True, "facts": {}})
    assert tables.latest_path(spark, root).endswith("v2")
    with ThreadPoolExecutor(6) as pool:
        taken = list(pool.map(lambda i: record.add_change(spark, str(tmp_path / "many"), {"i": i}), range(18)))
    assert sorted(taken) == list(range(1, 19))
    assert [c["number"] for c in record.changes(spark, str(tmp_path / "many"))] == list(range(1, 19))


def test_empty_output_raises_and_log_appends(spark, tmp_path):
    with pytest.raises(MissingInputError):
        tables.write_table(spark.range(0), str(tmp_path / "t"))
    back = tables.write_table(spark.range(5), str(tmp_path / "t"), order=["id"])
    assert back.count() == 5
    for _ in range(2):
        tables.append_rows(spark.range(1), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_key_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_table(spark.range(9).select(F.col("id").cast("string").alias("zip"), "id"), path)
    df = readers.read_table(spark, path, ["zip"]).filter(F.col("zip") == "3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(zip,3)" in plan and "ReadSchema: struct<zip:string>" in plan
    with pytest.raises(MissingInputError):
        readers.read_table(spark, str(tmp_path / "gone"))


def test_manifest_hash_ignores_row_order(spark, tmp_path):
    df = spark.range(20).withColumn("v", F.rand(1)).cache()
    hashes = []
    for i, part in enumerate((df.coalesce(1), df.orderBy(F.desc("id")).coalesce(1))):
        part.write.parquet(str(tmp_path / f"m{i}"))
        row = readers.source_manifest(spark.read.parquet(str(tmp_path / f"m{i}"))).first()
        hashes.append(row.content_hash)
        assert row.rows == 20 and row.file_size > 0
    assert hashes[0] == hashes[1]
