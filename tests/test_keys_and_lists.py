import pytest

from panelkit.errors import ListFormatError
from panelkit.functions.keys import geometry_key, leading_digits_key, list_key, trailing_digits_key
from panelkit.sources import lists


def values(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_trailing_digits(spark):
    got = values(spark, trailing_digits_key, "Zip Code: 210", "2109", "90210 ", "none", "12345-6789", None)
    assert got == ["00210", "02109", "90210", None, "06789", None]


def test_leading_digits_differs_on_extended_keys(spark):
    assert values(spark, leading_digits_key, "12345-6789", "210", "x") == ["12345", "00210", None]


def test_long_keys_are_not_cut(spark):
    assert values(spark, trailing_digits_key, "Zip Code: 1234567") == ["1234567"]


def test_list_and_geometry_keys(spark):
    assert values(spark, list_key, "2139", "2139.0", " 7 ", "", "12a") == [
        "02139", "02139", "00007", None, "0012a",
    ]
    assert values(spark, geometry_key, " 501 ", "94110") == ["00501", "94110"]


def write(tmp_path, text):
    path = tmp_path / "list.csv"
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize(
    "text", ["zip\n94110\n2139\n", "ZIP,name\n94110,a\n2139,b\n", "94110\n2139.0\n"]
)
def test_parse_exclusions(spark, tmp_path, text):
    keys = lists.parse_exclusions(spark, write(tmp_path, text))
    assert sorted(r.zip for r in keys.collect()) == ["02139", "94110"]


@pytest.mark.parametrize("text", ["a,b\n1,2\n", "zip\nhello\n", "zip\n"])
def test_unusable_lists_raise(spark, tmp_path, text):
    with pytest.raises(ListFormatError):
        lists.parse_exclusions(spark, write(tmp_path, text))


def test_bad_keys_are_reported_and_can_be_left_out(spark, tmp_path):
    path = write(tmp_path, "zip\n" + "\n".join(["94110"] + [f"bad{i}xx" for i in range(7)]))
    report = lists.rejection_report(lists.read_key_list(spark, path)).first()
    assert report["shown"].startswith("bad0xx, bad1xx") and report["more"] == 2
    kept = lists.parse_exclusions(spark, path, strict=False)
    assert [r.zip for r in kept.collect()] == ["94110"]
