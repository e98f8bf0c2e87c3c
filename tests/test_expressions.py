"""Truth tables of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from twinfold.functions import dates as D
from twinfold.functions import exprs as X


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r["x"] for r in rows.select("k", build(F.col("v")).alias("x")).orderBy("k").collect()]


def test_hamming_takes_the_sign_bit(spark):
    got = column(spark, ["0000000000000000", "ffffffffffffffff", "8000000000000000", "f", None, "zz"], lambda v: X.hamming_hex(v, F.lit("0000000000000000")))
    assert got == [0, 64, 1, 4, None, None]


def test_hamming_of_wide_and_uneven_hashes(spark):
    assert column(spark, ["f" * 64, "1"], lambda v: X.hamming_hex(v, F.lit("0" * 64), 256)) == [256, 1]
    assert column(spark, [None, "xyz"], lambda v: X.hamming_hex_or(v, F.lit("0"))) == [256, 256]


@pytest.mark.parametrize(
    ("p", "yes", "no"), [(0, [0, 30, 50], []), (10, [0, 30, 50], []), (11, [0, 10, 21], [22, 30, 50]), (12, [0, 10, 21], [22, 30, 50]), (13, [0, 10, 17], [18, 25, 50]), (14, [0, 10, 17], [18, 25, 50]), (15, [], [0, 50]), (50, [], [0])]
)
def test_scene_thresholds(spark, p, yes, no):
    assert column(spark, yes + no, lambda d: X.is_same_scene(F.lit(p), d), "int") == [True] * len(yes) + [False] * len(no)


def test_pair_index_is_exact_at_row_bounds(spark):
    n = 12836
    total = n * (n - 1) // 2
    ks = [0, n - 2, n - 1, total - 1]
    i = column(spark, ks, lambda k: X.pair_from_index(k, n)[0], "long")
    j = column(spark, ks, lambda k: X.pair_from_index(k, n)[1], "long")
    assert list(zip(i, j)) == [(0, 1), (0, n - 1), (1, 2), (n - 2, n - 1)]
    pairs = column(spark, list(range(10)), lambda k: F.struct(*X.pair_from_index(k, 5)), "long")
    assert [tuple(p) for p in pairs] == [(a, b) for a in range(5) for b in range(a + 1, 5)]


def test_dates_in_file_names(spark):
    cases = {
        "IMG_20231225_123456.jpg": "2023-12-25T12:34:56",
        "20231225.jpg": "2023-12-25",
        "2023-12-25_x.jpg": "2023-12-25",
        "Screen Shot 2023-05-14 at 09.48.46.png": "2023-05-14T09:48:46",
        "20230230.jpg": None,
        "20231225_253456.jpg": "2023-12-25",
        "19891225.jpg": None,
        "20311225.jpg": None,
        "no date": None,
    }
    assert column(spark, list(cases), D.date_from_filename) == list(cases.values())


def test_dates_in_paths(spark):
    cases = {
        "/a/101122 Rose x/1.jpg": "2010-11-22",
        "/a/310101 x/1.jpg": "1931-01-01",
        "/a/April 2010/1.jpg": "2010-04",
        "/a/2010 April/1.jpg": "2010-04",
        "/a/May 08/1.jpg": "2008-05",
        "/a/Xmas 2004/1.jpg": "2004-12",
        "/a/2004/1.jpg": "2004",
        "/a/x.photolibrary/2004/1.jpg": None,
        "/a/Mayor/1.jpg": None,
    }
    got = column(spark, list(cases), D.date_from_path)
    assert got == list(cases.values())
    assert column(spark, ["2004", "2004-12", None], D.path_confidence) == ["low", "medium", None]


def test_exif_confidence(spark):
    rate = lambda v, *who: column(spark, [v], lambda c: D.exif_confidence(c, *[F.lit(x).cast("string") for x in who]))[0]
    assert rate("2012-12-31T23:00:00", "Canon", None, None) == "unusable"
    assert rate(None, "Canon", None, None) == "unusable"
    assert rate("1989-01-01T00:00:00", "Canon", None, None) == "suspect"
    assert rate("2010-01-01T00:00:00", None, "M", None) == "high"
    assert rate("2010-01-01T00:00:00", None, None, "S") == "low"
    assert rate("2010-01-01T00:00:00", None, None, None) == "medium"


def test_sort_keys_put_missing_dates_last(spark):
    assert column(spark, ["2004", "2004-12", "2004-12-25", "2004-12-25T10:00:00", "", None], D.date_sort_key) == ["2004-00-00T00:00:00", "2004-12-00T00:00:00", "2004-12-25T00:00:00", "2004-12-25T10:00:00", "9999-99-99T99:99:99", "9999-99-99T99:99:99"]


def test_names(spark):
    assert column(spark, ["/a/b.tar.gz", "/a/.hidden", "c", "/x/IMG_1_1024.JPG"], X.stem) == ["b.tar", ".hidden", "c", "IMG_1_1024"]
    assert column(spark, ["/a/thumb_IMG_1024.jpg"], X.base_name) == ["img"]
    assert column(spark, [1280, 500, 3 * 1024**2], X.file_size_text, "long") == ["1.2 KB", "500.0 B", "3.0 MB"]
