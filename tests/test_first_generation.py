"""The first generation's rules, pinned by literal examples; the greedy rule against its own order spelled out."""

import random

from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators import first_generation as V1
from twinfold.operators import rules
from twinfold.operators.survivors import greedy_losers, leading, reject_in_groups, settled
from twinfold.sources import ingest, legacy


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r["x"] for r in rows.select("k", make(F.col("v")).alias("x")).orderBy("k").collect()]


def test_names(spark):
    camera = {"IMG_1.jpg": 1, "img_12.JPG": 1, "IMG_E1.jpg": 0, "IMG_1a.jpg": 0, "DSC1.jpg": 1, "DSC_1.jpg": 1, "DSCN1.jpg": 1, "DSCF1.jpg": 0, "P1234567.jpg": 1, "P123456.jpg": 0, "20080510_0015.jpg": 1, "20080510-0015.jpg": 0, "cat_1.jpg": 0, "MVI_1.avi": 0}
    assert column(spark, list(camera), X.is_camera_name) == [bool(v) for v in camera.values()]
    generated = {"IMG_1.jpg": 1, "IMG_E1.jpg": 1, "IMG_E.jpg": 0, "DSCF1.jpg": 0, "20080510-0015.jpg": 1, "photo-2008-05-10 x.jpg": 1, "photo-2008.jpg": 0, "thumb_cat.jpg": 1, "cat_1024.jpg": 1, "cat_1024b.jpg": 0, "Screen Shot 1.png": 0, "cat.jpg": 0}
    assert column(spark, list(generated), X.is_generated_name) == [bool(v) for v in generated.values()]


def test_bases(spark):
    names = ["/a/thumb_IMG_E123_1024.jpg", "/a/IMG_Ex.jpg", "/a/!cid_my-cat  pic.png", "/a/THUMB_!cid_x.jpg", "/a/cat_512.jpg", "/a/cat_thumb.jpg"]
    assert column(spark, names, X.derivative_base) == ["IMG 123", "IMG EX", "MY CAT PIC", "X", "CAT 512", "CAT THUMB"]
    assert column(spark, names, X.marked_base) == ["IMG_E123", "IMG_EX", "!CID_MY-CAT  PIC", "!CID_X", "CAT_512", "CAT_THUMB"]
    assert column(spark, names, X.collision_base) == ["IMG_E123", "IMG_EX", "!CID_MY-CAT  PIC", "!CID_X", "CAT", "CAT"]


def test_scores(spark):
    cases = [
        ("/x/cat.jpg", 300, 300, None, None, 50),
        ("/x/cat.jpg", 300, 300, "", "", 50),
        ("/x/cat.jpg", 300, 300, None, "M", 90),
        ("/x/IMG_1.jpg", 300, 300, None, None, 70),
        ("/x/P1001.jpg", 300, 300, None, None, 70),
        ("/x/P2001.jpg", 300, 300, None, None, 50),
        ("/x/Photo on.jpg", 300, 300, None, None, 50),
        ("/my pictures/cat.jpg", 800, 800, None, None, 80),
        ("/pictures2/cat.jpg", 300, 300, None, None, 50),
        ("/x/thumb_cat.jpg", 300, 300, None, None, 35),
        ("/x/.Trash-1/cat.jpg", 300, 300, None, None, 30),
        ("/x/trash/cat.jpg", 300, 300, None, None, 50),
        ("/icons/template.jpg", 300, 300, None, None, 30),
        ("/x/cat.jpg", 199, 300, None, None, 30),
        ("/x/cat.jpg", None, None, None, None, 30),
        ("/x/cache/sample/thumb_1.jpg", 10, 10, None, None, 0),
        ("/dcim/IMG_1.jpg", 900, 900, "Canon", "M", 100),
    ]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, path string, w int, h int, make string, model string, want int")
    p = F.col("path")
    got = [r["x"] for r in rows.select("k", X.legacy_confidence(p, F.col("w"), F.col("h"), F.col("make"), F.col("model"), legacy.is_thumbnail_legacy(p)).alias("x")).orderBy("k").collect()]
    assert got == [c[-1] for c in cases]
    assert column(spark, [70, 69, 40, 39], X.bucket_folder, "int") == ["high_confidence", "medium_confidence", "medium_confidence", "low_confidence"]
    plan = legacy.bucket_plan(spark.createDataFrame([("a", "/x/Cat.JPG", 75), ("b", "/x/cat", 10)], "id string, path string, score int")).collect()
    assert [r["dest"] for r in plan] == ["images/high_confidence/a.JPG", "images/low_confidence/b.jpg"]


def test_thumbnails_and_dates(spark):
    thumbs = {"/a/Thumbnails/x.jpg": 1, "/a/Thumbnail/x.jpg": 0, "/a/previews/x.jpg": 1, "/a/thumb/x.jpg": 1, "/a/thumbs/x.jpg": 0, "/a/.cache/x.jpg": 1, "/a/thumb_x.jpg": 1, "/a/x_thumbnail.jpg": 1, "/a/x_1024.jpg": 1, "/a/x_512.png": 1, "/a/x_10240.jpg": 0, "/a/mythumb.jpg": 0}
    assert column(spark, list(thumbs), legacy.is_thumbnail_legacy) == [bool(v) for v in thumbs.values()]
    dates = {
        "IMG_20231225_123456.jpg": "2023-12-25T12:34:56", "20231225123456.jpg": "2023-12-25T12:34:56", "IMG_20231225.jpg": "2023-12-25T00:00:00", "2023-12-25_x.jpg": "2023-12-25T00:00:00", "2023.12.25.jpg": None, "2023_12_25.jpg": None,
        "20231225_253456.jpg": "2023-12-25T00:00:00", "20230230.jpg": None, "19891225.jpg": None, "20310101.jpg": None, "x19891225_20011225.jpg": None, "20231301 2023-12-25.jpg": "2023-12-25T00:00:00",
    }
    assert column(spark, list(dates), legacy.legacy_filename_date) == list(dates.values())


def test_markers(spark):
    path = "/A/Thumbnails/My Cache/x/thumb_IMG_1024.jpg"
    assert column(spark, [path], X.path_keywords) == [["Thumbnails", "My Cache", "thumb_IMG_1024.jpg"]]
    assert column(spark, [path, "/a/Img_1.jpg", "/a/x_img_1.jpg"], X.name_prefixes) == [["thumb_"], ["img_"], []]
    assert column(spark, [path, "/a/x_12.jpg", "/a/x_123.jpg", "/a/x_Small.jpg", "/a/x_THUMB.jpg", "/a/x_12345.jpg"], X.name_suffixes) == [["_1024"], [], ["_123"], ["_small"], ["_thumb"], []]


def test_categories(spark):
    cases = [
        ("/a/MINECRAFT/HUE Animation/x.jpg", 10, 10, False, "minecraft"),
        ("/a/iChat Icons/x.jpg", 10, 10, True, "ichat_icons"),
        ("/a/Skype/x.jpg", 100, 100, False, None),
        ("/a/x.jpg", 10, 10, True, "web_page_asset"),
        ("/a/x_face0.jpg", 500, 500, False, "face_detection"),
        ("/a/x_face0.jpg", 501, 500, False, None),
        ("/a/x_face10.jpg", 500, 500, False, "face_detection_10plus"),
        ("/a/x_face09.jpg", 500, 500, False, None),
        ("/a/x_face1.png", 500, 500, False, None),
        ("/FlipShare Data/Previews/x.jpg", 10, 10, False, "flipshare_previews"),
        ("/a/x.jpg", 50, 100, False, "tiny_icons"),
        ("/modelresources/x.jpg", 200, 210, False, "face_detection_modelresources"),
        ("/modelresources/x.jpg", 200, 211, False, None),
        ("/modelresources/x.jpg", 201, 201, False, None),
        ("/.Trash-1/x.jpg", 900, 900, False, "trash"),
        ("/a/x.jpg", None, None, False, None),
    ]
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, source_path string, width int, height int, companion boolean, want string")
    assert [r["x"] for r in rows.select("k", rules.legacy_category().alias("x")).orderBy("k").collect()] == [c[-1] for c in cases]


MEMBERS = "id string, group_id int, paths array<string>, width int, height int, file_size int, content_md5 string, quality_score long"


def test_rejections(spark):
    small, large = (100, 100, 5), (900, 900, 9)
    cases = [  # group, path, (width, height, bytes), content, reason
        (1, "/a/thumb_x.jpg", small, "c", "thumbnail_with_master"), (1, "/a/x.jpg", large, "d", None), (1, "/a/y.jpg", small, "e", None),
        (2, "/l/a.photolibrary/x.jpg", large, "c", "iphoto_duplicate_of_photos"), (2, "/l/a.photoslibrary/x.jpg", large, "d", None), (2, "/l/b.photolibrary/x.jpg", (800, 900, 9), "d", None),
        (3, "/Photo Booth Library/Pictures/x.jpg", large, "c", "photobooth_filtered"), (3, "/Photo Booth Library/Originals/x.jpg", large, "c", None),
        (4, "/modelresources/x.jpg", (500, 455, 5), "c", "face_thumbnail"), (4, "/modelresources/y.jpg", (501, 500, 5), "c", None), (4, "/modelresources/z.jpg", (500, 400, 5), "c", None),
        (5, "/Thumbnails/024_1024.jpg", large, "c", "stock_image"), (5, "/Thumbnails/0245.jpg", large, "c", None), (5, "/a/024.jpg", large, "c", None),
        (6, "/20121223-175144/x.jpg", large, "c", "flag_icon"),
        (7, "/Thumbnails/x.jpg", small, "c", "smaller_thumbnail"), (7, "/a/thumb_x.jpg", large, "c", None),
        (8, "/a/x.jpg", small, "c", "tiny_with_large"), (8, "/b/x.jpg", (900, 500, 5), "c", None), (8, "/c/x.jpg", (300, 300, 5), "e", None),
        (9, "/Previews/x.jpg", large, "c", None), (9, "/a/x.png", (900, 900, 99), "d", None), (9, "/Previews/X.png", large, "e", "preview_with_original"),
        (10, "/a/IMG_1.jpg", large, "c", None), (10, "/a/IMG_E1.jpg", large, "c", None), (10, "/b/IMG_1.jpg", large, "d", None),
    ]
    rows = [(f"{k:02d}", g, [p], w, h, size, md5, 0) for k, (g, p, (w, h, size), md5, _) in enumerate(cases)]
    got = {r["photo_id"]: r["reason"] for r in V1.legacy_rejections(spark.createDataFrame(rows, MEMBERS)).collect()}
    want = {f"{k:02d}": c[-1] for k, c in enumerate(cases) if c[-1]}
    # IMG_E1 has the base of IMG_1 but no camera's name, so of two equal pictures the camera's goes.
    want["23"] = "pixel_duplicate"
    assert got == want


def test_marking(spark):
    cases = [  # group, path, width, height, bytes, quality -> keeper, mode, rejected
        (1, "/a/x.jpg", 900, 900, 9, 10, (True, "full", False)), (1, "/a/thumb_x.jpg", 300, 300, 5, 5, (False, "full", True)),
        (2, "/a/x.jpg", 900, 900, 9, 10, (True, "manual", False)), (2, "/b/x.jpg", 900, 900, 9, 9, (True, "manual", False)),
        (3, "/a/x.jpg", 900, 900, 9, 10, (True, "partial", False)), (3, "/Thumbnails/x.jpg", 300, 300, 5, 5, (False, "partial", True)), (3, "/a/y.jpg", 500, 500, 9, 7, (True, "partial", False)),
        (4, "/a.photolibrary/x.jpg", 900, 900, 99, 10, (False, "manual", False)), (4, "/a.photoslibrary/x.jpg", 900, 900, 9, 9, (True, "manual", False)), (4, "/b/x.jpg", 700, 700, 5, 8, (False, "manual", False)),
    ]
    rows = [(f"{k:02d}", g, [p], w, h, size, "", q) for k, (g, p, w, h, size, q, _) in enumerate(cases)]
    got = {r["photo_id"]: (r["keeper"], r["mode"], r["rejected"]) for r in V1.marked_derivatives(spark.createDataFrame(rows, MEMBERS)).collect()}
    assert got == {f"{k:02d}": c[-1] for k, c in enumerate(cases)}


def test_greedy_order():
    rng = random.Random(7)
    for _ in range(2000):
        n = rng.randrange(2, 9)
        worth = {k: rng.randrange(4) * 10 + k for k in range(n)}
        same = {(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}
        lost = []
        for a in range(n):
            if a in lost:
                continue
            for b in range(a + 1, n):
                if (a, b) in same and b not in lost:
                    lost.append(max(a, b, key=worth.get))
        assert sorted(greedy_losers([(a, b, worth[a] > worth[b]) for a, b in sorted(same)])) == sorted(set(lost))


def test_same_resolution_rule(spark):
    rng = random.Random(9)
    rows, want, at = [], set(), 0
    for g in range(30):
        members = [(f"{at + k:03d}", g, 1 << rng.randrange(6), rng.choice((0, 0, 1)), rng.choice((100, 95)), rng.randrange(3)) for k in range(rng.randrange(1, 7))]
        at += len(members)
        rows += [(i, g, ["/a/x.jpg"], w, 10, size, p, d, 0) for i, g, p, d, w, size in members]
        dist = lambda x, y: (x ^ y).bit_count()
        lost = []
        for k, a in enumerate(members):
            if a[0] in lost:
                continue
            for b in members[k + 1 :]:
                if b[0] not in lost and a[4] == b[4] and (dist(a[2], b[2]) <= 2 or dist(a[2], b[2]) <= 6 and a[3] == b[3]):
                    lost.append(max(a, b, key=lambda m: (-m[5], m[0]))[0])
        want |= set(lost)
    df = spark.createDataFrame(rows, "id string, group_id int, paths array<string>, width int, height int, file_size int, phash long, dhash long, x int")
    found = [(r["photo_id"], r["rule_name"]) for r in reject_in_groups(df).collect()]
    assert sorted(found) == sorted((i, "SAME_RES_DUPLICATE") for i in want)


def test_settling_in_rounds_is_the_greedy_order(spark):
    rng = random.Random(17)
    pairs, want, at = [], set(), 0
    for _ in range(1500):
        n = rng.randrange(2, 9)
        worth = {k: rng.randrange(4) * 10 + k for k in range(n)}
        mine = sorted((f"{at + a:05d}", f"{at + b:05d}", worth[a] > worth[b]) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.6)
        at += n
        pairs += mine
        want |= set(greedy_losers(mine))
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "one string, two string, one_is_worse boolean").repartition(4)
    for most in (200_000, 6, 0):  # all in tasks, some, none
        found = [r["id"] for r in settled(df, most).collect()]
        assert len(found) == len(set(found)) and set(found) == want, most
    assert settled(df.limit(0), 0).count() == 0


def test_leading_over_several_tasks(spark):
    rng = random.Random(3)
    rows = [(f"{k:04d}", rng.choice("aab"), rng.randrange(5000)) for k in range(2000)]
    least, want = {}, {}
    for i, key, worth in rows:
        want[i] = worth < least.get(key, 10**9)
        least[key] = min(worth, least.get(key, 10**9))
    got = {r["id"]: r["leads"] for r in leading(spark.createDataFrame(rows, "id string, key string, worth int"), ["key"]).collect()}
    assert got == want and 0 < sum(want.values()) < 100


def test_equal_hashes_in_one_group(spark):
    """Copies by hash in a large group: as greedy over all pairs, and with no more pairs than leaders."""
    rng = random.Random(4)
    members = [(f"{k:04d}", rng.choice((5, 5, 5, 4, 1 << 40, 3 << 40)), rng.choice((1, 1, 2)), rng.randrange(40)) for k in range(700)]
    same = lambda a, b: (a[1] ^ b[1]).bit_count() <= 2 or (a[1] ^ b[1]).bit_count() <= 6 and a[2] == b[2]
    pairs = [(a[0], b[0], (-a[3], a[0]) > (-b[3], b[0])) for k, a in enumerate(members) for b in members[k + 1 :] if same(a, b)]
    df = spark.createDataFrame([(i, 1, ["/a/x.jpg"], 10, 10, size, p, d) for i, p, d, size in members], "id string, group_id int, paths array<string>, width int, height int, file_size int, phash long, dhash long")
    for most in (0, 10**6):
        found = [r["photo_id"] for r in reject_in_groups(df, task_pairs=most).collect()]
        assert sorted(found) == sorted(greedy_losers(sorted(pairs)))


def test_imported_hashes_stay_one_row_each(spark):
    photos = spark.createDataFrame([("a", None), ("b", "own")], "id string, perceptual_hash string")
    other = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", None), ("b", "3")], "id string, perceptual_hash string")
    assert sorted(map(tuple, ingest.import_hashes(photos, other).collect())) == [("a", "1"), ("b", "own")]
