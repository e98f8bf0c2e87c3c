"""Files in, plans and small tables out."""

import hashlib
import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators import curate, fusion, rules
from twinfold.plans.fixtures import catalog
from twinfold.sources import ingest, legacy


def tiff(make: bytes, original: bytes) -> bytes:
    """A little-endian TIFF with Make in its first directory and DateTimeOriginal in its EXIF directory."""
    head = b"II*\x00" + struct.pack("<I", 8)
    first = struct.pack("<H", 2) + struct.pack("<HHII", 0x010F, 2, len(make), 100) + struct.pack("<HHII", 0x8769, 4, 1, 50) + b"\x00" * 4
    second = struct.pack("<H", 1) + struct.pack("<HHII", 0x9003, 2, len(original), 120) + b"\x00" * 4
    data = bytearray(160)
    data[: len(head)], data[8 : 8 + len(first)], data[50 : 50 + len(second)] = head, first, second
    data[100 : 100 + len(make)], data[120 : 120 + len(original)] = make, original
    return bytes(data)


@pytest.fixture
def tree(tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 640, 480) + b"\x08\x02"
    gif = b"GIF89a" + struct.pack("<HH", 32, 16)
    exif = b"\xff\xd8\xff\xe1\x00\x10Exif\x00\x00" + tiff(b"Canon\x00", b"2010:05:14 10:20:30\x00")
    for name, data in {"a/x.png": png, "b/copy.png": png, "c.gif": gif, "d/IMG_20040615_101112.jpg": exif, "notes.txt": b"text", "Thumbs.db": gif, "a/._x.png": png}.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return tmp_path


def test_scan_describe_and_link(spark, tree):
    files = ingest.scan_files(spark, f"file://{tree}/tree")
    rows = ingest.describe_files(files)
    got = {r["filename"]: r for r in rows.collect()}
    assert set(got) == {"x.png", "copy.png", "c.gif", "IMG_20040615_101112.jpg"}
    assert (got["x.png"]["width"], got["x.png"]["height"]) == (640, 480) and (got["c.gif"]["width"], got["c.gif"]["height"]) == (32, 16)
    assert got["x.png"]["id"] == hashlib.sha256((tree / "tree/a/x.png").read_bytes()).hexdigest() == got["copy.png"]["id"]
    photo = got["IMG_20040615_101112.jpg"]
    assert photo["exif_make"] == "Canon" and photo["exif_datetime_original"] == "2010:05:14 10:20:30" and photo["exif_model"] is None
    photos = ingest.photos_of(rows)
    assert photos.count() == 3
    paths = ingest.numbered_paths(rows)
    assert sorted(r["path_id"] for r in paths.collect()) == [1, 2, 3, 4]
    found = {(r["source_type"], r["date_value"], r["confidence"]) for r in ingest.date_sources(rows).collect() if r["source_type"] != "mtime"}
    assert found == {("exif_original", "2010-05-14T10:20:30", "high"), ("filename", "2004-06-15T10:11:12", "medium")}
    plan = ingest.link_plan(photos, paths, f"{tree}/farm")
    assert [r["done"] for r in ingest.make_links(plan).collect()] == [True] * 3
    assert [r["done"] for r in ingest.make_links(plan).collect()] == [False] * 3  # they exist
    assert os.path.exists(f"{tree}/farm/{photo['id'][:2]}/{photo['id']}.jpg")
    assert ingest.new_paths(rows, paths).count() == 0


def test_broken_exif_is_nothing():
    assert ingest.tiff_tags(b"") == ingest.tiff_tags(b"\xff\xd8\xff") == ingest.tiff_tags(b"II*\x00\xff\xff\xff\x7f") == {}


def test_json_and_tsv(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"complete": ["1,2", "3,2"], "single": ["4,5"]}))
    (tmp_path / "r.json").write_text(json.dumps({"1,2": 5, "3,4": 1}))
    assert sorted(map(tuple, legacy.read_boundaries(spark, f"file://{tmp_path}/b.json").collect())) == [("complete", "1,2"), ("complete", "3,2"), ("single", "4,5")]
    assert sorted(map(tuple, legacy.read_ratings(spark, f"file://{tmp_path}/r.json").collect())) == [(1, 2, 5), (3, 4, 1)]
    ingest.write_tsv(spark.createDataFrame([(1, None), (2, "x")], "a int, b string").coalesce(1), f"file://{tmp_path}/out")
    (part,) = [f for f in os.listdir(tmp_path / "out") if f.endswith(".csv")]
    assert (tmp_path / "out" / part).read_text() == "a\tb\n1\t\n2\tx\n"


def test_stage_ledger(spark):
    state = spark.createDataFrame([("1", 5, None)], "stage string, photo_count long, notes string")
    state = legacy.record_stage(legacy.record_stage(state, "1", 7), "2", 1, "x")
    assert sorted(map(tuple, state.collect())) == [("1", 7, None), ("2", 1, "x")]
    assert legacy.pending_stages(state, ["1", "1b", "2"]) == ["1b", "2"]


def test_rule_order_and_edges(spark):
    cases = [("t1", ["/x/tor/Pictures/2013/03/03/minecraft.png"], 100, 100, "FATHER_IN_LAW"), ("t2", ["/a/MINECRAFT/x"], 1, 1, "MINECRAFT_TEXTURE"), ("t3", ["/a/x.jpg"], 70, 71, "TINY_ICON"), ("t4", ["/a/x.jpg"], 50, 100, None), ("t5", ["/a/x.jpg"], None, None, "TINY_ICON"), ("t6", ["/l/modelresources/x.jpg"], 450, 500, "FACE_CROP"), ("t7", ["/l/modelresources/x.jpg"], 110, 100, None), ("t8", ["/l/modelresources/x.jpg"], 501, 500, None), ("t9", ["/20140223-155504/001_1024.jpg"], 900, 900, "STOCK_GREETING"), ("ta", ["/iChat Icons/x.gif"], 199, 199, "ICHAT_ICON"), ("tb", ["/iChat Icons/x.gif"], 200, 199, None)]
    photos = spark.createDataFrame([(k, p, w, h, False) for k, p, w, h, _ in cases], "id string, paths array<string>, width int, height int, companion boolean")
    every = rules.individual_rules()
    got = {r["id"]: r["m"] and r["m"]["rule_name"] for r in photos.select("id", rules.first_match(every, F.aggregate("paths", F.lit(0).cast("long"), lambda acc, p: acc.bitwiseOR(rules.path_flags(p, every)))).alias("m")).collect()}
    assert got == {c[0]: c[-1] for c in cases}


def test_prefix_dates_and_conflicts(spark):
    entities = spark.createDataFrame([("e", "p"), ("f", "q"), ("g", "r")], "entity string, photo_id string")
    turn = F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"))
    sources = spark.createDataFrame([("p", "2004", "a", "medium"), ("p", "2004-06-15", "b", "medium"), ("p", "2003-12-01", "c", "low"), ("q", "2004-05", "a", "high"), ("q", "2006-05", "b", "high")], "photo_id string, date_value string, source_type string, tier string").withColumn("turn", turn)
    got = {r["entity"]: r for r in fusion.derive(entities, sources).collect()}
    assert got["e"]["date_value"] == "2004-06-15" and not got["e"]["has_conflict"]
    assert got["f"]["has_conflict"] and got["f"]["conflict_dates"] == ["2004-05", "2006-05"] and got["f"]["date_value"] == "2004-05"
    assert got["g"]["date_value"] is None and got["g"]["has_conflict"] is False


def test_curation_errors(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "photo_id string, group_id long")
    with pytest.raises(ValueError):
        curate.split_composite(groups, 1, ["a", "b"])
    assert sorted(map(tuple, curate.split_composite(groups, 1, ["a"]).collect())) == [("c", 2)]
    with pytest.raises(ValueError):
        curate.keep_selection(groups, 1, ["c"])
    assert sorted(map(tuple, curate.merge_pairwise(groups, [(2, 1)]).collect())) == [("a", 1), ("b", 1), ("c", 1)]


def test_null_texts_in_the_catalog(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, ""), (3, "a b c"), (4, "a b c")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = catalog(spark, str(tmp_path))
    assert c.bare.count() == 2 and c.paths.count() == 4
    assert sorted((r["phash"] is None) for r in c.hashes.collect()) == [False, True]
    assert c.hashes.select(X.long_to_hex(F.col("phash")).alias("h")).filter("h is not null").first()["h"].__len__() == 16


def test_selections_are_tables_or_lists(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 2)], "photo_id string, group_id long")
    rejections = spark.createDataFrame([("a", 1, "THUMBNAIL")], "photo_id string, group_id long, rule_name string")
    log = spark.createDataFrame([], curate.LOG)
    rows = lambda df: sorted(map(tuple, df.collect()))
    for picked in (["b", "a"], spark.createDataFrame([("b",), ("a",), ("b",)], "photo_id string")):
        parts, done = curate.split(groups, log, 1, picked)
        assert rows(parts) == [("a", 3), ("b", 3), ("c", 1), ("d", 2)] and sorted(done.first()["photo_ids"]) == ["a", "b"]
        refused, done = curate.reject(rejections, done, 1, picked)
        assert rows(refused) == [("a", 1, "THUMBNAIL"), ("b", 1, "MANUAL")] and done.count() == 2
        same, accepted, left = curate.undo(parts, refused, done)
        assert rows(accepted) == rows(rejections) and rows(same) == rows(parts) and left.count() == 1
        back, _, none = curate.undo(same, accepted, left)
        assert rows(back) == rows(groups) and none.count() == 0
        assert rows(curate.keep_selection(groups, 1, picked)) == [("c", 1)]
        assert rows(curate.split_composite(groups, 1, picked)) == [("a", 3), ("b", 3), ("d", 2)]


def test_walk_finds_dotted_folders_and_trashes_are_rejected(spark, tmp_path):
    data = b"\xff\xd8\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 3000, 4000) + b"\x01\x01\x11\x00"
    names = ["a/x.jpg", ".Trashes/501/y.jpg", "_p/z.jpg", ".x.jpg", "a/b/c/d/e.jpg", "a/._x.jpg", "a/.DS_Store", "Thumbs.db", "desktop.ini", ".picasa.ini", "é ü/ñ.jpg", "empty.jpg"]
    for n in names:
        path = tmp_path / "t" / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data + n.encode() if n != "empty.jpg" else b"")
    os.symlink(tmp_path / "t/a/x.jpg", tmp_path / "t/link.jpg")
    os.symlink(tmp_path / "t", tmp_path / "t/a/loop")
    os.symlink(tmp_path / "nowhere", tmp_path / "t/broken.jpg")
    files = ingest.scan_files(spark, str(tmp_path / "t"))
    got = {r["source_path"].removeprefix(f"file:{tmp_path}/t/"): r for r in files.collect()}
    assert set(got) == {"a/x.jpg", ".Trashes/501/y.jpg", "_p/z.jpg", ".x.jpg", "a/b/c/d/e.jpg", "é ü/ñ.jpg", "empty.jpg", "link.jpg"}
    assert all(bytes(r["content"]) == (tmp_path / "t" / n).read_bytes() and r["file_size"] == len(r["content"]) and r["filename"] == n.rpartition("/")[2] for n, r in got.items())
    assert all(abs(r["mtime"].replace(tzinfo=__import__("datetime").timezone.utc).timestamp() - os.stat(tmp_path / "t" / n).st_mtime) < 1 for n, r in got.items())
    rows = ingest.describe_files(files)
    paths = ingest.numbered_paths(rows)
    decided = rules.decide(ingest.photos_of(rows), paths, paths.selectExpr("source_path AS path")).join(paths, "photo_id")
    assert [(r["filename"], r["decision"], r["rule_name"]) for r in decided.collect()] == [("y.jpg", "reject", "TRASHES")]
    assert ingest.scan_files(spark, str(tmp_path / "none")).count() == 0


def test_a_scan_without_contents_reads_none(spark, tmp_path, monkeypatch):
    from twinfold.plans import registry
    from twinfold.sources import ingest

    (tmp_path / ".dotted").mkdir()
    (tmp_path / ".dotted" / "a.bin").write_bytes(b"x" * 70)
    (tmp_path / "Thumbs.db").write_bytes(b"x")
    (tmp_path / "b.jpg").write_bytes(b"")
    columns = ["source_path", "filename", "mtime", "file_size"]
    whole = sorted(map(tuple, ingest.scan_files(spark, str(tmp_path)).select(*columns).collect()))
    bare = ingest.scan_files(spark, str(tmp_path), contents=False)
    assert bare.columns == columns and sorted(map(tuple, bare.collect())) == whole
    monkeypatch.setattr(ingest, "read_contents", None)  # would be called, and fail, if contents were read
    rows = registry.queries()["s1_s8_scanned_files"](spark, str(tmp_path)).collect()
    assert sorted((r["filename"], r["file_size"], r["timed"]) for r in rows) == [("a.bin", 70, True), ("b.jpg", 0, True)]


def test_text_hashes_hold_a_piece_of_a_batch(spark):
    """Words of a long batch are objects for a piece of it only, and hashes are those of the majority of distinct words."""
    import hashlib
    import threading

    import psutil

    from pyspark.sql import functions as F

    from twinfold.sources.ingest import text_hashes

    def wanted(text, salt):
        words = {w for w in text.lower().split(" ") if w}
        digests = [int.from_bytes(hashlib.md5((salt + w).encode()).digest()[:8], "big") for w in words]
        bits = sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(words))
        return (bits - (1 << 64) if bits >> 63 else bits) if words else None

    texts = ["", None, "  ", "One one two", " ".join(map(str, range(255))), " ".join(map(str, range(40_000))), "x", " ".join(map(str, range(700)))]
    got = {r["id"]: (r["phash"], r["dhash"]) for r in text_hashes(spark.createDataFrame(list(zip("abcdefgh", texts)), "id string, text string").coalesce(1)).collect()}
    assert got == {i: (wanted(t or "", ""), wanted(t or "", "d:")) for i, t in zip("abcdefgh", texts)}

    def resident():
        total = 0
        for p in psutil.Process().children(recursive=True):
            try:
                total = max(total, p.memory_info().rss if "python" in p.name() else 0)
            except psutil.Error:
                pass
        return total

    peak, done = [0], threading.Event()

    def watch():
        while not done.wait(0.05):
            peak[0] = max(peak[0], resident())

    watcher = threading.Thread(target=watch)
    before = resident()
    watcher.start()
    long = spark.range(0, 2000, 1, 1).select(F.col("id").cast("string").alias("id"), F.expr("array_join(transform(sequence(1, 1500), x -> concat(id, '_', x)), ' ')").alias("text"))
    assert text_hashes(long).filter("phash is not null").count() == 2000
    done.set()
    watcher.join()
    assert peak[0] - before < 400 << 20, (before, peak[0])
