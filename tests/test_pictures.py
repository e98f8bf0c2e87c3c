"""Sizes, EXIF blocks, rasters and hashes of generated pictures."""

import random
import struct
import zlib

import numpy as np
import pytest

from twinfold.operators import rules
from twinfold.sources import ingest, legacy, pictures, rasters
from twinfold.sources.pictures import exif_block, exif_entries, picture_size


def tiff(entries, order="<", more=b""):
    """A TIFF of one directory: tag -> (type, count, value bytes of up to 4)."""
    body = struct.pack(order + "H", len(entries)) + b"".join(struct.pack(order + "HHI", t, k, n) + v.ljust(4, b"\x00") for t, (k, n, v) in sorted(entries.items())) + b"\x00" * 4
    return (b"II*\x00" if order == "<" else b"MM\x00*") + struct.pack(order + "I", 8) + body + more


def camera(make=b"Ab\x00"):
    return tiff({0x010F: (2, len(make), make), 0x0112: (3, 1, struct.pack("<H", 6))})


def jpeg(w, h, sof=0xC0, exif=None, fill=b""):
    app = b"\xff\xe1" + struct.pack(">H", 8 + len(exif)) + b"Exif\x00\x00" + exif if exif else b""
    tables = b"\xff\xdb" + struct.pack(">H", 67) + b"\x00" * 65 + b"\xff\xc4" + struct.pack(">H", 4) + b"\xff\xc0"
    return b"\xff\xd8" + b"\xff\xe0\x00\x10JFIF" + b"\x00" * 10 + app + tables + fill + b"\xff" + bytes([sof]) + struct.pack(">HBHH", 11, 8, h, w) + b"\x01\x01\x11\x00" + b"\xff\xda\x00\x02data\xff\xd9"


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(pixels, color=2, depth=8, filters=None, palette=None, exif=None, interlaced=False):
    """pixels: (h, w, channels) samples."""
    h, w, c = pixels.shape
    step = max(1, c * depth // 8)

    def packed(part):
        lines = []
        for row in part.reshape(part.shape[0], -1):
            if depth == 16:
                lines.append(b"".join(bytes([int(v), 77]) for v in row))
            elif depth == 8:
                lines.append(bytes(row.astype(np.uint8)))
            else:
                bits = "".join(format(int(v), f"0{depth}b") for v in row)
                lines.append(bytes(int(bits[k : k + 8].ljust(8, "0"), 2) for k in range(0, len(bits), 8)))
        out, above = b"", bytes(len(lines[0])) if lines else b""
        for n, line in enumerate(lines):
            kind = (filters or [0])[n % len(filters or [0])]
            left = bytes(step) + line[:-step] if step < len(line) else bytes(len(line))
            corner = (bytes(step) + above)[: len(line)]
            done = []
            for x, a, b, q in zip(line, left, above, corner):
                p = a + b - q
                paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - q), 2, q))[2]
                done.append((x - [0, a, b, (a + b) // 2, paeth][kind]) & 255)
            out, above = out + bytes([kind]) + bytes(done), line
        return out

    passes = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)] if interlaced else [(0, 0, 1, 1)]
    raw = b"".join(packed(pixels[y::dy, x::dx]) for x, y, dx, dy in passes if pixels[y::dy, x::dx].size)
    data = zlib.compress(raw)
    head = struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, int(interlaced))
    parts = [chunk(b"IHDR", head)] + ([chunk(b"PLTE", palette.astype(np.uint8).tobytes())] if palette is not None else []) + ([chunk(b"eXIf", exif)] if exif else [])
    return b"\x89PNG\r\n\x1a\n" + b"".join(parts) + chunk(b"IDAT", data[:20]) + chunk(b"IDAT", data[20:]) + chunk(b"IEND", b"")


def bmp(pixels, top_down=False):
    h, w, _ = pixels.shape
    rows = pixels[:, :, ::-1] if top_down else pixels[::-1, :, ::-1]
    line = -(-w * 3 // 4) * 4
    data = b"".join(r.astype(np.uint8).tobytes().ljust(line, b"\x00") for r in rows)
    return b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, -h if top_down else h, 1, 24, 0, len(data), 0, 0, 0, 0) + data


def gif(indices, palette, interlaced=False):
    """Packed with literal codes and a clear code before the table grows."""
    h, w = indices.shape
    order = [r for a, b in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(a, h, b)] if interlaced else range(h)
    codes = []
    for k, v in enumerate(int(x) for r in order for x in indices[r]):
        codes += [256, v] if k % 200 == 0 else [v]
    bits = "".join(format(c, "09b")[::-1] for c in [*codes, 257])
    packed = bytes(int(bits[k : k + 8][::-1], 2) for k in range(0, len(bits), 8))
    blocks = b"".join(bytes([len(packed[k : k + 255])]) + packed[k : k + 255] for k in range(0, len(packed), 255))
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0xF7, 0, 0) + palette.astype(np.uint8).tobytes() + b"\x21\xfe\x03abc\x00" + b"\x2c" + struct.pack("<HHHHB", 0, 0, w, h, 0x40 * interlaced) + b"\x08" + blocks + b"\x00;"


def riff(*chunks):
    body = b"WEBP" + b"".join(k + struct.pack("<I", len(d)) + d + b"\x00" * (len(d) % 2) for k, d in chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def box(kind, data):
    return struct.pack(">I", 8 + len(data)) + kind + data


def heic(w, h, turned=0, exif=None):
    ispe = lambda w, h: box(b"ispe", b"\x00" * 4 + struct.pack(">II", w, h))
    ipco = box(b"ipco", ispe(512, 512) + ispe(w, h) + ispe(9999, 9999) + box(b"irot", bytes([turned])))
    ipma = box(b"ipma", b"\x00" * 4 + struct.pack(">IHBBB", 2, 1, 1, 0x81, 0) [:8] + struct.pack(">HBBB", 7, 2, 0x82, 4))
    infe = lambda n, kind: box(b"infe", b"\x02\x00\x00\x00" + struct.pack(">HH", n, 0) + kind + b"\x00")
    iinf = box(b"iinf", b"\x00" * 4 + struct.pack(">H", 2) + infe(7, b"hvc1") + infe(8, b"Exif"))
    ftyp = box(b"ftyp", b"heic\x00\x00\x00\x00heic")
    data = b"\x00\x00\x00\x06Exif\x00\x00" + (exif or b"")

    def meta(at):
        iloc = box(b"iloc", b"\x00" * 4 + b"\x44\x00" + struct.pack(">H", 1) + struct.pack(">HHHII", 8, 0, 1, at, len(data)))
        return box(b"meta", b"\x00" * 4 + box(b"pitm", b"\x00" * 4 + struct.pack(">H", 7)) + (iinf + iloc if exif else b"") + box(b"iprp", ipco + ipma))

    start = len(ftyp) + len(meta(0)) + 8
    return ftyp + meta(start) + box(b"mdat", data)


def vp8(w, h):
    return b"\x10\x00\x00\x9d\x01\x2a" + struct.pack("<HH", w | 0x4000, h)


def samples(h, w, c, seed=1, top=256):
    return np.random.default_rng(seed).integers(0, top, (h, w, c)).astype(np.uint8)


def sized():
    colours = samples(256, 1, 3)[:, 0]
    sizes = {0x0100: (3, 1, struct.pack("<H", 640)), 0x0101: (4, 1, struct.pack("<I", 70_000))}
    vp8l = b"\x2f" + struct.pack("<I", (800 - 1) | (600 - 1) << 14)
    vp8x = b"\x08\x00\x00\x00" + (5000 - 1).to_bytes(3, "little") + (4000 - 1).to_bytes(3, "little")
    return {
        "jpeg": (jpeg(4000, 3000), (4000, 3000)), "progressive": (jpeg(12, 34, 0xC2, camera(), b"\xff" * 9), (12, 34)), "png": (png(samples(3, 5, 3)), (5, 3)), "gif": (gif(samples(4, 6, 1)[:, :, 0], colours), (6, 4)),
        "bmp": (bmp(samples(3, 7, 3)), (7, 3)), "down": (bmp(samples(3, 7, 3), True), (7, 3)), "core": (b"BM" + b"\x00" * 12 + struct.pack("<IHHHH", 12, 21, 22, 1, 24), (21, 22)),
        "tiff": (tiff(sizes), (640, 70_000)), "big endian": (tiff({0x0100: (3, 1, b"\x01\x00"), 0x0101: (3, 1, b"\x00\x09")}, ">"), (256, 9)),
        "lossy": (riff((b"VP8 ", vp8(1234, 567) + b"x")), (1234, 567)), "lossless": (riff((b"VP8L", vp8l + b"xyz")), (800, 600)), "extended": (riff((b"VP8X", vp8x), (b"EXIF", camera())), (5000, 4000)),
        "heic": (heic(4032, 3024), (4032, 3024)), "turned": (heic(4032, 3024, 1, camera()), (3024, 4032)),
    }


def test_sizes_of_all_types():
    for name, (data, size) in sized().items():
        assert picture_size(data) == size, name


def test_cut_off_and_lying_headers():
    """Every prefix, and every place overwritten, gives a size or nothing, never an error; what is cut before its size gives nothing."""
    rng = random.Random(2)
    for data, size in sized().values():
        for n in range(len(data)):
            assert picture_size(data[:n]) in (None, size)
            assert rasters.raster(data[:n]) is None or picture_size(data[:n]) == size
        for _ in range(300):
            broken = bytearray(data)
            for _ in range(rng.randrange(1, 4)):
                broken[rng.randrange(len(broken))] = rng.choice([0, 1, 127, 128, 255])
            found = picture_size(bytes(broken))
            assert found is None or min(found) > 0 or data[:4] == b"\x89PNG" and rasters.raster(bytes(broken)) is None
            exif_entries(bytes(broken))
    assert picture_size(jpeg(0, 5)) is None and picture_size(b"") is None
    assert picture_size(b"\xff\xd8\xff\xe0\xff\xff" + jpeg(5, 5)[2:]) is None  # a segment beyond the end


def test_exif_in_every_container():
    for data in (jpeg(3, 3, exif=camera()), png(samples(2, 2, 3), exif=camera()), riff((b"VP8 ", vp8(3, 3)), (b"EXIF", b"Exif\x00\x00" + camera())), heic(5, 6, 0, camera()), camera()):
        assert ingest.tiff_tags(data) == {"exif_make": "Ab"} and exif_entries(data)[pictures.ORIENTATION_TAG] == 6
    assert exif_block(png(samples(2, 2, 3))) == exif_block(heic(5, 6)) == exif_block(b"x") == b""
    assert ingest.tiff_tags(tiff({0x010F: (2, 3, b"  \x00")})) == {"exif_make": ""}  # blanks only are an empty text, no null


def test_described_pictures_pass_the_rules(spark):
    kinds = sized()
    files = spark.createDataFrame([(f"/in/{k}", k, None, len(d), bytearray(d)) for k, (d, _) in kinds.items()], "source_path string, filename string, mtime timestamp, file_size long, content binary")
    rows = ingest.describe_files(files)
    got = {r["filename"]: (r["width"], r["height"]) for r in rows.collect()}
    assert got == {k: size for k, (_, size) in kinds.items()}
    paths = ingest.numbered_paths(rows)
    decided = {r["photo_id"]: r["rule_name"] for r in rules.decide(ingest.photos_of(rows), paths, paths.selectExpr("source_path AS path")).collect()}
    by_name = {r["filename"]: r["id"] for r in rows.collect()}
    assert by_name["jpeg"] not in decided and by_name["heic"] not in decided and decided[by_name["png"]] == "TINY_ICON"


@pytest.mark.parametrize("interlaced", [False, True])
def test_png_rasters(interlaced):
    colours = samples(256, 1, 3, 4)[:, 0]
    for color, channels in ((0, 1), (2, 3), (4, 2), (6, 4)):
        p = samples(11, 13, channels, channels)
        for depth in (8, 16):
            assert np.array_equal(rasters.raster(png(p, color, depth, [0, 1, 2, 3, 4], interlaced=interlaced)), p)
    for depth in (1, 2, 4, 8):
        p = samples(9, 10, 1, depth, 2**depth)
        assert np.array_equal(rasters.raster(png(p, 3, depth, [4, 2], palette=colours[: 2**depth], interlaced=interlaced)), colours[p[:, :, 0]])
        assert np.array_equal(rasters.raster(png(p, 0, depth, [1], interlaced=interlaced)), p * (255 // (2**depth - 1)))


def test_gif_and_bmp_rasters():
    p, colours = samples(17, 23, 1)[:, :, 0], samples(256, 1, 3, 4)[:, 0]
    for interlaced in (False, True):
        assert np.array_equal(rasters.raster(gif(p, colours, interlaced)), colours[p])
    q = samples(5, 7, 3)
    assert np.array_equal(rasters.raster(bmp(q)), q) and np.array_equal(rasters.raster(bmp(q, True)), q)
    # Codes that name the entry being made, and codes that grow.
    line = np.zeros((1, 3000), np.uint8)
    packed, bits, size, code = 0, 0, 9, 258
    for c in [256, 0]:
        packed, bits = packed | c << bits, bits + size
    total, run = 1, 1
    while total < 3000:
        packed, bits, run = packed | code << bits, bits + size, run + 1
        total, code = total + run, code + 1
        size += code == 1 << size
    data = packed.to_bytes(-(-bits // 8), "little")
    assert np.array_equal(rasters._lzw(data, 8, 3000), line[0])


def slow_dct(block):
    n = len(block)
    return np.array([[sum(block[y, x] * 4 * np.cos(np.pi * v * (2 * y + 1) / (2 * n)) * np.cos(np.pi * u * (2 * x + 1) / (2 * n)) for y in range(n) for x in range(n)) for u in range(8)] for v in range(8)])


def test_hashes_against_brute_force():
    rng = np.random.default_rng(7)
    smooth = np.clip(np.add.outer(np.arange(32) * 3, np.arange(32) * 4) + rng.integers(0, 30, (32, 32)), 0, 255).astype(np.uint8)
    low = slow_dct(smooth.astype(float))
    bits = "".join("1" if v else "0" for v in (low > np.median(low)).ravel())
    assert rasters.phash(smooth) == f"{int(bits, 2):016x}"
    edges = rng.integers(0, 256, (8, 9)).astype(np.uint8)
    bits = "".join("1" if edges[y, x + 1] > edges[y, x] else "0" for y in range(8) for x in range(8))
    assert rasters.dhash(edges) == f"{int(bits, 2):016x}"
    assert len(rasters.phash(smooth, 16)) == 64
    # A flat picture stays flat in any size, and the weights of each pixel add up to one, but for rounding.
    assert (rasters.resized(np.full((50, 70), 93, np.uint8), 9, 8) == 93).all()
    assert abs(rasters.lanczos(777, 32).sum(axis=1) - (1 << 22)).max() < 400
    # Other formats of one picture, and one that EXIF turns, hash alike.
    p = np.repeat(smooth[:, :, None], 3, axis=2)
    p[:, :16, 0] //= 2
    turned = png(np.ascontiguousarray(np.rot90(p, 1)), exif=tiff({0x0112: (3, 1, struct.pack("<H", 6))}))
    assert rasters.picture_hashes(png(p)) == rasters.picture_hashes(bmp(p)) == rasters.picture_hashes(turned)
    for n in range(2, 9):
        assert rasters.upright(p, n).shape == p.shape
    a = np.arange(6).reshape(2, 3, 1)
    assert rasters.upright(a, 6)[:, :, 0].tolist() == [[3, 0], [4, 1], [5, 2]] and rasters.upright(a, 8)[:, :, 0].tolist() == [[2, 5], [1, 4], [0, 3]]


def test_colour_hash():
    red, black, white = np.zeros((4, 4, 3), np.uint8), np.zeros((4, 4, 3), np.uint8), np.full((4, 4, 3), 255, np.uint8)
    red[:, :, 0] = 255
    shares = lambda *values: f"{int(''.join(format(v, '03b') for v in values), 2):011x}"
    assert rasters.colorhash(black) == shares(7, *[0] * 13)
    assert rasters.colorhash(white) == shares(0, 7, *[0] * 12)
    assert rasters.colorhash(red) == shares(0, 0, *[0] * 6, 7, *[0] * 5)
    assert rasters.colorhash(np.concatenate([red, black])) == shares(4, 0, *[0] * 6, 7, *[0] * 5)


def test_same_pictures(spark):
    p = samples(6, 8, 3)
    other = p.copy()
    other[0, 0, 0] ^= 1
    files = {"a": png(p), "b": bmp(p), "c": png(p, filters=[4]), "d": bmp(other), "e": jpeg(8, 6), "f": png(p)[:60], "g": png(np.ascontiguousarray(p.reshape(8, 6, 3)))}
    rows = ingest.picture_hashes(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()] + [("n", None)], "id string, content binary"))
    assert sorted(map(tuple, legacy.same_pictures(rows).collect())) == [("a", "b"), ("a", "c")]
    got = {r["id"]: r for r in rows.collect()}
    assert got["a"]["phash"] == got["b"]["phash"] and got["a"]["colorhash"] == got["c"]["colorhash"]
    assert all(got[k]["phash"] is None and got[k]["pixel_digest"] is None for k in "efn")


def test_pictures_of_one_header_are_hashed_together(monkeypatch):
    rng = np.random.default_rng(5)
    some = [bmp(rng.integers(0, 256, (h, 8, 3), dtype=np.uint8), down) for h in (1, 33, 400) for down in (False, True) for _ in range(20)]
    some += [png(rng.integers(0, 256, (9, 7, 3), dtype=np.uint8)), b"", b"BM", some[0][:-1], bmp(np.full((40, 8, 3), 77, np.uint8))]
    wanted = ("phash", "dhash", "phash_16", "colorhash", "pixel_digest")
    made = []
    decode = rasters._bmps
    monkeypatch.setattr(rasters, "_bmps", lambda files, *size: made.append(len(files)) or decode(files, *size))
    found = rasters.many_hashes(some, wanted)
    assert len(made) <= 2 * 8 and max(made) == 20  # 6 headers and one more, a look at the first of each
    assert found == [rasters.picture_hashes(data, wanted) for data in some]
    assert found[-2] == {} and len(found[-1]) == len(wanted)
