"""Pictures as arrays, and their perceptual hashes: PNG, BMP and GIF; other types have no decoder and give None.

Hashes are the usual ones of 64 and 256 bits: low frequencies of the cosine transform against their median,
gradients between neighbouring pixels, and shares of dark, gray and coloured pixels. Gray values, the Lanczos
filter and hue follow the arithmetic of whole numbers that the usual picture library has.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np

from twinfold.sources.pictures import ORIENTATION_TAG, exif_entries, kind_of, little, picture_size, png_chunks

#: Pixels that are decoded at most; a header that says more is taken as a lie.
MOST_PIXELS = 200_000_000


def _unpacked(rows: np.ndarray, bits: int, count: int) -> np.ndarray:
    """count samples of 1, 2, 4 or 8 bits from each row of bytes."""
    if bits == 8:
        return rows[:, :count]
    parts = 8 // bits
    shifts = np.arange(8 - bits, -1, -bits, dtype=np.uint8)
    return ((rows[:, :, None] >> shifts) & (2**bits - 1)).reshape(len(rows), rows.shape[1] * parts)[:, :count]


def _unfiltered(raw: bytes, height: int, line: int, step: int) -> np.ndarray:
    """Rows of bytes of a PNG without its line filters."""
    rows = np.frombuffer(raw, np.uint8, height * (line + 1)).reshape(height, line + 1)
    out = np.zeros((height + 1, line + step), np.uint8)  # a row above and a pixel to the left, of zeros
    for k in range(height):
        kind, now, above = rows[k, 0], out[k + 1], out[k]
        now[step:] = rows[k, 1:]
        if kind == 1:
            pad = -line % step
            groups = np.concatenate([now[step:], np.zeros(pad, np.uint8)]).reshape(-1, step)
            now[step:] = np.cumsum(groups, axis=0, dtype=np.uint8).reshape(-1)[:line]
        elif kind == 2:
            now[step:] += above[step:]
        elif kind in (3, 4):
            mine, up = now.tolist(), above.tolist()
            for x in range(step, line + step):
                a, b, c = mine[x - step], up[x], up[x - step]
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if p[0] <= p[1] and p[0] <= p[2] else b if p[1] <= p[2] else c
                mine[x] = (mine[x] + guess) & 255
            now[:] = mine
        elif kind:
            raise ValueError("filter")
    return out[1:, step:]


#: Starts and steps of the seven passes of an interlaced PNG.
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def _png(data: bytes, width: int, height: int) -> np.ndarray:
    depth, color, interlaced = data[24], data[25], data[28]
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    packed, palette = b"", np.zeros((256, 3), np.uint8)
    parts = []
    for kind, at, end in png_chunks(data):
        if kind == b"IDAT":
            parts.append(data[at:end])
        elif kind == b"PLTE":
            palette[: (end - at) // 3] = np.frombuffer(data, np.uint8, (end - at) // 3 * 3, at).reshape(-1, 3)
    packed = b"".join(parts)
    passes = _PASSES if interlaced else ((0, 0, 1, 1),)
    shapes = [(-(-(width - x) // dx) if width > x else 0, -(-(height - y) // dy) if height > y else 0) for x, y, dx, dy in passes]
    lines = [-(-w * channels * depth // 8) for w, _ in shapes]
    total = sum((n + 1) * h for n, (w, h) in zip(lines, shapes) if w)
    raw = zlib.decompressobj().decompress(packed, total)
    samples = np.zeros((height, width, channels), np.uint8)
    at = 0
    for (x, y, dx, dy), (w, h), line in zip(passes, shapes, lines):
        if not w or not h:
            continue
        rows = _unfiltered(raw[at : at + (line + 1) * h], h, line, max(1, channels * depth // 8))
        at += (line + 1) * h
        flat = rows[:, ::2] if depth == 16 else _unpacked(rows, depth, w * channels)  # of 16 bits the high ones
        samples[y::dy, x::dx] = flat.reshape(h, w, channels)
    if color == 3:
        return palette[samples[:, :, 0]]
    return samples * np.uint8(255 // (2**depth - 1)) if depth < 8 else samples


def _bmp(data: bytes, width: int, height: int) -> np.ndarray:
    return _bmps([data], width, height)[0]


def _bmps(files: list[bytes], width: int, height: int) -> np.ndarray:
    """The pictures of files that have all before the pixels in common."""
    data = files[0]
    start, head = little(data, 10, 4), little(data, 14, 4)
    core = head == 12
    bits = little(data, 24 if core else 28, 2)
    if not core and little(data, 30, 4) not in (0, 3):
        raise ValueError("compressed")
    line = -(-width * bits // 32) * 4
    rows = np.frombuffer(b"".join([d[start : start + line * height] for d in files]), np.uint8).reshape(len(files), height, line)
    if core or little(data, 22, 4) < 2**31:
        rows = rows[:, ::-1]
    if bits >= 24:
        return rows[:, :, : width * bits // 8].reshape(len(files), height, width, bits // 8)[:, :, :, 2::-1]
    step = 3 if core else 4
    count = (start - 14 - head) // step
    palette = np.zeros((256, 3), np.uint8)
    palette[:count] = np.frombuffer(data, np.uint8, step * min(count, 256), 14 + head).reshape(-1, step)[:, 2::-1]
    flat = _unpacked(rows.reshape(len(files) * height, line), bits, width)
    return palette[flat].reshape(len(files), height, flat.shape[1], 3)


def _lzw(packed: bytes, least: int, count: int) -> np.ndarray:
    """count colours of a GIF's packed picture."""
    clear, stop = 1 << least, (1 << least) + 1
    out = bytearray()
    table: list[bytes] = []
    size, before, held, bits = least + 1, b"", 0, 0
    for byte in packed:
        held |= byte << bits
        bits += 8
        while bits >= size:
            code, held, bits = held & ((1 << size) - 1), held >> size, bits - size
            if code == clear:
                table = [bytes([k]) for k in range(clear)] + [b"", b""]
                size, before = least + 1, b""
                continue
            if code == stop or len(out) >= count:
                return np.frombuffer(bytes(out[:count]), np.uint8)
            if code < len(table):
                entry = table[code]
            elif code == len(table) and before:
                entry = before + before[:1]
            else:
                raise ValueError("code")
            out += entry
            if before and len(table) < 4096:
                table.append(before + entry[:1])
                if len(table) == 1 << size and size < 12:
                    size += 1
            before = entry
    return np.frombuffer(bytes(out[:count]), np.uint8)


def _gif(data: bytes, width: int, height: int) -> np.ndarray:
    """The first frame, on a canvas of the background's colour 0."""
    flags, at = data[10], 13
    palette = np.zeros((256, 3), np.uint8)

    def colours(at: int, flags: int) -> int:
        n = 2 << (flags & 7)
        palette[:n] = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        return at + 3 * n

    if flags & 0x80:
        at = colours(at, flags)
    while data[at] == 0x21:
        at += 2
        while data[at]:
            at += 1 + data[at]
        at += 1
    if data[at] != 0x2C:
        raise ValueError("no frame")
    x, y, w, h = (little(data, at + k, 2) for k in (1, 3, 5, 7))
    flags, at = data[at + 9], at + 10
    if flags & 0x80:
        at = colours(at, flags)
    least, at, blocks = data[at], at + 1, []
    while data[at]:
        blocks.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    frame = _lzw(b"".join(blocks), least, w * h).reshape(h, w)
    if flags & 0x40:
        order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
        frame = frame[np.argsort(order)]
    canvas = np.zeros((height, width), np.uint8)
    canvas[y : y + h, x : x + w] = frame[: max(0, height - y), : max(0, width - x)]
    return palette[canvas]


def raster(data: bytes) -> np.ndarray | None:
    """Rows of pixels of 1 (gray), 2 (gray, alpha), 3 or 4 bytes, before EXIF turns them. None where that can't be had."""
    read = {"png": _png, "bmp": _bmp, "gif": _gif}.get(kind_of(data))
    size = picture_size(data)
    if read is None or size is None or not 0 < size[0] * size[1] <= MOST_PIXELS:
        return None
    try:
        return np.ascontiguousarray(read(data, *size))
    except (IndexError, KeyError, ValueError, zlib.error):
        return None


def upright(picture: np.ndarray, orientation: int) -> np.ndarray:
    """The picture as EXIF's orientation (1 to 8) turns it."""
    turned = {2: lambda p: p[:, ::-1], 3: lambda p: p[::-1, ::-1], 4: lambda p: p[::-1], 5: lambda p: p.swapaxes(0, 1), 6: lambda p: p.swapaxes(0, 1)[:, ::-1], 7: lambda p: p.swapaxes(0, 1)[::-1, ::-1], 8: lambda p: p.swapaxes(0, 1)[::-1]}
    return turned.get(orientation, lambda p: p)(picture)


def gray(picture: np.ndarray) -> np.ndarray:
    """One byte a pixel: the usual weights of red, green and blue, in 16-bit fractions; alpha is left out. Pixels are the last axis."""
    if picture.shape[-1] < 3:
        return picture[..., 0]
    r, g, b = (picture[..., k].astype(np.uint32) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


@functools.lru_cache(maxsize=16)
def lanczos(size: int, target: int) -> np.ndarray:
    """Weights (target, size) of the Lanczos filter over three lobes, in fractions of 2^-22."""
    scale = size / target
    reach = 3.0 * max(scale, 1.0)
    center = (np.arange(target) + 0.5) * scale
    low, high = np.maximum(0, (center - reach + 0.5).astype(np.int64)), np.minimum(size, (center + reach + 0.5).astype(np.int64))
    counts = high - low
    starts, row = np.cumsum(counts) - counts, np.repeat(np.arange(target), counts)
    column = np.arange(counts.sum()) - (starts - low)[row]
    x = (column - center[row] + 0.5) / max(scale, 1.0)
    w = np.where((x >= -3) & (x < 3), np.sinc(x) * np.sinc(x / 3), 0.0)
    w = w / np.array([w[a : a + n].sum() for a, n in zip(starts.tolist(), counts.tolist())])[row]
    out = np.zeros((target, size), np.int64)
    out[row, column] = np.trunc(np.where(w < 0, -0.5, 0.5) + w * (1 << 22)).astype(np.int64)
    return out


def resized(picture: np.ndarray, width: int, height: int) -> np.ndarray:
    """A gray picture, or several of one size, in another size: first along rows, then along columns, rounded to bytes each time.

    Sums stay below 2^53, so products of floating-point numbers are exact.
    """
    for target, size in ((width, picture.shape[-1]), (height, picture.shape[-2])):
        if target != size:
            sums = picture.astype(np.float64) @ lanczos(size, target).T.astype(np.float64)
            picture = np.clip((sums.astype(np.int64) + (1 << 21)) >> 22, 0, 255)
        picture = picture.swapaxes(-1, -2)
    return picture.astype(np.uint8)


@functools.lru_cache(maxsize=8)
def cosines(n: int) -> np.ndarray:
    return 2 * np.cos(np.pi * np.outer(np.arange(n), 2 * np.arange(n) + 1) / (2 * n))


def _hex(bits: np.ndarray) -> list[str]:
    """The bits of each picture as hexadecimal digits."""
    flat = bits.reshape(len(bits), -1)
    digits = flat.shape[1] // 4
    packed = np.packbits(flat, axis=1)
    return [row.tobytes().hex()[:digits] for row in packed]


def phashes(shades: np.ndarray, side: int = 8) -> list[str]:
    """phash of gray pictures of one size."""
    table = cosines(4 * side)
    low = (table @ resized(shades, 4 * side, 4 * side).astype(np.float64) @ table.T)[:, :side, :side]
    return _hex(low > np.median(low, axis=(1, 2))[:, None, None])


def dhashes(shades: np.ndarray, side: int = 8) -> list[str]:
    """dhash of gray pictures of one size."""
    small = resized(shades, side + 1, side)
    return _hex(small[:, :, 1:] > small[:, :, :-1])


def phash(shade: np.ndarray, side: int = 8) -> str:
    """Which of the side x side lowest frequencies of the picture, four times as large, are above their median."""
    return phashes(shade[None], side)[0]


def dhash(shade: np.ndarray, side: int = 8) -> str:
    """Which pixels are brighter than their left neighbours."""
    return dhashes(shade[None], side)[0]


def hue_and_saturation(picture: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rgb = picture[:, :, :3].reshape(-1, 3) if picture.shape[2] >= 3 else np.repeat(picture[:, :, :1].reshape(-1, 1), 3, axis=1)
    c = rgb.astype(np.float32)
    most, least = c.max(axis=1), c.min(axis=1)
    span = np.maximum(most - least, 1)
    r, g, b = ((most - c[:, k]) / span for k in range(3))
    hue = np.where(c[:, 0] == most, b - g, np.where(c[:, 1] == most, 2.0 + r - b, 4.0 + g - r))
    flat = most == least
    hue = np.where(flat, 0, np.fmod(hue.astype(np.float64) / 6.0 + 1.0, 1.0) * 255.0).astype(np.int64)
    return hue, np.where(flat, 0, (most - least).astype(np.float64) / np.maximum(most, 1) * 255.0).astype(np.int64)


#: Which of six hues each value belongs to; the last one holds its end as well.
_SIXTHS = np.minimum(np.searchsorted(np.linspace(0, 255, 7), np.arange(256), side="right") - 1, 5)


def colorhashes(pictures: np.ndarray, bits: int = 3) -> list[str]:
    """colorhash of pictures of one shape."""
    n, pixels = len(pictures), pictures.shape[1] * pictures.shape[2]
    shade = gray(pictures).ravel()
    hue, saturation = hue_and_saturation(pictures.reshape(n * pictures.shape[1], *pictures.shape[2:]))
    owner = np.repeat(np.arange(n), pixels)
    dark = shade < 256 // 8
    dull = saturation < 256 // 3
    colour = ~dark & ~dull
    count = lambda which: which.reshape(n, pixels).sum(axis=1)
    shares = [(count(dark) / pixels)[:, None], (count(~dark & dull) / pixels)[:, None]]
    coloured = np.maximum(1, count(colour))[:, None]
    for part in (colour & (saturation < 256 * 2 // 3), colour & (saturation > 256 * 2 // 3)):
        shares.append(np.bincount(owner[part] * 6 + _SIXTHS[hue[part]], minlength=6 * n).reshape(n, 6) / coloured)
    top = 2**bits
    values = np.minimum(top - 1, (np.hstack(shares) * top).astype(np.int64)).tolist()
    digits = -(-len(values[0]) * bits // 4)
    return [f"{functools.reduce(lambda a, v: a << bits | v, row):0{digits}x}" for row in values]


def colorhash(picture: np.ndarray, bits: int = 3) -> str:
    """Shares of dark, gray, and faint and bright coloured pixels of six hues, with some bits each."""
    return colorhashes(picture[None], bits)[0]


def pixel_digest(picture: np.ndarray) -> str:
    """A digest of size, channels and pixels, whatever format they came in."""
    return hashlib.sha256(repr(picture.shape).encode() + picture.tobytes()).hexdigest()


#: What can be told of gray pictures.
GRAY_HASHES = {"phash": phashes, "dhash": dhashes, "phash_16": lambda shades: phashes(shades, 16)}
#: Bytes of pixels that are hashed at once; a larger picture goes by itself.
STACK_BYTES = 1 << 19


def _stack_hashes(found: np.ndarray, orientation: object, wanted: tuple[str, ...]) -> list[dict[str, str]]:
    """The wanted hashes of pictures of one shape."""
    turn = orientation if isinstance(orientation, int) else 1
    pictures = found if turn == 1 else np.stack([upright(p, turn) for p in found])
    shades = gray(pictures) if GRAY_HASHES.keys() & set(wanted) else None
    out = {n: GRAY_HASHES[n](shades) for n in wanted if n in GRAY_HASHES}
    if "colorhash" in wanted:
        out["colorhash"] = colorhashes(pictures)
    if "pixel_digest" in wanted:
        out["pixel_digest"] = [pixel_digest(p) for p in found]
    return [dict(zip(out, row)) for row in zip(*out.values())]


def picture_hashes(data: bytes, wanted: tuple[str, ...] = ("phash", "dhash", "phash_16", "colorhash")) -> dict[str, str]:
    """The wanted hashes of the upright picture, and pixel_digest of the stored one; nothing where it can't be decoded."""
    found = raster(data)
    return {} if found is None else _stack_hashes(found[None], exif_entries(data).get(ORIENTATION_TAG, 1), wanted)[0]


def many_hashes(files: list[bytes], wanted: tuple[str, ...]) -> list[dict[str, str]]:
    """picture_hashes of each file. BMPs of one length with all before the pixels in common are decoded and hashed together."""
    out: list[dict[str, str]] = [{}] * len(files)
    alike: dict[tuple[int, bytes], list[int]] = {}
    for k, data in enumerate(files):
        if kind_of(data) == "bmp" and len(data) > 30 and little(data, 14, 4) != 12 and little(data, 28, 2) in (8, 24, 32):
            alike.setdefault((len(data), data[: max(54, little(data, 10, 4))]), []).append(k)
        else:
            out[k] = picture_hashes(data, wanted)
    for (length, _), places in alike.items():
        first = raster(files[places[0]])
        if first is None:
            continue
        at_once = max(1, STACK_BYTES // first.nbytes)
        for a in range(0, len(places), at_once):
            some = places[a : a + at_once]
            found = np.ascontiguousarray(_bmps([files[k] for k in some], first.shape[1], first.shape[0]))
            for k, hashes in zip(some, _stack_hashes(found, 1, wanted)):
                out[k] = hashes
    return out
