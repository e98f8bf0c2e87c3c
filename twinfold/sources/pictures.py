"""Sizes and EXIF blocks of pictures from their bytes, by walks over segments, chunks, directories and boxes.

Each walk goes forward only, one header at a time, and ends at the first length that is cut off or lies; what
it hasn't found by then is missing. Nothing is decoded. Sizes are those of the stored picture, before EXIF
turns it; a HEIC picture's own turn counts, since its readers apply it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: EXIF tags of the main directory, the EXIF directory, and the sizes of a TIFF.
TEXT_TAGS = {0x010F: "exif_make", 0x0110: "exif_model", 0x0131: "exif_software", 0x0132: "exif_datetime", 0x9003: "exif_datetime_original", 0x9004: "exif_datetime_digitized"}
WIDTH_TAG, HEIGHT_TAG, ORIENTATION_TAG, EXIF_TAG = 0x0100, 0x0101, 0x0112, 0x8769
#: Entries of a directory, and items of a HEIC file, that are looked at.
MOST_ENTRIES = 512

_MARKER = re.compile(rb"\xff+([^\xff\x00])")


def big(data: bytes, at: int, n: int) -> int:
    """n bytes as a number, high ones first. IndexError where they are cut off."""
    if at < 0 or at + n > len(data):
        raise IndexError(at)
    return int.from_bytes(data[at : at + n], "big")


def little(data: bytes, at: int, n: int) -> int:
    if at < 0 or at + n > len(data):
        raise IndexError(at)
    return int.from_bytes(data[at : at + n], "little")


def jpeg_segments(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(marker, start, end) of each segment's content up to the picture's data."""
    at = 2
    while m := _MARKER.match(data, at):
        marker, at = m[1][0], m.end()
        if marker in (0xD9, 0xDA):
            return
        if marker == 0x01 or 0xD0 <= marker <= 0xD8:
            continue
        size = big(data, at, 2)
        if size < 2 or at + size > len(data):
            return
        yield marker, at + 2, at + size
        at += size


def png_chunks(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    at = 8
    while at + 12 <= len(data):
        size, kind = big(data, at, 4), data[at + 4 : at + 8]
        if at + 12 + size > len(data):
            return
        yield kind, at + 8, at + 8 + size
        at += 12 + size


def riff_chunks(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    at = 12
    while at + 8 <= len(data):
        size = little(data, at + 4, 4)
        if at + 8 + size > len(data):
            return
        yield data[at : at + 4], at + 8, at + 8 + size
        at += 8 + size + size % 2


def boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, start, end) of the contents of the ISO boxes between two places."""
    while at + 8 <= end:
        size, kind, head = big(data, at, 4), data[at + 4 : at + 8], 8
        if size == 1:
            size, head = big(data, at + 8, 8), 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            return
        yield kind, at + head, at + size
        at += size


def tiff_entries(data: bytes) -> dict[int, object]:
    """tag -> number or text, of the first directory and of the EXIF directory that it names."""
    number = {b"II*\x00": little, b"MM\x00*": big}.get(data[:4])
    if number is None:
        return {}
    found: dict[int, object] = {}
    todo = [number(data, 4, 4)]
    for at in todo:
        for k in range(min(number(data, at, 2), MOST_ENTRIES)):
            entry = at + 2 + 12 * k
            if entry + 12 > len(data):
                break
            tag, kind, size = number(data, entry, 2), number(data, entry + 2, 2), number(data, entry + 4, 4)
            if tag == EXIF_TAG and len(todo) < 2:
                todo.append(number(data, entry + 8, 4))
            elif tag in TEXT_TAGS and kind == 2 and size:
                place = entry + 8 if size <= 4 else number(data, entry + 8, 4)
                raw = data[place : place + size].split(b"\x00")[0]
                if raw and place + size <= len(data):
                    found.setdefault(tag, raw.decode("utf-8", "ignore").strip())
            elif tag in (WIDTH_TAG, HEIGHT_TAG, ORIENTATION_TAG) and kind in (1, 3, 4) and size == 1:
                found.setdefault(tag, number(data, entry + 8, {1: 1, 3: 2, 4: 4}[kind]))
        if at + 2 > len(data):
            break
    return found


class HeicItems:
    """What a HEIC file's meta box says of its items."""

    def __init__(self, data: bytes):
        self.data = data
        self.primary: int | None = None
        self.properties: list[tuple[bytes, int, int]] = []
        self.of_item: dict[int, list[int]] = {}
        self.places: dict[int, tuple[int, int]] = {}
        self.kinds: dict[int, bytes] = {}
        for kind, at, end in boxes(data, 0, len(data)):
            if kind == b"meta":
                for inner, start, stop in boxes(data, at + 4, end):
                    read = {b"pitm": self.read_primary, b"iprp": self.read_properties, b"iinf": self.read_kinds, b"iloc": self.read_places}.get(inner)
                    if read:
                        read(start, stop)
                return

    def read_primary(self, at: int, end: int) -> None:
        self.primary = big(self.data, at + 4, 4 if self.data[at] else 2)

    def read_properties(self, at: int, end: int) -> None:
        for kind, start, stop in boxes(self.data, at, end):
            if kind == b"ipco":
                self.properties = list(boxes(self.data, start, stop))
            elif kind == b"ipma":
                wide, long = bool(self.data[start]), self.data[start + 3] & 1
                p = start + 8
                for _ in range(min(big(self.data, start + 4, 4), MOST_ENTRIES)):
                    item = big(self.data, p, 4 if wide else 2)
                    p += 4 if wide else 2
                    count, p = self.data[p], p + 1
                    step = 2 if long else 1
                    self.of_item[item] = [big(self.data, p + step * k, step) & (0x7FFF if long else 0x7F) for k in range(count)]
                    p += step * count

    def read_kinds(self, at: int, end: int) -> None:
        wide = bool(self.data[at])
        for _, (kind, start, _stop) in zip(range(MOST_ENTRIES), boxes(self.data, at + (8 if wide else 6), end)):
            version = self.data[start]
            if kind == b"infe" and version >= 2:
                n = 4 if version == 3 else 2
                self.kinds[big(self.data, start + 4, n)] = self.data[start + 6 + n : start + 10 + n]

    def read_places(self, at: int, end: int) -> None:
        version, sizes = self.data[at], big(self.data, at + 4, 2)
        offset, length, base, index = (sizes >> 12) & 15, (sizes >> 8) & 15, (sizes >> 4) & 15, sizes & 15
        n = 4 if version == 2 else 2
        count, p = big(self.data, at + 6, n), at + 6 + n
        for _ in range(min(count, MOST_ENTRIES)):
            item, p = big(self.data, p, n), p + n + (2 if version else 0)
            start, p = (big(self.data, p + 2, base) if base else 0), p + 2 + base
            extents, p = big(self.data, p, 2), p + 2
            step = offset + length + (index if version else 0)
            if extents == 1:
                q = p + (index if version else 0)
                self.places[item] = (start + (big(self.data, q, offset) if offset else 0), big(self.data, q + offset, length) if length else 0)
            p += step * extents

    def size(self) -> tuple[int, int] | None:
        mine = self.of_item.get(self.primary, range(1, len(self.properties) + 1))
        used = [self.properties[k - 1] for k in mine if 0 < k <= len(self.properties)]
        found = [(big(self.data, at + 4, 4), big(self.data, at + 8, 4)) for kind, at, end in used if kind == b"ispe"]
        if not found:
            return None
        w, h = max(found, key=lambda x: x[0] * x[1])
        turned = sum(self.data[at] & 1 for kind, at, end in used if kind == b"irot" and end > at) % 2
        return (h, w) if turned else (w, h)

    def exif(self) -> bytes:
        for item, kind in self.kinds.items():
            if kind == b"Exif" and item in self.places:
                at, n = self.places[item]
                skip = 4 + big(self.data, at, 4)
                if skip < n and at + n <= len(self.data):
                    return self.data[at + skip : at + n]
        return b""


def kind_of(data: bytes) -> str:
    """The container: by its first bytes, as the type is told."""
    if data[:3] == b"\xff\xd8\xff":
        return "jpeg"
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return "png"
    if data[:4] == b"GIF8":
        return "gif"
    if data[:2] == b"BM":
        return "bmp"
    if data[:4] in (b"II*\x00", b"MM\x00*"):
        return "tiff"
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return "webp"
    return "heic" if data[4:8] == b"ftyp" else ""


def _webp_size(data: bytes) -> tuple[int, int] | None:
    for kind, at, end in riff_chunks(data):
        if kind == b"VP8X" and end - at >= 10:
            return little(data, at + 4, 3) + 1, little(data, at + 7, 3) + 1
        if kind == b"VP8 " and data[at + 3 : at + 6] == b"\x9d\x01\x2a" and end - at >= 10:
            return little(data, at + 6, 2) & 0x3FFF, little(data, at + 8, 2) & 0x3FFF
        if kind == b"VP8L" and data[at] == 0x2F and end - at >= 5:
            bits = little(data, at + 1, 4)
            return (bits & 0x3FFF) + 1, ((bits >> 14) & 0x3FFF) + 1
    return None


def picture_size(data: bytes) -> tuple[int, int] | None:
    """(width, height); None where the header is missing, cut off or says zero. A PNG's is given as it stands."""
    try:
        kind, size = kind_of(data), None
        if kind == "jpeg":
            frames = (s for s in jpeg_segments(data) if 0xC0 <= s[0] <= 0xCF and s[0] not in (0xC4, 0xC8, 0xCC))
            size = next(((big(data, at + 3, 2), big(data, at + 1, 2)) for _, at, end in frames if end - at >= 6), None)
        elif kind == "png" and data[12:16] == b"IHDR":
            size = big(data, 16, 4), big(data, 20, 4)
        elif kind == "gif":
            size = little(data, 6, 2), little(data, 8, 2)
        elif kind == "bmp" and little(data, 14, 4) == 12:
            size = little(data, 18, 2), little(data, 20, 2)
        elif kind == "bmp":
            width, height = little(data, 18, 4), little(data, 22, 4)
            size = width, min(height, 2**32 - height)  # rows from the top have a negative height
        elif kind == "tiff":
            tags = tiff_entries(data)
            size = (tags[WIDTH_TAG], tags[HEIGHT_TAG]) if WIDTH_TAG in tags and HEIGHT_TAG in tags else None
        elif kind == "webp":
            size = _webp_size(data)
        elif kind == "heic":
            size = HeicItems(data).size()
        return size if size and (kind == "png" or min(size) > 0) else None
    except IndexError:
        return None


def exif_block(data: bytes) -> bytes:
    """The TIFF structure that holds a picture's EXIF data; empty where there is none."""
    try:
        kind, block = kind_of(data), b""
        if kind == "tiff":
            return data
        if kind == "jpeg":
            # Up to the file's end: directories are found by their offsets, also where a segment says that it is shorter.
            block = next((data[at:] for marker, at, end in jpeg_segments(data) if marker == 0xE1 and data[at : at + 6] == b"Exif\x00\x00"), b"")
        elif kind == "png":
            block = next((data[at:end] for name, at, end in png_chunks(data) if name == b"eXIf"), b"")
        elif kind == "webp":
            block = next((data[at:end] for name, at, end in riff_chunks(data) if name == b"EXIF"), b"")
        elif kind == "heic":
            block = HeicItems(data).exif()
        return block.removeprefix(b"Exif\x00\x00")
    except IndexError:
        return b""


def exif_entries(data: bytes) -> dict[int, object]:
    """tiff_entries of a picture's EXIF block; nothing where it is malformed."""
    try:
        return tiff_entries(exif_block(data))
    except IndexError:
        return {}
