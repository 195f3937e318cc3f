"""TIFF rasters read by ranges: headers, tiles of a window, overviews.

An ``Image`` asks its source for ranges of bytes: the directory, then only the
tiles or strips that a window meets. Classic and big files, strips and tiles,
plain, deflated, LZW, PackBits and Zstandard, horizontal and floating-point
differences, samples together or in planes, and reduced images (overviews) are
read; other packings are an error.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: TIFF and GeoTIFF tags, packings and field sizes.
SUBFILE, WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_COUNTS, FORMAT, SCALE, TIE, KEYS, NODATA = 254, 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
PLAIN, LZW, DEFLATE, PACKBITS, ZSTD = (1,), (5,), (8, 32946), (32773,), (50000,)
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8, 18: 8}
_CODE = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
HEADER = "path string, width int, height int, data_type string, samples int, nodata double, transform array<double>, epsg int"
PIXELS = "path string, row int, col int, sample int, x double, y double, value double"
Window = tuple[int, int, int, int]
Read = Callable[[int, int], bytes]
#: Bytes at a file's beginning that are read at once; directories mostly lie there.
HEAD = 16 << 10


class Ranges:
    """Ranges of a file in any store that Arrow reads. ``total`` counts the bytes that were asked for."""

    def __init__(self, path: str):
        fs, name = store(path)
        self.file = fs.open_input_file(name)
        self.size = self.file.size()
        self.total = 0
        self.head = self._get(0, HEAD)

    def _get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        self.total += n
        return self.file.read_at(n, at) if n else b""

    def __call__(self, at: int, n: int) -> bytes:
        return self.head[at : at + n] if at + n <= len(self.head) else self._get(at, n)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path in it; file: and plain paths are this machine's or a shared mount."""
    if re.match(r"file:/|/", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


def held(data: bytes) -> Read:
    return lambda at, n: data[at : at + n]


def lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; widths change one code early."""
    out, table, width, prev = bytearray(), [], 9, b""
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    bits = have = 0
    for byte in raw:
        bits, have = (bits << 8 | byte) & 0xFFFFFF, have + 8
        if have < width:
            continue
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 256:
            table, width, prev = list(start), 9, b""
            continue
        if code == 257:
            break
        if not prev:
            prev = table[code]
        else:
            now = table[code] if code < len(table) else prev + prev[:1]
            table.append(prev + now[:1])
            prev = now
        out += prev
        width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return bytes(out)


def packbits(raw: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(raw):
        n = raw[i]
        if n < 128:
            out += raw[i + 1 : i + 2 + n]
            i += 2 + n
        elif n > 128:
            out += raw[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


class Image:
    """The image of a file, or with ``level`` one of its reduced images."""

    def __init__(self, read: Read, level: int = 0):
        self.read = read
        head = read(0, 16)
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2], "")
        version = struct.unpack(self.order + "H", head[2:4])[0] if self.order else 0
        if version not in (42, 43):
            raise ValueError("not a TIFF file")
        self.big = version == 43
        at = struct.unpack(self.order + ("Q" if self.big else "I"), head[8:16] if self.big else head[4:8])[0]
        self.tags, at = self._directory(at)
        self.full = self.tags
        while level:
            if not at:
                raise ValueError("the file has no such overview")
            own, at = self._directory(at)
            if own.get(SUBFILE, (0,))[0] & 1 and not own.get(SUBFILE, (0,))[0] & 4:  # reduced, no mask
                level -= 1
                self.tags = own
        self.next = at
        t = self.tags
        self.width, self.height, self.samples = t[WIDTH][0], t[HEIGHT][0], t.get(SAMPLES, (1,))[0]
        self.kind = {1: "uint", 2: "int", 3: "float"}.get(t.get(FORMAT, (1,))[0], "uint") + str(t.get(BITS, (8,))[0])
        self.planes = self.samples if t.get(PLANAR, (1,))[0] != 1 else 1
        self.packing, self.predictor = t.get(COMPRESSION, (1,))[0], t.get(PREDICTOR, (1,))[0]
        if TILES in t:
            self.tile_w, self.tile_h, self.places, self.sizes = t[TILE_WIDTH][0], t[TILE_HEIGHT][0], t[TILES], t[TILE_COUNTS]
        elif STRIPS in t and COUNTS in t:
            self.tile_w, self.tile_h, self.places, self.sizes = self.width, min(t.get(ROWS, (self.height,))[0], self.height), t[STRIPS], t[COUNTS]
        else:
            raise ValueError("neither strips nor tiles")
        self.across, self.down = -(-self.width // self.tile_w), -(-self.height // self.tile_h)

    def _directory(self, at: int) -> tuple[dict[int, tuple], int]:
        o, size, inline = self.order, 20 if self.big else 12, 8 if self.big else 4
        n = struct.unpack(o + ("Q" if self.big else "H"), self.read(at, 8 if self.big else 2))[0]
        at += 8 if self.big else 2
        raw, out = self.read(at, n * size + inline), {}
        for i in range(n):
            tag, kind, count = struct.unpack(o + ("HHQ" if self.big else "HHI"), raw[i * size : i * size + size - inline])
            value, length = raw[i * size + size - inline : (i + 1) * size], _SIZE.get(kind, 0) * count
            if kind not in _CODE:
                continue
            if length > inline:
                value = self.read(struct.unpack(o + ("Q" if self.big else "I"), value)[0], length)
            out[tag] = (value[:length].rstrip(b"\0").decode(errors="replace"),) if kind == 2 else struct.unpack(f"{o}{count}{_CODE[kind]}", value[:length])
        return out, struct.unpack(o + ("Q" if self.big else "I"), raw[n * size : n * size + inline])[0]

    @property
    def nodata(self) -> float | None:
        text = self.full.get(NODATA, ("",))[0].strip()
        return float(text) if text and text.lower() != "nan" else None

    @property
    def transform(self) -> list[float] | None:
        """Cell width, 0, left edge, 0, minus cell height, upper edge."""
        scale, tie = self.full.get(SCALE), self.full.get(TIE)
        if not scale or not tie:
            return None
        dx, dy = scale[0] * self.full[WIDTH][0] / self.width, scale[1] * self.full[HEIGHT][0] / self.height
        return [dx, 0.0, tie[3] - tie[0] * scale[0], 0.0, -dy, tie[4] + tie[1] * scale[1]]

    @property
    def epsg(self) -> int | None:
        keys = self.full.get(KEYS, ())
        codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        return codes.get(3072) or codes.get(2048)

    @property
    def header(self) -> dict:
        return {"width": self.width, "height": self.height, "data_type": self.kind, "samples": self.samples, "nodata": self.nodata, "transform": self.transform, "epsg": self.epsg}

    def tile(self, n: int) -> np.ndarray:
        """[row, column, sample] of a tile or strip, in the order of the file."""
        deep = self.samples if self.planes == 1 else 1
        first = n % (self.across * self.down) // self.across * self.tile_h
        tall = self.tile_h if TILES in self.tags else min(self.tile_h, self.height - first)
        kind = np.dtype(self.kind).newbyteorder(self.order)
        size = tall * self.tile_w * deep * kind.itemsize
        if not self.sizes[n]:  # a tile that was never written
            return np.full((tall, self.tile_w, deep), self.nodata or 0, kind.newbyteorder("="))
        raw = self.read(self.places[n], self.sizes[n])
        if self.packing in DEFLATE:
            raw = zlib.decompress(raw)
        elif self.packing in LZW:
            raw = lzw(raw)
        elif self.packing in PACKBITS:
            raw = packbits(raw)
        elif self.packing in ZSTD:
            raw = pa.Codec("zstd").decompress(raw, size, asbytes=True)
        elif self.packing not in PLAIN:
            raise ValueError(f"compression {self.packing} isn't supported")
        if self.predictor == 3:
            rows = np.frombuffer(raw, np.uint8, size).reshape(tall, -1, deep)
            planes = np.cumsum(rows, axis=1, dtype=np.uint8).reshape(tall, kind.itemsize, -1)  # most significant bytes first
            part = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.dtype(self.kind).newbyteorder(">")).reshape(tall, self.tile_w, deep)
        else:
            part = np.frombuffer(raw, kind, tall * self.tile_w * deep).reshape(tall, self.tile_w, deep)
        part = part.astype(kind.newbyteorder("="))
        if self.predictor == 2:
            part = np.cumsum(part, axis=1, dtype=part.dtype)
        elif self.predictor not in (1, 3):
            raise ValueError(f"predictor {self.predictor} isn't supported")
        return part

    def window(self, window: Window | None = None) -> tuple[np.ndarray, int, int]:
        """[row, column, sample] of (first row, first column, rows, columns) as far as the image goes, and where that begins."""
        top, left, rows, cols = window or (0, 0, self.height, self.width)
        bottom, right = min(self.height, top + rows), min(self.width, left + cols)
        top, left = max(0, top), max(0, left)
        out = np.zeros((max(0, bottom - top), max(0, right - left), self.samples), np.dtype(self.kind))
        if not out.size:
            return out, top, left
        for p in range(self.planes):
            depth = slice(None) if self.planes == 1 else slice(p, p + 1)
            for j in range(top // self.tile_h, -(-bottom // self.tile_h)):
                for i in range(left // self.tile_w, -(-right // self.tile_w)):
                    part, r0, c0 = self.tile((p * self.down + j) * self.across + i), j * self.tile_h, i * self.tile_w
                    r, c = slice(max(r0, top), min(r0 + len(part), bottom)), slice(max(c0, left), min(c0 + self.tile_w, right))
                    out[r.start - top : r.stop - top, c.start - left : c.stop - left, depth] = part[r.start - r0 : r.stop - r0, c.start - c0 : c.stop - c0]
        return out, top, left


def fitting(read: Read, cell: float | None = None) -> Image:
    """The image, or the smallest of its overviews whose cells aren't wider than ``cell``."""
    best = Image(read)
    if cell is None or best.transform is None:
        return best
    level = 0
    while True:
        level += 1
        try:
            now = Image(read, level)
        except ValueError:
            return best
        if now.transform[0] <= cell * (1 + 1e-9) and now.width < best.width:
            best = now


def tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """The byte order and the tags of a file's first image."""
    image = Image(held(data))
    return image.order, image.tags


def header(data: bytes) -> dict:
    return Image(held(data)).header


def pixels(data: bytes, window: Window | None = None) -> tuple[np.ndarray, int, int]:
    """[row, column, sample] of a window (first row, first column, rows, columns), or of the whole, and where it begins."""
    return Image(held(data)).window(window)


def _packed(part: np.ndarray, packing: str) -> bytes:
    if part.dtype.kind == "f" and packing != "plain":
        rows = part.astype(part.dtype.newbyteorder(">")).reshape(len(part), -1).view(np.uint8).reshape(len(part), -1, part.dtype.itemsize)
        flat = np.ascontiguousarray(rows.transpose(0, 2, 1)).reshape(len(part), -1, part.shape[2])
        part = np.diff(flat, axis=1, prepend=np.zeros_like(flat[:, :1]))
    elif packing != "plain":
        part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
    raw = part.tobytes()
    return zlib.compress(raw) if packing == "deflate" else pa.Codec("zstd").compress(raw, asbytes=True) if packing == "zstd" else raw


def encode(a: np.ndarray, tile: int = 16, deflate: bool = True, transform: tuple[float, float, float, float] | None = None, epsg: int | None = None, nodata: float | None = None, packing: str | None = None, overviews: Sequence[np.ndarray] = ()) -> bytes:
    """A TIFF of [row, column, sample] numbers in tiles; ``transform``: x and y of the upper left corner, cell width and height.

    ``packing`` is plain, deflate or zstd, with differences of integers or of the
    bytes of floating-point numbers; ``overviews`` are the same image reduced.
    """
    packing = packing or ("deflate" if deflate else "plain")
    out = b"II*\0" + struct.pack("<I", 8)
    for k, image in enumerate([a, *overviews]):
        out += _directory(image, len(out), tile, packing, k, transform, epsg, nodata, k == len(overviews))
    return out


def _directory(a: np.ndarray, base: int, tile: int, packing: str, level: int, transform, epsg, nodata, last: bool) -> bytes:
    height, width, samples = a.shape
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    bodies = []
    for r in range(0, height, tile):
        for c in range(0, width, tile):
            part = np.zeros((tile, tile, samples), a.dtype.newbyteorder("<"))
            cut = a[r : r + tile, c : c + tile]
            part[: cut.shape[0], : cut.shape[1]] = cut
            bodies.append(_packed(part, packing))
    predictor = 1 if packing == "plain" else 3 if kind == 3 else 2
    entries = [(SUBFILE, "I", [int(level > 0)]), (WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [a.dtype.itemsize * 8] * samples), (COMPRESSION, "H", [{"plain": PLAIN, "deflate": DEFLATE, "zstd": ZSTD}[packing][0]]), (SAMPLES, "H", [samples]), (PREDICTOR, "H", [predictor]), (TILE_WIDTH, "I", [tile]), (TILE_HEIGHT, "I", [tile]), (TILES, "I", [0] * len(bodies)), (TILE_COUNTS, "I", [len(b) for b in bodies]), (FORMAT, "H", [kind] * samples)]
    if transform and not level:
        x, y, dx, dy = transform
        entries += [(SCALE, "d", [dx, dy, 0.0]), (TIE, "d", [0.0, 0.0, 0.0, x, y, 0.0])]
    if epsg and not level:
        entries.append((KEYS, "H", [1, 1, 0, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg]))
    if nodata is not None and not level:
        entries.append((NODATA, "s", [f"{nodata:g}\0".encode()]))
    entries.sort(key=lambda e: e[0])
    code, head = {"H": 3, "I": 4, "d": 12, "s": 2}, base + 2 + 12 * len(entries) + 4
    packed = lambda k, v: v[0] if k == "s" else struct.pack(f"<{len(v)}{k}", *v)
    at = head + sum(len(p) for _, k, v in entries if len(p := packed(k, v)) > 4)
    starts = (at + np.concatenate([[0], np.cumsum([len(b) for b in bodies])])).tolist()
    table, extra = b"", b""
    for tag, k, v in entries:
        raw = packed(k, starts[:-1] if tag == TILES else v)
        table += struct.pack("<HHI", tag, code[k], len(v[0]) if k == "s" else len(v)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", head + len(extra)))
        extra += raw if len(raw) > 4 else b""
    return struct.pack("<H", len(entries)) + table + struct.pack("<I", 0 if last else starts[-1]) + extra + b"".join(bodies)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    def run(batches):
        for b in batches:
            rows = [{"path": p} | header(c.as_py()) for p, c in zip(b.column(0).to_pylist(), b.column(1), strict=True)]
            names = [f.split()[0] for f in HEADER.split(", ")]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    return _files(spark, path).mapInArrow(run, HEADER)


def read_pixels(spark: SparkSession, path: str, window: Window | None = None) -> DataFrame:
    return pixels_of(_files(spark, path), window)


def pixels_of(files: DataFrame, window: Window | None = None) -> DataFrame:
    """Pixels of ``files(path, content)`` with the coordinates of their centres (rows and columns where a file has no transform)."""

    def run(batches):
        for b in batches:
            for p, c in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                data = c.as_py()
                try:
                    a, top, left = pixels(data, window)
                except ValueError as e:
                    raise ValueError(f"{p}: {e}") from e
                r, k, s = (x.reshape(-1).astype(np.int32) for x in np.indices(a.shape))
                r, k = r + np.int32(top), k + np.int32(left)
                dx, _, x0, _, dy, y0 = header(data)["transform"] or (1.0, 0.0, -0.5, 0.0, 1.0, -0.5)
                step = 1 << 16
                for lo in range(0, a.size, step):
                    own = slice(lo, lo + step)
                    n = len(r[own])
                    yield pa.RecordBatch.from_arrays([pa.array([p] * n), pa.array(r[own]), pa.array(k[own]), pa.array(s[own]), pa.array(x0 + (k[own] + 0.5) * dx), pa.array(y0 + (r[own] + 0.5) * dy), pa.array(a.reshape(-1)[own].astype(float))], ["path", "row", "col", "sample", "x", "y", "value"])

    return files.select("path", "content").mapInArrow(run, PIXELS)


def cube(pixels: DataFrame, assets: DataFrame, bands: list[str]) -> DataFrame:
    """A wide pixel table from ``pixels_of`` and ``assets(path, time, band)``: one shuffle on the cell; the first sample of each file.

    Of several files on a cell the one with the smallest ``place`` of ``assets`` counts, or without that column the first path.
    """
    place = F.col("place") if "place" in assets.columns else F.col("path")
    rows = pixels.where("sample = 0").join(assets.select("path", "time", "band", place.alias("place")), "path")
    return rows.groupBy("time", "y", "x").agg(*(F.min_by(F.when(F.col("band") == b, F.col("value")), F.when((F.col("band") == b) & F.col("value").isNotNull(), F.struct("place", "path"))).alias(b) for b in bands))
