"""Media columns: Netpbm and BMP images as bytes, decoded to numpy arrays, area-resized by integral
images, written as NPY tiles with difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Width in pixels of a stored payload, side of a tile, and grid of the difference hash (rows, columns).
WIDTH, TILE, HASH_GRID = 64, 32, (8, 9)
HEADER_FIELD = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)")


def write_netpbm(image: np.ndarray) -> bytes:
    """P5 of (h, w) or P6 of (h, w, 3) uint8."""
    kind = b"P5" if image.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + image.tobytes()


def write_bmp(image: np.ndarray) -> bytes:
    """8-bit BMP with a grey palette of (h, w), or 24-bit of (h, w, 3), bottom row first."""
    h, w = image.shape[:2]
    grey = image.ndim == 2
    rows = image[::-1] if grey else image[::-1, :, ::-1].reshape(h, w * 3)
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4)))
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
    palette[:, 3] = 0
    colours = palette.tobytes() if grey else b""
    offset = 54 + len(colours)
    head = struct.pack("<2sIHHI", b"BM", offset + rows.size, 0, 0, offset)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8 if grey else 24, 0, rows.size, 2835, 2835, 256 if grey else 0, 0)
    return head + info + colours + rows.tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 with at most 8 bits a sample; bitmaps become 0 (ink) and 255."""
    kind, at = data[:2], 2
    fields = []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = HEADER_FIELD.match(data, at)
        if not m:
            raise ValueError("truncated Netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    w, h = fields[:2]
    depth = 3 if kind in (b"P3", b"P6") else 1
    shape = (h, w, 3) if depth == 3 else (h, w)
    n = h * w * depth
    if kind in (b"P5", b"P6"):
        if fields[2] > 255:
            raise ValueError("more than 8 bits a sample")
        return np.frombuffer(data, np.uint8, n, at + 1).reshape(shape)
    if kind == b"P4":
        bits = np.unpackbits(np.frombuffer(data, np.uint8, h * ((w + 7) // 8), at + 1).reshape(h, -1), axis=1)[:, :w]
        return np.where(bits, 0, 255).astype(np.uint8)
    if kind in (b"P2", b"P3"):
        return np.array(data[at:].split()[:n], np.uint8).reshape(shape)
    if kind == b"P1":
        return np.array([0 if c == 49 else 255 for c in data[at:] if c in (48, 49)][:n], np.uint8).reshape(shape)
    raise ValueError("not Netpbm")


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed 8-bit (palette) and 24-bit BMP, bottom-up or top-down."""
    offset = struct.unpack_from("<I", data, 10)[0]
    size, w, h, _, bits, compression = struct.unpack_from("<IiiHHI", data, 14)
    if compression or bits not in (8, 24):
        raise ValueError("only uncompressed 8-bit and 24-bit BMP")
    stride = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)[:, : w * bits // 8]
    rows = rows[::-1] if h > 0 else rows
    if bits == 24:
        return rows.reshape(abs(h), w, 3)[:, :, ::-1]
    used = struct.unpack_from("<I", data, 46)[0] or 256
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + size).reshape(used, 4)
    if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all():
        return palette[:, 0][rows]
    return palette[:, [2, 1, 0]][rows]


def decode(data: bytes) -> np.ndarray:
    if data[:1] == b"P":
        return decode_netpbm(data)
    if data[:2] == b"BM":
        return decode_bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the exact (fractional) source area under each target pixel, from one integral image."""
    h, w = image.shape
    integral = np.zeros((h + 1, w + 1))
    integral[1:, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)

    def along(values: np.ndarray, n: int, parts: int) -> np.ndarray:
        at = np.arange(parts + 1) * (n / parts)
        low = np.minimum(at.astype(int), n - 1)
        share = (at - low)[:, None]
        return values[low] * (1 - share) + values[low + 1] * share

    grid = along(along(integral, h, height).T, w, width).T
    area = (h / height) * (w / width)
    return (grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]) / area


def difference_hash(image: np.ndarray) -> str:
    """64 bits: is each cell of an 8 x 9 reduction darker than its right neighbour."""
    small = np.round(area_resize(grey(image), *HASH_GRID), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def tile(image: np.ndarray) -> bytes:
    """NPY bytes of a TILE x TILE reduction in grey."""
    out = io.BytesIO()
    np.save(out, np.clip(np.round(area_resize(grey(image), TILE, TILE)), 0, 255).astype(np.uint8))
    return out.getvalue()


def store(text: str | None) -> tuple[bytes, int]:
    """(image, unpadded bytes): the text's UTF-8, zero-padded to a positive multiple of 64, as samples.

    Thirds of 64-pixel rows that divide by three are PPM, other even numbers of rows BMP, the rest PGM.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(WIDTH, -(-len(raw) // WIDTH) * WIDTH)
    samples = np.frombuffer(raw.ljust(size, b"\0"), np.uint8).reshape(-1, WIDTH)
    rows = len(samples)
    if rows % 3 == 0:
        return write_netpbm(samples.reshape(rows // 3, WIDTH, 3)), len(raw)
    return (write_bmp(samples) if rows % 2 == 0 else write_netpbm(samples)), len(raw)


FIELDS = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def describe(media: bytes, n_bytes: int) -> tuple:
    """Digest columns and the tile of one stored image, all from its decoded samples."""
    image = decode(media)
    payload = image.tobytes()
    npy = tile(image)
    feature = f"dhash:{difference_hash(image)};tile:{hashlib.sha256(npy).hexdigest()[:16]}"
    return (n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature), npy


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [store(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m for m, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())], ["id", "media", "n_bytes"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [describe(m, n) for m, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        columns = list(zip(*(d for d, _ in made), strict=True)) if made else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array([t for _, t in made], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["id", *(f.split()[0] for f in FIELDS.split(", ")), "npy"])


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, media, n_bytes): each text as an image column. A null text is the empty text."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_store, f"id {kind}, media binary, n_bytes bigint").withColumnRenamed("id", id_col)


def media_features(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, digest columns, npy) of media(id_col, media, n_bytes).

    The digest columns are those of the payload read back, of the stored bytes, and `feature` (difference hash and the
    tile's digest); npy is the tile. Nothing is shuffled and rows are handled one image at a time, so memory
    is that of the largest image; equal texts have equal values; an empty table gives an empty table; other columns are
    ignored. Bytes that are neither Netpbm nor BMP fail the query.
    """
    kind = media.schema[id_col].dataType.simpleString()
    return media.select(id_col, "media", "n_bytes").mapInArrow(_features, f"id {kind}, {FIELDS}, npy binary").withColumnRenamed("id", id_col)
