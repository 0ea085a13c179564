"""Netpbm and BMP columns: decoded to arrays, area-resized by integral images, stored as NPY tiles with difference hashes.

``media_table`` decodes a binary column; ``text_media`` stores texts losslessly as 64-pixel-wide RGB Netpbm images (one
byte a sample, 192 bytes a row) in a table of the shared folder, reads that back, and writes tiles and hashes of what it read
to a second table, from which the features come. Images may be
P1 to P6 with up to 8 bits a sample, or uncompressed BMP with 8, 24 or 32 bits a pixel.

Cases: a null text is an empty one (one row of blanks); equal texts get equal values; a null or unreadable image gives a
row with null width and a message in ``error``; repeated rows stay; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.frames import stored
from slotwise.llm.textops import Slice, documents, map_slices, slices

WIDTH = 64
ROW_BYTES = 3 * WIDTH
TILE = 16

IMAGE_SCHEMA = "doc_id long, n_bytes long, media binary"
TILE_SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, dhash string, tile binary"
)
MEDIA_SCHEMA = "id long, width int, height int, channels int, dhash string, tile binary, error string"


class UnreadableImage(ValueError):
    """The bytes are not an image that this module reads."""


def encode_ppm(samples: np.ndarray) -> bytes:
    height, width, _ = samples.shape
    return b"P6\n%d %d\n255\n" % (width, height) + samples.tobytes()


def decode_netpbm(raw: bytes) -> np.ndarray:
    """Samples as (height, width, channels), eight bits each; bitmaps become 0 and 255."""
    kind = raw[:2]
    fields, at = [], 2
    need = 2 if kind in (b"P1", b"P4") else 3
    while len(fields) < need:
        found = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(raw, at)
        if not found:
            raise UnreadableImage("short Netpbm header")
        fields.append(int(found[1]))
        at = found.end()
    width, height = fields[:2]
    top = fields[2] if need == 3 else 1
    if not 0 < top < 256:
        raise UnreadableImage("more than 8 bits a sample")
    channels = 3 if kind in (b"P3", b"P6") else 1
    count = width * height * channels
    if kind in (b"P2", b"P3"):
        values = np.array(raw[at:].split()[:count], dtype=np.uint8)
    elif kind == b"P1":
        values = np.frombuffer(re.sub(rb"[^01]", b"", raw[at:])[:count], np.uint8) - 48
    elif kind == b"P4":
        packed = np.frombuffer(raw, np.uint8, offset=at + 1)[: height * -(-width // 8)]
        if len(packed) < height * -(-width // 8):
            raise UnreadableImage("short Netpbm data")
        values = np.unpackbits(packed.reshape(height, -1), axis=1)[:, :width].ravel()
    else:
        values = np.frombuffer(raw, np.uint8, offset=at + 1)[:count]
    if len(values) < count:
        raise UnreadableImage("short Netpbm data")
    if need == 2:
        values = (1 - values) * np.uint8(255)
    elif top != 255:
        values = (values.astype(np.uint32) * 255 // top).astype(np.uint8)
    return values.reshape(height, width, channels)


def decode_bmp(raw: bytes) -> np.ndarray:
    if len(raw) < 54:
        raise UnreadableImage("short BMP header")
    start, head = struct.unpack_from("<II", raw, 10)
    width, height, _, bits, packing = struct.unpack_from("<iiHHI", raw, 18)
    if packing not in (0, 3) or bits not in (8, 24, 32) or width <= 0 or height == 0:
        raise UnreadableImage("BMP form not read")
    stride = -(-width * bits // 32) * 4
    rows = abs(height)
    if len(raw) < start + stride * rows:
        raise UnreadableImage("short BMP data")
    pixels = np.frombuffer(raw, np.uint8, stride * rows, start).reshape(rows, stride)[:, : width * bits // 8]
    if height > 0:
        pixels = pixels[::-1]
    if bits == 8:
        colours = np.frombuffer(raw[14 + head : start], np.uint8)
        colours = colours[: len(colours) // 4 * 4].reshape(-1, 4)[:, 2::-1]
        if pixels.max(initial=0) >= len(colours):
            raise UnreadableImage("BMP colour outside its table")
        return colours[pixels]
    return np.ascontiguousarray(pixels.reshape(rows, width, bits // 8)[:, :, 2::-1])


def decode(raw: bytes | None) -> np.ndarray:
    if raw and raw[:1] == b"P" and raw[1:2] in b"123456":
        return decode_netpbm(raw)
    if raw and raw[:2] == b"BM":
        return decode_bmp(raw)
    raise UnreadableImage("neither Netpbm nor BMP")


def area_resize(samples: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the exact source area of each target pixel, from an integral image read at fractional edges."""
    h, w, channels = samples.shape
    sums = np.zeros((h + 1, w + 1, channels))
    np.cumsum(np.cumsum(samples, axis=0, dtype=np.float64), axis=1, out=sums[1:, 1:])

    def edges(source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(target + 1) * source / target
        low = np.minimum(at.astype(np.int64), source - 1)
        return low, at - low

    y, fy = edges(h, height)
    x, fx = edges(w, width)
    lines = sums[y] * (1 - fy)[:, None, None] + sums[y + 1] * fy[:, None, None]
    at = lines[:, x] * (1 - fx)[None, :, None] + lines[:, x + 1] * fx[None, :, None]
    return np.diff(np.diff(at, axis=0), axis=1) / (h / height * w / width)


def difference_hash(samples: np.ndarray) -> str:
    """64 bits: whether each of 8 x 9 grey means is above its left neighbour."""
    grey = area_resize(samples, 8, 9).mean(axis=2)
    return np.packbits(grey[:, 1:] > grey[:, :-1] + 1e-9).tobytes().hex()


def npy_tile(samples: np.ndarray, side: int = TILE) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.rint(area_resize(samples, side, side)).astype(np.uint8), version=(1, 0))
    return out.getvalue()


def store_text(raw: bytes) -> bytes:
    """The stored form of a text: blanks up to whole rows, then one RGB sample a byte."""
    payload = raw + b" " * (-len(raw) % ROW_BYTES or (0 if raw else ROW_BYTES))
    return encode_ppm(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, 3))


def text_images(docs: DataFrame) -> DataFrame:
    """Every text as an image."""

    def work(part: Slice) -> pa.RecordBatch:
        media = [store_text(part.raw(i)) for i in range(len(part))]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(part.sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return map_slices(documents(docs, "doc_id", "text"), work, IMAGE_SCHEMA)


def image_tiles(images: DataFrame) -> DataFrame:
    """Digests, difference hash and NPY tile of every image of ``text_images``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media"):
                out = []
                for i in range(len(part)):
                    media = part.raw(i)
                    samples = decode(media)
                    payload = samples.tobytes()
                    out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(samples), npy_tile(samples)))
                names = [c.split()[0] for c in TILE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *map(pa.array, zip(*out, strict=True))], names)

    return images.mapInArrow(run, TILE_SCHEMA)


def text_media(docs: DataFrame) -> DataFrame:
    """Every text stored as an image; the table of images is read back, tiled and described, the table of tiles as well."""
    images = stored(text_images(docs), "media", compression="zstd")
    tiles = stored(image_tiles(images), "tiles", compression="zstd")
    tile = F.lpad(F.lower(F.hex(F.crc32("tile"))), 8, "0")
    return tiles.withColumn("feature", F.concat("dhash", F.lit("-"), tile)).drop("dhash", "tile")


def media_table(images: DataFrame, id_column: str = "id", image_column: str = "image", side: int = TILE) -> DataFrame:
    """Size, difference hash and NPY tile of every image of a binary column; write the result as any table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for key, raw in zip(*(c.slice(at, 64).to_pylist() for c in batch.columns), strict=True):
                    try:
                        samples = decode(raw)
                        out.append((key, samples.shape[1], samples.shape[0], samples.shape[2], difference_hash(samples), npy_tile(samples, side), None))
                    except ValueError as fault:
                        out.append((key, None, None, None, None, None, str(fault)))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
                names = [c.split()[0] for c in MEDIA_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return images.select(F.col(id_column).cast("long").alias("id"), F.col(image_column).alias("image")).mapInArrow(run, MEDIA_SCHEMA)
