"""Media columns for GIF: LZW coding, palettes, disposal, transparency, timed frames, colour histograms.

``decode`` renders an animation to full-canvas RGBA frames with their delays, following
the 1989 format: global and local palettes, interlacing, transparent indices, and the
disposal of each frame before the next.  ``encode`` writes 8-bit indexed frames.

Defined results: null content gives no frames (``frames``) or the empty payload (the
query); bytes that are no GIF, code sizes outside 2 to 8 and canvases of more than
``MOST_PIXELS`` raise ValueError in ``decode`` and give an ``error`` in ``frames``, there with
the frames before the place that is broken; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, map_rows, prepare, text_bytes

GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)
FULL = 4096
#: Pixels of a canvas or frame up to which it is rendered; a larger one, as a broken header can claim, is an error.
MOST_PIXELS = 1 << 26


def _widths(least: int) -> np.ndarray:
    """Bits of the n-th code since a clear code: the table grows by one with each code but the first."""
    n = np.arange(FULL + 2)
    following = (1 << (least)) + 2 + np.maximum(0, n - 1)
    return np.clip(np.ceil(np.log2(following + 1)).astype(np.int64), least + 1, 12)


_WIDTHS = {k: _widths(k) for k in range(2, 9)}


def lzw_encode(data: bytes, least: int = 8) -> bytes:
    """The code stream of samples below 2**least, with a clear code whenever the table is full."""
    clear = 1 << least
    fresh = clear + 2
    codes = [clear]
    if data:
        get, add = (table := {}).get, codes.append
        following, cur = fresh, data[0]
        for c in data[1:]:
            key = cur << 8 | c
            if (code := get(key)) is not None:
                cur = code
            else:
                add(cur)
                if following < FULL:
                    table[key] = following
                    following += 1
                else:
                    add(clear)
                    table.clear()
                    following = fresh
                cur = c
        add(cur)
    codes.append(clear + 1)
    every = np.frombuffer(array("H", codes), np.uint16)
    at = np.arange(len(every))
    last = np.maximum.accumulate(np.where(every == clear, at, -1))
    since = at - np.concatenate(([0], last[:-1])) - 1  # of the code before: a clear code is still of the old width
    since[0] = 0
    bits = _WIDTHS[least][np.maximum(since, 0)]
    return _pack(every, bits)


def _pack(codes: np.ndarray, bits: np.ndarray) -> bytes:
    place = np.arange(12)
    each = (codes[:, None] >> place.astype(codes.dtype)) & codes.dtype.type(1)
    return np.packbits(each[place < bits[:, None]].astype(np.uint8), bitorder="little").tobytes()


def lzw_decode(stream: bytes, least: int, most: int) -> bytes:
    """At most ``most`` samples of a code stream."""
    if least not in _WIDTHS:
        raise ValueError(f"code size {least}")
    clear = 1 << least
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    widths, total = _WIDTHS[least], len(stream) * 8
    single = [bytes([i]) for i in range(clear)] + [b"", b""]
    out: list[bytes] = []
    done, bit = 0, 0
    steps = np.concatenate(([0], np.cumsum(widths)))
    table = None
    while done < most:
        # the codes up to the next clear code, as if there were none; beyond a full table all have 12 bits
        at, wide = (bit + steps[:-1], widths) if table is None else (bit + 12 * np.arange(FULL), np.full(FULL, 12))
        span = len(at)
        fits = int(np.searchsorted(at + wide, total, "right"))
        if not fits:
            break
        at, wide = at[:fits], wide[:fits]
        byte = at >> 3
        codes = ((raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (at & 7)) & ((1 << wide) - 1)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        n = int(stop[0]) if len(stop) else fits
        if n:
            block = codes[:n].tolist()
            if table is None:
                table = single.copy()
                parts = _strings(block[: FULL - clear - 1], table, block[FULL - clear - 1 :])
            else:
                parts = b"".join([table[code] for code in block])
            out.append(parts)
            done += len(parts)
        if len(stop) and codes[n] == clear:
            bit, table = int(at[n] + wide[n]), None
        elif len(stop) or fits < span:
            break
        else:
            bit = int(at[-1] + wide[-1])  # a deferred clear code: the full table stays
    return b"".join(out)[:most]


def _strings(codes: list[int], table: list[bytes], beyond: list[int]) -> bytes:
    """The samples of the codes between two clear codes; those ``beyond`` come when the table is full."""
    if codes[0] >= len(table) - 2:
        raise ValueError("a code before its definition")
    previous = table[codes[0]]
    out = [previous]
    add, grow = out.append, table.append
    for code in codes[1:]:
        try:
            entry = table[code]
        except IndexError:
            if code != len(table):
                raise ValueError("a code before its definition") from None
            entry = previous + previous[:1]
        grow(previous + entry[:1])
        add(entry)
        previous = entry
    out += [table[code] for code in beyond]
    return b"".join(out)


@dataclass
class Frame:
    index: int
    at_ms: int
    delay_ms: int
    disposal: int
    rgba: np.ndarray  # the whole canvas after this frame is drawn

    def histogram(self, bins: int = 4) -> list[int]:
        """Visible pixels by colour: ``bins`` levels of red, green and blue."""
        seen = self.rgba[self.rgba[..., 3] > 0][:, :3].astype(np.int64) * bins // 256
        return np.bincount((seen[:, 0] * bins + seen[:, 1]) * bins + seen[:, 2], minlength=bins**3).tolist()


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    return np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3), at + 3 * n


def decode(data: bytes, most_pixels: int = MOST_PIXELS) -> list[Frame]:
    """All frames of an animation."""
    return list(rendered(data, most_pixels))


def rendered(data: bytes, most_pixels: int = MOST_PIXELS) -> Iterator[Frame]:
    """The frames one by one, so that only the canvas is held; anything that is no GIF raises ValueError."""
    try:
        yield from _rendered(data, most_pixels)
    except (IndexError, struct.error) as e:
        raise ValueError(f"broken GIF: {e}") from e


def _rendered(data: bytes, most_pixels: int) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > most_pixels:
        raise ValueError(f"a canvas of {width} x {height}")
    everywhere, at = _palette(data, 13, flags)
    canvas = np.zeros((height, width, 4), np.uint8)
    index, delay, disposal, clear, clock = 0, 0, 0, None, 0
    while (kind := data[at]) != 0x3B:
        if kind == 0x21:
            body, after = _blocks(data, at + 2)
            if data[at + 1] == 0xF9:
                bits, hundredths, through = struct.unpack_from("<BHB", body)
                delay, disposal, clear = hundredths * 10, bits >> 2 & 7, through if bits & 1 else None
            at = after
            continue
        if kind != 0x2C:
            raise ValueError(f"unknown block {kind:#x}")
        left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        own, at = _palette(data, at + 10, flags)
        colours = everywhere if own is None else own
        if colours is None:
            raise ValueError("no palette")
        if w * h > most_pixels:
            raise ValueError(f"a frame of {w} x {h}")
        least = data[at]
        stream, at = _blocks(data, at + 1)
        samples = np.frombuffer(lzw_decode(stream, least, w * h), np.uint8)
        if len(samples) < w * h:
            raise ValueError("too few samples")
        samples = samples.reshape(h, w)
        if flags & 0x40:
            order = [y for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(first, h, step)]
            plain = np.empty_like(samples)
            plain[order] = samples
            samples = plain
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        drawn = samples[: area.shape[0], : area.shape[1]]
        painted = _rgba(colours)[drawn]
        if clear is None:
            area[:] = painted.view(np.uint8).reshape(*drawn.shape, 4)
        else:
            shown = drawn != clear
            area[shown] = painted.view(np.uint8).reshape(*drawn.shape, 4)[shown]
        yield Frame(index, clock, delay, disposal, canvas.copy())
        index += 1
        clock += delay
        if disposal == 2:
            area[:] = 0
        elif before is not None:
            canvas = before
        delay, disposal, clear = 0, 0, None


def _rgba(colours: np.ndarray) -> np.ndarray:
    """The palette as 256 opaque 32-bit pixels; an index beyond it takes its last colour."""
    full = np.concatenate([colours, np.repeat(colours[-1:], 256 - len(colours), 0)])
    return np.ascontiguousarray(np.column_stack([full, np.full(256, 255, np.uint8)])).view(np.uint32).reshape(-1)


def encode(frames: list[np.ndarray], palette: np.ndarray = GREY, delay_ms: int = 100, disposal: int = 1) -> bytes:
    """An animation of 8-bit samples, each frame at the top left of a canvas that holds the largest."""
    height, width = max(f.shape[0] for f in frames), max(f.shape[1] for f in frames)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette.tobytes()]
    for f in frames:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2, delay_ms // 10, 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, f.shape[1], f.shape[0], 0) + b"\x08")
        stream = lzw_encode(f.tobytes())
        out += [x for i in range(0, len(stream), 255) for x in (bytes([len(stream[i : i + 255])]), stream[i : i + 255])]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


def frames(df: DataFrame, id_col: str, content_col: str, bins: int = 4, most_pixels: int = MOST_PIXELS) -> DataFrame:
    """Per GIF one row with its timed frames, and an error where it breaks off or is none: id, frames array<struct<index, at_ms, delay_ms, width, height, rgba, histogram>>, error."""
    import pyspark.sql.functions as F

    base = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{content_col}`").cast("binary").alias("_content"))

    def one(raw: bytes | None) -> tuple[list[dict], str | None]:
        found: list[dict] = []
        try:
            for f in rendered(raw, most_pixels) if raw is not None else ():
                found.append({"index": f.index, "at_ms": f.at_ms, "delay_ms": f.delay_ms, "width": f.rgba.shape[1], "height": f.rgba.shape[0], "rgba": f.rgba.tobytes(), "histogram": f.histogram(bins)})
        except ValueError as e:
            return found, str(e)
        return found, None

    def run(batch: pa.RecordBatch) -> dict:
        rows = [one(x) for x in batch.column("_content").to_pylist()]
        return {"_id": batch.column("_id"), "frames": [r[0] for r in rows], "error": [r[1] for r in rows]}

    kind = dict(base.dtypes)["_id"]
    frame = "struct<index: int, at_ms: long, delay_ms: long, width: int, height: int, rgba: binary, histogram: array<long>>"
    return map_rows(base, run, f"_id {kind}, frames array<{frame}>, error string").withColumnRenamed("_id", id_col)


# --- texts as grey animations -----------------------------------------------------------------

ROW, FRAME_ROWS = 576, 64


def store(text: bytes) -> bytes:
    """A text, padded with bytes 255 to rows of 576, as the samples of a grey animation of 64 rows a frame."""
    padded = text + b"\xff" * (-len(text) % ROW or ROW * (not text))
    rows = np.frombuffer(padded, np.uint8).reshape(-1, ROW)
    return encode([rows[i : i + FRAME_ROWS] for i in range(0, len(rows), FRAME_ROWS)])


def payload(stored: bytes) -> tuple[bytes, int, int]:
    """The samples that ``store`` put in, off the rendered frames, the number of frames and their time in ms."""
    samples, n, ms = [], 0, 0
    heights = _frame_heights(stored)
    for f in rendered(stored):
        samples.append(f.rgba[: heights[n], :, 0].tobytes())
        n, ms = n + 1, ms + f.delay_ms
    return b"".join(samples), n, ms


def _frame_heights(data: bytes) -> list[int]:
    flags, at, out = data[10], 13, []
    _, at = _palette(data, at, flags)
    while data[at] != 0x3B:
        if data[at] == 0x2C:
            out.append(struct.unpack_from("<H", data, at + 7)[0])
            _, at = _palette(data, at + 10, data[at + 9])
            _, at = _blocks(data, at + 1)
        else:
            _, at = _blocks(data, at + 2)
    return out


def op8_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    def one(text: bytes) -> dict:
        stored = store(text)
        back, n, ms = payload(stored)
        levels = np.bincount(np.frombuffer(back, np.uint8) >> 4, minlength=16)
        return {
            "n_bytes": len(text),
            "payload_bytes": len(back),
            "payload_sha256": hashlib.sha256(back).hexdigest(),
            "tail_crc32": zlib.crc32(back[-32:]),
            "media_bytes": len(stored),
            "media_sha256": hashlib.sha256(stored).hexdigest(),
            "feature": f"frames={n};ms={ms};grey16=" + ",".join(map(str, levels)),
        }

    def run(batch: pa.RecordBatch) -> dict:
        rows = [one(x) for x in text_bytes(batch.column("_text"))]
        return {"doc_id": batch.column("_id")} | {k: [r[k] for r in rows] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_rows(prepare(documents(spark, sf_dir), "doc_id", "text"), run, schema)
