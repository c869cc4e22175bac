"""Progressive JPEG: texts stored as DCT coefficients, and a decoder to coefficients and RGB.

Stored form.  A payload block of 64 bytes becomes the 64 zigzag coefficients of one 8x8 block, so
nothing is lost to the transform: the unit of the format is the coefficient.  Blocks fill the Y, Cb
and Cr planes of a 4:2:0 image in turn.  Each plane is sent as five scans: DC, AC 1-5 and AC 6-63 at
successive-approximation level 1, then one refinement bit for DC and for AC 1-63.  The Huffman
tables are chosen so that every DC difference and every first-pass AC coefficient takes one byte
and refinement is a plain bit run after an end-of-band run, which lets numpy code whole planes.

The decoder reads any progressive stream of 8-bit samples (interleaved DC, any spectral bands,
end-of-band runs, restart intervals) with a symbol-by-symbol reader, and takes the numpy path for a
scan whose table and history show that it applies.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load, written

# Fixed values of the format: zigzag order (natural index of the k-th coefficient).
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p % 8 if (p // 8 + p % 8) % 2 == 0 else p // 8)))
RUN_BLOCKS = 16384  # blocks in one end-of-band run; a multiple of 8 keeps runs byte-aligned

SOI, EOI, SOF2, DHT, DQT, DRI, SOS, COM = 0xD8, 0xD9, 0xC2, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE
_MARKER = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")


def _basis() -> np.ndarray:
    """Row k: the 8x8 samples of a unit k-th zigzag coefficient, flattened."""
    x = np.arange(8)
    c = np.cos((2 * x[:, None] + 1) * x[None, :] * np.pi / 16) * np.where(x == 0, np.sqrt(0.5), 1.0) / 2
    full = np.einsum("yv,xu->vuyx", c, c).reshape(64, 64)
    return full[ZIGZAG].astype(np.float32)


BASIS = _basis()


def _codes(lengths: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) of the canonical Huffman table."""
    out, code, last = {}, 0, lengths[0] if lengths else 0
    for n, s in zip(lengths, symbols, strict=True):
        code <<= n - last
        out[s] = (code, n)
        code, last = code + 1, n
    return out


# Difference of category s: a code of 8 - s bits, then s bits, so one byte in all.
DC_TABLE = ([1, 2, 3, 4, 5, 6, 7, 8], [7, 6, 5, 4, 3, 2, 1, 0])
# First-pass AC: category 7 without a run, by one bit, then 7 bits: one byte in all.
AC_TABLE = ([1], [0x07])
# End-of-band runs of category n: a code of 16 - n bits, then n bits: two bytes in all.
EOB_TABLE = (list(range(2, 17)), [n << 4 for n in range(14, -1, -1)])


def _dc_lut() -> np.ndarray:
    codes, out = _codes(*DC_TABLE), np.zeros(255, np.uint8)
    for d in range(-127, 128):
        s = abs(d).bit_length()
        code, _ = codes[s]
        out[d + 127] = code << s | (d if d >= 0 else d + (1 << s) - 1)
    return out


_b = np.arange(256)
DC_LUT = _dc_lut()
AC_LUT = np.where(_b < 128, 64 + (_b & 127) // 2, 63 - (_b & 127) // 2).astype(np.uint8)
AC_VALUE = np.where(_b < 128, 128 + (_b & 127), -128 - (_b & 127)).astype(np.int16)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, slot: int, table: tuple[list[int], list[int]]) -> bytes:
    lengths, symbols = table
    return bytes([kind << 4 | slot, *(lengths.count(n) for n in range(1, 17)), *symbols])


def _sos(comp: int, start: int, end: int, high: int, low: int, dc: int = 0, ac: int = 0) -> bytes:
    return _segment(SOS, bytes([1, comp, dc << 4 | ac, start, end, high << 4 | low]))


def _bits(bits: np.ndarray) -> bytes:
    """Packed bits, padded with ones, without byte stuffing."""
    raw = bytearray(np.packbits(bits).tobytes())
    if len(bits) % 8:
        raw[-1] |= (1 << (8 - len(bits) % 8)) - 1
    return bytes(raw)


HEAD = b"\xff\xd8" + _segment(DQT, bytes([0]) + b"\x01" * 64)
TABLES = _segment(DHT, _table(0, 0, DC_TABLE) + _table(1, 0, AC_TABLE) + _table(1, 1, EOB_TABLE))
EOB_CODES = _codes(*EOB_TABLE)


def padded(raw: bytes) -> bytes:
    """``raw`` and bytes 0 up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % 64 if raw else 64)


def encode(raw: bytes) -> bytes:
    """The progressive JPEG that holds ``raw``; its length is in a comment segment."""
    payload = padded(raw)
    n = len(payload) // 64
    mcus = -(-n // 6)
    cols = int(np.ceil(np.sqrt(mcus)))
    rows = -(-mcus // cols)
    if max(cols, rows) * 16 > 65535:
        raise ValueError("the text exceeds the largest image of the format")
    total = rows * cols
    blocks = np.zeros((6 * total, 64), np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    frame = struct.pack(">BHHB", 8, rows * 16, cols * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [HEAD, _segment(COM, b"payload %d" % len(raw)), _segment(SOF2, frame), TABLES]
    first = AC_LUT[blocks]
    for comp, plane in ((1, slice(0, 4 * total)), (2, slice(4 * total, 5 * total)), (3, slice(5 * total, 6 * total))):
        b, f = blocks[plane], first[plane]
        dc = b[:, 0].astype(np.int16)
        out += [_sos(comp, 0, 0, 0, 1), DC_LUT[np.diff(dc >> 1, prepend=np.int16(0)) + 127].tobytes()]
        out += [_sos(comp, 1, 5, 0, 1), f[:, 1:6].tobytes(), _sos(comp, 6, 63, 0, 1), f[:, 6:].tobytes()]
        out += [_sos(comp, 0, 0, 1, 0), _bits(b[:, 0] & 1).replace(b"\xff", b"\xff\x00")]
        low, runs = b[:, 1:] & 1, []
        for at in range(0, len(b), RUN_BLOCKS):
            run = low[at : at + RUN_BLOCKS]
            k = len(run).bit_length() - 1
            runs += [(EOB_CODES[k << 4][0] << k | len(run) - (1 << k)).to_bytes(2, "big"), _bits(run.reshape(-1))]
        out += [_sos(comp, 1, 63, 1, 0, ac=1), b"".join(runs).replace(b"\xff", b"\xff\x00")]
    out.append(b"\xff\xd9")
    return b"".join(out)


@dataclass
class Component:
    h: int
    v: int
    quant: int
    across: int = 0  # blocks a row, with those that fill the last unit
    down: int = 0
    wide: int = 0  # blocks a row of the component itself
    high: int = 0
    coef: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int16))  # zigzag order


@dataclass
class Image:
    width: int
    height: int
    components: dict[int, Component]
    quants: dict[int, np.ndarray]
    comment: bytes = b""


class _Reader:
    """Bits of one restart interval, stuffing removed."""

    def __init__(self, data: bytes):
        self.data, self.at, self.bits = data, 0, len(data) * 8

    def take(self, n: int) -> int:
        if not n:
            return 0
        end = self.at + n
        if end > self.bits:
            raise ValueError("the scan ends early")
        lo, hi = self.at >> 3, (end + 7) >> 3
        word = int.from_bytes(self.data[lo:hi], "big")
        self.at = end
        return word >> (hi * 8 - end) & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("no such Huffman code")

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


class _Table:
    def __init__(self, lengths: list[int], symbols: list[int]):
        self.pairs = (lengths, symbols)
        self.decode = {(n, c): s for s, (c, n) in _codes(lengths, symbols).items()}


def _byte_differences(table: _Table) -> np.ndarray | None:
    """Byte -> difference, where each symbol of a DC table and its bits fill one byte."""
    lengths, symbols = table.pairs
    if any(n + s != 8 for n, s in zip(lengths, symbols, strict=True)):
        return None
    out = np.full(256, 32767, np.int16)
    for s, (code, _) in _codes(lengths, symbols).items():
        for v in range(1 << s):
            out[code << s | v] = v if not s or v >> (s - 1) else v - (1 << s) + 1
    return out


class Decoder:
    """Accumulates the scans of one stream into coefficient arrays."""

    def __init__(self, data: bytes):
        self.data, self.tables, self.quants, self.restart = data, {}, {}, 0
        self.image: Image | None = None
        self._luts: dict[int, np.ndarray | None] = {}

    def run(self) -> Image:
        data, at, comment = self.data, 2, b""
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG stream")
        while True:
            while data[at + 1] == 0xFF:
                at += 1
            marker = data[at + 1]
            if marker == EOI:
                break
            size = struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == DQT:
                self._dqt(body)
            elif marker == DHT:
                self._dht(body)
            elif marker == SOF2:
                self._frame(body)
            elif marker == DRI:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == COM:
                comment = body
            elif marker == SOS:
                end = _MARKER.search(data, at).start()
                self._scan(body, data[at:end])
                at = end
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("only progressive Huffman frames are read")
        self.image.comment = comment
        return self.image

    def _dqt(self, body: bytes) -> None:
        while body:
            wide, slot = body[0] >> 4, body[0] & 15
            n = 128 if wide else 64
            self.quants[slot] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.float32)
            body = body[1 + n :]

    def _dht(self, body: bytes) -> None:
        while body:
            counts = body[1:17]
            lengths = [n for n, k in enumerate(counts, 1) for _ in range(k)]
            key, symbols = body[0], list(body[17 : 17 + len(lengths)])
            self.tables[key] = _Table(lengths, symbols)
            self._luts.pop(key, None)
            body = body[17 + len(lengths) :]

    def _frame(self, body: bytes) -> None:
        _, height, width, n = struct.unpack_from(">BHHB", body)
        comps = {body[6 + 3 * i]: Component(body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
        hmax, vmax = max(c.h for c in comps.values()), max(c.v for c in comps.values())
        self.mcu = (-(-width // (8 * hmax)), -(-height // (8 * vmax)))
        for c in comps.values():
            c.across, c.down = self.mcu[0] * c.h, self.mcu[1] * c.v
            c.wide, c.high = -(-(-(-width * c.h // hmax)) // 8), -(-(-(-height * c.v // vmax)) // 8)
            c.coef = np.zeros((c.across * c.down, 64), np.int16)
        self.image = Image(width, height, comps, self.quants)

    def _scan(self, head: bytes, raw: bytes) -> None:
        n = head[0]
        parts = [(self.image.components[head[1 + 2 * i]], head[2 + 2 * i] >> 4, head[2 + 2 * i] & 15) for i in range(n)]
        start, end, high, low = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
        if n == 1:
            c = parts[0][0]
            if not self.restart and c.wide == c.across and c.high == c.down and self._fast(c, parts[0], start, end, high, low, raw):
                return
            units = [[(c, parts[0], y * c.across + x)] for y in range(c.high) for x in range(c.wide)]
        else:
            units = [
                [(c, p, (my * c.v + v) * c.across + mx * c.h + h) for p in parts for c in (p[0],) for v in range(c.v) for h in range(c.h)]
                for my in range(self.mcu[1])
                for mx in range(self.mcu[0])
            ]
        spans = re.split(rb"\xff[\xd0-\xd7]", raw) if self.restart else [raw]
        each = self.restart or len(units)
        for k, span in enumerate(spans):
            self._units(units[k * each : (k + 1) * each], start, end, high, low, _Reader(span.replace(b"\xff\x00", b"\xff")))

    def _fast(self, c: Component, part: tuple, start: int, end: int, high: int, low: int, raw: bytes) -> bool:
        _, dc, ac = part
        blocks = len(c.coef)
        if start == 0 and not high:
            if dc not in self._luts:
                self._luts[dc] = _byte_differences(self.tables[dc])
            lut = self._luts[dc]
            if lut is None or len(raw) != blocks:
                return False
            c.coef[:, 0] = np.cumsum(lut[np.frombuffer(raw, np.uint8)], dtype=np.int32) << low
            return True
        if start == 0:
            raw = raw.replace(b"\xff\x00", b"\xff")
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=blocks)
            c.coef[:, 0] |= bits.astype(np.int16) << low
            return True
        if not high:
            size = blocks * (end - start + 1)
            if self.tables[16 | ac].pairs != AC_TABLE or len(raw) != size:
                return False
            v = np.frombuffer(raw, np.uint8).astype(np.int16).reshape(blocks, -1)
            c.coef[:, start : end + 1] = np.where(v >= 64, v, v - 127) << low
            return True
        band = c.coef[:, start : end + 1]
        if not band.all():
            return False
        raw, decode, width = raw.replace(b"\xff\x00", b"\xff"), self.tables[16 | ac].decode, end - start + 1
        reader, at, found = _Reader(raw), 0, []
        while at < blocks:  # one end-of-band run after the other
            s = reader.symbol(decode)
            if s & 15 or s >> 4 == 15:
                return False
            run = (1 << (s >> 4)) + reader.take(s >> 4)
            lead = reader.at & 7
            bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=reader.at >> 3), count=lead + run * width)[lead:]
            reader.at += run * width
            found.append(bits)
            at += run
        bits = np.concatenate(found).reshape(blocks, width).astype(np.int16) << low
        band += np.where(band > 0, bits, -bits)
        return True

    def _units(self, units: list, start: int, end: int, high: int, low: int, r: _Reader) -> None:
        pred: dict[int, int] = {}
        eob, step = 0, 1 << low
        for unit in units:
            for c, (_, dc, ac), at in unit:
                coef = c.coef[at]
                if start == 0:
                    if high:
                        coef[0] |= r.take(1) << low
                    else:
                        pred[id(c)] = pred.get(id(c), 0) + r.signed(r.symbol(self.tables[dc].decode))
                        coef[0] = pred[id(c)] << low
                    continue
                table, k = self.tables[16 | ac].decode, start
                if not high:
                    if eob:
                        eob -= 1
                        continue
                    while k <= end:
                        s = r.symbol(table)
                        run, size = s >> 4, s & 15
                        if size:
                            k += run
                            coef[k] = r.signed(size) * step
                            k += 1
                        elif run == 15:
                            k += 16
                        else:
                            eob = (1 << run) + r.take(run) - 1
                            break
                    continue
                while k <= end and not eob:
                    s = r.symbol(table)
                    run, size = s >> 4, s & 15
                    new = 0
                    if size:
                        new = step if r.take(1) else -step
                    elif run < 15:
                        eob = (1 << run) + r.take(run)
                        break
                    while k <= end:
                        if coef[k]:
                            if r.take(1):
                                coef[k] += step if coef[k] > 0 else -step
                        else:
                            if not run:
                                if new:
                                    coef[k] = new
                                k += 1
                                break
                            run -= 1
                        k += 1
                if eob:
                    while k <= end:
                        if coef[k] and r.take(1):
                            coef[k] += step if coef[k] > 0 else -step
                        k += 1
                    eob -= 1


def samples(image: Image, c: Component) -> np.ndarray:
    """Float samples of one component's plane, without the level shift."""
    q = image.quants[c.quant]
    coef = c.coef.astype(np.float32)
    if (q != 1).any():
        coef *= q
    return (coef @ BASIS).reshape(c.down, c.across, 8, 8).swapaxes(1, 2).reshape(c.down * 8, c.across * 8)


def rgb(image: Image) -> np.ndarray:
    """The (height, width, 3) uint8 tensor; chroma is replicated to full resolution."""
    comps = list(image.components.values())
    hmax, vmax = max(c.h for c in comps), max(c.v for c in comps)
    planes = [samples(image, c) for c in comps]
    up = lambda p, c: np.repeat(np.repeat(p, vmax // c.v, 0), hmax // c.h, 1)[: image.height, : image.width]
    y = up(planes[0], comps[0]) + np.float32(128.5)
    out = np.empty((image.height, image.width, 3), np.uint8)
    if len(comps) == 1:
        out[:] = np.clip(y, 0, 255)[:, :, None]
        return out
    cb, cr = planes[1], planes[2]  # added at their own resolution, then replicated
    if (comps[1].h, comps[1].v) != (comps[2].h, comps[2].v):
        cb, cr = up(cb, comps[1]), up(cr, comps[2])
        comps = [comps[0], comps[0], comps[0]]
    for i, add in enumerate((np.float32(1.402) * cr, np.float32(-0.344136) * cb - np.float32(0.714136) * cr, np.float32(1.772) * cb)):
        plane = y + up(add, comps[1])
        np.clip(plane, 0, 255, out=plane)
        out[:, :, i] = plane
    return out


def payload(image: Image) -> bytes:
    """The stored bytes with their padding, read from the coefficient arrays."""
    size = len(padded(bytes(int(image.comment.split()[1]))))
    coef = np.concatenate([c.coef for c in image.components.values()])[: size // 64]
    out = (np.abs(coef) & 127).astype(np.uint8) | (coef < 0).astype(np.uint8) << 7
    out[:, 0] = coef[:, 0]
    return out.tobytes()


def decode(data: bytes) -> Image:
    return Decoder(data).run()


DECODED = {
    "media": "binary",
    "height": "int",
    "width": "int",
    "rgb": "binary",
    "payload": "binary",
    "payload_bytes": "long",
    "payload_sha256": "string",
    "tail_crc32": "long",
    "media_bytes": "long",
    "media_sha256": "string",
    "feature": "string",
}
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
HELD = 8 << 20  # bytes of results that a worker gathers before it passes them on


def _rows(batches: Iterator[pa.RecordBatch], made_of: Callable[..., tuple], kinds: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """The first column of each batch and the values that ``made_of`` gives for the others, in parts of bounded size."""
    for b in batches:
        begin, held, made = 0, 0, []
        for at in range(b.num_rows):
            made.append(made_of(*(c[at].as_py() for c in b.columns[1:])))
            held += sum(len(x) for x in made[-1] if isinstance(x, bytes))
            if held >= HELD or len(made) == 1024 or at + 1 == b.num_rows:
                cols = [pa.array([m[i] for m in made], _ARROW[k]) for i, k in enumerate(kinds.values())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, len(made)), *cols], names=["id", *kinds])
                begin, held, made = at + 1, 0, []


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media) for every row: the text's length in bytes and the text as a progressive JPEG.

    A null text is stored as an empty one; equal texts give equal media; other columns are not read.  The whole
    text is stored, up to the format's 65535 x 65535 samples (2.8 GB of text).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def made(text: str | None) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass")
        return len(raw), encode(raw)

    kinds = {"n_bytes": "long", "media": "binary"}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _rows(batches, made, kinds), f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def decode_media(stored: DataFrame, columns: tuple[str, ...] = ("height", "width", "rgb"), id_col: str = "doc_id") -> DataFrame:
    """The id of each row of a table of media and the asked ones of DECODED.

    ``rgb`` is the full-resolution tensor (height x width x 3, row-major bytes) of the stored bytes; ``feature``
    is the image's size and its rounded mean of each channel.  Null media give nulls.
    """
    kind = stored.schema[id_col].dataType.simpleString()
    wants = set(columns)

    def made(media: bytes | None) -> tuple:
        if media is None:
            return (None,) * len(columns)
        got: dict[str, object] = {"media": media, "media_bytes": len(media)}
        if "media_sha256" in wants:
            got["media_sha256"] = hashlib.sha256(media).hexdigest()
        if wants - {"media", "media_bytes", "media_sha256"}:
            image = decode(media)
            got |= {"height": image.height, "width": image.width}
            if wants & {"payload", "payload_bytes", "payload_sha256", "tail_crc32"}:
                back = payload(image)
                got |= {"payload": back, "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-64:])}
            if wants & {"rgb", "feature"}:
                pixels = rgb(image)
                got["rgb"] = pixels.tobytes() if "rgb" in wants else None
                mean = pixels.reshape(-1, 3).mean(axis=0)
                got["feature"] = f"{image.width}x{image.height}:" + ",".join(str(round(float(m))) for m in mean)
        return tuple(got[c] for c in columns)

    kinds = {c: DECODED[c] for c in columns}
    schema = f"id {kind}, " + ", ".join(f"{c} {k}" for c, k in kinds.items())
    rows = stored.select(F.col(id_col).alias("id"), "media")
    return rows.mapInArrow(lambda batches: _rows(batches, made, kinds), schema).withColumnRenamed("id", id_col)


def op2_progressive_jpeg(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as a stored JPEG: media are written to the shared folder, read back and decoded.

    The digest columns and ``rgb``, the full-resolution tensor, come from the bytes read back.  A null text is an
    empty one; equal texts have equal values.
    """
    stored = written(encode_media(load(spark, sf_dir, "documents")), "media")
    digest = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "height", "width", "rgb")
    out = decode_media(stored.select(F.struct("doc_id", "n_bytes").alias("id"), "media"), digest, "id")
    return out.select("id.doc_id", "id.n_bytes", *digest)
