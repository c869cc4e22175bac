from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from tesserae.llm import jpeg


class Slow(jpeg.Decoder):
    """The symbol-by-symbol reader alone."""

    def _fast(self, *args) -> bool:
        return False


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4000])
def test_round_trip_and_both_readers(n):
    raw = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
    stored = jpeg.encode(raw)
    fast, slow = jpeg.decode(stored), Slow(stored).run()
    assert jpeg.payload(fast) == jpeg.payload(slow) == jpeg.padded(raw)
    assert (jpeg.rgb(fast) == jpeg.rgb(slow)).all()


def test_long_runs():
    raw = np.random.default_rng(1).integers(0, 256, 64 * 6 * 17000, dtype=np.uint8).tobytes()  # end-of-band runs beyond one
    assert jpeg.payload(jpeg.decode(jpeg.encode(raw))) == raw


class Bits:
    def __init__(self):
        self.s = []

    def put(self, v, n):
        self.s.append(format(v, f"0{n}b") if n else "")

    def symbol(self, v):
        self.put(v, 8) if v < 255 else None  # every symbol below 255 has itself as its 8-bit code

    def done(self):
        s = "".join(self.s)
        s += "1" * (-len(s) % 8)
        return bytes(int(s[i : i + 8], 2) for i in range(0, len(s), 8)).replace(b"\xff", b"\xff\x00")


def ordinary_stream(coefs, width, height):
    """A progressive stream of three components with interleaved DC, end-of-band runs and refinement with new coefficients."""
    table = ([8] * 255, list(range(255)))
    out = [b"\xff\xd8", jpeg._segment(jpeg.DQT, b"\x00" + bytes(range(1, 65)))]
    frame = jpeg.struct.pack(">BHHB", 8, height, width, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out += [jpeg._segment(jpeg.SOF2, frame), jpeg._segment(jpeg.DHT, jpeg._table(0, 0, table) + jpeg._table(1, 0, table))]
    mx, my = -(-width // 16), -(-height // 16)
    units = [(c, (y * v + dv) * mx * h + x * h + dh) for y in range(my) for x in range(mx) for c, h, v in ((0, 2, 2), (1, 1, 1), (2, 1, 1)) for dv in range(v) for dh in range(h)]
    head = lambda comps, s, e, hi, lo: jpeg._segment(jpeg.SOS, bytes([len(comps), *[b for c in comps for b in (c + 1, 0)], s, e, hi << 4 | lo]))

    def magnitude(b, v):
        n = abs(v).bit_length()
        b.put(v if v >= 0 else v + (1 << n) - 1, n)

    b, pred = Bits(), [0, 0, 0]
    for c, k in units:
        v = int(coefs[c][k, 0]) >> 1
        b.symbol(abs(v - pred[c]).bit_length())
        magnitude(b, v - pred[c])
        pred[c] = v
    out += [head([0, 1, 2], 0, 0, 0, 1), b.done()]
    b = Bits()
    for c, k in units:
        b.put(int(coefs[c][k, 0]) & 1, 1)
    out += [head([0, 1, 2], 0, 0, 1, 0), b.done()]
    for c, plane in enumerate(coefs):
        h = 2 if c == 0 else 1
        wide, high = -(-(-(-width * h // 2)) // 8), -(-(-(-height * h // 2)) // 8)
        own = [plane[y * mx * h + x] for y in range(high) for x in range(wide)]
        first = [np.sign(p) * (np.abs(p) >> 1) for p in own]
        for lo, hi in ((1, 5), (6, 63)):
            b, run = Bits(), 0

            def flush(b, run):
                if run:
                    n = run.bit_length() - 1
                    b.symbol(n << 4)
                    b.put(run - (1 << n), n)

            for p in first:
                nz = [k for k in range(lo, hi + 1) if p[k]]
                if not nz:
                    run += 1
                    continue
                flush(b, run)
                run, at = 0, lo
                for k in nz:
                    while k - at > 15:
                        b.symbol(0xF0)
                        at += 16
                    b.symbol((k - at) << 4 | int(abs(p[k])).bit_length())
                    magnitude(b, int(p[k]))
                    at = k + 1
                if at <= hi:
                    run = 1
            flush(b, run)
            out += [head([c], lo, hi, 0, 1), b.done()]
        b = Bits()
        for p, f in zip(own, first, strict=True):
            new = [k for k in range(1, 64) if p[k] and not f[k]]
            at = 1
            for k in new:
                zeros = [j for j in range(at, k) if not f[j]]
                while len(zeros) > 15:
                    b.symbol(0xF0)
                    stop = zeros[15]
                    for j in range(at, stop + 1):
                        if f[j]:
                            b.put(int(abs(p[j])) & 1, 1)
                    at, zeros = stop + 1, zeros[16:]
                b.symbol(len(zeros) << 4 | 1)
                b.put(int(p[k] > 0), 1)
                for j in range(at, k):
                    if f[j]:
                        b.put(int(abs(p[j])) & 1, 1)
                at = k + 1
            if at <= 63:
                b.symbol(0)
                for j in range(at, 64):
                    if f[j]:
                        b.put(int(abs(p[j])) & 1, 1)
        out += [head([c], 1, 63, 1, 0), b.done()]
    return b"".join(out) + b"\xff\xd9"


def test_ordinary_progressive_stream():
    rng = np.random.default_rng(5)
    width, height = 40, 24
    coefs = []
    for n in (6 * 4, 6, 6):
        p = np.where(rng.random((n, 64)) < 0.15, rng.integers(-9, 10, (n, 64)), 0).astype(np.int16)
        p[rng.random(n) < 0.3, 1:] = 0
        p[:, 0] = rng.integers(-200, 200, n)
        coefs.append(p)
    image = jpeg.decode(ordinary_stream(coefs, width, height))
    mx = 3
    for c, (got, want) in enumerate(zip(image.components.values(), coefs, strict=True)):
        h = 2 if c == 0 else 1
        wide, high = -(-(-(-width * h // 2)) // 8), -(-(-(-height * h // 2)) // 8)
        for y in range(high):
            for x in range(wide):
                assert (got.coef[y * mx * h + x] == want[y * mx * h + x]).all()
    assert jpeg.rgb(image).shape == (24, 40, 3)
    # the transform, against its definition
    c = image.components[1]
    q = np.zeros((8, 8))
    for k in range(64):
        q[jpeg.ZIGZAG[k] // 8, jpeg.ZIGZAG[k] % 8] = c.coef[0, k] * (k + 1)
    a = lambda u: 2**-0.5 if u == 0 else 1.0
    want = sum(a(u) * a(v) * q[v, u] * np.cos(11 * u * np.pi / 16) * np.cos(7 * v * np.pi / 16) for u in range(8) for v in range(8)) / 4
    assert abs(jpeg.samples(image, c)[3, 5] - want) < 1e-2


def test_columns(spark, tmp_path):
    rows = [(1, "héllo", "x"), (2, None, "y"), (3, "", None), (4, "héllo", "z"), (None, "a" * 5000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    stored = jpeg.encode_media(df)
    stored.write.parquet(str(tmp_path / "media"))
    stored = spark.read.parquet(str(tmp_path / "media"))
    sizes = {r["doc_id"]: r["n_bytes"] for r in stored.collect()}
    asked = ("payload_bytes", "payload_sha256", "tail_crc32", "media", "media_sha256", "feature", "rgb", "height", "width")
    decoded = jpeg.decode_media(stored, asked)
    decoded.write.parquet(str(tmp_path / "rgb"))
    got = {r["doc_id"]: r for r in spark.read.parquet(str(tmp_path / "rgb")).collect()}
    pay = "héllo".encode().ljust(64, b"\0")
    assert (sizes[1], got[1]["payload_bytes"], got[1]["payload_sha256"], got[1]["tail_crc32"]) == (6, 64, hashlib.sha256(pay).hexdigest(), zlib.crc32(pay))
    assert got[1]["media_sha256"] == got[4]["media_sha256"] == hashlib.sha256(bytes(got[1]["media"])).hexdigest() and got[1]["feature"] == got[4]["feature"]
    assert got[2]["payload_sha256"] == got[3]["payload_sha256"] and sizes[2] == 0
    for r in got.values():
        assert bytes(r["rgb"]) == jpeg.rgb(jpeg.decode(bytes(r["media"]))).tobytes() and len(r["rgb"]) == r["height"] * r["width"] * 3
    assert jpeg.decode_media(jpeg.encode_media(df.limit(0))).count() == 0
    assert jpeg.decode_media(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()["rgb"] is None


def test_results_are_passed_on_in_bounded_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(jpeg, "HELD", 3000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * 1000 * (i % 3) for i in range(9)])], names=["id", "text"])
    parts = list(jpeg._rows([batch], lambda t: (t.encode(),), {"b": "binary"}))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9)) and [len(b) for p in parts for b in p.column(1).to_pylist()] == [1000 * (i % 3) for i in range(9)]
    assert len(parts) == 3


def test_query_stores_and_reads_back(spark, monkeypatch):
    import os

    import pytest

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    made = []
    keep = jpeg.written
    monkeypatch.setattr(jpeg, "written", lambda df, name: made.append(keep(df, name)) or made[-1])
    rows = {r["doc_id"]: r for r in jpeg.op2_progressive_jpeg(spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    media = {r["doc_id"]: bytes(r["media"]) for r in made[0].collect()}  # the stored table
    assert set(rows) == set(texts) == set(media)
    for i, r in rows.items():
        raw = texts[i].encode()
        assert (r["n_bytes"], r["payload_sha256"]) == (len(raw), hashlib.sha256(jpeg.padded(raw)).hexdigest())
        assert r["media_sha256"] == hashlib.sha256(media[i]).hexdigest() and len(r["rgb"]) == 3 * r["height"] * r["width"]
