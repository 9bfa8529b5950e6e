"""Reading, checking and preparing images."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from docledger.sources import images as I
from docledger.sources.ocr import ImageBackend, recognise


def _filtered(pixels: np.ndarray, kind: int) -> bytes:
    """A PNG with one filter for all lines, by the definition of the filters."""
    height, width, step = pixels.shape
    out, above = b"", [0] * (width * step)
    for y in range(height):
        line, done = pixels[y].ravel().tolist(), []
        for k, x in enumerate(line):
            a, b, c = (line[k - step] if k >= step else 0), above[k], (above[k - step] if k >= step else 0)
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            done.append((x - (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
        out += bytes([kind, *done])
        above = line
    plain = I.write_png(pixels if step == 3 else pixels[:, :, 0])
    body = zlib.compress(out)
    data = struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body))
    return plain[:33] + data + plain[-12:]


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("step", [1, 3])
def test_png(kind, step):
    pixels = np.random.default_rng(kind).integers(0, 256, (7, 5, step)).astype(np.uint8)
    got = I.read_png(_filtered(pixels, kind))
    assert (got == (pixels if step == 3 else pixels[:, :, 0])).all()


def test_verify():
    png = I.write_png(np.zeros((30, 30, 3), np.uint8))
    assert I.verify(png, ".png") and not I.verify(png[:-5], ".png") and not I.verify(png[:60] + b"x" + png[61:], ".png") and not I.verify(png, ".jpg")
    frame = b"\xff\xc0\x00\x0b\x08\x00\x01\x00\x01\x01\x01\x11\x00"
    jpeg = b"\xff\xd8" + frame + b"\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00" + b"\x12\x34" + b"\xff\xd9"
    assert I.verify(jpeg, ".jpeg") and not I.verify(jpeg[:-2], ".jpg") and not I.verify(b"\xff\xd8\xff", ".jpg")
    entries = [(256, 3, 1, 2), (257, 3, 1, 2), (273, 4, 1, 8), (279, 4, 1, 4)]
    tiff = b"II*\0" + struct.pack("<I", 12) + b"abcd" + struct.pack("<H", 4) + b"".join(struct.pack("<HHI", a, b, c) + (struct.pack("<HH", d, 0) if b == 3 else struct.pack("<I", d)) for a, b, c, d in entries) + b"\0\0\0\0"
    assert I.verify(tiff, ".tiff") and not I.verify(tiff[:30], ".tif") and not I.verify(tiff.replace(struct.pack("<HHI", 279, 4, 1) + struct.pack("<I", 4), struct.pack("<HHI", 279, 4, 1) + struct.pack("<I", 4000)), ".tif")
    assert not any(I.verify(b"", e) for e in (".png", ".jpg", ".tif", ".pdf"))


def test_pnm():
    assert I.read_pnm(b"P5 # grey\n2 1\n255\n\x01\x02").tolist() == [[1, 2]]
    assert I.read_pnm(b"P6 1 1 255\n\x01\x02\x03").tolist() == [[[1, 2, 3]]]
    with pytest.raises(I.BadImage):
        I.read_pnm(b"P5 2 2 255\n\x01")


def test_grayscale():
    assert I.to_grayscale(np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [9, 9, 9]]], np.uint8)).tolist() == [[76, 150, 29, 9]]


def test_denoise():
    rng = np.random.default_rng(0)
    clean = np.zeros((40, 60), np.uint8) + 60
    clean[:, 30:] = 200
    noisy = np.clip(clean + rng.normal(0, 6, clean.shape), 0, 255).astype(np.uint8)
    out = I.denoise(noisy, search=5).astype(float)
    assert np.abs(out - clean).mean() < 0.5 * np.abs(noisy.astype(float) - clean).mean() and out[:, 29].mean() < 80 and out[:, 30].mean() > 180
    assert (I.denoise(clean) == clean).all()


def test_contrast():
    x = np.tile(100 + np.arange(160) % 20 * 2, (160, 1)).astype(np.uint8)
    out = I.enhance_contrast(x)
    assert out.shape == x.shape and int(np.ptp(out)) > 1.5 * int(np.ptp(x))
    assert I.enhance_contrast(np.full((5, 3), 7, np.uint8)).shape == (5, 3)


@pytest.mark.parametrize("degrees", [-9, -3, 0.2, 4, 12])
def test_deskew(degrees):
    page = np.zeros((240, 320), np.uint8)
    page[80:160, 60:260] = 255
    turned = I.rotate(page, degrees)
    assert abs(I.skew_angle(turned) + degrees) < 0.6
    back = I.deskew(turned)
    if abs(degrees) > 1:
        assert abs(I.skew_angle(back)) < 1 and np.abs(back.astype(int) - page).mean() < 6
    assert (I.deskew(page) == page).all() and (I.deskew(np.zeros((5, 5), np.uint8)) == 0).all()


def test_threshold():
    page = np.tile(np.linspace(120, 250, 200), (60, 1)).astype(np.uint8)
    page[20:24, 50:150] -= 60
    out = I.threshold(page)
    assert set(np.unique(out)) == {0, 255} and (out[21:23, 50:150] == 0).all() and (out[40:] == 255).mean() > 0.95
    flat = np.full((20, 20), 9, np.uint8)
    assert (I.threshold(flat) == 255).all()


def test_backend():
    page = I.write_png(np.full((20, 30, 3), 200, np.uint8))
    seen = []
    backend = ImageBackend(lambda x: seen.append(x) or " text \n")
    assert recognise(backend, page, ".png") == (True, "text", None)
    assert seen[0].shape == (20, 30) and set(np.unique(seen[0])) <= {0, 255}
    assert recognise(backend, page[:40], ".png")[0] is False
    assert recognise(backend, b"%PDF-", ".pdf") == (False, None, "no page could be read")
