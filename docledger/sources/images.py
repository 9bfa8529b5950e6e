"""Images as arrays: reading and checking PNG and PNM files, and the steps that prepare a scan for recognition.

All steps take and give arrays of ``uint8``: (height, width) in grey, (height, width, 3) in colour.  They are array
operations of numpy; no image library is needed.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PNG_HEAD = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel for each kind of PNG.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class BadImage(ValueError):
    """A file that is not a whole image."""


def _png_chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    if not data.startswith(PNG_HEAD):
        raise BadImage("no PNG signature")
    chunks, at = [], len(PNG_HEAD)
    while True:
        if at + 12 > len(data):
            raise BadImage("the file ends within a chunk")
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body, check = data[at + 8 : at + 8 + size], data[at + 8 + size : at + 12 + size]
        if len(check) < 4 or zlib.crc32(kind + body) != struct.unpack(">I", check)[0]:
            raise BadImage(f"chunk {kind!r} is damaged")
        chunks.append((kind, body))
        at += 12 + size
        if kind == b"IEND":
            break
    if chunks[0][0] != b"IHDR" or len(chunks[0][1]) != 13 or not any(k == b"IDAT" for k, _ in chunks):
        raise BadImage("header or pixels are missing")
    return chunks


def _verify_jpeg(data: bytes) -> None:
    """Walks the segments up to the picture, which must end with its end mark."""
    if data[:2] != b"\xff\xd8":
        raise BadImage("no JPEG signature")
    at, framed = 2, False
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise BadImage("the file ends within a segment")
        mark = data[at + 1]
        if mark == 0xFF:
            at += 1
            continue
        framed |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
        if mark == 0xDA:
            break
    if not framed or data.rstrip(b"\0")[-2:] != b"\xff\xd9":
        raise BadImage("the picture is not whole")


def _verify_tiff(data: bytes) -> None:
    """The first directory and the strips or tiles it names lie in the file."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None or len(data) < 8:
        raise BadImage("no TIFF signature")
    (at,) = struct.unpack(order + "I", data[4:8])
    if at + 2 > len(data):
        raise BadImage("the directory lies outside the file")
    (n,) = struct.unpack(order + "H", data[at : at + 2])
    if not n or at + 2 + 12 * n > len(data):
        raise BadImage("the directory is not whole")
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack(order + "HHI", data[at + 2 + 12 * k : at + 10 + 12 * k])
        width = {1: 1, 3: 2, 4: 4}.get(kind)
        if width and tag in (256, 257, 273, 279, 324, 325):
            raw = data[at + 10 + 12 * k : at + 14 + 12 * k]
            if width * count > 4:
                (where,) = struct.unpack(order + "I", raw)
                raw = data[where : where + width * count]
            if len(raw) < width * count:
                raise BadImage("values lie outside the file")
            tags[tag] = struct.unpack(f"{order}{count}{ {1: 'B', 2: 'H', 4: 'I'}[width] }", raw[: width * count])
    places, sizes = tags.get(273) or tags.get(324), tags.get(279) or tags.get(325)
    if 256 not in tags or 257 not in tags or not places or not sizes:
        raise BadImage("size or pixels are missing")
    if any(a + b > len(data) for a, b in zip(places, sizes, strict=False)):
        raise BadImage("pixels lie outside the file")


def verify(data: bytes, extension: str) -> bool:
    """Whether a file is a whole image of its kind. PNG: every chunk and its checksum; JPEG and TIFF: the structure."""
    try:
        if extension == ".png":
            _png_chunks(data)
        elif extension in (".jpg", ".jpeg"):
            _verify_jpeg(data)
        elif extension in (".tif", ".tiff"):
            _verify_tiff(data)
        else:
            return False
        return True
    except (BadImage, struct.error):
        return False


def read_png(data: bytes) -> np.ndarray:
    """The pixels of a PNG with 8 bits a sample that is not interlaced; transparency is dropped."""
    chunks = _png_chunks(data)
    width, height, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[0][1])
    if depth != 8 or interlaced or kind not in _SAMPLES:
        raise BadImage("this kind of PNG is not read")
    samples = _SAMPLES[kind]
    raw = np.frombuffer(zlib.decompress(b"".join(b for k, b in chunks if k == b"IDAT")), np.uint8)
    if len(raw) != height * (width * samples + 1):
        raise BadImage("the picture is not whole")
    lines = raw.reshape(height, -1)
    out = np.zeros((height, width * samples), np.uint8)
    above = np.zeros(width * samples, np.uint8)
    for y in range(height):
        above = out[y] = _unfilter(int(lines[y, 0]), lines[y, 1:], above, samples)
    pixels = out.reshape(height, width, samples)
    if kind == 3:
        palette = np.frombuffer(next(b for k, b in chunks if k == b"PLTE"), np.uint8).reshape(-1, 3)
        return palette[pixels[:, :, 0]]
    return pixels[:, :, 0] if samples < 3 else pixels[:, :, :3]


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:  # each sample adds to the same sample of the pixel before
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    left, corner = [0] * step, [0] * step
    out, up = line.tolist(), above.tolist()
    for k, x in enumerate(out):
        a, b, c = left[k % step], up[k], corner[k % step]
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
        out[k] = left[k % step] = (x + guess) & 255
        corner[k % step] = b
    return np.array(out, np.uint8)


def write_png(pixels: np.ndarray) -> bytes:
    """A PNG file of a grey or colour image."""
    height, width = pixels.shape[:2]
    kind = 0 if pixels.ndim == 2 else 2
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return PNG_HEAD + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def read_pnm(data: bytes) -> np.ndarray:
    """The pixels of a binary PGM or PPM with 8 bits a sample."""
    parts, at = [], 0
    while len(parts) < 4:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        if end == at:
            raise BadImage("the header is not whole")
        parts.append(data[at:end])
        at = end
    samples = {b"P5": 1, b"P6": 3}.get(parts[0])
    width, height = int(parts[1]), int(parts[2])
    body = data[at + 1 : at + 1 + width * height * (samples or 0)]
    if not samples or int(parts[3]) != 255 or len(body) != width * height * samples:
        raise BadImage("this kind of PNM is not read")
    pixels = np.frombuffer(body, np.uint8)
    return pixels.reshape(height, width) if samples == 1 else pixels.reshape(height, width, 3)


def to_grayscale(image: np.ndarray) -> np.ndarray:
    """Luma of the colours red, green, blue; grey stays."""
    if image.ndim == 2:
        return image
    return np.rint(image[:, :, :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def _box_sum(values: np.ndarray, radius: int) -> np.ndarray:
    """The sum over the square around each pixel; the border is repeated."""
    size = 2 * radius + 1
    padded = np.pad(values, radius, mode="edge")
    total = np.pad(padded, ((1, 0), (1, 0))).cumsum(0, dtype=np.float64).cumsum(1)
    return total[size:, size:] - total[:-size, size:] - total[size:, :-size] + total[:-size, :-size]


def denoise(image: np.ndarray, strength: float = 10.0, patch: int = 3, search: int = 10) -> np.ndarray:
    """Non-local means: the mean of all pixels around, each weighted by how alike the patches around the two are."""
    values = image.astype(np.float64)
    padded = np.pad(values, search, mode="reflect" if min(values.shape) > search else "edge")
    total, weights = np.zeros_like(values), np.zeros_like(values)
    height, width = values.shape
    scale = strength**2
    for dy in range(2 * search + 1):
        for dx in range(2 * search + 1):
            moved = padded[dy : dy + height, dx : dx + width]
            weight = np.exp(-np.maximum(_box_sum((values - moved) ** 2, patch), 0) / ((2 * patch + 1) ** 2 * scale))
            total += weight * moved
            weights += weight
    return np.rint(total / weights).astype(np.uint8)


def enhance_contrast(image: np.ndarray, limit: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Adaptive histogram equalisation: a curve for each tile, its histogram clipped, and between tiles what lies between curves."""
    height, width = image.shape
    ty, tx = -(-height // tiles), -(-width // tiles)
    padded = np.pad(image, ((0, ty * tiles - height), (0, tx * tiles - width)), mode="symmetric" if min(image.shape) >= tiles else "edge")
    area = ty * tx
    clip = max(1, int(limit * area / 256))
    curves = np.zeros((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            count = np.bincount(padded[i * ty : (i + 1) * ty, j * tx : (j + 1) * tx].ravel(), minlength=256)
            over = int(np.maximum(count - clip, 0).sum())
            count = np.minimum(count, clip) + over // 256
            left = over % 256
            if left:  # what is left is spread over the grey values
                count[np.arange(left) * 256 // left] += 1
            curves[i, j] = np.clip(np.rint(np.cumsum(count) * 255.0 / area), 0, 255)

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n) + 0.5) / size - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, tiles - 1), np.clip(low + 1, 0, tiles - 1), at - low

    y0, y1, fy = between(height, ty)
    x0, x1, fx = between(width, tx)
    fy, fx = fy[:, None], fx[None, :]
    top = curves[y0[:, None], x0[None, :], image] * (1 - fx) + curves[y0[:, None], x1[None, :], image] * fx
    low = curves[y1[:, None], x0[None, :], image] * (1 - fx) + curves[y1[:, None], x1[None, :], image] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def _hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, in order."""
    points = np.unique(points, axis=0)

    def half(rows) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    rows = points.tolist()
    return np.array(half(rows) + half(rows[::-1]) if len(rows) > 2 else rows, float)


def skew_angle(image: np.ndarray) -> float:
    """By how many degrees the smallest rectangle around the non-zero pixels is turned against the image, from -45 to 45."""
    ys, xs = np.nonzero(image)
    if len(ys) < 10:
        return 0.0
    # Only the first and last pixel of a row can be a corner.
    first = np.flatnonzero(np.concatenate([[True], ys[1:] != ys[:-1]]))
    last = np.append(first[1:], len(ys)) - 1
    hull = _hull(np.stack([np.concatenate([xs[first], xs[last]]), np.concatenate([ys[first], ys[last]])], axis=1))
    if len(hull) < 3:
        return 0.0
    edges = np.roll(hull, -1, axis=0) - hull
    best, angle = np.inf, 0.0
    for turn in np.arctan2(edges[:, 1], edges[:, 0]).tolist():
        u, v = hull @ np.array([np.cos(turn), np.sin(turn)]), hull @ np.array([-np.sin(turn), np.cos(turn)])
        area = (u.max() - u.min()) * (v.max() - v.min())
        if area < best - 1e-9:
            best, angle = area, np.degrees(turn)
    return float((angle + 45) % 90 - 45)


def _cubic(t: np.ndarray, a: float = -0.75) -> np.ndarray:
    """Weights of the four neighbours at a distance of t behind the second."""
    near, far = lambda x: ((a + 2) * x - (a + 3)) * x * x + 1, lambda x: ((a * x - 5 * a) * x + 8 * a) * x - 4 * a
    return np.stack([far(t + 1), near(t), near(1 - t), far(2 - t)])


def rotate(image: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about the centre, counter-clockwise; size and border stay, values between pixels are cubic."""
    height, width = image.shape
    cy, cx = height // 2, width // 2
    turn = np.radians(degrees)
    y, x = np.mgrid[:height, :width].astype(float)
    sx = np.cos(turn) * (x - cx) - np.sin(turn) * (y - cy) + cx
    sy = np.sin(turn) * (x - cx) + np.cos(turn) * (y - cy) + cy
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    wx, wy = _cubic(sx - x0), _cubic(sy - y0)
    out = np.zeros(image.shape)
    for j in range(4):
        row = np.clip(y0 + j - 1, 0, height - 1)
        out += wy[j] * sum(wx[k] * image[row, np.clip(x0 + k - 1, 0, width - 1)] for k in range(4))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def deskew(image: np.ndarray, least: float = 0.5, most: float = 15.0) -> np.ndarray:
    """Turned back by its skew, if that is small enough to be one and large enough to matter."""
    angle = skew_angle(image)
    return rotate(image, angle) if least <= abs(angle) <= most else image


def threshold(image: np.ndarray, size: int = 11, offset: float = 2.0) -> np.ndarray:
    """White where a pixel is brighter than the Gaussian mean around it less ``offset``, else black."""
    radius = size // 2
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    kernel /= kernel.sum()
    padded = np.pad(image.astype(float), radius, mode="edge")
    rows = sum(w * padded[:, k : k + image.shape[1]] for k, w in enumerate(kernel))
    mean = np.rint(sum(w * rows[k : k + image.shape[0]] for k, w in enumerate(kernel)))
    return np.where(image > mean - offset, 255, 0).astype(np.uint8)


def prepare(image: np.ndarray) -> np.ndarray:
    """All steps in order: grey, noise, contrast, skew, black and white."""
    return threshold(deskew(enhance_contrast(denoise(to_grayscale(image)))))
