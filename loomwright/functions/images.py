"""Perceptual features of PNG images, from Arrow batches; no imaging library is needed."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.schemas import IMAGE_FEATURES

#: Fixed values of the features: grey levels that count as ink, by purpose.
INK, CROP_INK, THUMBNAIL_INK = 245, 248, 235
MOST_DIFFERENCE, LEAST_OVERLAP = 18.0, 0.65
#: Fixed values of views: the longer side of an image, grey levels that count as content, and its margin.
LONGEST, CONTENT_INK, LEAST_MARGIN, MARGIN_SHARE = 1024, 250, 4, 0.02
VIEW_MODES = ("processor", "letterbox", "dual")
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


#: Passes of an interlaced image: first row, first column, steps between rows and columns.
_PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def decode_png(data: bytes) -> np.ndarray:
    """Height x width x 4, 0 to 255."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, palette, clear = 8, [], None, None
    width = height = depth = kind = laced = 0
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        at += 12 + size
        if name == b"IHDR":
            width, height, depth, kind, _, _, laced = struct.unpack(">IIBBBBB", body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"tRNS":
            clear = np.frombuffer(body, np.uint8)
        elif name == b"IDAT":
            packed.append(body)
        elif name == b"IEND":
            break
    if not width or not height:
        raise ValueError("empty dimensions")
    raw, channels = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8), _CHANNELS[kind]
    samples = np.zeros((height, width, channels), np.uint16)
    at = 0
    for y0, x0, dy, dx in _PASSES if laced else ((0, 0, 1, 1),):
        h, w = len(range(y0, height, dy)), len(range(x0, width, dx))
        if h and w:
            stride = (w * channels * depth + 7) // 8
            lines = _unfilter(raw[at : at + h * (stride + 1)].reshape(h, stride + 1), max(1, channels * depth // 8))
            at += h * (stride + 1)
            samples[y0::dy, x0::dx] = _samples(lines, w, channels, depth)
    out = np.full((height, width, 4), 255, np.uint8)
    if kind == 3:
        index = samples[..., 0]
        out[..., :3] = palette[index]
        if clear is not None:
            out[..., 3] = np.concatenate([clear, np.full(256 - len(clear), 255, np.uint8)])[index]
        return out
    grey = (samples >> 8 if depth == 16 else samples if depth == 8 else samples.astype(np.uint32) * 255 // (2**depth - 1)).astype(np.uint8)
    out[..., :3] = grey[..., :1] if channels < 3 else grey[..., :3]
    if channels in (2, 4):
        out[..., 3] = grey[..., -1]
    elif clear is not None:  # one colour of the image is transparent
        out[(samples == np.frombuffer(clear.tobytes(), ">u2")[:channels]).all(axis=2), 3] = 0
    return out


def _samples(lines: np.ndarray, width: int, channels: int, depth: int) -> np.ndarray:
    height = len(lines)
    if depth == 16:
        return np.ascontiguousarray(lines).view(">u2").reshape(height, width, channels).astype(np.uint16)
    if depth == 8:
        return lines.reshape(height, width, channels).astype(np.uint16)
    bits = np.unpackbits(lines, axis=1)[:, : width * channels * depth].reshape(height, width, channels, depth)
    return (bits @ (1 << np.arange(depth)[::-1])).astype(np.uint16)


def _unfilter(lines: np.ndarray, step: int) -> np.ndarray:
    """Undo the filters of an image's lines (filter first, then bytes)."""
    kinds, height, width = lines[:, 0], len(lines), -(-(lines.shape[1] - 1) // step)
    if not ((kinds > 0) & (kinds < 5)).any():
        return lines[:, 1:]
    out = np.zeros((height + 1, width + 1, step), np.int32)  # a line above and a pixel on the left, of zeros
    flat = np.zeros((height, width * step), np.uint8)
    flat[:, : lines.shape[1] - 1] = lines[:, 1:]
    out[1:, 1:] = flat.reshape(height, width, step)
    if (kinds > 2).any():
        # A pixel needs its left, upper and upper left neighbours, so all pixels of one diagonal are undone at once.
        for t in range(height + width - 1):
            y = np.arange(max(0, t - width + 1), min(height, t + 1))
            x, kind = t - y, kinds[y][:, None]
            left, up, corner = out[y + 1, x], out[y, x + 1], out[y, x]
            p = left + up - corner
            a, b, c = np.abs(p - left), np.abs(p - up), np.abs(p - corner)
            paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
            guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) // 2, paeth], 0)
            out[y + 1, x + 1] = (out[y + 1, x + 1] + guess) & 255
    else:
        for y in range(height):
            if kinds[y] == 1:
                out[y + 1, 1:] = np.cumsum(out[y + 1, 1:], axis=0) & 255
            elif kinds[y] == 2:
                out[y + 1] = (out[y + 1] + out[y]) & 255
    return out[1:, 1:].reshape(height, -1)[:, : lines.shape[1] - 1].astype(np.uint8)


@lru_cache(64)
def _lanczos(old: int, new: int) -> np.ndarray:
    """Weights (new x old) of a Lanczos filter of three lobes."""
    scale = max(old / new, 1.0)
    center = (np.arange(new)[:, None] + 0.5) * old / new
    x = (np.arange(old)[None, :] + 0.5 - center) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resize(grey: np.ndarray, width: int, height: int) -> np.ndarray:
    out = _lanczos(grey.shape[0], height) @ grey.astype(np.float64) @ _lanczos(grey.shape[1], width).T
    return np.clip(np.round(out), 0, 255)


@lru_cache(1)
def _cosines() -> np.ndarray:
    """The first 8 rows of the orthonormal cosine transform of 32 values."""
    k, i = np.arange(8)[:, None], np.arange(32)[None, :]
    return np.cos(np.pi * (2 * i + 1) * k / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def grey_on_white(image: np.ndarray) -> np.ndarray:
    rgb, alpha = image[..., :3].astype(np.float64), image[..., 3:] / 255.0
    flat = np.round(rgb * alpha + 255 * (1 - alpha))
    return np.floor((flat @ np.array([19595, 38470, 7471]) + 32768) / 65536)


def _fitted_shape(shape: tuple[int, int], most: int) -> tuple[int, int]:
    longer = max(shape)
    return shape if longer <= most else tuple(max(1, round(n * most / longer)) for n in shape)


def fitted(image: np.ndarray, most: int) -> np.ndarray:
    """An image (height x width, with or without channels) of at most ``most`` on its longer side, never enlarged."""
    h, w = _fitted_shape(image.shape[:2], most)
    if (h, w) == image.shape[:2]:
        return image
    if image.ndim == 2:
        return resize(image, w, h)
    return np.stack([resize(image[..., c], w, h) for c in range(image.shape[2])], axis=2)


def thumbnail(grey: np.ndarray) -> np.ndarray:
    """The inked part of the image at ``LONGEST`` at most, fitted into 64 x 64 on white."""
    grey = fitted(grey, LONGEST)
    inked = grey < CROP_INK
    if not inked.any():
        raise ValueError("blank image")
    ys, xs = np.flatnonzero(inked.any(axis=1)), np.flatnonzero(inked.any(axis=0))
    part = grey[max(0, ys[0] - 2) : ys[-1] + 3, max(0, xs[0] - 2) : xs[-1] + 3]
    scale = 64 / max(part.shape)
    h, w = (max(1, round(n * scale)) for n in part.shape)
    out = np.full((64, 64), 255.0)
    top, left = (64 - h) // 2, (64 - w) // 2
    out[top : top + h, left : left + w] = resize(part, w, h)
    return out


def features(data: bytes | None) -> dict:
    """One row of IMAGE_FEATURES; errors become a column."""
    row = dict.fromkeys(("png_w", "png_h"), 0) | dict.fromkeys(("phash", "dhash", "image_error"), "") | dict.fromkeys(("ink_ratio", "gray_mean", "gray_std"), 0.0) | {"thumbnail": None}
    try:
        image = decode_png(data or b"")
        row |= {"png_h": image.shape[0], "png_w": image.shape[1]}
        grey = grey_on_white(image)
        sample = resize(grey, 64, 64)
        low = _cosines() @ resize(sample, 32, 32) @ _cosines().T
        high = low > np.median(low.ravel()[1:])
        high[0, 0] = False
        across = resize(grey, 9, 8)
        row |= {"phash": _hex(high), "dhash": _hex(across[:, 1:] > across[:, :-1]), "ink_ratio": round(float((sample < INK).mean()), 6), "gray_mean": round(float(sample.mean()), 4), "gray_std": round(float(sample.std()), 4)}
        row["thumbnail"] = thumbnail(grey).astype(np.uint8).tobytes()
    except Exception as e:  # one bad image must not stop a run
        row["image_error"] = "" if row["phash"] and "blank" in str(e) else f"{type(e).__name__}: {e}"[:300]
    return row


def _image_features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([features(x) for x in s])


def on_white(image: np.ndarray) -> np.ndarray:
    """Height x width x 3 of an image with transparency."""
    if (image[..., 3] == 255).all():
        return image[..., :3].astype(np.float64)
    rgb, alpha = image[..., :3].astype(np.float64), image[..., 3:] / 255.0
    return np.round(rgb * alpha + 255 * (1 - alpha))


def content_of(rgb: np.ndarray) -> np.ndarray:
    """The part of an image that is not white, with a margin; the whole of a white one."""
    inked = rgb @ np.array([19595.0, 38470.0, 7471.0]) < CONTENT_INK * 65536 - 32768
    if not inked.any():
        return rgb
    ys, xs = np.flatnonzero(inked.any(axis=1)), np.flatnonzero(inked.any(axis=0))
    margin = max(LEAST_MARGIN, round(MARGIN_SHARE * max(xs[-1] + 1 - xs[0], ys[-1] + 1 - ys[0])))
    return rgb[max(0, ys[0] - margin) : ys[-1] + 1 + margin, max(0, xs[0] - margin) : xs[-1] + 1 + margin]


def letterboxed(rgb: np.ndarray) -> np.ndarray:
    """An image in the middle of a white square."""
    rgb = fitted(rgb, LONGEST)
    side = max(rgb.shape[:2])
    out = np.full((side, side, 3), 255.0)
    top, left = (side - rgb.shape[0]) // 2, (side - rgb.shape[1]) // 2
    out[top : top + rgb.shape[0], left : left + rgb.shape[1]] = rgb
    return out


def _parts(data: bytes | None, mode: str) -> list[np.ndarray]:
    """The parts of an image that its views show."""
    if mode not in VIEW_MODES:
        raise ValueError(f"not a mode of views: {mode!r}")
    rgb = on_white(decode_png(data or b""))
    return [rgb] if mode == "processor" else [content_of(rgb)] if mode == "letterbox" else [rgb, content_of(rgb)]


def views(data: bytes | None, mode: str = "dual") -> list[np.ndarray]:
    """What a model sees of an image: as it is, its content in a square, or both the image and its content in squares."""
    return [fitted(x, LONGEST) if mode == "processor" else letterboxed(x) for x in _parts(data, mode)]


def view_sizes(data: bytes | None, mode: str = "dual") -> dict:
    """Widths and heights of the views, which need not be drawn for it; an image that cannot be read has none, and says why."""
    try:
        shapes = [_fitted_shape(x.shape[:2], LONGEST) for x in _parts(data, mode)]
        return {"sizes": [[w, h] if mode == "processor" else [max(h, w)] * 2 for h, w in shapes], "error": ""}
    except Exception as e:  # one bad image must not stop a run
        return {"sizes": [], "error": f"{type(e).__name__}: {e}"[:300]}


def _same_picture(left: pd.Series, right: pd.Series) -> pd.Series:
    """Whether two thumbnails differ little and their ink overlaps; missing ones never match."""
    both = (left.notna() & right.notna()).to_numpy()
    out = np.zeros(len(left), bool)
    if both.any():
        x, y = (np.frombuffer(b"".join(s[both]), np.uint8).reshape(int(both.sum()), -1).astype(np.int16) for s in (left, right))
        ink = x < THUMBNAIL_INK, y < THUMBNAIL_INK
        overlap = (ink[0] & ink[1]).sum(axis=1) / np.maximum((ink[0] | ink[1]).sum(axis=1), 1)
        out[both] = (np.abs(x - y).mean(axis=1) <= MOST_DIFFERENCE) & (overlap >= LEAST_OVERLAP)
    return pd.Series(out)


# Made when called: parsing a type needs a session.


def image_features(content: Column | str) -> Column:
    fields = ", ".join(f"{n}: {t}" for n, t in (c.split() for c in IMAGE_FEATURES.split(", ")))
    return F.pandas_udf(_image_features, f"struct<{fields}>")(content)


def same_picture(left: Column | str, right: Column | str) -> Column:
    return F.pandas_udf(_same_picture, "boolean")(left, right)


def picture_views(content: Column | str, mode: str = "dual") -> Column:
    """struct<sizes: widths and heights of the views, error>."""

    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([view_sizes(x, mode) for x in s], columns=["sizes", "error"])

    return F.pandas_udf(sizes, "struct<sizes: array<array<int>>, error: string>")(content)
