"""Pixel helpers that run inside tasks on one image at a time (numpy arrays, height x width x 3)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

PNG_MAGIC = b"\x89PNG\r\n\x1a\n"

# Per-channel mean and deviation of the model input.
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """Gray, gray+alpha or RGBA to three channels; alpha is dropped."""
    channels = pixels.shape[2]
    if channels <= 2:
        return np.repeat(pixels[:, :, :1], 3, axis=2)
    return pixels[:, :, :3]


def encode_png(pixels: np.ndarray) -> bytes:
    """RGB pixels as a lossless PNG file."""
    height, width, _ = pixels.shape
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(1.0 - np.abs(x), 0.0)


def _cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution with a = -0.5."""
    x = np.abs(x)
    near = 1.5 * x**3 - 2.5 * x**2 + 1.0
    far = -0.5 * x**3 + 2.5 * x**2 - 4.0 * x + 2.0
    return np.where(x < 1.0, near, np.where(x < 2.0, far, 0.0))


# Kernel and its reach in pixels.
FILTERS = {"bilinear": (_triangle, 1.0), "bicubic": (_cubic, 2.0)}


def _resample_rows(pixels: np.ndarray, size: int, kernel: str) -> np.ndarray:
    """Resize along the first axis; the kernel widens when the image shrinks."""
    weigh, reach = FILTERS[kernel]
    old = pixels.shape[0]
    scale = old / size
    stretch = max(scale, 1.0)
    centre = (np.arange(size) + 0.5) * scale
    first = np.maximum((centre - reach * stretch + 0.5).astype(int), 0)
    last = np.minimum((centre + reach * stretch + 0.5).astype(int), old)
    taps = first[:, None] + np.arange(int((last - first).max()))
    weights = weigh((taps + 0.5 - centre[:, None]) / stretch) * (taps < last[:, None])
    weights /= weights.sum(axis=1, keepdims=True)
    taps = np.minimum(taps, old - 1)
    total = np.zeros((size, *pixels.shape[1:]))
    for k in range(taps.shape[1]):
        total += weights[:, k, None, None] * pixels[taps[:, k]]
    return np.clip(np.floor(total + 0.5), 0, 255).astype(np.uint8)


def resize(pixels: np.ndarray, width: int, height: int, kernel: str = "bilinear") -> np.ndarray:
    """Antialiased separable resize, columns first, rounded to bytes after each pass."""
    if pixels.shape[1] != width:
        pixels = _resample_rows(pixels.transpose(1, 0, 2), width, kernel).transpose(1, 0, 2)
    if pixels.shape[0] != height:
        pixels = _resample_rows(pixels, height, kernel)
    return pixels


def letterbox(pixels: np.ndarray, size: int) -> tuple[np.ndarray, float, float, float]:
    """Aspect-preserving fit on a black square: pixels, scale and normalised padding."""
    height, width = pixels.shape[:2]
    scale = min(size / width, size / height)
    new_w, new_h = int(width * scale), int(height * scale)
    if not new_w or not new_h:
        raise ValueError("image side shrinks to nothing")
    left, top = (size - new_w) // 2, (size - new_h) // 2
    canvas = np.zeros((size, size, 3), np.uint8)
    canvas[top : top + new_h, left : left + new_w] = resize(pixels, new_w, new_h)
    return canvas, scale, left / size, top / size


def stretch(pixels: np.ndarray, size: int) -> np.ndarray:
    """Plain resize to a square, aspect ratio not kept."""
    return resize(pixels, size, size, "bicubic")


def normalize(pixels: np.ndarray) -> np.ndarray:
    """Bytes to the flat channel-first model input."""
    scaled = pixels.astype(np.float32) / np.float32(255.0)
    return ((scaled - np.float32(MEAN)) / np.float32(STD)).transpose(2, 0, 1).ravel()


def paint_boxes(pixels: np.ndarray, boxes: list[tuple[int, int, int, int]], colour, width: int) -> np.ndarray:
    """Rectangle outlines of a width in pixels, drawn inwards, cut at the image border."""
    out = pixels.copy()
    for x1, y1, x2, y2 in boxes:
        for ys, xs in (
            (slice(y1, y1 + width), slice(x1, x2 + 1)), (slice(y2 - width + 1, y2 + 1), slice(x1, x2 + 1)),
            (slice(y1, y2 + 1), slice(x1, x1 + width)), (slice(y1, y2 + 1), slice(x2 - width + 1, x2 + 1)),
        ):
            rows, cols = (slice(max(s.start, 0), max(s.stop, 0)) for s in (ys, xs))
            out[rows, cols] = colour
    return out
