"""Small per-image NumPy helpers, called inside Spark tasks on one decoded image at a time."""

from __future__ import annotations

import numpy as np

# Luma weights (BT.709 for brightness; BT.601 in 1/65536 for gray levels).
BRIGHTNESS_WEIGHTS = (0.2126, 0.7152, 0.0722)
GRAY_WEIGHTS = (19595, 38470, 7471)
GRAY_ROUNDING = 32768
# Flags, colourfulness and histogram constants.
DARK_BELOW, LIGHT_ABOVE = 0.3, 0.7
MEAN_WEIGHT = 0.3
ENTROPY_EPSILON = 1e-9
COLOR_LEVELS = 4
THUMBNAIL = 64
# Channel means and deviations the usual image models are trained with.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
# Measures of an image that cannot be read.
UNREADABLE = {
    "aspect_ratio": 1.0, "image_width": 0.0, "image_height": 0.0, "brightness_mean": 0.5,
    "saturation_mean": 0.0, "colorfulness": 0.0, "visual_entropy": 0.0,
    "color_diversity_score": 0.0, "is_dark_background": 0.0, "is_light_background": 0.0,
}


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """RGB array from the interleaved BGR, BGRA or gray bytes of Spark's image source."""
    stored = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(stored, 3, axis=2)
    return stored[:, :, 2::-1]


def _bicubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    near = 1.5 * x**3 - 2.5 * x**2 + 1.0
    far = -0.5 * x**3 + 2.5 * x**2 - 4.0 * x + 2.0
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.clip(1.0 - np.abs(x), 0.0, None)


FILTERS = {"bicubic": (_bicubic, 2.0), "bilinear": (_triangle, 1.0)}


def _resize_weights(size_in: int, size_out: int, method: str) -> np.ndarray:
    """(size_out, size_in) weights of an antialiased filter, in 1/2**22 steps.

    Held as floats for a fast product; the sums stay below 2**53 and are therefore exact.
    """
    kernel, support = FILTERS[method]
    ratio = size_in / size_out
    stretch = max(ratio, 1.0)
    centers = (np.arange(size_out) + 0.5) * ratio
    first = np.maximum((centers - support * stretch + 0.5).astype(int), 0)
    last = np.minimum((centers + support * stretch + 0.5).astype(int), size_in)
    taps = np.arange(size_in)
    inside = (taps >= first[:, None]) & (taps < last[:, None])
    weights = np.where(inside, kernel((taps + 0.5 - centers[:, None]) / stretch), 0.0)
    weights /= weights.sum(axis=1, keepdims=True)
    scaled = weights * (1 << 22)
    return np.trunc(scaled + np.copysign(0.5, scaled))


def resize(rgb: np.ndarray, width: int, height: int, method: str) -> np.ndarray:
    """Resize with 8-bit rounding after the horizontal and after the vertical pass."""
    pixels = rgb.astype(np.float64)
    for axis, size in ((1, width), (0, height)):
        if pixels.shape[axis] != size:
            weights = _resize_weights(pixels.shape[axis], size, method)
            summed = np.moveaxis(np.tensordot(weights, pixels, axes=(1, axis)), 0, axis)
            pixels = np.clip(np.floor((summed + (1 << 21)) / (1 << 22)), 0, 255)
    return pixels.astype(np.uint8)


def model_tensor(rgb: np.ndarray, size: int) -> np.ndarray:
    """(3, size, size) float32 input of an image model."""
    unit = resize(rgb, size, size, "bilinear") / 255.0
    normal = (unit - np.array(CHANNEL_MEAN)) / np.array(CHANNEL_STD)
    return normal.transpose(2, 0, 1).astype(np.float32)
