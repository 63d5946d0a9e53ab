"""Images as arrays: shape, range and checks. Codecs are given by the caller."""

from __future__ import annotations

import numpy as np


def rgb_shape(image) -> tuple[int, int, int]:
    """(height, width, 3) of an array or nested lists; an error for anything else."""
    shape = tuple(np.asarray(image).shape)
    if len(shape) != 3 or shape[2] != 3 or not shape[0] or not shape[1]:
        raise ValueError(f"an RGB image has height x width x 3 values, not {shape}")
    return shape


def to_bytes(image) -> np.ndarray:
    """An RGB image as 8-bit values: floats count from 0 to 1, other numbers from 0 to 255, and are clipped."""
    array = np.asarray(image)
    rgb_shape(array)
    if array.dtype.kind == "f":
        array = array * 255.0
    return np.ascontiguousarray(array if array.dtype == np.uint8 else array.clip(0, 255).astype(np.uint8))


def swap_channels(image: np.ndarray) -> np.ndarray:
    """BGR as RGB, and back."""
    return np.ascontiguousarray(image[..., ::-1])


def same_shape(name: str, image, want: tuple[int, int, int]) -> None:
    if rgb_shape(image) != tuple(want):
        raise ValueError(f"{name} changed its shape from {tuple(want)} to {rgb_shape(image)}")


def raw_codec(shape: tuple[int, int, int]):
    """Encoder and decoder of images without compression, for tests and for stores that compress themselves."""
    return (lambda image: to_bytes(image).tobytes()), (lambda blob: np.frombuffer(blob, np.uint8).reshape(shape))
