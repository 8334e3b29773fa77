"""Numbers from the bytes of decoded images: rows of pixels whose channels are in the order blue, green, red, alpha, as Spark's image reader gives them.

Bytes are turned into numbers a batch at a time, over Arrow: images of one shape in a batch are one array. A tensor is (shape, values), values in the order of its layout.

Defined results. Null bytes give null. Bytes whose number isn't height * width * channels, or that have other than 1, 3 or 4 channels, are an error. An image without
pixels has no values. Batches are bounded by the session's spark.sql.execution.arrow.maxBytesPerBatch; one image is always whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TENSOR = "struct<shape:array<int>,values:array<float>>"
_ARROW = pa.struct([("shape", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])
#: The published luma weights of ITU-R 601, in thousandths of red, green and blue.
LUMA = (299, 587, 114)


def _pixels(data: list[memoryview], height: int, width: int, channels: int) -> np.ndarray:
    """(images, height, width, channels) of bytes, colours as red, green, blue."""
    if channels not in (1, 3, 4):
        raise ValueError(f"images of {channels} channels")
    if any(len(d) != height * width * channels for d in data):
        raise ValueError(f"bytes that are not {height} x {width} x {channels} pixels")
    raw = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(len(data), height, width, channels)
    return raw if channels == 1 else raw[..., [2, 1, 0, *range(3, channels)]]


def gray(pixels: np.ndarray) -> np.ndarray:
    """One channel of whole luma values, rounded half up; alpha plays no part."""
    if pixels.shape[-1] == 1:
        return pixels
    weighed = pixels[..., :3].astype(np.int32) @ np.array(LUMA, dtype=np.int32)
    return ((weighed + 500) // 1000).astype(np.uint8)[..., None]


def tensors(data: list[memoryview | None], height: list[int], width: list[int], channels: list[int], layout: str, grayscale: bool, unit: bool, threshold: float | None) -> pa.Array:
    """An Arrow array of TENSOR, in the order of the rows."""
    shapes: dict[tuple[int, int, int], list[int]] = {}
    for k, d in enumerate(data):
        if d is not None:
            shapes.setdefault((height[k], width[k], channels[k]), []).append(k)
    found: list[tuple[list[int], np.ndarray] | None] = [None] * len(data)
    for (h, w, c), rows in shapes.items():
        pixels = _pixels([data[k] for k in rows], h, w, c)
        pixels = gray(pixels) if grayscale else pixels
        pixels = pixels.transpose(0, 3, 1, 2) if layout == "chw" else pixels
        values = pixels / np.float32(255) if unit else pixels.astype(np.float32)
        if threshold is not None:
            values = (values > np.float32(threshold)).astype(np.float32)
        for k, v in zip(rows, values.reshape(len(rows), -1), strict=True):
            found[k] = (list(pixels.shape[1:]), v)
    sizes = [0 if f is None else len(f[1]) for f in found]
    flat = np.concatenate([f[1] for f in found if f is not None] or [np.zeros(0)]).astype(np.float32, copy=False)
    values = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), type=pa.int32()), pa.array(flat))
    shape = pa.array([f and f[0] for f in found], type=pa.list_(pa.int32()))
    return pa.StructArray.from_arrays([shape, values], fields=list(_ARROW), mask=pa.array([f is None for f in found]))


def image_tensor(data: Column, height: Column, width: Column, channels: Column, layout: str = "chw", grayscale: bool = False, unit: bool = True, threshold: float | None = None) -> Column:
    """The tensor of an image's bytes: red, green, blue(, alpha) or one channel; `chw` or `hwc`; from 0 to 1 (unit) or 0 to 255.

    grayscale: colours become their luma, in whole steps of 255ths. threshold: 1.0 for values above it, else 0.0.
    """
    if layout not in ("chw", "hwc"):
        raise ValueError(f"unknown layout: {layout}")

    @F.arrow_udf(TENSOR)
    def decoded(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for own, h, w, c in batches:
            views = [memoryview(x.as_buffer()) if x.is_valid else None for x in own]
            yield tensors(views, h.to_pylist(), w.to_pylist(), c.to_pylist(), layout, grayscale, unit, threshold)

    return decoded(data.cast("binary"), height.cast("int"), width.cast("int"), channels.cast("int"))
