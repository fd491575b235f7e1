"""TIFF as a table: files are listed and read by Spark's binary reader and decoded where they are."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe import schemas

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8, 18: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
_KINDS = {1: "u", 2: "i", 3: "f"}


def _directory(data: bytes, at: int, order: str, big: bool) -> tuple[dict[int, tuple], int]:
    """The tags of one page and where the next one is."""
    count, = struct.unpack_from(order + ("Q" if big else "H"), data, at)
    at += 8 if big else 2
    tags = {}
    for _ in range(count):
        tag, kind, n = struct.unpack_from(order + ("HHQ" if big else "HHI"), data, at)
        size = _SIZES.get(kind, 1) * n
        room = 8 if big else 4
        value_at = at + (12 if big else 8)
        place = value_at if size <= room else struct.unpack_from(order + ("Q" if big else "I"), data, value_at)[0]
        if kind == 2:
            tags[tag] = (data[place : place + n].split(b"\0")[0].decode("utf-8", "replace"),)
        elif kind in (5, 10):
            pairs = struct.unpack_from(f"{order}{2 * n}{'I' if kind == 5 else 'i'}", data, place)
            tags[tag] = tuple(a / b if b else 0.0 for a, b in zip(pairs[::2], pairs[1::2], strict=True))
        elif kind in _CODES:
            tags[tag] = struct.unpack_from(f"{order}{n}{_CODES[kind]}", data, place)
        else:
            tags[tag] = (data[place : place + size],)
        at += 20 if big else 12
    return tags, struct.unpack_from(order + ("Q" if big else "I"), data, at)[0]


def _packbits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


def _page(data: bytes, tags: dict[int, tuple], order: str) -> np.ndarray:
    one = lambda t, d=1: tags.get(t, (d,))[0]
    width, height, samples, compression = one(256), one(257), one(277), one(259)
    bits = one(258)
    if bits not in (8, 16, 32, 64):
        raise ValueError(f"{bits} bits a sample are not read")
    dtype = np.dtype(f"{_KINDS[one(339)]}{bits // 8}").newbyteorder(order)
    planar = one(284) == 2 and samples > 1
    tiled = 322 in tags
    block_w, block_h = (one(322), one(323)) if tiled else (width, min(one(278, height), height))
    offsets, counts = (tags[324], tags[325]) if tiled else (tags[273], tags.get(279, (height * width * samples * bits // 8,)))
    across, down = -(-width // block_w), -(-height // block_h)
    depth = 1 if planar else samples
    out = np.zeros((samples if planar else 1, height, width, depth), dtype.newbyteorder("="))
    for k, (at, n) in enumerate(zip(offsets, counts, strict=True)):
        raw = data[at : at + n]
        if compression in (8, 32946):
            raw = zlib.decompress(raw)
        elif compression == 32773:
            raw = _packbits(raw)
        elif compression != 1:
            raise ValueError(f"TIFF compression {compression} is not read")
        plane, rest = divmod(k, across * down)
        y, x = rest // across * block_h, rest % across * block_w
        rows = block_h if tiled else min(block_h, height - y)
        block = np.frombuffer(raw, dtype, rows * block_w * depth).reshape(rows, block_w, depth)
        if one(317) == 2:
            block = np.cumsum(block, axis=1, dtype=dtype.newbyteorder("="))
        h, w = min(rows, height - y), min(block_w, width - x)
        out[plane, y : y + h, x : x + w] = block[:h, :w]
    return np.moveaxis(out[0], -1, 0) if not planar else out[..., 0]


def decode(data: bytes) -> tuple[np.ndarray, str]:
    """All planes of a file as (planes, rows, columns), and its description."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None:
        raise ValueError("not a TIFF file")
    version, = struct.unpack_from(order + "H", data, 2)
    big = version == 43
    at, = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)
    planes, info, seen = [], "", set()
    while at and at not in seen:
        seen.add(at)
        tags, at = _directory(data, at, order, big)
        planes.append(_page(data, tags, order))
        info = info or str(tags.get(270, ("",))[0])
    if not planes:
        raise ValueError("a TIFF file without pages")
    return np.concatenate(planes), info


def encode(stack: np.ndarray, info: str = "", compress: bool = False) -> bytes:
    """A stack of planes as a little-endian TIFF, a strip for each page."""
    stack = np.atleast_3d(stack) if stack.ndim != 2 else stack[None]
    kind = {"u": 1, "i": 2, "f": 3}[stack.dtype.kind]
    text = info.encode() + b"\0"
    out = bytearray(b"II*\0" + struct.pack("<I", 0))
    link = 4
    for plane in stack:
        raw = np.ascontiguousarray(plane.astype(plane.dtype.newbyteorder("<"))).tobytes()
        raw = zlib.compress(raw) if compress else raw
        at = len(out)
        out += raw + b"\0" * (len(raw) % 2)
        note = len(out)
        out += text + b"\0" * (len(text) % 2)
        tags = [(256, 4, 1, plane.shape[1]), (257, 4, 1, plane.shape[0]), (258, 3, 1, plane.itemsize * 8), (259, 3, 1, 8 if compress else 1), (262, 3, 1, 1)]
        tags += [(270, 2, len(text), note)] if len(text) > 4 else []
        tags += [(273, 4, 1, at), (277, 3, 1, 1), (278, 4, 1, plane.shape[0]), (279, 4, 1, len(raw)), (339, 3, 1, kind)]
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags)
        link = len(out)
        out += struct.pack("<I", 0)
    return bytes(out)


def channel_axis(shape: tuple[int, ...]) -> int | None:
    """Which axis of a stack holds channels: a short one beside two long ones, the first of those; null if none."""
    for axis in (0, len(shape) - 1):
        others = [n for i, n in enumerate(shape) if i != axis]
        if shape[axis] <= 8 and all(n > 32 for n in others):
            return axis
    return None


def to_channels_first(stack: np.ndarray, axis: str = "auto") -> np.ndarray:
    """A plane or a stack as (channels, rows, columns)."""
    if stack.ndim == 2:
        return stack[None]
    if axis == "none":
        raise ValueError("a single plane was expected")
    at = {"first": 0, "last": stack.ndim - 1}.get(axis, channel_axis(stack.shape))
    return np.moveaxis(stack, at or 0, 0)


def squeeze_plane(stack: np.ndarray) -> np.ndarray:
    """One plane: a leading or last axis of length one is dropped, anything else is an error."""
    if stack.ndim == 3 and 1 in (stack.shape[0], stack.shape[-1]):
        stack = stack[0] if stack.shape[0] == 1 else stack[..., 0]
    if stack.ndim != 2:
        raise ValueError(f"one plane was expected, not {stack.shape}")
    return stack


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True, suffixes: tuple[str, ...] = ("tif", "tiff")) -> DataFrame:
    """(path, image_id, modified, size) of files by glob and suffix, without their contents."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return found.where(F.lower("path").rlike(rf"\.({'|'.join(suffixes)})$")).select("path", F.regexp_replace(name, r"\.[^.]*$", "").alias("image_id"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def read_planes(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True, header_only: bool = False) -> DataFrame:
    """One row for each plane of each TIFF file; a file that cannot be read is a row with its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    files = files.where(F.lower("path").rlike(r"\.tiff?$")).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                image_id = name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    stack, info = decode(content)
                    rows = [(image_id, str(k), p.shape[0], p.shape[1], str(p.dtype), k, None if header_only else p.astype(float).ravel().tolist(), info, None) for k, p in enumerate(stack)]
                except (ValueError, struct.error, zlib.error, KeyError) as error:
                    rows = [(image_id, None, None, None, None, None, None, None, f"{type(error).__name__}: {error}")]
                yield pd.DataFrame(rows, columns=schemas.PLANES.names).astype({"height": "Int32", "width": "Int32", "page": "Int32"})

    return files.mapInPandas(run, schemas.PLANES)


def write_files(stacks: DataFrame, folder: str) -> DataFrame:
    """Write rows of (name, height, width, planes array<array<double>>, dtype) as TIFF files into a shared folder.

    The folder has to be one that all executors see; a file takes its name only
    when it is whole, so that a task that runs again does no harm.  Gives (name, path, size).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                stack = np.array([np.asarray(p, float).reshape(r.height, r.width) for p in r.planes]).astype(r.dtype)
                data = encode(stack)
                path = f"{folder}/{r.name}.tif"
                with open(f"{path}.{os.getpid()}.part", "wb") as f:
                    f.write(data)
                os.replace(f"{path}.{os.getpid()}.part", path)
                out.append((r.name, path, len(data)))
            yield pd.DataFrame(out, columns=["name", "path", "size"])

    return stacks.mapInPandas(run, "name string, path string, size long")
