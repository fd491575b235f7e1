"""Archives of regions of interest as a table: zip files, or single regions, by Spark's binary reader.

The layout is the published one of the image tool's format: big-endian, a header of
64 bytes, then shorts relative to the upper left corner, then, where an option says
so, floats that are absolute; a second header tells where the name is.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The kinds of regions by number, the first bytes of a file, and the bit that says that coordinates are floats.
KINDS = ["polygon", "rectangle", "oval", "line", "freeline", "polyline", "none", "freehand", "traced", "angle", "point"]
MAGIC, VERSION, SUBPIXEL = b"Iout", 228, 128
#: Kinds that have a list of points.
_LISTED = ("polygon", "freeline", "polyline", "freehand", "traced", "angle", "point")

ROIS = "path string, archive string, number int, name string, kind string, top int, left int, bottom int, right int, position int, xs array<double>, ys array<double>, error string"


def decode_roi(data: bytes) -> dict[str, Any]:
    """One region: its name if it has one, kind, box, position and points (x, y); a rectangle's points are its corners."""
    if data[:4] != MAGIC or len(data) < 64:
        raise ValueError("no region of interest")
    kind_at, = struct.unpack_from(">B", data, 6)
    if kind_at >= len(KINDS):
        raise ValueError(f"kind {kind_at} is not known")
    kind = KINDS[kind_at]
    top, left, bottom, right, n = struct.unpack_from(">hhhhH", data, 8)
    options, = struct.unpack_from(">h", data, 50)
    position, header2 = struct.unpack_from(">ii", data, 56)
    xs, ys = [], []
    if kind in _LISTED:
        if options & SUBPIXEL:
            values = struct.unpack_from(f">{2 * n}f", data, 64 + 4 * n)
            xs, ys = list(values[:n]), list(values[n:])
        else:
            values = struct.unpack_from(f">{2 * n}h", data, 64)
            xs, ys = [float(left + v) for v in values[:n]], [float(top + v) for v in values[n:]]
    elif kind == "rectangle":
        xs, ys = [float(v) for v in (left, right, right, left)], [float(v) for v in (top, top, bottom, bottom)]
    elif kind == "line":
        x1, y1, x2, y2 = struct.unpack_from(">4f", data, 18)
        xs, ys = [x1, x2], [y1, y2]
    name = None
    if 0 < header2 <= len(data) - 24:
        at, length = struct.unpack_from(">ii", data, header2 + 16)
        if length and 0 < at <= len(data) - 2 * length:
            name = data[at : at + 2 * length].decode("utf-16-be")
    return {"name": name, "kind": kind, "top": top, "left": left, "bottom": bottom, "right": right, "position": position, "xs": xs, "ys": ys}


def encode_roi(name: str, kind: str, xs: list[float], ys: list[float], position: int = 0) -> bytes:
    """A region's file; coordinates that are not whole are kept as floats of four bytes."""
    if kind not in KINDS or len(xs) != len(ys) or not xs:
        raise ValueError("a region has a known kind and points")
    whole = all(float(v).is_integer() for v in [*xs, *ys])
    left, top, right, bottom = (int(v // 1) for v in (min(xs), min(ys), max(xs), max(ys)))
    if not whole:
        right, bottom = right + 1, bottom + 1
    n = len(xs) if kind in _LISTED else 0
    listed = b""
    if n:
        listed = struct.pack(f">{2 * n}h", *[int(round(v)) - left for v in xs], *[int(round(v)) - top for v in ys])
        listed += b"" if whole else struct.pack(f">{2 * n}f", *xs, *ys)
    line = struct.pack(">4f", xs[0], ys[0], xs[-1], ys[-1]) if kind == "line" else bytes(16)
    header2 = 64 + len(listed)
    head = MAGIC + struct.pack(">hBxhhhhH", VERSION, KINDS.index(kind), top, left, bottom, right, n) + line
    head += bytes(16) + struct.pack(">h", 0 if whole else SUBPIXEL) + bytes(4) + struct.pack(">ii", position, header2)
    second = bytes(16) + struct.pack(">ii", header2 + 64, len(name)) + bytes(40)
    return head + listed + second + name.encode("utf-16-be")


def decode_archive(path: str, content: bytes) -> list[dict[str, Any]]:
    """The regions of a zip file in its order, or of a single file; one that cannot be read has an error."""
    if content[:4] == MAGIC:
        members = [(path.rsplit("/", 1)[-1], lambda: content)]
    else:
        z = zipfile.ZipFile(io.BytesIO(content))
        members = [(m, lambda m=m: z.read(m)) for m in z.namelist() if m.lower().endswith(".roi")]
    found = []
    for k, (member, read) in enumerate(members):
        try:
            one = decode_roi(read())
            found.append(one | {"number": k, "name": one["name"] or member.rsplit("/", 1)[-1].removesuffix(".roi"), "error": None})
        except (ValueError, struct.error, zipfile.BadZipFile, zlib.error) as error:
            found.append({"number": k, "name": member, "error": f"{type(error).__name__}: {error}"})
    return found


def encode_archive(regions: list[dict[str, Any]]) -> bytes:
    """A zip file of regions (name, kind, xs, ys); of equal names all but the first get their number."""
    out, used = io.BytesIO(), set()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for k, r in enumerate(regions):
            member = f"{r['name']}.roi" if f"{r['name']}.roi" not in used else f"{r['name']}-{k}.roi"
            used.add(member)
            z.writestr(zipfile.ZipInfo(member), encode_roi(r["name"], r["kind"], r["xs"], r["ys"]))
    return out.getvalue()


def read_rois(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """One row for each region of each ``.zip`` and ``.roi`` file (columns `ROIS`); a file that cannot be read is a row with its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return decoded(files.where(F.lower("path").rlike(r"\.(zip|roi)$")).select("path", "content"))


def decoded(files: DataFrame) -> DataFrame:
    """The regions of archives that are a table (path, content)."""
    names = [c.split()[0] for c in ROIS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                archive = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    found = decode_archive(path, content)
                except (zipfile.BadZipFile, ValueError) as error:
                    found = [{"error": f"{type(error).__name__}: {error}"}]
                rows = [[(r | {"path": path, "archive": archive}).get(n) for n in names] for r in found]
                yield pd.DataFrame(rows, columns=names).astype({n: "Int32" for n in ("number", "top", "left", "bottom", "right", "position")})

    return files.select("path", "content").mapInPandas(run, ROIS)


def archives(rois: DataFrame) -> DataFrame:
    """(archive, content): one zip file for each archive of regions (archive, number, name, kind, xs, ys); a file's regions are one group."""
    regions = F.sort_array(F.collect_list(F.struct("number", "name", "kind", "xs", "ys")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, listed in zip(batch["archive"], batch["regions"], strict=True):
                content = encode_archive([{"name": r["name"], "kind": r["kind"], "xs": list(map(float, r["xs"])), "ys": list(map(float, r["ys"]))} for r in listed])
                yield pd.DataFrame([(archive, content)], columns=["archive", "content"])

    return rois.groupBy("archive").agg(regions.alias("regions")).mapInPandas(run, "archive string, content binary")
