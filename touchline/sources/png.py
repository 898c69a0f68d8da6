"""A file sink for pictures: one PNG file a row, for readers of image folders.

``df.write.format("png_files").mode("append").save(folder)`` takes rows with the
columns ``name`` (file name without extension; a slash is written as %2F), ``height``, ``width``,
``nChannels`` (3: BGR, 4: BGRA) and ``data`` (pixel bytes, row by row: the layout
of Spark's image source). A row whose sizes don't fit its bytes is written as it
stands, bytes and all: a file that no decoder accepts (a zero byte where there
are none, as readers skip empty files).

Every task writes into a hidden folder of its own attempt, and the commit renames
the folders of the attempts that Spark accepted, one rename a task. A lost
executor's half-written folder stays hidden (Spark skips names that begin with
``_``) until an abort or ``tidy`` removes it, and its task's next attempt writes
another one. Paths may be in any file system that Arrow opens by URI.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "png_files"
SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed value of the file format


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(height: int, width: int, channels: int, data: bytes) -> bytes:
    """PNG bytes of BGR or BGRA pixels (8 bits a channel, no line filter)."""
    bgr = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    lines = np.zeros((height, 1 + width * channels), np.uint8)
    order = [2, 1, 0, 3][:channels]
    lines[:, 1:] = bgr[:, :, order].reshape(height, -1)
    header = struct.pack(">IIBBBBB", width, height, 8, 6 if channels == 4 else 2, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def file_bytes(height: int | None, width: int | None, channels: int | None, data: bytes | None) -> bytes:
    """The file of one row: a picture, or the bytes themselves where they are none."""
    data = data or b""
    if channels in (3, 4) and height and width and height > 0 and width > 0 and len(data) == height * width * channels:
        return encode(height, width, channels, data)
    return data or b"\0"


def _opened(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    files: int


class PngWriter(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator) -> Written:
        system, folder = _opened(self.path)
        attempt = uuid.uuid4().hex
        own = f"{folder}/_attempt-{attempt}"
        files = 0
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("name", "height", "width", "nChannels", "data")]
            for i in range(batch.num_rows):
                if not files:
                    system.create_dir(own, recursive=True)
                name, *picture = (c[i].as_py() for c in columns)
                with system.open_output_stream(f"{own}/{str(name).replace("/", "%2F")}.png") as out:
                    out.write(file_bytes(*picture))
                files += 1
        return Written(attempt, files)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _opened(self.path)
        system.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None and m.files:
                system.move(f"{folder}/_attempt-{m.attempt}", f"{folder}/part-{m.attempt}")

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _opened(self.path)
        for m in messages:
            if m is not None and m.files:
                system.delete_dir(f"{folder}/_attempt-{m.attempt}")


class PngFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PngWriter:
        missing = {"name", "height", "width", "nChannels", "data"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"no column {', '.join(sorted(missing))}")
        if overwrite:
            raise ValueError("append to a fresh folder: this sink doesn't replace files")
        return PngWriter(self.options["path"])


def write_pngs(pictures: DataFrame, path: str) -> None:
    """Write every row of ``pictures`` as a file below ``path``."""
    spark = pictures.sparkSession
    spark.dataSource.register(PngFiles)
    pictures.write.format(FORMAT).mode("append").save(path)


def tidy(spark: SparkSession, path: str) -> int:
    """Remove what uncommitted attempts left below ``path``; only when no write
    to it is running. Returns how many folders went."""
    from pyarrow import fs

    system, folder = _opened(path)
    left = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name.startswith("_attempt-")]
    for name in left:
        system.delete_dir(name)
    return len(left)
