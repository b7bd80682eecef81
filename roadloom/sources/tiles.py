"""Binary tiles of speed records, and tar archives of them, as a batch data source."""

from __future__ import annotations

import io
import struct
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from roadloom.params import TILE_VERSION

# Header tile id, last update (64 bits), edge count, version, two spares (32 bits); then the records and two zero words.
HEADER, PAD = struct.Struct("<QQIIII"), struct.Struct("<II")
SUFFIX = ".gph"
BATCH_ROWS = 65_536


def encode_tile(tile: int, updated: int, records: np.ndarray, version: int = TILE_VERSION) -> bytes:
    return HEADER.pack(tile, updated, len(records), version, 0, 0) + records.astype("<u8").tobytes() + PAD.pack(0, 0)


def decode_tile(blob: bytes) -> tuple[int, int, int, np.ndarray]:
    """tile, last update, version, records."""
    tile, updated, count, version, _, _ = HEADER.unpack_from(blob)
    return tile, updated, version, np.frombuffer(blob, dtype="<u8", count=count, offset=HEADER.size)


def write_tar(path: str, members: Iterator[tuple[str, bytes]]) -> int:
    """Members in the order given; returns their number."""
    n = 0
    with tarfile.open(path, "w") as tar:
        for name, blob in members:
            info = tarfile.TarInfo(name)
            info.size = len(blob)
            tar.addfile(info, io.BytesIO(blob))
            n += 1
    return n


class TileTarReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        with tarfile.open(self.path) as tar:
            return [InputPartition((m.name, m.offset_data, m.size)) for m in tar.getmembers() if m.isfile() and m.name.endswith(SUFFIX) and m.name.rsplit("/", 1)[-1][: -len(SUFFIX)].isdigit()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        _, offset, size = partition.value
        with open(self.path, "rb") as f:
            f.seek(offset)
            tile, updated, _, records = decode_tile(f.read(size))
        for at in range(0, len(records), BATCH_ROWS):
            part = records[at : at + BATCH_ROWS].view(np.int64)
            n = len(part)
            columns = [pa.array(np.full(n, tile, dtype=np.int64)), pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(part), pa.array(np.full(n, updated, dtype=np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["tile", "edge_index", "record", "last_update"])


class TileTar(DataSource):
    """spark.read.format("tile_tar").load(path): (tile, edge_index, record, last_update), a partition for each member."""

    @classmethod
    def name(cls) -> str:
        return "tile_tar"

    def schema(self) -> str:
        return "tile long, edge_index int, record long, last_update long"

    def reader(self, schema) -> DataSourceReader:
        return TileTarReader(self.options["path"])
