"""Map files in PBF: a Spark data source, files in any store that Spark reads, and a distributed writer.

In file systems that workers have mounted, `partitions` reads blob headers only and deals runs of
whole blobs to tasks, so a planet file is decoded by as many tasks as it has megabytes. From any other
store a file is one row of Spark's own reader, at most 2 GB of it: cut larger ones up. Entities leave
in Arrow batches. Metadata beyond versions is never decoded.

    spark.dataSource.register(OsmPbf)
    spark.read.format("osmpbf").load(path)      # rows of schemas.ENTITIES
"""

from __future__ import annotations

import io
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.codec import zigzag
from ..schemas import ENTITIES
from . import wire

# The largest header and blob of the format, and the order of member types.
MOST_HEADER, MOST_BLOB = 32 << 10, 32 << 20
MEMBERS = ("NODE", "WAY", "RELATION")
#: Bytes of a partition, about; entities of an Arrow batch and of a written blob.
SPLIT, BATCH = 16 << 20, 4096
_MEMBER = pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())])
ARROW = pa.schema([("entity", pa.string()), ("id", pa.int64()), ("version", pa.int32()), ("lat", pa.int32()), ("lng", pa.int32()), ("refs", pa.list_(pa.int64())), ("members", pa.list_(_MEMBER)), ("tags", pa.map_(pa.string(), pa.string()))])


class MapFileError(ValueError):
    """A file that is no map file, or broken."""


def blob_at(file, at: int) -> tuple[str, int, int] | None:
    """(type, start, size) of the blob whose frame begins at a place, None at the end."""
    file.seek(at)
    size = file.read(4)
    if not size:
        return None
    if len(size) < 4 or (n := struct.unpack(">I", size)[0]) > MOST_HEADER:
        raise MapFileError(f"no blob header at byte {at}")
    header = wire.fields(file.read(n))
    if not header[1] or not header[3] or header[3][0] > MOST_BLOB:
        raise MapFileError(f"broken blob header at byte {at}")
    return bytes(header[1][0]).decode(), at + 4 + n, header[3][0]


def inflate(blob: bytes) -> bytes:
    """What a blob holds: plain or deflated."""
    own = wire.fields(blob)
    if own[3]:
        data = zlib.decompress(own[3][0])
    elif own[1]:
        data = bytes(own[1][0])
    else:
        raise MapFileError("a blob compressed in another way than zlib")
    if own[2] and own[2][0] != len(data):
        raise MapFileError("a blob of another size than stated")
    return data


def _int64(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


class Block:
    """A primitive block's entities."""

    def __init__(self, data: bytes):
        own = wire.fields(data)
        self.names = [bytes(x).decode("utf-8", "replace") for x in wire.fields(own[1][0])[1]] if own[1] else []
        self.groups = own[2]
        self.granularity = own[17][0] if own[17] else 100
        self.lat, self.lng = (_int64(own[k][0]) if own[k] else 0 for k in (19, 20))

    def name(self, place: int) -> str:
        if not 0 <= place < len(self.names):
            raise MapFileError(f"no string {place} in a table of {len(self.names)}")
        return self.names[place]

    def place(self, raw, offset: int):
        """1e-7 degrees; the offset is in nanodegrees as the raw value times granularity is."""
        whole = offset + self.granularity * raw
        return np.trunc(np.asarray(whole) / 100).astype(np.int64) if isinstance(raw, np.ndarray) else int(whole / 100)

    def pairs(self, keys: list, values: list) -> dict[str, str]:
        """Tags, the first of repeated keys winning."""
        keys, values = wire.packed(keys).tolist(), wire.packed(values).tolist()
        if len(keys) != len(values):
            raise MapFileError("a key without a value")
        out: dict[str, str] = {}
        for k, v in zip(keys, values, strict=True):
            out.setdefault(self.name(k), self.name(v))
        return out

    def version(self, info: list) -> int:
        found = wire.fields(info[0])[1] if info else []
        return int(found[0]) if found else 1

    def entities(self) -> Iterator[tuple]:
        for group in self.groups:
            own = wire.fields(group)
            if own[5]:
                raise MapFileError("changesets are not supported")
            for raw in own[1]:
                node = wire.fields(raw)
                lat, lng = (wire.signed(np.array(node[k][:1], np.uint64))[0].item() for k in (8, 9))
                yield "NODE", int(wire.signed(np.array(node[1][:1], np.uint64))[0]), self.version(node[4]), self.place(lat, self.lat), self.place(lng, self.lng), None, None, self.pairs(node[2], node[3])
            for raw in own[2]:
                yield from self._dense(wire.fields(raw))
            for raw in own[3]:
                way = wire.fields(raw)
                refs = wire.deltas(way[8])
                if (refs <= 0).any():
                    raise MapFileError("a node id that is not positive")
                yield "WAY", way[1][0], self.version(way[4]), None, None, refs.tolist(), None, self.pairs(way[2], way[3])
            for raw in own[4]:
                rel = wire.fields(raw)
                roles, ids, kinds = wire.packed(rel[8]).tolist(), wire.deltas(rel[9]).tolist(), wire.packed(rel[10]).tolist()
                if not len(roles) == len(ids) == len(kinds) or any(k >= len(MEMBERS) for k in kinds):
                    raise MapFileError("incomplete or unknown members")
                members = [(MEMBERS[k], i, self.name(r)) for k, i, r in zip(kinds, ids, roles, strict=True)]
                yield "RELATION", rel[1][0], self.version(rel[4]), None, None, None, members, self.pairs(rel[2], rel[3])

    def _dense(self, own: dict[int, list]) -> Iterator[tuple]:
        ids, lats, lngs = wire.deltas(own[1]), wire.deltas(own[8]), wire.deltas(own[9])
        if not len(ids) == len(lats) == len(lngs):
            raise MapFileError("dense columns of different lengths")
        versions = wire.packed(wire.fields(own[5][0])[1]) if own[5] else np.ones(len(ids), np.uint64)
        if len(versions) != len(ids):
            raise MapFileError("dense columns of different lengths")
        flat, at = wire.packed(own[10]).tolist(), 0
        for i, version, lat, lng in zip(ids.tolist(), versions.tolist(), self.place(lats, self.lat).tolist(), self.place(lngs, self.lng).tolist(), strict=True):
            tags: dict[str, str] = {}
            if flat:  # without any tag in the block there are no delimiters either
                while flat[at]:
                    tags.setdefault(self.name(flat[at]), self.name(flat[at + 1]))
                    at += 2
                at += 1
            yield "NODE", i, version, lat, lng, None, None, tags


@dataclass
class Blobs(InputPartition):
    path: str
    start: int
    end: int


def record_batches(entities: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Entities in Arrow batches of schemas.ENTITIES."""
    while rows := list(islice(entities, BATCH)):
        columns = [list(c) for c in zip(*rows, strict=True)]
        columns[6] = [m and [dict(zip(("type", "ref", "role"), x, strict=True)) for x in m] for m in columns[6]]
        columns[7] = [list(t.items()) for t in columns[7]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def entities_of(file, start: int, end: int | None = None) -> Iterator[tuple]:
    """Entities of the blobs of an open file from a place on, up to another."""
    at = start
    while (end is None or at < end) and (frame := blob_at(file, at)):
        kind, begin, size = frame
        at = begin + size
        if kind == "OSMHeader":
            continue
        if kind != "OSMData":
            raise MapFileError(f"unknown blob type {kind}")
        file.seek(begin)
        yield from Block(inflate(file.read(size))).entities()


def is_map(name: str) -> bool:
    """Whether a file of a folder is one: by its ending, or as a part that Spark wrote."""
    return name.endswith(".pbf") or name.startswith("part-")


class PbfReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].removeprefix("file://")
        self.split = int(options.get("split", SPLIT))

    def partitions(self):
        files = [self.path] if os.path.isfile(self.path) else sorted(os.path.join(self.path, f) for f in os.listdir(self.path) if is_map(f))
        out = []
        for path in files:
            with open(path, "rb") as f:
                start = at = 0
                while frame := blob_at(f, at):
                    at = frame[1] + frame[2]
                    if at - start >= self.split:
                        out.append(Blobs(path, start, at))
                        start = at
                if at > start:
                    out.append(Blobs(path, start, at))
        return out or [Blobs(self.path, 0, 0)]

    def read(self, partition):
        if partition.end == partition.start:
            return
        with open(partition.path, "rb") as f:
            yield from record_batches(entities_of(f, partition.start, partition.end))


class OsmPbf(DataSource):
    """Entities of a file, or of all .pbf files of a folder."""

    @classmethod
    def name(cls):
        return "osmpbf"

    def schema(self):
        return ENTITIES

    def reader(self, schema):
        return PbfReader(self.options)


def read(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Rows of schemas.ENTITIES."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file":
        spark.dataSource.register(OsmPbf)
        return spark.read.format("osmpbf").option("split", split).load(place.toUri().getPath())
    return read_whole(spark, path)


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """Rows of schemas.ENTITIES, each file read as one row by Spark, wherever it is."""

    def parse(batches):
        for b in batches:
            for content in b.column(0):
                yield from record_batches(entities_of(io.BytesIO(content.as_py()), 0))

    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(name.endswith(".pbf") | name.startswith("part-")).select("content").mapInArrow(parse, ENTITIES)


def write(entities: DataFrame, path: str) -> None:
    """Rows of schemas.ENTITIES as files below path, by Spark's text writer.

    Its line feed is the last byte of a blob: the value of a field that readers skip. Files appear by
    Spark's commit only, on any file system.
    """

    def frames(batches):
        held = PbfWriter(line_ended=True)
        yield [held.header()]
        for b in batches:
            for k in range(0, b.num_rows, BATCH):
                for r in b.slice(k, BATCH).to_pylist():
                    tags, version = dict(r["tags"] or ()), r["version"] or 1
                    if r["entity"] == "NODE":
                        held.node(r["id"], r["lat"], r["lng"], tags, version)
                    elif r["entity"] == "WAY":
                        held.way(r["id"], r["refs"] or [], tags, version)
                    else:
                        held.relation(r["id"], [(m["type"], m["ref"], m["role"] or "") for m in r["members"] or ()], tags, version)
                yield [held.flush()]

    def run(batches):
        for f in frames(batches):
            yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in f], pa.binary())], names=["value"])

    columns = [c.name for c in ARROW]
    entities.select(*columns).mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def nodes(entities: DataFrame) -> DataFrame:
    return entities.where("entity = 'NODE'").select("id", "version", "lat", "lng", "tags")


def ways(entities: DataFrame) -> DataFrame:
    """References are not located yet."""
    empty = F.lit(None).cast("int")
    refs = F.transform("refs", lambda r, i: F.struct((i + 1).cast("int").alias("pos"), r.alias("id"), empty.alias("lat"), empty.alias("lng")))
    return entities.where("entity = 'WAY'").select("id", "version", refs.alias("refs"), "tags")


def relations(entities: DataFrame) -> DataFrame:
    members = F.transform("members", lambda m, i: F.struct((i + 1).cast("int").alias("pos"), m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role")))
    return entities.where("entity = 'RELATION'").select("id", "version", members.alias("members"), "tags")


class PbfWriter:
    """A small file, entity by entity: for exchange and tests."""

    def __init__(self, dense: bool = True, compress: bool = True, granularity: int = 100, line_ended: bool = False):
        self.dense, self.compress, self.granularity, self.line_ended = dense, compress, granularity, line_ended
        self.names: dict[str, int] = {"": 0}
        self.nodes: list = []
        self.ways: list = []
        self.relations: list = []

    def _name(self, text: str) -> int:
        return self.names.setdefault(text, len(self.names))

    def node(self, i: int, lat: int, lng: int, tags: dict[str, str] | None = None, version: int = 1) -> None:
        self.nodes.append((i, lat, lng, tags or {}, version))

    def way(self, i: int, refs: list[int], tags: dict[str, str] | None = None, version: int = 1) -> None:
        self.ways.append((i, refs, tags or {}, version))

    def relation(self, i: int, members: list[tuple[str, int, str]], tags: dict[str, str] | None = None, version: int = 1) -> None:
        self.relations.append((i, members, tags or {}, version))

    @staticmethod
    def _steps(values: list[int]) -> bytes:
        return wire.pack(zigzag(b - a) for a, b in zip([0, *values], values, strict=False))

    def _tags(self, tags: dict[str, str]) -> list[tuple[int, bytes]]:
        return [(2, wire.pack(map(self._name, tags))), (3, wire.pack(map(self._name, tags.values())))] if tags else []

    def _raw(self, degrees: int) -> int:
        return degrees * 100 // self.granularity

    def block(self) -> bytes:
        parts = []
        if self.nodes and self.dense:
            ids, lats, lngs, tags, versions = zip(*self.nodes, strict=True)
            flat = [x for t in tags for x in (*(self._name(y) for kv in t.items() for y in kv), 0)] if any(tags) else []
            info = wire.message((1, wire.pack(versions)))
            parts.append((2, wire.message((1, self._steps(list(ids))), (5, info), (8, self._steps([*map(self._raw, lats)])), (9, self._steps([*map(self._raw, lngs)])), (10, wire.pack(flat)))))
        elif self.nodes:
            parts += [(1, wire.message((1, zigzag(i)), *self._tags(t), (4, wire.message((1, v))), (8, zigzag(self._raw(a))), (9, zigzag(self._raw(b))))) for i, a, b, t, v in self.nodes]
        parts += [(3, wire.message((1, i), *self._tags(t), (4, wire.message((1, v))), (8, self._steps(r)))) for i, r, t, v in self.ways]
        parts += [(4, wire.message((1, i), *self._tags(t), (4, wire.message((1, v))), (8, wire.pack(self._name(m[2]) for m in ms)), (9, self._steps([m[1] for m in ms])), (10, wire.pack(MEMBERS.index(m[0]) for m in ms)))) for i, ms, t, v in self.relations]
        group = wire.message(*parts)
        table = wire.message(*((1, n) for n in self.names))
        return wire.message((1, table), (2, group), (17, self.granularity))

    def frame(self, kind: str, data: bytes) -> bytes:
        blob = wire.message((2, len(data)), (3, zlib.compress(data))) if self.compress else wire.message((1, data))
        if self.line_ended:  # an unknown field, whose value is a line feed
            blob += wire.message((15, 10))
        header = wire.message((1, kind), (3, len(blob)))
        return struct.pack(">I", len(header)) + header + blob

    def flush(self) -> bytes:
        """A blob of what was added since the last one."""
        out = self.frame("OSMData", self.block())
        self.names, self.nodes, self.ways, self.relations = {"": 0}, [], [], []
        return out

    def header(self) -> bytes:
        return self.frame("OSMHeader", wire.message((4, "OsmSchema-V0.6"), (4, "DenseNodes")))
