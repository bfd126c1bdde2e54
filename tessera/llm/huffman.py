"""Token ids as canonical length-limited Huffman codes.

One code book serves a dataset: lengths come from global id counts by package-merge, codes are
canonical, so the lengths alone are stored, as a table beside the blocks: a dataset is read with nothing
but its folder. A file is a run of independent blocks. A block holds
some documents, each starting at a whole byte, and a bit offset for every CHECKPOINT ids; decoding
looks 2**LIMIT-entry tables up, at all checkpoints of a block side by side. Spark's own writer
commits the files, so a lost executor or a second attempt leaves no part of a file behind, on any
file system. Files are numbered in order of (id column, crc, length).

A block, little-endian: b"THUF", u32 bytes after this field, u32 documents, u32 checkpoints,
i64 ids of documents (with u8 flags, 1 for a null id, after them), u32 numbers of ids, u32 bit
offsets of checkpoints, the bits; then a line feed, which is not counted.

Cases: a null text counts as empty; an empty table writes no block and reads as no row; repeated
rows are stored each; null ids sort first; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import codec as bpe
from .common import discard, map_texts, shared_dir, strings, written

MAGIC = b"THUF"
#: Bits of the longest code, unless there are more ids than such codes.
LIMIT = 16
#: Ids from one bit offset to the next.
CHECKPOINT = 128
#: Ids of a block and of a file, about.
BLOCK_IDS, FILE_IDS = 1 << 17, 1 << 22
#: Files at most: beyond, files grow. Bins that documents are counted in, for each file.
MOST_FILES, BINS = 1 << 14, 4
#: Folders of a dataset.
BLOCKS, BOOK = "blocks", "book"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each id's code (0: the id does not occur), by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(n))))
    used = used[np.lexsort((used, counts[used]))]
    weights = counts[used].astype(np.int64)
    leaf_levels, merged = [], np.empty(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([weights, merged])
        order = np.argsort(both, kind="stable")
        leaf_levels.append(order < n)
        both = both[order]
        pairs = len(both) // 2 * 2
        merged = both[0:pairs:2] + both[1:pairs:2]
    lengths, take = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(leaf_levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[used] = lengths
    return out


class Codebook:
    """Canonical codes of given lengths, with the decoding table."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.longest = int(self.lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        sizes = np.int64(1) << (self.longest - self.lengths[used])
        firsts = np.cumsum(sizes) - sizes
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[used] = firsts >> (self.longest - self.lengths[used])
        self.symbols = np.zeros(1 << self.longest, np.uint32)
        filled = np.repeat(used, sizes)
        self.symbols[: len(filled)] = filled
        self.sizes = self.lengths[self.symbols].astype(np.int64)
        self.window = (self.longest + 14) // 8

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of ids in whole bytes, and the bit offset of every CHECKPOINT-th id."""
        if not len(ids):
            return b"", np.empty(0, np.uint32)
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = ends - sizes
        width = 8 * self.window
        shifted = self.codes[ids] << (width - sizes - (at & 7))
        total = int(ends[-1] + 7) // 8
        out = np.zeros(total + self.window)
        for k in range(self.window):  # bits of neighbours never overlap: sums are unions
            out += np.bincount((at >> 3) + k, (shifted >> (width - 8 - 8 * k)) & 255, len(out))
        return out[:total].astype(np.uint8).tobytes(), at[::CHECKPOINT].astype(np.uint32)

    def decode(self, bits: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids from each bit offset in turn, counts[k] (CHECKPOINT at most) from starts[k]."""
        raw = np.frombuffer(bits + bytes(self.window + 1), np.uint8).astype(np.int64)
        joined = np.zeros(len(raw) - self.window, np.int64)
        for k in range(self.window):
            joined = joined << 8 | raw[k : len(raw) - self.window + k]
        order = np.argsort(-counts, kind="stable")
        at, most = starts[order].astype(np.int64), counts[order]
        out = np.zeros((int(most[0]) if len(most) else 0, len(most)), np.uint32)
        width, mask = 8 * self.window - self.longest, (1 << self.longest) - 1
        live = len(most)
        for step in range(len(out)):
            while live and most[live - 1] <= step:
                live -= 1
            place = at[:live]
            index = joined[place >> 3] >> (width - (place & 7)) & mask
            out[step, :live] = self.symbols[index]
            at[:live] = place + self.sizes[index]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        lanes = out.T[back]
        return lanes[np.arange(lanes.shape[1]) < counts[:, None]] if len(counts) else np.empty(0, np.uint32)


def pack_block(docs: list[int | None], counts: list[int], marks: list[np.ndarray], bits: list[bytes]) -> bytes:
    """One block; marks are bit offsets within each document's bits."""
    bases = np.cumsum([0, *map(len, bits)])
    offsets = np.concatenate([m.astype(np.uint64) + np.uint64(8 * b) for m, b in zip(marks, bases, strict=False)]).astype("<u4")
    body = b"".join([
        np.array([len(docs), len(offsets)], "<u4").tobytes(),
        np.array([d or 0 for d in docs], "<i8").tobytes(),
        bytes(d is None for d in docs),
        np.array(counts, "<u4").tobytes(),
        offsets.tobytes(),
        *bits,
    ])
    return MAGIC + len(body).to_bytes(4, "little") + body + b"\n"


def read_blocks(data: bytes, book: Codebook):
    """(document ids, ids of each) of every block in a file's bytes."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        body = memoryview(data)[at + 8 : at + 8 + size]
        at += 9 + size
        docs, marks = np.frombuffer(body, "<u4", 2).tolist()
        place = 8
        ids = np.frombuffer(body, "<i8", docs, place)
        null = np.frombuffer(body, np.uint8, docs, place + 8 * docs)
        counts = np.frombuffer(body, "<u4", docs, place + 9 * docs).astype(np.int64)
        offsets = np.frombuffer(body, "<u4", marks, place + 13 * docs)
        lanes = -(-counts // CHECKPOINT)
        each = np.full(marks, CHECKPOINT, np.int64)
        last = np.cumsum(lanes)[lanes > 0] - 1
        each[last] = counts[lanes > 0] - CHECKPOINT * (lanes[lanes > 0] - 1)
        flat = book.decode(bytes(body[place + 13 * docs + 4 * marks :]), offsets, each)
        ends = np.cumsum(counts)
        yield [None if z else i for i, z in zip(ids.tolist(), null, strict=True)], [flat[e - c : e] for e, c in zip(ends, counts, strict=True)]


def tokenise(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, crc, ids): little-endian ids of 2 bytes where the vocabulary allows, else 4."""

    def start():
        codec = bpe(tokenizer_path)
        kind, tail = id_type(max(codec.size, end_id + 1)), np.array([end_id], "<u4")

        def work(batch):
            ids = [np.concatenate([x, tail]) for x in codec.encode(strings(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int32()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())], names=["doc_id", "n_tokens", "crc", "ids"])

        return work

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, start, "doc_id long, n_tokens int, crc long, ids binary")


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs: as many numbers as the vocabulary has reach the driver."""
    kind = id_type(size)

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    out = np.zeros(size, np.int64)
    for row in tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row.id] = row.n
    return out


def _bounds(tokens: DataFrame, place, files: int) -> np.ndarray:
    """Where files end, so that each holds about as many ids: documents are counted in BINS quantiles a
    file, and the ids of these decide. A bounded number of figures reaches the driver."""
    n = BINS * files
    cuts = [i / n for i in range(1, n)]
    found = tokens.agg(F.percentile_approx(place, cuts, max(10_000, 4 * n)).alias("q")).first().q if files > 1 else None
    edges = np.unique(np.array(found or [], np.float64))
    if not len(edges):
        return edges

    def count(batches):
        total = np.zeros(len(edges) + 1, np.int64)
        for b in batches:
            np.add.at(total, np.searchsorted(edges, b.column("place").to_numpy(), "left"), b.column("n_tokens").to_numpy())
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bin", "n"])

    sums = np.zeros(len(edges) + 1, np.int64)
    for r in tokens.select(place.alias("place"), "n_tokens").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        sums[r.bin] = r.n
    file = (np.cumsum(sums) - sums) * files // max(1, int(sums.sum()))
    return edges[np.flatnonzero(np.diff(file))]


def write(tokens: DataFrame, path: str, size: int) -> None:
    """Writes the blocks of (doc_id, n_tokens, crc, ids) and their code lengths below path.

    tokens is read four times; pass a written table.
    """
    counts = id_counts(tokens, size)
    lengths, kind = code_lengths(counts), id_type(size)
    files = min(MOST_FILES, max(1, -(-int(counts.sum()) // FILE_IDS)))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))) + F.col("crc") / float(1 << 32)
    bounds = _bounds(tokens, place, files)
    files = len(bounds) + 1

    def compress(batches):
        book = Codebook(lengths)
        for b in batches:
            bits, marks = zip(*(book.encode(np.frombuffer(x, kind)) for x in b.column("ids").to_pylist()), strict=True)
            own = np.searchsorted(bounds, b.column("place").to_numpy(), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own), *(b.column(c) for c in ("doc_id", "n_tokens", "crc")), pa.array([m.tobytes() for m in marks], pa.binary()), pa.array(bits, pa.binary())], names=["file", "doc_id", "n_tokens", "crc", "marks", "bits"])

    def blocks(batches):
        docs, counts_, marks, bits, held = [], [], [], [], 0
        for b in batches:
            for doc, n, m, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "marks", "bits")), strict=True):
                docs.append(doc), counts_.append(n), marks.append(np.frombuffer(m, np.uint32)), bits.append(x)
                held += n
                if held >= BLOCK_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array([pack_block(docs, counts_, marks, bits)[:-1]], pa.binary())], names=["value"])
                    docs, counts_, marks, bits, held = [], [], [], [], 0
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([pack_block(docs, counts_, marks, bits)[:-1]], pa.binary())], names=["value"])

    # Files are cut at quantiles found beforehand: ranges that Spark samples would encode all twice.
    coded = tokens.withColumn("place", place).mapInArrow(compress, "file int, doc_id long, n_tokens int, crc long, marks binary, bits binary")
    keys = [F.asc_nulls_first("doc_id"), F.col("crc"), F.col("n_tokens")]
    ordered = coded.repartitionById(files, F.col("file")).sortWithinPartitions(*keys)
    ordered.mapInArrow(blocks, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(f"{path}/{BLOCKS}")
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    tokens.sparkSession.createDataFrame([*book, (-1, size)], "id int, length int").coalesce(1).write.parquet(f"{path}/{BOOK}")


def code_book(spark: SparkSession, path: str) -> np.ndarray:
    """The code lengths of a dataset: as many numbers as the vocabulary has."""
    found = {r.id: r.length for r in spark.read.parquet(f"{path}/{BOOK}").collect()}
    out = np.zeros(found.pop(-1), np.uint8)
    for i, n in found.items():
        out[i] = n
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, at, n_tokens, ids): documents of the files below path; at counts in a file.

    ids: little-endian unsigned 32-bit integers.
    """

    lengths = code_book(spark, path)

    def parse(batches):
        book = Codebook(lengths)
        for b in batches:
            for number, data in zip(*(b.column(c).to_pylist() for c in ("file", "content")), strict=True):
                before = 0
                for docs, ids in read_blocks(data, book):
                    sizes = [len(x) for x in ids]
                    at = before + np.cumsum([0, *sizes])
                    before = int(at[-1])
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array(at[:-1], pa.int64()), pa.array(sizes, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["file", "doc_id", "at", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/{BLOCKS}")
    numbered = files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "content")
    return numbered.mapInArrow(parse, "file long, doc_id long, at long, n_tokens long, ids binary")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds start, the ids of all documents before, to rows with file, at and n_tokens.

    Only file totals (one row a file) are summed in order.
    """
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    return rows.join(bases, "file").withColumn("start", F.col("base") + F.col("at")).drop("base")


def round_trip(df: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes df's ids as files in the shared folder, reads them back: (doc_id, start, n_tokens, ids)."""
    spark = df.sparkSession
    size = max(bpe(tokenizer_path).size, end_id + 1)
    path = shared_dir(spark)
    tokens = written(tokenise(df, tokenizer_path, end_id, id_col, text_col))
    write(tokens, path, size)
    discard(tokens)
    return read(spark, path)
