"""Token ids in binary files of shuffled planes.

A file holds blocks of a fixed number of ids. Each block is transposed: all lowest bytes (or bits)
first, then all next ones; every plane is compressed by itself with zstandard. After the blocks come
the document index (ids of the documents and their lengths) and the chunk index (place, number of ids,
checksum and plane sizes of every block), so any block or document can be read alone.

    header   b"QPLN", version u2, id width u1, mode u1 (0 bytes, 1 bits), ids per block u4
    planes   of block 0, of block 1, ...
    doc ids  zstandard of int64, null as the smallest value
    lengths  zstandard of int64
    index    per block: offset u8, ids u4, crc32 u4, plane sizes u4 each
    footer   offsets of doc ids, lengths, index u8 each, blocks u8, documents u8, b"QEND"

All numbers are little-endian.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import UNEVEN, default_vocabulary
from ..shipping import map_arrow
from .common import materialize, partitions, scratch_path, table
from .texts import gather, raw, slices

MAGIC, END = b"QPLN", b"QEND"
BLOCK_IDS = 1 << 16
NULL_ID = -(1 << 63)
HEADER, FOOTER, ENTRY = struct.Struct("<4sHBBI"), struct.Struct("<5Q4s"), struct.Struct("<QII")


def to_planes(ids: np.ndarray, width: int, mode: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if mode == "byte":
        return [cells[:, i].tobytes() for i in range(width)]
    bits = np.unpackbits(np.ascontiguousarray(cells), axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(8 * width)]


def from_planes(planes: list[bytes], n: int, width: int, mode: str) -> np.ndarray:
    cells = np.zeros((n, 4), dtype=np.uint8)
    if mode == "byte":
        for i, p in enumerate(planes):
            cells[:, i] = np.frombuffer(p, dtype=np.uint8)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        cells[:, :width] = np.packbits(bits, axis=1, bitorder="little")
    return cells.reshape(-1).view("<u4")


class PlaneWriter:
    """Writes documents to a binary stream in the order given; holds one block at most."""

    def __init__(self, stream, width: int = 4, mode: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        if mode not in ("byte", "bit") or not 1 <= width <= 4 or block_ids < 1:
            raise ValueError("mode is byte or bit, width 1 to 4, block_ids at least 1")
        self.stream, self.width, self.mode, self.block_ids = stream, width, mode, block_ids
        self.squeeze = zstandard.ZstdCompressor(level=level).compress
        self.at = self.n_ids = self.pending = 0
        self.parts: list[np.ndarray] = []
        self.index: list[bytes] = []
        self.docs: list[int] = []
        self.lens: list[int] = []
        self._put(HEADER.pack(MAGIC, 1, width, int(mode == "bit"), block_ids))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.width < 4 and len(ids) and int(ids.max()) >> 8 * self.width:
            raise ValueError(f"an id needs more than {self.width} bytes")
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.lens.append(len(ids))
        self.parts.append(ids)
        self.n_ids += len(ids)
        self.pending += len(ids)
        if self.pending >= self.block_ids:
            data = np.concatenate(self.parts)
            full = len(data) // self.block_ids * self.block_ids
            for i in range(0, full, self.block_ids):
                self._block(data[i : i + self.block_ids])
            self.parts, self.pending = [data[full:]], len(data) - full

    def _block(self, ids: np.ndarray) -> None:
        ids = ids.astype("<u4")
        planes = [self.squeeze(p) for p in to_planes(ids, self.width, self.mode)]
        self.index.append(ENTRY.pack(self.at, len(ids), zlib.crc32(ids.tobytes())) + struct.pack(f"<{len(planes)}I", *map(len, planes)))
        self._put(b"".join(planes))

    def close(self) -> None:
        if self.pending:
            self._block(np.concatenate(self.parts))
        places = []
        for values in (self.docs, self.lens):
            places.append(self.at)
            self._put(self.squeeze(np.array(values, dtype="<i8").tobytes()))
        places.append(self.at)
        self._put(b"".join(self.index))
        self._put(FOOTER.pack(*places, len(self.index), len(self.docs), END))


class PlaneReader:
    """Reads a file from a seekable stream; blocks on demand, checked against their checksums."""

    def __init__(self, stream):
        self.stream = stream
        magic, _, self.width, bits, self.block_ids = HEADER.unpack(self._get(0, HEADER.size))
        size = stream.seek(0, os.SEEK_END)
        at_docs, at_lens, at_index, self.n_blocks, self.n_docs, end = FOOTER.unpack(self._get(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or end != END:
            raise ValueError("not a plane file")
        self.mode = "bit" if bits else "byte"
        self.n_planes = self.width * (8 if bits else 1)
        self.open = zstandard.ZstdDecompressor().decompress
        self.docs = np.frombuffer(self.open(self._get(at_docs, at_lens - at_docs)), dtype="<i8") if self.n_docs else np.zeros(0, "<i8")
        self.lens = np.frombuffer(self.open(self._get(at_lens, at_index - at_lens)), dtype="<i8") if self.n_docs else np.zeros(0, "<i8")
        self.starts = np.cumsum(self.lens) - self.lens
        self.index = self._get(at_index, self.n_blocks * (ENTRY.size + 4 * self.n_planes))

    def _get(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def block(self, i: int) -> np.ndarray:
        row = i * (ENTRY.size + 4 * self.n_planes)
        at, n, crc = ENTRY.unpack_from(self.index, row)
        sizes = struct.unpack_from(f"<{self.n_planes}I", self.index, row + ENTRY.size)
        data, planes = self._get(at, sum(sizes)), []
        for size in sizes:
            planes.append(self.open(data[:size]))
            data = data[size:]
        ids = from_planes(planes, n, self.width, self.mode)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {i} is damaged")
        return ids

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start to start + n of the file."""
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        found = [self.block(i) for i in range(first, last + 1)] if n else []
        return np.concatenate(found)[start - first * self.block_ids :][:n] if found else np.zeros(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, start, parts of its ids), in order; one block is held at a time."""
        held, block = -1, None
        for doc, start, n in zip(self.docs.tolist(), self.starts.tolist(), self.lens.tolist()):
            parts, at = [], start
            while at < start + n:
                if at // self.block_ids != held:
                    held = at // self.block_ids
                    block = self.block(held)
                low = at - held * self.block_ids
                part = block[low : low + start + n - at]
                parts.append(part)
                at += len(part)
            yield None if doc == NULL_ID else doc, start, parts


class LibraryEncoder:
    """The tokenizers library over the distinct words of a slice, without an object a word: words that begin
    with a space and a visible character are encoded as one text, since the pre-tokenizer cuts in front of
    each of them; where a word ends follows from the bytes that its tokens stand for. Other words, first
    words of texts, and texts that the pre-tokenizer may cut elsewhere are encoded alone."""

    def __init__(self, t):
        self.t = t
        self.batch = t.encode_batch_fast if hasattr(t, "encode_batch_fast") else t.encode_batch
        self.uneven = "|".join([UNEVEN, *(regex.escape(x.content) for x in t.get_added_tokens_decoder().values())])
        # A byte-level token has one character for each of its bytes.
        self.size = np.zeros(t.get_vocab_size(with_added_tokens=True), dtype=np.int64)
        for token, i in t.get_vocab().items():
            self.size[i] = len(token)

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each text)."""
        found = [e.ids for e in self.batch(texts, add_special_tokens=False)] if texts else []
        return np.array([i for ids in found for i in ids], dtype="<u4"), np.array([len(ids) for ids in found], dtype=np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word), of words behind a space."""
        data, offsets = raw(words)
        parts, counts, start = [], [], 0
        while start < len(words):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + JOINED, side="right")) - 1)
            ids = np.array(self.batch([data[offsets[start] : offsets[stop]].tobytes().decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.searchsorted(np.cumsum(self.size[ids]), offsets[start + 1 : stop + 1] - offsets[start]) + 1
            parts.append(ids)
            counts.append(np.diff(ends, prepend=0))
            start = stop
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ids of all texts one after the other, and the number of ids up to each end."""
        n = len(text)
        if not n:
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        uneven = pc.match_substring_regex(text, self.uneven).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(~uneven), text, ""), " ")
        split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        per = np.diff(split.offsets.to_numpy()).astype(np.int64)
        first = np.cumsum(per) - per
        joined = pc.match_substring_regex(coded.dictionary, r"^[^\s\x{85}\x{A0}\p{Z}\x1C-\x1F]").to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar(""), coded.dictionary, pa.scalar(" "))
        # Pieces: joined words, other words, first words of texts (whole texts where these are uneven).
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        heads = coded.dictionary.take(pa.array(at[first])).to_pylist()
        for i in np.flatnonzero(uneven).tolist():
            heads[i] = text[i].as_py()
        alone = spaced.filter(pa.array(~joined)).to_pylist() + heads
        ids_a, count_a = self._words(spaced.filter(pa.array(joined)))
        ids_b, count_b = self._alone(alone)
        flat, count = np.concatenate([ids_a, ids_b]), np.concatenate([count_a, count_b])
        piece = place[at]
        piece[first] = len(order) + np.arange(n)
        ids = gather(flat, (np.cumsum(count) - count)[piece], count[piece])
        return ids, np.concatenate([[0], np.cumsum(count[piece])])[np.cumsum(per)]


def _library(path: str | None) -> LibraryEncoder:
    """One a worker process, which also finds the default path."""
    path = path or default_vocabulary()
    if path not in _LIBRARY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        t = tokenizers.Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LIBRARY[path] = LibraryEncoder(t)
    return _LIBRARY[path]


_LIBRARY: dict[str, LibraryEncoder] = {}
JOINED = 1 << 16
#: Text of a slice: distinct words of a larger slice are fewer in all.
SLICE = 16 << 20


def _write_shard(batches: Iterator[pa.RecordBatch], out: str, path: str | None, end_id: int | None, mode: str) -> Iterator[pa.RecordBatch]:
    """One file for each partition; it gets its name when it is whole, so a lost task leaves none."""
    from pyarrow import fs
    from pyspark import TaskContext

    context = TaskContext.get()
    shard = context.partitionId()
    store, folder = fs.FileSystem.from_uri(out)
    store.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{shard:06d}.{context.taskAttemptId()}"
    encoder, tail = _library(path), np.array([] if end_id is None else [end_id], dtype="<u4")
    with store.open_output_stream(temporary) as stream:
        writer = PlaneWriter(stream, mode=mode)
        for part in slices(batches, limit=SLICE):
            ids, ends = encoder.encode(part.column("text"))
            start = 0
            for doc, end in zip(part.column("doc_id").to_pylist(), ends.tolist()):
                writer.add(doc, np.concatenate([ids[start:end], tail]))
                start = end
        writer.close()
    store.move(temporary, f"{folder}/{shard:06d}.qpl")
    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids], "n_bytes": [writer.at]})


def write_ids(docs: DataFrame, out: str | None = None, path: str | None = None, end_id: int | None = 2, mode: str = "byte") -> tuple[str, DataFrame]:
    """Write the ids of all texts to ``out`` in ascending doc_id order, one file per range of ids.

    ``out`` is a URI that all executors reach (default: in the shared folder). Returns it and the
    manifest: shard, n_docs, n_ids, n_bytes. Null texts are empty; null doc_ids come first; rows that
    repeat a doc_id follow one another, ordered by their text's hash.
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-ids")
    out = out if "://" in out or out.startswith("file:") else f"file://{out}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )
    manifest = map_arrow(ranged, lambda it: _write_shard(it, out, path, end_id, mode), "shard int, n_docs long, n_ids long, n_bytes long")
    return out, materialize(manifest, "token-manifest")


def _read_shards(batches: Iterator[pa.RecordBatch], out: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(out)
    for batch in batches:
        for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist()):
            with store.open_input_file(f"{folder}/{shard:06d}.qpl") as stream:
                rows = []
                for doc, start, parts in PlaneReader(stream).documents():
                    crc = 0
                    for p in parts:
                        crc = zlib.crc32(p.tobytes(), crc)
                    rows.append((doc, base + start, sum(map(len, parts)), crc))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(out: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the running sum passes one task, of as many rows as there are files.
    placed = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    dealt = placed.repartition(partitions(manifest.sparkSession), "shard")
    return map_arrow(dealt, lambda it: _read_shards(it, out), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_index(*write_ids(table(spark, sf_dir, "documents")))
