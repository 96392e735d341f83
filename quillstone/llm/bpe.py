"""Byte-level BPE by per-prefix dynamic programming, and its decoding.

For every prefix of a piece of text exactly one token can be the last token of the prefix's BPE
encoding. An automaton over the vocabulary names, at each position, all tokens that are suffixes of
the prefix read so far; the one that is compatible with the last token of what lies before it is
stored; following these back from the end gives the exact ids. Two tokens are compatible if no merge
would ever have joined symbols across their border, which their merge trees tell.

Texts are cut in front of every space that a visible character follows (the pre-tokenizer always
cuts there), equal pieces of a slice are encoded once, and the ids are gathered by index.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import table
from .texts import blobs, gather, raw, slices

#: Fixed value: the splitting pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space in front of any kind of white space: such texts are cut by the pattern alone.
UNEVEN = r" (?:\s|\x0b|[\x1c-\x1f]|\x{85}|\p{Z})"
#: Pieces remembered by a worker, in two generations of this size.
REMEMBERED = 100_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 characters for
    themselves, all other bytes in order for the code points from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merge trees and the automaton of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.shown = {b: c for b, c in enumerate(alphabet)}
        back = {c: b for b, c in enumerate(alphabet)}
        size = 1 + max([*ids.values(), *self.specials.values()])
        self.bytes: list[bytes] = [b""] * size
        for text, i in ids.items():
            self.bytes[i] = bytes(back[c] for c in text)
        for text, i in self.specials.items():
            self.bytes[i] = text.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made = [-1] * size  # the rank of the merge that makes a token; -1: a single byte
        self.left, self.right = [-1] * size, [-1] * size
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i = ids[a + b]
            self.rank[ids[a], ids[b]] = r
            if self.made[i] < 0:
                self.made[i], self.left[i], self.right[i] = r, ids[a], ids[b]
        self.known: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in ids.items():
            if self.made[i] < 0 or self._parted(self.left[i], self.right[i], self.made[i]):
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        lens = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.token_len, self.token_at = lens, np.cumsum(lens) - lens
        self.token_bytes = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.find = regex.compile(PATTERN).findall
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in self.specials) + ")") if self.specials else None

    def _parted(self, l: int, r: int, until: int) -> bool:
        """No merge of rank below ``until`` joins symbols across the border between l and r.

        The border is walked back in time: l and r stood side by side until the later of them was
        made, before that its inner part did. A symbol is there until its parent is made (l_end,
        r_end); of equal merges the one further left comes first.
        """
        made, rank = self.made, self.rank
        l_end = r_end = until
        while True:
            m = rank.get((l, r))
            if m is not None and m < l_end and (m <= r_end if r_end < until else m < until):
                return False
            if made[l] < 0 and made[r] < 0:
                return True
            if made[l] > made[r]:
                l_end, l = made[l], self.right[l]
            else:
                r_end, r = made[r], self.left[r]

    def compatible(self, l: int, r: int) -> bool:
        key = l << 20 | r
        known = self.known.get(key)
        if known is None:
            if len(self.known) > 300_000:
                self.known.clear()
            known = self.known[key] = self._parted(l, r, 1 << 40)
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word in the byte alphabet."""
        last = [-1] * len(word)
        lens = [0] * len(word)
        known, compatible = self.known.get, self.compatible
        for end, (token, n) in self.automaton.iter(word):
            if last[end] < 0:
                before = end - n
                if before >= 0:
                    ok = known(last[before] << 20 | token)
                    if not (compatible(last[before], token) if ok is None else ok):
                        continue
                last[end], lens[end] = token, n
        out, at = [], len(word) - 1
        while at >= 0:
            out.append(last[at])
            at -= lens[at]
        return out[::-1]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of a piece of text that holds no special token."""
        out, shown, words = [], self.shown, self.words
        for word in self.find(piece):
            ids = words.get(word)
            if ids is None:
                ids = self.encode_word(word if word.isascii() and word.isalpha() else "".join([shown[b] for b in word.encode()]))
                if len(word) <= 64:
                    if len(words) > REMEMBERED:
                        words.clear()
                    words[word] = ids
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        parts = self.special_split.split(text) if self.special_split else [text]
        return [i for p in parts if p for i in ([self.specials[p]] if p in self.specials else self.encode_piece(p))]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of concatenated ids; ends are the numbers of ids up to the end of each text.
        Bytes that are not UTF-8 become replacement characters."""
        counts = self.token_len[ids]
        data = gather(self.token_bytes, self.token_at[ids], counts)
        stops = np.concatenate([[0], np.cumsum(counts)])[ends]
        starts = np.concatenate([[0], stops[:-1]])
        heads = data[starts[starts < stops]]
        try:
            if ((heads & 0xC0) == 0x80).any():
                raise UnicodeError
            memoryview(data).tobytes().decode("utf-8")
        except UnicodeError:
            return pa.array([data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts, stops)], pa.string())
        return blobs(data, stops, pa.string())


class SliceEncoder:
    """Encodes string arrays; equal pieces once."""

    def __init__(self, encode_pieces: Callable[[list[str]], Iterable[bytes]], encode_text: Callable[[str], list[int]], specials: list[str]):
        self.encode_pieces, self.encode_text = encode_pieces, encode_text
        self.special = "|".join(regex.escape(s) for s in specials)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _entries(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece."""
        young, old = self.young, self.old
        out = [young.get(p) for p in pieces]
        missing = []
        for i, found in enumerate(out):
            if found is None:
                found = old.get(pieces[i])
                if found is None:
                    missing.append(i)
                else:
                    out[i] = young[pieces[i]] = found
        if missing:
            for i, b in zip(missing, self.encode_pieces([pieces[i] for i in missing])):
                out[i] = b
                if len(pieces[i]) <= 64:
                    young[pieces[i]] = b
        if len(young) > REMEMBERED:
            self.old, self.young = young, {}
        return out

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ids of all texts one after the other, and the number of ids up to each end."""
        n = len(text)
        if not n:
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        uneven = pc.match_substring_regex(text, UNEVEN + (f"|{self.special}" if self.special else "")).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(~uneven), text, "")
        split = pc.split_pattern(even, " ")
        if isinstance(split, pa.ChunkedArray):
            split = split.combine_chunks()
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        per = np.diff(split.offsets.to_numpy()).astype(np.int64)
        first = np.cumsum(per) - per
        words = coded.dictionary.to_pylist()
        heads = coded.dictionary.take(pa.array(at[first])).to_pylist()
        at[first] = len(words) + np.arange(n)
        entries = self._entries([" " + w for w in words])
        entries += self._entries(heads)
        for i in np.flatnonzero(uneven).tolist():
            entries[len(words) + i] = np.array(self.encode_text(text[i].as_py()), dtype="<u4").tobytes()
        count = np.array([len(e) for e in entries], dtype=np.int64) // 4
        flat = np.frombuffer(b"".join(entries), dtype="<u4")
        ids = gather(flat, (np.cumsum(count) - count)[at], count[at])
        return ids, np.concatenate([[0], np.cumsum(count[at])])[np.cumsum(per)]


_LOADED: dict[str, tuple[Vocabulary, SliceEncoder]] = {}


def _loaded(path: str | None) -> tuple[Vocabulary, SliceEncoder]:
    """One per worker process, which also finds the default path."""
    path = path or default_vocabulary()
    if path not in _LOADED:
        v = Vocabulary(path)
        _LOADED[path] = v, SliceEncoder(lambda pieces: (array("I", v.encode_piece(p)).tobytes() for p in pieces), v.encode, list(v.specials))
    return _LOADED[path]


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str | None, back: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, n_tokens, ids; with back also the text decoded from these ids."""
    vocabulary, encoder = _loaded(path)
    for part in slices(batches):
        ids, ends = encoder.encode(part.column("text"))
        cols = [part.column("doc_id"), pa.array(np.diff(np.concatenate([[0], ends]))), blobs(ids.view(np.uint8), ends * 4, pa.binary())]
        if not back:
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids"])
            continue
        for at in range(0, part.num_rows, 256):  # decoding looks up every byte: few texts at once
            own = ends[at : at + 256]
            before = int(ends[at - 1]) if at else 0
            text = vocabulary.decode(ids[before : int(own[-1])], own - before)
            yield pa.RecordBatch.from_arrays([*(c.slice(at, 256) for c in cols), text], ["doc_id", "n_tokens", "ids", "decoded"])


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocabulary, _ = _loaded(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            data, ends = raw(part.column("ids"))
            text = vocabulary.decode(np.frombuffer(data.tobytes(), dtype="<u4"), ends[1:] // 4)
            kept = [part.column(c) for c in part.schema.names]
            yield pa.RecordBatch.from_arrays([*kept, text], [*part.schema.names, "decoded"])


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit): one row per row of docs.

    Null and empty texts have no ids. The strings of special tokens inside a text become their ids.
    Repeated doc_ids are rows of their own. Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda it: _encode_batches(it, path, False), "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids with decoded string."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return map_arrow(rows, lambda it: _decode_batches(it, path), "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """encode_documents and decode_documents in one pass of one worker a task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda it: _encode_batches(it, path, True), "doc_id long, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    return round_trip(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
