"""Token ids as one wavelet matrix per shard.

Documents are encoded whole, ordered by ``doc_id`` and cut into shards of about
``SHARD_TOKENS`` ids at document borders.  A shard is one self-describing byte string: a header,
the documents' ids and end positions, and one succinct bit-plane per bit of the largest id, each
with rank samples every ``BLOCK`` bits.  The planes give access, counting and the n-th occurrence
of an id (``rank``/``select``) without decoding the shard.  The byte strings are written as a
Parquet table, one row a shard, by Spark's own committer: a lost executor leaves no half shard.

Shard format (little endian): magic ``WVM1``, then u64 tokens, u32 bits, u32 documents; doc ids
(i64, with one validity byte each before them) and document ends (u64); then for every plane, most
significant first: u64 zeros, the packed bits, and u32 ranks of the blocks.

Cases: a NULL text is empty and gets the end id alone; documents of equal id follow each other in
an order fixed by their texts' crc32; a NULL ``doc_id`` comes after all others; a document above
``SHARD_TOKENS`` gets a shard of its own; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.common import parts_for, ship, stage

MAGIC, BLOCK = b"WVM1", 512
SHARD_TOKENS, RANGE_BYTES, MEMO, GROUP_BYTES = 500_000, 15_000_000, 150_000, 20_000_000
#: Words that the tokenizer may normalise by more than lower-casing them, or that may hold a special token: all but
#: printable ASCII (``<`` begins the special tokens) and the letters of Latin-1.
OTHER = re.compile(r"[^ -;=-~À-ÖØ-öø-ÿ]")
#: The file's pattern on all other words, lowered: their pieces, and the blanks between the words.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]| |[^ a-z0-9ß-öø-ÿ]+")
#: Calls of 400 pieces the library answers at once; its answers take some 100 bytes an id.
AT_ONCE = 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: The rules that pieces rely on, as the vocabulary file states them.  Another file is encoded whole.
NORMALISES = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
     "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_CODERS: dict[str, Coder] = {}


class Coder:
    """A tokenizer with a memo of pieces; one per worker process.

    The vocabulary's tokenizer drops white space and never joins across it, so a text's ids are those
    of its words; a word's are those of the pieces that the file's pattern parts it into.  Words that
    are normalised by more than lower-casing are pieces as they stand, for the whole tokenizer.
    ``codes`` maps a piece to a number whose ids are ``flat[start: start + size]``.  A memo of more
    than ``MEMO`` pieces is cut to the most used, so its memory is bounded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.by_piece = rules["normalizer"] == NORMALISES and rules["pre_tokenizer"] == SPLITS
        self.bare = Tokenizer(self.tokenizer.model)                    # the same, for pieces of lowered words
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)     # ids that end a piece
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.spans = np.zeros((1 << 17, 2), np.int64)                   # start, size by number
        self.uses = np.zeros(1 << 17, np.int64)
        self.count = 0
        self._add([" "], np.zeros(0, np.int64), np.zeros(1, np.int64))

    def cut(self) -> None:
        """Keep the pieces that were used twice or more since the last cut, at most half the memo."""
        pieces = list(self.codes)[1:]
        numbers = np.arange(1, self.count)
        uses = self.uses[1: self.count]
        keep = np.flatnonzero(uses > 1)
        keep = keep[np.argsort(-uses[keep], kind="stable")[: MEMO // 2]]
        ids, sizes = self._gather(numbers[keep])
        self.clear()
        self._add([pieces[k] for k in keep.tolist()], ids, sizes)

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Store new pieces' ids one after the other."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(sizes) > len(self.spans):
            self.spans = np.concatenate([self.spans, np.zeros_like(self.spans)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.flat[self.used: self.used + len(ids)] = ids
        rows = self.spans[self.count: self.count + len(sizes)]
        rows[:, 0], rows[:, 1] = self.used + np.cumsum(sizes) - sizes, sizes
        self.codes.update(zip(pieces, range(self.count, self.count + len(sizes))))
        self.count, self.used = self.count + len(sizes), self.used + len(ids)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces in a row, and their sizes."""
        start, size = self.spans[numbers].T
        return spread(self.flat, start, size), size

    def _numbers(self, pieces: list[str], encode) -> np.ndarray:
        """Every piece's number; ``encode`` stores the ones that are not there."""
        code = np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(code < 0).tolist()
        if new:
            lacking = [pieces[k] for k in new]
            encode(list(dict.fromkeys(lacking)))
            code[new] = list(map(self.codes.__getitem__, lacking))
        self.uses[: self.count] += np.bincount(code, minlength=self.count)
        return code

    def _lowered(self, pieces: list[str]) -> None:
        self._closed(pieces, lambda calls: self.bare.encode_batch_fast(calls, is_pretokenized=True, add_special_tokens=False))

    def _as_they_stand(self, pieces: list[str]) -> None:
        whole = self.tokenizer.encode_batch_fast
        self._closed([p for p in pieces if p.isalpha()],
                     lambda calls: whole([" ".join(c) for c in calls], add_special_tokens=False))
        self._singly([p for p in pieces if not p.isalpha()])

    def _closed(self, pieces: list[str], encode) -> None:
        """Encode pieces that the tokenizer does not part, many to a call, told apart by the ids that end one."""
        calls = [pieces[lo: lo + 400] for lo in range(0, len(pieces), 400)]
        for lo in range(0, len(calls), AT_ONCE):
            for part, got in zip(calls[lo: lo + AT_ONCE], encode(calls[lo: lo + AT_ONCE])):
                ids = np.array(got.ids, np.int64)
                ends = np.flatnonzero(self.closes[ids]) + 1
                if len(ends) == len(part) and ends[-1] == len(ids):
                    self._add(part, ids, np.diff(ends, prepend=0))
                else:                                                   # letters by another Unicode table
                    self._singly(part)

    def _singly(self, pieces: list[str]) -> None:
        for lo in range(0, len(pieces), 400 * AT_ONCE):
            part = pieces[lo: lo + 400 * AT_ONCE]
            each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self._add(part, np.array(list(chain.from_iterable(each)), np.int64), np.array([len(i) for i in each]))

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the size of each word's."""
        if self.count > MEMO:
            self.cut()
        joined = " ".join(words)
        other = [k for k, w in enumerate(words) if OTHER.search(w)] if OTHER.search(joined) else []
        if not other:
            number = self._numbers(PIECES.findall(joined.lower() + " "), self._lowered)
        else:
            kept = list(words)
            for k in other:
                kept[k] = ""
            number = self._numbers(PIECES.findall(" ".join(kept).lower() + " "), self._lowered)
            closes = np.flatnonzero(number == 0)[other]                 # the blanks after them
            number = np.insert(number, closes, self._numbers([words[k] for k in other], self._as_they_stand))
        ids, sizes = self._gather(number)
        return ids, np.diff(np.cumsum(sizes)[number == 0], prepend=0)


def spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[start: start + size]`` one after the other."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    place = np.repeat((start - (ends - size)).astype(kind), size)
    place += np.arange(total, dtype=kind)
    return flat[place]


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts between the six ASCII blanks, and the number of words up to each text's end."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    word = ~BLANK[data]
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1                    # a blank follows every text
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if len(data) and word[0]:
        starts = np.concatenate([[0], starts])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    words = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data[word]))
    return words, np.searchsorted(ends, stops, "right")


def encode_texts(path: str, texts: list[str | None], end_id: int) -> list[np.ndarray]:
    """Ids of each whole text and the end id.  A word of several texts is encoded once."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    if not _CODERS[path].by_piece:
        got = _CODERS[path].tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        return [np.append(np.array(e.ids, np.uint32), np.uint32(end_id)) for e in got]
    words, upto = split_words([(t or "").encode("utf-8", "replace") for t in texts])
    if not len(words):
        return [np.array([end_id], np.uint32) for _ in texts]
    coded = words.dictionary_encode()
    del words
    at, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    del coded
    ids, sizes = _CODERS[path].words(words)
    at = np.insert(at, upto, len(sizes))                                # the end id is one more word, after each text's
    del words
    ids, sizes = np.append(ids, np.uint32(end_id)), np.append(sizes, 1)
    start, sizes = (np.cumsum(sizes) - sizes).astype(np.int32)[at], sizes.astype(np.int32)[at]
    stops = np.cumsum(sizes, dtype=np.int64)[upto + np.arange(len(upto))]
    return np.split(spread(ids, start, sizes), stops[:-1])


class Wavelet:
    """A shard: build from ids, or open its bytes; ``access``, ``rank``, ``select``, ``count``, ``decode``."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]], doc_ids: list, ends: np.ndarray):
        self.n, self.planes, self.doc_ids, self.ends = n, planes, doc_ids, ends

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: list, ends: np.ndarray) -> Wavelet:
        planes, bits = [], max(1, int(np.max(ids, initial=0)).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        ids = np.asarray(ids, kind)
        for level in range(bits - 1, -1, -1):
            one = (ids & kind(1 << level)) != 0
            packed = np.packbits(one, bitorder="little")
            planes.append((int(len(one) - np.count_nonzero(one)), packed, cls._ranks(packed)))
            ids = np.concatenate([ids.compress(~one), ids.compress(one)])
        return cls(len(ids), planes, list(doc_ids), np.asarray(ends, np.uint64))

    @staticmethod
    def _ranks(packed: np.ndarray) -> np.ndarray:
        """Ones before each block of ``BLOCK`` bits."""
        per = np.bitwise_count(packed).astype(np.uint32)
        sums = np.add.reduceat(per, np.arange(0, len(per), BLOCK // 8)) if len(per) else per
        return np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32)

    def to_bytes(self) -> bytes:
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        out = [MAGIC, struct.pack("<QII", self.n, len(self.planes), len(self.doc_ids)), known.tobytes(),
               np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(), self.ends.astype("<u8").tobytes()]
        for zeros, packed, ranks in self.planes:
            out += [struct.pack("<Q", zeros), packed.tobytes(), ranks.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> Wavelet:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        n, bits, docs = struct.unpack_from("<QII", data, 4)
        at = 20
        known = np.frombuffer(data, np.uint8, docs, at)
        ids = np.frombuffer(data, "<i8", docs, at + docs)
        ends = np.frombuffer(data, "<u8", docs, at + 9 * docs)
        at += 17 * docs
        size, blocks, planes = -(-n // 8), -(-n // BLOCK) + 1, []
        for _ in range(bits):
            zeros, = struct.unpack_from("<Q", data, at)
            planes.append((zeros, np.frombuffer(data, np.uint8, size, at + 8),
                           np.frombuffer(data, "<u4", blocks, at + 8 + size)))
            at += 8 + size + 4 * blocks
        return cls(n, planes, [int(i) if k else None for i, k in zip(ids, known)], ends)

    def _ones(self, plane: int, pos: int) -> int:
        """Ones among the first ``pos`` bits of a plane."""
        _, packed, ranks = self.planes[plane]
        block, byte = pos // BLOCK, pos // 8
        ones = int(ranks[block]) + int(np.bitwise_count(packed[block * BLOCK // 8: byte]).sum(dtype=np.int64))
        if pos % 8:
            ones += (int(packed[byte]) & ((1 << pos % 8) - 1)).bit_count()
        return ones

    def _bit(self, plane: int, pos: int) -> int:
        return int(self.planes[plane][1][pos // 8]) >> (pos % 8) & 1

    def access(self, pos: int) -> int:
        if not 0 <= pos < self.n:
            raise IndexError(pos)
        value = 0
        for k, (zeros, _, _) in enumerate(self.planes):
            bit, ones = self._bit(k, pos), self._ones(k, pos)
            value, pos = value << 1 | bit, zeros + ones if bit else pos - ones
        return value

    def _range(self, token: int, pos: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the first ``pos`` ids lie in the last plane's order."""
        if token < 0 or token >> len(self.planes):
            return 0, 0
        lo, hi = 0, pos
        for k, (zeros, _, _) in enumerate(self.planes):
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (len(self.planes) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, pos: int) -> int:
        """Occurrences of ``token`` among the first ``pos`` ids."""
        lo, hi = self._range(token, min(pos, self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, nth: int) -> int:
        """Position of the ``nth`` occurrence of ``token``, from 0."""
        lo, hi = self._range(token, self.n)
        if not 0 <= nth < hi - lo:
            raise IndexError(nth)
        pos = lo + nth
        for k in range(len(self.planes) - 1, -1, -1):
            zeros = self.planes[k][0]
            bit = token >> (len(self.planes) - 1 - k) & 1
            want = pos - zeros if bit else pos
            left, right = 0, self.n - 1               # the want-th one (zero) bit of the plane
            while left < right:
                mid = (left + right) // 2
                ones = self._ones(k, mid + 1)
                if (ones if bit else mid + 1 - ones) > want:
                    right = mid
                else:
                    left = mid + 1
            pos = left
        return pos

    def decode(self) -> np.ndarray:
        """All ids, by undoing the planes' stable partitions from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for k, (zeros, packed, _) in enumerate(reversed(self.planes)):
            one = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            back = np.empty_like(ids)
            back[np.flatnonzero(~one)] = ids[:zeros]
            back[np.flatnonzero(one)] = ids[zeros:] | kind(1 << k)
            ids = back
        return ids.astype(np.uint32)


def groups(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[list, list]]:
    """Ids and texts to encode together: about ``GROUP_BYTES``, told every ``rows`` rows."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            piece = batch.slice(lo, rows)
            ids += piece.column(0).to_pylist()
            texts += piece.column(1).to_pylist()
            size += piece.column(1).nbytes
            if size >= GROUP_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def shards(docs: DataFrame, path: str, end_id: int, shard_tokens: int = SHARD_TOKENS,
           range_bytes: int = RANGE_BYTES, texts_at_once: int = 256) -> DataFrame:
    """(part, seq, n_tokens, payload): the shards, (part, seq) in document order.

    The texts are placed by range before they are encoded, once, inside the shards' task."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.isnull("doc_id"), F.col("doc_id").asc(), F.crc32(F.col("text").cast("binary"))]
    placed = (docs.select("doc_id", "text").repartitionByRange(parts_for(total, range_bytes), *order)
              .sortWithinPartitions(*order))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        names, parts, size = [], [], 0

        def flush():
            payload = Wavelet.build(np.concatenate(parts), names, np.cumsum([len(x) for x in parts])).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([payload], pa.binary())], names=["part", "seq", "n_tokens", "payload"])

        for own, texts in groups(batches, texts_at_once):
            for name, ids in zip(own, encode_texts(path, texts, end_id)):
                if parts and size + len(ids) > shard_tokens:
                    yield flush()
                    names, parts, size, seq = [], [], 0, seq + 1
                names.append(name)
                parts.append(ids)
                size += len(ids)
        if parts:
            yield flush()

    ship(docs.sparkSession)
    return placed.mapInArrow(run, "part int, seq bigint, n_tokens bigint, payload binary")


def write(docs: DataFrame, path: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode, shard and write; returns the shard table read back from the files."""
    return stage(shards(docs, path, end_id, shard_tokens), "wavelet-shards")


def read_documents(shard_table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    # exclusive sums in two steps: over the few range partitions, and within each
    sizes = shard_table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("seq")
    bases = (shard_table.select("part", "seq", "n_tokens").join(before, "part")
             .select("part", "seq", (F.col("part_base") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("base")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                w = Wavelet.from_bytes(payload.as_buffer().to_pybytes())
                raw = w.decode().astype("<u4")
                ends = w.ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ends), pa.int32()), pa.array([seq] * len(ends), pa.int64()),
                     pa.array(w.doc_ids, pa.int64()), pa.array(starts), pa.array(ends - starts),
                     pa.array([zlib.crc32(raw[s:e]) for s, e in zip(starts, ends)], pa.int64())],
                    names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    ship(shard_table.sparkSession)
    docs = shard_table.select("part", "seq", "payload").mapInArrow(
        run, "part int, seq bigint, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    return (docs.join(bases, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))
