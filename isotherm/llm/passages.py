"""Substring dedup by hashing text units, with original offsets.

A text is cut into pieces at line ends, after sentence marks, before capitalised words, and between
two words whose pair has a hash of 0 modulo 8, which moves with a passage in text without marks; a
unit is the shortest run of whole pieces from one piece on that has ``min_words`` words (the rest
of the text, if that is less, is no unit).  A character of a script without blanks is half a word.  Units overlap, so a passage is found wherever it
stands, in the middle of a line too.  Units are normalised (lower case, single blanks) and their
96-bit digests grouped globally; of equal units the earliest by (doc_id, position) stays, the
pieces of all others are removed, except pieces that an earliest occurrence needs.

Only a minimum per digest is aggregated, in partial sums, and the digests' rows meet their minimum
in joins of two written frames, whose hot keys Spark can split.

Cases: NULL and empty texts have no units and stay as they are; a NULL ``doc_id`` ranks after
all ids; rows of one id and text are one document and lose the same spans; rows of one id with
different texts, NULL ids too, are told apart by a 64-bit hash of id and text; texts below
``min_words`` words are never touched; an empty table gives an empty result; other columns are kept
by ``remove`` and not read, and its own columns get underscores where the input has their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.llm.common import fresh, ship, stage

MIN_WORDS = 8
#: One word pair in so many ends a piece.
EVERY = 8


def _set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(0x10000, bool)
    for lo, hi in ranges:
        out[lo: hi + 1] = True
    return out


# White space as Python's str.split sees it; sentence marks; capitals (Latin, Greek,
# Cyrillic); scripts that set no blanks (Thai, Lao, Burmese, Khmer, kana, Chinese).
SPACE = _set((9, 13), (28, 32), (133, 133), (160, 160), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
             (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
MARK = _set(*[(ord(c), ord(c)) for c in ".!?。！？"])
CAPITAL = _set((0x41, 0x5A), (0xC0, 0xD6), (0xD8, 0xDE), (0x391, 0x3A9), (0x410, 0x42F))
BLANKLESS = _set((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
                 (0xF900, 0xFAFF))
#: Odd multiplier of the words' rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)                            # modulo 2**64


_TABLES = [_powers(BASE, 1 << 14), _powers(BACK, 1 << 14)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for texts of up to ``n`` characters; kept for the next text unless very long."""
    if n <= len(_TABLES[0]):
        return _TABLES[0], _TABLES[1]
    made = _powers(BASE, n), _powers(BACK, n)
    if n <= 1 << 18:
        _TABLES[:] = made
    return made


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _lowered(text: str) -> str:
    """Lower case, character by character where the whole text's would shift positions or depend on
    what stands beside a letter (a final sigma)."""
    low = text.lower()
    return low if len(low) == len(text) and "Σ" not in text else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Pieces:
    """The pieces of a text: character spans, half-words, and normalised texts as UTF-8."""
    start: np.ndarray
    stop: np.ndarray
    half: np.ndarray
    norm: list[bytes]


def pieces(text: str) -> Pieces:
    low = _lowered(text)
    raw = np.minimum(_codes(text), 0xFFFF)
    code = _codes(low)
    space, single = SPACE[raw], BLANKLESS[raw]
    none = np.zeros(0, np.int64)
    # words: every blankless character, and every run of other characters without white space
    solid = ~space
    begins = solid.copy()
    begins[1:] &= space[:-1] | single[:-1] | single[1:]
    start = np.flatnonzero(begins)
    if not len(start):
        return Pieces(none, none, none, [])
    ends = solid.copy()
    ends[:-1] &= space[1:] | single[1:] | single[:-1]
    stop = np.flatnonzero(ends) + 1
    # a word's hash from prefix sums of its characters, shifted back to position 0
    up, down = _tables(len(code))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[: len(code)])])
    word = (sums[stop] - sums[start]) * down[start]
    word ^= word >> np.uint64(29)
    pair = (word[:-1] * np.uint64(0xBF58476D1CE4E5B9) + word[1:]) * np.uint64(0x94D049BB133111EB)
    # cuts before a word
    gap = start[1:] - stop[:-1]
    lines = np.cumsum(raw == 10)
    cut = np.ones(len(start), bool)
    cut[1:] = (lines[start[1:]] > lines[stop[:-1] - 1]) | (gap > 0) & (MARK[raw[stop[:-1] - 1]] | CAPITAL[raw[start[1:]]])
    cut[1:] |= (pair >> np.uint64(32)) % np.uint64(EVERY) == 0
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(start)) - 1
    half = np.add.reduceat(np.where(single[start], 1, 2), first)
    a, b = start[first], stop[last]
    odd = np.zeros(len(start), bool)                                   # more than one plain blank before the word
    odd[1:] = ~cut[1:] & ((gap > 1) | (gap == 1) & (raw[stop[:-1]] != 32))
    strange = np.add.reduceat(odd, first) > 0
    spans = zip(a.tolist(), b.tolist())
    norm = [low[x:y] for x, y in spans]
    for k in np.flatnonzero(strange).tolist():
        norm[k] = " ".join(norm[k].split())
    return Pieces(a, b, half, [x.encode("utf-8", "replace") for x in norm])


class _Span:
    def __init__(self, start: int, stop: int):
        self._span = start, stop

    def span(self) -> tuple[int, int]:
        return self._span


class PIECE:
    """The pieces of a text, as a pattern would give them."""

    @staticmethod
    def finditer(text: str) -> Iterator[_Span]:
        p = pieces(text)
        return map(_Span, p.start.tolist(), p.stop.tolist())


def _last_pieces(p: Pieces, min_words: int) -> np.ndarray:
    """The last piece of the unit that begins at each of the first pieces; the later ones begin none."""
    total = np.cumsum(p.half)
    last = np.searchsorted(total, total - p.half + 2 * min_words)
    return last[last < len(total)]


def _digests(p: Pieces, last: np.ndarray) -> list[bytes]:
    sizes = np.fromiter(map(len, p.norm), np.int64, len(p.norm)) + 1
    after = np.cumsum(sizes)
    whole = memoryview(b" ".join(p.norm))
    digest = xxhash.xxh3_128_digest
    lo = (after - sizes)[: len(last)].tolist()
    return [digest(whole[x:y])[:12] for x, y in zip(lo, (after[last] - 1).tolist())]


def units(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first piece, last piece, digest) of every unit."""
    p = pieces(text)
    last = _last_pieces(p, min_words)
    return zip(range(len(last)), last.tolist(), _digests(p, last))


def _row(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits of a document's id and text, a NULL id told from any other."""
    return F.xxhash64(F.isnull(doc_id), F.col(doc_id), F.col(text))


def unit_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, first, d1, d2): the units of all documents, by their first piece."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                counts, digests = [], []
                for text in part.column(1).to_pylist():
                    p = pieces(text or "")
                    found = _digests(p, _last_pieces(p, min_words))
                    counts.append(len(found))
                    digests += found
                if not digests:
                    continue
                digest = np.frombuffer(b"".join(digests), [("a", "<i8"), ("b", "<i4")])
                idx = pa.array(np.repeat(np.arange(len(counts)), counts))
                first = np.arange(len(digest)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(idx), part.column(2).take(idx), pa.array(first.astype(np.int32)),
                     pa.array(digest["a"].copy()), pa.array(digest["b"].copy())], names=["doc_id", "row", "first", "d1", "d2"])

    return (docs.select("doc_id", "text", _row().alias("row"))
            .mapInArrow(run, f"doc_id {kind}, row bigint, first int, d1 bigint, d2 int"))


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, row, u): the repeated units (first piece, whether it stays) of every document that has a
    later copy."""
    all_units = stage(unit_table(docs, min_words), "units")
    # most units are unique: half a digest, counted alone, tells which ones need not travel further
    seen = stage(all_units.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1"), "seen-digests")
    some = stage(all_units.join(seen.hint("merge"), "d1", "left_semi"), "repeated-units")
    place = F.struct(F.isnull("doc_id").alias("late"), "doc_id", "row", "first")
    firsts = stage(some.groupBy("d1", "d2").agg(F.min(place).alias("head"), F.max(place).alias("tail"))
                   .where("head != tail").select("d1", "d2", "head"), "first-units")
    hit = some.join(firsts.hint("merge"), ["d1", "d2"]).select("doc_id", "row", "first", (place == F.col("head")).alias("kept"))
    # a document's own units are the bound of what is gathered
    found = hit.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "kept")).alias("u"))
    return stage(found.where(F.exists("u", lambda x: ~x["kept"])), "repeats")


def _cut(text: str, found: list[dict], min_words: int) -> tuple[str, list[dict], int]:
    """The text without the repeated pieces, the spans removed, and their words."""
    p = pieces(text)
    last = _last_pieces(p, min_words)
    spans_of = list(zip(p.start.tolist(), p.stop.tolist()))
    gone = np.zeros(len(spans_of) + 1, np.int32)
    need = np.zeros(len(spans_of) + 1, np.int32)
    for u in found:
        mark = need if u["kept"] else gone
        mark[u["first"]] += 1
        mark[last[u["first"]] + 1] -= 1
    drop = (np.cumsum(gone)[:-1] > 0) & (np.cumsum(need)[:-1] == 0)
    spans, words = [], 0
    for k in np.flatnonzero(drop).tolist():
        words += p.norm[k].count(b" ") + 1
        if spans and drop[k - 1]:
            spans[-1]["stop"] = spans_of[k][1]
        else:
            spans.append({"start": spans_of[k][0], "stop": spans_of[k][1]})
    out, at = [], 0
    for s in spans:
        out.append(text[at: s["start"]])
        at = s["stop"]
    return "".join([*out, text[at:]]), spans, words


def remove(docs: DataFrame, min_words: int = MIN_WORDS, text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and removed_spans (character offsets in the
    original text) and removed_words appended (with underscores where ``docs`` has such columns)."""
    found = repeats(docs, min_words).hint("merge")
    name, held = fresh(docs, "__row"), fresh(docs, "__units")
    spans_col, words_col = fresh(docs, "removed_spans"), fresh(docs, "removed_words")
    keyed = docs.withColumn(name, _row()).alias("d")
    r = found.alias("r")
    joined = keyed.join(r, F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col(f"d.{name}").eqNullSafe(F.col("r.row")), "left")
    wide = joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("r.u").alias(held))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(spans_col, span), T.StructField(words_col, T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for b in batches:
            texts, spans, words = [], [], []
            for text, found_units in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                cut = _cut(text, found_units, min_words) if found_units and text else (text, [], 0)
                for out, x in zip((texts, spans, words), cut):
                    out.append(x)
            cols = list(b.columns[:-1])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind), pa.array(words, pa.int64())], names=out_columns)

    out_columns = [*docs.columns, spans_col, words_col]
    return wide.mapInArrow(run, schema)
