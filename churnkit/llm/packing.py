"""Packing documents into fixed-length sequences by vector best-fit."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch

END = (2).to_bytes(4, "little")
#: Where byte-level BPE splits a text into parts.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space that, beside a space or newline or in their place, joins what stands around it.
RUNS = ("  ", " \n", "\n ", "\n\n", *"\t\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)))
#: Characters from here on are split by the tokenizer itself.
BEYOND = "\u0250"


#: Marks that make a part of their own behind letters (an apostrophe does not).
MARKS = frozenset(".,;:!?")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class Remembered(dict):
    """A dictionary that works out a key's value when it is first asked for, so a look-up is one step of C code."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key):
        value = self[key] = self.work(key)
        return value


class UnitTokenizer:
    """Token ids of texts as little-endian 32-bit words.

    Byte-level BPE splits a text into parts, of which a single space or
    newline always begins one, and encodes each part by itself.  So the ids of
    a text are those of its space-separated units in order; units and parts
    recur, and each distinct one is encoded once and remembered (``limit`` of
    them at most, then the memory is emptied)."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.split, self.encode = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        self.letters = byte_letters()
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.first = Remembered(self._ids)  # units at the start of a text or a line
        self.later = Remembered(self._unit)  # units after a space
        self.parts = Remembered(self._part)

    def _model(self, part: str) -> bytes:
        return array("I", [t.id for t in self.encode(part)]).tobytes()

    def _part(self, part: str) -> bytes:
        return self._model(part.encode().decode("latin-1").translate(self.letters))

    def _ids(self, text: str) -> bytes:
        if text and max(text) >= BEYOND:
            return b"".join([self._model(part) for part, _ in self.split(text)])
        return b"".join(map(self.parts.__getitem__, PARTS.findall(text)))

    def _word(self, word: str) -> bytes:
        """Ids of a space and a word of letters: one part."""
        return self._model("\u0120" + word) if word.isascii() else self._part(" " + word)

    def _unit(self, unit: str) -> bytes:
        """Ids of a space and a unit; letters, or letters and one mark, are split without the pattern."""
        if unit.isalpha() and (unit.isascii() or max(unit) < BEYOND):
            return self._word(unit)
        word, mark = unit[:-1], unit[-1:]
        if mark in MARKS and word.isalpha() and (word.isascii() or max(word) < BEYOND):
            return self.later[word] + self.parts[mark]
        return self._ids(" " + unit)

    def _text(self, text: str) -> bytes:
        if any(run in text for run in RUNS):
            return self._ids(text)
        first, later, out = self.first, self.later, []
        for n, line in enumerate(text.split("\n")):
            units = line.split(" ")
            head = "\n" + units[0] if n else units[0]
            out.append(first[head])
            del units[0]
            out += map(later.__getitem__, units)
        return b"".join(out)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.later) + len(self.first) > self.limit:
            self._forget()
        return list(map(self._text, texts))


class DocumentTokenizer(UnitTokenizer):
    """As the tokenizer of the file: a text that may hold one of its added tokens is encoded whole by the tokenizer itself."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        super().__init__(path, limit)
        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        # a normalized token may match a text in another form
        self.added = tuple(t.content for t in added)
        self.always = any(t.normalized for t in added) and self.whole.normalizer is not None

    def _text(self, text: str) -> bytes:
        if self.always or any(t in text for t in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return super()._text(text)


@cache
def document_tokenizer(path: str) -> DocumentTokenizer:
    """A worker's tokenizer: the tasks that it runs one after the other read the file once and share what is remembered."""
    return DocumentTokenizer(path)


def pieces(df: DataFrame, tokenizer_path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, row)``: every document's ids and an end id, cut into pieces of
    ``capacity``, of which the first may be shorter; ``row`` tells repeated rows of a document apart."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = document_tokenizer(tokenizer_path)
        row = 0
        for big in batches:
            for at in range(0, big.num_rows, 200):
                b = big.slice(at, 200)
                take, piece, start, length, crc, rows = [], [], [], [], [], []
                for i, ids in enumerate(encode([x or "" for x in b.column(1).to_pylist()])):
                    ids += END
                    row += 1
                    rest = len(ids) % (4 * capacity)  # what whole pieces leave over is the first piece
                    for k, first in enumerate([*([0] if rest else []), *range(rest, len(ids), 4 * capacity)]):
                        part = ids[first : rest if first < rest else first + 4 * capacity]
                        take.append(i)
                        piece.append(k)
                        start.append(first // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        rows.append(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(take, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(rows, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "row"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, row long")


def best_fit(length: np.ndarray, capacity: int, max_docs: int, max_attention: float, weights: tuple[float, float, float],
             rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins, for items in the given order.

    An item needs (length, 1, length squared) of a bin's tokens, documents and
    attention cost, as shares of the capacities.  Among the bins with room in
    all three, ``norm`` takes the one whose weighted residual after the item
    is shortest, ``dot`` the one whose weighted residual has the largest dot
    product with the item; ties go to the bin opened first.  Bins with equal
    residuals are alike and kept together, so a choice looks at the distinct
    residuals only."""
    cap = np.array([capacity, max_docs, max_attention], float)
    scale = np.asarray(weights, float)
    state: dict[tuple[int, int, int], int] = {}  # residual -> slot
    stock: list[list[int]] = []  # slot -> bins, the first opened last
    room = np.zeros((64, 3))
    used = np.zeros(64, bool)
    free: list[int] = []
    where, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    filled: list[int] = []
    least = int(length.min()) if len(length) else 0

    def put(bin_: int, left: tuple[int, int, int]) -> None:
        nonlocal room, used
        if left[0] < least or left[1] < 1 or left[2] < least * least:
            return  # no item fits any more
        slot = state.get(left)
        if slot is None:
            slot = free.pop() if free else len(stock)
            if slot == len(stock):
                stock.append([])
                if slot == len(room):
                    room = np.concatenate([room, np.zeros_like(room)])
                    used = np.concatenate([used, np.zeros_like(used)])
            state[left] = slot
            room[slot], used[slot] = left, True
        stock[slot].append(bin_)

    for i, n in enumerate(length.tolist()):
        need = np.array([n, 1, n * n], float)
        top = len(stock)
        fits = np.flatnonzero(used[:top] & (room[:top] >= need).all(1))
        if len(fits):
            rest = room[fits]
            if rule == "norm":
                score = -((scale * (rest - need) / cap) ** 2).sum(1)
            else:
                score = (scale * (rest / cap) * (need / cap)).sum(1)
            slot = int(fits[score.argmax()])
            left = tuple(int(x) for x in room[slot])
            bin_ = stock[slot].pop()
            if not stock[slot]:
                del state[left]
                used[slot] = False
                free.append(slot)
        else:
            bin_, left = len(filled), (capacity, max_docs, int(max_attention))
            filled.append(0)
        where[i], offset[i] = bin_, filled[bin_]
        filled[bin_] += n
        put(bin_, (left[0] - n, left[1] - 1, left[2] - n * n))
    return where, offset, len(filled)


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 1024, max_docs: int | None = None,
         max_attention: float | None = None, weights: tuple[float, float, float] = (1.0, 0.0, 0.02), rule: str = "norm",
         group_size: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone.  Every row of a repeated
    document is packed for itself.  Pieces are dealt by hash into groups of
    about ``group_size`` (as many groups as the counted pieces need); each
    group is packed by itself, longest pieces first, in bounded memory, and
    wastes part of its last few sequences at most.  ``max_docs`` and
    ``max_attention`` bind no sequence unless given.  Other columns are
    ignored; an empty table gives no rows."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    cut = scratch.keep(pieces(df, tokenizer_path, capacity, id_col, text_col), "pieces")
    groups = max(1, -(-cut.count() // group_size))
    docs, attention = max_docs or capacity, max_attention or capacity * capacity
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True], kind="stable")
        where, offset, _ = best_fit(frame["length"].to_numpy(), capacity, docs, attention, weights, rule)
        return frame.assign(sequence_id=frame["group"].to_numpy(np.int64) * (1 << 32) + where, offset=offset)[columns]

    id_type = cut.schema["doc_id"].dataType.simpleString()
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups)))
    out = dealt.groupBy("group").applyInPandas(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return scratch.result(out)
