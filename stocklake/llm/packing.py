"""Packing of documents into windows by the online sum-of-squares rule.

Each task keeps an array of how many open windows there are of each fill level. A piece
goes where the sum of the squared counts of partly filled windows grows least, which
spreads the levels out so that later pieces find a window they fill up. What is open at a
task's end goes through the rule once more, in few tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

WINDOW = 2048
END_ID = 1
#: Sequence ids hold the number of the task above so many bits.
TASK_BITS = 40
#: Set in the sequence ids of the second pass.
SECOND = 1 << 62
#: Pieces of open windows that make a task of the second pass.
TAILS = 100_000
CACHED_PIECES = 400_000
#: The tokenizer's own token that stands between words encoded together.
BETWEEN, BETWEEN_ID = "<|startoftext|>", 49406


#: Letters, and all characters, of texts that are cut into the vocabulary's pieces here;
#: such texts need no normalisation but lower case.
LETTERS = r"a-z\u00df-\u00f6\u00f8-\u00ff"
SIMPLE = re.compile(r"[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: The pieces of the vocabulary's own pattern, for such characters.
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")


def _byte_signs() -> dict[int, str]:
    """The sign by which byte-level vocabularies write a byte: visible Latin-1 characters
    stand for themselves, the rest are numbered from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class _Pieces(dict):
    """Ids of pieces, merged by the tokenizer's model; forgotten when there are too many."""

    def __init__(self, model):
        self.model = model
        self.signs = _byte_signs()

    def __missing__(self, piece: str) -> bytes:
        if len(self) > CACHED_PIECES:
            self.clear()
        signs = piece if piece.isascii() else "".join(map(self.signs.__getitem__, piece.encode()))
        out = array("H", [token.id for token in self.model.tokenize(signs)]).tobytes()
        if len(piece) <= 64:
            self[piece] = out
        return out


class WordTokenizer:
    """Token ids of texts, with the vocabulary's merges run once per distinct piece.

    Texts of simple characters are cut into pieces by the vocabulary's pattern and merged
    by the tokenizer's model. In other texts this is done word by word, as the rules never
    look across white space; words of other characters go through the whole tokenizer,
    many in one call with a special token between them, or alone if they hold the text of
    a special token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.tokenizer.model)

    def _simple(self, text: str) -> bytes | None:
        if "<|" in text or not SIMPLE.fullmatch(text):
            return None
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text.lower())))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _by_word(self, text: str) -> bytes:
        """Ids of a text by its words."""
        words = [w.decode("utf-8", "replace") for w in text.encode("utf-8", "replace").split()]
        known, hard = {}, []
        for word in set(words):
            known[word] = self._simple(word)
            if known[word] is None:
                if "<|" in word:
                    known[word] = self._whole(word).tobytes()
                else:
                    hard.append(word)
        for start in range(0, len(hard), 4096):
            part = hard[start : start + 4096]
            ids = self._whole(BETWEEN.join(part))
            cuts = np.nonzero(ids == BETWEEN_ID)[0]
            begins = np.concatenate(([0], cuts + 1)).tolist()
            ends = np.concatenate((cuts, [len(ids)])).tolist()
            raw = ids.tobytes()
            for word, begin, end in zip(part, begins, ends, strict=True):
                known[word] = raw[2 * begin : 2 * end]
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, as unsigned 16-bit numbers."""
        ids = self._simple(text or "")
        return np.frombuffer(self._by_word(text) if ids is None else ids, "<u2")


#: Of this Python worker; what it has learned serves its later tasks.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class SumOfSquares:
    """Open windows by fill level; ``windows[level]`` lists those with that many tokens."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.windows: list[list] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, list]:
        """The level to put a piece of ``length`` < size on, and the window (a list of
        pieces) taken from it; an empty list is a new window.

        Moving a window from level h to h + length changes the sum of squares by
        2 * (count[h + length] - count[h] + 1), a new one by 2 * count[length] + 1 and
        filling one up by 1 - 2 * count[h]. Ties go to the fuller window.
        """
        top = self.size - length
        here = self.count[1 : top + 1]
        change = 2 * (self.count[1 + length :] - here + 1)
        change[-1] = 1 - 2 * here[-1]
        change = np.where(here > 0, change, np.iinfo(np.int64).max)
        best = top - 1 - int(np.argmin(change[::-1])) if top else 0
        if not top or change[best] >= 2 * self.count[length] + 1:
            return 0, []
        level = best + 1
        self.count[level] -= 1
        return level, self.windows[level].pop()

    def put(self, level: int, window: list) -> None:
        self.count[level] += 1
        self.windows[level].append(window)

    def drain(self) -> Iterator[list]:
        for level in range(self.size - 1, 0, -1):
            yield from self.windows[level]


class _Rows:
    """Rows of the result."""

    def __init__(self, first: int):
        self.sequence = first
        self.rows: list[tuple] = []

    def close(self, window: list) -> None:
        """One finished sequence out of ``(doc, start, ids, doc_tokens)`` pieces."""
        offset = 0
        for doc, start, ids, total in window:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc, start, len(ids), crc, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def leave(self, window: list) -> None:
        """The pieces of a window that is still open, with their ids and in no sequence."""
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), None, total, None, None, ids.tobytes()))

    def take(self, ids: bool = False) -> pa.RecordBatch:
        """The rows since the last call, with the ``ids`` of open windows if asked for."""
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = [[row[i] for row in self.rows] for i in range(len(names))]
        arrays = [pa.array(column, pa.int64()) for column in columns]
        if ids:
            names = [*names, "ids"]
            arrays.append(pa.array([row[7] if len(row) > 7 else None for row in self.rows], pa.binary()))
        self.rows = []
        return pa.record_batch(arrays, names=names)


def _relay(windows: Iterator[list], size: int) -> Iterator[list]:
    """The pieces of windows left open, laid end to end and cut anew: full windows, and
    at the end one sequence for each power of two in what is left."""
    pieces = [piece for window in windows for piece in window]
    left = sum(len(ids) for _, _, ids, _ in pieces)
    room, window = min(size, 1 << max(0, left.bit_length() - 1)), []
    for doc, start, ids, total in pieces:
        while len(ids):
            part = ids[:room]
            window.append((doc, start, part, total))
            ids, start = ids[room:], start + len(part)
            room, left = room - len(part), left - len(part)
            if not room:
                yield window
                room, window = min(size, 1 << max(0, left.bit_length() - 1)), []


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pack(
    documents: DataFrame, tokenizer: str, size: int = WINDOW, end_id: int = END_ID, tails: int = TAILS
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``.

    A document's tokens are its text's ids and ``end_id``; a null text has the last only.
    Whole windows are cut off long documents; the rest is placed by the sum-of-squares
    rule. What lies in windows still open when a task has read its rows is dealt to a
    second pass by the same rule, of one task per about ``tails`` such pieces; only what is
    open then is cut anew into full windows and powers of two, so nothing is padded. Sequence
    ids are unique: the pass, the task's number and a count. Rows are packed in the order they
    are read, in the second pass by a hash, id and place, so a task run again makes the same
    sequences. Repeated rows are packed each; a null ``doc_id`` stays null; no other column
    than ``doc_id`` and ``text`` is read; an empty table gives no rows. Needs ids below 2**16.

    Only the ids of open windows are shuffled. A task holds a slice of its texts and those ids.
    """
    spark = documents.sparkSession
    staging = Staging(spark, "packing")

    def place(bins: SumOfSquares, out: _Rows, piece: tuple) -> None:
        length = len(piece[2])
        level, window = bins.place(length)
        window.append(piece)
        if level + length == size:
            out.close(window)
        else:
            bins.put(level + length, window)

    def first(batches):
        words = tokenizer_at(tokenizer)
        bins = SumOfSquares(size)
        out = _Rows(TaskContext.get().partitionId() << TASK_BITS)
        end = np.array([end_id], "<u2")
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.concatenate((words.encode(text), end))
                total, at = len(ids), 0
                while total - at >= size:
                    out.close([(doc, at, ids[at : at + size], total)])
                    at += size
                if at < total:
                    place(bins, out, (doc, at, ids[at:].copy(), total))
            yield out.take(ids=True)
        for window in bins.drain():
            out.leave(window)
            if len(out.rows) >= 1024:
                yield out.take(ids=True)
        yield out.take(ids=True)

    def second(batches):
        bins = SumOfSquares(size)
        out = _Rows(SECOND | TaskContext.get().partitionId() << TASK_BITS)
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
            for doc, start, ids, total in zip(*columns, strict=True):
                place(bins, out, (doc, start, np.frombuffer(ids, "<u2"), total))
            yield out.take()
        for window in _relay(bins.drain(), size):
            out.close(window)
        yield out.take()

    rows = documents.selectExpr("cast(doc_id as long) as doc_id", "text")
    placed = staging.write(map_arrow(rows, first, PIECES + ", ids binary"), "placed")
    left = placed.where("ids is not null").select("doc_id", "start", "doc_tokens", "ids")
    tasks = max(1, -(-left.count() // tails))
    spread = F.xxhash64("doc_id", "start", "ids")
    left = left.withColumn("spread", spread).repartition(tasks, "spread")
    left = left.sortWithinPartitions("spread", "doc_id", "start", "doc_tokens").drop("spread")
    return placed.where("ids is null").drop("ids").union(map_arrow(left, second, PIECES))
