"""Byte-pair encoding by walking a trie of distinct words, and decoding.

Every prefix of a word has an encoding, and all that matters of it is its last token: the
tokens before it are the encoding of a shorter prefix. So a trie node holds its prefix's
last token and the node before that token; a word is encoded by following these nodes back
to the root. The states go down the trie depth first, and a prefix that many words share
is worked out once.

A node's last token is the one token that ends the prefix and stays apart from the last
token of what is left, which ``Merges.apart`` tells from the merges alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocklake.llm.common import map_arrow, with_fields
from stocklake.llm.packing import _byte_signs

#: A trie or a cache that outgrows these is given up and begun anew; results do not change.
NODES = 1_000_000
WORDS_CACHED = 300_000
#: Longer words are walked on a path of their own, so that they leave no nodes behind.
LONG_WORD = 256


class Merges:
    """A byte-level vocabulary: tokens as bytes, merges by rank, special tokens.

    Each token must come from one merge of earlier ones, as in every trained vocabulary,
    and special tokens must be plain strings; else ``ValueError``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = {sign: byte for byte, sign in _byte_signs().items()}
        model = content["model"]
        vocabulary = model["vocab"]
        raw = {token: bytes(map(byte_of.__getitem__, signs)) for signs, token in vocabulary.items()}
        self.rank = {token: -1 for token, own in raw.items() if len(own) == 1}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, token = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            if token in self.rank or not all(part in self.rank for part in pair):
                raise ValueError(f"merge {rank} makes a token twice or of later tokens")
            self.rank[token], self.parts[token] = rank, pair
            self.merged[pair] = rank
        self.special: dict[str, int] = {}
        for added in content["added_tokens"]:
            if any(added[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"special token {added['content']!r} is not a plain string")
            self.special[added["content"]] = added["id"]
        self.bytes = {**raw, **{token: text.encode() for text, token in self.special.items()}}
        sound: set[int] = set()
        for token in sorted(self.rank, key=self.rank.__getitem__):
            pair = self.parts.get(token)
            if pair is None or (sound.issuperset(pair) and self.apart(*pair, merging=True)):
                sound.add(token)
        #: Tokens that their own bytes are encoded as, and the lengths they have.
        self.tokens = {raw[token]: token for token in sound}
        self.lengths = sorted({len(own) for own in self.tokens})

    def apart(self, left: int, right: int, merging: bool = False) -> bool:
        """Whether two neighbouring tokens are left as they are by all merges.

        Merges inside either token are undone from the last to the first. Between two of
        them the bytes at the border belong to one token on each side; these merge if
        their rank comes before the merges that would take one of them away. Of equal
        ranks the left one goes first. With ``merging``, the merge of the two tokens
        themselves does not count.
        """
        rank, merged = self.rank, self.merged
        left_until = right_until = len(merged) + 1
        while True:
            across = merged.get((left, right))
            if across is not None and not merging and across < left_until and across <= right_until:
                return False
            merging = False
            if rank[left] > rank[right]:
                left_until, left = rank[left], self.parts[left][1]
            elif rank[right] >= 0:
                right_until, right = rank[right], self.parts[right][0]
            else:
                return True


class PrefixTrie:
    """Distinct words with the last-token state of each of their prefixes.

    Node 0 is the empty prefix. ``last`` and ``before`` hold a node's last token and the
    node in front of it.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        #: Whether pairs of tokens stay apart, by both ids in one number.
        self.stays: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.last, self.before = [-1], [0]
        if len(self.stays) > NODES:
            self.stays.clear()

    def _state(self, word: bytes, end: int, path: list[int], last: list[int]) -> tuple[int, int]:
        """The last token of ``word[:end]`` and the node before it; ``path[i]`` is the
        node of ``word[:i]``. Just one token fits, so the short ones, which mostly do,
        are tried first."""
        tokens, stays = self.merges.tokens, self.stays
        for length in self.merges.lengths:
            if length > end:
                break
            token = tokens.get(word[end - length : end])
            if token is None:
                continue
            if length == end:
                return token, 0
            node = path[end - length]
            pair = last[node] << 32 | token
            apart = stays.get(pair)
            if apart is None:
                apart = stays[pair] = self.merges.apart(last[node], token)
            if apart:
                return token, node
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """The ids of each word; sorted, so that the walk goes depth first and goes on
        from the prefix it shares with the word before."""
        path, previous = [0], b""
        children, state = self.children, self._state
        for word in sorted(words):
            if len(word) > LONG_WORD:
                yield word, self._walk(word)
                continue
            if len(self.last) > NODES:
                self.clear()
                children, path, previous = self.children, [0], b""
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del path[shared + 1 :]
            last, before, node = self.last, self.before, path[-1]
            for end in range(shared + 1, len(word) + 1):
                key = node << 8 | word[end - 1]
                node = children.get(key)
                if node is None:
                    token, front = state(word, end, path, last)
                    node = children[key] = len(last)
                    last.append(token)
                    before.append(front)
                path.append(node)
            previous = word
            yield word, self._back(node, last, before)

    def _walk(self, word: bytes) -> tuple[int, ...]:
        """The same along the one path of a long word, whose nodes are its positions."""
        path, last, before = range(len(word) + 1), [-1], [0]
        for end in path[1:]:
            token, node = self._state(word, end, path, last)
            last.append(token)
            before.append(node)
        return self._back(len(word), last, before)

    @staticmethod
    def _back(node: int, last: list[int], before: list[int]) -> tuple[int, ...]:
        ids = []
        while node:
            ids.append(last[node])
            node = before[node]
        return tuple(ids[::-1])


def word_pattern(path: str) -> str:
    """The pattern that cuts texts into words as the vocabulary's own rule does.

    What counts as a letter, a digit or neither is asked of that rule for every code
    point, so no table of this Python's has to agree with it. Words never hold blanks
    but the one before them.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    kinds = np.zeros(sys.maxunicode + 1, np.int8)
    kinds[0xD800:0xE000] = 3
    # Neighbours of one kind make one piece, and so does a point with a lead of its kind.
    # The first points are looked up one by one, as the rule names some of them.
    pieces = [(point, point + 1) for point in range(128)]
    for start, stop in ((128, 0xD800), (0xE000, sys.maxunicode + 1)):
        run = "".join(map(chr, range(start, stop)))
        pieces += [(start + begin, start + end) for _, (begin, end) in cut(run)]
    for begin, end in pieces:
        for kind, lead in enumerate("a0!", start=1):
            if len(cut(lead + chr(begin))) == 1:
                kinds[begin:end] = kind
    letters, digits, others, blanks = (_ranges(np.flatnonzero(kinds == k)) for k in (1, 2, 3, 0))
    # The endings that are words of their own, and the order of the kinds.
    endings = "'s|'t|'re|'ve|'m|'ll|'d"
    return f"{endings}| ?[{letters}]+| ?[{digits}]+| ?[{others}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+"


def _ranges(points: np.ndarray) -> str:
    """Sorted code points as the inside of a character class."""
    runs = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs if len(run))


def _small(pattern: str) -> str:
    """The pattern without ranges beyond the first plane, which make it slow."""
    return re.sub(r"\\U000[1-9a-f][0-9a-f]{4}-\\U00\w{6}|\\U0010\w{4}-\\U00\w{6}", "", pattern)


class BytePairCodec:
    """Encodes texts and decodes ids with one vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(path)
        self.trie = PrefixTrie(self.merges)
        self.ids: dict[str, tuple[int, ...]] = {}
        self.beyond = re.compile("[\U00010000-\U0010ffff]")
        self.words_small, self.words = re.compile(_small(pattern)), re.compile(pattern)
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _cut(self, text: str) -> list[str]:
        return (self.words if self.beyond.search(text) else self.words_small).findall(text)

    def _pieces(self, text: str) -> list[tuple[list[str], str | None]]:
        """The words of each stretch of text and the special token behind it."""
        if self.special is None:
            return [(self._cut(text), None)]
        out, at = [], 0
        for found in self.special.finditer(text):
            out.append((self._cut(text[at : found.start()]), found[0]))
            at = found.end()
        return [*out, (self._cut(text[at:]), None)]

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text. The distinct words of all of them go through the trie
        together first."""
        cut = [self._pieces(text) for text in texts]
        if len(self.ids) > WORDS_CACHED:
            self.ids.clear()
        known = self.ids
        new = {word for pieces in cut for words, _ in pieces for word in words if word not in known}
        for word, ids in self.trie.encode(word.encode() for word in new):
            known[word.decode()] = ids
        for pieces in cut:
            ids: list[int] = []
            for words, special in pieces:
                ids += chain.from_iterable(map(known.__getitem__, words))
                if special is not None:
                    ids.append(self.merges.special[special])
            yield ids

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens included. Unknown ids are passed over and
        broken characters replaced."""
        known = self.merges.bytes
        return b"".join([known.get(i, b"") for i in ids]).decode("utf-8", "replace")


#: Of this Python worker; what it has learned serves its later tasks.
_CODECS: dict[tuple[str, str], BytePairCodec] = {}


def codec_at(path: str, pattern: str) -> BytePairCodec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = BytePairCodec(path, pattern)
    return _CODECS[path, pattern]


def encode(documents: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``documents`` and ``ids``, an array of the ids of ``text``.

    A null text is empty and has no ids. Rows are independent: repeated ones are encoded
    each, an empty table gives none, other columns are not read. ``vocabulary`` is a file
    that all machines have. No shuffle. A task holds the texts of 64 rows and caches of
    bounded size; a word is linear in its length.
    """
    pattern = word_pattern(vocabulary)

    def run(batches):
        codec = codec_at(vocabulary, pattern)
        for batch in batches:
            ids = list(codec.encode_all([text or "" for text in batch["text"].to_pylist()]))
            columns = [batch[name] for name in keep]
            yield pa.record_batch([*columns, pa.array(ids, pa.list_(pa.int32()))], names=[*keep, "ids"])

    rows = documents.select(*keep, *([] if "text" in keep else ["text"]))
    return map_arrow(rows, run, with_fields(rows, keep, "ids array<int>"), rows=64)


def decode(encoded: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``text``, what ``ids`` stand for; null ids give a null text."""

    def run(batches):
        codec = codec_at(vocabulary, pattern)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch["ids"].to_pylist()]
            columns = [batch[name] for name in keep]
            yield pa.record_batch([*columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    pattern = word_pattern(vocabulary)
    rows = encoded.select(*keep, *([] if "ids" in keep else ["ids"]))
    return map_arrow(rows, run, with_fields(rows, keep, "text string"), rows=64)


def round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, as ``encode`` and
    the decoding of its ids give them, in one pass so that no ids leave the task.

    Null texts are empty; repeated rows and null ids of documents stay; an empty table
    gives no rows.
    """
    pattern = word_pattern(vocabulary)

    def run(batches):
        codec = codec_at(vocabulary, pattern)
        for batch in batches:
            rows: list[tuple] = []
            for ids in codec.encode_all([text or "" for text in batch["text"].to_pylist()]):
                listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                decoded = hashlib.sha256(codec.decode(ids).encode()).hexdigest()
                rows.append((len(ids), listed, decoded))
            counts, listed, decoded = zip(*rows, strict=True)
            yield pa.record_batch(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(listed), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select("doc_id", "text")
    schema = with_fields(rows, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return map_arrow(rows, run, schema, rows=64)
