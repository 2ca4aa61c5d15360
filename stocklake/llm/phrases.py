"""Phrases that stick together, counted by weighted acyclic automata.

A shard's n-grams are read in their order into an acyclic automaton whose transitions are
words and carry the count of the n-gram that ends there. States that all n-grams below
have been read of are final, and one that equals an earlier state is replaced by it. The
shards' automata are cut at common prefixes, and those of one range are united, with their
weights added. What is left after dropping rare n-grams is small; phrases ask for the
counts of their parts by automata too, which are composed with the counts of the range
that the parts lie in.

The first symbol of every n-gram is its language, so one order holds all languages.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

#: What ends a piece, and what parts words. Capitals of A to Z are folded.
PIECE_ENDS = b".,;:!?\n\v\f\r"
FOLDED = bytes.maketrans(
    PIECE_ENDS + b"\t" + bytes(range(65, 91)), b"." * len(PIECE_ENDS) + b" " + bytes(range(97, 123))
)
UNKNOWN = "und"
#: The longest n-gram, with its language.
DEPTH = 4


@dataclass(frozen=True)
class Settings:
    """``min_count``: occurrences of a candidate. ``contained``: percent of a candidate's
    occurrences from which a longer candidate stands for it. ``top``: phrases returned of
    each language. ``shard_words``: words a task counts at a time. ``range_bytes``: text a
    prefix range stands for; a shard makes a row per range, so larger tables want larger
    ranges. ``sample``: about so many documents, 16 places of each, choose the borders of
    the ranges; they decide which task counts what, and nothing else. ``united_nodes``:
    n-grams a task unites at a time."""

    min_count: int = 10
    contained: int = 50
    top: int = 2000
    shard_words: int = 2_000_000
    range_bytes: int = 6 << 20
    sample: int = 2_000
    united_nodes: int = 4_000_000


# ---- automata ------------------------------------------------------------------------


class CountTransducer:
    """N-grams with counts, as the levels of a trie whose equal states are shared.

    ``symbols`` are sorted bytes; labels are their numbers. ``levels[d]`` has the states
    at depth d: ``start`` (where a state's transitions begin, with one more entry for the
    end), and per transition ``label``, ``weight`` (0 where no n-gram ends) and ``target``
    (a state of the next level, or -1). Level 0 has one state, the root.
    """

    def __init__(self, symbols: list[bytes], levels: list[dict[str, np.ndarray]]):
        self.symbols = symbols
        self.levels = levels

    @classmethod
    def build(cls, symbols: list[bytes], tree: list[dict[str, np.ndarray]]) -> CountTransducer:
        """Of sorted n-grams, given as nodes by depth (``parent, label, weight``), in the
        order of the n-grams. Symbols no node has are left out.

        The states are taken from the deepest level up, each in the order of the n-grams,
        so that whatever a state leads to has been replaced by its shared twin before.
        """
        used = np.unique(np.concatenate([level["label"] for level in tree]))
        symbols = [symbols[k] for k in used]
        tree = [{**level, "label": np.searchsorted(used, level["label"])} for level in tree]
        levels: list[dict[str, np.ndarray]] = []
        target = np.full(len(tree[-1]["label"]), -1, np.int64)
        for depth in range(len(tree) - 1, -1, -1):
            level = tree[depth]
            states = len(tree[depth - 1]["label"]) if depth else 1
            start = np.searchsorted(level["parent"], np.arange(states + 1))
            first, twin = _register(start, level["label"], level["weight"], target)
            degree = np.diff(start)
            take = _slices(start[:-1][first], degree[first])
            levels.append(
                {
                    "start": np.concatenate(([0], np.cumsum(degree[first]))),
                    "label": level["label"][take],
                    "weight": level["weight"][take],
                    "target": target[take],
                }
            )
            target = np.where(degree > 0, twin, -1)
        return cls(symbols, levels[::-1])

    def tree(self) -> list[dict[str, np.ndarray]]:
        """The nodes by depth again, in the order of the n-grams."""
        out, state = [], np.zeros(1, np.int64)
        owner = np.zeros(1, np.int64)
        for level in self.levels:
            degree = level["start"][state + 1] - level["start"][state]
            take = _slices(level["start"][state], degree)
            target = level["target"][take]
            out.append(
                {
                    "parent": np.repeat(owner, degree),
                    "label": level["label"][take],
                    "weight": level["weight"][take],
                }
            )
            owner = np.flatnonzero(target >= 0)
            state = target[owner]
        return out

    def rows(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """Every n-gram with its count, in order of depth."""
        paths: list[tuple[bytes, ...]] = [()]
        for level in self.tree():
            made = []
            for parent, label, weight in zip(*(level[k].tolist() for k in ("parent", "label", "weight")), strict=True):
                made.append((*paths[parent], self.symbols[label]))
                if weight:
                    yield made[-1], weight
            paths = made

    def pack(self) -> bytes:
        """As bytes, compressed; numbers as narrow as they can be."""
        arrays = [np.frombuffer(b"".join(self.symbols), np.uint8), np.array(list(map(len, self.symbols)), np.int64)]
        for level in self.levels:
            arrays += [np.diff(level["start"]), level["label"], level["weight"], level["target"] + 1]
        narrow = [a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8) for a in arrays]
        head = np.array([[a.dtype.itemsize, len(a)] for a in narrow], "<i8").ravel()
        raw = len(self.levels).to_bytes(8, "little") + head.tobytes() + b"".join(a.tobytes() for a in narrow)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def unpack(cls, packed: bytes) -> CountTransducer:
        size = int.from_bytes(packed[:8], "little")
        raw = pa.decompress(packed[8:], size, "zstd", asbytes=True)
        depth = int.from_bytes(raw[:8], "little")
        head = np.frombuffer(raw, "<i8", 2 * (2 + 4 * depth), 8).reshape(-1, 2).tolist()
        at, arrays = 8 + 16 * (2 + 4 * depth), []
        for width, count in head:
            arrays.append(np.frombuffer(raw, f"<u{width}", count, at))
            at += width * count
        ends = np.cumsum(arrays[1].astype(np.int64)).tolist()
        text = arrays[0].tobytes()
        symbols = [text[begin:end] for begin, end in zip([0, *ends], ends)]
        levels = []
        for k in range(depth):
            degree, label, weight, target = (a.astype(np.int64) for a in arrays[2 + 4 * k : 6 + 4 * k])
            start = np.concatenate(([0], np.cumsum(degree)))
            levels.append({"start": start, "label": label, "weight": weight, "target": target - 1})
        return cls(symbols, levels)


def _slices(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices of many slices, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def _register(start, label, weight, target) -> tuple[np.ndarray, np.ndarray]:
    """The states to keep, by the first of each kind, and the number of every state's kind.

    States are equal if they have the same transitions. Those with a single one, by far
    the most, are told apart in one go, the others by a table of their transitions.
    """
    degree = np.diff(start)
    first_of = np.arange(len(degree))
    single = np.flatnonzero(degree == 1)
    if len(single):
        at = start[single]
        kind = np.unique(weight[at], return_inverse=True)[1] << 32 | label[at]
        if (target[at] >= 0).any():
            kind = np.unique(kind, return_inverse=True)[1] << 32 | (target[at] + 1)
        _, leader, twin = np.unique(kind, return_index=True, return_inverse=True)
        first_of[single] = single[leader][twin]
    transitions = np.stack([label, weight, target], axis=1).astype(np.int64)
    raw, width = transitions.tobytes(), 3 * transitions.itemsize
    register: dict[bytes, int] = {}
    several = np.flatnonzero(degree > 1)
    for state, begin, end in zip(several.tolist(), start[several].tolist(), start[several + 1].tolist(), strict=True):
        first_of[state] = register.setdefault(raw[begin * width : end * width], state)
    empty = np.flatnonzero(degree == 0)
    if len(empty):
        first_of[empty] = empty[0]
    first, twin = np.unique(first_of, return_inverse=True)
    return first, twin


def _unique(parent: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``parent << 32 | label`` in order, and the place of each row in them."""
    return np.unique(parent << 32 | label, return_inverse=True)


def _level(keys: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    return {"parent": keys >> 32, "label": keys & 0xFFFFFFFF, "weight": weight}


def _grown(symbols: list[bytes], grams: list[tuple[list[np.ndarray], np.ndarray]]) -> CountTransducer:
    """The automaton of n-grams in any order, given as columns of labels and a weight
    each; the largest weight of equal ones counts."""
    tree, places = [], [np.zeros(len(weight), np.int64) for _, weight in grams]
    for d in range(max(len(columns) for columns, _ in grams)):
        parts = [
            (place, columns[d], weight if d == len(columns) - 1 else np.zeros_like(weight))
            if d < len(columns)
            else _NOTHING
            for place, (columns, weight) in zip(places, grams, strict=True)
        ]
        keys, total, places = _merged(parts, np.maximum)
        tree.append(_level(keys, total))
    return CountTransducer.build(symbols, tree)


_NOTHING = (np.zeros(0, np.int64),) * 3


def _merged(parts, by) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Nodes of one level from several sources: the distinct ones, their weights put
    together, and where each source's nodes have gone."""
    parent, label, weight = (np.concatenate(column) for column in zip(*parts, strict=True))
    keys, place = _unique(parent, label)
    total = np.zeros(len(keys), np.int64)
    by.at(total, place, weight)
    return keys, total, np.split(place, np.cumsum([len(part[0]) for part in parts])[:-1])


def unite(automata: list[CountTransducer]) -> CountTransducer:
    """The automaton of all n-grams, with the weights of equal ones added."""
    if len(automata) == 1:
        return automata[0]
    symbols = sorted(set().union(*(a.symbols for a in automata)))
    number = {symbol: k for k, symbol in enumerate(symbols)}
    trees = []
    for automaton in automata:
        own = np.array([number[s] for s in automaton.symbols], np.int64)
        trees.append([{**level, "label": own[level["label"]]} for level in automaton.tree()])
    out: list[dict[str, np.ndarray]] = []
    places = [np.zeros(1, np.int64) for _ in trees]
    for d in range(max(map(len, trees))):
        parts = [
            (place[tree[d]["parent"]], tree[d]["label"], tree[d]["weight"]) if d < len(tree) else _NOTHING
            for place, tree in zip(places, trees, strict=True)
        ]
        keys, total, places = _merged(parts, np.add)
        out.append(_level(keys, total))
    return CountTransducer.build(symbols, out)


def united(packed: Iterable[bytes], nodes: int) -> CountTransducer | None:
    """All automata of a stream as one, united whenever so many n-grams are held."""
    held: list[CountTransducer] = []
    size = 0
    for blob in packed:
        held.append(CountTransducer.unpack(blob))
        size += sum(len(level["label"]) for level in held[-1].tree())
        if size > nodes and len(held) > 1:
            held, size = [unite(held)], 0
    return unite(held) if held else None


def select(automaton: CountTransducer, least: int) -> CountTransducer:
    """The n-grams with at least this weight; what they begin with is no rarer, but may
    lie in another range, so it stays without a weight."""
    tree = automaton.tree()
    keep = [level["weight"] >= least for level in tree]
    need = [mask.copy() for mask in keep]
    for d in range(len(tree) - 1, 0, -1):
        need[d - 1][tree[d]["parent"][need[d]]] = True
    out, place = [], np.zeros(1, np.int64)
    for level, kept, needed in zip(tree, keep, need, strict=True):
        weight = np.where(kept, level["weight"], 0)[needed]
        out.append({"parent": place[level["parent"][needed]], "label": level["label"][needed], "weight": weight})
        place = np.cumsum(needed) - 1
    return CountTransducer.build(automaton.symbols, out)


def compose(asked: CountTransducer, counts: CountTransducer) -> tuple[CountTransducer, list[np.ndarray]]:
    """Both read the same n-grams. Returns those ``asked`` for with the weights of
    ``counts`` (0 for unknown ones), and by level the node of ``counts.tree()`` that every
    node of ``asked.tree()`` meets, or -1."""
    number = {symbol: k for k, symbol in enumerate(counts.symbols)}
    own = np.array([number.get(s, -1) for s in asked.symbols], np.int64)
    met, answer, meetings = np.zeros(1, np.int64), [], []
    theirs = counts.tree()
    for d, level in enumerate(asked.tree()):
        parent, label = met[level["parent"]], own[level["label"]]
        met = np.full(len(label), -1, np.int64)
        weight = np.zeros(len(label), np.int64)
        if d < len(theirs) and len(theirs[d]["label"]):
            keys = theirs[d]["parent"] << 32 | theirs[d]["label"]
            wanted = np.where((parent >= 0) & (label >= 0), parent << 32 | label, -1)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            met = np.where((keys[at] == wanted) & (wanted >= 0), at, -1)
            weight = np.where((met >= 0) & (level["weight"] > 0), theirs[d]["weight"][met], 0)
        answer.append({**level, "weight": weight})
        meetings.append(met)
    return CountTransducer.build(asked.symbols, answer), meetings


# ---- shards --------------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


class Shard:
    """N-grams of a few texts, counted over numbers of words."""

    def __init__(self):
        # Number 0 ends a piece.
        self.number = _Numbers({b".": 0})
        self.ids: dict[bytes, list[np.ndarray]] = {}
        self.words = 0

    def add(self, text: str, lang: str) -> None:
        tokens = cut(text)
        ids = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        self.ids.setdefault(lang.encode("utf-8", "replace"), []).append(ids)
        self.words += len(ids)

    def tree(self) -> tuple[list[bytes], list[dict[str, np.ndarray]]]:
        """The symbols and the nodes of all n-grams, in the order of the n-grams."""
        langs = sorted(self.ids)
        symbols = sorted({*langs, *self.number} - ({b"."} - set(langs)))
        place = {symbol: k for k, symbol in enumerate(symbols)}
        rank = np.array([place.get(word, -1) for word in self.number], np.int64)
        rank[0] = -1
        lengths = [sum(map(len, self.ids[lang])) for lang in langs]
        lang = np.repeat(np.arange(len(langs)), lengths)
        word = rank[np.concatenate([part for name in langs for part in self.ids[name]])]
        named = np.array([place[name] for name in langs], np.int64)
        tree = [_level(named, np.zeros(len(langs), np.int64))]
        at = np.flatnonzero(word >= 0)
        parent = lang[at]
        while len(tree) < DEPTH:
            # ``at`` is the last word of every n-gram of this length.
            keys, node = _unique(parent, word[at])
            tree.append(_level(keys, np.bincount(node, minlength=len(keys)).astype(np.int64)))
            # The word behind, if the piece goes on; each text's last number is an end.
            goes_on = word[at + 1] >= 0
            at, parent = at[goes_on] + 1, node[goes_on]
        return symbols, tree


def cut(text: str) -> list[bytes]:
    """The words of a text, with a full stop behind each piece."""
    folded = text.encode("utf-8", "replace").translate(FOLDED)
    return [*folded.replace(b".", b" . ").split(), b"."]


# ---- prefix ranges -------------------------------------------------------------------

Path = tuple[bytes, ...]


def _positions(symbols, tree, border: Path) -> list[int]:
    """By level the first node whose n-gram is not before ``border``; an n-gram comes
    before those that begin with it."""
    out, first, on_path = [], 0, True
    for d, level in enumerate(tree):
        if not on_path:
            first = int(np.searchsorted(level["parent"], first))
        else:
            label = bisect.bisect_left(symbols, border[d])
            begin, end = np.searchsorted(level["parent"], (first, first + 1)).tolist()
            first = begin + int(np.searchsorted(level["label"][begin:end], label))
            met = first < end and symbols[label] == border[d] and level["label"][first] == label
            on_path = met and d + 1 < len(border)
        out.append(first + on_path)
    return out


def split(symbols, tree, borders: list[Path]) -> Iterator[tuple[int, CountTransducer]]:
    """The n-grams by range, each as an automaton; range k ends before border k."""
    begin = [0] * len(tree)
    for k, border in enumerate([*borders, None]):
        end = _positions(symbols, tree, border) if border else [len(level["label"]) for level in tree]
        # No n-gram is a language alone.
        if begin[1:] != end[1:]:
            yield k, CountTransducer.build(symbols, _slice(tree, begin, end))
        begin = end


def _slice(tree, begin: list[int], end: list[int]) -> list[dict[str, np.ndarray]]:
    """The nodes from ``begin`` to ``end`` of each level and those above them, which have
    no weight if they lie outside."""
    bounds, above = [], None
    for level, low, high in zip(tree[::-1], begin[::-1], end[::-1], strict=True):
        if above is not None:
            low, high = (min(low, above[0]), max(high, above[1])) if low < high else above
        bounds.append((low, high))
        if low < high:
            above = int(level["parent"][low]), int(level["parent"][high - 1]) + 1
    out, offset = [], 0
    for level, (low, high), inside, outside in zip(tree, bounds[::-1], begin, end, strict=True):
        place = np.arange(low, high)
        out.append(
            {
                "parent": level["parent"][low:high] - offset,
                "label": level["label"][low:high],
                "weight": np.where((place >= inside) & (place < outside), level["weight"][low:high], 0),
            }
        )
        offset = low
    return out


def borders_of(documents: DataFrame, settings: Settings) -> list[Path]:
    """Borders of ranges of about equal size, from a sample of places in the texts."""
    size = documents.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    ranges = -(-(size[1] or 0) // settings.range_bytes)
    if ranges < 2:
        return []

    def places(batches):
        for batch in batches:
            paths = []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = cut(text)
                for at in range(0, len(words), max(1, -(-len(words) // 16))):
                    if b"." not in words[at : at + 3]:
                        paths.append([lang.encode("utf-8", "replace"), *words[at : at + 3]])
            yield pa.record_batch([pa.array(paths, pa.list_(pa.binary()))], names=["path"])

    some = documents.sample(min(1.0, settings.sample / size[0]), seed=0)
    paths = sorted({tuple(row.path) for row in map_arrow(some, places, "path array<binary>").collect()})
    chosen = {paths[k * len(paths) // ranges] for k in range(1, ranges)} if paths else set()
    return sorted(tuple(map(bytes, path)) for path in chosen)


# ---- the jobs ------------------------------------------------------------------------


def _texts(documents: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return documents.select(lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def shards(texts: DataFrame, borders: list[Path], settings: Settings) -> DataFrame:
    """``range, automaton``: the n-grams of the tasks' shards, cut at the borders."""

    def run(batches):
        shard = Shard()
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                shard.add(text, lang)
                if shard.words >= settings.shard_words:
                    yield from _rows(split(*shard.tree(), borders))
                    shard = Shard()
        if shard.words:
            yield from _rows(split(*shard.tree(), borders))

    def _rows(parts):
        for k, automaton in parts:
            yield pa.record_batch(
                [pa.array([k], pa.int32()), pa.array([automaton.pack()], pa.binary())],
                names=["range", "automaton"],
            )

    return map_arrow(texts, run, "range int, automaton binary")


def _by_range(rows: DataFrame, n_ranges: int, *order: str) -> DataFrame:
    """All rows of a range one after the other in one task."""
    return rows.repartition(n_ranges, "range").sortWithinPartitions("range", *order)


def _groups(batches) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows by range, as they come."""
    rows = (row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist())
    return groupby(rows, key=lambda row: row["range"])


def count_ngrams(shard_rows: DataFrame, n_ranges: int, settings: Settings) -> DataFrame:
    """The united automata. Rows have ``range, automaton`` (n-grams of at least
    ``min_count``) or ``range, lang, words`` (words of a language in the range)."""

    def run(batches):
        for k, rows in _groups(batches):
            whole = united((row["automaton"] for row in rows), settings.united_nodes)
            tree = whole.tree()
            langs = [whole.symbols[label] for label in tree[0]["label"].tolist()]
            words = np.zeros(len(langs), np.int64)
            np.add.at(words, tree[1]["parent"], tree[1]["weight"])
            frequent = select(whole, settings.min_count)
            yield pa.record_batch(
                [
                    pa.array([k] * (len(langs) + 1), pa.int32()),
                    pa.array([None, *(lang.decode() for lang in langs)], pa.string()),
                    pa.array([None, *words.tolist()], pa.int64()),
                    pa.array([frequent.pack(), *[None] * len(langs)], pa.binary()),
                ],
                names=["range", "lang", "words", "automaton"],
            )

    schema = "range int, lang string, words long, automaton binary"
    return map_arrow(_by_range(shard_rows, n_ranges), run, schema)


def _columns(tree, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The labels of the n-grams with a weight at one level, a column per place."""
    at = np.flatnonzero(tree[depth]["weight"] > 0)
    weight, columns = tree[depth]["weight"][at], []
    for d in range(depth, -1, -1):
        columns.append(tree[d]["label"][at])
        at = tree[d]["parent"][at]
    return columns[::-1], weight


def parts_asked(automaton: CountTransducer) -> CountTransducer:
    """The parts of all candidates; the weight is 1 and, of a part that is a candidate
    itself, the count of the most frequent candidate around it."""
    tree = automaton.tree()
    (lang2, a2, b2), n2 = _columns(tree, 2)
    (lang3, a3, b3, c3), n3 = _columns(tree, 3)
    one2, one3 = np.ones_like(n2), np.ones_like(n3)
    grams = [([lang2, a2], one2), ([lang2, b2], one2), ([lang3, a3], one3), ([lang3, c3], one3)]
    grams += [([lang3, a3, b3], n3 + 1), ([lang3, b3, c3], n3 + 1)]
    return _grown(automaton.symbols, grams)


def requests(counted: DataFrame, borders: list[Path]) -> DataFrame:
    """``range, origin, automaton``: the parts that a range's candidates ask of another."""

    def run(batches):
        for origin, rows in _groups(batches):
            for row in rows:
                asked = parts_asked(CountTransducer.unpack(row["automaton"]))
                for k, automaton in split(asked.symbols, asked.tree(), borders):
                    yield pa.record_batch(
                        [pa.array([k], pa.int32()), pa.array([origin], pa.int32()), pa.array([automaton.pack()])],
                        names=["range", "origin", "automaton"],
                    )

    return map_arrow(counted.select("range", "automaton"), run, "range int, origin int, automaton binary")


def answers(counted: DataFrame, asked: DataFrame, n_ranges: int, settings: Settings) -> DataFrame:
    """Rows for the ranges that asked: ``range, kept, automaton``. One of a range's rows
    (``kept``) has its own candidates that no longer one stands for, the others the
    counts of their parts."""
    own = counted.select("range", F.lit(None).cast("int").alias("origin"), "automaton")
    rows = _by_range(own.unionByName(asked), n_ranges, "origin")

    def run(batches):
        for k, group in _groups(batches):
            # The range's own counts come first.
            counts = CountTransducer.unpack(next(group)["automaton"])
            tree = counts.tree()
            longer = [np.zeros(len(level["label"]), np.int64) for level in tree]
            for row in group:
                question = CountTransducer.unpack(row["automaton"])
                answer, meetings = compose(question, counts)
                for best, met, level in zip(longer, meetings, question.tree(), strict=False):
                    known = met >= 0
                    np.maximum.at(best, met[known], level["weight"][known] - 1)
                yield _answer(row["origin"], False, answer)
            for depth, (level, best) in enumerate(zip(tree, longer, strict=True)):
                dropped = (best > 0) & _reaches(best, level["weight"], settings.contained)
                level["weight"] = np.where(dropped | (depth < 2), 0, level["weight"])
            yield _answer(k, True, CountTransducer.build(counts.symbols, tree))

    def _answer(k, kept, automaton):
        return pa.record_batch(
            [pa.array([k], pa.int32()), pa.array([kept]), pa.array([automaton.pack()])],
            names=["range", "kept", "automaton"],
        )

    return map_arrow(rows, run, "range int, kept boolean, automaton binary")


def _reaches(part: np.ndarray, whole: np.ndarray, percent: int) -> np.ndarray:
    """``100 * part >= percent * whole`` without overflow."""
    pairs = zip(part.tolist(), whole.tolist(), strict=True)
    return np.fromiter((100 * p >= percent * w for p, w in pairs), bool, len(part))


def scored(answered: DataFrame, n_ranges: int, settings: Settings) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that stay."""

    def run(batches):
        for _, group in _groups(batches):
            kept = CountTransducer.unpack(next(group)["automaton"])
            counts = united((row["automaton"] for row in group), settings.united_nodes)
            known = dict(counts.rows()) if counts is not None else {}
            rows = [_score(path, a, known) for path, a in kept.rows() if len(path) > 2]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)],
                names=["lang", "phrase", "a", "l", "r", "score"],
            )

    order = _by_range(answered.withColumn("later", ~F.col("kept")), n_ranges, "later")
    schema = "lang string, phrase string, a long, l long, r long, score long"
    return map_arrow(order.drop("later"), run, schema)


def _score(path: Path, a: int, known: dict[Path, int]) -> tuple:
    """The lowest score of all cuts of a phrase, with its parts' counts."""
    lang, *words = path
    cuts = []
    for k in range(1, len(words)):
        left, right = known[lang, *words[:k]], known[lang, *words[k:]]
        cuts.append((1_000_000 * a * a // (left * right), k, left, right))
    score, _, left, right = min(cuts)
    return lang.decode(), b" ".join(words).decode(), a, left, right, score


def phrases(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The phrases of each language that stick together most: ``lang, rank, phrase, a, l,
    r, n, score``.

    A null text is empty, a null ``lang`` is "und" (and so is that value itself);
    languages without phrases give no rows, so does an empty table. Repeated rows count
    each time. Equal scores go by count, then by phrase, so no two phrases tie. Only
    ``text`` and ``lang`` are read.

    Two scans of the texts (sizes, then counts). Shuffled are the shards' automata, a row
    per shard and range, then those of frequent n-grams. A range is one task; it holds
    the distinct n-grams of its range, and a language or a word of any frequency is
    spread over as many ranges as it needs.
    """
    staging = Staging(documents.sparkSession, "phrases")
    texts = _texts(documents)
    borders = borders_of(texts, settings)
    n_ranges = len(borders) + 1
    counted = staging.write(count_ngrams(shards(texts, borders, settings), n_ranges, settings), "counted")
    automata = counted.where("automaton is not null").select("range", "automaton")
    answered = answers(automata, requests(automata, borders), n_ranges, settings)
    found = staging.write(scored(answered, n_ranges, settings), "scored")
    sizes = counted.where("lang is not null").groupBy("lang").agg(F.sum("words").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= settings.top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
