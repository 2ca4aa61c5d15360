"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own hashed embedding beside the mean of those of its character
n-grams. The network reads windows of words from both ends, attention pools the
states, and a document scores as its highest window. Windows overlap by half and cover
the whole text. A run of letters longer than a word, as of a script without spaces,
is read as overlapping pieces, so that none of its n-grams is missed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, held_out, map_arrow, packed, with_fields

TOKEN = re.compile(r"[^\W_]+")
GRAMS = (3, 4, 5)
#: Longest word, length of the pieces a longer one is read as, and of their overlap: an
#: n-gram that one piece cuts lies in the next.
LONGEST, PIECE, OVERLAP = 40, 12, max(GRAMS) - 1
#: Weight of a standard error of evidence in an embedding.
EVIDENCE = 0.3


@dataclass(frozen=True)
class Settings:
    """``sample``: at most about so many labelled rows of each label are learned from,
    chosen by a hash of the id among documents with text; of a longer text than
    ``sample_chars``, ``passages`` spread evenly over it that are so long together.
    ``min_texts``: sampled texts that must hold a word or n-gram for it to count.
    ``hidden``: units of each direction."""

    sample: int = 1500
    sample_chars: int = 20_000
    passages: int = 10
    min_texts: int = 4
    window: int = 32
    word_rows: int = 1 << 14
    gram_rows: int = 1 << 15
    word_dim: int = 8
    gram_dim: int = 16
    hidden: int = 8
    attention: int = 8
    steps: int = 300
    batch: int = 256
    rate: float = 4e-3
    seed: int = 7


def tokens(text: str | None) -> list[str]:
    """The words of a text, long ones in pieces."""
    words = TOKEN.findall(text.lower()) if text else []
    if not any(len(word) > LONGEST for word in words):
        return words
    return [piece for word in words for piece in _pieces(word)]


def _pieces(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[at : at + PIECE] for at in range(0, len(word) - OVERLAP, PIECE - OVERLAP)]


def gram_ids(words: list[str], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character n-grams of each word with marked ends, one word after the
    other, and how many each word has."""
    marked = [f"<{word}>" for word in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(word) for word in marked])
    found, owners = [], []
    for n in GRAMS:
        keep = len(points) - n + 1
        if keep <= 0:
            continue
        whole = owner[:keep] == owner[n - 1 :]
        rolled = np.full(keep, n, np.uint64)
        for i in range(n):
            rolled = rolled * np.uint64(0x100000001B3) + points[i : i + keep]
        rolled = (rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        found.append((rolled[whole] % np.uint64(rows)).astype(np.int32))
        owners.append(owner[:keep][whole])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(words))


def word_id(word: str, rows: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % rows


def window_starts(words: int, size: int) -> list[int]:
    """Starts of windows that overlap by half and reach the end: a passage of half a window
    lies whole in one."""
    if words <= size:
        return [0] if words else []
    starts = list(range(0, words - size + 1, max(1, size // 2)))
    if starts[-1] + size < words:
        starts.append(words - size)
    return starts


class Network:
    """Parameters, and the forward pass over windows of input rows."""

    def __init__(self, settings: Settings):
        self.settings = s = settings
        rng = np.random.default_rng(s.seed)
        inputs, h = s.word_dim + s.gram_dim, s.hidden
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "word": normal(s.word_rows, s.word_dim, scale=0.1),
            "gram": normal(s.gram_rows, s.gram_dim, scale=0.3),
            # Columns: update gate, reset gate and candidate, of one direction and the other.
            "wx": normal(inputs, 6 * h, scale=1 / math.sqrt(inputs)),
            "bx": np.zeros(6 * h, np.float32),
            "uf": normal(h, 3 * h, scale=1 / math.sqrt(h)),
            "ub": normal(h, 3 * h, scale=1 / math.sqrt(h)),
            "wa": normal(2 * h, s.attention, scale=1 / math.sqrt(2 * h)),
            "ba": np.zeros(s.attention, np.float32),
            "va": normal(s.attention, scale=0.3),
            "wo": normal(2 * h, scale=1 / math.sqrt(2 * h)),
            "bo": np.zeros(1, np.float32),
        }
        self.scale, self.shift, self.empty = 1.0, 0.0, 0.0

    def inputs(self, word_ids: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input rows of words: own embedding and mean of the n-grams'."""
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        mean = np.add.reduceat(self.p["gram"][grams], starts) / sizes[:, None]
        return np.concatenate((self.p["word"][word_ids], mean.astype(np.float32)), axis=1)

    def read(self, projected: np.ndarray, at: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None):
        """One direction: states (steps x windows x hidden) of rows ``at`` of projections."""
        h = np.zeros((at.shape[1], u.shape[0]), np.float32)
        n = u.shape[0]
        states = np.empty((at.shape[0], at.shape[1], n), np.float32)
        gates_u, cand_u = np.ascontiguousarray(u[:, : 2 * n]), np.ascontiguousarray(u[:, 2 * n :])
        for t in range(at.shape[0]):
            x = projected[at[t]]
            gates = x[:, : 2 * n] + h @ gates_u
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :n], gates[:, n:]
            cand = np.tanh(x[:, 2 * n :] + (r * h) @ cand_u)
            step = z * (cand - h)
            step *= mask[t][:, None]
            if keep is not None:
                keep.append((h, z, r, cand))
            h = h + step
            states[t] = h
        return states

    def split(self, projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Projections of the two directions, each with update, reset and candidate."""
        half = projected.shape[1] // 2
        return np.ascontiguousarray(projected[:, :half]), np.ascontiguousarray(projected[:, half:])

    def pool(self, states: np.ndarray, mask: np.ndarray):
        """Attention over time: hidden layer, weights, pooled states and logits."""
        p = self.p
        layer = np.tanh(states @ p["wa"] + p["ba"])
        score = layer @ p["va"]
        score = np.where(mask > 0, score, -1e9)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return layer, weight, pooled, pooled @ p["wo"] + p["bo"][0]

    def logits(self, forward: np.ndarray, backward: np.ndarray, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of windows whose words are rows ``at`` (steps x windows) of the projections."""
        ahead = self.read(forward, at, mask, self.p["uf"], None)
        back = self.read(backward, at[::-1], mask[::-1], self.p["ub"], None)[::-1]
        return self.pool(np.concatenate((ahead, back), axis=2), mask)[3]

    def probability(self, logit: float) -> float:
        value = max(-60.0, min(60.0, self.scale * logit + self.shift))
        return 1.0 / (1.0 + math.exp(-value))


class Words:
    """Rows of projected inputs by word; forgotten when there are too many."""

    LIMIT = 200_000

    def __init__(self, network: Network):
        self.network = network
        self.rows: dict[str, int] = {}
        self.forward, self.backward = self._room(1 << 12)

    def _room(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        width = 3 * self.network.settings.hidden
        return np.empty((rows, width), np.float32), np.empty((rows, width), np.float32)

    def take(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.rows) > self.LIMIT:
            self.rows = {}
        new = list(set().union(*texts).difference(self.rows))
        if new:
            settings = self.network.settings
            grams, sizes = gram_ids(new, settings.gram_rows)
            ids = np.array([word_id(word, settings.word_rows) for word in new])
            rows = self.network.inputs(ids, grams, sizes)
            made = self.network.split(rows @ self.network.p["wx"] + self.network.p["bx"])
            start, end = len(self.rows), len(self.rows) + len(new)
            if end > len(self.forward):
                old = self.forward, self.backward
                self.forward, self.backward = self._room(2 * end)
                self.forward[:start], self.backward[:start] = old[0][:start], old[1][:start]
            self.forward[start:end], self.backward[start:end] = made
            self.rows.update(zip(new, range(start, end), strict=True))
        get = self.rows.__getitem__
        return [np.fromiter(map(get, words), np.int32, len(words)) for words in texts]


def _windows(documents: list[np.ndarray], size: int):
    """Windows of all documents (steps x windows), their masks and documents."""
    parts, owner = [], []
    for i, words in enumerate(documents):
        starts = window_starts(len(words), size)
        if not starts:
            continue
        if len(words) < size:
            row = np.full((1, size), -1, np.int32)
            row[0, : len(words)] = words
            parts.append(row)
        else:
            parts.append(words[np.array(starts)[:, None] + np.arange(size)])
        owner.extend([i] * len(starts))
    if not parts:
        return np.zeros((size, 0), np.int32), np.zeros((size, 0), np.float32), np.zeros(0, np.int64)
    at = np.concatenate(parts).T
    return np.maximum(at, 0), (at >= 0).astype(np.float32), np.array(owner)


def score_texts(network: Network, words: Words, texts: list[str | None]) -> list[float]:
    """Probability of each text; all windows of a text count, wherever batches are cut."""
    size = network.settings.window
    found = words.take([tokens(text) for text in texts])
    at, mask, owner = _windows(found, size)
    best = np.full(len(texts), -np.inf)
    for start in range(0, at.shape[1], 2048):
        part = slice(start, start + 2048)
        logits = network.logits(words.forward, words.backward, at[:, part], mask[:, part])
        np.maximum.at(best, owner[part], logits.astype(np.float64))
    return [network.probability(x) if np.isfinite(x) else network.empty for x in best]


# ---- training ------------------------------------------------------------------------


class _Trainer:
    """Backpropagation through time and Adam, over a fixed vocabulary of words."""

    def __init__(self, network: Network, vocabulary: list[str]):
        self.network, s = network, network.settings
        self.grams, self.sizes = gram_ids(vocabulary, s.gram_rows)
        self.word_ids = np.array([word_id(word, s.word_rows) for word in vocabulary])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.mean = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.square = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.silent: dict[str, np.ndarray] = {}
        self.steps = 0
        self.rng = np.random.default_rng(s.seed)

    def _grams_of(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[used]
        first = np.repeat(self.starts[used] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return self.grams[first + np.arange(sizes.sum())], sizes

    def prime(self, documents: list[np.ndarray], labels: np.ndarray) -> None:
        """Start the first coordinate of each embedding at the evidence for its row: the
        log odds of occurring in toxic and in other texts, in standard errors. Rows that
        few texts hold, or none, stay at zero: they would only help to know the texts by
        heart, and a new text has many of them."""
        toxic = labels == 1
        for key, rows_of in (("word", lambda used: self.word_ids[used]), ("gram", lambda used: self._grams_of(used)[0])):
            table = self.network.p[key]
            held = np.zeros((2, len(table)))
            for words, label in zip(documents, toxic, strict=True):
                if len(words):
                    held[int(label), np.unique(rows_of(np.unique(words)))] += 1
            yes, no = held[1] + 0.5, held[0] + 0.5
            odds = np.log(yes / (toxic.sum() + 1)) - np.log(no / ((~toxic).sum() + 1))
            table[:, 0] = EVIDENCE * odds / np.sqrt(1 / yes + 1 / no)
            self.silent[key] = held.sum(axis=0) < self.network.settings.min_texts
            table[self.silent[key]] = 0

    def project(self, used: np.ndarray):
        grams, sizes = self._grams_of(used)
        rows = self.network.inputs(self.word_ids[used], grams, sizes)
        return rows, grams, sizes

    def logits(self, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
        used, inverse = np.unique(at, return_inverse=True)
        rows, _, _ = self.project(used)
        net = self.network
        ahead, back = net.split(rows @ net.p["wx"] + net.p["bx"])
        return net.logits(ahead, back, inverse.reshape(at.shape), mask)

    def _back(self, kept, grad_states, mask, at, u, rows):
        """Gradients of one direction: of the projected rows and of the recurrent matrix."""
        n = u.shape[0]
        du, dproj = np.zeros_like(u), np.zeros((rows, 3 * n), np.float32)
        dh = np.zeros_like(grad_states[0])
        steps = []
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, cand = kept[t]
            dh = dh + grad_states[t]
            dstep = dh * mask[t][:, None]
            dz = dstep * (cand - h) * z * (1 - z)
            dcand = dstep * z * (1 - cand * cand)
            dh = dh - dstep * z
            drh = dcand @ u[:, 2 * n :].T
            dr = drh * h * r * (1 - r)
            gates = np.concatenate((dz, dr), axis=1)
            du[:, : 2 * n] += h.T @ gates
            du[:, 2 * n :] += (r * h).T @ dcand
            dh = dh + drh * r + gates @ u[:, : 2 * n].T
            steps.append(np.concatenate((gates, dcand), axis=1))
        flat = np.concatenate(steps[::-1])
        where = at.ravel()
        for k in range(3 * n):
            dproj[:, k] = np.bincount(where, weights=flat[:, k], minlength=rows)
        return dproj, du

    def step(self, at: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        net, p, s = self.network, self.network.p, self.network.settings
        used, inverse = np.unique(at, return_inverse=True)
        inverse = inverse.reshape(at.shape)
        rows, grams, sizes = self.project(used)
        # Whole word embeddings are left out at times, so that characters must do.
        drop = (self.rng.random(len(used)) < 0.5).astype(np.float32)[:, None]
        rows[:, : s.word_dim] *= drop
        ahead, back = net.split(rows @ p["wx"] + p["bx"])
        keep_f, keep_b = [], []
        states_f = net.read(ahead, inverse, mask, p["uf"], keep_f)
        states_b = net.read(back, inverse[::-1], mask[::-1], p["ub"], keep_b)[::-1]
        states = np.concatenate((states_f, states_b), axis=2)
        layer, attention, pooled, logit = net.pool(states, mask)
        error = ((1 / (1 + np.exp(-logit)) - label) * weight / len(label)).astype(np.float32)
        grads = {"wo": pooled.T @ error, "bo": np.array([error.sum()], np.float32)}
        dpooled = error[:, None] * p["wo"]
        dstates = attention[:, :, None] * dpooled
        dweight = np.einsum("bh,tbh->tb", dpooled, states)
        dscore = attention * (dweight - (attention * dweight).sum(axis=0))
        dlayer = dscore[:, :, None] * p["va"] * (1 - layer * layer)
        grads["va"] = np.einsum("tb,tba->a", dscore, layer)
        grads["wa"] = np.einsum("tbh,tba->ha", states, dlayer)
        grads["ba"] = dlayer.sum(axis=(0, 1))
        dstates = dstates + dlayer @ p["wa"].T
        h = s.hidden
        proj_f, grads["uf"] = self._back(keep_f, dstates[:, :, :h], mask, inverse, p["uf"], len(used))
        proj_b, grads["ub"] = self._back(keep_b, dstates[::-1, :, h:], mask[::-1], inverse[::-1], p["ub"], len(used))
        dproj = np.concatenate((proj_f, proj_b), axis=1)
        grads["wx"], grads["bx"] = rows.T @ dproj, dproj.sum(axis=0)
        drows = dproj @ p["wx"].T
        grads["word"] = self._summed(self.word_ids[used], drows[:, : s.word_dim] * drop, s.word_rows)
        spread = np.repeat(drows[:, s.word_dim :] / sizes[:, None], sizes, axis=0)
        grads["gram"] = self._summed(grams, spread, s.gram_rows)
        for key, silent in self.silent.items():
            grads[key][silent] = 0
        self._adam(grads)

    @staticmethod
    def _summed(where: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        return np.stack(
            [np.bincount(where, weights=values[:, k], minlength=rows) for k in range(values.shape[1])], axis=1
        ).astype(np.float32)

    def _adam(self, grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = self.network.settings.rate * math.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for key, grad in grads.items():
            mean, square = self.mean[key], self.square[key]
            mean *= 0.9
            mean += 0.1 * grad
            square *= 0.999
            square += 0.001 * grad * grad
            self.network.p[key] -= rate * mean / (np.sqrt(square) + 1e-7)


def fit(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Network:
    """Train on whole texts. A label holds for a text, so of a toxic one the window that
    scores highest is taken for toxic (in the first round, all of them), of others the two
    highest and two more for clean."""
    network = Network(settings)
    rng = np.random.default_rng(settings.seed)
    split = [tokens(text) for text in texts]
    vocabulary = sorted(set().union(*split)) if split else []
    if not vocabulary or len(set(labels)) < 2:
        rate = (sum(labels) + 0.5) / (len(labels) + 1)
        network.p["wo"][:] = 0
        network.shift = math.log(rate / (1 - rate))
        network.empty = network.probability(0.0)
        return network
    number = {word: i for i, word in enumerate(vocabulary)}
    documents = [np.array([number[w] for w in words], np.int32) for words in split]
    at, mask, owner = _windows(documents, settings.window)
    label = np.array(labels, np.float32)[owner]
    trainer = _Trainer(network, vocabulary)
    trainer.prime(documents, np.array(labels))

    def all_logits():
        return np.concatenate(
            [trainer.logits(at[:, i : i + 4096], mask[:, i : i + 4096]) for i in range(0, at.shape[1], 4096)]
        )

    while trainer.steps < settings.steps:
        if not trainer.steps:
            chosen = rng.permutation(at.shape[1])[: 8 * len(texts)]
        else:
            logits = all_logits()
            order = np.lexsort((-logits, owner))
            first = np.concatenate(([0], np.nonzero(np.diff(owner[order]))[0] + 1))
            rank = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate((first, [len(order)]))))
            lucky = rng.random(len(order)) < 2 * len(texts) / len(order)
            toxic = label[order] == 1
            chosen = order[np.where(toxic, rank == 0, (rank < 2) | lucky)]
        rng.shuffle(chosen)
        positive = label[chosen].mean()
        weight = np.where(label[chosen] == 1, 0.5 / max(positive, 1e-6), 0.5 / max(1 - positive, 1e-6))
        weight = weight.astype(np.float32)
        for start in range(0, len(chosen), settings.batch):
            part = chosen[start : start + settings.batch]
            trainer.step(at[:, part], mask[:, part], label[part], weight[start : start + settings.batch])
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, owner, all_logits().astype(np.float64))
    _calibrate(network, best, np.array(labels, float))
    return network


def _calibrate(network: Network, logits: np.ndarray, labels: np.ndarray) -> None:
    """Scale and shift of document logits by logistic regression, labels smoothed."""
    some = np.isfinite(logits)
    x, y = logits[some], labels[some] * 0.98 + 0.01
    spread = x.std() or 1.0
    x = (x - x.mean()) / spread
    def loss(a, b):
        z = a * x + b
        return (np.logaddexp(0, z) - y * z).sum() + 5e-4 * a * a

    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = q * (1 - q) + 1e-6
        gradient = np.array([((q - y) * x).sum() + 1e-3 * a, (q - y).sum()])
        hessian = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        move = np.linalg.solve(hessian, gradient)
        # A whole step overshoots when few texts lie between the labels.
        while loss(a - move[0], b - move[1]) > loss(a, b) and np.abs(move).max() >= 1e-8:
            move = move / 2
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    network.scale = a / spread
    network.shift = b - a * logits[some].mean() / spread
    network.empty = network.probability(float(logits[some].min()))


# ---- tables --------------------------------------------------------------------------


def _excerpt(text: Column, settings: Settings) -> Column:
    """The text, or evenly spread passages of a long one."""
    size = max(1, settings.sample_chars // settings.passages)
    step = (F.length(text) - size) / max(1, settings.passages - 1)
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(settings.passages - 1)),
        lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(size)),
    )
    return F.when(F.length(text) <= settings.sample_chars, text).otherwise(F.array_join(parts, "\n"))


def train(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Network:
    """Learn ``labels.toxic`` (1 or 0; others and nulls are left out) on a bounded sample.

    The sample is drawn from the labels of documents with text, about ``2 * sample`` ids,
    one row each (a document with both labels counts as toxic). So it is small enough to be
    broadcast, no text is shuffled but those found, and the driver gets at most as many
    texts, of at most about ``sample_chars`` code points.
    """
    sound = labels.where("toxic in (0, 1) and doc_id is not null")
    known = sound.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = documents.where(F.length("text") > 0).select("doc_id", "text")
    known = Staging(documents.sparkSession, "toxicity").write(
        known.join(texts.select("doc_id"), "doc_id", "left_semi"), "known"
    )
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    steps = 1 << 30
    share = F.coalesce(
        *[F.when(F.col("toxic") == t, F.lit(min(steps, settings.sample * steps // n))) for t, n in sizes.items()],
        F.lit(0),
    )
    spot = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(steps))
    rows = texts.join(F.broadcast(known.where(spot < share)), "doc_id")
    rows = rows.withColumn("text", _excerpt(F.col("text"), settings))
    learned = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    learned.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in learned], [r.toxic for r in learned], settings)


def score(df: DataFrame, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """``df``'s columns ``keep`` (at least one; those named as the results are replaced) with ``score`` and ``predicted``, a row for each row.

    The network is of fixed size and broadcast; no shuffle. Texts are read whole, some
    at a time.
    """
    keep = [c for c in keep if c not in ("score", "predicted")]
    held = df.sparkSession.sparkContext.broadcast(network)
    source = df.select(packed(df, keep), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        words = Words(held.value)
        for batch in batches:
            texts = batch["text"].to_pylist()
            scores: list[float] = []
            for start in range(0, len(texts), 128):
                scores.extend(score_texts(held.value, words, texts[start : start + 128]))
            predicted = pa.array([int(x >= 0.5) for x in scores], pa.int32())
            yield pa.record_batch(
                [batch["row"], pa.array(scores, pa.float64()), predicted], names=["row", "score", "predicted"]
            )

    made = map_arrow(source, run, with_fields(source, ["row"], "score double, predicted int"))
    return made.select("row.*", "score", "predicted")


def toxicity(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Learns from labelled documents that are not held out; a score uses the text alone. A
    null text, or one without a word, gets the lowest score seen in training. Without labels
    of both kinds, or without labels, every score is the smoothed rate of toxic ones. Repeated
    rows are each scored, a null ``doc_id`` stays null, columns beyond those named are not
    looked at, an empty table gives no rows.
    """
    network = train(documents.where(~held_out()), labels.where(~held_out()), settings)
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return score(rows, network, keep=["doc_id", "held_out"])
