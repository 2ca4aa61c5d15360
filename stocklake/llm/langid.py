"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on the executors, sums them by (language, bucket)
and makes one log-probability matrix of fixed width, which is broadcast. Scoring looks
up the rows of the n-grams a text holds (its sparse count vector) and adds them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import held_out, map_arrow, packed, with_fields

UNKNOWN = "und"
ORDERS = (1, 2, 3)
CHUNK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``buckets``: width of the hashed feature space, a power of two. ``sample``: at most
    about so many labelled documents of each language are learned from, chosen by a hash
    of the id; rarer languages are learned from whole. ``alpha``: additive smoothing.
    ``strictness``: where between a text without sense (0) and the learned ones (1) the mean
    log-probability of an n-gram must lie at least for a text to be in a known language."""

    buckets: int = 1 << 15
    sample: int = 4000
    alpha: float = 0.5
    strictness: float = 0.6


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # bucket x language
    floor: np.ndarray | None = None  # per language the least mean log-probability of its texts


_FOLD: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Of each code point of the basic plane: its lower-case letter, or a blank."""
    global _FOLD
    if _FOLD is None:
        table = np.full(1 << 16, 32, np.uint32)
        for point in range(1 << 16):
            letter = chr(point)
            if letter.isalpha():
                low = letter.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _FOLD = table
    return _FOLD


def _folded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _fold_table()
    return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], points)


def gram_chunks(text: str, buckets: int, chunk: int | None = None):
    """Buckets of all 1-, 2- and 3-grams of a text, a piece of it at a time; runs of
    non-letters count as one blank.

    The last two points of a piece go before the next one, so the n-grams are those of
    the whole text, and a very long one needs no more memory than a piece.
    """
    tail = np.zeros(0, np.uint32)
    size = chunk or CHUNK
    for start in range(0, len(text), size):
        points = _folded(text[start : start + size])
        blank = points == 32
        before = np.concatenate((tail[-1:] == 32 if len(tail) else [False], blank[:-1]))
        points = np.concatenate((tail, points[~(blank & before)]))
        yield _buckets_of(points.astype(np.uint64), len(tail), buckets)
        tail = points[-2:]


def _buckets_of(points: np.ndarray, old: int, buckets: int) -> np.ndarray:
    """Buckets of the n-grams that end behind the first ``old`` points."""
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    out, rolled = [], np.zeros(len(points), np.uint64)
    for order in ORDERS:
        keep = len(points) - order + 1
        if keep <= 0:
            break
        rolled = rolled[:keep] * np.uint64(0x100000001B3) + points[order - 1 :] + np.uint64(order)
        out.append((rolled[max(0, old - order + 1) :] * np.uint64(0x9E3779B97F4A7C15)) >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def gram_buckets(text: str, buckets: int) -> np.ndarray:
    """The buckets of all pieces of a text."""
    return np.concatenate([*gram_chunks(text, buckets), np.zeros(0, np.int64)])


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(df: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from the rows of ``df`` (``doc_id, text, lang``) that have a language.

    The driver gets one row per language and, after the sum, at most ``buckets`` counts
    of each: a size that does not depend on the number of documents.
    """
    labelled = df.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros(0), np.zeros((settings.buckets, 0)))
    steps = 1 << 30
    share = F.coalesce(
        *[
            F.when(F.col("lang") == lang, F.lit(min(steps, settings.sample * steps // sizes[lang])))
            for lang in languages
        ]
    )
    spot = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(steps))
    index = {lang: i for i, lang in enumerate(languages)}
    buckets = settings.buckets

    def count(batches):
        total = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                for grams in gram_chunks(text, buckets):
                    total[index[lang]] += np.bincount(grams, minlength=buckets)
        rows, cols = np.nonzero(total)
        yield pa.record_batch(
            [pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32)), pa.array(total[rows, cols])],
            names=["lang_no", "bucket", "n"],
        )

    learned = labelled.where(spot < share).select("text", "lang")
    counted = map_arrow(learned, count, "lang_no int, bucket int, n long")
    counted = counted.groupBy("lang_no", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((buckets, len(languages)))
    table[counted["bucket"], counted["lang_no"]] = counted["n"]
    smooth = table + settings.alpha
    log_prob = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    prior = np.array([sizes[lang] for lang in languages], float)
    return Model(
        languages, np.log(prior / prior.sum()), log_prob, _floors(table, log_prob, settings)
    )


def _floors(counts: np.ndarray, log_prob: np.ndarray, settings: Settings) -> np.ndarray:
    """The background model has all buckets alike; a language's floor lies between its
    mean log-probability and that of the n-grams learned from, and nearer to the
    background's the fewer these are beside the smoothing."""
    background = -np.log(settings.buckets)
    learned = counts.sum(axis=0)
    own = (counts * log_prob).sum(axis=0) / np.maximum(learned, 1)
    weight = learned / (learned + settings.alpha * settings.buckets)
    return background + settings.strictness * weight * (own - background)


#: Counts of so many buckets are scored at a time.
SCORED = 1 << 18


def _sparse_counts(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets a text holds and how often."""
    total = np.zeros(buckets, np.int64)
    for grams in gram_chunks(text, buckets):
        total += np.bincount(grams, minlength=buckets)
    held = np.flatnonzero(total)
    return held, total[held]


def log_scores(model: Model, texts: list[str]) -> np.ndarray:
    """A row per text with the log-probability of each language and the text."""
    return _scored(model, texts)[0]


def _scored(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The log-probabilities, and how many n-grams each text has.

    The texts' counts are the rows of a sparse matrix (bucket numbers, counts and where
    each row begins); many rows at a time are multiplied with the model's matrix.
    """
    out: list[np.ndarray] = []
    held, counts, begins, size = [], [], [], 0
    grams = np.zeros(len(texts))

    def multiply() -> None:
        weighted = model.log_prob[np.concatenate(held)] * np.concatenate(counts)[:, None].astype(np.float64)
        out.append(np.add.reduceat(weighted, begins, axis=0) + model.log_prior)

    for k, text in enumerate(texts):
        buckets, number = _sparse_counts(text, len(model.log_prob))
        grams[k] = number.sum()
        if held and size + len(buckets) > SCORED:
            multiply()
            held, counts, begins, size = [], [], [], 0
        held.append(buckets)
        counts.append(number)
        begins.append(size)
        size += len(buckets)
    if held:
        multiply()
    return (np.concatenate(out) if out else np.zeros((0, len(model.languages)))), grams


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and posterior of each text."""
    return _judged(model, texts)[:2]


def _judged(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, posterior, and whether the text reads like those the language was learned from."""
    langs, scores, fits = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    known = [k for k, text in enumerate(texts) if model.languages and has_letter(text)]
    total, grams = _scored(model, [texts[k] for k in known])
    for k, row, n in zip(known, total, grams, strict=True):
        best = int(np.argmax(row))
        langs[k] = model.languages[best]
        scores[k] = float(1.0 / np.exp(row - row[best]).sum())
        mean = (row[best] - model.log_prior[best]) / n
        fits[k] = model.floor is None or bool(mean >= model.floor[best])
    return langs, scores, fits


def identify(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``df``'s columns ``keep`` (at least one; those named as the results are replaced) with
    ``lang_pred``, ``score`` and ``known``, a row for each row.

    ``known`` is false if the text's n-grams are too improbable in the language found: it is
    in none of the learned ones, or without sense. The posterior alone cannot tell, as some
    language is always the likeliest by far.

    A null text or one without a letter is ``und`` with score 0; so is any text if there
    was nothing to learn from. Ties go to the language that sorts first. The model is of
    fixed size (buckets x languages) and is broadcast; no shuffle.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score", "known")]
    held = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(packed(df, keep), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for batch in batches:
            langs, scores, fits = _judged(held.value, batch["text"].to_pylist())
            yield pa.record_batch(
                [batch["row"], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.bool_())],
                names=["row", "lang_pred", "score", "known"],
            )

    made = map_arrow(source, run, with_fields(source, ["row"], "lang_pred string, score double, known boolean"))
    return made.select("row.*", "lang_pred", "score", "known")


def language_id(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    Learns from documents that are not held out and have a language; a prediction uses
    the text alone. Repeated rows are repeated in the result, a null ``doc_id`` stays
    null and is not held out, other columns are not looked at, an empty table gives none.
    """
    model = train(documents.where(~held_out()), settings)
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, model, keep=["doc_id", "held_out"]).drop("known")
