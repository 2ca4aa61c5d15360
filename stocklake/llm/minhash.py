"""Near-duplicate groups by SuperMinHash signatures, banding, verification, union-find.

A document's set holds its distinct 5-word shingles. SuperMinHash gives each shingle one
random permutation of the signature's slots and writes ``rank + uniform`` into the slot
of each rank, so the slots of one shingle are spread evenly, and a set is done as soon as
no later rank can lower a slot: after about ``slots * ln(slots) / size`` ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

WORDS = 5
PERCENT = 75
BANDS = 32
ROWS = 4
#: Sets signed in one numpy pass hold about so many shingles together.
ELEMENTS = 1 << 16
#: Members of an unsettled bucket compared in one task; a larger bucket takes a task for
#: each pair of blocks.
BLOCK = 1024
#: A pair at the limit agrees in fewer slots than this share in about 1 of 10**6 cases.
AGREE = 0.55

#: Times that unsettled buckets are verified against a member drawn at random.
PASSES = 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = out
        return out


_HASHES = _WordHashes()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; with fewer words, the
    whole sequence is the one shingle; without words there is none."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(hashed))
    keep = len(hashed) - width + 1
    rolled = np.full(keep, width, np.uint64)
    for i in range(width):
        rolled = _mixed(rolled * _MIX + hashed[i : i + keep])
    return np.unique(rolled)


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (sets x slots, 32-bit) of non-empty sets.

    A set of more than ELEMENTS shingles is signed in parts; the least of each slot over
    the parts is the slot of the whole.
    """
    parts, owner = [], []
    for i, found in enumerate(sets):
        for start in range(0, len(found), ELEMENTS):
            parts.append(found[start : start + ELEMENTS])
            owner.append(i)
    if len(parts) == len(sets):
        best = _least_ranks(parts, slots)
    else:
        best = np.full((len(sets), slots), np.inf)
        for i, part in zip(owner, parts, strict=True):
            best[i] = np.minimum(best[i], _least_ranks([part], slots)[0])
    whole = np.floor(best)
    exact = whole.astype(np.uint64) << np.uint64(32) | ((best - whole) * 2.0**32).astype(np.uint64)
    return (_mixed(exact) >> np.uint64(32)).astype(np.uint32)


def _least_ranks(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """The slots of all sets, rank by rank over all their shingles at once.

    A slot keeps the least ``rank + uniform`` of the set's shingles. Rank j of a shingle
    goes to the slot that a Fisher-Yates step picks among those it has not used so far.
    """
    sizes = np.array([len(s) for s in sets])
    base = np.repeat(np.arange(len(sets)) * slots, sizes)
    state = np.concatenate(sets)
    best = np.full(len(sets) * slots, np.inf)
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(state), 1))
    rows = np.arange(len(state))
    for rank in range(slots):
        state = _mixed(state + _MIX)
        pick = rank + ((state >> np.uint64(40)) % np.uint64(slots - rank)).astype(np.int64)
        uniform = (state & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32
        slot = order[rows, pick]
        order[rows, pick] = order[:, rank]
        np.minimum.at(best, base + slot, rank + uniform)
        # A set goes on while a slot is open or holds more than the next rank could give.
        going = best.reshape(-1, slots).max(axis=1) > rank + 1
        if not going.any():
            break
        live = going[base // slots]
        if not live.all():
            base, state, order = base[live], state[live], order[live]
            rows = np.arange(len(state))
    return best.reshape(-1, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    keys = np.empty((len(signatures), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signatures), band + 1, np.uint64)
        for row in range(band * rows, (band + 1) * rows):
            key = _mixed(key * _MIX + signatures[:, row])
        keys[:, band] = key
    return keys


def _groups(sets: list[np.ndarray]) -> Iterator[list[int]]:
    """Positions of non-empty sets, about ELEMENTS shingles together."""
    group, size = [], 0
    for i, found in enumerate(sets):
        if len(found):
            group.append(i)
            size += len(found)
        if size >= ELEMENTS:
            yield group
            group, size = [], 0
    if group:
        yield group


def sign(df: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc, n, class_a, class_b, signature``: a set's size, two hashes of the set that
    equal sets share, and its signature; for an empty set these are null."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch["text"].to_pylist()]
            signatures: list = [None] * len(sets)
            first: list = [None] * len(sets)
            second: list = [None] * len(sets)
            for group in _groups(sets):
                for i, made in zip(group, superminhash([sets[i] for i in group], bands * rows), strict=True):
                    signatures[i] = made.tobytes()
                    raw = xxhash.xxh3_128_digest(sets[i].tobytes())
                    first[i], second[i] = np.frombuffer(raw, np.int64).tolist()
            yield pa.record_batch(
                [
                    batch["doc"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc", "n", "class_a", "class_b", "signature"],
            )

    return map_arrow(df, run, "doc long, n long, class_a long, class_b long, signature binary")


def _banded(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """``key, band, doc, n``: a row for each set and band."""

    def run(batches):
        for batch in batches:
            raw = b"".join(batch["signature"].to_pylist())
            keys = band_keys(np.frombuffer(raw, np.uint32).reshape(-1, bands * rows), bands, rows)
            repeat = lambda c: pa.array(np.repeat(batch[c].to_numpy(), bands))
            number = pa.array(np.tile(np.arange(bands, dtype=np.int32), len(keys)))
            yield pa.record_batch(
                [pa.array(keys.view(np.int64).ravel()), number, repeat("doc"), repeat("n")],
                names=["key", "band", "doc", "n"],
            )

    return map_arrow(signed.select("doc", "n", "signature"), run, "key long, band int, doc long, n long", 2048)


def _verified(
    pairs: DataFrame, texts: DataFrame, words: int, percent: int, staging: Staging, label: str
) -> DataFrame:
    """The pairs ``a, b`` whose full sets are at least so similar.

    Whole texts travel once, to find those of the pairs; these are written and joined.
    """
    pairs = staging.write(pairs, f"{label}-pairs")
    named = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    named = staging.write(named, f"{label}-named")
    texts = staging.write(texts.join(named, "doc", "left_semi"), f"{label}-texts")
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        last, kept = None, None
        for batch in batches:
            fine = []
            texts_a, texts_b = batch["text_a"].to_pylist(), batch["text_b"].to_pylist()
            for text_a, text_b in zip(texts_a, texts_b, strict=True):
                if text_a != last:
                    last, kept = text_a, shingle_set(text_a, words)
                other = shingle_set(text_b, words)
                both = len(np.intersect1d(kept, other, assume_unique=True))
                fine.append(100 * both >= percent * (len(kept) + len(other) - both))
            yield pa.record_batch([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return map_arrow(pairs.join(left, "a").join(right, "b"), run, "a long, b long")


def _forest(edges: DataFrame) -> DataFrame:
    """Union-find within each task: links to the least member of each local group."""

    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        links = [(x, root(x)) for x in parent if root(x) != x]
        yield pa.record_batch(
            [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
            names=["a", "b"],
        )

    return map_arrow(edges.select("a", "b"), run, "a long, b long", 10_000)


def components(edges: DataFrame, staging: Staging, label: str) -> DataFrame:
    """``doc, component`` of each node of ``edges`` (``a, b``): the least node reachable.

    Each round links all neighbours of a node to the least of them and joins the links of
    each task by union-find. A round is written to the shared folder, so a lost executor
    costs no more than the round; it ends when no node has two smaller neighbours and none
    of them is a root's child, that is, when all links are stars.
    """
    links, turn = staging.write(_forest(edges).distinct(), f"{label}-0"), 0
    while True:
        turn += 1
        both = links.union(links.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        star = both.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = staging.write(_forest(star).distinct(), f"{label}-{turn}")
        ends = links.select("a", F.lit(1).alias("up")).union(links.select("b", F.lit(0)).distinct())
        # A node with two links up, or with links up and down, is not settled.
        settled = ends.groupBy("a").agg(F.sum("up").alias("up"), F.count("*").alias("ends"))
        if settled.where("up > 1 or (up = 1 and ends > 1)").isEmpty():
            break
    return links.select(F.col("a").alias("doc"), F.col("b").alias("component")).union(
        links.select("b", "b").distinct()
    )


def _sets(texts: DataFrame, words: int, slots: int) -> DataFrame:
    """``doc, shingles, signature`` of texts that have words."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch["text"].to_pylist()]
            signatures: list = [None] * len(sets)
            for group in _groups(sets):
                for i, made in zip(group, superminhash([sets[i] for i in group], slots), strict=True):
                    signatures[i] = made.tobytes()
            raw = pa.array([found.tobytes() for found in sets], pa.binary())
            yield pa.record_batch(
                [batch["doc"], raw, pa.array(signatures, pa.binary())], names=["doc", "shingles", "signature"]
            )

    return map_arrow(texts, run, "doc long, shingles binary, signature binary")


def linked_pairs(
    docs: np.ndarray,
    component: np.ndarray,
    side: np.ndarray,
    sets: list[np.ndarray],
    signatures: np.ndarray,
    band: int,
    rows: int,
    percent: int,
) -> list[tuple[int, int]]:
    """Links that join components of a bucket's members, where ``side`` differs or all
    are on one side.

    A pair is looked at in the first band that its members share, if its signatures and
    sizes may reach the limit, and confirmed on the full sets. Members that a link has
    joined are not compared again.
    """
    component, links = component.copy(), []
    size = np.array([len(found) for found in sets])
    both_sides = (side != side[0]).any()
    for i in range(len(docs)):
        fits = (component != component[i]) & (docs > docs[i])
        fits &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
        if both_sides:
            fits &= side != side[i]
        at = np.nonzero(fits)[0]
        same = signatures[at] == signatures[i]
        shared = same.reshape(len(at), signatures.shape[1] // rows, rows).all(axis=2)
        at = at[(same.mean(axis=1) >= AGREE) & (shared.argmax(axis=1) == band)]
        for k in at:
            if component[k] == component[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= percent * (size[i] + size[k] - both):
                links.append((int(docs[i]), int(docs[k])))
                component[component == component[k]] = component[i]
    return links


def _cross_links(rows: DataFrame, band_rows: int, percent: int) -> DataFrame:
    """Links within unsettled buckets that join components. A bucket is dealt to blocks
    of about BLOCK members, and each pair of blocks is a group of its own."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = rows.join(sizes, "key").withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "doc"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["key", "band", "doc", "component", "shingles", "signature", "block"]
    dealt = dealt.select(*columns, other.alias("other")).select(
        *columns, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        links = linked_pairs(
            group["doc"].to_numpy(),
            group["component"].to_numpy(),
            group["block"].to_numpy(),
            [np.frombuffer(raw, np.uint64) for raw in group["shingles"]],
            np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(group), -1),
            int(group["band"].iloc[0]),
            band_rows,
            percent,
        )
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("key", "low", "high").applyInPandas(compare, "a long, b long").distinct()


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with their component so far."""
    return rows.join(found, "doc", "left").select(
        "key", "band", "doc", "n", F.coalesce("component", "doc").alias("component")
    )


def _unsettled(labelled: DataFrame) -> DataFrame:
    """Members of the buckets in which pairs are left that may link two components."""
    keys = labelled.groupBy("key").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    return labelled.join(keys.where("members > 2 and low <> high").select("key"), "key", "left_semi")


def near_duplicates(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: a row per row of the documents.

    Two documents are linked if ``100 * intersection >= percent * union`` holds for their
    full sets; ``component_id`` is the least id reachable over links, ``kept`` says that
    it is the document itself. Null, empty and blank texts have an empty set and no link.
    Rows with a null id are given back with their size and no component (kept). Rows
    of one id should not occur; if they do, they share what their first set is linked with.

    Sets that are equal are one class, found by a 128-bit hash of the set with a map-side
    minimum, so copies cost nothing further on. Of the classes' signatures, bands make
    buckets; each member is verified against the bucket's least member (pairs grow with
    the members, not their square). In buckets that still hold several components, members
    outside the component of a member drawn at random are verified against it, PASSES
    times; a text shares many buckets with its near copies and meets another in each.
    What is still open is compared block by block, each pair once, on signatures and then
    on the full sets; the blocks give back links only. So no link is lost but by banding
    itself (at the limit 4 * 10**-6 of the pairs share no band of 32 x 4) or by AGREE.
    """
    spark = documents.sparkSession
    staging = Staging(spark, "near-dup")
    slots = bands * rows
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text")
    signed = staging.write(sign(texts, words, bands, rows), "signed")
    member = signed.where("n > 0 and doc is not null")
    classes = member.groupBy("class_a", "class_b").agg(F.min("doc").alias("first"))
    classed = staging.write(
        signed.select("doc", "n", "class_a", "class_b").join(classes, ["class_a", "class_b"], "left")
        .select("doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("first", "doc")).alias("first")),
        "classes",
    )
    heads = signed.join(classed.where("n > 0 and doc = first").select("doc"), "doc", "left_semi")

    banded = staging.write(_banded(heads, bands, rows), "banded")
    buckets = banded.groupBy("key").agg(
        F.min(F.struct("doc", "n")).alias("lead"), F.count("*").alias("members")
    ).where("members > 1")
    near = F.lit(100) * F.least("n", "lead.n") >= F.lit(percent) * F.greatest("n", "lead.n")
    stars = (
        banded.join(buckets, "key")
        .where((F.col("doc") != F.col("lead.doc")) & near)
        .select(F.col("lead.doc").alias("a"), F.col("doc").alias("b"))
        .distinct()
    )
    links = staging.write(_verified(stars, texts, words, percent, staging, "star"), "links")
    found = staging.write(components(links, staging, "round"), "components")

    labelled = _labelled(banded.join(buckets.select("key"), "key", "left_semi"), found)
    rest = staging.write(_unsettled(labelled).drop("component"), "rest")
    for turn in range(PASSES):
        lead = F.struct(F.xxhash64(F.lit(turn), "key", "doc"), "doc", "n", "component")
        labelled = _labelled(rest, found)
        leads = labelled.groupBy("key").agg(F.min(lead).alias("lead"))
        stars = (
            labelled.join(leads, "key")
            .where((F.col("component") != F.col("lead.component")) & near)
            .select(F.least("doc", "lead.doc").alias("a"), F.greatest("doc", "lead.doc").alias("b"))
            .distinct()
        )
        more = _verified(stars, texts, words, percent, staging, f"star-{turn}")
        links = links.union(staging.write(more, f"links-{turn}"))
        found = staging.write(components(links, staging, f"round-{turn}"), f"components-{turn}")
    open_rows = staging.write(_unsettled(_labelled(rest, found)), "open")
    named = staging.write(open_rows.select("doc").distinct(), "open-named")
    sets = _sets(texts.join(named, "doc", "left_semi"), words, slots).dropDuplicates(["doc"])
    missed = staging.write(_cross_links(open_rows.join(sets, "doc"), rows, percent), "missed")
    found = components(links.union(missed), staging, "last")

    return (
        classed.join(found.select(F.col("doc").alias("first"), "component"), "first", "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "first").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
