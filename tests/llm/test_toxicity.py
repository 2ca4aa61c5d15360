import random

import numpy as np
from conftest import SF
from stocklake.llm import toxicity
from stocklake.llm.queries import op9_toxicity

SMALL = toxicity.Settings(steps=200, batch=64)


def texts_of(n, seed, bad=("zorkish", "blargful", "zorken", "blargs")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("aeioulnrst", k=rng.randrange(2, 8))) for _ in range(rng.randrange(20, 150))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_from_words_and_characters(spark, documents):
    rows = texts_of(300, 1)
    labels = spark.createDataFrame([(i, t, "x") for i, _, t in rows], "doc_id long, toxic int, text string")
    fresh = [(1000 + i, text, t) for i, text, t in texts_of(90, 2)]
    other = [(2100 + i, text, t) for i, text, t in texts_of(90, 3, bad=("zorkishes", "blargfuls"))]
    edges = [(2000, None), (2001, ""), (2002, "?!"), (None, "zorkish"), (2003, "al " * 60_000 + "zorkish blargful zorken")]
    df = documents([(i, text) for i, text, _ in rows + fresh + other] + edges)
    out = toxicity.toxicity(df, labels, SMALL)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) + len(fresh) + len(other) + len(edges)
    assert np.mean([got[i].predicted == t for i, _, t in rows + fresh]) > 0.95
    # Words not seen in training, but for their beginnings: toxic texts score higher.
    toxic, clean = ([got[i].score for i, _, t in other if t == label] for label in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[2000].score == got[2001].score == got[2002].score < 0.5
    assert got[2003].predicted == 1 and got[None].held_out is False


def test_nothing_to_learn(spark, documents):
    df = documents([(1, "a b"), (1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == 3 and {r.score for r in got} == {0.5}
    assert toxicity.toxicity(df.limit(0), labels.limit(0)).count() == 0


def test_sample_is_drawn_from_documents_with_text(spark, documents, monkeypatch):
    """Labels without a document take no place in the sample; long texts are learned from."""
    learned = []
    monkeypatch.setattr(toxicity, "fit", lambda *a: learned.extend(zip(*a[:2], strict=True)))
    rows = [(i, text + " al" * 20_000 * t + " end") for i, text, t in texts_of(60, 1)]
    labels = spark.range(6_000).selectExpr("id doc_id", "int(id % 3 = 0) toxic")
    toxicity.train(documents([*rows, (60, None), (63, "")]), labels, toxicity.Settings(sample=20))
    toxic = [text for text, label in learned if label]
    assert len(toxic) == 20 and 5 <= len(learned) - 20 <= 35
    assert all(19_900 < len(text) <= 20_020 and text.endswith(" end") for text in toxic)


def test_query_on_given_tables(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op9_toxicity(spark, SF).join(labels, "doc_id").where("not held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_text_without_spaces_is_read_to_its_end():
    """Every n-gram of a long run of letters is read, and words inside it count."""
    run = "".join(texts_of(1, 5)[0][1].split())
    for n in (40, 41, 44, 45, 52, 53, len(run)):
        read = set(toxicity.gram_ids(toxicity.tokens(run[:n]), 1 << 30)[0])
        points = [ord(c) for c in run[:n]]
        for size in toxicity.GRAMS:
            for at in range(n - size + 1):
                row = size
                for point in points[at : at + size]:
                    row = (row * 0x100000001B3 + point) % (1 << 64)
                assert (row * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % (1 << 30) in read, (n, size, at)
    network = toxicity.fit([t for _, t, _ in texts_of(300, 1)], [y for *_, y in texts_of(300, 1)], SMALL)
    words = toxicity.Words(network)
    clean = ["".join(t.split()) for _, t, y in texts_of(90, 6) if not y]
    toxic = [t[:200] + "zorkishblargful" + t[200:] for t in clean]
    low, high = (toxicity.score_texts(network, words, texts) for texts in (clean, toxic))
    assert np.mean([b > a for a, b in zip(low, high, strict=True)]) > 0.9


def test_calibration_of_separate_labels():
    """Few toxic texts far from the others: the scores still tell them apart."""
    network = toxicity.Network(toxicity.Settings())
    rng = np.random.default_rng(0)
    logits = np.concatenate((rng.normal(6.6, 0.4, 42), np.minimum(rng.exponential(1.5, 1500) - 6.5, 5.7)))
    toxicity._calibrate(network, logits, np.array([1.0] * 42 + [0.0] * 1500))
    assert network.probability(6.5) > 0.5 > network.probability(-5.0) > network.probability(-7.0) > 0


def test_rare_words_count_by_setting():
    for least, silent in ((1, False), (4, True)):
        settings = toxicity.Settings(min_texts=least)
        trainer = toxicity._Trainer(toxicity.Network(settings), ["common", "zorkish"])
        trainer.prime([np.array([0, 1])] + [np.array([0])] * 9, np.array([1] * 4 + [0] * 6))
        row = toxicity.word_id("zorkish", settings.word_rows)
        assert trainer.silent["word"][row] == silent and (trainer.network.p["word"][row, 0] == 0) == silent


def test_gradients():
    """Backpropagation against differences, for every parameter."""
    settings = toxicity.Settings(word_rows=8, gram_rows=16, word_dim=2, gram_dim=3, hidden=2, attention=2, window=4)
    network = toxicity.Network(settings)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    trainer = toxicity._Trainer(network, ["ab", "cde", "f", "ghij"])
    trainer.rng = type("Keep", (), {"random": staticmethod(lambda n: np.zeros(n))})()
    taken = {}
    trainer._adam = taken.update
    at = np.array([[0, 1, 2], [3, 0, 1], [1, 1, 0], [2, 3, 0]])
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0]], np.float32)
    label, weight = np.array([1.0, 0, 1]), np.array([1.0, 0.5, 2])
    trainer.step(at, mask, label, weight)

    def loss():
        x = trainer.logits(at, mask).astype(np.float64)
        return (weight * (np.log1p(np.exp(x)) - label * x)).mean()

    rng = np.random.default_rng(0)
    for key, value in network.p.items():
        for _ in range(4):
            place = tuple(rng.integers(0, n) for n in value.shape)
            kept, step = value[place], 3e-3
            value[place] = kept + step
            up = loss()
            value[place] = kept - step
            down = loss()
            value[place] = kept
            assert abs((up - down) / (2 * step) - taken[key][place]) < 2e-3, (key, place)


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 55, 56, 57, 200):
        starts = toxicity.window_starts(n, 32)
        covered = {i for s in starts for i in range(s, min(n, s + 32))}
        assert covered == set(range(n))
    assert toxicity.window_starts(0, 32) == []


def test_windows_hold_passages():
    """Wherever a passage lies, a window holds all of it up to half a window, and three
    quarters of one as long as a window."""
    starts = toxicity.window_starts(200, 32)
    for length, least in ((10, 10), (17, 17), (32, 24)):
        for at in range(200 - length + 1):
            assert max(min(s + 32, at + length) - max(s, at) for s in starts) >= least, (length, at)


def test_score_does_not_depend_on_company():
    network = toxicity.fit([t for _, t, _ in texts_of(60, 3)], [y for *_, y in texts_of(60, 3)], SMALL)
    texts = [t for _, t, _ in texts_of(20, 4)]
    together = toxicity.score_texts(network, toxicity.Words(network), texts)
    alone = [toxicity.score_texts(network, toxicity.Words(network), [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)
