import numpy as np
from brute import fold_out
from conftest import SF
from pyspark.sql import functions as F
from stocklake.llm import langid
from stocklake.llm.queries import op1_language_id

ENGLISH = "the cat and the dog were there with them this morning "
GERMAN = "der hund und die katze waren nicht dort über schöne straßen "


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op1_language_id(spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 10
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(documents):
    rows = [(i, ENGLISH * 3, "en") for i in range(10)] + [(i, GERMAN * 3, "de") for i in range(10, 20)]
    rows += [(20, None, "en"), (21, "", "en"), (22, "12 -- 34", "de"), (23, GERMAN, None), (None, ENGLISH, "en")]
    rows += [(24, GERMAN * 30_000, None), (24, GERMAN * 30_000, None)]
    out = langid.language_id(documents(rows))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (20, 21, 22, 23, 24, None)] == ["und", "und", "und", "de", "de", "en"]
    assert by_id[20].score == 0.0 and by_id[None].held_out is False


def test_empty_and_unlabelled(documents):
    assert langid.language_id(documents([]) if False else documents([(1, "a", None)]).limit(0)).count() == 0
    only = langid.language_id(documents([(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in only] == [("und", 0.0)]


def test_lang_is_no_input(documents):
    rows = [(i, ENGLISH, "en") for i in range(8)] + [(i, GERMAN, "de") for i in range(8, 16)]
    model = langid.train(documents(rows))
    wrong = documents([(1, ENGLISH, "de"), (2, GERMAN, "en")])
    got = {r.doc_id: r.lang_pred for r in langid.identify(wrong, model, keep=("doc_id",)).collect()}
    assert got == {1: "en", 2: "de"}


def test_scores_are_naive_bayes():
    model = langid.Model(("a", "b"), np.log([0.5, 0.5]), np.log(np.full((64, 2), 1 / 64)).astype(np.float32))
    langs, scores = langid.predict_texts(model, ["hello"])
    assert langs == ["a"] and abs(scores[0] - 0.5) < 1e-9


def plain_grams(text):
    """The n-grams of a text by plain loops: letters folded, the rest one blank."""
    points = []
    for c in text:
        if ord(c) > 0xFFFF:
            point = ord(c)
        elif c.isalpha():
            point = ord(c.lower()) if len(c.lower()) == 1 else ord(c)
        else:
            point = 32
        if point != 32 or not points or points[-1] != 32:
            points.append(point)
    return [(k, tuple(points[i : i + k])) for k in (1, 2, 3) for i in range(len(points) - k + 1)]


def plain_bucket(order, gram, buckets):
    rolled = 0
    for size, point in enumerate(gram, 1):
        rolled = (rolled * 0x100000001B3 + point + size) % 2**64
    return (rolled * 0x9E3779B97F4A7C15) % 2**64 >> (64 - (buckets.bit_length() - 1))


def test_every_score_against_plain_naive_bayes(documents):
    """Counts, smoothing, priors, posteriors: all by hand from the same n-grams."""
    import math
    import random

    settings = langid.Settings(buckets=1 << 10)
    draw = random.Random(3)
    texts = [(" ".join(draw.choices(s.split(), k=12)), lang) for s, lang in ((ENGLISH, "en"), (GERMAN, "de")) for _ in range(15)]
    rows = [(n, text, lang) for n, (text, lang) in enumerate(texts)]
    rows += [(100, "The DOG!!  𝔘𝔫 ǅ ß", None), (101, "x", None), (102, "a-b 1", "en")]
    df = documents(rows)
    learned = [r for r in rows if r[2] is not None and not fold_out(r[0])]
    counts = {lang: [settings.alpha] * settings.buckets for lang in ("de", "en")}
    for _, text, lang in learned:
        for order, gram in plain_grams(text):
            counts[lang][plain_bucket(order, gram, settings.buckets)] += 1
    got = {r.doc_id: r for r in langid.language_id(df, settings).collect()}
    for doc, text, _ in rows:
        logs = {}
        for lang, own in counts.items():
            prior = sum(r[2] == lang for r in learned) / len(learned)
            buckets = [plain_bucket(order, gram, settings.buckets) for order, gram in plain_grams(text)]
            logs[lang] = math.log(prior) + sum(math.log(own[b] / sum(own)) for b in buckets)
        best = max(sorted(logs), key=logs.get)
        want = 1 / sum(math.exp(x - logs[best]) for x in logs.values())
        assert got[doc].lang_pred == best and abs(got[doc].score - want) < 1e-4, (doc, got[doc], want)


def test_pieces_have_the_ngrams_of_the_whole():
    """Cuts inside words, runs of blanks and surrogate pairs change no count."""
    text = "Ab  c!!  𝔘𝔫 -- ende   " * 4
    whole = np.sort(langid.gram_buckets(text, 1 << 12))
    want = sorted(plain_bucket(order, gram, 1 << 12) for order, gram in plain_grams(text))
    assert whole.tolist() == want
    for size in range(1, 25):
        pieces = [*langid.gram_chunks(text, 1 << 12, size)]
        assert np.array_equal(np.sort(np.concatenate(pieces)), whole), size
    long = "ab, " * ((langid.CHUNK + 3) // 4) + "xyz"
    assert len(long) > langid.CHUNK
    assert np.array_equal(np.sort(langid.gram_buckets(long, 64)), np.sort(np.concatenate([*langid.gram_chunks(long, 64, len(long))])))


def test_batches_do_not_change_scores(monkeypatch):
    draw = np.random.default_rng(2)
    model = langid.Model(("a", "b", "c"), np.log([0.2, 0.3, 0.5]), draw.normal(-5, 1, (64, 3)).astype(np.float32))
    texts = ["one two", None, "", "three" * 50, "12", "vier fünf", "x"]
    alone = [langid.predict_texts(model, [text]) for text in texts]
    for limit in (1, 40, 1 << 18):
        monkeypatch.setattr(langid, "SCORED", limit)
        langs, scores = langid.predict_texts(model, texts)
        assert langs == [x[0][0] for x in alone] and np.allclose(scores, [x[1][0] for x in alone])


UNSEEN = [
    "Il governo italiano ha deciso di aumentare le tasse sulle imprese che non rispettano le norme ambientali "
    "e questo cambiamento avrà conseguenze per molte famiglie",
    "De Nederlandse regering heeft besloten dat de belasting voor bedrijven omhoog gaat en dat heeft gevolgen "
    "voor veel gezinnen in het hele land",
    "Polski rząd zdecydował się podnieść podatki dla przedsiębiorstw które nie przestrzegają przepisów ochrony środowiska",
    "中国政府决定提高不遵守环境规定的企业的税收这将影响许多家庭的生活",
    "Правительство решило повысить налоги для предприятий которые не соблюдают экологические нормы",
    "asdfkj qwepoi zxcmnv lkjhasd poiqwe mnzxbv qpwoei rutyal skdjfh gzmxnc bvqwer",
]


def test_unseen_languages_and_noise_are_not_known(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(documents.where(~langid.held_out()))
    rows = documents.where(langid.held_out() & F.col("lang").isNotNull()).select("lang", "text")
    judged = langid.identify(rows, model, keep=["lang"]).groupBy("lang").agg(F.avg(F.col("known").cast("int")))
    assert {lang: share >= 0.98 for lang, share in judged.collect()} == dict.fromkeys(model.languages, True)
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(UNSEEN)], "n int, text string")
    assert [r.n for r in langid.identify(frame, model, keep=["n"]).where("known").collect()] == []
