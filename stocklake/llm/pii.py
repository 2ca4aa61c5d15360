"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence.

Pattern spans (e-mail, ip, card, phone) are protected values. For each value c and term t
of a document with it the corpus gives the pointwise mutual information,
log2(N n(c,t) / (n(c) n(t))), and the information content of the value, log2(N / n(c)); all
counts are of documents. PMI reaches the content when t never occurs without c; a term
whose PMI is at least ``content / alpha`` says too much about the value and is generalised,
from ``content / certain`` on it is removed, wherever a document with the value has it.
Everything is column expressions, joins and aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, packed

# Patterns with the same matches as the stated ones, in forms a regular expression engine
# without memory runs in linear time: possessive repeats, starts only where a run starts.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole runs of 16 to 19 digits; runs of other lengths fail the length check anyway.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = tuple(PATTERNS)
TERM = "term"
WORD = r"(?<![\p{L}\p{N}])\p{L}{3,}+(?!\p{N})"

SPANS = "array<struct<kind:string,start:long,end:long,value:string>>"
#: Sizes summed up at a time, and how often sums are summed in blocks again.
BLOCK, DEPTH = 32, 2


@dataclass(frozen=True)
class Settings:
    """``min_docs``: documents a pair must occur in to be judged."""

    min_docs: int = 3
    alpha: float = 1.25
    certain: float = 1.02


def _luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, r"[\x20-]", "")
    places = F.sequence(F.lit(1), F.length(digits))

    def weigh(place):
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when((F.length(digits) - place) % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.transform(places, weigh), F.lit(0), lambda a, x: a + x)
    return F.length(digits).between(16, 19) & (total % 10 == 0)


def _octets(value: Column) -> Column:
    def small(part):
        part = F.ltrim(part, F.lit("0"))
        return (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255"))

    return F.forall(F.split(value, r"\."), small)


def _dialled(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)


CHECKS = {"email": lambda v: F.lit(True), "ip": _octets, "card": _luhn, "phone": _dialled}


def _with(value: Column, made) -> Column:
    """``made(value)`` with the value worked out once; inside lambda functions an
    expression is evaluated anew for every element."""
    return F.transform(F.array(value), made)[0]


def _before(sizes: Column, first: Column, depth: int = DEPTH) -> Column:
    """For each size ``first`` and the sum of the sizes before it.

    An array that grows by an element is copied, so sums are taken in blocks, and those of
    blocks in blocks of blocks: the work of n sizes is that of n * BLOCK copies.
    """
    if not depth:
        start = F.struct(first.alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(
            sizes,
            start,
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
            lambda acc: acc["out"],
        )
    last = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
    numbers = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
    blocks = F.transform(numbers, lambda i: F.slice(sizes, i * BLOCK + 1, BLOCK))
    total = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda a, x: a + x)

    def summed(blocks):
        firsts = _with(F.transform(blocks, total), lambda totals: _before(totals, first, depth - 1))
        return F.flatten(F.zip_with(blocks, firsts, lambda block, at: _before(block, at, 0)))

    return _with(blocks, summed)


def _placed(matches: Column, pieces: Column, **more) -> Column:
    """``start, end, value`` of the matches, from the lengths of the pieces between them,
    and the columns that the functions ``more`` make of a value."""
    def placed(pairs):
        sizes = F.transform(pairs, lambda p: (F.length(p["piece"]) + F.length(p["match"])).cast("long"))
        befores = _with(sizes, lambda sizes: _before(sizes, F.lit(0).cast("long")))

        def place(pair, before):
            begin = before + F.length(pair["piece"])
            end = begin + F.length(pair["match"])
            made = [make(pair["match"]).alias(name) for name, make in more.items()]
            return F.struct(begin.alias("start"), end.alias("end"), pair["match"].alias("value"), *made)

        return F.zip_with(pairs, befores, place)

    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"))
    return _with(pairs, placed)


def _valid(spans: Column, kind: str) -> Column:
    valid = F.filter(spans, lambda s: CHECKS[kind](s["value"]))
    return F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"])).cast(SPANS)


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find_spans(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``base``: all valid spans in the order of kinds, then of place."""
    none = F.array().cast("array<string>")
    columns = rows.columns
    for kind in KINDS:
        matches = F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))
        rows = rows.withColumn(
            f"_{kind}", F.when(F.contains(F.col(text), F.lit(NEEDS[kind])), matches).otherwise(none)
        )
    parts = []
    for kind in KINDS:
        found = F.col(f"_{kind}")
        spans = _placed(found, F.split(F.col(text), PATTERNS[kind], -1))
        parts.append(F.when(F.size(found) > 0, _valid(spans, kind)).otherwise(F.array().cast(SPANS)))
    return rows.select(*columns, F.concat(*parts).alias("base"))


def _masked(text: Column) -> Column:
    """The text with zeros for the letters of its values, so that what is left of a word
    beside or inside one is no word. Of the kinds only e-mails hold letters."""
    pattern = PATTERNS["email"]
    matches = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.regexp_replace(m, "[A-Za-z]", "0")
    )
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), matches.alias("match"))
    parts = F.transform(pairs, lambda x: F.concat(x["piece"], F.coalesce(x["match"], F.lit(""))))
    return F.when(F.contains(text, F.lit(NEEDS["email"])), F.array_join(parts, "")).otherwise(text)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _terms(text: Column) -> Column:
    """The distinct words of a masked text."""
    return F.array_distinct(F.transform(_words(text), F.lower))


def _marked(text: Column, removed: Column) -> Column:
    """Places of the words of a masked text that are keys of the map ``removed``."""
    how = lambda word: F.try_element_at(removed, F.lower(word))
    places = _with(_words(text), lambda words: _placed(words, F.split(text, WORD, -1), removed=how))
    return F.filter(places, lambda s: s["removed"].isNotNull())


def revealing_terms(held: DataFrame, values: DataFrame, documents: DataFrame, settings: Settings, staging: Staging) -> DataFrame:
    """``entity, term, removed``: terms that exceed the threshold.

    ``held`` has a row for each document with values of ``values``: those, and its masked
    text. Counts are of documents, over the whole corpus. Every sum is taken map-side first,
    so a value or term of a third of all rows is a few rows per task.
    """
    pairs = (
        held.select("entities", F.explode(_terms(F.col("masked"))).alias("term"))
        .select(F.explode("entities").alias("entity"), "term")
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_both"))
    )
    pairs = staging.write(
        pairs.where(F.col("n_both") >= settings.min_docs).join(values, "entity"), "pairs"
    )
    words = _terms(_masked(F.col("text")))
    terms = documents.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = documents.agg(F.count("*").alias("n")).first().n
    # PMI is at most log2(N / n(t)), so a word of more documents than this tells nothing of
    # any value. Such words are paired with nearly all values; they go before the join.
    most = values.agg(F.max("n_entity").alias("most")).first().most or total
    limit = total / (total / most) ** (1 / settings.alpha) * (1 + 1e-9) if most else 0
    terms = staging.write(terms, "terms")
    common = staging.write(terms.where(F.col("n_term") > limit).select("term"), "common")
    pairs = pairs.join(common, "term", "left_anti")
    terms = terms.where(F.col("n_term") <= limit)
    content = F.log2(F.lit(total) / F.col("n_entity"))
    pmi = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    judged = pairs.join(terms, "term").select(
        "entity", "term", pmi.alias("pmi"), content.alias("content")
    )
    return judged.where((F.col("content") > 0) & (F.col("pmi") >= F.col("content") / settings.alpha)).select(
        "entity", "term", (F.col("pmi") >= F.col("content") / settings.certain).alias("removed")
    )


def _row(doc_id: Column, text: Column) -> Column:
    """Two hashes that stand for a document: with one, two of 10^10 would share theirs."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit("row"), doc_id, text).alias("b"))


def personal_data(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``row, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, base, terms``.

    ``spans`` lists ``kind:start:end`` of all spans, in code points, by kind (terms last)
    and place. A null text is empty. ``row`` holds two hashes of id and text: rows that repeat are
    one document in the counts and are each in the result. A null ``doc_id`` stays null;
    other columns are not looked at; an empty table gives no rows.
    """
    staging = Staging(documents.sparkSession, "pii")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("row", _row(F.col("doc_id"), F.col("text")))
    based = find_spans(texts)
    entities = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    masked = F.when(F.size("base") > 0, _masked(F.col("text")))
    found = staging.write(
        based.select("row", "doc_id", "base", entities.alias("entities"), masked.alias("masked")), "found"
    )
    holders = found.where(F.size("base") > 0).select("row", F.explode("entities").alias("entity")).distinct()
    values = holders.groupBy("entity").agg(F.count("*").alias("n_entity"))
    # No pair occurs in more documents than its value.
    values = staging.write(values.where(F.col("n_entity") >= settings.min_docs), "values")
    rows = holders.join(values, "entity").groupBy("row").agg(F.collect_list("entity").alias("entities"))
    masked = found.where(F.size("base") > 0).select("row", "masked")
    held = staging.write(masked.join(rows, "row").dropDuplicates(["row"]), "held")
    risky = staging.write(revealing_terms(held, values, texts, settings, staging), "risky")
    risks = (
        held.select("row", F.explode("entities").alias("entity"))
        .join(risky, "entity")
        .groupBy("row", "term")
        .agg(F.max("removed").alias("removed"))
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "removed"))).alias("removed"))
    )
    terms = held.select("row", "masked").join(risks, "row").select(
        "row", _marked(F.col("masked"), F.col("removed")).alias("terms")
    )
    shown = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform("base", lambda s: shown(s["kind"], s))
    more = F.transform(
        F.coalesce("terms", F.array().cast("array<struct<start:long,end:long,value:string,removed:boolean>>")),
        lambda s: shown(F.lit(TERM), s),
    )
    return (
        found.select("row", "doc_id", "base")
        .join(terms, "row", "left")
        .select(
            "row",
            "doc_id",
            *[_count(kind) for kind in KINDS],
            F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
            F.array_join(F.concat(base, more), ",").alias("spans"),
            "base",
            "terms",
        )
    )


def sanitised(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with their values replaced by ``[KIND]``, revealing terms by
    ``[WORD]``, and terms that give a value away for certain by nothing."""
    place = "array<struct<start:long,end:long,mark:string>>"
    base = F.transform(
        "base",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark"),
        ),
    )
    terms = F.transform(
        "terms",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.when(s["removed"], F.lit("")).otherwise(F.lit("[WORD]")).alias("mark"),
        ),
    )
    marks = F.sort_array(F.concat(base, F.coalesce(terms, F.array().cast(place))))
    text = F.coalesce(F.col("text"), F.lit(""))

    def step(acc, m):
        gap = F.greatest(m["start"] - acc["at"], F.lit(0)).cast("int")
        kept = F.substring(text, acc["at"].cast("int") + 1, gap)
        mark = F.when(m["start"] >= acc["at"], m["mark"]).otherwise(F.lit(""))
        out = F.concat(acc["out"], F.array(kept, mark))
        return F.struct(F.greatest(acc["at"], m["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(
        F.concat_ws("", acc["out"]), F.substring(text, acc["at"].cast("int") + 1, F.length(text))
    )
    rest_of = [c for c in documents.columns if c != "text"]
    rows = documents.select(packed(documents, rest_of), "text", _row(F.col("doc_id"), text).alias("key"))
    spans = found.select(F.col("row").alias("key"), "base", "terms").dropDuplicates(["key"])
    made = rows.join(spans, "key").withColumn("text", F.aggregate(marks, start, step, rest))
    return made.select("row.*", "text").select(*[f"`{c}`" for c in documents.columns])
