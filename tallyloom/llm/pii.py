"""Personal data: patterns, and terms that reveal the protected entities they stand beside.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers: the protected entities. A term is a word of
letters among the eight words before or after an entity. From the whole corpus, with n(c, t) occurrences of term t beside entity
c, n(t) occurrences of t anywhere, and p(c) the entity's share of all words, the term discloses ``PMI(c; t) / IC(c)`` of the
entity: 1 + log p(c | t) / -log p(c), where 1 means that the term always stands beside it. p(c | t) is smoothed by ``PRIOR``
occurrences of t dealt out as all words are: (n(c, t) + PRIOR * p(c)) / (n(t) + PRIOR). So no pair is left out for being rare: a
term seen once, beside an entity seen once, reaches 0.9 in a corpus of 60,000 words or more, one seen twice in 2,000. Terms that
reach ``DISCLOSED`` are generalised wherever they stand beside the entity.

Defined results: null texts have no spans and stay null. Spans are in code points, end exclusive. Repeated rows have equal
spans. Where spans overlap, the union is replaced by the label of the first. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.bpe_codec import column_batches, extended, with_columns
from tallyloom.session import settle

KINDS = ("email", "ip", "card", "phone", "term")
PRIOR, DISCLOSED = 2.0, 0.9
NEAR_WORDS = 8
#: Characters in which the words before an entity are looked for at first; twice as many each time that is too few.
FIRST_LOOK = 400
SHORTEST = 3
#: Pairs of entity and term that one pass over the texts is given at most; more pairs take more passes.
PAIRS_PER_PASS = 200_000
#: Words that one task counts before it hands its counts on.
COUNTED = 500_000
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile("[0-9]")
# A match can only begin at the first digit of a run, so no run is tried from its middle.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"\S+")
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind, then by start."""
    if not text:
        return []
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
    return found


def term_of(word: str) -> str | None:
    term = word.lower()
    if not term.isalpha():
        term = EDGES.sub("", term)
    return term if len(term) >= SHORTEST and term.isalpha() else None


def words_before(text: str, start: int) -> list[tuple[str, int]]:
    """The last ``NEAR_WORDS`` words before a place, however long they are."""
    width = FIRST_LOOK
    while True:
        low = max(0, start - width)
        found = [(m[0], m.start()) for m in WORD.finditer(text, low, start)]
        if low and found and found[0][1] == low and not text[low - 1].isspace():
            found = found[1:]  # its beginning is further away
        if len(found) >= NEAR_WORDS or not low:
            return found[-NEAR_WORDS:]
        width *= 2


def surroundings(text: str, spans: list[tuple[str, int, int]]):
    """For each entity: its name, and (term, start, end) of the words beside it."""
    taken = sorted((s, e) for _, s, e in spans)
    for kind, start, end in spans:
        before = words_before(text, start)
        near = before + [(m[0], m.start()) for m in islice(WORD.finditer(text, end), NEAR_WORDS)]
        low, high = (near[0][1], near[-1][1] + len(near[-1][0])) if near else (start, end)
        near_taken = [(s, e) for s, e in taken if e > low and s < high] if len(taken) > 1 else taken
        terms = []
        for word, at in near:
            term = term_of(word)
            if term is not None:
                inner = at + word.lower().find(term) if len(word.lower()) == len(word) else at
                stop = inner + len(term) if len(word.lower()) == len(word) else at + len(word)
                if all(stop <= s or inner >= e for s, e in near_taken):
                    terms.append((term, inner, stop))
        yield f"{kind}:{text[start:end].lower()}", terms


def without_entities(text: str | None) -> str:
    """A text with a space in place of each entity: a word that is glued to one is a word of its own here, as it is beside it."""
    spans = base_spans(text)
    if not spans:
        return text or ""
    parts, at = [], 0
    for start, end in sorted((s, e) for _, s, e in spans):
        parts += [text[at:start], " "] if start > at else []
        at = max(at, end)
    return "".join([*parts, text[at:]])


def beside(docs: DataFrame) -> DataFrame:
    """``entity``, ``term`` (null: the entity itself) and ``n``; a term between two places of one entity counts once."""

    def run(batches):
        for batch, texts in column_batches(batches, "text"):
            counts: Counter = Counter()
            for text in texts:
                if spans := base_spans(text):
                    found = list(surroundings(text, spans))
                    counts.update((entity, None) for entity, _ in found)
                    counts.update((entity, t) for entity, t, _ in {(entity, t, start) for entity, terms in found for t, start, _ in terms})
            if counts:
                entity, term = zip(*counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entity, pa.string()), pa.array(term, pa.string()), pa.array(list(counts.values()), pa.int64())], ["entity", "term", "n"])

    return docs.select("text").mapInArrow(run, "entity string, term string, n bigint")


def occurrences(docs: DataFrame) -> DataFrame:
    """``term`` and ``total``: occurrences in all documents, entities cut out; term null: all words."""

    def run(batches):
        counts, words = Counter(), 0

        def hand_on():
            found: Counter = Counter()
            for word, n in counts.items():
                term = term_of(word)
                if term is not None:
                    found[term] += n
            found[None] = words
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

        for _, texts in column_batches(batches, "text"):
            for text in texts:
                split = without_entities(text).split()
                words += len(split)
                counts.update(split)
            if len(counts) > COUNTED:
                yield hand_on()
                counts, words = Counter(), 0
        yield hand_on()

    return docs.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("total"))


def disclosing_terms(docs: DataFrame, disclosed: float = DISCLOSED, prior: float = PRIOR) -> DataFrame:
    """``entity``, ``term`` and ``share`` of the entity's information that the term gives away."""
    counts = settle(beside(docs).groupBy("entity", "term").agg(F.sum("n").alias("n")))
    # The null term, all words, is among them: every entity has a row with it.
    terms = counts.select(F.col("term").alias("__asked")).distinct()
    totals = occurrences(docs)
    totals = settle(totals.join(terms, totals["term"].eqNullSafe(terms["__asked"]), "left_semi"))
    words = totals.where("term is null").agg(F.sum("total")).first()[0] or 1
    entities = counts.where("term is null").select("entity", F.col("n").alias("n_entity"))
    pairs = counts.where("term is not null").join(entities, "entity").join(totals, "term")
    # An entity that is all of the corpus has no information to give away.
    known = F.least(F.col("n_entity") / words, F.lit(1.0))
    information, given = -F.log(known), (F.col("n") + prior * known) / (F.col("total") + prior)
    share = F.when(information > 0, 1 + F.log(F.least(given, F.lit(1.0))) / information)
    return pairs.select("entity", "term", share.alias("share")).where(F.col("share") >= disclosed)


def find(docs: DataFrame, disclosed: float = DISCLOSED) -> DataFrame:
    """``docs`` with ``spans``, an array of (kind, start, end): those of the patterns by kind and start, then the terms."""
    return _passes(docs, disclosed, clean=False)


def _passes(docs: DataFrame, disclosed: float, clean: bool) -> DataFrame:
    """``docs`` with ``spans``; ``clean``: with labels in ``text`` in place of them, and ``spans`` only if there were several passes."""
    pairs = settle(disclosing_terms(docs, disclosed).select("entity", "term"))
    passes = max(1, -(-pairs.count() // PAIRS_PER_PASS))
    out = docs
    for k in range(passes):
        # By pair, so that a hot entity is dealt over the passes too; a pass holds about PAIRS_PER_PASS pairs.
        part: dict[str, set[str]] = {}
        for r in pairs.where(F.pmod(F.xxhash64("entity", "term"), F.lit(passes)) == k).toLocalIterator():
            part.setdefault(r["entity"], set()).add(r["term"])
        out = _mark(out, docs.sparkSession.sparkContext.broadcast(part), first=k == 0, clean=clean and k == passes - 1)
    return out


def _mark(docs: DataFrame, shared, first: bool, clean: bool) -> DataFrame:
    """One pass; ``clean``: its spans are replaced at once, since every mapInArrow of a task takes a Python worker of its own."""

    def run(batches):
        disclosing = shared.value
        for batch, texts in column_batches(batches, "text"):
            earlier = [[]] * len(texts) if first else [[(s["kind"], s["start"], s["end"]) for s in spans] for spans in batch.column("spans").to_pylist()]
            out = []
            for text, marked in zip(texts, earlier):
                spans = base_spans(text)
                terms = {s for s in marked if s[0] == "term"}
                if spans and disclosing:
                    for entity, near in surroundings(text, spans):
                        known = disclosing.get(entity, ())
                        terms.update(("term", s, e) for t, s, e in near if t in known)
                found = [{"kind": k, "start": s, "end": e} for k, s, e in spans + sorted(terms)]
                out.append(replaced(text, found) if clean else found)
            yield with_columns(batch, text=pa.array(out, pa.string())) if clean else with_columns(batch, spans=pa.array(out, ARROW_SPANS))

    return docs.mapInArrow(run, extended(docs, T.StructField("text", T.StringType()) if clean else T.StructField("spans", SPANS)))


def replaced(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    parts, at, end = [], 0, -1
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] < end:
            end = max(end, s["end"])
            at = end
            continue
        parts += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = end = s["end"]
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by labels such as <EMAIL>; ``n_chars``, if there, is counted again."""
    ours = docs.withColumnRenamed("spans", "__own_spans")
    clean = _passes(ours, DISCLOSED, clean=True).drop("spans").withColumnRenamed("__own_spans", "spans")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return clean.select(*docs.columns)
