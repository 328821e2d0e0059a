"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses and its words into classes: insult, threat, target,
negation, reported speech, other. Three transducers rewrite the classes: one
marks what stands in the scope of a negation, one what follows a verb of
reported speech, one what is aimed at a target. Composed, they form a single
deterministic machine that runs once over a clause; the symbols it accepts
carry weights, and a clause scores the sum of them. What a document's clauses
yield is turned into a probability by a logistic model.

Word lists start from SEEDS and are extended from labelled training documents:
words and stems that mark toxic documents beyond chance are taken as insults.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import materialise

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
SEEDS = {
    INSULT: "idiot idiots moron morons stupid scum loser losers trash clown pathetic disgusting worthless imbecile dumb "
            "vermin idioten dummkopf abschaum arschloch versager imbécile connard crétin ordure pourriture "
            "idiota imbécil estúpido basura escoria inútil",
    THREAT: "kill hurt destroy attack burn shoot stab töten verletzen vernichten tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours u they them he she du dich dir ihr sie euch tu toi vous te tú ti usted ustedes vosotros",
    NEGATION: "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ningún",
    REPORT: "said says wrote called claims claimed reported quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó",
}
#: Weight of what the grammar accepts.
WEIGHTS = {"insult": 1.0, "insult+target": 1.5, "insult+negation": 0.4, "insult+report": 0.5, "threat+target": 2.0, "threat": 0.3}
#: Words, weights and intercept come from all labelled documents; the bound of
#: earlier versions is gone and its name has no effect.
TRAIN_PER_LABEL = None
STEM = (3, 8)
#: A learned entry must be in so many toxic documents, reach this
#: log-likelihood ratio, and have this share of its documents toxic (as they
#: are, and with labels balanced).
LEAST_DOCS, LEAST_RATIO, LEAST_SHARE, MOST_ENTRIES = 3, 22.0, 0.95, 5_000
#: Lists are learned in rounds: each looks only at the toxic documents in
#: which the grammar accepts nothing yet, so rarer words stand out.
ROUNDS = 3

_CLAUSE = re.compile(r"[.!?;:,\n]+")
_WORD = re.compile(r"[\w']+")


class Transducer:
    """Deterministic: ``step(state, symbol) -> (state, symbol)``, start 0."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str]], alphabet: set[str]):
        self.arcs, self.alphabet = arcs, alphabet

    def compose(self, other: Transducer) -> Transducer:
        """First this one, then ``other`` on what it wrote."""
        number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
        while todo:
            a, b = todo.pop()
            for symbol in self.alphabet:
                to_a, between = self.arcs[a, symbol]
                to_b, out = other.arcs[b, between]
                if (to_a, to_b) not in number:
                    number[to_a, to_b] = len(number)
                    todo.append((to_a, to_b))
                arcs[number[a, b], symbol] = (number[to_a, to_b], out)
        return Transducer(arcs, self.alphabet)


def _scope(cue: str, changes: dict[str, str], alphabet: set[str], length: int | None) -> Transducer:
    """After ``cue`` the symbols of ``changes`` are rewritten for ``length``
    words (to the end of the clause if None)."""
    arcs = {}
    for state in range(2 if length is None else length + 1):
        for symbol in alphabet:
            if symbol == cue:
                to = 1 if length is None else length
            else:
                to = state if length is None else max(0, state - 1)
            arcs[state, symbol] = (to, changes.get(symbol, symbol) if state else symbol)
    return Transducer(arcs, alphabet)


def grammar() -> Transducer:
    words = {INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER}
    negation = _scope(NEGATION, {INSULT: "insult+negation", THREAT: OTHER}, words, 3)
    report = _scope(REPORT, {INSULT: "insult+report", THREAT: OTHER}, words | {"insult+negation"}, None)
    target = _scope(TARGET, {INSULT: "insult+target", THREAT: "threat+target"},
                    words | {"insult+negation", "insult+report"}, 4)
    return negation.compose(report).compose(target)


ACCEPTED = tuple(WEIGHTS)
FEATURES = (*(f"log {a}" for a in ACCEPTED), "best clause", "log total", "any insult", "per word")


class Scorer:
    """Features of a text from word lists: classes of whole words, and stems
    that make any word an insult."""

    def __init__(self, words: dict[str, str], stems: tuple[str, ...]):
        import ahocorasick
        self.words, self.stems = words, set(stems)
        self.lengths = sorted({len(s) for s in stems})
        self.machine = grammar().arcs
        # texts without any insult or threat need no parse
        self.cues = ahocorasick.Automaton()
        for w in [*stems, *(w for w, kind in words.items() if kind in (INSULT, THREAT))]:
            self.cues.add_word(w, 1)
        self.cues.make_automaton()

    def kind(self, word: str) -> str:
        found = self.words.get(word)
        if found is None and any(word[:n] in self.stems for n in self.lengths):
            return INSULT
        return found or OTHER

    def __call__(self, text: str | None) -> list[float]:
        import math
        low = text.lower() if text else ""
        if not len(self.cues) or next(self.cues.iter(low), None) is None:
            return [0.0] * len(FEATURES)
        counts, best, total, n_words, known = dict.fromkeys(ACCEPTED, 0), 0.0, 0.0, 0, {}
        for clause in _CLAUSE.split(low):
            state, score = 0, 0.0
            for word in _WORD.findall(clause):
                n_words += 1
                symbol = known.get(word)
                if symbol is None:
                    symbol = known[word] = self.kind(word)
                state, out = self.machine[state, symbol]
                if out in counts:
                    counts[out] += 1
                    score += WEIGHTS[out]
            best, total = max(best, score), total + score
        insults = sum(v for a, v in counts.items() if a.startswith(INSULT))
        return [*(math.log1p(counts[a]) for a in ACCEPTED), best, math.log1p(total), float(insults > 0),
                min(1.0, 20.0 * total / max(n_words, 1))]


def _feature_rows(words: dict[str, str], stems: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(words, stems)
        for batch in batches:
            x = [score(t.as_py()) for t in batch.column(1)]
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(x, pa.list_(pa.float64()))],
                                             names=[*kept.schema.names, "x"])
    return run


def _features(rows: DataFrame, words: dict[str, str], stems: tuple[str, ...], carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, x and the columns ``carry``) of (doc_id, text and these)."""
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *carry))
    return rows.select("doc_id", "text", *carry).mapInArrow(_feature_rows(words, stems), f"{fields}, x array<double>")


def seed_words() -> dict[str, str]:
    return {w: kind for kind, listed in SEEDS.items() for w in listed.split()}


def entry_counts(docs: DataFrame) -> DataFrame:
    """(e, n): how many of the rows (text) hold the word or stem ``e``. Repeats go
    within the row, so only counts are shuffled, never an entry of a document."""
    words = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_']+")),
                     lambda w: (F.length(w) >= 3) & ~w.rlike("[0-9]"))
    entries = F.flatten(F.transform(words, lambda w: F.array(
        F.concat(w, F.lit("$")), *[F.when(F.length(w) > k, F.substring(w, 1, k)) for k in range(STEM[0], STEM[1] + 1)])))
    return (docs.select(F.explode(F.array_distinct(entries)).alias("e")).where("e IS NOT NULL")
            .groupBy("e").agg(F.count(F.lit(1)).alias("n")))


def frequent_entries(toxic: DataFrame) -> DataFrame:
    """(e, a): entries in at least LEAST_DOCS toxic documents."""
    return entry_counts(toxic).where(F.col("n") >= LEAST_DOCS).withColumnRenamed("n", "a")


def learn_insults(toxic: DataFrame, n0: int, clean: DataFrame, frequent: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that mark toxic documents, from all toxic documents (doc_id,
    text) and their ``frequent`` entries; of the ``n0`` clean documents the counts
    ``clean`` (e, b) of each such entry. MOST_ENTRIES of them reach the driver."""
    n1 = toxic.count()
    if not n1 or not n0:
        return [], []
    entries = frequent.join(clean, "e", "left").withColumn("b", F.coalesce("b", F.lit(0)))
    p1, p0 = F.col("a") / n1, F.col("b") / n0
    p = (F.col("a") + F.col("b")) / (n1 + n0)

    def part(count, observed):
        return F.when(observed > 0, count * F.log(observed / p)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), p1) + part(F.col("b"), p0) + part(n1 - F.col("a"), (n1 - F.col("a")) / n1 * p / (1 - p + 1e-12))
                 + part(n0 - F.col("b"), (n0 - F.col("b")) / n0 * p / (1 - p + 1e-12)))
    found = (entries.where((p1 / (p1 + p0) >= LEAST_SHARE) & (F.col("a") / (F.col("a") + F.col("b")) >= LEAST_SHARE)).withColumn("g", ratio).where(F.col("g") >= LEAST_RATIO)
             .orderBy(F.desc("g"), "e").limit(MOST_ENTRIES).select("e", "a").collect())
    docs = {r.e: r.a for r in found}
    # A stem whose documents are nearly those of one longer entry says no more
    # than that entry; an entry below a kept stem says no more than the stem.
    words, kept = [], []
    for e in sorted(docs, key=lambda x: (x.endswith("$"), len(x))):
        body = e.rstrip("$")
        if any(body.startswith(s) for s in kept):
            continue
        if e.endswith("$"):
            words.append(body)
        elif not any(o != e and o.startswith(e) and docs[o] >= 0.9 * docs[e] for o in docs):
            kept.append(e)
    return words, kept


def learn(sample: DataFrame) -> tuple[dict[str, str], tuple[str, ...], list[float], float]:
    """Word classes, insult stems, weights and intercept from (doc_id, text,
    label)."""
    words, stems, left = seed_words(), (), sample.where("label = 1")
    # the clean documents are the same in all rounds, the frequent entries ever fewer
    calm = sample.where("label = 0")
    n0 = calm.count()
    frequent = materialise(frequent_entries(left), "toxicity-frequent")
    clean = materialise(entry_counts(calm).withColumnRenamed("n", "b").join(frequent, "e", "left_semi"), "toxicity-clean-entries")
    for _ in range(ROUNDS):
        more, found = learn_insults(left, n0, clean, frequent)
        words |= dict.fromkeys(more, INSULT)
        stems += tuple(found)
        if not more and not found:
            break
        left = materialise(left.join(
            _features(left, words, stems).where(F.get("x", FEATURES.index("any insult")) > 0)
            .select("doc_id"), "doc_id", "left_anti"), "toxicity-unexplained")
        frequent = frequent_entries(left)
    fallback = [0.0] * len(FEATURES)
    fallback[FEATURES.index("any insult")], fallback[FEATURES.index("best clause")] = 2.0, 1.0
    if sample.agg(F.countDistinct("label")).first()[0] != 2:
        return words, stems, fallback, -3.0
    data = materialise(_features(sample, words, stems).join(sample.select("doc_id", "label"), "doc_id").select(
        array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label")), "toxicity-train")
    fit = LogisticRegression(regParam=0.003, standardization=False, maxIter=60,
                             lowerBoundsOnCoefficients=_not_negative()).fit(data)
    return words, stems, [float(w) for w in fit.coefficients], float(fit.intercept)


def _not_negative():
    """What the grammar accepts can only make a document more toxic."""
    from pyspark.ml.linalg import Matrices
    return Matrices.dense(1, len(FEATURES), [0.0] * len(FEATURES))


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = 0.3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted and the columns ``carry`` of ``docs``),
    one row per row of ``docs``.

    ``held_out`` is a Column over doc_id; labels of such rows are never read.
    Labels other than 0 and 1 are ignored. Null and empty texts have the
    score of a text in which the grammar accepts nothing; null ids are kept,
    with held_out false. Without labels of both kinds the seed words and fixed
    weights decide. Repeated rows are scored alike; of a labelled id's texts the
    smallest is learned from. Other columns are not read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("label IN (0, 1)").where(~held_out).groupBy("doc_id").agg(F.max("label").alias("label")))
    sample = materialise(rows.select("doc_id", "text").where("text IS NOT NULL").join(known, "doc_id")
                         .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")), "toxicity-labelled")
    words, stems, weights, intercept = learn(sample)
    x = _features(rows, words, stems, carry)
    raw = sum((F.get("x", i) * w for i, w in enumerate(weights)), F.lit(intercept))
    score = 1 / (1 + F.exp(-raw))
    return x.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"),
                    (score >= threshold).cast("int").alias("predicted"), *carry)
