"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negator, report verb, filler, other). Three small
transducers are composed: negation turns an insult right after a negator into a negated one, reported
speech turns insults after a verb of saying into quoted ones, and the target transducer joins insults
and threats with the person addressed. Each final symbol has a weight; a clause scores by its
strongest match and a text by 1 - product(1 - clause score).

The insult lexicon holds seeds and words or word beginnings learnt from labels: those whose texts are
nearly all toxic. The weight of a negated insult is learnt likewise, from a prior. At most
``FIT_ROWS`` labelled rows are used, chosen by a hash of doc_id, none of them held out
(crc32(doc_id) mod 4 = 2). Everything else runs over every text as a whole.

Defined cases: a null or empty text scores ``FLOOR``; a null doc_id is not held out; labels that are
null take no part, of repeated labels the largest counts; without labels the seeds remain.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.llm import common

FIT_ROWS = 20_000
THRESHOLD = 0.3
FLOOR = 0.01

WORD = re.compile(r"[^\W\d_]+")
_PIECE = re.compile(r"[^\W\d_]+|[.!?;:\n]+")

# Lexicons of the grammar, in English, German, French and Spanish.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile cretin scum scumbag loser losers trash worthless pathetic disgusting "
    "stupid dumbass clown bastard bitch asshole retard vermin filth degenerate "
    "dummkopf vollidiot trottel arschloch schwachkopf missgeburt abschaum wichser "
    "connard connasse salaud salope abruti crétin débile enculé ordure "
    "imbécil estúpido estúpida gilipollas cabrón pendejo basura escoria".split())
THREATS = frozenset(
    "kill murder strangle slaughter stab shoot töten umbringen ermorden erwürgen "
    "tuer égorger étrangler assassiner matar asesinar estrangular".split())
TARGETS = frozenset(
    "you your yours yourself u ye dich dir dein deine euch eure toi vous votre ti tú usted ustedes vosotros".split())
NEGATORS = frozenset("not never isn aren wasn cannot nicht kein keine keinen niemals jamais nunca jamás".split())
REPORTS = frozenset(
    "said says told called quoted wrote reported alleged sagte schrieb nannte zitierte dit écrit appelé cité "
    "dijo escribió llamó citó".split())
FILLERS = frozenset("a an the so such very really that ein eine so ganz un une très el la un una tan muy".split())

PREFIX_LENGTHS = (4, 5, 6, 7, 8, 9)
PRIOR = 1.0  # pseudo-texts at the base rate behind every count
WORD_RATE, WORD_TEXTS = 0.8, 5  # toxic share and toxic texts that make a word an insult
STEM_RATE, STEM_TEXTS = 0.95, 8  # the same for a beginning
SEED_TEXTS = (20.0, 1.0)  # counts of a seed the sample does not show
NEGATED_PRIOR, NEGATED_PRIOR_TEXTS = 0.3, 10.0

SYMBOLS = "itnrkaw$"  # insult, target, negator, report verb, threat, filler, other word, end of clause
State = object


class Transducer:
    """A deterministic transducer: (state, symbol) -> (state, symbol); unlisted arcs lead to
    ``otherwise`` of the state and copy the symbol."""

    def __init__(self, arcs: dict[tuple, tuple], otherwise: dict[State, State], start: State):
        self.arcs, self.otherwise, self.start = arcs, otherwise, start

    def step(self, state: State, symbol: str) -> tuple[State, str]:
        return self.arcs.get((state, symbol)) or (self.otherwise[state], symbol)

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes, the other reads."""
        arcs, seen, todo = {}, set(), [(self.start, other.start)]
        while todo:
            state = todo.pop()
            if state in seen:
                continue
            seen.add(state)
            for symbol in SYMBOLS:
                mine, middle = self.step(state[0], symbol)
                theirs, out = other.step(state[1], middle)
                arcs[state, symbol] = ((mine, theirs), out)
                todo.append((mine, theirs))
        return Transducer(arcs, {}, (self.start, other.start))


# A filler between negator and insult keeps the negation: "not a ...".
NEGATION = Transducer(
    {("-", "n"): ("not", "w"), ("not", "n"): ("not", "w"), ("not", "a"): ("not", "a"),
     ("not", "i"): ("-", "ni"), ("not", "k"): ("-", "w")},
    {"-": "-", "not": "-"}, "-")
REPORTED = Transducer(
    {("-", "r"): ("said", "w"), ("said", "i"): ("said", "qi"), ("said", "ni"): ("said", "w"),
     ("said", "k"): ("said", "w"), ("said", "$"): ("-", "$"), ("-", "$"): ("-", "$")},
    {"-": "-", "said": "said"}, "-")
# A threat needs its target, before or after it; an insult weighs more with one.
TARGETED = Transducer(
    {("-", "t"): ("you", "w"), ("you", "i"): ("you", "ti"), ("you", "k"): ("you", "tk"),
     ("-", "k"): ("threat", "w"), ("threat", "t"): ("you", "tk"),
     ("you", "$"): ("-", "$"), ("threat", "$"): ("-", "$")},
    {"-": "-", "you": "you", "threat": "threat"}, "-")
GRAMMAR = NEGATION.then(REPORTED).then(TARGETED)

WEIGHTS = {"ti": 1.0, "i": 0.95, "qi": 0.6, "tk": 0.9, "ni": NEGATED_PRIOR}


class Scorer:
    """Scores texts with the lexicon {word or "beginning*": (toxic, clean texts)}. A word is an insult
    if it or a beginning of it is, unless the longest beginning that was seen is mostly clean."""

    _MEMO = 200_000

    def __init__(self, lexicon: dict[str, tuple[float, float]], base: float, weights: dict[str, float]):
        self.lexicon, self.base, self.weights = lexicon, base, weights
        self.memo: dict[str, float] = {}

    def insult(self, word: str) -> float:
        found = self.memo.get(word)
        if found is None:
            found, longest = 0.0, 1.0
            for feature in [*(word[:k] + "*" for k in PREFIX_LENGTHS if k < len(word)), word]:
                if feature in self.lexicon:
                    bad, good = self.lexicon[feature]
                    longest = rate = (bad + PRIOR * self.base) / (bad + good + PRIOR)
                    enough, least = (STEM_TEXTS, STEM_RATE) if feature[-1] == "*" else (WORD_TEXTS, WORD_RATE)
                    if bad >= enough and rate >= least:
                        found = max(found, rate)
            found = found if longest >= 0.5 else 0.0
            if len(self.memo) >= self._MEMO:
                self.memo.clear()
            self.memo[word] = found
        return found

    def symbol(self, word: str) -> str:
        if self.insult(word):
            return "i"
        for symbol, words in (("t", TARGETS), ("n", NEGATORS), ("r", REPORTS), ("k", THREATS), ("a", FILLERS)):
            if word in words:
                return symbol
        return "w"

    def score(self, text: str) -> float:
        text = text.lower()
        vocabulary = set(WORD.findall(text))
        if not any(self.insult(w) for w in vocabulary) and vocabulary.isdisjoint(THREATS):
            return FLOOR
        clean = math.log1p(-FLOOR)
        for clause in self.clauses(text):
            clean += math.log1p(-min(clause, 0.999))
        return min(1.0, 1.0 - math.exp(clean))

    def clauses(self, text: str) -> Iterator[float]:
        state, best = GRAMMAR.start, 0.0
        for piece in _PIECE.findall(text):
            word = piece[0].isalpha()
            state, out = GRAMMAR.step(state, self.symbol(piece) if word else "$")
            if out in self.weights:
                strength = 1.0 if out == "tk" else self.insult(piece)
                best = max(best, strength * self.weights[out])
            if not word:
                if best:
                    yield best
                best = 0.0
        if best:
            yield best


def features(text: str) -> set[str]:
    """What the lexicon is learnt from: words, their beginnings, and words after a negator."""
    words = WORD.findall(text.lower())
    found = set(words)
    found |= {w[:k] + "*" for w in list(found) for k in PREFIX_LENGTHS if k < len(w)}
    return found | {"!" + b for a, b in zip(words, words[1:], strict=False) if a in NEGATORS}


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


_IN_WORD = common.byte_mask(b" \t\n\x0b\x0c\r")


def copy_group(text: str) -> int:
    """The smallest hash of three consecutive words: equal for copies, and for most near copies."""
    words = common.word_hashes(text.lower().encode("utf-8", "surrogatepass"), _IN_WORD)
    if len(words) >= 3:
        with np.errstate(over="ignore"):
            words = common.mix64(words[:-2] + np.uint64(3) * words[1:-1] + np.uint64(5) * words[2:])
    return int(words.min() >> np.uint64(1)) if len(words) else 0


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Scorer:
    """The scorer fitted to the labelled rows that are not held out, ``fit_rows`` at most."""
    sample = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(remainder(F.col("doc_id")) != 2)
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    rows = docs.select("doc_id", common.text_or_empty().alias("text")).join(
        F.broadcast(sample), "doc_id")  # at most fit_rows pairs of an id and a flag

    def grouped(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups = [copy_group(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(groups, pa.int64())], ["doc_id", "text", "toxic", "group"])

    # Copies would make every word of a toxic text look toxic: one text of each group counts.
    rows = common.per_batch(
        rows.select(F.col("doc_id").cast("bigint"), "text", "toxic"), grouped,
        "doc_id bigint, text string, toxic boolean, group bigint",
    ).groupBy("group").agg(F.min(F.struct("doc_id", "toxic", "text")).alias("row")).select("row.*")

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, toxic = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = features(text)
            words += found
            words.append("")  # counts the texts
            toxic += [label] * (len(found) + 1)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic)], ["feature", "toxic"])

    counts = common.per_batch(rows.select("text", "toxic"), counted, "feature string, toxic boolean").groupBy(
        "feature").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    counts = common.written(counts, "toxic-counts")
    total = counts.filter("feature = ''").first()
    bad, good = (total["bad"], total["good"]) if total else (0, 0)
    base = bad / (bad + good) if bad + good else 0.0
    rate = (F.col("bad") + PRIOR * base) / (F.col("bad") + F.col("good") + PRIOR)
    words = counts.filter((F.col("feature") != "") & ~F.col("feature").startswith("!"))
    stems = words.filter((F.col("bad") >= WORD_TEXTS) & (rate >= WORD_RATE))
    # Whatever was seen below a stem corrects it. The words of a bounded sample bound both.
    beginnings = F.array(F.col("feature"), *(F.concat(F.substring("feature", 1, k), F.lit("*"))
                                             for k in PREFIX_LENGTHS))
    below = words.withColumn("stem", F.explode(F.array_distinct(beginnings))).join(
        stems.select(F.col("feature").alias("stem")), "stem")
    lexicon = {r["feature"]: (r["bad"], r["good"])
               for r in below.select("feature", "bad", "good").distinct().collect()}
    seen = {r["feature"] for r in words.filter(F.col("feature").isin(sorted(INSULTS))).filter(
        F.col("bad") + F.col("good") >= WORD_TEXTS).select("feature").collect()}
    for word in INSULTS - seen:
        lexicon.setdefault(word, SEED_TEXTS)
    scorer = Scorer(lexicon, base, dict(WEIGHTS))
    hits = [w for w in lexicon if not w.endswith("*") and scorer.insult(w)]
    negated = counts.filter(F.col("feature").isin(["!" + w for w in hits])).agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    bad, good = negated["bad"] or 0, negated["good"] or 0
    scorer.weights["ni"] = (bad + NEGATED_PRIOR * NEGATED_PRIOR_TEXTS) / (bad + good + NEGATED_PRIOR_TEXTS)
    return scorer


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id and score; every text is scored as a whole."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [scorer.score(t.as_py()) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return common.per_batch(docs.select(F.col("doc_id").cast("bigint"), common.text_or_empty()), score,
                            "doc_id bigint, score double")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows the scorer rejects, all columns kept by position."""
    scorer, text = learn(docs, labels), docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([scorer.score(t.as_py() or "") < THRESHOLD for t in batch.column(text)],
                                     pa.bool_()))

    return common.per_batch(docs, keep, docs.schema)


def rate_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scorer = learn(docs, labels)
    return scored(docs, scorer).select(
        "doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
