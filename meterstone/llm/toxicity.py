"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are turned into symbols: insult, threat, target, negation, reporting verb, other. Five small
weighted transducers read a clause's symbols: negation weakens the insults and threats that follow
within a few words, reported speech weakens those after a reporting verb, target notes whether
somebody is addressed, insult and threat give the weights. They are composed once into one
deterministic machine (``GRAMMAR``) that gives every clause a weight; single words count only through
the clause they stand in.

Insult stems beyond the few seeds and the scale of the score are learned from labelled rows that are
not held out (crc32 of the id as text, mod 5, is not 0). ``TOXIC_ROWS`` and ``OTHER_ROWS`` bound that
sample; it is taken by the order of a hash of the id, is the same in every run and is counted in
Spark; at most ``LEXICON`` stems and one row of five figures for each sampled text reach the driver.
Language, source, id and label are no inputs of a score. Scoring is a narrow pass over whole texts.

Results for odd input: null texts count as empty; empty texts and texts without a match get the base
score; every input row gives one row; without usable labels the seeds and a fixed scale are used;
labels of unknown documents and null labels or ids in the label table are ignored; of several labels of
one document the highest counts; a null id is not held out; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import arrow_map, id_type, map_text, slices

TOXIC_ROWS, OTHER_ROWS, LEXICON = 1500, 3000, 500
#: A stem is learned if this share of the toxic sample (LEAST_TEXTS texts at least) has it and the log odds of texts
#: with it reach LEAST_ODDS (strong), or else those of its rate among words reach LEAST_RATE (weak: stems that
#: clean texts have too, but less often).
SUPPORT, LEAST_TEXTS, LEAST_ODDS, LEAST_RATE = 0.03, 6, 3.0, 1.5
STEM_LENGTHS = (4, 5, 6)

# Fixed word lists of the grammar.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "worthless", "pathetic", "disgusting")
THREATS = ("kill", "hurt", "destroy", "beat", "burn", "shoot", "stab")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "this", "that", "these", "those")
NEGATIONS = ("not", "never", "no", "isn", "aren", "wasn", "don", "doesn", "nicht", "kein", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "claimed", "quoted", "called", "reported", "sagte", "dit", "dijo")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, WEAK_INSULT, WEAK_THREAT = range(8)
WORDS = re.compile(r"[^\W\d_]+")
CLAUSES = re.compile(r"[.,;:!?\n|]+")
SEEDS = {w: s for ws, s in ((INSULTS, INSULT), (THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in ws}

#: A transducer: (state, symbol) to (next state, symbol out, weight); symbols without an arc stay and weigh nothing. State 0 begins.
Transducer = dict[tuple[int, int], tuple[int, int, float]]


def negation(reach: int = 3) -> Transducer:
    """After a negation the next ``reach`` words are read with weakened insults and threats."""
    arcs: Transducer = {}
    for left in range(reach + 1):
        arcs[left, NEGATION] = (reach, NEGATION, 0.0)
        for s in (OTHER, TARGET, REPORT, INSULT, THREAT):
            weak = {INSULT: WEAK_INSULT, THREAT: WEAK_THREAT}.get(s, s) if left else s
            arcs[left, s] = (max(0, left - 1), weak, 0.0)
    return arcs


def reported() -> Transducer:
    """After a reporting verb the rest of the clause tells what somebody else said."""
    return {(0, REPORT): (1, REPORT, 0.0), (1, INSULT): (1, WEAK_INSULT, 0.0), (1, THREAT): (1, WEAK_THREAT, 0.0)}


def target() -> Transducer:
    """Notes that somebody is addressed, before or after; a threat needs that, an insult weighs more with it."""
    return {(0, TARGET): (1, TARGET, 0.0), (1, INSULT): (1, INSULT, 0.5), (1, WEAK_INSULT): (1, WEAK_INSULT, 0.1),
            (1, THREAT): (1, THREAT, 1.5), (1, WEAK_THREAT): (1, WEAK_THREAT, 0.3),
            (0, INSULT): (2, INSULT, 0.0), (2, TARGET): (1, TARGET, 0.5), (0, THREAT): (3, THREAT, 0.0), (3, TARGET): (1, TARGET, 1.5)}


def insult() -> Transducer:
    """The first insult of a clause weighs most; more of them add less."""
    return {(0, INSULT): (1, OTHER, 2.0), (1, INSULT): (1, OTHER, 0.5), (0, WEAK_INSULT): (0, OTHER, 0.4), (1, WEAK_INSULT): (1, OTHER, 0.1)}


def threat() -> Transducer:
    """An insult and a threat in one clause strengthen each other through ``target``; alone a threat weighs little."""
    return {(0, THREAT): (1, OTHER, 0.2), (1, THREAT): (1, OTHER, 0.1), (0, WEAK_THREAT): (0, OTHER, 0.0)}


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What ``a`` writes is read by ``b``; weights add. Only states that can be reached are kept."""
    number, queue, arcs = {(0, 0): 0}, [(0, 0)], {}
    for p, q in queue:
        for s in range(WEAK_THREAT + 1):
            p2, out, w = a.get((p, s), (p, s, 0.0))
            q2, out, v = b.get((q, out), (q, out, 0.0))
            if (p2, q2) not in number:
                number[p2, q2] = len(number)
                queue.append((p2, q2))
            if (p2, q2, out, w + v) != (p, q, s, 0.0):
                arcs[number[p, q], s] = (number[p2, q2], out, w + v)
    return arcs


def grammar() -> Transducer:
    out = negation()
    for part in (reported(), target(), insult(), threat()):
        out = compose(out, part)
    return out


GRAMMAR = grammar()


def clause_weight(symbols: list[int], strength: float = 1.0) -> float:
    state, total = 0, 0.0
    for s in symbols:
        state, _, w = GRAMMAR.get((state, s), (state, s, 0.0))
        total += w
    return total * strength


class Reader:
    """Symbols of words by seeds and learned stems (``word$`` for whole words), remembered for a task."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.known: dict[str, tuple[int, float]] = {}
        self.plain: set[str] = set()

    def look(self, word: str) -> tuple[int, float] | None:
        strength = max((self.stems.get(w, 0.0) for w in (word + "$", *(word[:n] for n in STEM_LENGTHS if len(word) >= n))), default=0.0)
        if strength > 0:
            return INSULT, strength
        return (SEEDS[word], 1.0) if word in SEEDS else None

    def features(self, text: str) -> tuple[float, float, float, float, float]:
        """Greatest clause weight, logs of the summed weights and of matched clauses, weight by length, 1 if any match is strong."""
        low = text.lower()
        every = WORDS.findall(low)
        words = set(every)
        for w in words - self.plain - self.known.keys():
            found = self.look(w)
            if found:
                self.known[w] = found
            else:
                self.plain.add(w)
        if len(self.plain) > 500_000:
            self.plain.clear()
        if not any(self.known[w][0] in (INSULT, THREAT) for w in words if w in self.known):
            return 0.0, 0.0, 0.0, 0.0, 0.0
        weights, strong = [], 0.0
        for clause in CLAUSES.split(low):
            marks = [self.known.get(w, (OTHER, 0.0)) for w in WORDS.findall(clause)]
            hit = [s for m, s in marks if m in (INSULT, THREAT)]
            if hit:
                weights.append(clause_weight([m for m, _ in marks], max(hit)))
                strong = max(strong, float(weights[-1] > 0.9))
        return max(weights), math.log1p(sum(weights)), math.log1p(len(weights)), min(5.0, 20 * sum(weights) / len(every)), strong


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(toxic, text) of at most TOXIC_ROWS + OTHER_ROWS labelled texts that are not held out; each text once."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    known = known.where(~held_out("doc_id")).withColumn("turn", F.xxhash64("doc_id"))
    some = lambda toxic, n: known.where(F.col("toxic") == toxic).orderBy("turn", "doc_id").limit(n)
    picked = F.broadcast(some(True, TOXIC_ROWS).unionByName(some(False, OTHER_ROWS)).select(F.col("doc_id").alias("label_id"), "toxic"))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return texts.join(picked, F.col("id") == F.col("label_id")).select("toxic", "text").dropDuplicates()


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, times): whole words with a mark, stems, and the empty term for all words of a text."""
    for part in slices(batches):
        terms, toxic, times = [], [], []
        for y, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            own: dict[str, int] = defaultdict(int)
            for w in WORDS.findall(text.lower()):
                own[""] += 1
                if len(w) > 2:
                    own[w + "$"] += 1
                    for n in STEM_LENGTHS:
                        if len(w) > n:
                            own[w[:n]] += 1
            terms += own
            times += own.values()
            toxic += [y] * len(own)
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "toxic": pa.array(toxic, pa.bool_()), "times": pa.array(times, pa.int64())})


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Stems and words that toxic texts have and others lack (strength 0.5 to 1) or have less often (0.2)."""
    size = rows.agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("n")).first()
    if not size.p or not size.n:
        return {}
    of = lambda toxic: F.sum(F.when(F.col("toxic") == toxic, F.col("times")).otherwise(0))
    count = (arrow_map(rows, _terms, "term string, toxic boolean, times long").groupBy("term")
             .agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("n"), of(True).alias("words_p"), of(False).alias("words_n")))
    count = count.where((F.col("term") == "") | (F.col("p") >= max(LEAST_TEXTS, math.ceil(SUPPORT * size.p))))
    count = count.withColumn("odds", F.log((F.col("p") + 0.5) / (size.p + 1)) - F.log((F.col("n") + 0.5) / (size.n + 1)))
    count = count.withColumn("raw", F.log((F.col("words_p") + 0.5) / (F.col("words_n") + 0.5)))
    rows = count.orderBy(F.col("term") != "", F.greatest(F.col("odds"), F.col("raw")).desc(), F.desc("p"), "term").limit(8 * LEXICON).collect()
    base = next((r.raw for r in rows if r.term == ""), 0.0)
    found = {r.term: r for r in rows if r.term and (r.odds >= LEAST_ODDS or r.p >= 2 * LEAST_TEXTS and r.odds > 0.7 and r.raw - base >= LEAST_RATE and not r.term.endswith("$"))}
    kept = {}
    for t, r in found.items():
        longer = any(u != t and u.startswith(t) and v.p >= 0.9 * r.p for u, v in found.items())
        shorter = any(t.rstrip("$").startswith(u) and u != t and 0.9 * v.p > r.p and v.odds >= LEAST_ODDS for u, v in found.items())
        if not longer and not shorter and len(kept) < LEXICON:
            kept[t] = min(1.0, 0.5 + (r.odds - LEAST_ODDS) / 6) if r.odds >= LEAST_ODDS else 0.2
    return kept


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * len(y) * np.r_[0, beta[1:]]
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * len(y) * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


#: The scale used without labels: base, greatest weight, sum, number, share, any.
FIXED_SCALE = (-3.0, 1.5, 0.5, 0.5, 1.0, 1.0)


def _features(reader: Reader, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        f = np.array([reader.features(t) for t in part.column(1).to_pylist()]).reshape(-1, 5)
        yield pa.RecordBatch.from_pydict({"toxic": part.column(0), **{f"f{k}": f[:, k] for k in range(5)}})


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], tuple[float, ...]]:
    """The stems and the scale."""
    from meterstone.llm.common import written

    rows = written(sample(docs, labels, id_col, text_col), "labelled")
    stems = learn_stems(rows)
    got = arrow_map(rows, lambda it: _features(Reader(stems), it), "toxic boolean, f0 double, f1 double, f2 double, f3 double, f4 double").collect()
    y = np.array([r.toxic for r in got], dtype=bool)
    if not y.any() or y.all():
        return stems, FIXED_SCALE
    return stems, tuple(fit(np.array([tuple(r)[1:] for r in got]), y).tolist())


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): one row a text."""
    stems, scale = learn(df, labels, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, beta = Reader(stems), np.array(scale)
        for part in slices(batches):
            f = np.array([reader.features(t) for t in part.column(1).to_pylist()]).reshape(-1, 5)
            yield pa.RecordBatch.from_pydict({"id": part.column(0), "score": 1 / (1 + np.exp(-np.clip(beta[0] + f @ beta[1:], -30, 30)))})

    out = map_text(df, id_col, text_col, work, f"id {id_type(df, id_col)}, score double").withColumnRenamed("id", id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``df`` without rows whose score reaches ``limit``: one narrow pass, all columns kept."""
    stems, scale = learn(df, labels, id_col, text_col)
    at = df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, beta = Reader(stems), np.array(scale)
        for part in slices(batches, at):
            f = np.array([reader.features(t or "") for t in part.column(at).to_pylist()]).reshape(-1, 5)
            yield part.filter(pa.array(1 / (1 + np.exp(-np.clip(beta[0] + f @ beta[1:], -30, 30))) < limit))

    return arrow_map(df, work, df.schema)
