"""Personal data: base patterns and a linear-chain conditional random field.

The base patterns give e-mail, ip, card and phone spans. The tagger adds spans of secrets, names and
numbers of persons: a conditional random field over word-shape features, trained from the small table
in ``pii_labels`` by gradient ascent on its likelihood in log space, and decoded by Viterbi in numpy
batches. All tokens of a text are decoded, but for those of base spans, in blocks that overlap.

Results for odd input: null texts count as empty; every input row gives one row, repeated ids
included; an empty text has no spans; very long texts are read whole, and every pattern runs in time
linear in the text; other columns are ignored. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import id_type, map_text, slices
from meterstone.llm.pii_labels import lines

KINDS = ("email", "ip", "card", "phone", "secret", "name", "id")
BASE = KINDS[:4]

# The contract's patterns, written so that each runs in linear time: a run of digits that fails is not tried again from within.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            end = max(end, start)
        at = text.find("@", max(at + 1, found.end() if found else 0))


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out)


TOKEN = re.compile(r"[^\W_]+(?:[-'][^\W_]+)*|[^\w\s]|_")
#: Words that tell what follows, in four languages (fixed values).
CUES = frozenset("""token key secret password passwd apikey api bearer access jeton clave contraseña schlüssel passwort kennwort passe
name mr mrs ms dr mme frau herr monsieur madame señora señor contact ansprechpartner author customer dear sincerely signed by led from with said ask von par por appelle llamo
passport account tax ssn iban no number id social security national licence policy kontonummer ausweisnummer steuernummer numéro passeport compte número cuenta dni""".split())
#: Cues that open sentences too and count only in small letters.
SMALL = frozenset("by led from with said ask von par por number no id".split())
#: Words before a word in which cues count.
REACH = 4
#: Tokens of a block to decode, tokens decoded with it on either side, and words whose class is kept.
BLOCK, LAP, KEPT = 512, 32, 300_000
OUT = 0
TAGS = ("O", *(f"{p}-{k}" for k in KINDS[4:] for p in "BI"))


def cue_of(word: str) -> str:
    """The cue that a word is, or nothing."""
    low = word.lower()
    return low if low in CUES and (word == low or low not in SMALL) else ""


_CLASSES = str.maketrans({chr(c): "d" if chr(c).isdigit() else "X" if chr(c).isupper() else "x" for c in range(128) if chr(c).isalnum()})
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Character classes, runs joined; hexadecimal-like and mixed words are told apart by length class."""
    if len(word) <= 64:  # most words: letters only, then ASCII
        if word.isalpha() and word.islower():
            return "x"
        if word.isascii():
            body = _RUNS.sub(r"\1", word.translate(_CLASSES))
            digits, body = "d" in body, body if len(body) <= 4 else "mix"
            return f"{body}:{min(3, len(word) // 6)}" if digits else body
    return _shape(word)


def _shape(word: str) -> str:
    out = []
    for c in word[:64]:
        k = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    body = "".join(out) if len(out) <= 4 else "mix"
    return f"{body}:{min(3, len(word) // 6)}" if any(c.isdigit() for c in word) else body


def features(words: list[str], i: int) -> list[str]:
    """Word-shape features of place i: own shape, its neighbours' shapes and cue words nearby."""
    w = words[i]
    out = ["bias", "s0=" + shape(w)]
    for k in (-1, 1):
        out.append(f"s{k}=" + (shape(words[i + k]) if 0 <= i + k < len(words) else "edge"))
    for k in range(1, REACH + 1):
        before = cue_of(words[i - k]) if i >= k else ""
        if before:
            out.append("cue=" + before)
    if cue_of(w):
        out.append("is=" + cue_of(w))
    if hexadecimal(w):
        out.append("hex")
    if rich(w):
        out.append("rich")
    if w in words[max(0, i - 1):i] or w in words[i + 1:i + 2]:
        out.append("again")
    return out


def hexadecimal(word: str) -> bool:
    return word.isascii() and len(word) >= 16 and bool(re.fullmatch(r"[0-9a-fA-F]+", word))


def rich(word: str) -> bool:
    """Whether a long word has letters and digits and few repeats among its characters, as drawn ones do."""
    return len(word) >= 12 and len(set(word[:64])) >= 8 and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """The conditional random field: one weight for each feature and tag, one for each pair of tags."""

    def __init__(self, table: list[str] | None = None, rounds: int = 100, rate: float = 0.3, ridge: float = 2e-2):
        rows = [self.parse(line) for line in (lines() if table is None else table)]
        self.number: dict[str, int] = {}
        seen = [[[self.number.setdefault(f, len(self.number)) for f in features(w, i)] for i in range(len(w))] for w, _ in rows]
        n, size = len(TAGS), np.array([len(w) for w, _ in rows])
        self.emit, self.move = np.zeros((len(self.number), n)), np.zeros((n, n))
        for a, tag in enumerate(TAGS):  # an inner tag follows only its own kind; such moves keep this weight
            for b, to in enumerate(TAGS):
                if to[0] == "I" and tag[2:] != to[2:]:
                    self.move[a, b] = -1e4
        self.start = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])
        # all lines at once: places of padded lines, a row of features for each place
        inside = np.arange(size.max()) < size[:, None]
        feats = np.zeros((int(size.sum()), len(self.number)))
        for k, own in enumerate(f for line in seen for f in line):
            np.add.at(feats[k], own, 1.0)
        tags = np.zeros(inside.shape, dtype=int)
        tags[inside] = np.concatenate([t for _, t in rows])
        truth, pairs = np.zeros((len(feats), n)), np.zeros((n, n))
        truth[np.arange(len(feats)), tags[inside]] = 1
        np.add.at(pairs, (tags[:, :-1][inside[:, 1:]], tags[:, 1:][inside[:, 1:]]), 1)
        square_e, square_m = np.full_like(self.emit, 1e-8), np.full_like(self.move, 1e-8)
        for _ in range(rounds):
            share, moves = self.expected(feats @ self.emit, inside)
            up_e = feats.T @ (truth - share) - ridge * self.emit
            up_m = np.where(self.move > -1e3, pairs - moves - ridge * self.move, 0.0)
            square_e += up_e ** 2
            square_m += up_m ** 2
            self.emit += rate * up_e / np.sqrt(square_e)
            self.move += np.where(self.move > -1e3, rate * up_m / np.sqrt(square_m), 0.0)
        self.learned()

    def expected(self, scores: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of every tag at every place and expected number of every move (forward and backward sums)."""
        e = np.zeros((*inside.shape, len(TAGS)))
        e[inside] = scores
        ahead, back = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = self.start + e[:, 0]
        for i in range(1, inside.shape[1]):
            step = e[:, i] + logsum(ahead[:, i - 1][:, :, None] + self.move, 1)
            ahead[:, i] = np.where(inside[:, i, None], step, ahead[:, i - 1])
        for i in range(inside.shape[1] - 2, -1, -1):
            step = logsum(self.move + (e[:, i + 1] + back[:, i + 1])[:, None], 2)
            back[:, i] = np.where(inside[:, i + 1, None], step, 0.0)
        total = logsum(ahead[:, -1], 1)
        share = np.exp(ahead + back - total[:, None, None])[inside]
        both = ahead[:, :-1, :, None] + self.move + (e[:, 1:] + back[:, 1:])[:, :, None] - total[:, None, None, None]
        return share, np.exp(both)[inside[:, 1:]].sum(axis=0)

    @staticmethod
    def parse(line: str) -> tuple[list[str], list[int]]:
        words, tags = [], []
        for kind, inside, outside in re.findall(r"\[(secret|name|id):([^\]]*)\]|((?:(?!\[(?:secret|name|id):).)+)", line):
            for k, w in enumerate(TOKEN.findall(inside or outside)):
                words.append(w)
                tags.append(TAGS.index(("I-" if k else "B-") + kind) if kind else OUT)
        return words, tags

    def learned(self) -> None:
        """Tables of the weights by class of word (shape, cue, hexadecimal), so that a word is looked at once."""
        self.classes: dict[tuple, int] = {}
        self.of: dict[str, int] = {}
        self.edges, self.repeat = (self.weight("s-1=edge"), self.weight("s1=edge")), self.weight("again")
        self.rows: list[tuple] = []
        self.tables: list[np.ndarray] = []

    def weight(self, feature: str) -> np.ndarray:
        return self.emit[self.number[feature]] if feature in self.number else np.zeros(len(TAGS))

    def kind(self, word: str) -> int:
        key = shape(word), cue_of(word), hexadecimal(word), rich(word)
        if key not in self.classes:
            self.classes[key] = len(self.classes)
            own, cue = key[:2]
            row = self.weight("bias") + self.weight("s0=" + own) + self.weight("is=" + cue) + (self.weight("hex") if key[2] else 0.0) + (self.weight("rich") if key[3] else 0.0)
            self.rows.append((row, self.weight("s-1=" + own), self.weight("s1=" + own), self.weight("cue=" + cue)))
            self.tables = []
        if len(self.of) >= KEPT:
            self.of.clear()
        self.of[word] = self.classes[key]
        return self.of[word]

    def emissions(self, words: list[str]) -> np.ndarray:
        of = self.of
        known = list(map(of.get, words))
        if None in known:
            known = [of[w] if w in of else self.kind(w) for w in words]
        c = np.array(known, dtype=np.int64)
        if not self.tables:
            self.tables = [np.array(t) for t in zip(*self.rows)]
        own, after, before, cue = self.tables
        out = own[c]
        out[0] += self.edges[0]
        out[1:] += after[c[:-1]]
        out[-1] += self.edges[1]
        out[:-1] += before[c[1:]]
        at = np.flatnonzero(cue.any(axis=1)[c])  # few words are cues
        for k in range(1, REACH + 1):
            near = at[at < len(c) - k]
            out[near + k] += cue[c[near]]
        same = np.fromiter(map(eq, words, words[1:]), dtype=bool, count=len(words) - 1)  # words that their neighbour repeats
        if same.any():
            again = np.zeros(len(words), dtype=bool)
            again[1:] |= same
            again[:-1] |= same
            out[again] += self.repeat
        return out

    def viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of many sequences at once: sequences of like length share padded numpy steps."""
        out: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(rows)
        order = sorted(range(len(rows)), key=lambda k: len(rows[k]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and to - at < 512 and len(rows[order[to]]) <= 1.3 * len(rows[order[at]]) + 4:
                to += 1
            part, at = [rows[k] for k in order[at:to]], to
            ks = order[to - len(part):to]
            size = np.array([len(r) for r in part])
            e = np.zeros((len(part), size.max(), len(TAGS)))
            for k, r in enumerate(part):
                e[k, :len(r)] = r
            best, back = self.start + e[:, 0], np.zeros(e.shape, dtype=np.int8)
            for i in range(1, size.max()):
                step = best[:, :, None] + self.move[None]
                back[:, i] = step.argmax(1)
                best = np.where((i < size)[:, None], step.max(1) + e[:, i], best)
            tag = best.argmax(1)
            tags = np.zeros((len(part), size.max()), dtype=int)
            for i in range(size.max() - 1, -1, -1):
                inside = i < size
                tags[:, i] = np.where(inside, tag, 0)
                tag = np.where(inside & (i > 0), back[np.arange(len(part)), i, tag], tag)
            for k, n, row in zip(ks, size, tags):
                out[k] = row[:n]
        return out

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of sequences of any length: in blocks of BLOCK tokens, each decoded with LAP more tokens on either side."""
        parts = [(k, at) for k, r in enumerate(rows) for at in range(0, len(r), BLOCK)]
        tags = self.viterbi([rows[k][max(0, at - LAP):at + BLOCK + LAP] for k, at in parts])
        out = [np.zeros(len(r), dtype=int) for r in rows]
        for (k, at), own in zip(parts, tags):
            piece = out[k][at:at + BLOCK]
            piece[:] = own[min(at, LAP):][:len(piece)]
        return out

    @staticmethod
    def tokens(text: str, base: list[tuple[int, int, int]]) -> list[re.Match]:
        """All tokens of a text but those that meet a base span."""
        own = list(TOKEN.finditer(text))
        if not base:
            return own
        out, at = [], 0
        merged: list[list[int]] = []
        for a, _, b in base:  # sorted by start
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for t in own:
            while at < len(merged) and merged[at][1] <= t.start():
                at += 1
            if at == len(merged) or t.end() <= merged[at][0]:
                out.append(t)
        return out

    def spans(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        # places are looked up only for texts with a tag
        laid = [[m.group() for m in self.tokens(t, b)] if b else TOKEN.findall(t) for t, b in zip(texts, base)]
        full = [k for k, words in enumerate(laid) if words]
        tags = self.decode([self.emissions(laid[k]) for k in full])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, own in zip(full, tags):
            if not own.any():
                continue
            run, at = self.tokens(texts[k], base[k]), 0
            for i in np.flatnonzero(own).tolist():
                if i < at:
                    continue
                kind, j = TAGS[own[i]][2:], i + 1
                while j < len(run) and TAGS[own[j]] == "I-" + kind:
                    j += 1
                out[k].append((run[i].start(), KINDS.index(kind), run[j - 1].end()))
                at = j
        return out


@lru_cache(maxsize=1)
def tagger() -> Tagger:
    return Tagger()


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans): one row a text, in one narrow pass."""

    own = tagger()  # trained once, on the driver; its weights go along with the tasks

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            more = own.spans(texts, base)
            yield pa.RecordBatch.from_pydict({
                "id": part.column(0),
                **{f"n_{k}": pa.array([sum(s[1] == n for s in b) for b in base], pa.int64()) for n, k in enumerate(BASE)},
                "base_sha256": [hashlib.sha256(told(b).encode()).hexdigest() for b in base],
                "spans": [told(b + m) for b, m in zip(base, more)],
            })

    schema = f"id {id_type(df, id_col)}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return map_text(df, id_col, text_col, work, schema).withColumnRenamed("id", id_col)


def redact(df: DataFrame, spans_col: str = "spans", text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``spans_col`` in ``text_col`` replaced by its kind in angle brackets (DataFrame functions).

    Overlapping spans are one stretch with the kind of the first.
    """
    spans = F.transform(F.filter(F.split(F.coalesce(F.col(f"`{spans_col}`"), F.lit("")), ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    piece = lambda acc, s: F.when(
        s[1].cast("int") < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s[2].cast("int")).alias("at"))).otherwise(F.struct(
            F.concat(acc["out"], F.substring(F.col(f"`{text_col}`"), acc["at"] + 1, s[1].cast("int") - acc["at"]), F.lit("<"), s[0], F.lit(">")).alias("out"),
            s[2].cast("int").alias("at")))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(f"`{text_col}`"), acc["at"] + 1, F.length(F.col(f"`{text_col}`"))))
    return df.withColumn(text_col, F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), piece, rest))
