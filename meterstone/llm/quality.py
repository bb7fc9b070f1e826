"""Quality rules on whole texts, with tokeniser fertility.

Base rules count words, symbols, repeated lines and repeated five-word windows. The fertility rules
tokenise every word with two public vocabularies, one of pieces that falls back to bytes and one of byte pairs for many
languages: characters a token and the share of tokens that are bytes in both, and the entropy of the pieces. Bands are
kept for each language or script. Every text is judged, however short: a figure rejects it if it lies outside its band by
more than ``DEVIATIONS`` standard errors, which come from the text's own tokens (the spread of their lengths, the share at the
edge of the band, the spread of their information; entropy is held against what so few tokens can show of it).

A word's tokens are found once per task (bounded, ``KEPT``) as both vocabularies cut at blanks first.

Results for odd input: null texts count as empty; texts without words fail the base rules; every
input row gives one row; a null or unknown language takes the band of its script, and a script
without a band the widest; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import arrow_map, id_type, slices

KEPT = 300_000
#: New words taken together.
LEARNED = 10_000
PIECES = "piece_bpe_32k.model"
MIN_WORDS, REPEAT_PERCENT, RUN = 10, 20, 5
SYMBOLS = "#*$%&|<>"
PAIRS = "byte_bpe_multi_50k.tiktoken"
DEVIATIONS = 2.0
#: Bands (fixed values of the rule): characters a piece from..to, byte share to, entropy in bits from; characters a byte pair
#: from, its byte share to. For languages the lower ends are figures that clean texts reach; for scripts about half the
#: figures of plain sentences in languages that use them. Scripts without a band of their own are "other".
BANDS = {
    "en": (2.10, 9.0, 0.10, 4.5, 2.12, 0.10),
    "de": (2.09, 9.0, 0.10, 4.5, 2.16, 0.10),
    "fr": (1.85, 9.0, 0.10, 4.5, 1.92, 0.10),
    "es": (1.82, 9.0, 0.10, 4.5, 1.94, 0.10),
    "Latin": (1.15, 9.0, 0.10, 3.5, 1.30, 0.10),
    "Cyrillic": (1.20, 9.0, 0.10, 3.5, 1.20, 0.10),
    "Greek": (0.50, 6.0, 0.10, 3.2, 0.90, 0.10),
    "Hebrew": (0.50, 6.0, 0.10, 3.0, 0.90, 0.15),
    "Arabic": (0.60, 6.0, 0.10, 3.2, 1.00, 0.10),
    "Devanagari": (0.45, 5.0, 0.20, 3.2, 0.50, 0.40),
    "Thai": (0.60, 5.0, 0.10, 3.5, 0.80, 0.20),
    "Kana": (0.50, 5.0, 0.40, 3.5, 0.60, 0.40),
    "Han": (0.50, 5.0, 0.45, 3.5, 0.50, 0.45),
    "Hangul": (0.40, 5.0, 0.40, 3.5, 0.80, 0.45),
    "other": (0.45, 9.0, 0.40, 3.0, 0.50, 0.40),
}
#: Code points from which a script's letters begin, in order (fixed values of the Unicode blocks); "" has no script of its own.
BLOCKS = ((0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, ""), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0780, ""), (0x0900, "Devanagari"),
          (0x0980, ""), (0x0E00, "Thai"), (0x0E80, ""), (0x1100, "Hangul"), (0x1200, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"), (0x3100, ""),
          (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, ""), (0x20000, "Han"), (0x30000, ""))
_STARTS, _SCRIPTS = np.array([c for c, _ in BLOCKS]), [n for _, n in BLOCKS]


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def default_pairs() -> str:
    import public_tokenizers

    return public_tokenizers.path(PAIRS)


def script(text: str) -> str:
    """The script of most letters; Japanese text is Kana if a tenth of its letters are. "other" where letters of no band's script, or none, prevail."""
    letters = "".join(filter(str.isalpha, text))
    if not letters:
        return "other"
    if letters.isascii():
        return "Latin"
    of = np.searchsorted(_STARTS, np.frombuffer(letters.encode("utf-32-le"), dtype="<u4"), side="right") - 1
    count = Counter()
    for k, n in enumerate(np.bincount(of, minlength=len(_SCRIPTS)).tolist()):
        count[_SCRIPTS[k]] += n
    if count["Kana"] and 10 * count["Kana"] >= count["Kana"] + count["Han"]:
        count["Kana"] += count.pop("Han", 0)
    return max(count, key=lambda s: (count[s], s)) or "other"


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def repeat_words(words: list[bytes], run: int = RUN, numbers: list[int] | None = None) -> int:
    """Words in windows of ``run`` words that the text has twice or more; ``numbers`` are words' own numbers where they are known.

    Windows are sorted by a 64-bit hash; neighbours with equal hashes are compared word by word, and
    where a clash is found the windows are counted as tuples.
    """
    n = len(words) - run + 1
    if n < 2:
        return 0
    if numbers is None:
        number: dict[bytes, int] = {}
        numbers = [number.setdefault(w, len(number)) for w in words]
    if len(set(numbers)) == len(words):
        return 0
    ids = np.array(numbers, dtype=np.uint64)
    hashes = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(run):
            hashes = (hashes ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes, kind="stable")
    at = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    a, b = order[at], order[at + 1]
    if all((ids[a + k] == ids[b + k]).all() for k in range(run)):
        twice = np.zeros(n, dtype=bool)
        twice[a] = twice[b] = True
    else:
        windows = [tuple(ids[i:i + run].tolist()) for i in range(n)]
        count: dict[tuple, int] = {}
        for w in windows:
            count[w] = count.get(w, 0) + 1
        twice = np.array([count[w] > 1 for w in windows])
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + run, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


class Pieces:
    """The public vocabularies and the tokens of words met so far, one for each worker process."""

    def __init__(self, path: str, pairs_path: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        with open(pairs_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pairs = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lone = {r for t, r in ranks.items() if len(t) == 1 and t[0] >= 128}
        self.clear()

    def clear(self) -> None:
        """No words: the number of each, its pieces, and a row of figures for each (pieces, code points, byte pairs, lone bytes among them)."""
        self.of: dict[bytes, int] = {}
        self.pieces: list[bytes] = []
        self.table = np.zeros((1024, 4), dtype=np.int64)

    def learn(self, texts: list[list[bytes]]) -> None:
        """Pieces, number of byte pairs and of lone bytes among them, for every word of ``texts``."""
        new = set().union(*texts).difference(self.of) if texts else set()
        if len(self.of) + len(new) > KEPT:
            self.clear()
            new = set().union(*texts)
        new = list(new)
        for at in range(0, len(new), LEARNED):
            self._learn(new[at:at + LEARNED])

    def _learn(self, new: list[bytes]) -> None:
        plain = [w.decode("utf-8", "replace") for w in new]
        ids, pairs = self.model.encode(plain, num_threads=1), [self.pairs.encode_ordinary(" " + w) for w in plain]
        base = len(self.of)
        self.pieces += [array("i", i).tobytes() for i in ids]
        self.of.update(zip(new, range(base, base + len(new))))
        if len(self.of) > len(self.table):
            self.table = np.concatenate([self.table[:base], np.zeros((len(self.of), 4), dtype=np.int64)])
        lone = self.lone.__contains__
        own = self.table[base:len(self.of)]
        own[:, 0], own[:, 1], own[:, 2] = list(map(len, ids)), list(map(len, plain)), list(map(len, pairs))
        own[:, 3] = [0 if w.isascii() else sum(map(lone, two)) for w, two in zip(plain, pairs)]

    def numbers(self, words: list[bytes]) -> list[int]:
        return list(map(self.of.__getitem__, words))

    def figures(self, words: list[bytes], chars: int, numbers: list[int] | None = None) -> Figures:
        if not words:
            return Figures(0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0.0, 0.0)
        numbers = self.numbers(words) if numbers is None else numbers
        ids = np.frombuffer(b"".join(map(self.pieces.__getitem__, numbers)), dtype=np.int32)
        n = len(ids)
        count = np.unique(ids, return_counts=True)[1]
        share = count / n
        told = -np.log2(share)
        entropy = float((share * told).sum())
        spread = float(np.sqrt(max(0.0, (share * told ** 2).sum() - entropy ** 2)))
        width, size, pairs, lone = self.table[numbers].T
        # spread of characters a piece, from words: characters of a word less what its pieces would hold on average
        rest = size - width * (chars / n)
        uneven = float(np.sqrt((rest ** 2).sum()) / n)
        two = int(pairs.sum())
        return Figures(n, chars / n, uneven, float(self.is_byte[ids].mean()), entropy, spread / np.sqrt(n), two, chars / two, int(lone.sum()) / two)


class Figures(NamedTuple):
    n: int  # pieces
    chars: float  # characters a piece
    chars_error: float
    bytes: float  # share of pieces that are bytes
    entropy: float
    entropy_error: float
    pairs: int  # byte pairs
    pair_chars: float
    pair_bytes: float


@lru_cache(maxsize=2)
def pieces(path: str, pairs_path: str) -> Pieces:
    return Pieces(path, pairs_path)


def verdict(band: tuple, f: Figures, deviations: float = DEVIATIONS) -> bool:
    """Whether all figures lie inside the band, or outside it by no more than their standard errors allow."""
    low, high, most_bytes, least, pair_low, pair_bytes = band
    if not f.n:
        return False
    slack = deviations * f.chars_error
    reached = least - (2 ** least - 1) / (2 * f.n * np.log(2))  # what n pieces of a text at the edge of the band show of its entropy
    share = lambda p, n: p + deviations * (p * (1 - p) / n) ** 0.5
    return bool(low - slack <= f.chars <= high + slack and f.bytes <= share(most_bytes, f.n) and f.entropy + deviations * f.entropy_error >= reached
                and f.pair_chars >= pair_low - slack * f.pair_chars / f.chars and f.pair_bytes <= share(pair_bytes, f.pairs))


def _assessed(path: str, pairs_path: str, bands: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = pieces(path, pairs_path)
    for part in slices(batches):
        texts, langs = part.column(1).to_pylist(), part.column(2).to_pylist()
        words = [t.encode().split() for t in texts]  # bytes.split cuts at space and 0x09-0x0D
        own.learn(words)
        rows = []
        for t, lang, w in zip(texts, langs, words):
            chars = len(t) - sum(map(t.count, " \t\n\x0b\x0c\r"))
            numbers = own.numbers(w)
            again = repeat_words(w, numbers=numbers)
            failed = len(w) < MIN_WORDS or 100 * again > REPEAT_PERCENT * len(w)
            f = own.figures(w, chars, numbers)
            band = bands.get(lang) or bands.get(script(t)) or bands["other"]
            rows.append((len(w), chars, sum(map(t.count, SYMBOLS)), dup_lines(t), again, failed, not failed and verdict(band, f),
                         f.chars, f.bytes, float(f.entropy), f.pair_chars, f.pair_bytes))
        columns = dict(zip(NAMES, zip(*rows)))
        yield pa.RecordBatch.from_pydict({"id": part.column(0), **{k: pa.array(v) for k, v in columns.items()}})


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "chars_per_token", "byte_share", "token_entropy",
         "chars_per_pair", "pair_byte_share")


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
           pieces_path: str | None = None, pairs_path: str | None = None, bands: dict | None = None) -> DataFrame:
    """(id, counts, base_failed, kept, the fertility figures of both vocabularies): one row a text, in one narrow pass."""
    path, pairs, own = pieces_path or default_pieces(), pairs_path or default_pairs(), bands or BANDS
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col else F.lit(None).cast("string")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
    kinds = ["long"] * 5 + ["boolean"] * 2 + ["double"] * 5
    schema = f"id {id_type(df, id_col)}, " + ", ".join(f"{n} {k}" for n, k in zip(NAMES, kinds))
    return arrow_map(rows, lambda it: _assessed(path, pairs, own, it), schema).withColumnRenamed("id", id_col)
