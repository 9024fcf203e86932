"""Quality rules from how a public tokeniser sees a text.

Each text is encoded word by word with a public vocabulary. Three measures follow: characters per token
(its fertility turned round), the share of tokens that are single fallback bytes, and the entropy of the
token distribution as a share of what a text of that many tokens can reach. Bands of accepted values per
script reject a text. A few counts over words and lines come first and reject for themselves.

Words are found again and again, so each worker keeps the tokens of words it has seen, up to a bound.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import with_struct
from eventloom.llm.words import SPACES, Known

SYMBOLS = "#*$%&|<>"
FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
          "base_failed": "boolean", "script": "string", "chars_per_token": "double", "byte_share": "double",
          "token_entropy": "double", "kept": "boolean"}


@dataclass(frozen=True)
class Band:
    """What is accepted. Entropy is relative: 1 is as even as so many tokens of ``FULL_BITS`` bits can be."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_token_entropy: float


# Entropy grows with the length of a text up to about so many bits.
FULL_BITS = 7.0
# By the first word of the Unicode names of a text's letters. Vocabularies trained on mostly Latin text cut
# other scripts finer and know fewer of their characters. The entropy floor of Latin is about the 0.002 quantile of
# clean text; low quantiles in German, English, French and Spanish lie close. There was no clean text in other scripts.
BANDS = {
    "LATIN": Band(1.2, 8.0, 0.10, 0.82),
    "CYRILLIC": Band(1.0, 8.0, 0.20, 0.65),
    "GREEK": Band(0.6, 8.0, 0.40, 0.60),
    "CJK": Band(0.3, 4.0, 0.90, 0.50),
    "HIRAGANA": Band(0.3, 4.0, 0.90, 0.50),
    "HANGUL": Band(0.3, 4.0, 0.95, 0.50),
}
OTHER = Band(0.25, 8.0, 0.98, 0.45)


def line_repeats(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of three words that are found twice or more."""
    if len(words) < 4:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[which] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def script_of(text: str) -> str:
    """The script of most letters; Latin where there are none."""
    if text.isascii():
        return "LATIN"
    times = np.bincount(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    counts: dict[str, int] = {}
    for code in np.flatnonzero(times).tolist():
        if (c := chr(code)).isalpha():
            name = unicodedata.name(c, "OTHER").split(" ")[0]
            counts[name] = counts.get(name, 0) + int(times[code])
    return max(counts, key=lambda k: (counts[k], k)) if counts else "LATIN"


class Vocabulary:
    """Tokens of single words."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(k) for k in range(self.model.vocab_size())])
        self.known = Known(self.learn)

    def learn(self, words: list[bytes]) -> list[bytes]:
        found = self.model.encode([w.decode() for w in words], num_threads=1)
        raw = np.fromiter(itertools.chain.from_iterable(found), "<u4").tobytes()
        cuts = [0, *itertools.accumulate(4 * len(ids) for ids in found)]
        return [raw[a:b] for a, b in itertools.pairwise(cuts)]

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(self.known.of(words)), "<u4")

    def measures(self, ids: np.ndarray, chars: int) -> tuple[float, float, float] | tuple[None, None, None]:
        if not len(ids):
            return None, None, None
        share = np.bincount(ids)
        share = share[share > 0] / len(ids)
        bits = float(-(share * np.log2(share)).sum())
        most = min(FULL_BITS, float(np.log2(len(ids)))) if len(ids) > 1 else 0.0
        return chars / len(ids), float(self.is_byte[ids].mean()), bits / most if most else 1.0


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker, which serves many tasks."""
    return Vocabulary(path)


def judge(text: str | None, tokens: Vocabulary, bands: dict[str, Band], min_words: int, max_repeat_pct: int) -> tuple:
    text = text or ""
    words = text.encode().split()
    n, chars = len(words), len(text) - sum(map(text.count, SPACES))
    repeat = repeat_words(words)
    failed = n < min_words or 100 * repeat > max_repeat_pct * n
    script = script_of(text)
    cpt, share, entropy = tokens.measures(tokens.ids(words), chars)
    band = bands.get(script, OTHER)
    fits = cpt is not None and (band.min_chars_per_token <= cpt <= band.max_chars_per_token
                                and share <= band.max_byte_share and entropy >= band.min_token_entropy)
    return (n, chars, sum(map(text.count, SYMBOLS)), line_repeats(text), repeat, failed, script, cpt, share, entropy,
            fits and not failed)


def quality_rules(docs: DataFrame, model: str, text: str = "text", bands: dict[str, Band] = BANDS, min_words: int = 50,
                  max_repeat_pct: int = 50) -> DataFrame:
    """Adds the counts, the measures and ``kept`` to each row.

    ``model`` is the path of a sentencepiece model with byte fallback that every executor can open. A null
    text counts as empty; a text without words has null measures and is not kept. Texts are measured whole,
    however long. Rows are judged one by one, so ties, repeated rows and order change nothing; columns named
    like the new ones are replaced. An empty table gives an empty result.
    """

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in FIELDS.items()))
    def rules(texts: pd.Series) -> pd.DataFrame:
        rows = [judge(t, vocabulary(model), bands, min_words, max_repeat_pct) for t in texts]
        return pd.DataFrame(rows, columns=list(FIELDS)).astype({"chars_per_token": float, "byte_share": float, "token_entropy": float})

    return with_struct(docs, rules(F.col(text)), list(FIELDS))
