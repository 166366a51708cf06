"""Quality rules in a short-circuit cascade.

A first pass over a sample of the rows that pass the base rule times every rule, on top of the figures that each text has
anyway, and counts what it rejects; the rules then run in the order of rejections per second, and a text meets a rule
only if all rules before it let it pass. The order changes the cost alone: the verdict is that of all rules together.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_carried, ship

#: Rows that the cost estimate looks at, about.
SAMPLE_ROWS = 2000
#: Words of a window that counts as repeated; a power of two.
WINDOW = 8
_BLANKS, _SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
_LETTER = re.compile(r"[^\W\d_]")


class Text:
    """A text and what rules ask of it; each figure is worked out when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")
        self.words = self.raw.split()  # bytes split at exactly the blanks \x09-\x0D and \x20
        self.n_words = len(self.words)

    @cached_property
    def ids(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), dtype=np.int64, count=self.n_words)

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(c) for c in _BLANKS)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.raw.count(c.encode()) for c in _SYMBOLS)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of ``WINDOW`` words that the text holds twice or more."""
        width = WINDOW
        if self.n_words <= width:
            return 0
        names, reach = self.ids, 1
        while reach < width:  # names of windows twice as long from the names of their halves
            pairs = names[:-reach] * (int(names.max()) + 1) + names[reach:]
            found, names = np.unique(pairs, return_inverse=True)
            if len(found) == len(pairs):
                return 0
            reach *= 2
        twice = np.bincount(names)[names] > 1
        edges = np.zeros(self.n_words + 1, dtype=np.int64)
        at = np.flatnonzero(twice)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + width, -1)
        return int((np.cumsum(edges) > 0).sum())


def too_many_symbols(t: Text) -> bool:
    return 10 * t.n_symbols > 3 * t.n_words


def repeated_lines(t: Text) -> bool:
    """More than half of the lines, and four at least, repeat an earlier one."""
    return t.n_dup_lines >= 4 and 2 * t.n_dup_lines > len(t.lines)


def stuttering(t: Text) -> bool:
    """More than three words in ten repeat the word before."""
    return 10 * int((t.ids[1:] == t.ids[:-1]).sum()) > 3 * t.n_words


def odd_word_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 15 * t.n_words


def shouting(t: Text) -> bool:
    """More than half of the letters are capitals that have a small form."""
    text = t.text
    upper = sum(map(str.isupper, text))
    return 2 * upper > sum(map(str.isalpha, text))


def few_letters(t: Text) -> bool:
    """More than three words in ten without any letter."""
    bare = sum(1 for w in set(t.words) if not _LETTER.search(w.decode("utf-8", "replace")))
    if not bare:
        return False
    return 10 * sum(1 for w in t.words if not _LETTER.search(w.decode("utf-8", "replace"))) > 3 * t.n_words


def one_word(t: Text) -> bool:
    """One word makes up over a fifth of the text."""
    return 5 * int(np.bincount(t.ids).max(initial=0)) > t.n_words


def cut_off_lines(t: Text) -> bool:
    """More than three lines in ten end in an ellipsis."""
    return 10 * sum(line.rstrip().endswith((b"...", "…".encode())) for line in t.lines) > 3 * len(t.lines)


RULES: dict[str, Callable[[Text], bool]] = {f.__name__: f for f in (too_many_symbols, repeated_lines, odd_word_length, shouting, few_letters, one_word, stuttering, cut_off_lines)}


def figures(t: Text) -> tuple:
    """What every text is asked, whatever its fate; the last one is whether the base rule fails."""
    return t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.n_words < 20 or 100 * t.n_repeat_words > 30 * t.n_words


def estimate(docs: DataFrame, rules: dict[str, Callable] = RULES, sample_rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """Per rule: rows tried, rows rejected and seconds, over the rows of a hashed sample of about ``sample_rows`` that pass the base rule.

    A rule's cost is what it adds to the base figures. What several rules share is charged to the first one, so the first
    rule changes from row to row.
    """
    ship(docs.sparkSession)
    keep_one_in = max(1, docs.count() // sample_rows)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seconds, rejected, rows, names = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0, list(rules)
        for batch in batches:
            for text in batch["text"]:
                t = Text(text)
                if figures(t)[-1]:
                    continue
                rows += 1
                for name in names[rows % len(names) :] + names[: rows % len(names)]:
                    rule = rules[name]
                    began = time.perf_counter()
                    rejected[name] += bool(rule(t))
                    seconds[name] += time.perf_counter() - began
        yield pd.DataFrame({"rule": list(rules), "tried": rows, "rejected": list(rejected.values()), "seconds": list(seconds.values())})

    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(keep_one_in)) == 0).select("text")
    sums = sample.mapInPandas(measure, "rule string, tried long, rejected long, seconds double").groupBy("rule")
    return sums.agg(*[F.sum(c).alias(c) for c in ("tried", "rejected", "seconds")]).toPandas()  # a row per rule


def cascade_order(estimates: pd.DataFrame, rules: dict[str, Callable] = RULES) -> list[str]:
    """Rule names by rejections per second, best first; rules that rejected nothing by cost; without a sample as given."""
    figures = estimates.set_index("rule")
    if not len(figures) or not figures["tried"].max():
        return list(rules)
    gain = {r: figures.rejected[r] / max(figures.seconds[r], 1e-9) for r in rules}
    return sorted(rules, key=lambda r: (-gain[r], figures.seconds[r], r))


def judge(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Callable] = RULES) -> DataFrame:
    """One row per row of (doc_id, text): the figures n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then base_failed and kept.

    A null or empty text has no words and fails the base rule. Every row is judged by itself, so repeated rows get
    equal verdicts; an empty table gives an empty result; further columns are ignored. ``order`` defaults to the
    order that :func:`estimate` suggests.
    """
    names = cascade_order(estimate(docs, rules), rules) if order is None else order
    cascade = [rules[n] for n in names]

    def decide(text: str | None) -> tuple:
        t = Text(text)
        known = figures(t)
        return *known, not known[-1] and not any(rule(t) for rule in cascade)

    result = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return map_carried(docs, ["doc_id"], ["text"], lambda: lambda texts: (None, list(zip(*map(decide, texts), strict=True)) or [[]] * 7), result)


def op2(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
