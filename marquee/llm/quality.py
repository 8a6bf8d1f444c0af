"""Quality rules as a short-circuit cascade ordered by rejection per cost."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import map_batches, raw_words, texts, with_columns

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_NOT_UPPER = bytes(b for b in range(256) if b not in _UPPER)
_NOT_LETTERS = bytes(b for b in range(256) if b not in _LETTERS)
_NO_LETTER = bytes(b for b in range(128) if b not in _LETTERS)

MEASURES = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"}


@dataclass(frozen=True)
class Measured:
    """One text with its base measures; rules read these or compute their own from the words."""

    text: bytes
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < 50 or 100 * self.n_repeat_words > 50 * n


def code_points(data: bytes) -> int:
    """Characters of UTF-8 bytes: all but the continuation bytes."""
    return len(data.decode("utf-8", "surrogatepass")) if not data.isascii() else len(data)


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    seen, n, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            n += i + 3 - max(i, end)
            end = i + 3
    return n


def measure(text: bytes) -> Measured:
    words = raw_words(text)
    lines = [x for x in text.split(b"\n") if x.split()]
    return Measured(text, words, code_points(b"".join(words)), len(text.translate(None, _NOT_SYMBOLS)),
                    len(lines) - len(set(lines)), repeat_words(words), len(lines))


def _too_loud(m: Measured) -> bool:
    return 2 * m.text.count(b"!") > len(m.words)


def _symbols(m: Measured) -> bool:
    return 4 * m.n_symbols > len(m.words)


def _same_lines(m: Measured) -> bool:
    return 2 * m.n_dup_lines > m.n_lines


def _word_size(m: Measured) -> bool:
    n = len(m.words)
    return not 2 * n <= m.word_chars <= 15 * n


def _shouting(m: Measured) -> bool:
    letters = len(m.text.translate(None, _NOT_LETTERS))
    return 2 * len(m.text.translate(None, _NOT_UPPER)) > letters


def _repeats(m: Measured) -> bool:
    return 10 * m.n_repeat_words > 3 * len(m.words)


def _one_word(m: Measured) -> bool:
    return 10 * max(Counter(m.words).values(), default=0) > 3 * len(m.words)


def _no_letters(m: Measured) -> bool:
    """Words without a letter; any byte beyond ASCII counts as one."""
    without = sum(not w.translate(None, _NO_LETTER) for w in m.words)
    return 10 * without > 3 * len(m.words)


# name -> does the rule reject the text?
RULES: dict[str, Callable[[Measured], bool]] = {
    "no_letters": _no_letters, "one_word": _one_word, "shouting": _shouting, "repeats": _repeats,
    "same_lines": _same_lines, "too_loud": _too_loud, "symbols": _symbols, "word_size": _word_size,
}


def plan_cascade(docs: DataFrame, text: str = "text", sample_rows: int = 512, rounds: int = 3) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected), best rejection per cost first.

    Only this order comes from the sample (at most ``sample_rows`` texts from one in twenty
    rows, the first rows of a table too small for that); since a text is kept if no rule
    rejects it, the order never changes a verdict. An empty table keeps the given order.
    """
    column = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches):
        for batch in batches:
            for data in texts(batch, "t"):
                m, seconds, rejected = measure(data), [], []
                for rule in RULES.values():
                    start = time.perf_counter()
                    for _ in range(rounds):
                        verdict = rule(m)
                    seconds.append((time.perf_counter() - start) / rounds)
                    rejected.append(int(verdict))
                yield pa.RecordBatch.from_pydict({"seconds": [seconds], "rejected": [rejected]})

    def measured(some: DataFrame) -> list:
        """Two numbers a rule for each text; texts stay in the tasks, and no more of these run than give the rows."""
        return map_batches(some, "seconds array<double>, rejected array<bigint>", run).limit(sample_rows).collect()

    rows = measured(column.sample(0.05, 7))
    if len(rows) < 64:
        rows = measured(column)
    found = []
    for place, name in enumerate(RULES):
        cost = sum(r["seconds"][place] for r in rows) / max(1, len(rows)) + 1e-9
        share = sum(r["rejected"][place] for r in rows) / max(1, len(rows))
        found.append((-share / cost, place, name, cost, share))
    return [(name, cost, share) for _, _, name, cost, share in sorted(found)]


def quality_rules(docs: DataFrame, text: str = "text", sample_rows: int = 512) -> DataFrame:
    """Every row with its base measures, ``base_failed``, ``kept`` and ``rejected_by``.

    Words are runs of anything but ASCII blanks. A text fails the base rule with fewer than 50
    words or with over half of its words in repeated 3-word windows; otherwise the cascade
    stops at the first rule that rejects it. ``rejected_by`` names that rule (``base`` for the
    base rule, null if kept), so it may change with the sampled order while ``kept`` never does.
    Null text counts as empty: no words, not kept. Repeated rows and null ids get their own
    verdict; an empty table gives no rows; columns with a result's name are replaced.
    """
    order = [name for name, _, _ in plan_cascade(docs, text, sample_rows)]

    def run(batch):
        out = {name: [] for name in [*MEASURES, "rejected_by"]}
        for t in texts(batch, text):
            m = measure(t)
            reason = "base" if m.base_failed else next((r for r in order if RULES[r](m)), None)
            values = (len(m.words), m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
                      reason is None, reason)
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    return with_columns(docs, MEASURES | {"rejected_by": "string"}, run)


SQL = r"""
WITH w AS (
  SELECT doc_id, k, list_extract(ws, k) AS word, list_extract(ws, k + 1) AS w1, list_extract(ws, k + 2) AS w2
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents))),
g AS (SELECT *, CASE WHEN w2 IS NULL THEN 0 WHEN count(*) OVER (PARTITION BY doc_id, word, w1, w2) > 1 THEN 1 ELSE 0 END AS hit FROM w),
c AS (SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM g),
per_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, sum(covered)::BIGINT AS n_repeat_words,
    sum(CASE WHEN regexp_matches(word, '[^\x00-\x40\x5B-\x60\x7B-\x7F]') THEN 0 ELSE 1 END)::BIGINT AS no_letter FROM c GROUP BY doc_id),
top AS (SELECT doc_id, max(n) AS top FROM (SELECT doc_id, word, count(*) AS n FROM w GROUP BY doc_id, word) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
chars AS (
  SELECT doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^!]', '', 'g')) AS loud,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters FROM documents),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, coalesce(n_symbols, 0)::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(no_letter, 0) AS no_letter, coalesce(top, 0) AS top, coalesce(loud, 0) AS loud, coalesce(upper, 0) AS upper, coalesce(letters, 0) AS letters
  FROM documents d LEFT JOIN per_word USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN chars USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (2 * loud > n_words OR 4 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 2 * upper > letters OR 10 * n_repeat_words > 3 * n_words OR 10 * top > 3 * n_words OR 10 * no_letter > 3 * n_words) AS kept
FROM b"""
