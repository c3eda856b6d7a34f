"""Line-first cleaning: every line meets punctuation, navigation and boilerplate rules, lines that fail go, and a document
that loses too much of its text is rejected.

A line is what stands between two newlines; lines without a word count for nothing. Characters are non-blank ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm.common import BLANKS, map_slices, texts_of

SYMBOLS = "#*$%&|<>"
#: A sentence ends here: at the line's end, or before a blank inside it.
SENTENCE_END = r"[.!?…][\"')\]”»]*([ \t]|$)"
MARKS = "!?*#$%&|<>~^=_\\"
SEPARATORS = "|»•·›"
BOILERPLATE = (
    r"all rights reserved|copyright|©|cookie|privacy policy|terms of (use|service)|javascript|lorem ipsum|subscribe|"
    r"click here|sign (in|up)|log ?in|powered by|(licen[sc]ed|released|distributed) under"
)
_SENTENCE_END, _BOILERPLATE = re.compile(SENTENCE_END), re.compile(BOILERPLATE)
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, n_lines bigint, n_lines_kept bigint, chars_kept bigint"
)


@dataclass(frozen=True)
class Rules:
    """Thresholds. Percentages are of a line's or a document's non-blank characters."""

    least_words: int = 50
    most_repeat_percent: int = 50
    most_mark_percent: int = 20
    least_separators: int = 2
    separators_per_word_percent: int = 25
    least_kept_percent: int = 60


def n_chars(text: str) -> int:
    return len(text) - sum(text.count(c) for c in BLANKS)


def line_fails(line: str, rules: Rules = Rules()) -> str | None:
    """The rule that the line breaks, or None. `line` has at least one word."""
    if _SENTENCE_END.search(line) is None:
        return "punctuation"
    if 100 * sum(line.count(c) for c in MARKS) > rules.most_mark_percent * n_chars(line):
        return "marks"
    separators = sum(line.count(c) for c in SEPARATORS)
    if separators >= rules.least_separators:
        if 100 * separators >= rules.separators_per_word_percent * len(line.encode().split()):
            return "navigation"
    if _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words standing in a window of three that occurs twice or more, its first occurrence included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def clean(text: str, rules: Rules = Rules()) -> tuple[str, int, int, int, int]:
    """The text of the lines that pass; lines, lines kept, characters, characters kept. Lines without a word go too."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    passed = [line for line in lines if line_fails(line, rules) is None]
    return "\n".join(passed), len(lines), len(passed), n_chars("".join(lines)), n_chars("".join(passed))


def measure(text: str, rules: Rules = Rules()) -> tuple:
    """The columns of SCHEMA after doc_id."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    n_repeat = repeated_words(words)
    failed = len(words) < rules.least_words or 100 * n_repeat > rules.most_repeat_percent * len(words)
    _, n_lines, n_kept, chars, chars_kept = clean(text, rules)
    return (
        len(words),
        n_chars(text),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        n_repeat,
        failed,
        not failed and 100 * chars_kept >= rules.least_kept_percent * chars,
        n_lines,
        n_kept,
        chars_kept,
    )


def line_quality(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of `documents` (doc_id, text): measures, `base_failed`, and the verdict `kept`.

    A null or empty text has no words, so it fails. Repeated rows give repeated rows; other columns are ignored; an
    empty table gives none. Rows stay in the tasks that read them: nothing is shuffled.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")[1:]]

    def measured(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*(measure(text, rules) for text in texts_of(part))))
        kinds = [pa.bool_() if n in ("base_failed", "kept") else pa.int64() for n in names]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *arrays], ["doc_id", *names])

    return map_slices(documents.select("doc_id", "text"), measured, SCHEMA)


def cleaned(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The accepted documents with the lines that pass: doc_id, text."""

    def kept(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, clean(t, rules)[0]) for i, t in zip(part.column("doc_id").to_pylist(), texts_of(part)) if measure(t, rules)[6]]
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["doc_id", "text"]
        )

    return map_slices(documents.select("doc_id", "text"), kept, "doc_id bigint, text string")
