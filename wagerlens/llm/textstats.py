"""Statistics of a text as numbers, for classifiers."""

from __future__ import annotations

import zlib
from collections import Counter
from operator import mul

import numpy as np

NAMES = (
    "log_chars", "log_words", "log_lines", "word_length", "distinct_words", "top_word", "distinct_lines", "line_length",
    "upper", "digits", "spaces", "marks", "exclamations", "signs", "bars", "beyond_ascii", "compressed", "capital_words", "ended_lines",
)

_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_SIGNS = [ord(c) for c in "#$%&*@^~+=<>"]
_CLASSES = np.stack(  # which of the 256 bytes count as upper case, digits, spaces, marks, signs, beyond ASCII
    [np.isin(np.arange(256), c) for c in (range(65, 91), range(48, 58), [9, 10, 11, 12, 13, 32], _MARKS, _SIGNS, range(128, 256))], axis=1
).astype(np.int64)


def statistics(text: str, counted: Counter) -> list[float]:
    """The numbers named in NAMES, of the whole text; of an empty one all are 0. `counted`: its white-space separated words."""
    data = text.encode("utf-8", "replace")
    if not data:
        return [0.0] * len(NAMES)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digits, spaces, marks, signs, beyond = (seen @ _CLASSES).tolist()
    words, lines, n = counted.total(), [x for x in text.split("\n") if x.strip()], len(data)
    w, k = max(words, 1), max(len(lines), 1)
    return [
        np.log1p(len(text)), np.log1p(words), np.log1p(len(lines)), sum(map(mul, map(len, counted), counted.values())) / w, len(counted) / w,
        max(counted.values(), default=0) / w, len(set(lines)) / k, np.log1p(n / k),
        upper / n, digits / n, spaces / n, marks / n, seen[33] / w,
        signs / w, seen[124] / w, beyond / n, len(zlib.compress(data, 1)) / n,
        sum([m for x, m in counted.items() if x[0].isupper()]) / w, sum(x.rstrip()[-1] in ".!?" for x in lines) / k,
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t, Counter(t.split())) for t in texts], np.float64).reshape(len(texts), len(NAMES))
