"""Operator 2: secrets, by patterns and by the guess cost of credential values.

Three kinds of pattern give the base spans. Beyond them, values in a credential context (a name
such as ``pwd`` or ``client_secret`` before ``=``, ``:`` or ``is``, or the password of a URL) are secrets
if they are hard to guess: a dynamic programme finds the cheapest way to cut the value into common
words, dates, repeats, keyboard walks and brute-force spans, in bits. A brute-force span costs the joint
alphabet of its classes for each character, or is a word with digits behind it. Quoted values end at their
closing quote. Calls and look-ups in code are no values. Values inside a base span are not reported
twice, but every value, those of the base spans included, is given its bits.

Words cost their rank: a few frequent ones of passwords, then a dictionary in order of frequency, such as
the whole words of a public tokenizer's vocabulary (``tokenizer_words``), which is sent to every task.

Whole texts are searched; spans are code points, end exclusive. A null or empty text has no spans.
Repeated rows and null ids are kept as they are. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from haulgrain.llm.periodic_runs import stretch_runs

KINDS = ("assign", "access", "hex", "guess")
_FLAGS = re.ASCII | re.IGNORECASE
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", _FLAGS)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|signing|encryption)[_-]?key|auth)"""
    r"""["']?\x20*(?::=|=>|[:=]|\x20is\x20)\x20*(?:"((?:[^"\\\r\n]|\\.){6,})"|'((?:[^'\\\r\n]|\\.){6,})'|["']?([^\s"'<>,;]{6,}))""", _FLAGS)
_URL = re.compile(r"[a-z][a-z0-9+.-]*://[^\s:/@]+:([^\s:/@]{6,})@", _FLAGS)

# Frequent words of passwords, most frequent first.
COMMON_WORDS = """password admin welcome login letmein qwerty monkey dragon master secret shadow sunshine princess
football baseball superman batman michael jordan hunter killer soccer hockey charlie thomas summer winter spring
autumn january february march april june july august october november december monday friday london paris berlin
love star angel flower computer internet server root user guest test demo default changeme access service backup
database system network office company cheese pepper ginger cookie banana orange apple freedom whatever trustno
ninja mustang tiger eagle falcon phoenix silver golden purple yellow green black white blue red"""
# Rows of a keyboard.
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

#: Letters of a dictionary word at least, and at most.
_LEAST_WORD, _LONGEST_WORD = 4, 24
_SWAPS = str.maketrans("4@301!5$7", "aaeoiisst")
_NEAR = {a + b for row in KEYBOARD_ROWS for a, b in zip(row, row[1:], strict=False)}
_NEAR |= {p[::-1] for p in _NEAR}
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Bits for choosing the kind of the next span.
CUT_BITS = 2.0


def _brute_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.islower() or c.isupper() else 33) if c.isascii() else 10.0


#: Characters of each class: digits, lower case, upper case, other ASCII.
_SIZES = (10, 26, 26, 33)
_JOINT = [math.log2(sum(n for k, n in enumerate(_SIZES) if mask >> k & 1) or 1) for mask in range(16)]


def _class_of(c: str) -> int:
    """Bit of the class of a character, 0 outside ASCII."""
    return 0 if not c.isascii() else 1 if c.isdigit() else 2 if c.islower() else 4 if c.isupper() else 8


def word_ranks(dictionary: Sequence[str] = ()) -> dict[str, int]:
    """Rank of each word: common ones of passwords, then the dictionary's, most frequent first."""
    ranks: dict[str, int] = {}
    for w in COMMON_WORDS.split():
        ranks.setdefault(w, len(ranks) + 1)
    for w in dictionary:
        if _LEAST_WORD <= len(w) <= _LONGEST_WORD:
            ranks.setdefault(w.lower(), len(ranks) + 1)
    return ranks


def tokenizer_words(path: str) -> list[str]:
    """Whole words of letters in a tokenizer's vocabulary, which is in order of frequency. Read on the driver."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = (w.removesuffix("</w>") for w in sorted(vocabulary, key=vocabulary.get) if w.endswith("</w>"))
    return [w for w in words if w.isascii() and w.isalpha()]


_COMMON = word_ranks()
#: Blocks up to this length are followed while the value is read; longer repeats come from the value's runs.
_SHORT_BLOCK = 16


def _long_repeats(value: str) -> dict[int, list[tuple[int, int]]]:
    """By end: (block length, times) of repeats of blocks longer than ``_SHORT_BLOCK``."""
    found: dict[int, list[tuple[int, int]]] = {}
    if len(value) > 2 * _SHORT_BLOCK:
        for start, length, period in stretch_runs(np.frombuffer(value.encode("utf-32-le"), "<u4").astype(np.int64), 2).tolist():
            if period > _SHORT_BLOCK:
                for end in range(start + 2 * period, start + length + 1):
                    found.setdefault(end, []).append((period, (end - start) // period))
    return found


def guess_bits(value: str, ranks: Mapping[str, int] = _COMMON) -> float:
    """Bits of the cheapest segmentation of ``value``; takes time nearly in proportion to its length."""
    n, low = len(value), value.lower()
    plain = low.translate(_SWAPS)
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            dates.setdefault(m.end(), []).append(i)
    cost = [0.0] + [math.inf] * n
    classes = [_class_of(c) for c in value]
    present = 0
    for c in classes:
        present |= c
    masks = [m for m in range(1, 16) if m & present == m] or [0]
    brute = dict.fromkeys(masks, math.inf)  # cheapest way to end in a brute-force span of each alphabet
    word = number = math.inf  # the same in lower case after any first letter, and in digits behind that
    total = [0.0, *accumulate(map(_brute_bits, value))]
    same, walk, turns, before = [0] * (_SHORT_BLOCK + 1), 1, 0, 0
    repeats = _long_repeats(value)
    for i in range(n):
        # brute force: one more character, or a new span
        bits, kind, end = _brute_bits(value[i]), classes[i], i + 1
        for mask in masks:
            brute[mask] = math.inf if kind & mask != kind else min(brute[mask], cost[i] + CUT_BITS) + (_JOINT[mask] if kind else bits)
        number = min(number, word) + bits if kind == 1 else math.inf
        word = min(word if kind == 2 else math.inf, cost[i] + CUT_BITS) + bits if kind in (2, 4) else math.inf
        cost[end] = min(cost[end], word, number, min(brute.values()))
        # words that end here
        for start in range(max(0, end - _LONGEST_WORD), end - 2):
            for form, extra in ((low, 0.0), (plain, 2.0)):
                rank = ranks.get(form[start:end])
                if rank:
                    case = 0.0 if value[start:end].islower() else 1.0 if value[start + 1:end].islower() else 3.0
                    cost[end] = min(cost[end], cost[start] + CUT_BITS + math.log2(rank + 1) + extra + case)
        for start in dates.get(end, ()):
            cost[end] = min(cost[end], cost[start] + CUT_BITS + math.log2(120 * (365 if end - start > 4 else 1)))
        # repeats of a block: as many as end here
        blocks = repeats.get(end, [])
        for size in range(1, min(i, _SHORT_BLOCK) + 1):
            same[size] = same[size] + 1 if value[i] == value[i - size] else 0
            if same[size] >= size:
                blocks = [*blocks, (size, same[size] // size + 1)]
        for size, times in blocks:
            start = end - times * size
            unit = total[start + size] - total[start]
            cost[end] = min(cost[end], cost[start] + CUT_BITS + unit + math.log2(times))
        # a walk on the keyboard or along the characters: the longest that ends here
        step = ord(low[i]) - ord(low[i - 1]) if i else 0
        if i and (low[i - 1:end] in _NEAR or abs(step) == 1):
            turns += step != before
            walk += 1
        else:
            walk, turns = 1, 0
        before = step
        if walk >= 3:
            cost[end] = min(cost[end], cost[end - walk] + CUT_BITS + math.log2(47) + math.log2(walk) + 2.0 * max(1, min(turns, walk // 2)))
    return cost[n]


# An unquoted value that goes on as a call or a look-up in code, and one that names a variable.
_CODE = re.compile(r"[A-Za-z_][\w.:]*(?:->\w+)*[(\[]|[$%]?[({]")


def _scored(text: str, base: list[tuple[int, int, int, int]], ranks: Mapping[str, int], min_bits: float):
    """(start, kind, end, bits) of values beyond the base spans that are hard to guess."""
    # Spans of a kind neither overlap nor nest, so the last one that starts before an end reaches furthest.
    starts, ends = [[] for _ in KINDS], [[] for _ in KINDS]

    def add(kind: int, a: int, b: int) -> None:
        starts[kind].append(a)
        ends[kind].append(b)

    for a, kind, b, _ in base:
        add(kind, a, b)
    matches = list(_CONTEXT.finditer(text))
    values = {m.span(m.lastindex): m.lastindex < 3 for m in matches}
    if "://" in text:
        for m in _URL.finditer(text):
            values.setdefault(m.span(1), False)
    for (a, b), quoted in sorted(values.items()):
        # A base pattern ends at the first space of a quoted value; the value goes on.
        reach = b - 1 if quoted else a
        if any((k := bisect_left(starts[kind], b)) and ends[kind][k - 1] > reach for kind in range(len(KINDS))):
            continue
        if not quoted and _CODE.match(text, a, b):
            continue
        bits = guess_bits(text[a:b], ranks)
        if bits >= min_bits:
            add(3, a, b)
            yield a, 3, b, bits


def scored_spans(text: str, min_bits: float = 40.0, ranks: Mapping[str, int] = _COMMON) -> list[tuple[int, int, int, float]]:
    """Ordered (start, kind, end, bits) of all secrets of a text; kinds by their place in ``KINDS``."""
    cost = lru_cache(maxsize=64)(lambda value: guess_bits(value, ranks))
    found = []
    named = ":" in text or "=" in text
    if named:
        found += [(m.start(), 0, m.end(), cost(m[2])) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), cost(m[0])) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), cost(m[0])) for m in _HEX.finditer(text)]
    if named or " is " in text:
        found += list(_scored(text, found, ranks, min_bits))
    return sorted(found)


def find_spans(text: str, min_bits: float = 40.0, ranks: Mapping[str, int] = _COMMON) -> list[tuple[int, int, int]]:
    """Ordered (start, kind, end) of all secrets of a text."""
    return [x[:3] for x in scored_spans(text, min_bits, ranks)]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def _scan(id_type: pa.DataType, min_bits: float, ranks):
    def run(batches):
        for batch in batches:
            spans = [scored_spans(t, min_bits, ranks.value) if t else [] for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in x) for x in spans], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), *counts, pa.array([_joined(s for s in x if s[1] < 3) for x in spans], pa.string()),
                 pa.array([_joined(x) for x in spans], pa.string()), pa.array([[s[3] for s in x] for x in spans], pa.list_(pa.float64()))],
                names=["id", "n_assign", "n_access", "n_hex", "n_guess", "base", "spans", "bits"])

    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = 40.0,
                 dictionary: Sequence[str] = ()) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_guess, base, spans, bits) for each row of ``docs``.

    ``base`` and ``spans`` are kind:start:end by start and kind, comma-joined, without and with the guessed
    ones; ``bits`` are the guess costs of the values of ``spans``. ``min_bits`` is the cost from which a
    value beyond the base patterns is a secret. ``dictionary`` lists words, most frequent first.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    long, text = T.LongType(), T.StringType()
    schema = T.StructType([rows.schema["id"], *(T.StructField(n, long) for n in ("n_assign", "n_access", "n_hex", "n_guess")),
                           T.StructField("base", text), T.StructField("spans", text), T.StructField("bits", T.ArrayType(T.DoubleType()))])
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(dictionary))
    found = rows.mapInArrow(_scan(to_arrow_type(rows.schema["id"].dataType), min_bits, ranks), schema)
    return found.withColumnRenamed("id", id_col)
