"""Operator 12: stretches of words that repeat with a period (runs), and texts without the repeats.

A run's period starts with a Lyndon word: one that is least among its own suffixes, in the order of
words or in the reverse order. The longest Lyndon word at each position, in both orders, is therefore
a complete list of candidates. Each is extended to the right by the longest common extension of its two
ends in the document's suffix tree, and to the left in the tree of the reversed document. Trees are
Ukkonen's; extensions are lowest common ancestors by a Euler tour, answered in constant time. The Lyndon
words come from the next smaller rank of suffixes in the tour's order.

Trees are built of the parts of a document that can hold a run at all. Any word of a run of length
``min_length`` or more and at least twice its period lies in a window of ``min_length // 2`` words
that the document has twice: the window fits within a period, or moves by the period without leaving
the run. So runs lie in stretches covered by such windows, and a word beside a stretch extends no run.

Words are numbered by text, so equal numbers mean equal words. A null or empty text has no words and no
runs. Repeated rows, null ids and ties give a row each; runs are ordered by start, then period. An empty
table gives an empty table. Other columns are ignored. Texts are taken whole; a task holds about
100 bytes for each word of a document and 500 for each word of its longest stretch.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from haulgrain.llm.suffix_tree import Extensions, SuffixTree

#: Words of documents taken together.
CHUNK_WORDS = 1 << 18
_KEYS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the distance to the next place of smaller rank, or to the end."""
    values, n = rank.tolist(), len(rank)
    found, open_places = [0] * n, []
    for i in range(n - 1, -1, -1):
        own = values[i]
        while open_places and values[open_places[-1]] > own:
            open_places.pop()
        found[i] = (open_places[-1] if open_places else n) - i
        open_places.append(i)
    return np.array(found, np.int64)


def stretch_runs(words: np.ndarray, min_length: int = 12) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence, by start, then period."""
    n = len(words)
    symbols = (np.unique(words, return_inverse=True)[1].reshape(-1) + 1).tolist()
    tree = SuffixTree(symbols)
    forward = tree.leaves()
    ranks = []
    for suffixes, _ in (forward, tree.leaves(backwards=True)):
        rank = np.empty(n + 1, np.int64)
        rank[suffixes] = np.arange(n + 1)
        ranks.append(rank[:n])
    del tree
    right = Extensions(*forward)
    left = Extensions(*SuffixTree(symbols[::-1]).leaves())

    starts = np.tile(np.arange(n), 2)
    period = np.concatenate([_next_smaller(rank) for rank in ranks])
    some = starts + period < n
    starts, period = starts[some], period[some]
    after = right(starts, starts + period)
    # Position i of the document is n - 1 - i of the reversed one; n is its end.
    before = left(n - starts, n - starts - period)
    length = before + period + after
    runs = np.stack([starts - before, length, period], axis=1)[(length >= 2 * period) & (length >= min_length)]
    runs = np.unique(runs, axis=0).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _covered(words: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """The words that lie in a window which its document has at least twice.

    Windows are compared by a 64-bit hash: two that differ but agree in it only cover more words.
    """
    n = len(words)
    cover = np.zeros(n + 1, np.int64)
    if n >= window:
        document = np.repeat(np.arange(len(sizes)), sizes)
        fits = document[:n - window + 1] == document[window - 1:]
        with np.errstate(over="ignore"):
            mixed = (words.astype(np.uint64) + np.uint64(1)) * _KEYS[0]
            mixed ^= mixed >> np.uint64(29)
            found = document[:n - window + 1].astype(np.uint64) * _KEYS[1]
            for k in range(window):
                found = (found + mixed[k:n - window + 1 + k]) * _KEYS[2]
                found ^= found >> np.uint64(31)
        places = np.flatnonzero(fits)
        found = found[places]
        ordered = np.sort(found)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, found), len(twice) - 1)
            hit = places[twice[at] == found]
            cover[hit] += 1
            cover[hit + window] -= 1
    return np.cumsum(cover[:n]) > 0


def _stretches(covered: np.ndarray, least: int):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if end - start >= least:
            yield start, end


def document_runs(words: np.ndarray, covered: np.ndarray, min_length: int) -> np.ndarray:
    """Rows (start, length, period) of a document's runs, by start, then period."""
    found = [np.empty((0, 3), np.int64)]
    for start, end in _stretches(covered, min_length):
        found.append(stretch_runs(words[start:end], min_length) + [start, 0, 0])
    return np.concatenate(found)


def _chunks(sizes: list[int]):
    first = 0
    while first < len(sizes):
        end, held = first, 0
        while end < len(sizes) and (end == first or held + sizes[end] <= CHUNK_WORDS):
            held += sizes[end]
            end += 1
        yield first, end
        first = end


def _find(min_length: int, remap, id_type: pa.DataType):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def chunk(ids, texts):
        split = [(t or "").encode().split() for t in texts]  # bytes split at ASCII white space only
        number: dict[bytes, int] = {}
        numbers = np.array([number.setdefault(w, len(number)) for w in chain.from_iterable(split)], np.int64)
        ends = np.cumsum([len(w) for w in split])
        documents = []
        for k, (id, words) in enumerate(zip(ids, split, strict=True)):
            own = numbers[ends[k] - len(words):ends[k]]
            if remap and (order := remap(id, len(words))) is not None:
                own = own[order]
                split[k] = [words[i] for i in order.tolist()]
            documents.append(own)
        flat = np.concatenate(documents) if documents else numbers
        covered = _covered(flat, np.diff(ends, prepend=0), min_length // 2)
        runs, kept = [], []
        for k, words in enumerate(split):
            since = ends[k] - len(words)
            own = covered[since:ends[k]]
            found = document_runs(documents[k], own, min_length) if own.any() else ()
            if len(found):
                drop = np.zeros(len(words) + 1, np.int64)
                np.add.at(drop, found[:, 0] + found[:, 2], 1)
                np.add.at(drop, found[:, 0] + found[:, 1], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()] if len(found) else [])
            kept.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array([len(w) for w in split], pa.int64()), pa.array(runs, run_type),
             pa.array(kept, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            # Six bytes a word are only a guess at the size of a chunk.
            sizes = [len(t or "") // 6 for t in texts.to_pylist()]
            for first, end in _chunks(sizes):
                yield chunk(ids.slice(first, end - first).to_pylist(), texts.slice(first, end - first).to_pylist())

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12,
              remap: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row of ``docs``.

    ``runs`` lists (start, length, period) of every maximal stretch whose words repeat at the distance
    of its smallest period, at least ``min_length`` long and two periods. ``collapsed`` is the text
    without the words that a run holds after its first period, joined by one space. ``remap`` may name
    for an id and a number of words the word to put in each place, before runs are looked for.
    """
    if min_length < 2:
        raise ValueError("a run has at least two words")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(
        T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType())])
    found = rows.mapInArrow(_find(min_length, remap, to_arrow_type(rows.schema["id"].dataType)), schema)
    return found.withColumnRenamed("id", id_col)
