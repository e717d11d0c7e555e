"""Operator 13: words of a corpus that differ by one letter, and the usual form of each.

Words are counted per document and task, then added. Words that differ by one inserted, deleted or
replaced letter have letter counts at a squared distance of one or two, and lengths that differ by one
at most. So words are laid in blocks by length, and pairs of blocks of the same and of adjacent lengths
are multiplied: the product of two blocks' letter counts gives all squared distances of their words.
Pairs at most two apart are then compared letter by letter.

A block is further narrowed by how many of its words' letters fall in each of ``PARTS`` classes of code
points: one edit moves these counts by one in one class, or by one up and one down. Only such blocks
meet. Blocks of more than ``BLOCK`` words are dealt by hash, and each part meets all parts of the other.
A task holds one block and streams the blocks that it meets.

Words come from maximal runs of ASCII and Latin-1 letters, with A-Z in lower case. Null and empty texts
have none; a null id spoils no word. Repeated rows count again. A word's form is its near word of
largest count, ties by code point order, if it is ``ratio`` times as frequent; forms thus grow, and
following them ends after a number of steps below the logarithm of the largest count. An empty table
gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.tables import split_join, written

#: Words of a block, and classes of letters.
BLOCK, PARTS = 1024, 4
#: Different words that a task counts before it hands them on, and their characters.
HELD_WORDS, HELD_CHARS = 200_000, 8_000_000
_LETTERS = [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]
#: Latin-1 bytes: letters as they are, A-Z in lower case, anything else a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32 for c in range(256))


def text_words(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_TABLE).split()


def misspell(id, word: bytes, every: int) -> bytes:
    """The word, or for one in ``every`` words and documents the word without one of its letters."""
    key = zlib.crc32(f"{id}:{word.decode('latin-1')}".encode())
    if key % every:
        return word
    at = key % len(word)
    return word[:at] + word[at + 1:]


def _count(least: int, every: int | None):
    def emit(counts):
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        chars = 0
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(text_words(text or "")).items():
                    if len(word) < least:
                        continue
                    if every and id is not None:
                        word = misspell(id, word, every)
                        if len(word) < least:
                            continue
                    if word not in counts:
                        chars += len(word)
                    counts[word] += n
                if len(counts) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield emit(counts)
                    counts, chars = Counter(), 0
        if counts:
            yield emit(counts)

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6,
                min_count: int = 5, every: int | None = None) -> DataFrame:
    """(word, n) of the words of at least ``min_chars`` letters that occur ``min_count`` times in all texts.

    With ``every``, one in so many words and documents loses a letter first, chosen by a checksum.
    """
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    counts = rows.mapInArrow(_count(min_chars, every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _place(batches):
    """Each word's length and its letters by class of code point."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sizes = np.array([len(w) for w in words], np.int64)
        found = np.bincount(np.repeat(np.arange(len(words)), sizes) * PARTS + points % PARTS, minlength=len(words) * PARTS)
        shape = pa.array(found.reshape(len(words), PARTS).tolist(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, shape], names=["word", "n", "shape"])


def _meetings(shape: Column) -> Column:
    """The shapes whose blocks a block is sent to: its own, half of those one replacement away, and those
    of one letter less. Of two shapes of equal length the lower one receives."""
    def moved(change: dict[int, int]) -> Column:
        return F.array(*[shape[i] + F.lit(change.get(i, 0)) for i in range(PARTS)])

    own = [moved({})]
    replaced = [moved({i: -1, j: 1}) for i in range(PARTS) for j in range(i + 1, PARTS)]
    shorter = [moved({i: -1}) for i in range(PARTS)]
    return F.array(*own, *replaced, *shorter)


class _Block:
    """Words of one length as rows of code points."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = words, counts
        self.length = len(words[0])
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), self.length)
        # Sums of squared counts stay exact in the chosen type.
        self.kind = np.float32 if self.length < 1 << 11 else np.float64

    def letters(self, columns: np.ndarray) -> np.ndarray:
        """Counts of the given letters, one row a word."""
        at = np.searchsorted(columns, self.points)
        known = columns[np.minimum(at, len(columns) - 1)] == self.points
        row = np.broadcast_to(np.arange(len(self.words))[:, None], at.shape)[known]
        found = np.bincount(row * len(columns) + at[known], minlength=len(self.words) * len(columns))
        return found.reshape(len(self.words), len(columns)).astype(self.kind)

    def norms(self) -> np.ndarray:
        ordered = np.sort(self.points, axis=1)
        # A letter's k-th copy adds 2k - 1 to the square of its count.
        copy = np.ones(ordered.shape, np.int64)
        for k in range(1, self.length):
            copy[:, k] = np.where(ordered[:, k] == ordered[:, k - 1], copy[:, k - 1] + 1, 1)
        return (2 * copy - 1).sum(axis=1).astype(self.kind)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points, ``b`` as long as ``a`` or one longer, differ by one edit."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    before = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= n


#: Pairs of words that are compared letter by letter at a time, in letters.
_COMPARED = 1 << 22


def near_pairs(home: _Block, other: _Block, same: bool):
    """Row numbers (home, other) of words one edit apart; ``same`` takes each pair of a block once."""
    columns = np.unique(home.points)
    kind = np.promote_types(home.kind, other.kind)
    product = home.letters(columns).astype(kind) @ other.letters(columns).astype(kind).T
    distance = home.norms().astype(kind)[:, None] + other.norms().astype(kind)[None, :] - 2 * product
    wanted = 2 if home.length == other.length else 1  # words of the same letters at distance 0 are two edits apart
    a, b = np.nonzero(distance == wanted)
    if same:
        a, b = a[a < b], b[a < b]
    step = max(1, _COMPARED // max(1, other.length))
    kept = [np.flatnonzero(_one_edit(home.points[a[i:i + step]], other.points[b[i:i + step]])) + i
            for i in range(0, len(a), step)]
    kept = np.concatenate(kept) if kept else np.empty(0, np.int64)
    return a[kept], b[kept]


def _meet(batches):
    """Tasks read a cell's own block, then the blocks sent to it."""
    cell, home = None, None
    for batch in batches:
        for own, place, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = _Block(words, counts)
            if own != cell:
                cell, home = own, block
            a, b = near_pairs(home, block, place == 0)
            if len(a):
                a, b = a.tolist(), b.tolist()
                columns = [[home.words[i] for i in a], [home.counts[i] for i in a],
                           [block.words[i] for i in b], [block.counts[i] for i in b]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64()] * 2, strict=True)],
                    names=["a", "a_n", "b", "b_n"])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, a_n, b, b_n) for each pair of different words of ``words`` (word, n) that are one edit apart.

    Words are distinct; each pair comes once. An empty word is near the words of one letter only if it
    is in no table: empty and null words are left out.
    """
    placed = written(words.filter("length(word) > 0").select("word", "n").mapInArrow(
        _place, "word string, n long, shape array<int>"), "placed")
    sizes = placed.groupBy("shape").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    dealt = split_join(placed, sizes, ["shape"]).withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    blocks = written(dealt.groupBy("shape", "part").agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")), "blocks")
    # A block goes to every part of the shapes it meets, and of its own shape to the parts up to its own.
    sent = blocks.select("*", F.explode(_meetings(F.col("shape"))).alias("to"))
    homes = blocks.select(F.col("shape").alias("to"), F.col("part").alias("to_part"))
    met = sent.join(homes, "to").filter((F.col("to") != F.col("shape")) | (F.col("to_part") <= F.col("part")))
    home = (F.col("to") == F.col("shape")) & (F.col("to_part") == F.col("part"))
    cells = met.select(F.struct("to", "to_part").alias("cell"), F.when(home, 0).otherwise(1).alias("place"), "words", "counts")
    return cells.repartition("cell").sortWithinPartitions("cell", "place").mapInArrow(
        _meet, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the end, in doubling steps."""
    found = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(found.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "roots")
        found = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return found


def variants(words: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of ``words`` (word, n); words are distinct."""
    words = written(words.select("word", "n"), "words")
    pairs = near_words(words, block)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("low"), "near")).alias("best"))
    usual = -F.col("best.low") >= F.lit(ratio) * F.col("n")
    known = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.near")).alias("form"), F.when(usual, -F.col("best.low")).alias("form_n")), "forms")
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
