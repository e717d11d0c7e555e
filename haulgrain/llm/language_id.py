"""Operator 8: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; everything but letters is a space. N-grams of one to ``ORDERS`` characters
that end in a letter are hashed to ``BUCKETS``. Each task counts the n-grams of its labelled texts by
language; the counts are added by language and become a matrix of log probabilities of fixed size
for each language, which is broadcast. Scoring is a sparse batch product: n-grams of a batch gather
their log probabilities, and sums over each text's stretch add them.

Only text and label of the training rows are learned from. A null or letterless text is ``und`` with
score 0, as is every text if nothing could be learned. Null labels aren't learned; a null id is a
training row. Score is the posterior probability. Ties go to the first language in code point order.
Repeated rows are all predicted. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


ORDERS, BUCKETS = 3, 1 << 16
#: Characters taken together.
CHUNK = 1 << 19
_GAP = "\n" * ORDERS
_KEYS = (2_654_435_761, 2_246_822_519, 3_266_489_917, 668_265_263)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        _letters.append(table)
    return _letters[0]


def _ngrams(points: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams and the offsets of rows; each row begins with ``ORDERS`` characters of context."""
    letter = _is_letter()[points]
    chars = np.where(letter, points, 0).astype(np.uint32)
    rows = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.flatnonzero(letter)
    ends = ends[ends >= ORDERS]
    found = np.empty((len(ends), ORDERS), np.int64)
    h = np.zeros(len(ends), np.uint32)
    for k in range(ORDERS):
        h = (h ^ (chars[ends - k] + np.uint32(k + 1))) * np.uint32(_KEYS[k])
        found[:, k] = (h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)
    return found.reshape(-1), np.searchsorted(ends, rows) * ORDERS


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def ngram_chunks(texts: list[str | None]):
    """(first row, end row, buckets, offsets of rows) for stretches of texts; null is empty.

    A text longer than ``CHUNK`` comes in several stretches of its own, each with the characters before it.
    """
    first = 0
    while first < len(texts):
        if len(texts[first] or "") > CHUNK:
            whole = _GAP + texts[first].lower()
            for at in range(ORDERS, len(whole), CHUNK):
                piece = whole[at - ORDERS:at + CHUNK]
                yield first, first + 1, *_ngrams(_points(piece), [len(piece)])
            first += 1
            continue
        end, held = first, 0
        while end < len(texts) and held + len(texts[end] or "") <= CHUNK:
            held += len(texts[end] or "")
            end += 1
        parts = [(t or "").lower() for t in texts[first:end]]
        yield first, end, *_ngrams(_points(_GAP + _GAP.join(parts)), [len(p) + ORDERS for p in parts])
        first = end


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=object)
        for lang in sorted(set(langs.tolist())):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            table = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            rows[lang] = rows.get(lang, 0) + len(own)
            for _, _, buckets, _ in ngram_chunks(own):
                table += np.bincount(buckets, minlength=BUCKETS)
    if counts:
        yield _batch(counts, rows)


def _batch(counts, rows):
    names = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([rows[x] for x in names], pa.int64()),
         pa.array([counts[x].tobytes() for x in names], pa.binary())], names=["lang", "n", "counts"])


def _add(batches):
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for lang, n, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            own = np.frombuffer(own, np.int64)
            counts[lang] = counts[lang] + own if lang in counts else own
            rows[lang] = rows.get(lang, 0) + n
    if counts:
        yield _batch(counts, rows)


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5, most: int = 1000):
    """(languages, log probabilities, log priors) from all rows with a text and a label.

    The driver and each task hold a row of ``BUCKETS`` numbers for each label; more than ``most``
    different labels are an error, as of a column that holds something else.
    """
    rows = train.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    schema = "lang string, n long, counts binary"
    if rows.select(lang_col).distinct().limit(most + 1).count() > most:
        raise ValueError(f"more than {most} different values of {lang_col}")
    counts = rows.mapInArrow(_count, schema)
    counts = counts.repartition("lang", F.pmod(F.hash("counts"), F.lit(16))).mapInArrow(_add, schema)
    counts = counts.repartition("lang").mapInArrow(_add, schema)
    found = sorted((r["lang"], r["n"], bytes(r["counts"])) for r in counts.collect())  # one row a language
    langs = [x[0] for x in found]
    table = np.array([np.frombuffer(x[2], np.int64) for x in found], dtype=np.float64).reshape(len(langs), BUCKETS)
    logs = np.log((table + smoothing) / (table.sum(axis=1, keepdims=True) + smoothing * BUCKETS))
    priors = np.log(np.array([x[1] for x in found], dtype=np.float64) / max(1, sum(x[1] for x in found)))
    return langs, logs, priors


def _predict(model, id_type: pa.DataType):
    def run(batches):
        langs, logs, priors = model.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            best, score = ["und"] * len(texts), np.zeros(len(texts))
            total, seen = np.zeros((len(langs), len(texts))), np.zeros(len(texts), bool)
            for first, _, buckets, at in ngram_chunks(texts) if langs else ():
                some = np.flatnonzero(np.diff(at))
                if len(some):
                    seen[first + some] = True
                    for k, row in enumerate(logs):
                        total[k, first + some] += np.add.reduceat(row[buckets], at[some])
            rows = np.flatnonzero(seen)
            if len(rows):
                own = total[:, rows] + priors[:, None]
                score[rows] = 1.0 / np.exp(own - own.max(axis=0)).sum(axis=0)
                for i, k in zip(rows.tolist(), own.argmax(axis=0).tolist(), strict=True):
                    best[i] = langs[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(2), pa.array(best, pa.string()), pa.array(score)],
                names=["id", "held_out", "lang_pred", "score"])

    return run


def held_out(id_col: Column, parts: int = 4, part: int = 2) -> Column:
    """The rows kept back from learning, by the crc32 of the id's text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) for each row of ``docs``, learned from the rows not held out."""
    kept_back = held_out(F.col(id_col))
    model = docs.sparkSession.sparkContext.broadcast(learn(docs.filter(~kept_back), text_col, lang_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), kept_back.alias("held_out"))
    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    found = rows.mapInArrow(_predict(model, to_arrow_type(rows.schema["id"].dataType)), schema)
    return found.withColumnRenamed("id", id_col)
