"""Operator 11: exact top-k search by inner product, one term at a time.

Vector components become integers, ``floor(scale * x)``. The rows to search are dealt into groups of
bounded size; each group's task inverts them into postings, (row, weight) by dimension. Every query
visits every group. Its non-zero components are its terms: each scatters its weighted postings into a
dense array of scores, one place a row. The best ``k`` are selected by partitioning that array, and
the groups' lists merge by rank.

Nothing is skipped, so the result is exact; the work is queries times rows times dimensions, in tasks
of at most ``GROUP_TERMS`` stored components and ``QUERY_TERMS`` query components. Every row is shipped
once for each block of queries and every query once for each group. Queries are streamed through a task.

A row is a candidate of all queries but itself; repeated rows are candidates of each other, and each
is a query of its own. Ties go to the smaller id, null ids last, then to the row read first. Vectors
that are null or hold a null, infinite or undefined component take no part. Vectors of different
lengths are compared as if filled up with zeros, an empty vector scores 0 with all. Integer components
and scores beyond a signed 64-bit number are held at its ends, scores after they are summed without
overflow; those held tie. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from haulgrain.llm.tables import written

#: Stored components of a group, and query components of a task.
GROUP_TERMS, QUERY_TERMS = 1 << 24, 1 << 21
_ENDS = -(1 << 63), (1 << 63) - 1
_WIDTHS = [np.dtype(x) for x in ("<i1", "<i2", "<i4", "<i8")]
#: From this share of rows a dimension's postings are kept as a whole column.
_DENSE = 0.5


def _floors(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; beyond their range the nearest end."""
    whole = np.floor(values * scale)
    found = np.where(np.abs(whole) < 2.0 ** 63, whole, 0).astype(np.int64)
    found[whole >= 2.0 ** 63] = _ENDS[1]
    found[whole < -(2.0 ** 63)] = _ENDS[0]
    return found


def _pack(scale: float, id_type: pa.DataType):
    """Vectors as integers of the narrowest width that holds them; unusable ones are left out."""
    def run(batches):
        for batch in batches:
            rows, ids, packed, terms = [], [], [], []
            vectors = batch.column(2)
            flat = vectors.flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))  # a null reads as NaN
            sizes = vectors.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            whole = _floors(np.where(np.isfinite(values), values, 0.0), scale)
            usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
            for i in np.flatnonzero(usable).tolist():
                own = whole[ends[i] - sizes[i]:ends[i]]
                code = next(c for c, w in enumerate(_WIDTHS) if not len(own) or (
                    np.iinfo(w).min <= own.min() and own.max() <= np.iinfo(w).max))
                rows.append(i)
                packed.append(bytes([code]) + own.astype(_WIDTHS[code]).tobytes())
                terms.append(len(own))
            keep = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep).cast(id_type),
                 pa.array(packed, pa.binary()), pa.array(terms, pa.int64())], names=["row", "id", "packed", "terms"])

    return run


def _vector(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, _WIDTHS[packed[0]], offset=1)


class _Postings:
    """The rows of a group by dimension; places follow id, then row, so the first of a tie is the right one."""

    def __init__(self, held: list[tuple]):
        held.sort(key=lambda x: (x[1] is None, x[1] if x[1] is not None else 0, x[0]))
        self.rows = np.array([x[0] for x in held], np.int64)
        self.ids = [x[1] for x in held]
        self.places = {row: i for i, row in enumerate(self.rows.tolist())}
        vectors = [_vector(x[2]) for x in held]
        sizes = np.array([len(v) for v in vectors])
        values = np.concatenate([v.astype(np.int64) for v in vectors])
        row = np.repeat(np.arange(len(held)), sizes)
        term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        some = np.flatnonzero(values)
        some = some[np.argsort(term[some], kind="stable")]
        terms, starts = np.unique(term[some], return_index=True)
        self.largest = max((abs(int(values.min())), abs(int(values.max())))) if len(values) else 0
        self.slices = list(zip(terms.tolist(), starts.tolist(), [*starts[1:].tolist(), len(some)], strict=True))
        self.row, self.weight, self.built = row[some], values[some], {}

    def kind(self, query: np.ndarray):
        """The narrowest type in which no score of this query can overflow."""
        most = self.largest * max((abs(int(x)) for x in (query.min(), query.max())), default=0) * len(query) if len(query) else 0
        return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object

    def of(self, kind):
        """(rows or None for all, weights) by dimension, in one number type."""
        if kind not in self.built:
            found = {}
            for term, start, end in self.slices:
                rows, weights = self.row[start:end], self.weight[start:end].astype(kind)
                if kind is not object and end - start >= _DENSE * len(self.rows):
                    column = np.zeros(len(self.rows), kind)
                    column[rows] = weights
                    rows, weights = None, column
                found[term] = rows, weights
            self.built[kind] = found
        return self.built[kind]

    def scores(self, query: np.ndarray) -> np.ndarray:
        kind = self.kind(query)
        postings = self.of(kind)
        found = np.zeros(len(self.rows), kind)
        part = np.empty(len(self.rows), kind)
        for term in np.flatnonzero(query).tolist():
            if term not in postings:
                continue
            rows, weights = postings[term]
            weight = int(query[term]) if kind is object else kind(query[term])
            if rows is None:
                np.multiply(weights, weight, out=part)
                found += part
            else:
                found[rows] += weights * weight
        return found if kind is not object else np.clip(found, *_ENDS).astype(np.int64)

    def best(self, row: int, query: np.ndarray, k: int) -> list[tuple]:
        """(row, id, score) of the best ``k`` rows other than ``row``."""
        found = self.scores(query)
        need = min(k + 1, len(found))
        least = np.partition(found, len(found) - need)[len(found) - need]
        above = np.flatnonzero(found > least)
        level = np.flatnonzero(found == least)[:need - len(above)]
        picked = sorted(((-int(found[i]), i) for i in above.tolist()))
        own = self.places.get(row)
        order = [i for _, i in picked] + level.tolist()
        return [(int(self.rows[i]), self.ids[i], int(found[i])) for i in order if i != own][:k]


def _search(k: int, id_type: pa.DataType):
    """Tasks read a cell's candidates, then its queries."""
    def run(batches):
        cell, held, postings = None, [], None
        for batch in batches:
            out = []
            for own, side, row, id, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != cell:
                    cell, held, postings = own, [], None
                if side == 0:
                    held.append((row, id, packed))
                elif held or postings:
                    if postings is None:
                        postings, held = _Postings(held), []
                    out += [(row, id, *x) for x in postings.best(row, _vector(packed), k)]
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), id_type, pa.int64(), id_type, pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["query_row", "query_id", "row", "id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding", group_terms: int = GROUP_TERMS, query_terms: int = QUERY_TERMS) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` best rows for each row of ``vectors`` where ``is_query``.

    ``is_query`` is an expression over the id column; null is no query.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                          F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("query"))
    id_field = rows.schema["id"]
    id_type = to_arrow_type(id_field.dataType)
    long = T.LongType()
    packed_schema = T.StructType([T.StructField("row", long), id_field, T.StructField("packed", T.BinaryType()), T.StructField("terms", long)])
    # Written first, so that the number of a row is the same for everyone who reads it.
    rows = written(rows, "vectors")
    packed = written(rows.select("row", "id", "vector").mapInArrow(_pack(scale, id_type), packed_schema), "packed")
    asked = packed.join(rows.filter("query").select("row"), "row", "left_semi")

    stored = packed.agg(F.sum("terms")).first()[0] or 0
    queried = asked.agg(F.sum("terms")).first()[0] or 0
    groups = max(2 * spark.sparkContext.defaultParallelism, -(-stored // group_terms))
    blocks = max(1, -(-queried // query_terms))
    group, block = (F.pmod(F.xxhash64("row"), F.lit(n)).cast("int") for n in (groups, blocks))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))

    own = ["row", "id", "packed"]
    stored_cells = packed.withColumn("group", group).withColumn("block", every(blocks)).withColumn("side", F.lit(0))
    query_cells = asked.withColumn("group", every(groups)).withColumn("block", block).withColumn("side", F.lit(1))
    cells = stored_cells.unionByName(query_cells).withColumn("cell", F.col("group") * F.lit(int(blocks)) + F.col("block"))
    found_schema = T.StructType([T.StructField("query_row", long), T.StructField("query_id", id_field.dataType),
                                 T.StructField("row", long), id_field, T.StructField("score", long)])
    found = cells.select("cell", "side", *own).repartitionById(int(groups * blocks), F.col("cell")).sortWithinPartitions(
        "cell", "side").mapInArrow(_search(k, id_type), found_schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
