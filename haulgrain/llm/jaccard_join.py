"""Operator 6: n-gram Jaccard self join by prefix trees.

Every text is the set of its distinct word shingles, hashed to 64 bits. Two texts link when their
Jaccard similarity reaches the threshold. The steps:

1. One pass hashes all texts to a set key and a set size, and counts all shingles of the corpus in a
   sketch of fixed size. The sketch only orders shingles, rare ones first; it decides no result.
2. Equal sets are one node. Each set sends its prefix, the rarest shingles of which linked sets must
   share one, to the task of the shingle, packed into arrays.
3. Sets that share a prefix shingle, and whose sizes and places of the shingle allow a link, meet in
   the cell of the least of them. Cells above a weight are dealt in pairs of blocks, so each task is bounded whatever the size of the group.
4. Only texts in some cell are shipped, compressed, which takes less than their hashed sets. Each
   task hashes them, stores a block in a prefix tree of ordered n-grams and walks it with each set of the other block: overlaps of shared paths are
   counted once, and subtrees that cannot reach the threshold by their remaining length are cut.
5. Verified links are joined to components.

No link is dropped: a cell holds every pair that shares a prefix shingle of that cell. A task sends on
a spanning forest of the links it finds, which keeps components as they are.

Null and empty texts, and texts without words, have an empty set and link with nothing. Rows with
equal texts, or that repeat an id, are all kept and get the same component; the least non-null id of
a component names it (null if all its ids are null). An empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_type

from haulgrain.llm.graph import components
from haulgrain.llm.shingle_hash import mix, set_keys, shingle_sets
from haulgrain.llm.tables import WORD, fresh_name, split_join, written
from haulgrain.session import SMALL_BATCHES, tune

#: The threshold as a fraction: 3 / 4.
SIMILAR = (3, 4)
#: Counters of the order sketch, in slices that are added up apart.
SKETCH_BITS, SLICES = 21, 16
#: Prefix shingles in one packed group; shingles of a block of a cell.
GROUP_SHINGLES, BLOCK_SHINGLES = 400_000, 1_000_000
#: Prefix shingles that a task holds before it packs them.
FLUSH_SHINGLES = 250_000
#: Counts above the sketch's median from which a shingle's group is split.
HOT_SHINGLE = 1_000_000


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _profile(size: int, id_type: pa.DataType):
    """Each row's set key and size, then the task's shingle counts."""
    names = ["id", "text_hash", "key", "n", "slice", "counts"]

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            keys, sizes = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for first, values, at in shingle_sets(batch.column(1), size):
                end = first + len(at) - 1
                keys[first:end] = set_keys(values, at).view(np.int64)
                sizes[first:end] = np.diff(at)
                np.add.at(counts, _bucket(values), 1)
            empty = pa.nulls(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(2), pa.array(keys), pa.array(sizes),
                 empty.cast(pa.int32()), empty.cast(pa.binary())], names=names)
        packed = [zlib.compress(part.astype(np.int64).tobytes(), 1) for part in np.split(counts, SLICES)]
        none = pa.nulls(SLICES)
        yield pa.RecordBatch.from_arrays(
            [none.cast(id_type), *(none.cast(pa.int64()) for _ in range(3)),
             pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary())], names=names)

    return run


def _add_slices(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(part.as_py()), np.int64)
            sums[k] = sums[k] + part if k in sums else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
        names=["slice", "counts"])


def _sketch(parts: DataFrame) -> np.ndarray:
    """The tasks' counts added up in two levels; the result has a fixed size."""
    tasks = parts.filter("slice = 0").count()
    level = max(1, math.isqrt(tasks))
    parts = parts.repartition(level * 2, F.pmod(F.hash("counts"), F.lit(level)))
    parts = parts.mapInArrow(_add_slices, "slice int, counts binary")
    parts = parts.repartition(SLICES, "slice").mapInArrow(_add_slices, "slice int, counts binary")
    counts = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), dtype=np.int64)
    for row in parts.toLocalIterator():
        counts[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return counts.reshape(-1)


def _prefix_length(n: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """A set of n shingles shares one of its first so many with every set that it links with."""
    top, bottom = similar
    return np.where(n > 0, n - (-(-n * top // bottom)) + 1, 0)


def _prefixes(size: int, similar: tuple[int, int], sketch, middle: int, groups: int, hot: int):
    """Packed (group, shingles, set keys, index of set): each distinct set of the task sends its prefix."""

    def flush(columns):
        values, keys, sizes, place = map(np.concatenate, zip(*columns, strict=True))
        above = sketch.value[_bucket(values)] - middle
        parts = np.where(above > hot, above // hot + 1, 1).astype(np.uint64)
        salt = np.where(parts > 1, mix(keys) % parts + np.uint64(1), np.uint64(0))
        group = (mix(values + salt) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((values, salt, group))
        values, keys, sizes, place, salt, group = (x[order] for x in (values, keys, sizes, place, salt, group))
        cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own, first, index = np.unique(keys[a:b], return_index=True, return_inverse=True)
            salts = salt[a:b].astype(np.uint32).tobytes() if salt[a:b].any() else b""
            rows.append((int(group[a]), values[a:b].tobytes(), own.tobytes(), sizes[a:b][first].astype(np.uint32).tobytes(),
                         index.astype(_index_type(len(own))).tobytes(), place[a:b].tobytes(), salts))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=list(_PACKED))

    def run(batches):
        seen: set[int] = set()  # bounded by the rows of the task
        held, weight = [], 0
        for batch in batches:
            for _, values, at in shingle_sets(batch.column(0), size):
                n, keys = np.diff(at), set_keys(values, at)
                new = np.zeros(len(n), dtype=bool)
                for i, key in enumerate(keys.tolist()):
                    if n[i] and key not in seen:
                        seen.add(key)
                        new[i] = True
                owner = np.repeat(np.arange(len(n)), n)
                mine = new[owner]
                values, owner = values[mine], owner[mine]
                order = np.lexsort((values, sketch.value[_bucket(values)], owner))
                values, owner = values[order], owner[order]
                starts = np.concatenate(([0], np.cumsum(np.where(new, n, 0))))
                place = np.arange(len(values)) - starts[owner]
                take = place < _prefix_length(n, similar)[owner]
                owner, place = owner[take], place[take]
                # The place in 256ths of the set, rounded down.
                held.append((values[take], keys[owner], n[owner], (place * 256 // n[owner]).astype(np.uint8)))
                weight += len(owner)
                if weight > FLUSH_SHINGLES:
                    yield flush(held)
                    held, weight = [], 0
        if weight:
            yield flush(held)

    return run


_PACKED = ("grp", "shingles", "keys", "sizes", "at", "places", "salts")


def _index_type(n: int):
    return np.uint16 if n < 65536 else np.uint32


def runs(batches, column: int = 0):
    """Consecutive rows with an equal key, as one table each."""
    held, key = [], None
    for batch in batches:
        if len(batch) == 0:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and values[a] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = values[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _size_classes(similar: tuple[int, int]) -> np.ndarray:
    """Lower bounds of classes such that sizes of linked sets are in the same or neighbouring ones."""
    top, bottom = similar
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * bottom // top + 1)
    return np.array(bounds)


def _meet(similar: tuple[int, int]):
    """(leader, class, key, shingle): sets that share a prefix shingle, with the least set of them.

    Sets of one shingle meet by pairs of neighbouring size classes, and only if so much of the set is left
    after the shingle as a link with the smallest of them needs (a pair is found at its first shared
    shingle). ``shingle`` is null unless its group was split, when leaders of the parts are still to be joined.
    """
    top, bottom = similar
    bounds = _size_classes(similar)

    def group(table: pa.Table):
        parts = []
        for v, k, n, at, place, s in zip(*(table.column(c).to_pylist() for c in _PACKED[1:]), strict=True):
            v, k, n = np.frombuffer(v, np.uint64), np.frombuffer(k, np.int64), np.frombuffer(n, np.uint32)
            at = np.frombuffer(at, _index_type(len(k)))
            parts.append((v, k[at], n[at].astype(np.int64), np.frombuffer(place, np.uint8).astype(np.int64),
                          np.frombuffer(s, np.uint32) if s else np.zeros(len(v), np.uint32)))
        values, keys, sizes, places, salts = map(np.concatenate, zip(*parts, strict=True))
        # Only shingles that occur twice matter.
        order = np.lexsort((salts, values))
        values, keys, sizes, places, salts = (x[order] for x in (values, keys, sizes, places, salts))
        same = (values[1:] == values[:-1]) & (salts[1:] == salts[:-1])
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same)) | (salts > 0)
        values, keys, sizes, places, salts = (x[shared] for x in (values, keys, sizes, places, salts))
        low = np.searchsorted(bounds, sizes, side="right")
        two = lambda x: np.concatenate((x, x))
        classes = np.concatenate((low, low - 1))  # as the smaller, and as the larger of a pair of classes
        smaller = np.repeat([True, False], len(low))
        values, keys, sizes, places, salts = map(two, (values, keys, sizes, places, salts))
        order = np.lexsort((classes, salts, values))
        values, keys, sizes, places, salts, classes, smaller = (
            x[order] for x in (values, keys, sizes, places, salts, classes, smaller))
        if not len(values):
            return
        new_shingle = np.concatenate(([True], (values[1:] != values[:-1]) | (salts[1:] != salts[:-1])))
        start = np.flatnonzero(new_shingle | np.concatenate(([True], classes[1:] != classes[:-1])))
        has_small, has_large = np.maximum.reduceat(smaller, start), np.maximum.reduceat(~smaller, start)
        # A split shingle's sets may meet those of other parts. Else a class on its own is a run unless the pair of classes below holds it too.
        joined = np.concatenate(([False], ~new_shingle[start[1:]] & has_small[:-1] & (classes[start[1:]] == classes[start[:-1]] + 1)))
        whole = has_small & (has_large | ~joined) | (salts[start] > 0)
        lengths = np.diff(np.concatenate((start, [len(values)])))
        least = np.repeat(np.minimum.reduceat(sizes, start), lengths)
        left = sizes - places * sizes // 256
        partner = np.maximum(np.where(salts > 0, 0, least), -(-sizes * top // bottom))
        alive = np.repeat(whole, lengths) & ((top + bottom) * left >= top * (sizes + partner))
        run = np.repeat(np.arange(len(start)), lengths)[alive]
        values, keys, salts, classes = (x[alive] for x in (values, keys, salts, classes))
        if not len(values):
            return
        order = np.lexsort((keys, run))
        values, keys, salts, classes, run = (x[order] for x in (values, keys, salts, classes, run))
        start = np.concatenate(([True], run[1:] != run[:-1]))
        leader = keys[np.maximum.accumulate(np.where(start, np.arange(len(keys)), 0))]
        hot = salts > 0
        for part, named in ((~hot & (leader != keys), False), (hot, True)):
            if part.any():
                shingle = values[part].view(np.int64) if named else np.zeros(int(part.sum()), np.int64)
                rows = np.stack((leader[part], classes[part], keys[part], shingle), 1)
                order = np.lexsort(rows.T)
                rows = rows[order]
                rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))]
                columns = [pa.array(rows[:, i].copy()) for i in range(4)]
                if not named:
                    columns[3] = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=["leader", "class", "key", "shingle"])

    def run(batches):
        for table in runs(batches):
            yield from group(table)

    return run


def _pack(id_type: pa.DataType):
    """Texts compressed one by one, for the two shuffles that carry them."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary()).fill_null(b"")
            packed = [pack.compress(t.as_buffer()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(1), pa.array(packed, pa.binary())],
                names=["id", "text_hash", "packed"])

    return run


class PrefixTree:
    """Ordered n-gram sets as a compressed prefix tree, kept in arrays level by level."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        tokens, starts, depth, parent, member = [], [0], [0], [-1], [-1]
        tokens.append(np.zeros(0, np.int64))
        ends, stack, before = [0], [0], None
        total = 0

        def node(owner: np.ndarray, top: int, bottom: int, above: int, who: int) -> int:
            nonlocal total
            tokens.append(owner[top:bottom])
            starts.append(total)
            total += bottom - top
            ends.append(total)
            depth.append(bottom)
            parent.append(above)
            member.append(who)
            return len(depth) - 1

        # Nodes are cut where the next set leaves the path of the one before.
        paths: dict[int, np.ndarray] = {}
        for i in order:
            own = sets[i]
            shared = 0
            if before is not None:
                least = min(len(own), len(before))
                differ = np.flatnonzero(own[:least] != before[:least])
                shared = int(differ[0]) if len(differ) else least
            last = -1
            while depth[stack[-1]] > shared:
                last = stack.pop()
            if depth[stack[-1]] < shared:
                above = stack[-1]
                split = node(paths[last], depth[above], shared, above, -1)
                paths[split] = paths[last]
                starts[last] += shared - depth[above]
                parent[last] = split
                stack.append(split)
            leaf = node(own, shared, len(own), stack[-1], i)
            paths[leaf] = own
            stack.append(leaf)
            before = own
        parent_of, depths = np.array(parent), np.array(depth)
        sizes = np.array([len(s) for s in sets] or [0])
        least_size = np.where(np.array(member) >= 0, sizes[np.array(member)], np.iinfo(np.int64).max)
        most_size = np.where(np.array(member) >= 0, sizes[np.array(member)], 0)
        for i in np.argsort(-depths, kind="stable"):  # children before parents
            if parent_of[i] >= 0:
                least_size[parent_of[i]] = min(least_size[parent_of[i]], least_size[i])
                most_size[parent_of[i]] = max(most_size[parent_of[i]], most_size[i])
        self.tokens = np.concatenate(tokens)
        self.starts, self.ends = np.array(starts), np.array(ends)
        self.depth, self.member, self.sizes = depths, np.array(member), sizes
        self.least, self.most = least_size, most_size
        by_parent = np.argsort(parent_of, kind="stable")
        self.children = by_parent
        self.child_at = np.searchsorted(parent_of[by_parent], np.arange(len(depths) + 1))

    def linked(self, query: np.ndarray, mark: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
        """Members whose similarity with ``query`` (ordered tokens; also set in ``mark``) is reached."""
        top, bottom = similar
        n, found = len(query), []
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            counts = self.child_at[nodes + 1] - self.child_at[nodes]
            overlap = np.repeat(overlap, counts)
            nodes = self.children[_ranges(self.child_at[nodes], counts)]
            if not len(nodes):
                break
            lengths = self.ends[nodes] - self.starts[nodes]
            hits = mark[self.tokens[_ranges(self.starts[nodes], lengths)]]
            overlap = overlap + np.add.reduceat(hits, np.cumsum(lengths) - lengths, dtype=np.int64)
            depth = self.depth[nodes]
            rest = n - np.searchsorted(query, self.tokens[self.ends[nodes] - 1], side="right")
            best = np.clip(depth + rest, self.least[nodes], self.most[nodes])
            bound = overlap + np.minimum(rest, best - depth)
            alive = (top + bottom) * bound >= top * (n + best)
            nodes, overlap = nodes[alive], overlap[alive]
            who = self.member[nodes]
            hit = (who >= 0) & ((top + bottom) * overlap >= top * (n + self.sizes[who]))
            found.append(who[hit])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _cell_links(side: np.ndarray, keys: np.ndarray, flat: list[np.ndarray], similar: tuple[int, int]):
    """A spanning forest of the links between the two blocks of a cell, or in its one block."""
    _, once = np.unique(keys, return_index=True)
    keys, side, flat = keys[once], side[once], [flat[i] for i in once]
    lengths = np.array([len(x) for x in flat])
    values, index, counts = np.unique(np.concatenate(flat), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)  # common n-grams first, so that paths are shared
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ids, cuts = rank[index], np.cumsum(lengths)
    sets = [np.sort(ids[e - n:e]) for e, n in zip(cuts.tolist(), lengths.tolist(), strict=True)]
    stored = np.flatnonzero(side == 0)
    walking = np.flatnonzero(side == 1) if (side == 1).any() else stored
    tree = PrefixTree([sets[i] for i in stored])
    mark = np.zeros(len(values), dtype=bool)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in walking.tolist():
        mark[sets[i]] = True
        for j in stored[tree.linked(sets[i], mark, similar)].tolist():
            x, y = find(i), find(j)
            if x != y:
                root[x] = y
                links.append((int(keys[i]), int(keys[j])))
        mark[sets[i]] = False
    return links


def _verify(size: int, similar: tuple[int, int]):
    """(a, b) of linked set keys, from rows (cell, side, packed text) in order of cells."""

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        cell, held, links = None, [], []
        for batch in batches:
            cells, sides = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = pa.array([unpack.decompress(t.as_buffer()) for t in batch.column(2)], pa.large_binary())
            for first, values, at in shingle_sets(texts.cast(pa.large_string()), size):
                keys = set_keys(values, at).view(np.int64).tolist()
                for i, key in enumerate(keys):
                    if cells[first + i] != cell:
                        if len(held) > 1:
                            links += _cell_links(*_columns(held), similar)
                        cell, held = cells[first + i], []
                    held.append((sides[first + i], key, values[at[i]:at[i + 1]]))
                if len(links) > 50_000:
                    yield _edges(links)
                    links = []
        if len(held) > 1:
            links += _cell_links(*_columns(held), similar)
        if links:
            yield _edges(links)

    return run


def _columns(held):
    side, keys, sets = zip(*held, strict=True)
    return np.array(side), np.array(keys), list(sets)


def _edges(links):
    a, b = zip(*links, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    similar: tuple[int, int] = SIMILAR, hot: int = HOT_SHINGLE,
                    block: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, text_hash, n, class) for each row of ``docs``: rows of one class are linked, directly or not.

    ``n`` is the number of shingles; without any the class is null. ``similar`` is the threshold as
    numerator and denominator. Other columns are ignored. See the module for the method.
    """
    spark = docs.sparkSession
    tune(spark, SMALL_BATCHES)
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    id_type = docs.schema["id"]
    long = T.LongType()
    schema = T.StructType([id_type, *(T.StructField(x, long) for x in ("text_hash", "key", "n")),
                           T.StructField("slice", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    arrow_id = to_arrow_type(id_type.dataType)

    profile = written(docs.select("id", "text", "text_hash").mapInArrow(_profile(size, arrow_id), schema), "profile")
    parts = profile.filter("slice is not null").select("slice", "counts")
    rows = profile.filter("slice is null").select("id", "text_hash", "key", "n")
    sketch = _sketch(parts)
    shared = spark.sparkContext.broadcast(sketch)
    total = rows.agg(F.sum("n")).first()[0] or 0
    top, bottom = similar
    groups = max(1, total * (bottom - top) // bottom // GROUP_SHINGLES)

    packed = docs.select("text").mapInArrow(
        _prefixes(size, similar, shared, int(np.median(sketch)), groups, hot),
        "grp long, shingles binary, keys binary, sizes binary, at binary, places binary, salts binary")
    tasks = max(groups // 4, spark.sparkContext.defaultParallelism)
    met = packed.repartition(int(tasks), "grp").sortWithinPartitions("grp").mapInArrow(
        _meet(similar), "leader long, class long, key long, shingle long").distinct()
    met = written(met, "met")
    split = met.filter("shingle is not null")
    least = split.groupBy("shingle", "class").agg(F.min("leader").alias("least"))
    pairs = met.filter("shingle is null").select("leader", "class", "key").union(
        split.join(least, ["shingle", "class"]).select(F.col("least").alias("leader"), "class", "key")).distinct()
    pairs = pairs.filter("leader <> key")

    sets = rows.filter("n > 0").groupBy("key").agg(
        F.min(F.struct("id", "text_hash")).alias("row"), F.min("n").alias("n")).select("key", "row.*", "n")
    members = written(pairs.union(pairs.select("leader", "class", F.col("leader").alias("key")).distinct())
                      .join(sets, "key"), "members")
    weight = members.groupBy("leader", "class").agg(F.ceil(F.sum("n") / F.lit(block)).cast("long").alias("blocks"))
    dealt = members.join(weight, ["leader", "class"]).select(
        "leader", "class", "id", "text_hash", F.pmod(F.xxhash64("key"), "blocks").alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = dealt.select(
        F.xxhash64("leader", "class", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), F.col("id").alias("own_id"),
        F.col("text_hash").alias("own_hash"))
    packed = docs.select("id", "text_hash", "text").mapInArrow(_pack(arrow_id), T.StructType(
        [id_type, T.StructField("text_hash", long), T.StructField("packed", T.BinaryType())]))
    # The same plan at every size: the texts are what grows, and both sides are dealt by document.
    shipped = cells.hint("merge").join(packed, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")))
    links = shipped.select("cell", "side", "packed").repartition("cell").sortWithinPartitions("cell").mapInArrow(
        _verify(size, similar), "a long, b long")

    found = components(links)
    sized = rows.join(found.withColumnRenamed("node", "key"), "key", "left")
    return written(sized.select("id", "text_hash", "n", F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("class")), "classes")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                       similar: tuple[int, int] = SIMILAR, hot: int = HOT_SHINGLE,
                       block: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``docs``: classes named by their least id."""
    named = jaccard_classes(docs, id_col, text_col, size, similar, hot, block)
    names = named.filter("class is not null").groupBy("class").agg(F.min("id").alias("first_id"))
    return split_join(named, names, ["class"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("first_id")).alias("component_id"))


def first_of_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class: that of least id, null ids last, then of least text hash.

    Rows that repeat this id and text come once. Rows without words are in no class and all stay.
    """
    classes = jaccard_classes(docs, id_col, text_col)
    first = classes.filter("class is not null").groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("row")).select(
        F.col("row.id").alias("first_id"), F.col("row.text_hash").alias("first_hash"))
    mark = fresh_name(docs, "text_hash")
    rows = docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))
    worded = F.coalesce(F.regexp_like(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(False))
    kept = rows.filter(worded).join(first, rows[id_col].eqNullSafe(first["first_id"]) & (rows[mark] == first["first_hash"]), "left_semi")
    return kept.dropDuplicates([id_col, mark]).unionByName(rows.filter(~worded)).select(*docs.columns)
