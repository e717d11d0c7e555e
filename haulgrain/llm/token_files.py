"""Operator 3: token ids as seekable files of zstandard frames.

Documents are range-partitioned and sorted by id; each task tokenizes its texts and writes one or
more shards. A shard is independent zstandard frames of at least ``frame_tokens`` ids (whole
documents; a longer document is a frame of its own), then a trailing seek table:

    frame ... frame | skippable frame: 0x184D2A5E, length, entries, footer
    entry   compressed size, decompressed size, checksum   (3 x u32, little-endian)
    footer  number of frames (u32), flags (u8, 0x80: checksums), 0x8F92EAB1 (u32)

The checksum is the low half of xxh64 of the frame's content: ids as little-endian u32. A reader
takes the table from the end of the file and decompresses only the frames of the documents it wants.

A task's shards count once its manifest rows are committed; names hold a random part, so a task
that runs again after an executor is lost writes other files, and files of failed tasks are never
read. Folders may be on any store that pyarrow opens by its URI.

Null and empty texts are the end id alone. Null ids come first; rows that repeat an id are put in
order of their text. An empty table makes no shard and an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from haulgrain.llm.tables import shared_path, written

# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
END_ID = 1

_SPLIT = re.compile(r"[^\x20\x09-\x0D]+").findall
#: White space to str.split() but not to _SPLIT.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


class SeekTableError(ValueError):
    """A shard's seek table or a frame's checksum is wrong."""


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def frame_checksum(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The trailing skippable frame for (compressed size, decompressed size, checksum) of each frame."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class ShardReader:
    """Reads single frames of one shard."""

    def __init__(self, file, size: int):
        import zstandard

        self._unpack, self._file = zstandard.ZstdDecompressor(), file
        if size < 17:
            raise SeekTableError("the file is too short for a seek table")
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS or 17 + 12 * n > size:
            raise SeekTableError("no seek table with checksums at the end of the file")
        file.seek(size - 9 - 12 * n - 8)
        head = struct.unpack("<II", file.read(8))
        if head != (SKIPPABLE, 12 * n + 9):
            raise SeekTableError("the seek table's header doesn't fit its footer")
        self.entries = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.entries[:, 0], dtype=np.int64)))

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame ``k``."""
        self._file.seek(int(self.starts[k]))
        packed, size, checksum = self.entries[k].tolist()
        content = self._unpack.decompress(self._file.read(packed), max_output_size=size)
        if len(content) != size or frame_checksum(content) != checksum:
            raise SeekTableError(f"frame {k} doesn't match its checksum")
        return np.frombuffer(content, "<u4")


#: Documents of a shard at most; a writer holds a line of the manifest for each.
SHARD_ROWS = 250_000

#: Between a letter or digit and punctuation the tokenizer always cuts, but for apostrophes. Letters
#: that its normalizer turns into several characters are left out.
_BEFORE_MARKS = re.compile("([!-&(-/:-@\\[-`{-~])(?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f].)", re.DOTALL).sub


def _spread(text: str) -> str:
    """A text with the same ids whose words repeat more often: marks apart, ASCII in lower case."""
    if "<|" in text:  # may spell a special token, which is taken as it is
        return text
    text = _BEFORE_MARKS(r" \1", text)
    return text.lower() if text.isascii() else text


# Case, marks, white space and apostrophes: what a tokenizer must treat as ``_spread`` does.
_PROBE = "Ab ab AB-ab ab,\n (Ab)\tdon't DON'T x1 1x Éa éa <|x Ab.ab  é, a_b ab_ \x0b a.\r\nb ＃ ı İx ß"


class WordEncoder:
    """Ids of whole texts, word by word.

    A tokenizer that drops white space, never looks across it and ignores ASCII case gives a text the
    ids of its words between ASCII white space in order. Words seen are kept, up to a bound in bytes. A
    tokenizer that a probe shows to be another is given whole texts.
    """

    def __init__(self, path: str, most: int = 256 << 20, longest: int = 1000):
        from tokenizers import Tokenizer

        #: ``most`` bytes of words and ids are kept; words of more than ``longest`` characters are not.
        self._tokenizer, self._ids, self._held, self._most, self._longest = Tokenizer.from_file(path), {}, 0, most, longest
        whole = [self._tokenizer.encode(t, add_special_tokens=False).ids for t in (_PROBE, _PROBE[::-1])]
        self._by_word = [x.tolist() for x in self._words([_PROBE, _PROBE[::-1]])] == whole

    @classmethod
    def of_worker(cls, path: str) -> WordEncoder:
        """One encoder for the life of a Python worker, which Spark reuses for many tasks."""
        kept = sys.modules.setdefault("haulgrain_worker_state", types.ModuleType("haulgrain_worker_state")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if self._by_word:
            return self._words(texts)
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _words(self, texts: list[str]) -> list[np.ndarray]:
        texts = map(_spread, texts)
        split = [_SPLIT(text) if _OTHER_SPACE(text) else text.split() for text in texts]
        known = self._ids
        new = list(set().union(*split).difference(known))
        once: dict[str, bytes] = {}
        if new:
            if self._held > self._most:
                known.clear()
                self._held = 0
                new = list(set().union(*split))
            for a in range(0, len(new), 20_000):
                part = new[a:a + 20_000]
                encoded = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
                for w, e in zip(part, encoded, strict=True):
                    ids = struct.pack(f"<{len(i := e.ids)}I", *i)
                    if len(w) > self._longest:
                        once[w] = ids
                    else:
                        known[w] = ids
                        self._held += 200 + 4 * len(w) + len(ids)  # with what Python adds to two objects and an entry
        find = (lambda w: known.get(w) or once[w]) if once else known.__getitem__
        return [np.frombuffer(b"".join(map(find, words)), "<u4") for words in split]


def _writer(folder: str, tokenizer: str, end_id: int, frame_tokens: int, shard_bytes: int, id_type: pa.DataType):
    def run(batches):
        import os

        import zstandard
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, pack = WordEncoder.of_worker(tokenizer), zstandard.ZstdCompressor(level=3)
        partition = TaskContext.get().partitionId()
        store, base = _store(folder)
        shard, shards = None, 0
        frames, pending, held, size = [], [], 0, 0
        rows: list[tuple] = []  # of the open shard: id, order, frame, offset in the frame, tokens

        def close_frame():
            nonlocal pending, held, size
            if pending:
                content = np.concatenate(pending).tobytes()
                packed = pack.compress(content)
                shard[1].write(packed)
                frames.append((len(packed), len(content), frame_checksum(content)))
                pending, held, size = [], 0, size + len(packed)

        def close_shard():
            nonlocal shard, frames, rows, size
            close_frame()
            shard[1].write(seek_table(frames))
            shard[1].close()
            ids, frame, offset, n = zip(*rows, strict=True)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([shard[0]] * len(ids)), pa.array([partition] * len(ids), pa.int32()),
                 pa.array([shards] * len(ids), pa.int32()), pa.array(range(len(ids)), pa.int64()),
                 pa.array(ids, id_type), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()), pa.array(n, pa.int64())],
                names=["shard", "partition", "part", "place", "id", "frame", "offset", "n_tokens"])
            shard, frames, rows, size = None, [], [], 0
            return batch

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a in range(0, len(batch), 256):
                own = [t or "" for t in texts.slice(a, 256).to_pylist()]
                for key, tokens in zip(ids[a:a + 256], encode(own), strict=True):
                    if shard is None:
                        name = f"{partition:06d}-{shards:03d}-{uuid.uuid4().hex}.zst"
                        store.create_dir(base, recursive=True)
                        shard = (name, store.open_output_stream(f"{base}/{name}", compression=None))
                    rows.append((key, len(frames), held, len(tokens) + 1))
                    pending.append(np.append(tokens, np.array([end_id], "<u4")).astype("<u4"))
                    held += len(tokens) + 1
                    if held >= frame_tokens:
                        close_frame()
                    if size >= shard_bytes or len(rows) >= SHARD_ROWS:
                        yield close_shard()
                        shards += 1
        if shard is not None:
            yield close_shard()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, frame_tokens: int = 65_536, shard_bytes: int = 256 << 20) -> DataFrame:
    """Write the shards below ``folder``; the committed manifest, one row a document.

    (shard, partition, part, place, id, frame, offset, n_tokens): the file, its place among all files, the
    document's place in it, and where in which frame its ids begin.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_field = rows.schema["id"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(tasks, "id", "h").sortWithinPartitions("id", "h", "text")
    schema = T.StructType([T.StructField("shard", T.StringType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), id_field,
                           T.StructField("frame", T.IntegerType()), T.StructField("offset", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    manifest = ranged.select("id", "text").mapInArrow(
        _writer(folder, tokenizer, end_id, frame_tokens, shard_bytes, to_arrow_type(id_field.dataType)), schema)
    return written(manifest, "manifest")


def _reader(folder: str, id_type: pa.DataType):
    def run(batches):
        store, base = _store(folder)
        name, reader, frame, ids = None, None, -1, None
        for batch in batches:
            crc = []
            for shard, k, offset, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "frame", "offset", "n_tokens")), strict=True):
                if shard != name:
                    path = f"{base}/{shard}"
                    name, reader, frame = shard, ShardReader(store.open_input_file(path), store.get_file_info(path).size), -1
                if k != frame:
                    frame, ids = k, reader.frame(k)
                crc.append(zlib.crc32(ids[offset:offset + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("place"), batch.column("id").cast(id_type),
                 batch.column("n_tokens"), pa.array(crc, pa.int64())], names=["shard", "place", "id", "n_tokens", "crc"])

    return run


def read_token_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """(shard, place, id, n_tokens, crc) of each document, from the ids in the files."""
    schema = T.StructType([manifest.schema[c] for c in ("shard", "place", "id", "n_tokens")] + [T.StructField("crc", T.LongType())])
    ordered = manifest.select("shard", "place", "id", "frame", "offset", "n_tokens").repartition("shard").sortWithinPartitions("shard", "place")
    return ordered.mapInArrow(_reader(folder, to_arrow_type(manifest.schema["id"].dataType)), schema)


def token_digests(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", **writing) -> DataFrame:
    """Write token files and read them back: (id, start, n_tokens, ids_crc32) for each row of ``docs``.

    ``start`` is the number of ids of all documents before it. ``folder`` is a new one in the shared
    folder unless given.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    manifest = write_token_files(docs, folder, tokenizer, id_col, text_col, **writing)
    read = read_token_digests(manifest, folder)
    # Ids before each shard, from one row a shard.
    shards = manifest.groupBy("shard").agg(F.min("partition").alias("p"), F.min("part").alias("k"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy("p", "k").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = read.withColumn("own", F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).join(shards, "shard")
    return placed.select(F.col("id").alias(id_col), (F.col("base") + F.col("own")).alias("start"), "n_tokens",
                         F.col("crc").alias("ids_crc32"))
