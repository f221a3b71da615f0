"""SentencePiece encoding and decoding through a distinct-chunk table.

A sentencepiece model writes a space as the marker U+2581. Where no piece of
the vocabulary has a marker after another character, no merge can cross into
the next run of markers, so the normalised text falls into chunks (a run of
markers and the characters up to the next one) that are segmented
independently. Every distinct chunk is segmented once and its ids are joined
back to every place where it occurs:

1. A scan task cuts its documents into blocks of about ``BLOCK_BYTES`` of text.
   A block's distinct chunks are listed once, by shard (hash of the chunk);
   its documents become sequences of codes into that list.
2. The lists meet by shard. A shard owns its chunks: it keeps one table of
   distinct chunks, segments each with the library when it first comes by, and
   answers every list with the ids of its chunks in the list's order.
3. Lists of answers and code sequences meet by block, where each document's
   ids are gathered by position.

A chunk, however frequent, is one entry of a block's list, so no task gets the
occurrences of a frequent word. A task holds one block (or one document, where
that is longer) or the distinct chunks of one shard; shards follow
``spark.sql.shuffle.partitions``. What is shuffled is compressed.

The documents are read twice, for the lists and for the code sequences; rows
must come in the same order each time, as they do from a stored table. A block
and its lists are sealed with a hash, and a difference raises RuntimeError.

The model file is read once by the driver and shipped with the tasks (its size
is checked against ``MAX_MODEL_BYTES``). A model whose pieces cross markers, or
whose normaliser does more than write markers, is refused with ValueError.

Null and empty texts have no ids and decode to the empty text. Every row is
kept, rows that repeat an id or a text included; ids of any type, null ones
included, are carried along. Texts are encoded whole, whatever their length.
Other columns of the input are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, buffers, slices, string_hashes

MARK = "▁"
BLOCK_BYTES = 8 << 20
DECODED_IDS = 1 << 18
MAX_MODEL_BYTES = 64 << 20


def read_model(path: str) -> bytes:
    """The model file's bytes, checked to be one that can be cut into chunks."""
    with open(path, "rb") as f:
        model = f.read()
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has {len(model)} bytes; the bound is {MAX_MODEL_BYTES}")
    sp = _processor(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError(f"{path}: a piece crosses a whitespace marker")
    plain = lambda t: MARK + t.replace(" ", MARK)
    probes = [" ", "  a  b ", "a\tb\r\nc", "ﬁ ½ é Ａ", *(p.replace(MARK, " ") for p in pieces)]
    if any(sp.normalize(t) != plain(t) for t in probes if t):
        raise ValueError(f"{path}: its normaliser does more than write whitespace markers")
    return model


def _processor(model: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=model)


# ---------------------------------------------------------------- chunks

def chunks_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """(chunks of all rows in order, number of chunks of each row). A chunk is
    given without its first marker: the library adds that one again."""
    space = data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    rows = offs[:-1][np.diff(offs) > 0]
    cut[rows] = False  # a row's first chunk has its marker from the library; a space there is content
    begins = cut.copy()
    begins[rows] = True
    marks = np.flatnonzero(begins)
    gone = cut[marks]
    at = marks - (np.cumsum(gone) - gone)  # bytes that were cut out before
    kept = data[~cut]
    offsets = np.append(at, len(kept)).astype(np.int32)
    chunks = pa.StringArray.from_buffers(len(marks), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept)))
    bounds = np.searchsorted(marks, offs)
    return chunks, np.diff(bounds)


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _unpack(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _small(a: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _text_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offs = buffers(strings)
    return data, _small(np.diff(offs))


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data)))


_BLOCK_ROWS = "block long, shard int, ids array<{0}>, blob binary"


def _block(ids: pa.Array, text: pa.Array, block: int, shards: int, kind: pa.DataType):
    """One row (shard -1) with the documents as codes, and one row a shard
    with the chunks that it owns. Codes run through the lists in shard order;
    documents hold ranks by frequency, which compress better, and the ranks'
    codes."""
    chunks, counts = chunks_of(*buffers(text))
    coded = chunks.dictionary_encode()
    index = coded.indices.to_numpy()
    names = coded.dictionary
    hashes = string_hashes(names)
    owner = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    by_rank = np.argsort(-np.bincount(index, minlength=len(names)), kind="stable")
    rank = np.empty(len(names), np.int32)
    rank[by_rank] = np.arange(len(names), dtype=np.int32)
    code = np.empty(len(names), np.int64)
    code[order] = np.arange(len(names))
    ranks = rank[index] if len(index) else index
    low = np.minimum(ranks, 0xFFFF).astype(np.uint16)
    high = ranks[ranks >= 0xFFFF]
    bounds = np.searchsorted(owner[order], np.arange(shards + 1))
    some = np.flatnonzero(np.diff(bounds))
    seal = np.add.reduceat(hashes[order] * np.arange(1, len(names) + 1, dtype=np.uint64), bounds[some]) if len(some) else hashes
    rows = [(-1, ids, _pack(_small(counts), low, _small(high), _small(code[by_rank]), seal))]
    listed = names.take(pa.array(order))
    none = pa.array([], kind)
    for s, x in zip(some, seal):
        rows.append((int(s), none, _pack(*_text_of(listed.slice(bounds[s], bounds[s + 1] - bounds[s])), x)))
    yield pa.RecordBatch.from_arrays(
        [pa.array([block] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
         pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(r[1]) for r in rows]).astype(np.int32)),
                                  pa.concat_arrays([r[1] for r in rows])),
         pa.array([r[2] for r in rows], pa.binary())], names=["block", "shard", "ids", "blob"])


def _listed(batches, shards: int, block_bytes: int):
    """Blocks of the task's documents. A block's number holds the partition,
    so a task that runs again names its blocks as before."""
    number = TaskContext.get().partitionId() << 33
    held, size = [], 0

    def ready():
        table = pa.Table.from_batches(held).combine_chunks()
        return table.column(0).combine_chunks(), table.column(1).combine_chunks()

    def cut(ids, text):
        nonlocal number
        _, offs = buffers(text)
        for i, j in slices(offs, block_bytes):
            yield from _block(ids.slice(i, j - i), text.slice(i, j - i), number, shards, ids.type)
            number += 1

    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        if pc.any(pc.match_substring(text, MARK)).as_py():
            text = pc.replace_substring(text, MARK, " ")  # the library reads both alike
        held.append(pa.RecordBatch.from_arrays([batch.column(0), text], names=["id", "t"]))
        size += text.nbytes
        if size >= block_bytes:
            yield from cut(*ready())
            held, size = [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield from cut(*ready())


# ---------------------------------------------------------------- segments

class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.size = np.empty(1 << 12, dtype), 0

    def add(self, values: np.ndarray):
        need = self.size + len(values)
        if need > len(self.room):
            room = np.empty(max(need, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:need] = values
        self.size = need


def _answered(batches, model: bytes):
    """For each list of chunks its ids: all ids in order and each chunk's
    number of them. The table of this shard's distinct chunks grows as lists
    come by; a chunk is segmented once."""
    sp = _processor(model)
    place: dict[str, int] = {}
    flat, begin, count = _Grown(np.int32), _Grown(np.int64), _Grown(np.int64)

    def learn(names: list[str], found: list[list[int]]):
        n = np.fromiter(map(len, found), np.int64, len(found))
        begin.add(flat.size + np.cumsum(n) - n)
        flat.add(np.fromiter(chain.from_iterable(found), np.int32, int(n.sum())))
        count.add(n)
        place.update(zip(names, range(len(place), len(place) + len(names))))

    learn([""], [sp.encode("x ")[len(sp.encode("x")):]])  # a marker that nothing follows
    for batch in batches:
        blobs = []
        for blob in batch.column("blob").to_pylist():
            data, lengths, seal = _unpack(blob)
            names = _strings(data, lengths).to_numpy(zero_copy_only=False).tolist()
            new = [n for n in names if n not in place]
            for k in range(0, len(new), 20_000):
                learn(new[k:k + 20_000], sp.encode(new[k:k + 20_000], num_threads=1))
            at = np.fromiter((place[n] for n in names), np.int64, len(names))
            blobs.append(_pack(_small(count.room[at]), _small(_gather(flat.room, begin.room[at], count.room[at])), seal))
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("shard"), pa.array(blobs, pa.binary())],
            names=["block", "shard", "blob"])


def _gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[begin:begin + count] of every row, one after the other."""
    total = int(count.sum())
    before = np.cumsum(count) - count
    return flat[np.repeat(begin - before, count) + np.arange(total)]


def _joined(docs: pa.Table, answers: pa.Table, model: bytes | None = None) -> pa.Table:
    """The ids of each document of one block, and with a model their text."""
    kind = docs.schema.field("ids").type.value_type
    out = pa.schema([("id", kind), ("ids", pa.list_(pa.int32())), *([("decoded", pa.string())] if model else [])])
    if docs.num_rows == 0:
        return out.empty_table()
    counts, low, high, code, seal = _unpack(docs.column("blob")[0].as_py())
    counts = counts.astype(np.int64)
    rank = low.astype(np.int64)
    rank[low == 0xFFFF] = high
    order = np.argsort(answers.column("shard").to_numpy())
    blobs = answers.column("blob")
    parts = [_unpack(blobs[int(k)].as_py()) for k in order]
    if [p[2] for p in parts] != list(seal):
        raise RuntimeError("the documents came in another order when they were read again; give a stored table")
    n = np.concatenate([p[0] for p in parts]).astype(np.int64) if parts else np.empty(0, np.int64)
    flat = np.concatenate([p[1] for p in parts]).astype(np.int32) if parts else np.empty(0, np.int32)
    begin = np.cumsum(n) - n
    at = code.astype(np.int64)[rank]
    ids = _gather(flat, begin[at], n[at])
    upto = np.concatenate([[0], np.cumsum(n[at])])  # ids before each chunk
    offs = upto[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
    columns = [docs.column("ids").combine_chunks().flatten(), pa.ListArray.from_arrays(pa.array(offs), pa.array(ids))]
    if model:
        columns.append(pa.array(_decoded(_processor(model), ids, offs), pa.string()))
    pa.default_memory_pool().release_unused()
    return pa.Table.from_arrays(columns, schema=out)


def _decoded(sp, flat: np.ndarray, offs: np.ndarray):
    return (sp.decode(flat[a:b].tolist()) for a, b in zip(offs[:-1], offs[1:]))


def _by_block(docs: DataFrame, model: bytes, id_col: str, text_col: str, block_bytes: int, rows_of, columns: str) -> DataFrame:
    """``rows_of(block's documents, answers)`` of every block."""
    spark = docs.sparkSession
    bounded_batches(spark, BLOCK_BYTES)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = source.schema["id"].dataType.simpleString()
    # both branches read this one exchange
    rows = source.mapInArrow(lambda it: _listed(it, shards, block_bytes), _BLOCK_ROWS.format(kind)).repartition(
        shards, "block")
    answers = (rows.where("shard >= 0").select("block", "shard", "blob").repartition(shards, "shard")
                   .mapInArrow(lambda it: _answered(it, model), "block long, shard int, blob binary"))
    return (rows.where("shard < 0").groupBy("block").cogroup(answers.groupBy("block"))
                .applyInArrow(rows_of, f"id {kind}, {columns}").withColumnRenamed("id", id_col))


def encode(docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """(id, ids) of every row: its piece ids, without begin or end; with
    ``with_text`` also ``decoded``, as ``decode`` adds it, from the same task."""
    return _by_block(docs, model, id_col, text_col, block_bytes, lambda d, a: _joined(d, a, model if with_text else None),
                     "ids array<int>" + ", decoded string" * with_text)


def _texts(batches, model: bytes):
    sp = _processor(model)
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        offs = ids.offsets.to_numpy()
        flat = ids.values.to_numpy()
        for i, j in slices(offs.astype(np.int64), DECODED_IDS):
            text = _decoded(sp, flat, offs[i:j + 1])
            yield batch.slice(i, j - i).append_column("decoded", pa.array(text, pa.string()))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """Adds the column ``decoded``: the text of ``ids`` (null: empty)."""
    bounded_batches(encoded.sparkSession, BLOCK_BYTES)
    filled = encoded.withColumn("ids", F.coalesce(F.col("ids"), F.array().cast("array<int>")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in filled.schema.fields)
    return filled.mapInArrow(lambda it: _texts(it, model), f"{schema}, decoded string")


def _digested(encoded: pa.Table) -> pa.Table:
    """``digest``'s columns of the rows that ``_joined`` gives with their text."""
    ids, text = (encoded.column(c).combine_chunks() for c in ("ids", "decoded"))
    flat, offs = ids.values.to_numpy(), ids.offsets.to_numpy()
    of_ids = (sha256(",".join(map(str, flat[a:b].tolist())).encode()).hexdigest() for a, b in zip(offs[:-1], offs[1:]))
    of_text = (sha256(t.as_buffer()).hexdigest() for t in text)
    return pa.table([encoded.column("id"), pa.array(np.diff(offs).astype(np.int64)), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digest(docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: number of ids, and SHA-256 of the ids and of the decoded text.
    The hashes are taken where the ids are, so the JVM never holds an id as a
    string of its own."""
    return _by_block(docs, model, id_col, text_col, block_bytes, lambda d, a: _digested(_joined(d, a, model)),
                     "n_tokens long, ids_sha256 string, decoded_sha256 string")
