"""Benchmark decontamination with suffix arrays over the training shards.

Every task turns its slice of documents into a shard: the words become ids of
the benchmark's vocabulary, and a suffix array is built over the positions
that can begin a match (suffixes of at least the shortest window's length
whose words all occur in the benchmark; all others compare below any test
suffix, so leaving them out changes no search). Every test suffix is then
binary-searched in every shard: the range between the two bounds holds all
places where its first ``window`` words occur verbatim. Chains of matches of
neighbouring suffixes give the longest verbatim match and its location.

The benchmark travels to the tasks as arrays behind a check of its size
(``max_broadcast_bytes`` of text); a larger one is cut into parts under that
bound, each part is searched in a pass of its own, and the hits are united
per document. Documents are never shuffled in the one-part case.

Nulls and empty texts have no words, never match and come back clean. An
item of fewer words than the window, but not none, is one window. A null
doc_id or item_id, repeated rows and repeated items are allowed: each
document row is judged by itself, and equal item ids count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import BY_LETTER, Words, arrow_schema, batch_words, buffers

WINDOW = 13
MAX_BROADCAST_BYTES = 32 << 20

HITS = ("doc_id {t}, n_words long, spans array<struct<start:long,stop:long>>, items array<string>, "
        "longest long, longest_at long, longest_item string")


class Benchmark:
    """Test suffixes of one part of the benchmark."""

    def __init__(self, ids: list, texts: list, window: int):
        data, offs = buffers(pa.array(texts, pa.string()))
        words = Words(data, offs, BY_LETTER)
        self.window = window
        self.vocabulary, code = np.unique(words.hash, return_inverse=True)
        code = code.astype(np.int64) + 1
        item, first, length = [], [], []
        for r in range(len(ids)):
            lo, hi = words.bounds[r], words.bounds[r + 1]
            n = int(hi - lo)
            if n:
                size = min(n, window)
                starts = np.arange(lo, hi - size + 1)
                first.append(starts)
                item.append(np.full(len(starts), r))
                length.append(np.full(len(starts), size))
        none = np.empty(0, np.int64)
        self.item = np.concatenate(item or [none])
        first = np.concatenate(first or [none])
        self.length = np.concatenate(length or [none])
        names = ["" if i is None else str(i) for i in ids]
        self.names = sorted(set(names))
        #: row of the benchmark -> its id's name (equal ids count once)
        place = {x: k for k, x in enumerate(self.names)}
        self.name = np.array([place[x] for x in names], np.int64)
        self.shortest = int(self.length.min()) if len(self.length) else 0
        at = np.arange(window)
        keep = at[None, :] < self.length[:, None]
        codes = np.zeros((len(first), window), np.int64)
        codes[keep] = code[(first[:, None] + at)[keep]]
        self.low = _packed(codes)
        high = codes.copy()
        high[~keep] = 0xFFFFFFFF
        self.high = _packed(high)


def _packed(codes: np.ndarray) -> np.ndarray:
    """Rows of codes as fixed-width byte strings that sort like the rows."""
    wide = np.ascontiguousarray(codes.astype(">u4"))
    return wide.view(f"S{4 * codes.shape[1]}").ravel() if len(wide) else np.empty(0, f"S{4 * codes.shape[1]}")


def _search(words: Words, bench: Benchmark):
    """(position, test suffix) of every verbatim match in the shard."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(words.hash) or not len(bench.item):
        return none
    at = np.searchsorted(bench.vocabulary, words.hash)
    at[at == len(bench.vocabulary)] = 0
    code = np.where(bench.vocabulary[at] == words.hash, at + 1, 0)
    n, w = len(code), bench.window
    # last word of the known run each position lies in, within its document
    stop = (code == 0)
    ends = np.where(stop, np.arange(n), words.bounds[words.doc + 1])
    reach = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)
    starts = np.flatnonzero(reach >= bench.shortest)
    if not len(starts):
        return none
    at = np.arange(w)
    inside = at[None, :] < np.minimum(reach[starts], w)[:, None]
    grid = np.zeros((len(starts), w), np.int64)
    grid[inside] = code[(starts[:, None] + at)[inside]]
    keys = _packed(grid)
    order = np.argsort(keys, kind="stable")
    keys, starts = keys[order], starts[order]
    lo = np.searchsorted(keys, bench.low, side="left")
    hi = np.searchsorted(keys, bench.high, side="right")
    n_hits = hi - lo
    suffix = np.repeat(np.arange(len(lo)), n_hits)
    offset = np.arange(n_hits.sum()) - np.repeat(np.cumsum(n_hits) - n_hits, n_hits)
    return starts[np.repeat(lo, n_hits) + offset], suffix


def _scan(batches, bench: Benchmark, schema: pa.Schema):
    for batch in batches:
        ids = batch.column(0)
        for i, j, words in batch_words(batch.column(1), BY_LETTER):
            pos, suffix = _search(words, bench)
            rows = j - i
            spans = [[] for _ in range(rows)]
            items = [[] for _ in range(rows)]
            longest = [(0, None, None)] * rows
            if len(pos):
                size = bench.length[suffix]
                mark = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(mark, pos, 1)
                np.add.at(mark, pos + size, -1)
                hit = np.cumsum(mark[:-1]) > 0
                # spans end at document edges because no match crosses them
                edge = np.ones(len(hit), bool)
                edge[1:] = words.doc[1:] != words.doc[:-1]
                prev = np.r_[False, hit[:-1]]
                begin = np.flatnonzero(hit & (~prev | edge))
                nxt = np.r_[hit[1:], False] & ~np.r_[edge[1:], True]
                end = np.flatnonzero(hit & ~nxt) + 1
                base = words.bounds[words.doc[begin]]
                for r, a, b in zip(words.doc[begin], begin - base, end - base):
                    spans[r].append({"start": int(a), "stop": int(b)})
                for r, k in np.unique(np.stack([words.doc[pos], bench.name[bench.item[suffix]]], 1), axis=0):
                    items[r].append(bench.names[k])
                # neighbouring suffixes of an item at neighbouring positions chain up
                order = np.lexsort((pos, pos - suffix, bench.item[suffix], words.doc[pos]))
                p, s, z = pos[order], suffix[order], size[order]
                new = np.ones(len(p), bool)
                new[1:] = ((p[1:] != p[:-1] + 1) | (s[1:] != s[:-1] + 1)
                           | (bench.item[s[1:]] != bench.item[s[:-1]]) | (words.doc[p[1:]] != words.doc[p[:-1]]))
                head = np.flatnonzero(new)
                tail = np.r_[head[1:], len(p)] - 1
                for a, b in zip(head, tail):
                    r = words.doc[p[a]]
                    n = int(p[b] + z[b] - p[a])
                    if n > longest[r][0]:
                        longest[r] = (n, int(p[a] - words.bounds[r]), bench.names[bench.name[bench.item[s[a]]]])
            yield pa.RecordBatch.from_arrays([
                ids.slice(i, rows), pa.array(words.count, pa.int64()),
                pa.array(spans, schema.field("spans").type), pa.array(items, schema.field("items").type),
                pa.array([x[0] for x in longest], pa.int64()), pa.array([x[1] for x in longest], pa.int64()),
                pa.array([x[2] for x in longest], pa.string())], schema=schema)


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
            max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per document row: words, verbatim matches as maximal word spans, the
    items that occur, and the longest match with its place and item."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    parts = _parts(items, max_broadcast_bytes)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    if parts > 1:
        # hits of the parts are united by id and text, so repeated ids keep their own rows
        source = source.select(F.struct("doc_id", F.xxhash64("t").alias("k")).alias("doc_id"), "t")
        kind, id_type = f"struct<doc_id:{kind},k:bigint>", pa.struct([("doc_id", id_type), ("k", pa.int64())])
    schema = _hits_schema(id_type)
    passes = []
    for part in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        held = _held(mine, window)
        passes.append(source.mapInArrow(lambda it, held=held: _scan(it, held.value, schema), HITS.format(t=kind)))
    if parts == 1:
        return passes[0]
    found = _united(passes).withColumnRenamed("doc_id", "key")
    rows = source.select("doc_id.doc_id", F.col("doc_id").alias("key"))
    return rows.join(found, rows["key"].eqNullSafe(found["key"])).drop("key")


def _parts(items: DataFrame, max_broadcast_bytes: int) -> int:
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    return 1 if size <= max_broadcast_bytes else -(-int(size) * 2 // max_broadcast_bytes)


def _held(items: DataFrame, window: int):
    rows = items.collect()  # one part: its text is about max_broadcast_bytes at most
    return items.sparkSession.sparkContext.broadcast(
        Benchmark([r["i"] for r in rows], [r["t"] for r in rows], window))


def _hits_schema(id_type: pa.DataType) -> pa.Schema:
    return arrow_schema([
        ("doc_id", id_type), ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64()),
        ("longest_item", pa.string())])


def _united(passes: list[DataFrame]) -> DataFrame:
    """One row per document id from the passes over the parts: spans are
    merged where they overlap or touch, item lists are joined."""
    from functools import reduce
    rows = reduce(DataFrame.unionByName, passes)
    both = rows.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.max(F.struct("longest", "longest_at", "longest_item")).alias("best"))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate("spans", empty, lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= last(acc)["stop"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last(acc)["start"].alias("start"), F.greatest(last(acc)["stop"], s["stop"]).alias("stop")))))
        .otherwise(F.concat(acc, F.array(s))))
    return both.select("doc_id", "n_words", merged.alias("spans"), "items", "best.longest",
                       "best.longest_at", "best.longest_item")


def digest(found: DataFrame, hit_share: tuple[int, int] = (1, 20)) -> DataFrame:
    """Counts, the hash of the item list and the contamination rule: at
    least ``hit_share`` of the words lie in a matching window."""
    some, of = hit_share
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    out = found.withColumn("n_hit", n_hit)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (of * F.col("n_hit") >= some * F.col("n_words"))).alias("contaminated"),
        "longest", "longest_at", "longest_item")


def _clean(batches, bench: Benchmark, text_at: int, share: tuple[int, int], schema: pa.Schema):
    """The rows of whole batches that are not contaminated."""
    some, of = share
    for batch in batches:
        pair = pa.RecordBatch.from_arrays(
            [pa.array(range(batch.num_rows), pa.int64()), batch.column(text_at)], names=["doc_id", "t"])
        keep = []
        for found in _scan([pair], bench, schema):
            for n, spans in zip(found.column("n_words").to_pylist(), found.column("spans").to_pylist()):
                hit = sum(x["stop"] - x["start"] for x in spans)
                keep.append(not (hit > 0 and of * hit >= some * n))
        yield batch.filter(pa.array(keep, pa.bool_()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  hit_share: tuple[int, int] = (1, 20),
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns. A
    benchmark in one part needs no shuffle: each task drops its own rows. With
    several parts an id that stands for several texts goes if one of them is
    contaminated."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    parts = _parts(items, max_broadcast_bytes)
    if parts == 1:
        held, schema = _held(items, window), _hits_schema(pa.int64())
        text_at = docs.columns.index(text_col)
        return docs.mapInArrow(lambda it: _clean(it, held.value, text_at, hit_share, schema), docs.schema)
    found = matches(docs, benchmark, id_col=id_col, text_col=text_col, item_col=item_col,
                    item_text_col=item_text_col, window=window, max_broadcast_bytes=max_broadcast_bytes)
    bad = digest(found, hit_share).where("contaminated").select(F.col("doc_id").alias("__bad"))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")
