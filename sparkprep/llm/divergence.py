"""Source divergence audit: how the sources of a language differ in the terms
they use, from an inverted index that is built in one pass.

1. *Single-pass in-memory indexing.* A scan task adds the postings (term,
   source, count, and the documents of the term) of its texts to an index in
   memory. When it holds ``BLOCK_POSTINGS`` postings it is sorted by language
   and term and spilled as a run, whose entries are dealt to shards by the hash
   of (language, term); then an empty one is begun.
2. *Heap merge.* The runs of a shard meet in one task, where a heap gives
   their entries in term order; neighbours of one term are added up. Terms
   found in ``MIN_DOCS`` documents or more are kept with their frequencies.
3. *Pair corrections.* Let p0 be a source's p of a term that it doesn't have.
   Over V kept terms a pair starts at V * f(p0, q0), as if neither had any;
   the kept terms then stream by, and each adds f(p, q) - f(p0, q0) for the
   pairs of which at least one source has it. Sums are kept by tiles of
   ``TILE`` x ``TILE`` sources and handed on when ``MAX_TILES`` are held.

Hot sources and terms are summed before they are shuffled: a run holds a term
once, with one count a source, so a shard gets at most one entry a run for any
term. Shards follow the number of entries (``SHARD_ENTRIES``). Work on pairs
is of the size of its result (all pairs of sources of a language). The groups
with their totals go to every task; more than ``MAX_GROUPS`` are refused with
ValueError (their pairs would be a result of up to 10^12 rows).

Counts are 64-bit; p and f are floors of exact quotients (p is divided out in
three steps of a factor 1000, exact while N + 2V stays under 9 * 10^15).

A null text, language or source counts as ''. Documents without terms count
for their group: it has p of every kept term as any other. Repeated rows are
documents of their own. A language without kept terms has V = 0 and pairs of
value 0. Texts are read whole. An empty table gives no rows. Ties in value are
broken by the item's UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, bounded_batches, buffers, saved, slices, string_hashes

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
BLOCK_POSTINGS = 1 << 20
SHARD_ENTRIES = 1 << 17
MAX_GROUPS = 1 << 20
TILE, MAX_TILES = 256, 16
BATCH_BYTES = 8 << 20

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[0x41:0x5B] = _TERM_BYTE[0x61:0x7B] = _TERM_BYTE[0x80:] = True


# ---------------------------------------------------------------- index

def terms_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """(all terms in order, the row of each)."""
    inside = _TERM_BYTE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offs[:-1][np.diff(offs) > 0]
    start[heads] = inside[heads]  # a term does not go on from the row before
    at = np.flatnonzero(start)
    row = np.searchsorted(offs, at, side="right") - 1
    kept = np.cumsum(inside)
    first = (kept[at] - 1).astype(np.int32)
    total = int(kept[-1]) if len(kept) else 0
    body = np.ascontiguousarray(ASCII_LOWER[data][inside])
    return pa.StringArray.from_buffers(
        len(at), pa.py_buffer(np.append(first, total).astype(np.int32)), pa.py_buffer(body)), row


def _postings(group: np.ndarray, text: pa.Array) -> pa.Table:
    """(group, term, n, docs) of a slice of rows: occurrences, and documents
    that hold the term."""
    terms, row = terms_of(*buffers(text))
    coded = terms.dictionary_encode()
    width = max(1, len(coded.dictionary))
    pair, count = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
    # documents of one group: add up before terms are copied
    cell, place = np.unique(group[pair // width] * width + pair % width, return_inverse=True)
    return pa.table({"group": pa.array((cell // width).astype(np.int32)), "term": coded.dictionary.take(pa.array(cell % width)),
                     "n": pa.array(np.bincount(place, count, len(cell)).astype(np.int64)),
                     "docs": pa.array(np.bincount(place, minlength=len(cell)))})


def _compact(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(["group", "term"]).aggregate(
        [("n", "sum"), ("docs", "sum")]).rename_columns(["group", "term", "n", "docs"])


_RUN = "shard int, lang string, term string, docs long, sources array<string>, counts array<long>"


def _run(index: pa.Table, groups: list[tuple[str, str]]):
    """The index as a run: one entry a term, in the order of language and term."""
    index = index.combine_chunks()
    langs, sources = sorted({g[0] for g in groups}), pa.array([g[1] for g in groups], pa.string())
    place = {x: k for k, x in enumerate(langs)}
    lang_of = np.array([place[g[0]] for g in groups], np.int32)
    index = index.append_column("lang", pa.array(lang_of[index.column("group").to_numpy()]))
    order = pc.sort_indices(index, [("lang", "ascending"), ("term", "ascending"), ("group", "ascending")])
    lang = index.column("lang").to_numpy()[order.to_numpy()]
    term = index.column("term").combine_chunks().take(order)
    n = len(term)
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = (lang[1:] != lang[:-1]) | pc.not_equal(term.slice(1), term.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new)
    offs = np.append(at, n).astype(np.int32)
    docs, count, group = (index.column(c).to_numpy()[order.to_numpy()] for c in ("docs", "n", "group"))
    docs = np.add.reduceat(docs, at) if n else docs
    names = term.take(pa.array(at))
    salt = string_hashes(pa.array(langs, pa.string())) if langs else np.empty(0, np.uint64)
    shard = ((string_hashes(names) ^ (salt[lang[at]] >> np.uint64(1))) >> np.uint64(33)).astype(np.int32)
    for k in range(0, len(at), 50_000):
        s = slice(k, min(k + 50_000, len(at)))
        part = slice(offs[s.start], offs[s.stop])
        cut = pa.array(offs[s.start:s.stop + 1] - offs[s.start])
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[s]), pa.array(langs, pa.string()).take(pa.array(lang[at[s]])), names.slice(k, s.stop - k),
             pa.array(docs[s]), pa.ListArray.from_arrays(cut, sources.take(pa.array(group[part]))),
             pa.ListArray.from_arrays(cut, pa.array(count[part]))],
            names=["shard", "lang", "term", "docs", "sources", "counts"])


def _runs(batches, block_postings: int):
    held, size, floor, known = [], 0, 0, {}
    for batch in batches:
        names = zip(*(pc.fill_null(batch.column(k), "").to_pylist() for k in range(2)))
        group = np.fromiter((known.setdefault(x, len(known)) for x in names), np.int64, batch.num_rows)
        text = pc.fill_null(batch.column(2), "")
        _, offs = buffers(text)
        for i, j in slices(offs):
            held.append(_postings(group[i:j], text.slice(i, j - i)))
            size += held[-1].num_rows
            if size >= block_postings + floor:
                held = [_compact(held)]
                size = floor = held[0].num_rows
                if size >= block_postings // 2:  # memory is full of different postings
                    yield from _run(held[0], list(known))
                    held, size, floor = [], 0, 0
                    pa.default_memory_pool().release_unused()
    if held:
        yield from _run(_compact(held), list(known))


# ---------------------------------------------------------------- merge

def _heap_merge(table: pa.Table, min_docs: int) -> pa.Table:
    """The entries of one shard, merged. An entry's run is not told: a run is
    where the sorted order breaks. The heap orders the entries; their numbers
    are then added up by arrays."""
    table = table.combine_chunks()
    lang, term = table.column("lang").combine_chunks(), table.column("term").combine_chunks()
    keys = list(zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in (lang, term))))
    cuts = [0, *(k for k in range(1, len(keys)) if keys[k] < keys[k - 1]), len(keys)]
    runs = (zip(keys[a:b], range(a, b)) for a, b in zip(cuts, cuts[1:]))
    order = np.fromiter((k for _, k in heapq.merge(*runs)), np.int64, len(keys))
    first = np.ones(len(keys), bool)
    first[1:] = [keys[a] != keys[b] for a, b in zip(order[1:], order[:-1])]
    entry = np.empty(len(keys), np.int64)  # merged entry of each row
    entry[order] = np.cumsum(first) - 1
    docs = np.zeros(int(first.sum()), np.int64)
    np.add.at(docs, entry, table.column("docs").to_numpy())
    kept = np.flatnonzero(docs >= min_docs)

    sources, counts = (table.column(c).combine_chunks() for c in ("sources", "counts"))
    coded = sources.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    ranked = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(names), np.int64)
    rank[ranked] = np.arange(len(names))
    of = np.repeat(entry, np.diff(sources.offsets.to_numpy()))
    on = docs[of] >= min_docs if len(of) else np.empty(0, bool)
    width = max(1, len(names))
    cell, place = np.unique(of[on] * width + rank[coded.indices.to_numpy()[on]], return_inverse=True)
    total = np.zeros(len(cell), np.int64)
    np.add.at(total, place, counts.flatten().to_numpy()[on])
    offs = pa.array(np.append(np.searchsorted(cell // width, kept), len(cell)).astype(np.int32))
    at = pa.array(order[first][kept])
    held = pa.array([names[k] for k in ranked], pa.string()).take(pa.array(cell % width))
    return pa.table({"lang": lang.take(at), "term": term.take(at), "sources": pa.ListArray.from_arrays(offs, held),
                     "counts": pa.ListArray.from_arrays(offs, pa.array(total))})


def frequencies(docs: DataFrame, *, min_docs: int = MIN_DOCS, block_postings: int = BLOCK_POSTINGS,
                shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(lang, term, sources, counts) of the kept terms: the sources that hold
    the term, ascending, and how often."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_BYTES)
    runs = saved(docs.select("lang", "source", "text").mapInArrow(lambda it: _runs(it, block_postings), _RUN))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // shard_entries))
    dealt = runs.withColumn("shard", F.col("shard") % F.lit(shards))
    return dealt.groupBy("shard").applyInArrow(
        lambda t: _heap_merge(t, min_docs), "lang string, term string, sources array<string>, counts array<long>")


# ---------------------------------------------------------------- values

def share(count: np.ndarray, n, v) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (n + 2 v)), exactly."""
    whole = n + 2 * v
    p, rest = np.divmod(count + 2, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        p = p * 1000 + more
    return 1 + p


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


def share_column(count: Column, n: Column, v: Column) -> Column:
    """``share`` as a column."""
    whole, rest = n + 2 * v, count + 2
    p = _div(rest, whole)
    for _ in range(3):
        rest = (rest % whole) * 1000
        p = p * 1000 + _div(rest, whole)
    return 1 + p


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def gap_column(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _corrections(batches, groups: dict):
    """Partial sums (lang, a, b, value) over the terms of one task, for pairs
    a < b by place in the language's sources. ``groups``: language to (sources,
    their N, V)."""
    tiles: dict = {}
    place = {lang: {s: k for k, s in enumerate(g[0])} for lang, g in groups.items()}

    def out():
        for (lang, i, j), m in tiles.items():
            a, b = np.nonzero(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(a + i * TILE, pa.int32()),
                 pa.array(b + j * TILE, pa.int32()), pa.array(m[a, b], pa.int64())], names=["lang", "a", "b", "value"])
        tiles.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        sources, counts = batch.column("sources").to_pylist(), batch.column("counts").to_pylist()
        for lang in dict.fromkeys(langs):
            names, n, v = groups[lang]
            none = share(np.zeros(len(n), np.int64), n, v)
            rows = [k for k, x in enumerate(langs) if x == lang]
            for lo in range(0, len(rows), 4096):
                part = rows[lo:lo + 4096]
                at = np.repeat(np.arange(len(part)), [len(sources[k]) for k in part])
                who = np.array([place[lang][s] for k in part for s in sources[k]], np.int64)
                p = share(np.array([c for k in part for c in counts[k]], np.int64), n[who], v)
                for i in range(math.ceil(len(n) / TILE)):
                    left = slice(i * TILE, (i + 1) * TILE)
                    in_left = (who >= left.start) & (who < left.stop)
                    for j in range(i, math.ceil(len(n) / TILE)):
                        right = slice(j * TILE, (j + 1) * TILE)
                        in_right = (who >= right.start) & (who < right.stop)
                        touched, row = np.unique(at[in_left | in_right], return_inverse=True)
                        if not len(touched):
                            continue
                        local = np.full(len(part), -1)
                        local[touched] = np.arange(len(touched))
                        full_l = np.tile(none[left], (len(touched), 1))
                        full_l[local[at[in_left]], who[in_left] - left.start] = p[in_left]
                        full_r = np.tile(none[right], (len(touched), 1))
                        full_r[local[at[in_right]], who[in_right] - right.start] = p[in_right]
                        m = tiles.setdefault((lang, i, j), np.zeros((full_l.shape[1], full_r.shape[1]), np.int64))
                        for a in range(full_l.shape[1]):
                            r = slice(a + 1 if i == j else 0, None)
                            f = gap(full_l[:, a:a + 1], full_r[:, r]) - gap(none[left][a], none[right][r])
                            m[a, r] += f.sum(0)
                        if len(tiles) >= MAX_TILES:
                            yield from out()
    yield from out()


def audit(docs: DataFrame, *, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP, block_postings: int = BLOCK_POSTINGS,
          shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other
    sources of the language by the summed f, part ``term`` the ``top`` kept
    terms that the source uses more than its language does."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name)
                          for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    index = saved(frequencies(plain, min_docs=min_docs, block_postings=block_postings, shard_entries=shard_entries))
    flat = index.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("all_n"),
                        F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", "term", "all_n", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    sums = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = index.groupBy("lang").agg(F.count("*").alias("v"))
    groups = saved(plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(kept, "lang", "left")
                        .select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                                F.coalesce("v", F.lit(0)).cast("long").alias("v")))
    if groups.count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups of language and source")
    return _pairs(index, groups).unionByName(_terms(flat, groups, top))


def _ranking():
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))


def _pairs(index: DataFrame, groups: DataFrame) -> DataFrame:
    known: dict = {}
    for r in groups.orderBy("lang", "source").toLocalIterator():
        names, n, v = known.setdefault(r["lang"], ([], [], r["v"]))
        names.append(r["source"])
        n.append(r["total"])
    known = {lang: (names, np.array(n, np.int64), v) for lang, (names, n, v) in known.items()}
    fixed = index.mapInArrow(lambda it: _corrections(it, known), "lang string, a int, b int, value long").groupBy(
        "lang", "a", "b").agg(F.sum("value").alias("fix"))
    own = groups.select("lang", "source", "v", share_column(F.lit(0).cast("long"), F.col("total"), F.greatest(
        "v", F.lit(1).cast("long"))).alias("p0"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("k"))
    other = own.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("k").alias("l"))
    base = own.join(other, "lang").where("k <> l").withColumn("a", F.least("k", "l")).withColumn("b", F.greatest("k", "l"))
    value = F.col("v") * gap_column(F.col("p0"), F.col("q0")) + F.coalesce("fix", F.lit(0).cast("long"))
    return base.join(fixed, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn(
        "rank", F.row_number().over(_ranking()))


def _terms(flat: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    whole = groups.withColumn("all_total", F.sum("total").over(Window.partitionBy("lang")))
    value = (flat.join(F.broadcast(whole), ["lang", "source"])
                 .withColumn("p", share_column(F.col("n"), F.col("total"), F.col("v")))
                 .withColumn("q", share_column(F.col("all_n"), F.col("all_total"), F.col("v"))).where("p > q")
                 .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                         gap_column(F.col("p"), F.col("q")).alias("value")))
    return value.withColumn("rank", F.row_number().over(_ranking())).where(F.col("rank") <= top)
