"""Near-duplicate documents by b-bit MinHash.

1. Each document's set of ``SIZE``-word shingles (64-bit hashes) is reduced
   inside its scan task to 128 minima. The band keys are hashes of 4 full
   minima each; of every minimum only the low ``BITS`` bits are retained,
   packed into 8 longs.
2. Documents with the same set (a 128-bit hash of it) are one class, stood
   for by its smallest id; only representatives go on.
3. Candidates of the first round link each member of a band to the band's
   smallest representative: one pair per member, not all pairs. The packed
   signatures give a similarity estimate by counting equal b-bit values and
   correcting for chance collisions; pairs whose estimate lies more than
   ``MARGIN`` standard deviations under the threshold go.
4. Each remaining pair is confirmed on the full shingle sets, and the links'
   components are found.
5. In bands that still hold several components, the members outside the
   largest one are tested against ``SAMPLES`` of its members, again a number
   of pairs in proportion to the members.
6. In bands that then still hold several components, every pair of members
   from different components is a candidate. Members of the largest component
   meet the others in blocks; only pairs that pass the estimate leave a block.
   After confirmation no link between candidates of different components is
   missing, so the components are those of all candidate links.

With 32 bands of 4 a pair at similarity 0.75 is no candidate with a chance of
about 5e-6, one at 0.85 of less than 1e-10.

Null or empty texts and texts without words have no set and are linked with
nothing. Ids may repeat, with equal or with different texts, and may be null:
links and classes belong to texts, and rows that repeat an id and a text get
equal results. A null doc_id never names a component (a component of null ids
only has a null component_id). Very long texts are hashed whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BY_SPACE, batch_words, bounded_batches, constants, is_empty, mix, saved
from .components import components

SIZE = 5
SIMILARITY = (75, 100)  # links: 100 * intersection >= 75 * union
BANDS, ROWS, BITS = 32, 4, 4
PERMUTATIONS = BANDS * ROWS
MARGIN = 4.5
SAMPLES = 4
BLOCK = 1024
BROADCAST_IDS = 1_000_000

_XOR = mix(constants(PERMUTATIONS, 101))
_MUL = constants(PERMUTATIONS, 211)
_ROW = constants(ROWS, 307)
_SET = constants(2, 401)


def shingle_sets(words, size: int = SIZE):
    """Distinct shingle hashes, row by row, and their bounds."""
    h, row = words.shingles(size)
    bounds = np.searchsorted(row, np.arange(words.rows + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(words.rows + 1))


def _set_hash(h: np.ndarray, at: np.ndarray):
    return [np.add.reduceat(mix(h ^ s), at) for s in _SET]


def _signatures(batches, size: int):
    for batch in batches:
        for i, j, words in batch_words(batch.column(1), BY_SPACE):
            h, bounds = shingle_sets(words, size)
            n = np.diff(bounds)
            some = n > 0
            at = bounds[:-1][some]
            ids, text_hash = batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i)
            if not len(at):
                none = pa.nulls(j - i, pa.int64())
                lists = pa.nulls(j - i, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, text_hash, pa.array(n, pa.int64()), none, none, lists, lists],
                                                 names=["doc_id", "th", "n", "s1", "s2", "bands", "sig"])
                continue
            low = np.empty((len(at), PERMUTATIONS), np.uint64)
            for k in range(PERMUTATIONS):
                low[:, k] = np.minimum.reduceat((h ^ _XOR[k]) * _MUL[k], at)
            low = mix(low)  # spreads the minima, whose high bits are all near zero
            band = (low.reshape(-1, BANDS, ROWS) * _ROW).sum(2)
            band = mix(band + np.arange(BANDS, dtype=np.uint64) * _MUL[0])
            bits = (low & np.uint64((1 << BITS) - 1)).reshape(-1, PERMUTATIONS * BITS // 64, 64 // BITS)
            packed = (bits << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
            s1, s2 = _set_hash(h, at)

            def spread(values):
                full = np.zeros(j - i, np.int64)
                full[some] = values.view(np.int64)
                return pa.array(full, mask=~some)

            def lists_of(m):
                m = np.ascontiguousarray(m).view(np.int64)
                offs = np.r_[0, np.cumsum(np.where(some, m.shape[1], 0))].astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(offs), pa.array(m.ravel()))
                return flat

            yield pa.RecordBatch.from_arrays(
                [ids, text_hash, pa.array(n, pa.int64()), spread(s1), spread(s2), lists_of(band), lists_of(packed)],
                names=["doc_id", "th", "n", "s1", "s2", "bands", "sig"])


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Per row: hash of the text, set size, 128-bit set hash, band keys and
    packed signature."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("th"))
    return source.mapInArrow(lambda it: _signatures(it, size),
                             "doc_id long, th long, n long, s1 long, s2 long, bands array<long>, sig array<long>")


def least_matches(similarity: tuple[int, int]) -> int:
    """Equal b-bit values that a pair at the threshold has, less the margin."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * similarity[0] / similarity[1]
    return max(0, math.floor(PERMUTATIONS * p - MARGIN * math.sqrt(PERMUTATIONS * p * (1 - p))))


def _matches(a: str, b: str):
    """Equal b-bit values of two packed signatures, by bit counts."""
    x = F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q))
    per_lane = 0x1111111111111111
    unequal = F.aggregate(x, F.lit(0), lambda acc, w: acc + F.bit_count(
        w.bitwiseOR(F.shiftrightunsigned(w, 1)).bitwiseOR(F.shiftrightunsigned(w, 2))
         .bitwiseOR(F.shiftrightunsigned(w, 3)).bitwiseAND(F.lit(per_lane))).cast("int"))
    return PERMUTATIONS - unequal


def estimate(matches: int) -> float:
    """Collision-corrected similarity."""
    chance = 2.0 ** -BITS
    return (matches / PERMUTATIONS - chance) / (1 - chance)


def _confirm(batches, size: int, similarity: tuple[int, int]):
    """Pairs (a, b) whose full shingle sets reach the threshold. A batch has
    a, b, the set hashes both must have, and both texts; equal neighbours in
    a are hashed once."""
    some, of = similarity

    def sets(ids, texts):
        key = ids.to_numpy(zero_copy_only=False)
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        group = np.cumsum(first) - 1
        out = []
        for _, _, words in batch_words(texts.filter(pa.array(first)), BY_SPACE):
            h, bounds = shingle_sets(words, size)
            for p, q in zip(bounds[:-1], bounds[1:]):
                part = h[p:q]
                out.append((part, int(mix(part ^ _SET[0]).sum(dtype=np.uint64).astype(np.int64)) if len(part) else 0))
        return group, out

    for batch in batches:
        a, b, ha, hb, ta, tb = (batch.column(k) for k in range(6))
        ga, sa = sets(a, ta)
        gb, sb = sets(b, tb)
        ha, hb = ha.to_numpy(), hb.to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            (x, hx), (y, hy) = sa[ga[k]], sb[gb[k]]
            if hx != ha[k] or hy != hb[k]:
                continue
            if of * min(len(x), len(y)) < some * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[k] = of * both >= some * (len(x) + len(y) - both) and both > 0
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))


def _linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of representatives that are links."""
    t = reps.select("rep", "s1").join(texts, "rep")
    right = t.select(F.col("rep").alias("b"), F.col("s1").alias("hb"), F.col("t").alias("tb"))
    left = t.select(F.col("rep").alias("a"), F.col("s1").alias("ha"), F.col("t").alias("ta"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "hb", "ta", "tb")
    return full.mapInArrow(lambda it: _confirm(it, size, similarity), "a long, b long")


def _mixed(members: DataFrame, label: DataFrame) -> DataFrame | None:
    """(band, rep, component) of the bands that hold several components."""
    named = saved(members.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left")
                         .select("band", "rep", F.coalesce("component", "rep").alias("component")))
    mixed = saved(named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                       .where("lo <> hi").select("band"))
    return None if is_empty(mixed) else named.join(mixed, "band")


def _largest(rest: DataFrame) -> DataFrame:
    """(band, main component, its members, all members)."""
    size = rest.groupBy("band", "component").agg(F.count("*").alias("n"))
    return saved(size.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                          F.max("n").alias("n_main"), F.sum("n").alias("n_all")))


def _close(pairs: DataFrame, sig: DataFrame, need: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in ``need`` values or more."""
    return (pairs.join(sig.withColumnsRenamed({"rep": "b", "sig": "sb"}), "b")
                 .join(sig.withColumnsRenamed({"rep": "a", "sig": "sa"}), "a")
                 .where(_matches("sa", "sb") >= need).select("a", "b"))


def _samples(rest: DataFrame, need: int) -> DataFrame:
    """Candidate pairs of the members outside a band's largest component
    with ``SAMPLES`` members of it: few tests join most of them to it."""
    inside = rest.join(_largest(rest), "band")
    hubs = saved(inside.where("component = main").groupBy("band").agg(F.array_distinct(F.array(*[
        F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(SAMPLES)])).alias("hubs")))
    pairs = inside.where("component <> main").join(hubs, "band").select(F.explode("hubs").alias("h"), "rep").select(
        F.least("h", "rep").alias("a"), F.greatest("h", "rep").alias("b")).distinct()
    return _close(saved(pairs), saved(rest.select("rep", "sig").dropDuplicates(["rep"])), need)


def _codes(batches, size: int):
    """(rep, set size, sorted 32-bit codes of its shingles) of each text."""
    for batch in batches:
        for i, j, words in batch_words(batch.column(1), BY_SPACE):
            h, bounds = shingle_sets(words, size)
            c = (h >> np.uint64(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(np.diff(bounds), pa.int64()),
                 pa.array([np.unique(c[p:q]).tobytes() for p, q in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["rep", "n", "codes"])


def _shared(codes: list[np.ndarray]):
    """A function (row, rows) -> sizes of the intersections of code sets: by
    bit rows over the codes that two members share, or, where those would
    take more than 64 MB, set by set."""
    flat = np.concatenate(codes)
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    names, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = np.flatnonzero(count > 1)
    if len(codes) * len(common) > 1 << 26:
        return lambda k, at: np.array([len(np.intersect1d(codes[k], codes[j], assume_unique=True)) for j in at], np.int64)
    column = np.full(len(names), -1)
    column[common] = np.arange(len(common))
    inside = np.zeros((len(codes), -(-max(1, len(common)) // 64) * 64), bool)
    c = column[place]
    inside[row[c >= 0], c[c >= 0]] = True
    bits = np.packbits(inside, axis=1).view(np.uint64)
    return lambda k, at: np.bitwise_count(bits[k] & bits[at]).sum(1, dtype=np.int64)


def _compare(table: pa.Table, need: int, similarity: tuple[int, int]) -> pa.Table:
    """Pairs of one group from different components that pass the signature
    estimate and can reach the threshold: shingles of one set that share a
    code may each be shared, so the codes lost to that are added back."""
    some, of = similarity
    table = table.combine_chunks()
    rep, comp = table.column("rep").to_numpy(), table.column("component").to_numpy()
    sig = np.array(table.column("sig").to_pylist(), np.int64).view(np.uint64)
    codes = [np.frombuffer(c, np.uint32) for c in table.column("codes").to_pylist()]
    n = table.column("n").to_numpy()
    lost = n - np.array([len(c) for c in codes], np.int64)
    lane, shared, out_a, out_b = np.uint64(0x1111111111111111), None, [], []
    for k in range(len(rep) - 1):
        x = sig[k + 1:] ^ sig[k]
        x = x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))
        same = PERMUTATIONS - np.bitwise_count(x & lane).sum(1)
        hit = np.flatnonzero((same >= need) & (comp[k + 1:] != comp[k])) + k + 1
        if len(hit):
            shared = shared or _shared(codes)
            both = shared(k, hit) + np.minimum(lost[k], lost[hit])
            hit = hit[of * both >= some * (n[k] + n[hit] - both)]
            out_a.append(np.minimum(rep[hit], rep[k]))
            out_b.append(np.maximum(rep[hit], rep[k]))
    none = np.empty(0, np.int64)
    return pa.table({"a": np.concatenate(out_a or [none]), "b": np.concatenate(out_b or [none])},
                    schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _across(rest: DataFrame, need: int, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs from different components of the same band that reach the
    threshold on 32-bit shingle codes, with an allowance for equal ones (and
    are confirmed on the full sets, as all links are).
    ``rest``: band, rep, component, sig of bands with several components."""
    n_main = F.ceil(F.col("n_main") / BLOCK).cast("int")
    n_rest = F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK).cast("int")
    rows = (rest.join(_largest(rest), "band").withColumn("in_main", F.col("component") == F.col("main"))
                .withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("in_main"), n_main).otherwise(n_rest)).cast("int"))
                .withColumn("n_main", n_main).withColumn("n_rest", n_rest))
    # a task compares one block of the others with one block of the main
    # component or of the others
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    where = F.when(F.col("in_main"), F.transform(upto(F.col("n_rest")), lambda o: F.struct(
        F.lit(0).alias("kind"), o.alias("p"), F.col("block").alias("q")))).otherwise(F.concat(
            F.transform(upto(F.col("n_main")), lambda m: F.struct(
                F.lit(0).alias("kind"), F.col("block").alias("p"), m.alias("q"))),
            F.transform(upto(F.col("n_rest")), lambda o: F.struct(
                F.lit(1).alias("kind"), F.least(o, F.col("block")).alias("p"), F.greatest(o, F.col("block")).alias("q")))))
    wanted = texts.join(rest.select("rep").distinct(), "rep", "left_semi").select("rep", "t")
    codes = saved(wanted.mapInArrow(lambda it: _codes(it, size), "rep long, n long, codes binary"))
    # one key for the pair of blocks, dealt out anew: a hot band spreads
    parts = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.select("band", F.explode(where).alias("g"), "rep", "component", "sig")
                 .select(F.struct("band", "g").alias("pair"), "rep", "component", "sig")
                 .join(codes, "rep").repartition(parts, "pair"))
    return dealt.groupBy("pair").applyInArrow(
        lambda t: _compare(t, need, similarity), "a long, b long").distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Per row: doc_id, th (hash of the text), n (set size), component (null
    without a set) and component_id. A class is known inside by the stored
    number of its first row, so ids may be null or repeat, with equal or
    different texts."""
    bounded_batches(docs.sparkSession)
    signed = saved(signatures(docs, id_col=id_col, text_col=text_col, size=size).withColumn("row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "th"))
    classes = saved(signed.where("n > 0").groupBy("s1", "s2").agg(first.alias("f")).select(
        "s1", "s2", F.col("f.row").alias("rep"), F.col("f.doc_id").alias("rep_id"), F.col("f.th").alias("rep_th")))
    reps = saved(signed.join(classes, ["s1", "s2"]).where("row = rep").select("rep", "rep_id", "rep_th", "s1", "bands", "sig"))
    need = least_matches(similarity)

    bands = reps.select("rep", F.explode("bands").alias("band"))
    hubs = saved(bands.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"))
                      .where("hub <> top").select("band", "hub"))
    members = saved(bands.join(hubs, "band").select("band", "rep", "hub"))
    star = saved(members.where("hub <> rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    sig = reps.select("rep", "sig")
    close = saved(_close(star, sig, need))
    ids = saved(members.select("rep").distinct().join(reps.select("rep", "rep_id", "rep_th"), "rep"))
    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("th"))
    # 24 bytes a row: sent to the scan while they are few, else both sides are shuffled
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = saved(source.join(wanted, F.col("i").eqNullSafe(F.col("rep_id")) & (F.col("th") == F.col("rep_th"))).select("rep", "t"))
    if texts.count() > ids.count():  # rows that repeat id and text
        texts = saved(texts.dropDuplicates(["rep"]))
    linked = saved(_linked(close, reps, texts, size, similarity))
    label = components(linked)

    def merged(label, links):
        """Components of the old ones and the new links."""
        held = label.select(F.col("component").alias("a"), F.col("id").alias("b"))
        return components(held.unionByName(links))

    tested = star
    for last in (False, True):
        rest = _mixed(members, label)
        if rest is None:
            break
        rest = saved(rest.join(sig, "rep"))
        pairs = _across(rest, need, texts, size, similarity) if last else _samples(rest, need)
        pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(pairs)
        links = saved(_linked(pairs, reps, texts, size, similarity))
        if not is_empty(links):
            label = saved(merged(label, links))
    named = saved(classes.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left")
                         .select("s1", "s2", "rep_id", F.coalesce("component", "rep").alias("component")))
    least = saved(named.groupBy("component").agg(F.min("rep_id").alias("component_id")))
    return signed.select("doc_id", "th", "n", "s1", "s2").join(
        saved(named.join(least, "component").select("s1", "s2", "component", "component_id")), ["s1", "s2"], "left").select(
        "doc_id", "th", "n", "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                    similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by
    links, its own included) and kept (it is that id)."""
    rows = _labelled(docs, id_col, text_col, size, similarity)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                         similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row of each component, with all its columns: the one of the
    smallest id (null last), then text hash; rows that repeat id and text
    count once. Rows without words all stay."""
    rows = saved(_labelled(docs, id_col, text_col, size, similarity).where("component is not null"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    stays = saved(rows.groupBy("component").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("__gone_id"), F.col("k.th").alias("__gone_text")))
    here = lambda other: F.col("__id").eqNullSafe(other["__gone_id"]) & (F.col("__text") == other["__gone_text"])
    named = rows.groupBy("doc_id", "th").agg(F.count("*").alias("_n")).select(F.col("doc_id").alias("__id"), F.col("th").alias("__text"), "_n")
    gone = saved(named.join(stays, here(stays), "left_anti").select(F.col("__id").alias("__gone_id"), F.col("__text").alias("__gone_text")))
    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__text": F.xxhash64(text_col)})
    kept = keyed.join(gone, here(gone), "left_anti")
    twice = saved(named.where("_n > 1").join(stays, here(stays), "left_semi").select(F.col("__id").alias("__gone_id"), F.col("__text").alias("__gone_text")))
    if not is_empty(twice):
        once = kept.join(twice, here(twice), "left_semi").dropDuplicates(["__id", "__text"])
        kept = kept.join(twice, here(twice), "left_anti").unionByName(once)
    return kept.drop("__id", "__text")
