"""Suffix-array deduplication of repeated byte strings.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller doc_id, or earlier in the same document) is removed. Exactly the
strings at all byte positions are judged, by a sparse suffix array:

1. *Anchors.* In each ``LENGTH``-byte string the leftmost smallest hash of
   its ``GRAM``-byte substrings names an anchor. Equal strings name the anchor
   at the same offset, so the strings an anchor owns (consecutive starts) can
   only equal strings owned by anchors with the same leading bytes. One text
   byte in forty or so is an anchor.
2. *Filter.* An anchor whose leading ``GRAM`` bytes occur once owns no
   repeated string. Hashes of the leading bytes are dealt out by hash; those
   met twice send their positions back. A task sends each hash once however
   often it saw it, so a hash that a third of all documents share costs one
   row per task.
3. *Suffixes.* The remaining anchors' suffixes (with the bytes to their left
   that owned strings reach) are range-partitioned by their leading bytes,
   with splitters from a sample that follows the number of buckets. Splitters also
   hold the document and position, so a hot suffix is cut across buckets.
4. *Buckets* sort their suffixes locally by multikey quicksort over 8-byte
   symbols, and likewise the reversed left contexts. Longest common prefixes
   of neighbours cut both orders into classes, and the strings at offset o of
   two anchors are equal exactly if their right classes at LENGTH - o and
   their left classes at o are. All but the earliest of a class are marked.
5. *Borders.* Where a splitter cuts the suffixes of one leading ``GRAM``
   bytes, each string still unmarked there is dealt once more, by a 128-bit
   hash of its ``LENGTH`` bytes; equal hashes count as equal strings. A bucket
   sends a string once, so a string costs one row per bucket at most and a
   shared line between differing texts spreads over all parts.
6. Marked ranges go back to their documents and the rest is hashed.

Texts that equal an earlier document's as a whole are marked at once by a
128-bit hash and take no part in steps 3 to 5.

Null is empty; texts shorter than LENGTH lose nothing. A null doc_id counts as the
smallest. Rows that repeat a doc_id and text are one document (equal results);
rows that repeat a doc_id with another text are compared by start only.
Memory of a task: a slice of text (or one document), one flush buffer, one
bucket of about ``BUCKET_ROWS`` suffixes, or about ``BORDER_STRINGS`` hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (_BYTE, _powers, bounded_batches, buffers, constants, hash128, mix, saved, slices)

LENGTH = 100
GRAM = 24
BUCKET_ROWS = 60_000
BORDER_STRINGS = 1 << 20
PER_SPLITTER = 16  # sampled suffixes a bucket
BROADCAST_SAMPLE = 200_000
_FLUSH = 16 << 20


# ---------------------------------------------------------------- anchors

class Anchors:
    """Anchors of a slice of documents: position in the slice, row, hash of
    the leading ``gram`` bytes, and the offsets lo..hi (anchor minus start)
    of the strings each one owns."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, length: int, gram: int):
        n, w = len(data), length - gram + 1
        none = np.empty(0, np.int64)
        self.pos = self.row = self.lo = self.hi = none
        self.hash = np.empty(0, np.uint64)
        if n < length:
            return
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=total[1:])
        h = mix((total[gram:] - total[:-gram]) * inverse[:n - gram + 1])
        bits = np.uint64(max(1, int(n).bit_length()))
        best = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span < w:
            step = min(span, w - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        owner = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # starts whose string lies in one document
        size = np.diff(offs)
        valid = np.zeros(len(owner) + 1, np.int64)
        rows = np.flatnonzero(size >= length)
        np.add.at(valid, offs[rows], 1)
        np.add.at(valid, offs[rows + 1] - length + 1, -1)
        start = np.flatnonzero(np.cumsum(valid[:-1]))
        if not len(start):
            return
        own = owner[start]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.r_[head[1:], len(own)] - 1
        self.pos = own[head]
        self.row = np.searchsorted(offs, start[head], side="right") - 1
        self.hash = h[self.pos]
        self.lo = self.pos - start[tail]
        self.hi = self.pos - start[head]


def _packed(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpacked(blob: bytes, n: int, *kinds):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 0
    for k in kinds:
        size = np.dtype(k).itemsize * n
        out.append(np.frombuffer(raw, k, n, at))
        at += size
    return [*out, raw[at:]]


def _by_part(part: np.ndarray):
    """(part, positions) of each part that occurs."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
    for a, b in zip(cut, np.r_[cut[1:], len(order)]):
        yield int(part[order[a]]), order[a:b]


# ------------------------------------------------- filter by leading bytes

def _deal_hashes(batches, length: int, gram: int, parts: int):
    """Blobs (part, n, hashes, documents, positions, flags). Flag 1: the hash
    occurs twice here; flag 2: sent besides such a row, to any part."""
    def flush(hs, docs, pos):
        h, d, p = np.concatenate(hs), np.concatenate(docs), np.concatenate(pos)
        order = np.argsort(h, kind="stable")
        h, d, p = h[order], d[order], p[order]
        first = np.r_[True, h[1:] != h[:-1]]
        twin = ~first | np.r_[~first[1:], False]
        flag = np.where(first, twin.astype(np.uint8), np.uint8(2))
        key = np.where(first, h, mix(p.astype(np.uint64) ^ mix(d.view(np.uint64))))
        part = (key % np.uint64(parts)).astype(np.int64)
        rows = [(k, len(at), _packed(h[at], d[at], p[at].astype(np.uint32), flag[at])) for k, at in _by_part(part)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.binary())], names=["part", "n", "z"])

    hs, docs, pos, held = [], [], [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offs = buffers(batch.column(1))
        for i, j in slices(offs):
            own = offs[i:j + 1] - offs[i]
            a = Anchors(data[offs[i]:offs[j]], own, length, gram)
            hs.append(a.hash)
            docs.append(ids[i + a.row])
            pos.append(a.pos - own[a.row])
            held += 24 * len(a.pos)
            if held > _FLUSH:
                yield flush(hs, docs, pos)
                hs, docs, pos, held = [], [], [], 0
    if held:
        yield flush(hs, docs, pos)


def _blobs(batches, *kinds):
    """Unpacked blobs of a partition, by part (a partition is one part as
    dealt; parts are told apart all the same)."""
    held: dict[int, list] = {}
    for batch in batches:
        for part, n, z in zip(*(batch.column(k).to_pylist() for k in range(3))):
            held.setdefault(part, []).append((n, z))
    for part in sorted(held):
        rows = held.pop(part)
        yield part, [(n, _unpacked(z, n, *kinds)) for n, z in rows]


def _repeated(batches):
    """(doc, positions) of anchors whose leading bytes occur twice."""
    for _, blobs in _blobs(batches, np.uint64, np.int64, np.uint32, np.uint8):
        h, d, p, flag = (np.concatenate([b[k] for _, b in blobs]) for k in range(4))
        loose = flag == 2
        mine = np.flatnonzero(~loose)
        mine = mine[np.argsort(h[mine], kind="stable")]
        hs = h[mine]
        cut = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]]) if len(hs) else np.empty(0, np.int64)
        size = np.diff(np.r_[cut, len(hs)])
        twice = (size > 1) | (np.maximum.reduceat(flag[mine], cut) == 1 if len(cut) else False)
        keep = np.concatenate([mine[np.repeat(twice, size)], np.flatnonzero(loose)])
        if len(keep):
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[keep]), pa.array(p[keep].astype(np.int32))], names=["doc", "pos"])


# ------------------------------------------------------------ local sorting

def _words(rows: np.ndarray) -> np.ndarray:
    """Byte rows as rows of big-endian 8-byte symbols."""
    n, m = rows.shape
    wide = np.zeros((n, -(-m // 8) * 8), np.uint8)
    wide[:, :m] = rows
    return wide.view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of rows of symbols: sorted by the first symbol, then each run of
    equal symbols by the next one, and so on; a run of one row is done."""
    n, m = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for d in range(1, m):
        single = new & np.r_[new[1:], True]
        at = np.flatnonzero(~single)
        if not len(at):
            break
        run = np.cumsum(new)[at]
        symbol = words[order[at], d]
        sub = np.lexsort((symbol, run))
        order[at] = order[at][sub]
        symbol = symbol[sub]
        new[at[1:]] |= (symbol[1:] != symbol[:-1])
    return order


def common_prefixes(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes each row shares with its predecessor in the order."""
    a, b = words[order[:-1]], words[order[1:]]
    differ = a != b
    d = differ.argmax(1)
    x = np.take_along_axis(a ^ b, d[:, None], 1)[:, 0]
    inside = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        inside += x < (np.uint64(1) << np.uint64(64 - 8 * k))
    return np.where(differ.any(1), 8 * d + inside, 8 * words.shape[1])


def _classes(words: np.ndarray):
    order = multikey_quicksort(words)
    return order, common_prefixes(words, order)


def mark(right: np.ndarray, left: np.ndarray, doc: np.ndarray, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray,
         length: int) -> np.ndarray:
    """Which owned strings also start earlier: a matrix (row, offset). Rows
    of ``right`` start at the anchor; rows of ``left`` go backwards from it."""
    n = len(doc)
    marked = np.zeros((n, length), bool)
    if n < 2:
        return marked
    first = np.lexsort((pos, doc))
    right, left, doc, pos, lo, hi = (x[first] for x in (right, left, doc, pos, lo, hi))
    r_order, r_lcp = _classes(_words(right))
    l_order, l_lcp = _classes(_words(left))
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(lo.min()), int(hi.max()) + 1):
        own = np.flatnonzero((lo <= o) & (o <= hi))
        if len(own) < 2:
            continue
        r_class[r_order] = np.r_[0, np.cumsum(r_lcp < length - o)]
        l_class[l_order] = np.r_[0, np.cumsum(l_lcp < o)]
        key = r_class[own] * n + l_class[own]
        sort = np.argsort(key, kind="stable")
        key = key[sort]
        new = np.r_[True, key[1:] != key[:-1]]
        head = own[sort][np.flatnonzero(new)][np.cumsum(new) - 1]  # earliest of the class
        row = own[sort]
        later = (doc[row] != doc[head]) | (pos[row] != pos[head])
        marked[first[row[later]], o] = True
    return marked


def _runs(marked: np.ndarray, pos: np.ndarray, length: int):
    """Marked offsets as byte ranges: (row, start, stop)."""
    edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)  # one past the largest offset of the run
    return row, pos[row] - (high - 1), pos[row] - low + length


# ------------------------------------------------------------ suffix buckets

class Suffixes:
    """Anchored suffixes with their left contexts, as fixed-width rows."""

    KINDS = (np.int64, np.uint32, np.int64, np.uint8, np.uint8)  # doc, check, pos, lo, hi

    def __init__(self, data, start, doc, check, pos, lo, hi, length, gram):
        self.doc, self.check, self.pos, self.lo, self.hi = doc, check, pos, lo, hi
        n = len(data)
        at = start[:, None] + np.arange(length)
        ok = np.arange(length) < (length - lo)[:, None]
        self.right = np.where(ok, data[np.minimum(at, max(n - 1, 0))], 0).astype(np.uint8)
        reach = length - gram
        back = start[:, None] - 1 - np.arange(reach)
        ok = np.arange(reach) < hi[:, None]
        self.left = np.where(ok, data[np.maximum(back, 0)], 0).astype(np.uint8)

    def pack(self, at) -> bytes:
        lo, hi = self.lo[at], self.hi[at]
        length, reach = self.right.shape[1], self.left.shape[1]
        r = self.right[at][np.arange(length) < (length - lo)[:, None]]
        b = self.left[at][np.arange(reach) < hi[:, None]]
        return _packed(self.doc[at], self.check[at], self.pos[at], lo.astype(np.uint8), hi.astype(np.uint8), r, b)

    @staticmethod
    def unpack(blobs, length: int, gram: int):
        """doc, check, pos, lo, hi, right, left of all blobs."""
        cols = [np.concatenate([b[k] for _, b in blobs]) for k in range(5)]
        lo, hi = cols[3].astype(np.int64), cols[4].astype(np.int64)
        n, reach = len(lo), length - gram
        right, left = np.zeros((n, length), np.uint8), np.zeros((n, reach), np.uint8)
        at = 0
        for m, b in blobs:
            raw = np.frombuffer(b[5], np.uint8)
            own = slice(at, at + m)
            r_ok = np.arange(length) < (length - lo[own])[:, None]
            l_ok = np.arange(reach) < hi[own][:, None]
            cut = int(r_ok.sum())
            right[own][r_ok] = raw[:cut]
            left[own][l_ok] = raw[cut:cut + int(l_ok.sum())]
            at += m
        return cols[0], cols[1], cols[2], lo, hi, right, left


def _keys(right: np.ndarray, doc: np.ndarray, pos: np.ndarray, gram: int) -> np.ndarray:
    """Leading bytes, document and position as byte strings that sort like the three."""
    tie = (doc.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    at = pos.astype(">u4").view(np.uint8).reshape(-1, 4)
    wide = np.ascontiguousarray(np.concatenate([right[:, :gram], tie, at], 1))
    return wide.view(f"S{gram + 12}").ravel() if len(wide) else np.empty(0, f"S{gram + 12}")


def _kept_suffixes(batches, length: int, gram: int):
    """Suffixes of the anchors that passed the filter, slice by slice.
    Columns: doc, text, check, positions."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        check = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint32)
        data, offs = buffers(batch.column(1))
        wanted = batch.column(3)
        for i, j in slices(offs):
            own = offs[i:j + 1] - offs[i]
            text = data[offs[i]:offs[j]]
            a = Anchors(text, own, length, gram)
            w = wanted.slice(i, j - i)
            count = np.diff(np.asarray(w.offsets))
            asked = np.repeat(own[:-1], count) + np.asarray(w.flatten())
            keep = np.isin(a.pos, asked)
            pos, row = a.pos[keep], a.row[keep]
            if len(pos):
                yield Suffixes(text, pos, ids[i + row], check[i + row], pos - own[row], a.lo[keep], a.hi[keep],
                               length, gram)


def _deal_suffixes(batches, splitters: np.ndarray, length: int, gram: int):
    """Blobs (part, n, suffixes) by range of the leading bytes."""
    def flush(held):
        rows = []
        whole = {}
        for s in held:
            part = np.searchsorted(splitters, _keys(s.right, s.doc, s.pos, gram), side="right")
            for k, at in _by_part(part):
                whole.setdefault(k, []).append((s, at))
        for k in sorted(whole):
            for s in [_joined(whole[k])]:
                rows.append((k, len(s.doc), s.pack(np.arange(len(s.doc)))))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.binary())], names=["part", "n", "z"])

    held, size = [], 0
    for s in _kept_suffixes(batches, length, gram):
        held.append(s)
        size += len(s.doc) * 220
        if size > 2 * _FLUSH:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _joined(parts) -> Suffixes:
    """Rows of several ``Suffixes``, sorted by leading bytes so that blobs of
    copies compress."""
    s = Suffixes.__new__(Suffixes)
    for name in ("doc", "check", "pos", "lo", "hi", "right", "left"):
        setattr(s, name, np.concatenate([getattr(x, name)[at] for x, at in parts]))
    order = np.argsort(_words(s.right[:, :8])[:, 0], kind="stable")
    for name in ("doc", "check", "pos", "lo", "hi", "right", "left"):
        setattr(s, name, getattr(s, name)[order])
    return s


_RESULT = "doc long, chk long, start long, stop long, n int, strings long, z binary"
_CHUNK = 8192  # rows a blob of border rows holds at most


def _result(doc, check, start, stop) -> pa.RecordBatch:
    k = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(check.astype(np.int64)), pa.array(start.astype(np.int64)),
         pa.array(stop.astype(np.int64)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())],
        names=["doc", "chk", "start", "stop", "n", "strings", "z"])


def _resolve(batches, cut_grams: frozenset, length: int, gram: int):
    """Marked ranges of a bucket, and the rows of cut leading bytes that
    still own an unmarked string (packed, after the bits of what is marked)."""
    for _, blobs in _blobs(batches, *Suffixes.KINDS):
        doc, check, pos, lo, hi, right, left = Suffixes.unpack(blobs, length, gram)
        marked = mark(right, left, doc, pos, lo, hi, length)
        row, start, stop = _runs(marked, pos, length)
        yield _result(doc[row], check[row], start, stop)
        if cut_grams:
            open_ = hi - lo + 1 - marked.sum(1)
            lead = np.ascontiguousarray(right[:, :gram]).view(f"S{gram}").ravel()
            hot = np.flatnonzero((open_ > 0) & np.isin(lead, np.array(sorted(cut_grams), f"S{gram}")))
            s = Suffixes.__new__(Suffixes)
            s.doc, s.check, s.pos, s.lo, s.hi, s.right, s.left = doc, check, pos, lo, hi, right, left
            for k in range(0, len(hot), _CHUNK):
                at = hot[k:k + _CHUNK]
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, none, none, pa.array([len(at)], pa.int32()), pa.array([int(open_[at].sum())]),
                     pa.array([_packed(np.packbits(marked[at], axis=1)) + s.pack(at)], pa.binary())],
                    names=["doc", "chk", "start", "stop", "n", "strings", "z"])


# ------------------------------------------------------------------ borders

def _string_hashes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independently seeded 64-bit hashes of each byte row."""
    words = _words(rows)
    out = []
    for seed in (53, 59):
        c = constants(words.shape[1] + 1, seed)
        h = np.full(len(words), c[-1], np.uint64)
        for k in range(words.shape[1]):
            h = mix((h ^ words[:, k]) * c[k])
        out.append(h)
    return out[0], out[1]


_STRING = (np.uint64, np.uint64, np.int64, np.uint32, np.int64)  # both hashes, doc, check, start


def _deal_strings(batches, length: int, gram: int, parts: int):
    """Blobs (part, n, strings) by hash: the unmarked strings of border rows.
    Columns: n, packed rows."""
    reach, bits = length - gram, -(-length // 8)

    def flush(held):
        cols = [np.concatenate(c) for c in zip(*held)]
        part = (cols[0] % np.uint64(parts)).astype(np.int64)
        rows = [(k, len(at), _packed(*(c[at] for c in cols))) for k, at in _by_part(part)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.binary())], names=["part", "n", "z"])

    held, size = [], 0
    for batch in batches:
        for n, z in zip(batch.column(0).to_pylist(), batch.column(1)):
            z = z.as_py()
            head = zstandard.ZstdDecompressor().decompressobj()
            marked = np.frombuffer(head.decompress(z), np.uint8).reshape(n, bits)
            blob = (n, _unpacked(head.unused_data, n, *Suffixes.KINDS))
            doc, check, pos, lo, hi, right, left = Suffixes.unpack([blob], length, gram)
            marked = np.unpackbits(marked, axis=1, count=length).astype(bool)
            text = np.concatenate([left[:, ::-1], right], 1)  # anchor at reach
            for o in range(int(lo.min()), int(hi.max()) + 1):
                own = np.flatnonzero((lo <= o) & (o <= hi) & ~marked[:, o])
                if len(own):
                    a, b = _string_hashes(text[own, reach - o:reach - o + length])
                    held.append((a, b, doc[own], check[own], pos[own] - o))
                    size += 36 * len(own)
                if size > _FLUSH:
                    yield flush(held)
                    held, size = [], 0
    if held:
        yield flush(held)


def _across_borders(batches, length: int):
    """Ranges of all strings of a part that also start earlier."""
    for _, blobs in _blobs(batches, *_STRING):
        a, b, doc, check, start = (np.concatenate([x[k] for _, x in blobs]) for k in range(5))
        order = np.lexsort((start, doc, b, a))
        a, b, doc, check, start = (x[order] for x in (a, b, doc, check, start))
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]  # earliest of its class
        later = np.flatnonzero((doc != doc[head]) | (start != start[head]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[later]), pa.array(check[later].astype(np.int64)), pa.array(start[later]),
             pa.array(start[later] + length)], names=["doc", "chk", "start", "stop"])


# ---------------------------------------------------------------- operator

def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (null is smallest), text and a checksum that tells texts of a
    repeated id apart."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
                       text.alias("text"), F.crc32(text).alias("chk"))


def repeated_ranges(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Byte ranges to remove, possibly overlapping: doc, chk, start, stop."""
    if not 8 <= gram < length <= 255:
        raise ValueError("8 <= gram < length <= 255")
    spark = docs.sparkSession
    bounded_batches(spark)
    source = _source(docs, id_col, text_col)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    h1, h2 = hash128(F.col("text"))
    meta = saved(source.select("doc", "chk", F.octet_length("text").alias("n"), h1.alias("h1"), h2.alias("h2")))
    firsts = saved(meta.where(F.col("n") >= length).groupBy("h1", "h2").agg(F.min("doc").alias("first")))
    copies = saved(meta.join(firsts, ["h1", "h2"]).where("doc <> first").select("doc", "chk", "n").distinct())
    total = meta.agg(F.sum("n")).first()[0] or 0
    # an id that stands for several texts is not left out below
    single = meta.join(copies.select("doc").distinct(), "doc").groupBy("doc").agg(
        F.min("chk").alias("lo"), F.max("chk").alias("hi")).where("lo = hi").select("doc")

    parts = max(least, int(total >> 26) + 1)  # about 1.5 million anchors each at most
    dealt = source.select("doc", "text").mapInArrow(
        lambda it: _deal_hashes(it, length, gram, parts), "part int, n int, z binary")
    again = dealt.repartitionById(parts, "part").mapInArrow(_repeated, "doc long, pos int")
    wanted = saved(again.groupBy("doc").agg(F.collect_list("pos").alias("at")).join(single, "doc", "left_anti"))
    rows = wanted.agg(F.sum(F.size("at"))).first()[0] or 0

    buckets = max(least, int(rows // bucket_rows) + 1)
    splitters, cut = _splitters(source, wanted, buckets, rows, length, gram)
    held = spark.sparkContext.broadcast((splitters, cut))
    suffixes = source.join(wanted, "doc").select("doc", "text", "chk", "at").mapInArrow(
        lambda it: _deal_suffixes(it, held.value[0], length, gram), "part int, n int, z binary")
    found = saved(suffixes.repartitionById(len(splitters) + 1, "part").mapInArrow(
        lambda it: _resolve(it, held.value[1], length, gram), _RESULT))
    ranges = found.where("doc is not null").select("doc", "chk", "start", "stop")
    strings = found.agg(F.sum("strings")).first()[0] or 0
    if strings:
        pieces = max(least, int(strings // BORDER_STRINGS) + 1)
        border = found.where("strings is not null").select("n", "z").mapInArrow(
            lambda it: _deal_strings(it, length, gram, pieces), "part int, n int, z binary")
        ranges = ranges.unionByName(border.repartitionById(pieces, "part").mapInArrow(
            lambda it: _across_borders(it, length), "doc long, chk long, start long, stop long"))
    whole = copies.select("doc", "chk", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("stop"))
    return ranges.unionByName(whole)


def _splitters(source: DataFrame, wanted: DataFrame, buckets: int, rows: int, length: int, gram: int):
    """Range splitters for ``buckets`` buckets of ``rows`` suffixes in all,
    and the leading bytes that a splitter cuts. Suffixes are sampled by a hash
    of their place, ``PER_SPLITTER`` a bucket, so that the sample follows the
    buckets: ``gram`` + 12 bytes a sampled suffix come to the driver, and as
    many a bucket go back."""
    share = min(1 << 30, math.ceil((PER_SPLITTER * buckets << 30) / max(1, rows)))
    sample = saved(wanted.select("doc", F.filter("at", lambda p: F.pmod(F.xxhash64("doc", p), F.lit(1 << 30)) < share).alias("at"))
                         .where(F.size("at") > 0))
    if PER_SPLITTER * buckets <= BROADCAST_SAMPLE:
        sample = F.broadcast(sample)

    def keys(batches):
        for s in _kept_suffixes(batches, length, gram):
            k = _keys(s.right, s.doc, s.pos, gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.ljust(gram + 12, b"\0") for x in k.tolist()], pa.binary())], names=["k"])

    got = source.join(sample, "doc").select("doc", "text", "chk", "at").mapInArrow(keys, "k binary")
    seen = sorted(bytes(r["k"]) for r in got.collect())
    kind = f"S{gram + 12}"
    if len(seen) < buckets:
        buckets = max(1, len(seen))
    cuts = sorted({seen[len(seen) * k // buckets] for k in range(1, buckets)}) if seen else []
    lead = frozenset(c[:gram].rstrip(b"\0") for c in cuts)
    return np.array(cuts, kind) if cuts else np.empty(0, kind), lead


def _rest(batches):
    """Counts and hash of what stays. Columns: doc_id, text, starts, stops."""
    for batch in batches:
        data, offs = buffers(batch.column(1))
        starts, stops = batch.column(2), batch.column(3)
        n_removed, n_spans, digest = [], [], []
        for i, j in slices(offs):
            own = offs[i:j + 1] - offs[i]
            text = data[offs[i]:offs[j]]
            cover = np.zeros(len(text) + 1, np.int64)
            for col, by in ((starts, 1), (stops, -1)):
                c = col.slice(i, j - i)
                at = np.repeat(own[:-1], np.diff(np.asarray(c.offsets))) + np.asarray(c.flatten())
                np.add.at(cover, at, by)
            gone = np.cumsum(cover[:-1]) > 0
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            edge = own[:-1][own[:-1] < len(text)]
            rise[edge] = gone[edge]
            count = lambda x: np.diff(np.r_[0, np.cumsum(x)][own])
            removed = count(gone)
            n_removed.append(removed)
            n_spans.append(count(rise))
            left = text[~gone].tobytes()
            ends = np.r_[0, np.cumsum(np.diff(own) - removed)]
            digest += [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        cat = lambda x: pa.array(np.concatenate(x or [np.empty(0, np.int64)]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offs)), cat(n_removed), cat(n_spans), pa.array(digest, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_ranges(docs: DataFrame, ranges: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text bytes, and the starts and stops of its ranges."""
    per = ranges.groupBy("doc", "chk").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    none = F.array().cast("array<bigint>")
    left = _source(docs, id_col, text_col).withColumn("doc_id", F.when(
        F.col("doc") != F.lit(-(1 << 63)).cast("long"), F.col("doc")))
    return left.join(per, ["doc", "chk"], "left").select(
        "doc_id", "text", F.coalesce("starts", none).alias("starts"), F.coalesce("stops", none).alias("stops"))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of what stays."""
    names = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return with_ranges(docs, repeated_ranges(docs, **options), **names).mapInArrow(
        _rest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
