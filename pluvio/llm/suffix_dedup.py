"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts anywhere else
goes. Strings that can't repeat are put aside first: each window of ``length`` bytes is
ruled by an anchor, the piece of a third of its length with the smallest hash in it.
Equal windows have equal anchors at equal places, so windows whose anchor occurs once
are unique. The stretch of text that a repeated anchor rules is a segment; segments
are dealt into shards by their anchor, a very common anchor over several.

A shard sorts the suffixes of its segments (Larsson-Sadakane: groups of equal prefixes
are split by the rank of what follows, the prefix doubling each round, sorted ones left
alone) and gets the common prefixes of neighbours by Kasai's rule, carried along all
segments at once. A window repeats in the shard if it shares ``length`` bytes with a
neighbour. Where an anchor lies in several shards, each cuts its sorted windows at the
same splitters, and the slices of a range are merged by binary search.

Copies cost little: of equal texts one is cut, and of equal segments one is sorted, with a
mark that all its windows repeat.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import BATCH, BATCH_BYTES, partitions, run_folder, store

CHUNK = 1 << 20        # bytes hashed at once
SHARD = 1 << 19        # bytes of a shard
SLICES = 8             # shards whose windows meet in one range, about
MULTIPLIER = 0x9E3779B97F4A7C15
PIECES = 4096          # segments of a long text in a batch
FIRST = 7              # bytes that the first sort compares


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Grams:
    """Hashes of all pieces of a fixed number of bytes."""

    def __init__(self, most: int, seed: int = 13):
        with np.errstate(over="ignore"):
            up, down = np.full(most, MULTIPLIER, np.uint64), np.full(most, pow(MULTIPLIER, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        self.value = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)

    def __call__(self, data: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.value[data] * self.up[:len(data)], out=total[1:])
            return _mix((total[k:] - total[:-k]) * self.down[:len(data) - k + 1])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w neighbours."""
    x = np.full(-(-len(v) // w) * w, 2**64 - 1, np.uint64)
    x[:len(v)] = v
    x = x.reshape(-1, w)
    before = np.minimum.accumulate(x, axis=1).reshape(-1)
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:len(v) - w + 1], before[w - 1:len(v)])


def anchors(data: np.ndarray, start: np.ndarray, length: int, grams: Grams):
    """Of texts that lie side by side in ``data``, text i at start[i]:start[i + 1]: the
    number of the text, the first and last window (its place in the text) that an anchor
    rules without a break, and the anchor's hash."""
    k = max(1, length // 3)
    w = length - k + 1
    place = np.uint64((1 << 21) - 1)
    out = []
    for at in range(0, len(data) - length + 1, CHUNK):
        h = grams(data[at:at + CHUNK + length - 1], k)
        # ties go to the first place, in every window alike
        least = sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), w)
        here = (least & place).astype(np.int64)
        window = np.arange(len(here)) + at
        text = np.searchsorted(start, window, side="right") - 1
        whole = window + length <= start[text + 1]
        here, window, text = here[whole], window[whole], text[whole]
        if not len(here):
            continue
        new = np.flatnonzero(np.concatenate([[True], (here[1:] != here[:-1]) | (text[1:] != text[:-1])]))
        last = np.concatenate([new[1:], [len(here)]]) - 1
        of = text[new]
        out.append((of, window[new] - start[of], window[last] - start[of], h[here[new]].view(np.int64)))
    if not out:
        return [np.empty(0, np.int64)] * 4
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def suffix_array(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of segments that lie side by side, segment s at
    start[s]:start[s + 1]. A suffix ends with its segment, by an end mark below all
    bytes; the mark of an earlier segment is the smaller."""
    n = len(data)
    segment = np.repeat(np.arange(len(start) - 1), np.diff(start))
    end = start[1:][segment]
    left = np.minimum(end - np.arange(n), FIRST)
    padded = np.concatenate([data, np.zeros(FIRST, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(FIRST):
        key = (key << np.uint64(8)) | np.where(left > j, padded[j:j + n], np.uint64(0))
    key = (key << np.uint64(8)) | left.astype(np.uint64)
    sa = np.argsort(key)
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # what ends within the prefix is told apart by the end mark
    ended = np.flatnonzero(left[sa] < FIRST)
    sa[ended] = sa[ended][np.lexsort((sa[ended], np.cumsum(head)[ended]))]
    head[ended] = True
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, slots, 0))
    open_ = slots[~(head & np.concatenate([head[1:], [True]]))]
    depth, marks = FIRST, len(start) - 1
    while len(open_):
        at = sa[open_]
        follow = at + depth  # not past the end mark, for else the prefix were unique
        second = np.where(follow == end[at], segment[at], marks + rank[np.minimum(follow, n - 1)])
        pair = rank[at] * (n + marks) + second
        order = np.argsort(pair)
        at, pair = at[order], pair[order]
        sa[open_] = at
        head = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[at] = np.maximum.accumulate(np.where(head, open_, 0))
        open_ = open_[~(head & np.concatenate([head[1:], [True]]))]
        depth *= 2
    return sa, rank


def common_prefixes(data: np.ndarray, start: np.ndarray, sa: np.ndarray, rank: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """For the first upto[s] suffixes of each segment, the bytes that each shares with
    the suffix before it in ``sa``; 0 elsewhere. One place of all segments a step: what a
    suffix shares is at least what the one before it in the text shares, less one."""
    n = len(data)
    out = np.zeros(n, np.int64)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    word = np.zeros(n + 8, np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j:j + n + 8]
    begin, stop = start[:-1], start[1:]
    end = np.repeat(stop, np.diff(start))
    order = np.argsort(-upto)
    shared = np.zeros(len(begin), np.int64)
    limits = 1 << np.arange(56, 0, -8, dtype=np.uint64)
    for step in range(int(upto.max(initial=0))):
        live = order[:np.searchsorted(-upto[order], -step, side="left")]
        i = begin[live] + step
        slot = rank[i]
        j = sa[slot - 1]
        h = np.maximum(shared[live] - 1, 0)
        room = np.where(slot == 0, 0, np.minimum(stop[live] - i, end[j] - j))
        go = np.flatnonzero(h < room)
        while len(go):
            differ = word[i[go] + h[go]] ^ word[j[go] + h[go]]
            same = np.where(differ == 0, 8, (differ[:, None] < limits).sum(axis=1))
            h[go] += same
            go = go[(same == 8) & (h[go] < room[go])]
        h = np.minimum(h, room)
        shared[live] = h
        out[i] = h
    return out


def repeats_in_shard(segments: list, many: list, length: int):
    """The text of a shard, its segments' starts, the number of windows of each, and for
    each byte whether a window that starts there also starts elsewhere, in the shard or in
    a copy of a segment that there are ``many`` of; at last, whether one starts before it
    in the order of the suffixes."""
    start = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
    data = np.frombuffer(b"".join(segments), np.uint8)
    windows = np.diff(start) - length + 1
    sa, rank = suffix_array(data, start)
    common = common_prefixes(data, start, sa, rank, windows) >= length
    again = common.copy()
    follows = np.flatnonzero(common[sa])  # its slot's neighbour before it repeats too
    again[sa[follows - 1]] = True
    for a, n, copied in zip(start, windows, many, strict=False):
        if copied:
            again[a:a + n] = True
    return data, start, windows, again, common


def _intervals(flags: np.ndarray) -> list:
    """First and last place of each run of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"a": int(a), "b": int(b) - 1} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


_PLACES = "array<struct<a:int,b:int>>"
_FOUND = f"h long, s0 long, s1 long, at {_PLACES}"
_SLICES = "h long, range int, salt long, f0 array<long>, f1 array<long>, seg array<int>, off array<int>, s0s array<long>, s1s array<long>"
_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_SLICE_TYPES = pa.schema([("h", pa.int64()), ("range", pa.int32()), ("salt", pa.int64()), ("f0", pa.list_(pa.int64())),
                          ("f1", pa.list_(pa.int64())), ("seg", pa.list_(pa.int32())), ("off", pa.list_(pa.int32())),
                          ("s0s", pa.list_(pa.int64())), ("s1s", pa.list_(pa.int64()))])


def _anchor_rows(length: int):
    def go(batches):
        grams = Grams(CHUNK + length)
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            if not len(texts) or offsets[-1] == offsets[0]:
                continue
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            text, lo, hi, h = anchors(data, offsets - offsets[0], length, grams)
            order = np.lexsort((h, text))
            twice = np.zeros(len(h), bool)
            same = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
            twice[order[1:][same]] = True
            k0, k1 = (batch.column(i).to_numpy(zero_copy_only=False)[text] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k0, pa.int64()), pa.array(k1, pa.int64()), pa.array(h), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(twice)],
                names=["k0", "k1", "h", "lo", "hi", "twice"])
    return go


def _piece_rows(length: int):
    """A text's segments, each with the digest of its bytes."""
    def go(batches):
        for batch in batches:
            for k0, k1, text, at in zip(*(batch.column(i) for i in range(4)), strict=True):
                k0, k1, text, at = k0.as_py(), k1.as_py(), text.as_py(), at.as_py()
                digest = np.array([np.frombuffer(xxhash.xxh3_128_digest(text[x["lo"]:x["hi"] + length]), np.int64) for x in at])
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["h"] for x in at], pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                     pa.array([k0] * n, pa.int64()), pa.array([k1] * n, pa.int64()),
                     pa.array([x["lo"] for x in at], pa.int32()), pa.array([x["hi"] for x in at], pa.int32())],
                    names=["h", "s0", "s1", "k0", "k1", "lo", "hi"])
    return go


def _segment_rows(length: int):
    """The bytes of the segments that go to the shards."""
    names = ("h", "salt", "salts", "s0", "s1")

    def go(batches):
        for batch in batches:
            for text, cut in zip(batch.column(0), batch.column(1), strict=True):
                text, every = text.as_py(), cut.as_py()
                for at in (every[i:i + PIECES] for i in range(0, len(every), PIECES)):
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([x[c] for x in at], pa.int64()) for c in names), pa.array([x["many"] for x in at], pa.bool_()),
                         pa.array([text[x["lo"]:x["hi"] + length] for x in at], pa.binary())], names=[*names, "many", "segment"])
    return go


def _shard_rows(length: int):
    """Sorts shards. One row for each segment with repeated windows; for an anchor that
    lies in several shards also the slices of its windows, one of each text in a shard."""
    def fingerprints(grams, data):
        return [np.concatenate([g(data, length), np.zeros(length - 1, np.uint64)]) for g in grams]

    def solved(held, grams):
        data, start, windows, again, common = repeats_in_shard([x["segment"] for x in held], [x["many"] for x in held], length)
        found = {}
        for x, a, n in zip(held, start, windows, strict=False):
            if again[a:a + n].any():
                found[x["h"], x["s0"], x["s1"]] = _intervals(again[a:a + n])
        rows = [{"h": k[0], "s0": k[1], "s1": k[2], "at": at} for k, at in found.items()]
        slices = []
        if held[0]["salts"] > 1:
            h, salt, salts = (held[0][c] for c in ("h", "salt", "salts"))
            of = np.repeat(np.arange(len(held)), windows)
            off = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            place = start[of] + off
            once = ~common[place]  # the first of each repeated window
            of, off, place = of[once], off[once], place[once]
            f0, f1 = (f[place] for f in fingerprints(grams, data))
            order = np.argsort(f0)
            f0, f1, of, off = f0[order], f1[order], of[order], off[order]
            ranges = -(-salts // SLICES)
            cuts = np.searchsorted(f0, np.array([(2**64 * r) // ranges for r in range(1, ranges)], np.uint64))
            for r, part in enumerate(np.split(np.arange(len(f0)), cuts)):
                if len(part):
                    used, seg = np.unique(of[part], return_inverse=True)
                    slices.append({"h": h, "range": r, "salt": salt, "f0": f0[part].view(np.int64), "f1": f1[part].view(np.int64),
                                   "seg": seg, "off": off[part], "s0s": [held[s]["s0"] for s in used], "s1s": [held[s]["s1"] for s in used]})
        return rows, slices

    names = [f.name for f in _SLICE_TYPES if f.name != "h"]

    def batch_of(rows, slices):
        every = rows + slices
        return pa.RecordBatch.from_arrays(
            [pa.array([x["h"] for x in every], pa.int64()), pa.array([x.get("s0") for x in every], pa.int64()),
             pa.array([x.get("s1") for x in every], pa.int64()), pa.array([x.get("at") for x in every], _RUNS),
             *(pa.array([x.get(c) for x in every], _SLICE_TYPES.field(c).type) for c in names)],
            names=["h", "s0", "s1", "at", *names])

    def go(batches):
        grams = [Grams((SHARD << 2) + length, seed) for seed in (101, 102)]
        held, size, part = [], 0, None
        for batch in batches:
            for x in batch.to_pylist():
                now = (x["h"], x["salt"])
                # an anchor in several shards has each of them for itself
                if held and now != part and (size + len(x["segment"]) > SHARD or x["salts"] > 1 or held[0]["salts"] > 1):
                    yield batch_of(*solved(held, grams))
                    held, size = [], 0
                held.append(x)
                size += len(x["segment"])
                part = now
                if len(grams[0].up) <= size + length:
                    grams = [Grams(2 * size + length, seed) for seed in (101, 102)]
        if held:
            yield batch_of(*solved(held, grams))
    return go


def merged_slices(slices: list) -> list:
    """Places (slice, row) of windows that lie in two or more of the sorted slices. Each
    slice is looked up by binary search in what the ones before it have merged."""
    known = np.empty(0, np.dtype([("f0", np.uint64), ("f1", np.uint64)]))
    owner = np.empty(0, np.int64)  # number of the row that brought a window
    base, hits = [0], []
    for f0, f1 in slices:
        own = np.empty(len(f0), known.dtype)
        own["f0"], own["f1"] = f0, f1
        order = np.argsort(own, order=("f0", "f1"))
        own, number = own[order], order + base[-1]
        lo = np.searchsorted(known["f0"], own["f0"], side="left")
        hi = np.searchsorted(known["f0"], own["f0"], side="right")
        fresh = np.ones(len(own), bool)
        for step in range(int((hi - lo).max(initial=0))):
            at = np.flatnonzero(lo + step < hi)
            at = at[known["f1"][lo[at] + step] == own["f1"][at]]
            fresh[at] = False
            hits += [number[at], owner[lo[at] + step]]
        into = hi[fresh]
        known, owner = np.insert(known, into, own[fresh]), np.insert(owner, into, number[fresh])
        base.append(base[-1] + len(f0))
    if not hits:
        return []
    every = np.unique(np.concatenate(hits))
    of = np.searchsorted(base, every, side="right") - 1
    return list(zip(of.tolist(), (every - np.array(base)[of]).tolist(), strict=True))


def _merge_rows():
    def solved(held):
        found = {}
        cols = [{c: np.array(x[c]) for c in ("f0", "f1", "seg", "off", "s0s", "s1s")} for x in held]
        for s, row in merged_slices([(c["f0"].view(np.uint64), c["f1"].view(np.uint64)) for c in cols]):
            c = cols[s]
            seg = c["seg"][row]
            found.setdefault((held[0]["h"], int(c["s0s"][seg]), int(c["s1s"][seg])), []).append(int(c["off"][row]))
        rows = []
        for (h, s0, s1), offs in found.items():
            flags = np.zeros(max(offs) + 1, bool)
            flags[offs] = True
            rows.append((h, s0, s1, _intervals(flags)))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), _RUNS))],
                                          names=["h", "s0", "s1", "at"])

    def go(batches):
        held = []
        for batch in batches:
            for x in batch.to_pylist():
                if held and (x["h"], x["range"]) != (held[0]["h"], held[0]["range"]):
                    yield solved(held)
                    held = []
                held.append(x)
        if held:
            yield solved(held)
    return go


def joined_spans(spans) -> list:
    """Overlapping and touching (start, end) put together."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _kept_rows(length: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def go(batches):
        for batch in batches:
            spans, kept = [], []
            for text, at in zip(batch.column(2), batch.column(3), strict=True):
                text = text.as_py()
                runs = joined_spans((x["a"], x["b"] + length) for x in at.as_py())
                edges = [0, *(e for r in runs for e in r), len(text)]
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                                             names=["_k0", "_k1", "spans", "kept"])
    return go


def _keys(text) -> dict:
    """Two 64-bit hashes by which equal texts are known."""
    return {"k0": F.xxhash64(text), "k1": F.xxhash64(F.lit(1), text)}


def _found_segments(shards: DataFrame) -> DataFrame:
    """Segments with repeated windows, from the shards and from merging their slices."""
    cols = [c.split()[0] for c in _SLICES.split(", ")]
    slices = shards.filter("f0 is not null").select(*cols)
    merged = (slices.repartition(partitions(shards.sparkSession), "h", "range").sortWithinPartitions("h", "range", "salt")
              .mapInArrow(_merge_rows(), _FOUND))
    return shards.filter("f0 is null").select("h", "s0", "s1", "at").union(merged)


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, text_sha256, spans and kept. ``spans``
    are the maximal runs of bytes (start, end exclusive, in the UTF-8 text) that lie in a
    string of ``length`` bytes which also starts anywhere else, the same document
    included; ``kept`` is what remains, null where all of it does. Null texts count as
    empty; texts shorter than ``length`` lose nothing. Rows with equal texts are each
    other's copies, repeated rows and null ids included. Extra columns aren't read.
    Texts, anchors and, across shards, windows are told apart by 128, 64 and 128 bits of
    hash; an anchor's chance match costs work only."""
    spark = docs.sparkSession
    n = partitions(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumns(_keys(F.col("text")))
    rows = store(keyed.select("doc_id", "k0", "k1", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256")))
    long_ = keyed.filter(F.octet_length("text") >= length).select("k0", "k1", F.col("text").cast("binary").alias("text"))
    copies = rows.filter(F.col("n_bytes") >= length).groupBy("k0", "k1").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    found = store(long_.mapInArrow(_anchor_rows(length), "k0 long, k1 long, h long, lo int, hi int, twice boolean"))
    again = store(found.groupBy("h").agg(F.min("k0").alias("a"), F.max("k0").alias("b"), F.max("twice").alias("twice"))
                  .filter("a < b or twice").select(F.col("h").alias("_h")))
    wanted = store(found.join(again, found["h"] == again["_h"], "left_semi").groupBy("k0", "k1")
                   .agg(F.collect_set(F.struct("h", "lo", "hi")).alias("at")).withColumnsRenamed({"k0": "_k0", "k1": "_k1"}))
    # the texts with repeated anchors, laid out by class for the three times they are read
    one = long_.groupBy("k0", "k1").agg(F.first("text").alias("text"))
    name = f"pluvio_segments_{uuid.uuid4().hex}"
    path = f"{run_folder(spark)}/{name}"
    batch = spark.conf.get(BATCH)
    spark.conf.set(BATCH, BATCH_BYTES)
    try:
        (one.join(wanted, (one["k0"] == wanted["_k0"]) & (one["k1"] == wanted["_k1"])).select("k0", "k1", "text", "at")
         .write.bucketBy(n, "k0", "k1").sortBy("k0", "k1").option("path", path).format("parquet").saveAsTable(name))
    finally:
        spark.conf.set(BATCH, batch)
    texts = spark.table(name)
    try:
        pieces = store(texts.mapInArrow(_piece_rows(length), "h long, s0 long, s1 long, k0 long, k1 long, lo int, hi int"))
        where = F.struct("k0", "k1", "lo", "hi")
        sorted_ = store(pieces.groupBy("h", "s0", "s1").agg(F.min(where).alias("x"), (F.count(F.lit(1)) > 1).alias("many"))
                        .select("h", "s0", "s1", "many", "x.*"))
        many = store(sorted_.groupBy(F.col("h").alias("_h")).agg(
            F.ceil(F.sum(F.col("hi") - F.col("lo") + length) / SHARD).cast("long").alias("salts")).filter("salts > 1"))
        salts = F.coalesce("salts", F.lit(1).cast("long"))
        dealt = (sorted_.join(many, sorted_["h"] == many["_h"], "left")
                 .select("h", F.pmod(F.xxhash64("s0", "s1"), salts).alias("salt"), salts.alias("salts"), "s0", "s1", "many", "k0", "k1", "lo", "hi")
                 .groupBy(F.col("k0").alias("_k0"), F.col("k1").alias("_k1"))
                 .agg(F.collect_list(F.struct("h", "salt", "salts", "s0", "s1", "many", "lo", "hi")).alias("cut")))
        segments = (texts.join(dealt, (texts["k0"] == dealt["_k0"]) & (texts["k1"] == dealt["_k1"])).select("text", "cut")
                    .mapInArrow(_segment_rows(length), "h long, salt long, salts long, s0 long, s1 long, many boolean, segment binary"))
        shards = store(segments.repartition(n, "h", "salt").sortWithinPartitions("h", "salt", "s0", "s1")
                       .mapInArrow(_shard_rows(length), _FOUND + ", " + _SLICES.removeprefix("h long, ")))
        # stored, so that both sides of the join with a common segment's pieces can be split
        hits = store(_found_segments(shards).groupBy(F.col("h").alias("_h"), F.col("s0").alias("_s0"), F.col("s1").alias("_s1"))
                     .agg(F.flatten(F.collect_list("at")).alias("at")))
        moved = F.transform("at", lambda x: F.struct((F.col("lo") + x["a"]).alias("a"), (F.col("lo") + x["b"]).alias("b")))
        spans = (pieces.join(hits, (pieces["h"] == hits["_h"]) & (pieces["s0"] == hits["_s0"]) & (pieces["s1"] == hits["_s1"]))
                 .select("k0", "k1", moved.alias("at")).groupBy(F.col("k0").alias("_k0"), F.col("k1").alias("_k1"))
                 .agg(F.flatten(F.collect_list("at")).alias("hits")))
        single = store(texts.join(spans, (texts["k0"] == spans["_k0"]) & (texts["k1"] == spans["_k1"])).select("k0", "k1", "text", "hits")
                       .mapInArrow(_kept_rows(length), "_k0 long, _k1 long, spans array<struct<start:long,end:long>>, kept binary"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    whole = store(copies.select(F.col("k0").alias("_a"), F.col("k1").alias("_b")))
    known = single.join(whole, (single["_k0"] == whole["_a"]) & (single["_k1"] == whole["_b"]), "full").select(
        F.coalesce("_k0", "_a").alias("_k0"), F.coalesce("_k1", "_b").alias("_k1"), F.col("_a").isNotNull().alias("copied"), "spans", "kept")
    got = rows.join(store(known), (F.col("k0") == F.col("_k0")) & (F.col("k1") == F.col("_k1")), "left")
    nothing = F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return got.select("doc_id", "n_bytes", "text_sha256",
                      F.when(F.col("copied"), all_).otherwise(F.coalesce("spans", nothing)).alias("spans"),
                      F.when(F.col("copied"), F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def drop_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts. A character that a cut
    leaves in part becomes U+FFFD. Null texts stay null; all rows and columns are kept."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = repeated_spans(docs, length, id_col, text_col).filter(F.col("kept").isNotNull())
    cut = found.groupBy(F.col("text_sha256").alias("_sha")).agg(F.first("kept").alias("_kept"))
    return (docs.join(store(cut), F.sha2(text, 256) == F.col("_sha"), "left")
            .select(*[F.coalesce(F.make_valid_utf8(F.col("_kept").cast("string")), F.col(f"`{c}`")).alias(c) if c == text_col
                      else F.col(f"`{c}`") for c in docs.columns]))
