"""Runs of periodic words by string synchronising sets.

A run is a stretch of words that repeats with a smallest period q at least four times
and that no neighbouring word extends. Periods are looked for at dyadic scales. At scale
t a hash of t words stands at every place; a place is picked if, of the hashes of the
t + 1 places from it on, the smallest is at either end. What is picked depends on the 2t
words from the place on alone, so a run of period t <= q < 2t picks the same places in
each of its periods, and has one among its first t: two picked places with equal
2t-word contexts and no such place between them, q apart, propose q. Proposals are
extended and checked word by word.

Places whose t words have a period of t / 4 or less are left out, or long stretches of a
small period would be picked at every place. They lie in runs of a smaller scale, which
are all known by then and supply the small periods themselves.
"""
from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import widened, without

TIMES = 4             # periods in a run at least; the scales rely on it
TOGETHER = 1 << 18    # words of documents solved together
NONE = np.uint64(2**64 - 1)
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """The smallest of v[i:i + w] at each place; beyond the end nothing counts."""
    x = np.full(-(-(len(v) + w) // w) * w, NONE)
    x[:len(v)] = v
    x = x.reshape(-1, w)
    before = np.minimum.accumulate(x, axis=1).reshape(-1)
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:len(v)], before[w - 1:len(v) + w - 1])


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many first items are equal."""
    done, step, most = 0, 32, min(len(x), len(y))
    while done < most:
        differ = x[done:min(done + step, most)] != y[done:min(done + step, most)]
        if differ.any():
            return done + int(differ.argmax())
        done += step
        step *= 4
    return most


def _prime_factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


def _stretch(words: np.ndarray, at: int, q: int, begin: int, end: int) -> tuple[int, int]:
    """The longest stretch of period q around words at .. at + q - 1, within its text."""
    right = at + q + _agree(words[at:end - q], words[at + q:end])
    left = at - _agree(words[begin:at][::-1], words[begin + q:at + q][::-1])
    return left, right


def find(words: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every stretch of at least TIMES periods, each period
    the smallest, in texts that lie side by side in ``words`` (numbers of words), text i
    at start[i]:start[i + 1]. Places are those in ``words``."""
    found: list[tuple[int, int, int]] = []
    size = np.diff(start)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(words))  # in words, of what is still looked at
    end = start[1:][text]
    with np.errstate(over="ignore"):
        h = _mix((words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.uint64(max(1, len(words).bit_length()))
    low = np.uint64((1 << int(bits)) - 1)
    t = 1
    while len(place):
        long_ = size[text[place]] >= TIMES * t
        if not long_.all():
            place, h = place[long_], h[long_]
            if not len(place):
                break
        n = len(place)
        v = h.copy()
        # with the run of a small period, all places whose t words lie in it
        edge = np.zeros(len(words) + 1, np.int32)
        for s, length, q in found:
            if TIMES * q <= t <= length:
                edge[s] += 1
                edge[s + length - t + 1] -= 1
        v[np.cumsum(edge[:-1])[place] > 0] = NONE
        least = _window_min(v, t + 1)
        far = np.minimum(np.arange(n) + t, n - 1)
        picked = np.flatnonzero((place + 2 * t <= end[place]) & (least != NONE) & ((v == least) | (v[far] == least)))
        with np.errstate(over="ignore"):
            h = _mix(h * np.uint64(0xD6E8FEB86659FD93) + h[far])
            context = _mix(h[picked] + text[place[picked]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        both = np.sort((context & ~low) | place[picked].astype(np.uint64))
        equal = np.flatnonzero((both[1:] ^ both[:-1]) <= low)
        a = (both[:-1][equal] & low).astype(np.int64)
        q = (both[1:][equal] & low).astype(np.int64) - a
        near = (q >= t) & (q < 2 * t)
        found += _checked(words, start, end, text, a[near], q[near])
        t *= 2
    return found


def _checked(words, start, end, text, a, q) -> list[tuple[int, int, int]]:
    """The stretches around proposed places a with periods q."""
    out = []
    order = np.lexsort((a, q))
    a, q = a[order], q[order]
    bound = np.searchsorted(q, q, side="right") if len(q) else q  # where a period's proposals end
    i = 0
    while i < len(a):
        at, period = int(a[i]), int(q[i])
        left, right = _stretch(words, at, period, int(start[text[at]]), int(end[at]))
        if right - left >= TIMES * period and not any(
                _agree(words[left:right - period // f], words[left + period // f:right]) == right - left - period // f
                for f in _prime_factors(period)):
            out.append((left, right - left, period))
        # the other proposals of this stretch
        i = max(i + 1, i + int(np.searchsorted(a[i:bound[i]], max(right - period, at + 1))))
    return out


def _solved(texts: list, least: int) -> tuple[list, list]:
    """Runs and collapsed text of each."""
    numbers = _Numbers()
    split = [t.split() for t in texts]  # bytes know no white space but that of ASCII
    start = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    words = np.fromiter((numbers[w] for part in split for w in part), np.int64, int(start[-1]))
    runs = [[] for _ in texts]
    drop = np.zeros(len(words) + 1, np.int32)
    for s, length, q in sorted((s, length, q) for s, length, q in find(words, start) if length >= least):
        i = int(np.searchsorted(start, s, side="right")) - 1
        runs[i].append({"start": s - int(start[i]), "length": length, "period": q})
        drop[s + q] += 1
        drop[s + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    kept = [b" ".join(compress(part, keep[a:b]) if runs[i] else part)
            for i, (part, a, b) in enumerate(zip(split, start[:-1], start[1:], strict=True))]
    return runs, kept


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = 6) -> DataFrame:
    """``docs`` plus ``runs``, all runs of at least ``least`` words and four periods as
    (start, length, period) in words by start and period, and ``collapsed``, the words
    that stay when of every run only the first period does, joined by one space. Words
    lie between ASCII white space. A null or blank text has no run and collapses to an
    empty one. Rows are looked at alone, so repeated rows, null ids and an empty table
    need no care; extra columns are kept, but for two of these names."""
    docs = without(docs, "runs", "collapsed")
    schema = widened(docs, runs=RUNS, collapsed=T.StringType())

    def go(batches):
        for batch in batches:
            column = batch.schema.get_field_index(text_col)
            at = 0
            for group in _groups(batch.column(column)):
                runs, kept = _solved(group, least)
                part = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns,
                     pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                     pa.array([k.decode() for k in kept], pa.string())], names=[*part.schema.names, "runs", "collapsed"])

    return docs.mapInArrow(go, schema)


def _groups(column):
    """Texts of a column as bytes, some together; a word takes two bytes at least."""
    held, size = [], 0
    for text in column:
        b = (text.as_py() or "").encode()
        if held and size + len(b) > 2 * TOGETHER:
            yield held
            held, size = [], 0
        held.append(b)
        size += len(b)
    if held:
        yield held


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end in a tenth of the texts, chosen by the id's CRC-32 h:
    where h % 10 = 0, with g = h div 10, the words from a = g % n on repeat the
    1 + (n - a) div (3 + g % 8) words from a. A null id changes nothing."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    text = F.col(f"`{text_col}`")

    def repeated(w):
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        words = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int"))))
        return F.when(n > 0, F.array_join(words, " ")).otherwise(text)

    # a lambda's argument is worked out once, however often it is referred to
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    new = F.when(text.isNotNull() & (h % 10 == 0), F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(text)
    return docs.withColumn(text_col, new)
