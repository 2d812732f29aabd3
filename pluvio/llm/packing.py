"""Vector bin packing of token sequences.

A document's ids (and the closing id) are cut into pieces of at most one sequence;
pieces are dealt evenly over tasks by a hash of document and start, and each task
fills sequences one after the other under three limits at once: tokens, segments
and loss-bearing tokens. The next piece of an open sequence is, among those that fit
every limit, the one whose demand has the largest dot product with what remains of
the limits (each as a share of its limit). A task holds a window of pieces and one
open sequence, so its memory doesn't grow with the input.
"""
from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import partitions, widened, without

WINDOW = 4096       # pieces a task chooses from
BATCH_CHARS = 1 << 20
# beyond these the two tokenizer libraries may class characters differently
OTHER_CHARS = re.compile("[^\x00-ɏ]")
# the faster library fails on a million white-space characters in a row; looked for among
# every SPARSE-th character, so a run of ten times that is always found
SPARSE, SPACES = 1000, re.compile(r"\s{10}")

PIECE_SCHEMA = ("doc_id long, start long, length long, loss long, ids_crc32 long, doc_tokens long, "
                "ids array<int>")


class Encoder:
    """Ids of whole texts. The ranks are the same vocabulary for a library that is
    several times as fast; they serve texts of Latin characters without very long runs
    of white space, where both give the same ids (tested). All others go through the
    tokenizer file. Both are loaded in the
    task that first needs them."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        self.tokenizer_path, self.ranks_path = tokenizer_path, ranks_path
        self.exact = self.quick = None

    def __call__(self, text: str) -> np.ndarray:
        if self.ranks_path is not None and (text.isascii() or not OTHER_CHARS.search(text)) and not SPACES.search(text[::SPARSE]):
            if self.quick is None:
                self.quick = self._ranks()
            return self.quick.encode_to_numpy(text, disallowed_special=())
        if self.exact is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self.exact = Tokenizer.from_file(self.tokenizer_path)
            self.exact.encode_special_tokens = True
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _ranks(self):
        import base64

        import public_tokenizers
        import tiktoken
        with open(self.ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, max_tokens: int = 1024,
                 end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Pieces (PIECE_SCHEMA) of every document: its ids and ``end_id`` cut at multiples
    of ``max_tokens``. Null text counts as empty and gives one piece with ``end_id``; null
    ids and repeated rows make pieces of their own. Every id bears loss. ids is null unless
    asked for. Whole texts are encoded, with ``encode_special_tokens``: the text of a special
    token (``<|endoftext|>``) is ordinary text and becomes several ids, never the token's
    own, so no document can end itself."""

    def go(batches):
        encode = Encoder(tokenizer_path, ranks_path)
        for batch in batches:
            names = ("doc_id", "start", "length", "loss", "ids_crc32", "doc_tokens", "ids")
            out = {k: [] for k in names}
            size = 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                for start in range(0, len(ids), max_tokens):
                    piece = ids[start:start + max_tokens]
                    for k, v in zip(names, (doc.as_py(), start, len(piece), len(piece),
                                            zlib.crc32(piece.tobytes()), len(ids),
                                            piece.astype(np.int32) if with_ids else None), strict=True):
                        out[k].append(v)
                size += len(ids)
                if size > BATCH_CHARS:
                    yield _piece_batch(out)
                    out, size = {k: [] for k in names}, 0
            if out["start"]:
                yield _piece_batch(out)

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).mapInArrow(
        go, PIECE_SCHEMA)


def _piece_batch(cols: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[k], pa.int64()) for k in ("doc_id", "start", "length", "loss", "ids_crc32", "doc_tokens")]
        + [pa.array(cols["ids"], pa.list_(pa.int32()))],
        names=["doc_id", "start", "length", "loss", "ids_crc32", "doc_tokens", "ids"])


class _Filler:
    """Fills one sequence after the other from a window of pieces."""

    def __init__(self, limits, first_sequence: int):
        self.limits = np.array(limits, dtype=np.float64)
        self.next = first_sequence
        self.demand = np.empty((0, 3))
        self.row = np.empty(0, dtype=np.int64)
        self.placed: list[tuple[int, int, int]] = []  # row, sequence, offset

    def add(self, demand: np.ndarray, row: np.ndarray) -> None:
        if (demand > self.limits).any():
            raise ValueError("a piece exceeds a limit of a sequence by itself")
        self.demand = np.concatenate([self.demand, demand])
        self.row = np.concatenate([self.row, row])

    def fill(self, keep: int) -> None:
        """Fill sequences while more than ``keep`` pieces wait. Pieces of one demand score
        alike, so each demand is scored once and its pieces go in order of arrival."""
        kinds, kind = np.unique(self.demand, axis=0, return_inverse=True)
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=len(kinds)))
        at = np.concatenate([[0], ends[:-1]])  # of each demand, the next piece's place in ``order``
        share, tokens = kinds / self.limits, kinds[:, 0]
        free = np.ones(len(self.row), dtype=bool)
        left = len(self.row)
        while left > keep:
            remaining, offset = self.limits.copy(), 0
            while left:
                upto = tokens.searchsorted(remaining[0], side="right")  # demands are sorted by tokens
                fits = (at[:upto] < ends[:upto]) & (kinds[:upto] <= remaining).all(axis=1)
                score = np.where(fits, share[:upto] @ (remaining / self.limits), -1.0)
                top = score.max(initial=-1.0)
                if top < 0:
                    break
                ties = np.flatnonzero(score == top)
                best = int(ties[order[at[ties]].argmin()])
                piece = int(order[at[best]])
                at[best] += 1
                self.placed.append((int(self.row[piece]), self.next, offset))
                offset += int(kinds[best, 0])
                remaining -= kinds[best]
                free[piece] = False
                left -= 1
                if remaining[0] < 1 or remaining[1] < 1:
                    break
            self.next += 1
        self.demand, self.row = self.demand[free], self.row[free]


def pack(pieces: DataFrame, max_tokens: int = 1024, max_segments: int = 256, max_loss: int | None = None,
         groups: int | None = None, order: tuple = ("doc_id", "start")) -> DataFrame:
    """``pieces`` (columns length, loss and those of ``order``; any others are kept)
    plus sequence_id and offset (long). A sequence holds at most ``max_tokens`` tokens,
    ``max_segments`` pieces and ``max_loss`` loss-bearing tokens (default: no limit but
    max_tokens); offsets of a sequence run from 0 without a gap. A piece over a limit
    by itself raises. Pieces without tokens (or null length) are placed like any other
    at no cost in tokens. The result doesn't depend on the order in which rows arrive:
    each task sorts its share; it does depend on the number of tasks (``groups``, by default
    the shuffle partitions). Rows alike in all columns go to one task, where they stream
    through a bounded window. Extra columns sequence_id and offset are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    pieces = without(pieces, "sequence_id", "offset")
    n = groups or partitions(pieces.sparkSession)
    schema = widened(pieces, sequence_id=T.LongType(), offset=T.LongType())
    arrow = to_arrow_schema(schema)
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    at_l, at_b = pieces.columns.index("length"), pieces.columns.index("loss")

    def go(batches):
        from pyspark import TaskContext
        filler = _Filler(limits, TaskContext.get().partitionId() << 33)
        waiting: dict[int, pa.RecordBatch] = {}  # first row number -> batch with rows that wait

        def placed():
            """The rows placed since the last call, by batch of arrival."""
            if not filler.placed:
                return
            done = np.array(sorted(filler.placed), dtype=np.int64)
            filler.placed = []
            still = np.sort(filler.row)
            for first, batch in list(waiting.items()):
                own = done[(done[:, 0] >= first) & (done[:, 0] < first + batch.num_rows)]
                if len(own):
                    rows = batch.take(pa.array(own[:, 0] - first))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(own[:, 1]), pa.array(own[:, 2])], schema=arrow)
                k = np.searchsorted(still, first)
                if k == len(still) or still[k] >= first + batch.num_rows:
                    del waiting[first]

        seen = 0
        for whole in batches:
            for at in range(0, whole.num_rows, WINDOW // 2):
                batch = whole.slice(at, WINDOW // 2)
                waiting[seen] = batch
                length = np.nan_to_num(batch.column(at_l).to_numpy(zero_copy_only=False).astype(np.float64))
                loss = np.nan_to_num(batch.column(at_b).to_numpy(zero_copy_only=False).astype(np.float64))
                filler.add(np.stack([length, np.ones(len(length)), loss], axis=1),
                           np.arange(seen, seen + batch.num_rows))
                seen += batch.num_rows
                if len(filler.row) > WINDOW:
                    filler.fill(WINDOW // 2)
                    yield from placed()
        filler.fill(0)
        yield from placed()

    # the plain columns beside the order deal out pieces whose ids are null
    plain = [f.name for f in pieces.schema if isinstance(f.dataType, T.LongType | T.IntegerType)]
    key = F.xxhash64(*[F.col(c) for c in dict.fromkeys((*order, *plain))])
    return (pieces.repartition(n, key).sortWithinPartitions(*[F.col(c) for c in order])
            .mapInArrow(go, schema))
