"""Packing of tokenized documents into fixed windows by multiway differencing.

A document's ids (a separator id at its end) are cut at multiples of the window:
full windows stand alone, and what is left over, always shorter than a window,
is packed.  Left-overs are packed in blocks inside the task that tokenized them,
so nothing is shuffled, no row meets a global order, and a hot key has no meaning
here.  Within a block the Karmarkar-Karp rule repeatedly merges the two partial
partitions with the widest imbalance, adding the largest windows of one to the
smallest of the other, until one partition into ``k`` windows remains.  ``k``
starts at the fewest windows that could hold the block and rises while a window
exceeds the capacity.  Only the last block of a task may hold few left-overs.

Defined results: NULL text counts as empty; an empty document is one piece that
holds the separator; repeated rows are packed as often as they come; a NULL id is
returned as NULL; columns other than the id and the text are not read; an empty
table gives no pieces.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
BLOCK = 512  # left-overs packed together
_SEQ_BITS = 36  # sequences numbered within a task

# Characters on which the two libraries' splitting rules are known to agree (tested);
# texts with others, or with the start of a special token, go to the json tokenizer.
_PLAIN = re.compile("[^\x00-ɏ‐-‧€]|<\\|")
_encoders: dict[tuple, object] = {}


def _encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    """text -> uint32 ids, as the json tokenizer gives them.

    ``ranks_path`` names the same vocabulary as byte ranks; with it, plain texts take
    the faster of the two libraries.
    """
    key = (json_path, ranks_path)
    if key not in _encoders:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(json_path)
        tok.no_truncation()
        tok.no_padding()
        fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if fast is not None and _PLAIN.search(text) is None:
                return np.array(fast.encode_ordinary(text), dtype="<u4")
            return np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _encoders[key] = encode
    return _encoders[key]


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window (0..k-1) of every item, by multiway differencing into ``k`` windows."""
    n = len(sizes)
    if k <= 1:
        return np.zeros(n, dtype=np.int64)
    # node -> (left node, right node, order of the merged slots); leaves are the items
    merges: list[tuple[int, int, np.ndarray]] = []
    heap: list = []
    for i, s in enumerate(sizes):
        heap.append((-s, i, None))
    heapq.heapify(heap)

    def slots(size: int, values):
        if values is not None:
            return values
        one = np.zeros(k, dtype=np.int64)
        one[0] = size
        return one

    while len(heap) > 1:
        da, a, va = heapq.heappop(heap)
        db, b, vb = heapq.heappop(heap)
        total = slots(-da, va) + slots(-db, vb)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(total[0]), n + len(merges) - 1, total))
    place: dict[int, np.ndarray] = {heap[0][1]: np.arange(k)}
    out = np.zeros(n, dtype=np.int64)
    for node in range(n + len(merges) - 1, n - 1, -1):
        a, b, order = merges[node - n]
        here = place.pop(node)
        left = np.empty(k, dtype=np.int64)
        left[order] = here
        for child, pos in ((a, left), (b, left[::-1])):
            if child < n:
                out[child] = pos[0]
            else:
                place[child] = pos
    if n == 1:
        out[0] = 0
    return out


def pack_block(sizes: list[int], window: int) -> np.ndarray:
    """The window of every item: the fewest windows that differencing fills within capacity."""
    total = sum(sizes)
    k = max(1, -(-total // window))
    while True:
        place = differencing(sizes, k)
        if np.bincount(place, weights=sizes, minlength=k).max(initial=0) <= window:
            return place
        k += max(1, k // 100)


def _pack(batches, window: int, separator: int, block: int, spec: tuple, with_ids: bool):
    encode = _encoder(*spec)
    context = TaskContext.get()
    seq = (context.partitionId() if context else 0) << _SEQ_BITS
    out: list[tuple] = []
    waiting: list[tuple] = []

    def flush():
        nonlocal seq
        place = pack_block([p[2] for p in waiting], window)
        fill = [0] * (int(place.max()) + 1)
        number = {}
        for p, w in zip(waiting, place.tolist()):
            s = number.setdefault(w, len(number))
            out.append((*p[:5], seq + s, fill[w], *p[5:]))
            fill[w] += p[2]
        seq += len(number)
        waiting.clear()

    def emit() -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        cols = [pa.array([p[i] for p in out], pa.int64()) for i in range(7)]
        if with_ids:
            names.append("ids")
            cols.append(pa.array([p[7] for p in out], pa.binary()))
        out.clear()
        return pa.RecordBatch.from_arrays(cols, names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(encode(text.as_py() or ""), np.uint32(separator)).astype("<u4")
            n = len(ids)
            for start in range(0, n, window):
                cut = ids[start:start + window]
                raw = cut.tobytes()
                piece = (doc_id, start, len(cut), zlib.crc32(raw), n) + ((raw,) if with_ids else ())
                if len(cut) == window:
                    out.append((*piece[:5], seq, 0, *piece[5:]))
                    seq += 1
                else:
                    waiting.append(piece)
            if len(waiting) >= block:
                flush()
            if len(out) >= (2_000 if with_ids else 20_000):
                yield emit()
    if waiting:
        flush()
    if out:
        yield emit()


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
                   window: int = 1024, separator: int = 0, block: int = BLOCK, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: which ids of which document stand where in which sequence.

    ``json_path`` is the tokenizer file; ``ranks_path`` and ``pattern`` optionally name the same
    vocabulary as byte ranks.  ``with_ids`` also returns the ids of every piece, as the bytes that
    ``ids_crc32`` is taken of (unsigned 32 bits each, little-endian).
    """
    spec = (json_path, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack(batches, window, separator, block, spec, with_ids)

    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))
