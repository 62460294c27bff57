"""Packing of token windows by order-preserving dynamic programming.

Documents are laid end to end in input order, each closed by one id. Windows may end after a document, after a
sentence, a full window after either, or every 16 tokens of a stretch where neither comes for a sixteenth of a window. Of
all such cuts the dynamic program takes those with the least padding plus penalties: none after a document, a few
tokens for a cut sentence end, many elsewhere. Since a window's padding depends on its two ends separately, the best start
for each end is the minimum of a sliding window over values already known, which a monotone queue gives in constant time.

Each task packs its own rows and holds one block of them at a time; the open end of a block starts the next one. So
a task pads one window more than a single pass over all rows would, and nothing is shuffled. Sequence ids are
unique: the task's partition number times 2**33, plus the window's number.

Nulls: a null text is an empty document, which is its closing id alone; null ids are ids. Repeated rows are packed
one by one. An empty table gives an empty result. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from customer_canon.llm.common import releasing

#: Characters beyond Latin letters and the common marks.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u2027]")
#: Tokens of one block.
BLOCK = 1 << 20

#: Share of a window from which on a stretch without such ends may be cut anywhere, and the tokens from one cut to the next.
SELDOM, STEP = 1 / 16, 16

#: Penalties of a cut, in tokens of padding.
AT_DOCUMENT, AT_SENTENCE, ELSEWHERE = 0, 2, 16


def text_encoder(tokenizer_file: str, ranks_file: str | None = None) -> Callable[[str], bytes]:
    """Text to little-endian 32-bit ids, exactly those of ``tokenizer_file`` without added special tokens.

    ``ranks_file`` may hold the same vocabulary as ranks; then texts of Latin letters and common marks are encoded from
    it, which is several times faster. Texts with other characters or a special token go to the tokenizer.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    if not ranks_file:
        return whole
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> bytes:
        if _OTHER.search(text) or any(token in text for token in special):
            return whole(text)
        return np.array(fast.encode_ordinary(text), dtype="<u4").tobytes()

    return encode


def sentence_ends(tokenizer_file: str) -> np.ndarray:
    """For every id, whether a sentence or line may end after it."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(tokenizer_file)
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    marks = (".", "!", "?", *[as_bytes(mark)[0][0] for mark in ("\n", "。", "！", "？")])  # as byte-level BPE writes them
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    for number in range(len(ends)):
        token = tokenizer.id_to_token(number) or ""
        ends[number] = token.endswith(marks)
    return ends


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Indices of the cuts taken of rising ``places``; the first and the last are always among them.

    No two neighbouring places may be further apart than ``window``.
    """
    spots, fees = places.tolist(), penalties.tolist()
    cost = [0.0] * len(spots)
    start = [0] * len(spots)
    queue: deque[int] = deque([0])
    for end in range(1, len(spots)):
        oldest = spots[end] - window
        while spots[queue[0]] < oldest:
            queue.popleft()
        best = start[end] = queue[0]
        cost[end] = cost[best] + window - (spots[end] - spots[best]) + fees[end]
        value = cost[end] + spots[end]
        while queue and cost[queue[-1]] + spots[queue[-1]] >= value:
            queue.pop()
        queue.append(end)
    cuts = [len(spots) - 1]
    while cuts[-1]:
        cuts.append(start[cuts[-1]])
    return cuts[::-1]


class _Block:
    """Documents laid end to end, from the first token not yet packed."""

    def __init__(self, ends: np.ndarray, window: int):
        self.ends, self.window = ends, window
        self.docs: list[tuple] = []  # id, ids, first token not yet packed
        self.length = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.length += len(ids)

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        places, penalties, at = [np.zeros(1, dtype=np.int64)], [np.zeros(1)], 0
        for _, ids, done in self.docs:
            inner = np.flatnonzero(self.ends[ids[done:-1]]) + 1
            places.append(at + inner)
            penalties.append(np.full(len(inner), float(AT_SENTENCE)))
            at += len(ids) - done
            places.append(np.array([at]))
            penalties.append(np.array([float(AT_DOCUMENT)]))
        places, penalties = np.concatenate(places), np.concatenate(penalties)
        # a window may also be filled to the brim from any place, and end anywhere between places that are far apart
        full = places + self.window
        gaps = np.diff(places)
        wide = np.flatnonzero(gaps > SELDOM * self.window)
        inside = [np.arange(places[i] + STEP, places[i + 1], STEP) for i in wide]
        extra = np.concatenate([full[full < places[-1]], *inside])
        places = np.concatenate([places, extra])
        penalties = np.concatenate([penalties, np.full(len(extra), float(ELSEWHERE))])
        order = np.lexsort((penalties, places))
        places, penalties = places[order], penalties[order]
        keep = np.concatenate([[True], np.diff(places) > 0])
        return places[keep], penalties[keep]

    def packed(self, last: bool) -> list[list[tuple]]:
        """The pieces of each window; unless it is the ``last`` block, the final windows stay for the next one."""
        places, penalties = self._places()
        cuts = [int(places[i]) for i in best_cuts(places, penalties, self.window)]
        if not last:
            cuts = cuts[: max(2, len(cuts) - 3)]
        windows: list[list[tuple]] = []
        doc, at = 0, 0  # the document that covers token ``at``, and how far it has been packed
        rest = [list(d) for d in self.docs]
        for end in cuts[1:]:
            pieces, offset = [], 0
            while at < end:
                doc_id, ids, done = rest[doc]
                take = min(len(ids) - done, end - at)
                pieces.append((doc_id, done, ids[done : done + take], len(ids), offset))
                rest[doc][2] += take
                at, offset = at + take, offset + take
                if rest[doc][2] == len(ids):
                    doc += 1
            windows.append(pieces)
        self.docs = [tuple(d) for d in rest[doc:]]
        self.length -= at
        return windows


PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    ranks_file: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 1024,
    closing_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``.

    The files must be at the given path on every executor.
    """
    schema = PIECES.format(id=docs.schema[id_col].dataType.simpleString())
    if not with_ids:
        schema = schema.removesuffix(", ids array<int>")
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64()] * 6 + [pa.list_(pa.int32())] * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in this order, so that only one tokenizer is in memory
        ends = sentence_ends(tokenizer_file)
        encode = text_encoder(tokenizer_file, ranks_file)
        closing = np.array([closing_id], dtype="<u4").tobytes()
        block = _Block(ends, window)
        number = TaskContext.get().partitionId() << 33

        def rows(id_type: pa.DataType, last: bool) -> pa.RecordBatch:
            nonlocal number
            found = []
            for window_pieces in block.packed(last):
                for doc_id, start, ids, total, offset in window_pieces:
                    row = (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset)
                    found.append((*row, ids.astype("int32")) if with_ids else row)
                number += 1
            columns = zip(zip(*found), [id_type, *types])
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in columns], names=names)

        id_type = pa.null()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) if text.is_valid else b""
                block.add(doc_id, np.frombuffer(ids + closing, dtype="<u4"))
                if block.length >= BLOCK:
                    yield rows(id_type, last=False)
            batch = text = None  # else it stays while the next one is read
        if block.docs:
            yield rows(id_type, last=True)

    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(releasing(pieces), schema)
