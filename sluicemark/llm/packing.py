"""Harmonic packing of token sequences.

A sequence holds ``capacity`` tokens.  Class j takes pieces longer than capacity/(j+1) and at most
capacity/j, so a sequence of class j is full with exactly j pieces, whatever they are.  Every
worker fills its own sequences in one pass over its partition: nothing is shuffled, and a
repeated task gives the same rows.

A document whose length would leave more than ``slack`` of its class's sequence unused is cut at
the next class's exact size and its rest is placed again.  Pieces of at most capacity/``classes``
tokens, and the pieces of sequences still open when the partition ends, are strung together and cut at the
capacity; what is left at the very end is cut into powers of two, which need no padding.  A worker
holds less than ``classes`` open sequences at a time, so its memory does not grow with its input.

Texts are encoded in slices of ``SLICE_BYTES`` (a longer text is a slice of its own), so a very long text costs memory in proportion to itself.

Null and empty texts are one end token.  Null ids are carried along.  Repeated rows are packed
once each.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
END_ID = 1
CLASSES = 64
SLACK = 1 / 64
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class int"
)

# White space that str.split knows, beyond ASCII, as UTF-8 (fixed values).
_WIDE_SPACES = [ch.encode() for ch in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
SLICE_BYTES = 6 << 20


def word_starts(data: np.ndarray) -> np.ndarray:
    """Places of the spaces that stand before something else than white space.

    There the byte-level pre-tokenizer always starts a new word, so what lies on either side can be encoded on its own.
    """
    at = np.flatnonzero(data[:-1] == 0x20)
    following = data[at + 1]
    starts = ~_IS_SPACE[following]
    leads = {lead: np.flatnonzero(following == lead) for lead in {space[0] for space in _WIDE_SPACES}}
    for space in _WIDE_SPACES:
        if len(near := leads[space[0]]):
            ahead = np.minimum(at[near][:, None] + 1 + np.arange(len(space)), len(data) - 1)
            starts[near[(data[ahead] == np.frombuffer(space, dtype=np.uint8)).all(axis=1)]] = False
    return at[starts]


class Encoder:
    """Ids of whole texts; the words of a slice of texts are told apart first, and each is encoded once.

    With ``start`` a task begins to remember words from slice to slice, with ``stop`` it drops them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a space
        self.starts[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.stop()

    def stop(self) -> None:
        self.known: tuple[pa.Array, np.ndarray, np.ndarray] | None = None

    def start(self) -> None:
        self.known = pa.array([], pa.string()), np.zeros(0, dtype=np.uint32), np.zeros((2, 0), dtype=np.int64)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32), np.array([len(ids) for ids in found], dtype=np.int64)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_each``; words that are a space and then no white space are encoded as one text: every space in it starts a word."""
        plain = pc.match_substring_regex(words, r"^ [^\s\x0b\x1c-\x1f]+$").to_numpy(zero_copy_only=False)
        plain &= pc.equal(pc.binary_length(words), pc.utf8_length(words)).to_numpy(zero_copy_only=False)
        lens = np.zeros(len(words), dtype=np.int64)
        odd, lens[~plain] = self._each(words.filter(pa.array(~plain)).to_pylist())
        parts, chosen = [], np.flatnonzero(plain)
        for first in range(0, len(chosen), 4_000):
            block = chosen[first : first + 4_000]
            texts = words.take(pa.array(block)).to_pylist()
            ids, _ = self._each(["".join(texts)])
            at = np.flatnonzero(self.starts[ids])
            if len(at) == len(block):
                lens[block] = np.diff(np.append(at, len(ids)))
            else:
                ids, lens[block] = self._each(texts)
            parts.append(ids)
        # Back into the words' own order.
        together = np.concatenate([odd, *parts])
        order = np.concatenate([np.flatnonzero(~plain), chosen])
        begin = np.zeros(len(words), dtype=np.int64)
        begin[order] = np.cumsum(lens[order]) - lens[order]
        return together, np.stack([begin, lens])

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_distinct``, from what the task remembers where it can."""
        if self.known is None:
            return self._distinct(words)
        known, ids, places = self.known
        found = pc.index_in(words, value_set=known)
        at = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = words.filter(pc.is_null(found))
        if len(new):
            more, more_places = self._distinct(new)
            known, ids = pa.concat_arrays([known, new]), np.concatenate([ids, more])
            places = np.concatenate([places, more_places + np.array([[len(ids) - len(more)], [0]])], axis=1)
            self.known = known, ids, places
            at[at < 0] = np.arange(len(known) - len(new), len(known))
        return ids, places[:, at]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; a null is empty."""
        texts = pc.fill_null(texts, "")
        texts = pa.concat_arrays([texts]) if not texts.offset else pa.array(texts.to_pylist(), pa.string())
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int32)[: len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[: bounds[-1]]
        raw = data.tobytes()
        if any(t.encode() in raw for t in self.added):
            return self._each(texts.to_pylist())
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        own = bounds[:-1][np.diff(bounds) > 0]
        inner = word_starts(data)
        inner = inner[bounds[np.searchsorted(bounds, inner + 1)] != inner + 1]  # the last byte of a text starts no word
        starts = np.sort(np.concatenate([inner, own]), kind="stable")
        starts = starts[np.append(True, starts[1:] != starts[:-1])]
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32).tobytes())
        words = pa.StringArray.from_buffers(len(starts), offsets, texts.buffers()[2]).dictionary_encode()
        ids, (begin, lens) = self._looked_up(words.dictionary)
        codes = words.indices.to_numpy()
        n = lens[codes]
        ends = np.cumsum(n)
        places = np.arange(int(ends[-1])) + np.repeat(begin[codes] - (ends - n), n)
        total = np.append(0, ends)[np.searchsorted(starts, bounds)]
        return ids[places], np.diff(total)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


@cache
def encoder_at(path: str) -> Encoder:
    """The tokenizer of a worker process: its size does not depend on what it has encoded."""
    return Encoder(path)


def cuts(length: int, capacity: int = CAPACITY, classes: int = CLASSES, slack: float = SLACK) -> list[tuple[int, int]]:
    """(class, piece length) of a document, in order; class 0 marks a piece too short for a class."""
    found = [(1, capacity)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        if j >= classes:
            return [*found, (0, rest)]
        if j * rest >= capacity * (1 - slack):
            return [*found, (j, rest)]
        found.append((j + 1, capacity // (j + 1)))
        rest -= capacity // (j + 1)
    return found


class _Bins:
    """Open sequences of one worker.  A piece is (doc, start, ids, tokens of the document)."""

    def __init__(self, first_id: int, capacity: int):
        self.next_id, self.capacity = first_id, capacity
        self.open: dict[int, list[tuple]] = {}
        self.tail: list[tuple] = []
        self.tail_tokens = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple], kind: int) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.next_id, offset, kind))
            offset += len(ids)
        self.next_id += 1

    def add(self, kind: int, piece: tuple) -> None:
        if not kind:
            self.string(piece)
            return
        pieces = self.open.setdefault(kind, [])
        pieces.append(piece)
        if len(pieces) == kind:
            self.close(self.open.pop(kind), kind)

    def string(self, piece: tuple) -> None:
        self.tail.append(piece)
        self.tail_tokens += len(piece[2])
        while self.tail_tokens >= self.capacity:
            self.close(self.take(self.capacity), 0)

    def take(self, size: int) -> list[tuple]:
        """The first ``size`` tokens of the tail; the piece at the border is cut."""
        taken, need = [], size
        while need:
            doc, start, ids, tokens = self.tail[0]
            taken.append((doc, start, ids[:need], tokens))
            if len(ids) <= need:
                self.tail.pop(0)
            else:
                self.tail[0] = (doc, start + need, ids[need:], tokens)
            need -= len(taken[-1][2])
        self.tail_tokens -= size
        return taken

    def finish(self) -> None:
        for kind in sorted(self.open):
            for piece in self.open[kind]:
                self.string(piece)
        self.open = {}
        while self.tail_tokens:
            self.close(self.take(1 << (self.tail_tokens.bit_length() - 1)), 0)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 8
        self.rows = []
        kinds = [pa.int64()] * 7 + [pa.int32()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    classes: int = CLASSES,
    slack: float = SLACK,
) -> DataFrame:
    """One row per piece, see the module; ``class`` is the piece's harmonic class, 0 for strung rests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_at(tokenizer)
        encoder.start()
        bins = _Bins(TaskContext.get().partitionId() << 40, capacity)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = min(int(np.searchsorted(sizes, before + SLICE_BYTES)) + 1, batch.num_rows)
                ids, lens = encoder.encode_all(batch.column(1).slice(at, to - at))
                for doc, mine in zip(batch.column(0).slice(at, to - at).to_pylist(), np.split(ids, np.cumsum(lens)[:-1]), strict=True):
                    ids, start = np.append(mine, end), 0
                    for kind, size in cuts(len(ids), capacity, classes, slack):
                        bins.add(kind, (doc, start, ids[start : start + size], len(ids)))
                        start += size
                    if len(bins.rows) >= 10_000:
                        yield bins.batch()
                at = to
            yield bins.batch()
        encoder.stop()
        bins.finish()
        yield bins.batch()
        pa.default_memory_pool().release_unused()  # the worker process outlives the task

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInArrow(run, SCHEMA)
