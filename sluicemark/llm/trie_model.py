"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is interpolated with a Dirichlet prior: p_k(w | context) = (c(context w) + m_k p_(k-1)(w)) / (c(context) + m_k), down to
p_1(w) = (c(w) + 1) / (N + V + 1), which is one for all words and an unknown one together.  The trie holds the first part,
c(context w) / (c(context) + m_k), quantised to steps of 1/4096 of a factor of ten; a scorer adds the prior's share, which follows from the context's count.

Documents become blocks: rows of at most ``BLOCK_BYTES`` of text (or one longer text) with their distinct words and each token's place among them.
Words get their counts and numbers in one shuffle of distinct words per block.  Then, order by order, a block asks for its distinct n-grams,
each once and with its own training count, grouped by context, which is the trie node of the order before.  A shard gathers
what all blocks ask of its contexts, sums the counts into a trie of memory-mapped levels and answers every block from it, so counting and
scoring share one shuffle; it looks an n-gram up once, however many blocks ask for it.  A context that no other block has, in training or held out, is not sent: the block builds a shard of such contexts itself, wherever it needs the answers.
Nothing is kept for the documents' tokens but their block, and no model is gathered anywhere.

Shards take ``SHARD_TOKENS`` training tokens each on average.  A context counted in training more than an eighth as often is dealt out by its successors
as well, and an n-gram that is everywhere is one entry per block, so no shard is hot.  Blocks and answers lie bucketed in the shared folder, so
blocks are never shuffled and an answer is shuffled once, however many orders need it.

Null text is empty: one end token.  A document without id is not held out.  Repeated rows count each time, and as training each time.  Very long texts
are a block of their own.  Ties do not arise.  An empty table gives no rows; with nothing to learn from, every token is unknown.  Other columns are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicemark.llm.elias_fano import TrieShard, probability
from sluicemark.session import new_database, new_folder, staged

ORDER = 3
PRIORS = (0.0, 0.0, 200.0, 20.0)  # of orders 0 to 3; higher orders take the last
BLOCK_BYTES = 8 << 20
SHARD_TOKENS = 1_000_000
END = ""  # no word is empty
MOST_WORD_SHARDS = 65_536
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BLOCK = "block long, docs array<long>, held_out array<boolean>, lens binary, words array<string>, codes binary, counts binary"
ASKED_WORDS = "shard long, block long, words array<string>, counts binary"
ASKED = "shard long, block long, contexts binary, context_counts binary, sizes binary, words binary, counts binary"
ANSWER = "block long, level int, shard long, distinct long, tokens long, codes binary, nodes binary, counts binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


_CODEC = pa.Codec("zstd", compression_level=1)


def packed(values: np.ndarray, steps: bool = False) -> bytes:
    """Whole numbers, or their steps, in as few bytes each as they need, compressed byte by byte."""
    values = np.diff(values.astype(np.int64), prepend=0) if steps else values
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = np.promote_types(np.min_scalar_type(low), np.min_scalar_type(high)) if low < 0 else np.min_scalar_type(high)
    kind = kind if kind.kind in "iu" else np.dtype(np.int64)
    values, octets = values.astype(kind), np.empty((kind.itemsize, len(values)), dtype=np.uint8)
    for place, part in enumerate(octets):
        part[:] = (values >> (8 * place)).astype(np.uint8)
    head = f"{kind.str[1:]} {len(values)} {int(steps)} ".encode()
    return head.ljust(24) + (_CODEC.compress(octets, asbytes=True) if octets.size else b"")


def unpacked(blob: bytes) -> np.ndarray:
    kind, n, steps = blob[:24].split()
    kind, n = np.dtype(kind.decode()), int(n)
    if not n:
        return np.zeros(0, dtype=np.int64)
    octets = np.frombuffer(_CODEC.decompress(blob[24:], n * kind.itemsize, asbytes=True), dtype=np.uint8).reshape(kind.itemsize, n)
    values = octets[-1].astype(f"u{kind.itemsize}")
    for part in octets[-2::-1]:
        values <<= 8
        values |= part
    values = values.view(kind).astype(np.int64)
    return np.cumsum(values) if steps == b"1" else values


def _all(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed column, row after row, and where each row's begin."""
    rows = [unpacked(blob) for blob in column.to_pylist()]
    return np.concatenate([np.zeros(0, dtype=np.int64), *rows]), np.append(0, np.cumsum([len(r) for r in rows], dtype=np.int64)).astype(np.int64)


def _cut(values: np.ndarray, bounds: np.ndarray, steps: bool = False) -> pa.Array:
    return pa.array([packed(values[a:b], steps) for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())


def _batch(schema: str, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[f.split()[0] for f in schema.split(", ")])


def _block(number: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (doc_id, held_out, text) as one block; every document ends with the end token."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(rows.column(2), "")))
    spoken = pc.not_equal(lists.values, "")
    owners = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[spoken.to_numpy(zero_copy_only=False)]
    coded = lists.values.filter(spoken).dictionary_encode()
    lens = np.bincount(owners, minlength=len(lists)) + 1
    # Words in order, so that neighbours have much in common; the end token's empty word is the first.
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(1, len(order) + 1, dtype=np.int32)
    codes = np.zeros(int(lens.sum()), dtype=np.int32)
    codes[np.arange(len(owners)) + owners] = place[coded.indices.to_numpy()]
    taught = np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), lens)
    counts = np.bincount(codes[taught], minlength=len(coded.dictionary) + 1)
    words = pa.concat_arrays([pa.array([END]), coded.dictionary.take(pa.array(order))])
    own = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    blobs = [pa.array([packed(v)], pa.binary()) for v in (lens, codes, counts)]
    return _batch(BLOCK, pa.array([number], pa.int64()), own(rows.column(0)), own(rows.column(1)), blobs[0], own(words), *blobs[1:])


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                # As many rows as fit, the one that passes the limit included.
                end = min(int(np.searchsorted(sizes, before + block_bytes - size)) + 1, batch.num_rows)
                parts.append(batch.slice(at, end - at))
                size += int(sizes[end - 1]) - before
                at = end
                if size >= block_bytes:
                    yield _block(number, pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _block(number, pa.Table.from_batches(parts).combine_chunks().to_batches()[0])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, BLOCK)


class Totals:
    """Training tokens, distinct words among them, training documents, and the first number of each word shard."""

    def __init__(self, tokens: int, distinct: int, documents: int, starts: np.ndarray):
        self.tokens, self.distinct, self.documents, self.starts = tokens, distinct, documents, starts


_POWER = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: pa.Array) -> np.ndarray:
    """A number for each word, to deal it to a shard by."""
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int32)[: len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[: bounds[-1]].astype(np.uint64) + np.uint64(1)
    lens = np.diff(bounds)
    powers = np.multiply.accumulate(np.full(max(int(lens.max(initial=0)), 1), _POWER))
    sums = np.append(np.uint64(0), np.cumsum(data * powers[np.arange(len(data)) - np.repeat(bounds[:-1], lens)], dtype=np.uint64))
    return _mixed((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))


def _by_shard(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by shard (what comes first stays first), the shards there are, and where each begins."""
    order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    dealt = shard[order]
    starts = np.flatnonzero(np.diff(dealt, prepend=-1))
    return order, dealt[starts], np.append(starts, len(order)).astype(np.int64)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (none is negative) in order, and the rank of each key among them."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits < 64:
        # Sorted with their places in their low bits, which takes a fraction of the time of sorting the places.
        both = (keys << bits) | np.arange(len(keys))
        both.sort()
        order, both = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys)
        both = keys[order]
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    rank = np.empty(len(both), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return both[new], rank


def _words(block: pa.Table) -> pa.Array:
    return pa.concat_arrays([block["words"].combine_chunks().flatten()])


def _ask_words(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = pa.Table.from_batches([batch.slice(row, 1)])
                words, counts = _words(block), unpacked(block["counts"][0].as_py())
                order, shards, bounds = _by_shard(_hashes(words) % buckets)
                dealt = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), words.take(pa.array(order)))
                yield _batch(ASKED_WORDS, pa.array(shards), pa.array([block["block"][0].as_py()] * len(shards), pa.int64()), dealt, _cut(counts[order], bounds))

    return ask


def _answer_words(rows: pa.Table) -> pa.Table:
    """Number the shard's words, sum their training counts and mark those that only one block has."""
    rows = rows.combine_chunks()
    coded = pa.concat_arrays([rows["words"].combine_chunks().flatten()]).dictionary_encode()
    place, (counts, bounds) = coded.indices.to_numpy().astype(np.int64), _all(rows["counts"])
    sums = np.zeros(len(coded.dictionary), dtype=np.int64)
    np.add.at(sums, place, counts)
    # Numbers go by the order of the words, those in training first, so that only they take up numbers.
    order = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(sums), dtype=np.int64)
    number[order[np.argsort(sums[order] == 0, kind="stable")]] = np.arange(len(sums))
    n, known = rows.num_rows, int((sums > 0).sum())
    return pa.Table.from_batches([_batch(
        ANSWER, rows["block"].combine_chunks(), pa.array([1] * n, pa.int32()), rows["shard"].combine_chunks(), pa.array([known] * n, pa.int64()),
        pa.array([int(sums.sum())] * n, pa.int64()), _cut((np.bincount(place)[place] == 1).astype(np.int8), bounds), _cut(number[place], bounds, steps=True), _cut(sums[place], bounds),
    )])


def number_words(held: DataFrame, keep: Callable[[DataFrame], DataFrame] = staged) -> tuple[DataFrame, Totals]:
    """The answer of order 1, each block's words with number within their shard and training count, as ``keep`` stored it; and the totals."""
    buckets = min(max(held.count(), 1), MOST_WORD_SHARDS)
    # A word is once in a block, so a common one is one entry per block.
    asked = held.select("block", "words", "counts").mapInArrow(_ask_words(buckets), ASKED_WORDS)
    answer = keep(asked.groupBy("shard").applyInArrow(_answer_words, ANSWER))
    per_shard = answer.groupBy("shard").agg(F.max("distinct").alias("distinct"), F.max("tokens").alias("tokens")).collect()  # MOST_WORD_SHARDS rows at most
    documents = held.select(F.expr("aggregate(held_out, 0L, (s, h) -> s + IF(h, 0L, 1L))").alias("n")).agg(F.sum("n")).first()[0]
    starts = np.zeros(buckets + 1, dtype=np.int64)
    for row in per_shard:
        starts[row["shard"] + 1] = row["distinct"]
    return answer, Totals(sum(r["tokens"] for r in per_shard), int(starts.sum()), documents or 0, np.cumsum(starts))


def _mixed(values: np.ndarray) -> np.ndarray:
    """Whole numbers scattered over 63 bits."""
    v = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((v ^ (v >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


class _Grams:
    """Distinct n-grams of a block for one order, by context and word.

    ``of`` gives the n-gram of each token, -1 where a document has no context that long.
    """

    def __init__(self, contexts: np.ndarray, codes: np.ndarray, words: int):
        whole = np.flatnonzero(contexts >= 0)
        bits = words.bit_length()
        keys, rank = _ranked((contexts[whole] << bits) | codes[whole])
        self.context, self.word = keys >> bits, keys & ((1 << bits) - 1)
        self.of = np.full(len(codes), -1, dtype=np.int64)
        self.of[whole] = rank

    def deal(self, nodes: np.ndarray, counts: np.ndarray, alone: np.ndarray, numbers: np.ndarray, known: np.ndarray, shards: int, split: int) -> None:
        """Which n-grams are asked for (context and word were both seen in training), by shard; and those whose context is in this block alone."""
        seen = (counts[self.context] > 0) & known[self.word]
        alone = alone[self.context]
        self.alone, seen = np.flatnonzero(seen & alone), np.flatnonzero(seen & ~alone)
        context = self.context[seen]
        shard = (_mixed(nodes) % shards)[context]
        if len(hot := np.flatnonzero((counts > split)[context])):
            shard[hot] = _mixed(_mixed(nodes[context[hot]]) ^ _mixed(numbers[self.word[seen[hot]]] + 1)) % shards
        order, self.shards, self.bounds = _by_shard(shard)
        self.asked = seen[order]


def _looked_up(
    entries: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place (-1 where it is not there), code and count of each asked n-gram, from a shard of the entries."""
    with tempfile.TemporaryDirectory() as folder:
        trie = TrieShard(*entries, Path(folder))
        place = trie.find(contexts, sizes, words)
        there = place >= 0
        codes, found = np.zeros(len(words), dtype=np.int16), np.zeros(len(words), dtype=np.int64)
        codes[there] = trie.codes[place[there]]
        found[there] = trie.counts[place[there]]
        del trie  # unmaps the files
    return place, codes, found


class _State:
    """A block with the answers to its questions of the first orders."""

    def __init__(self, block: pa.Table, answers: pa.Table, heard: int, totals: Totals, shards: int, split: int, priors: tuple[float, ...]):
        self.shards, self.split, self.priors = shards, split, priors
        self.number, self.docs, self.out = block["block"][0].as_py(), block["docs"].combine_chunks().flatten(), block["held_out"].combine_chunks().flatten()
        self.lens = unpacked(block["lens"][0].as_py())
        self.starts = np.cumsum(self.lens) - self.lens
        answers = answers.take(pc.sort_indices(answers, [("level", "ascending"), ("shard", "ascending")]))
        levels = answers["level"].to_numpy()
        self._number_words(block, answers.filter(pa.array(levels == 1)), totals)
        self.floor = (self.word_counts[:-1] + 1) / (totals.tokens + totals.distinct + 1)
        self.level, self.grams, self.nodes, self.counts, self.chances = 1, None, self.numbers, self.word_counts, self.floor[self.codes]
        for level in range(2, heard + 1):
            self._next()
            self._hear(answers.filter(pa.array(levels == level)))

    def _number_words(self, block: pa.Table, first: pa.Table, totals: Totals) -> None:
        """Words in the order of their numbers; one entry more stands for the start of a text, a context only."""
        words = _words(block)
        order, shards, bounds = _by_shard(_hashes(words) % (len(totals.starts) - 1))
        local, counts = _all(first["nodes"])[0], _all(first["counts"])[0]
        numbers = np.where(counts > 0, local + np.repeat(totals.starts[shards], np.diff(bounds)), totals.distinct + 1)
        by_number = np.argsort(numbers, kind="stable")
        place = np.empty(len(words), dtype=np.int64)
        place[order[by_number]] = np.arange(len(words))
        self.codes = place[unpacked(block["codes"][0].as_py())]
        self.numbers, self.word_counts = np.append(numbers[by_number], totals.distinct), np.append(counts[by_number], totals.documents)
        self.alone = np.append(_all(first["codes"])[0][by_number] > 0, len(totals.starts) == 2)

    def _next(self) -> None:
        """N-grams of the next order: each token after the n-gram that ends before it."""
        if self.grams is not None:
            self._go_by_nodes()
        before = self.codes if self.grams is None else self.grams.of
        contexts = np.append(0, before[:-1])
        contexts[self.starts] = len(self.numbers) - 1 if self.grams is None else -1
        self.grams = grams = _Grams(contexts, self.codes, len(self.numbers))
        taught = np.repeat(~self.out.to_numpy(zero_copy_only=False), self.lens) & (grams.of >= 0)
        self.training = np.bincount(grams.of[taught], minlength=len(grams.word))
        grams.deal(self.nodes, self.counts, self.alone, self.numbers, self.word_counts > 0, self.shards, self.split)

    def _own_answers(self, prior: float) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts of the n-grams whose context no other block has.

        They have no node: whatever follows them is in this block as well, so it is never asked for.
        """
        at = self.grams.alone
        context, word, n = self.grams.context[at], self.grams.word[at], self.training[at]
        first, counted = np.flatnonzero(np.diff(context, prepend=-1)), np.flatnonzero(n)
        entries = context[counted], word[counted], n[counted] / (self.counts[context[counted]] + prior), n[counted]
        return _looked_up(entries, context[first], np.diff(np.append(first, len(at))), word)[1:]

    def _hear(self, answers: pa.Table) -> None:
        grams, self.level = self.grams, self.level + 1
        codes, nodes, counts = (np.zeros(len(grams.word), dtype=np.int64) for _ in range(3))
        codes[grams.asked] = _all(answers["codes"])[0]
        if len(named := _all(answers["nodes"])[0]):
            nodes[grams.asked], counts[grams.asked] = named, _all(answers["counts"])[0]
        prior = self.priors[min(self.level, len(self.priors) - 1)]
        # A shard gives no count to an n-gram that only one block asked for: the block has it itself.
        own = (codes > 0) & (counts == 0)
        counts[own] = self.training[own]
        own[grams.alone] = True
        codes[grams.alone], counts[grams.alone] = self._own_answers(prior)
        whole = np.flatnonzero(grams.of >= 0)
        of = grams.of[whole]
        rest = (prior / (self.counts + prior))[grams.context]
        self.chances[whole] = probability(codes)[of] + rest[of] * self.chances[whole]
        self.nodes, self.counts, self.alone = nodes, counts, own

    def _go_by_nodes(self) -> None:
        """N-grams in the order of their nodes, in which a shard gave them: what is asked of a shard next then comes in the order of its contexts."""
        asked = self.grams.asked
        order = np.concatenate([np.flatnonzero(self.nodes == 0), asked[self.nodes[asked] > 0]])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        whole = np.flatnonzero(self.grams.of >= 0)
        self.grams.of[whole] = place[self.grams.of[whole]]
        self.nodes, self.counts, self.alone = self.nodes[order], self.counts[order], self.alone[order]

    def questions(self) -> pa.RecordBatch:
        """One row per shard asked."""
        self._next()
        grams = self.grams
        training = self.training[grams.asked]
        context, word = grams.context[grams.asked], self.numbers[grams.word[grams.asked]]
        new = np.ones(len(context), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        new[grams.bounds[:-1]] = True
        first = np.flatnonzero(new)
        of_shard = np.searchsorted(first, grams.bounds)
        return _batch(
            ASKED, pa.array(grams.shards, pa.int64()), pa.array([self.number] * len(grams.shards), pa.int64()), _cut(self.nodes[context[first]], of_shard, steps=True),
            _cut(self.counts[context[first]], of_shard), _cut(np.diff(np.append(first, len(context))), of_shard), _cut(word, grams.bounds), _cut(training, grams.bounds),
        )

    def scores(self) -> pa.RecordBatch:
        """Sums over each document."""
        add = lambda values: np.add.reduceat(values, self.starts)
        known = add((self.word_counts[self.codes] > 0).astype(np.int64))
        return _batch(
            SCORES, self.docs, self.out, pa.array(self.lens), pa.array(known), pa.array(add(np.log10(self.floor)[self.codes])), pa.array(add(np.log10(self.chances)))
        )


def _answer_shard(level: int, prior: float, last: bool) -> Callable[[pa.Table], pa.Table]:
    def answer(rows: pa.Table) -> pa.Table:
        """Build the shard's trie from what all blocks count and answer each of them."""
        (contexts, _), (totals, _), (sizes, _) = _all(rows["contexts"]), _all(rows["context_counts"]), _all(rows["sizes"])
        (words, bounds), (counts, _) = _all(rows["words"]), _all(rows["counts"])
        rows = rows.select(["shard", "block"])
        # Each distinct n-gram that was asked for is summed, and looked up, once.
        known, owner = _ranked(contexts)
        total = np.zeros(len(known), dtype=np.int64)
        total[owner] = totals
        bits = int(words.max(initial=0)).bit_length()
        grams, rank = _ranked((np.repeat(owner, sizes) << bits) | words)
        context, word = grams >> bits, grams & ((1 << bits) - 1)
        n, askers = np.bincount(rank, weights=counts, minlength=len(grams)).astype(np.int64), np.bincount(rank, minlength=len(grams))
        counted = np.flatnonzero(n)
        of, n = context[counted], n[counted]
        entries = known[of], word[counted], n / (total[of] + prior), n
        del grams, owner, words, counts, counted, of
        place, codes, found = _looked_up(entries, known, np.bincount(context, minlength=len(known)), word)
        found[askers == 1] = 0  # one block asked, and counts for itself
        nodes = np.where(place >= 0, (rows["shard"][0].as_py() << 36) + place, 0)
        del entries, context, word, place
        n = rows.num_rows
        none = pa.array([packed(found[:0])] * n, pa.binary())
        zeros = pa.array([0] * n, pa.int64())
        return pa.Table.from_batches([_batch(
            ANSWER, rows["block"].combine_chunks(), pa.array([level] * n, pa.int32()), rows["shard"].combine_chunks(), zeros, zeros, _cut(codes[rank], bounds),
            none if last else _cut(nodes[rank], bounds, steps=True), none if last else _cut(found[rank], bounds),
        )])

    return answer


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each order shuffles about as much as the table holds: its files go as its query ends, not whenever the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, priors: tuple[float, ...] = PRIORS, block_bytes: int = BLOCK_BYTES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the model's score."""
    spark = docs.sparkSession
    database, buckets = new_database(spark, "blocks"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks(docs, doc_id, text, block_bytes).write.bucketBy(buckets, "block").option("compression", "zstd").saveAsTable(f"{database}.blocks")
    held = spark.table(f"{database}.blocks")

    def keep(answer: DataFrame) -> DataFrame:
        answer.repartition(buckets, "block").write.mode("append").bucketBy(buckets, "block").saveAsTable(f"{database}.answers")
        return spark.table(f"{database}.answers")

    with _shuffles_removed(spark):
        answers, totals = number_words(held, keep)
    shards, split = max(1, totals.tokens // shard_tokens), shard_tokens // 8

    def with_answers(level: int, work: Callable[[_State], pa.RecordBatch], schema: str) -> DataFrame:
        def run(block: pa.Table, heard: pa.Table) -> pa.Table:
            return pa.Table.from_batches([work(_State(block, heard, level, totals, shards, split, priors))])

        return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)

    with _shuffles_removed(spark):
        for level in range(2, order + 1):
            asked = with_answers(level - 1, _State.questions, ASKED)
            answer = _answer_shard(level, priors[min(level, len(priors) - 1)], last=level == order)
            answered = asked.groupBy("shard").applyInArrow(answer, ANSWER)
            answers = keep(answered)
        found = staged(with_answers(order, _State.scores, SCORES))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found.withColumn("train_tokens", F.lit(totals.tokens).cast("long"))
