"""Prefix trie of conversations, its subtree totals worked out by time-forward processing.

Conversations of a family (ids that share ``c - c % 5``) are rebuilt so that they share first turns: the first h turns
of the family's base, then the conversation's own turns after its first h, with h = crc32(decimal id) % 9.  A node is a
distinct sequence of first turns (role and text), known by a chained 128-bit digest; the root is the empty sequence.

Texts become digests and byte counts before anything is shuffled.  Each family is one stream of sorted rows that keeps no
more than the base's first eight turns; nodes are counted with map-side sums, so a common first turn costs one row a task.

Subtree totals: nodes on more than ``top`` conversations form the upper part of the tree, at most
``MOST_TOP`` of them because their members add up to no more than all rows.  What hangs below is cut into shards, one per
highest node outside the upper part.  A shard's nodes are sorted by reverse level order (Spark's external sort) and
streamed; every node takes what its children sent off a priority queue and sends its own totals to its parent through it.
The queue is ordered as the nodes are and spills sorted runs to an unnamed temporary file, so a task's memory
does not grow with its shard.  Totals of shard roots are then summed per parent and the upper part is run the same way.

Null roles and texts are empty.  Rows without a conversation id belong to no conversation and are left out.  Turns are
ordered by number, null first; turns of equal number by their digest, and repeated rows are turns of their own.  A
conversation of no turns is a member of the root.  Very long texts are hashed in the JVM and never leave it; a very long conversation is a
chain in one shard, streamed.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.session import staged

FAMILY, MOST_SHARED = 5, 9
# Members above which a node belongs to the upper part: this many, or what keeps the upper part within MOST_TOP nodes.
LEAST_TOP, MOST_TOP = 100, 10_000
QUEUE_ROWS = 200_000
CHUNK_IDS = 20_000
PATHS = "conv long, depth long, hi long, lo long, phi long, plo long, bytes long, ends boolean"
TOTALS = "hi long, lo long, phi long, plo long, conv long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, is_root boolean"
_NODE = ("ahi", "alo", "depth", "hi", "lo", "phi", "plo", "conv", "n_convs", "own", "children", "leaves", "saved", "is_root")


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from its family's base."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    values = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(values, fields, strict=True)], names=[n for n, _ in fields])


def _flushed(rows: Iterable[tuple], schema: str, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield _columns(part, schema)
            part = []
    yield _columns(part, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _halves(digest: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", digest)


class _Path:
    """One rebuilt conversation; a node is handed out once it is known whether another turn follows."""

    def __init__(self, conv: int):
        self.conv, self.depth, self.key, self.parent, self.size = conv, 0, bytes(16), None, 0

    def node(self, ends: bool) -> tuple:
        parent = _halves(self.parent) if self.parent is not None else (None, None)
        return (self.conv, self.depth, *_halves(self.key), *parent, self.size, ends)

    def step(self, digest: str, size: int) -> tuple:
        before = self.node(ends=False)
        self.parent, self.size, self.depth = self.key, size, self.depth + 1
        self.key = hashlib.blake2b(self.parent + digest.encode(), digest_size=16).digest()
        return before


def _rebuilt(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of every conversation; rows are (family, conv, h, digest, bytes), a family's base first."""
    family, base, path, taken = None, [], None, 0
    for own_family, conv, shared, digest, size in rows:
        if path is None or conv != path.conv:
            if path is not None:
                yield path.node(ends=True)
            if own_family != family:
                family, base = own_family, []
            path, taken = _Path(conv), 0
            if conv != family:
                for turn in base[:shared]:
                    yield path.step(*turn)
        if conv == family:
            if len(base) < MOST_SHARED - 1:
                base.append((digest, size))
            yield path.step(digest, size)
        elif taken >= shared:
            yield path.step(digest, size)
        taken += 1
    if path is not None:
        yield path.node(ends=True)


def paths(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation and depth of its rebuilt form: the node, its parent, the last text's bytes, whether it ends there."""
    said = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.sha2(F.coalesce(F.col(role), F.lit("")).cast("binary"), 256), F.sha2(said.cast("binary"), 256)).cast("binary"), 256)
    conv = F.col(conv_id).cast("long")
    turns = conversations.filter(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("family"), conv.alias("conv"), F.col(turn).alias("turn"), shared_turns(conv).alias("shared"), digest.alias("digest"),
        F.octet_length(said).cast("long").alias("bytes"),
    )
    ordered = turns.repartition("family").sortWithinPartitions("family", F.col("conv") != F.col("family"), "conv", F.asc_nulls_first("turn"), "digest")
    return ordered.select("family", "conv", "shared", "digest", "bytes").mapInArrow(lambda batches: _flushed(_rebuilt(_rows(batches)), PATHS), PATHS)


class SpillingQueue:
    """Smallest tuple of whole numbers first; beyond ``most`` of them, sorted runs go to an unnamed temporary file."""

    def __init__(self, width: int, most: int = QUEUE_ROWS):
        self.kind, self.most, self.heap, self.heads, self.file = struct.Struct(f"<{width}q"), most, [], [], None

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        start = self.file.seek(0, 2)
        while self.heap:
            self.file.write(self.kind.pack(*heapq.heappop(self.heap)))
        self._refill(start, self.file.tell())

    def _refill(self, at: int, end: int) -> None:
        """Next block of the run that lies from ``at`` to ``end``, in reverse so that its smallest is last."""
        if at < end:
            self.file.seek(at)
            block = self.file.read(min(end - at, self.kind.size * 1024))
            items = [self.kind.unpack_from(block, i) for i in range(0, len(block), self.kind.size)][::-1]
            heapq.heappush(self.heads, (items[-1], at, end, items))

    def first(self) -> tuple | None:
        return min((q[0] if q is self.heap else q[0][0] for q in (self.heap, self.heads) if q), default=None)

    def pop(self) -> tuple:
        if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
            return heapq.heappop(self.heap)
        item, at, end, items = heapq.heappop(self.heads)
        items.pop()
        at += self.kind.size
        if items:
            heapq.heappush(self.heads, (items[-1], at, end, items))
        else:
            self._refill(at, end)
        return item

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _forward(rows: Iterator[tuple], most: int) -> Iterator[tuple]:
    """Totals of each node; rows are ``_NODE`` in the order (shard, deepest first, node)."""
    queue = SpillingQueue(7, most)
    try:
        for ahi, alo, depth, hi, lo, phi, plo, conv, n_convs, own, children, leaves, saved, is_root in rows:
            here, saved = (ahi, alo, -depth, hi, lo), saved + own
            while (head := queue.first()) is not None and head[:5] == here:
                *_, below, sent = queue.pop()
                children, leaves, saved = children + 1, leaves + below, saved + sent
            leaves = leaves if children else 1
            if not is_root and phi is not None:
                queue.push((ahi, alo, 1 - depth, phi, plo, leaves, saved))
            yield (hi, lo, phi, plo, conv, depth, n_convs, children, leaves, saved, is_root)
    finally:
        queue.close()


def _totals(nodes: DataFrame, most: int) -> DataFrame:
    ordered = nodes.select(*_NODE).sortWithinPartitions("ahi", "alo", F.desc("depth"), "hi", "lo")
    return ordered.mapInArrow(lambda batches: _flushed(_forward(_rows(batches), most), TOTALS), TOTALS)


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's conversation ids in order.

    Ids are joined in ranges of the sorted rows, so that a node where very many end reaches its task as a few long texts.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[tuple]:
            key, ids = None, []
            for hi, lo, conv in _rows(batches):
                if (hi, lo) != key or len(ids) == CHUNK_IDS:
                    if ids:
                        yield (*key, ids[0], ",".join(map(str, ids)))
                    key, ids = (hi, lo), []
                ids.append(conv)
            if ids:
                yield (*key, ids[0], ",".join(map(str, ids)))

        return _flushed(chunks(), "hi long, lo long, first long, ids string", 64)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            key, state = None, None
            for hi, lo, ids in _rows(batches):
                if (hi, lo) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    yield (*key, state.hexdigest())
                key, state = (hi, lo), hashlib.sha256(ids.encode())
            if key is not None:
                yield (*key, state.hexdigest())

        return _flushed(found(), "hi long, lo long, ends_sha256 string")

    ranges = ends.repartitionByRange("hi", "lo", "conv").sortWithinPartitions("hi", "lo", "conv")
    joined = ranges.mapInArrow(join, "hi long, lo long, first long, ids string")
    ordered = joined.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").select("hi", "lo", "ids")
    return ordered.mapInArrow(digest, "hi long, lo long, ends_sha256 string")


def _same(left: str, right: str) -> Column:
    return F.expr(f"{left}hi = {right}hi AND {left}lo = {right}lo")


def trie(conversations: DataFrame, top: int | None = None, queue_rows: int = QUEUE_ROWS, **columns: str) -> DataFrame:
    """One row per node, see the module; ``top`` sets the members above which a node belongs to the upper part."""
    walked = staged(paths(conversations, **columns))
    nodes = staged(walked.groupBy("hi", "lo", "phi", "plo", "depth", "bytes").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")))
    if top is None:
        top = max(LEAST_TOP, walked.count() // MOST_TOP)
    upper = staged(nodes.filter(F.col("n_convs") > top))  # at most MOST_TOP rows
    keys = F.broadcast(upper.select(F.col("hi").alias("thi"), F.col("lo").alias("tlo")))
    # A path leaves the upper part once, so the first node outside it is the root of the path's shard.
    outside = walked.join(keys, _same("", "t"), "left_anti")
    anchors = outside.groupBy("conv").agg(F.min_by("hi", "depth").alias("ahi"), F.min_by("lo", "depth").alias("alo"))
    own = (F.col("n_convs") - 1) * F.col("bytes")
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    lower = nodes.join(keys, _same("", "t"), "left_anti").join(anchors, "conv")
    lower = lower.select("*", own.alias("own"), *none, (_same("", "a")).alias("is_root")).repartition("ahi", "alo")
    below = staged(_totals(lower, queue_rows))
    sent = below.filter(F.col("is_root") & F.col("phi").isNotNull()).groupBy(F.col("phi").alias("shi"), F.col("plo").alias("slo")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    told = upper.join(sent, _same("", "s"), "left").select(
        "*", F.lit(0).cast("long").alias("ahi"), F.lit(0).cast("long").alias("alo"), own.alias("own"), F.lit(False).alias("is_root")
    ).fillna(0, ["children", "leaves", "saved"])
    above = staged(_totals(told.coalesce(1), queue_rows))
    ends = _end_digests(walked.filter("ends").select("hi", "lo", "conv")).withColumnsRenamed({"hi": "ehi", "lo": "elo"})
    # Parents in the upper part may have very many children and are few; any other parent has no more than ``top``.
    named = [F.col("hi").alias("qhi"), F.col("lo").alias("qlo"), F.col("conv").alias("parent_conv_id")]
    parent = F.expr("phi = qhi AND plo = qlo")
    under = below.filter(F.col("phi").isNotNull())
    highest = above.join(F.broadcast(above.select(*named)), parent, "left")
    hanging = under.filter("is_root").join(F.broadcast(above.select(*named)), parent)
    inner = under.filter("NOT is_root").join(below.select(*named), parent)
    alone = below.filter(F.col("phi").isNull()).select("*", *[F.lit(None).cast("long").alias(c) for c in ("qhi", "qlo", "parent_conv_id")])
    every = highest.unionByName(hanging).unionByName(inner).unionByName(alone).join(ends, _same("", "e"), "left")
    return every.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


# crc32 by its definition, bit by bit; prefixes are spelled out as the digests of their turns.
ORACLE = """
WITH turns AS (
  SELECT conv_id AS c, turn, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS digest, strlen(coalesce(text, ''))::BIGINT AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT c, digest, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos FROM turns
), convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))
  ), 4294967295::BIGINT) % 9 AS h FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT v.c, 0 AS own, p.pos, digest, bytes FROM convs v JOIN placed p ON p.c = v.base WHERE p.pos <= v.h
  UNION ALL
  SELECT v.c, 1, p.pos, digest, bytes FROM convs v JOIN placed p ON p.c = v.c WHERE p.pos > v.h
), prefixes AS (
  SELECT c, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS prefix, bytes,
         row_number() OVER w = count(*) OVER (PARTITION BY c) AS ends
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
), members AS (
  SELECT c, depth, prefix, bytes, ends FROM prefixes
  UNION ALL SELECT c, 0, '', 0, NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.c = v.c) FROM convs v
), nodes AS (
  SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY prefix, depth
), family AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = left(n.prefix, 64 * (n.depth - 1))
  LEFT JOIN (SELECT left(prefix, 64 * (depth - 1)) AS prefix, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2) k
    ON k.prefix = n.prefix AND k.depth = n.depth
), sums AS (
  SELECT left(prefix, 64 * d) AS prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM family) GROUP BY 1
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM family JOIN sums USING (prefix)
"""
