"""SimHash near-duplicates found with covering locality-sensitive hashing.

Each of the ``bits`` positions of a fingerprint gets a vector of radius + 1 bits.  Every non-zero vector v gives a
mask that keeps the positions whose vector has an odd product with v.  Up to ``radius`` vectors of
radius + 1 bits always have some v that is orthogonal to them all, so two fingerprints that differ
in at most ``radius`` positions agree under at least one of the 2^(radius+1) - 1 masks: no pair is
missed, and a mask still keeps about half of the bits.

Equal fingerprints are one row from the start, so copies cost nothing.  ``components_within`` finds
every link of radius 2 without listing pairs: fingerprints that share a bucket with another one are
spread to the 65 centres at distance 1 or less; two fingerprints are within 2 exactly if they share a centre,
and all at one centre are linked to its smallest.  Work is linear in the fingerprints, however large a bucket.

Null and empty texts have fingerprint 0 and are linked like any other.  Null ids are carried along and are never a representative
unless a group has nothing else.  Repeated rows stay.  A very long text is hashed in one task, in memory proportional to it.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.llm.graphs import components
from sluicemark.session import staged

SHINGLE = 3
RADIUS = 2
HASH_SEED = 42
_PART = 1 << 16
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hash of every shingle, repeats included; of all words if there are fewer; of none if there is no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(shingle, len(words))
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
    return np.fromiter((h(joined[a:b], HASH_SEED) for a, b in spans), dtype=np.uint64, count=len(words) - n + 1)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of the same hashes; word 0 is the hash itself."""
    if word == 0:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64(word) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1) -> list[int]:
    """Signed 64-bit words; a bit is 1 if it is set in over half of the hashes."""
    found = []
    for word in range(words):
        set_in = np.zeros((8, 8), dtype=np.int64)
        for at in range(0, len(hashes), _PART):
            octets = _mixed(hashes[at : at + _PART], word).astype(">u8").view(np.uint8).reshape(-1, 8)
            for i in range(8):
                set_in[i] += np.bincount(octets[:, i], minlength=256) @ _BITS_OF_BYTE
        found.append(int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big", signed=True))
    return found


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """(doc, text_key, f0, f1, ...) of every row; ``text_key`` is a hash that tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fingerprint(shingle_hashes(t.as_py(), shingle), words) for t in batch.column(1)]
            arrays = [pa.array([r[i] for r in rows], pa.int64()) for i in range(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], names=["doc", "text_key", *[f"f{i}" for i in range(words)]])

    schema = "doc long, text_key long, " + ", ".join(f"f{i} long" for i in range(words))
    columns = F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key")
    return docs.select(*columns).mapInArrow(run, schema)


def masks(bits: int, radius: int, seed: int = 1) -> list[int]:
    """The covering masks, as signed 64-bit numbers."""
    size = 1 << (radius + 1)
    vectors = 1 + np.random.default_rng(seed).permutation(bits) % (size - 1)
    found = []
    for v in range(1, size):
        kept = sum(1 << i for i, m in enumerate(vectors.tolist()) if (m & v).bit_count() % 2)
        found.append(kept - (1 << 64) if kept >> 63 else kept)
    return found


def _flips() -> Column:
    return F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])


def links_within_two(distinct: DataFrame) -> DataFrame:
    """(f, to) linking all of the distinct fingerprints ``f`` that lie within 2 bits of each other.

    Of the links at one centre only those to its smallest fingerprint are returned; they hold the same together.
    """
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.col("f").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks(64, RADIUS))])
    keyed = distinct.select("f", F.inline(tables))
    shared = keyed.groupBy("table", "key").agg(F.min("f").alias("a"), F.max("f").alias("b")).filter(F.col("a") < F.col("b"))
    close = staged(keyed.join(shared.select("table", "key"), ["table", "key"]).select("f").distinct())
    centres = close.select("f", F.explode(F.transform(_flips(), lambda x: x.bitwiseXOR(F.col("f")))).alias("centre"))
    first = centres.groupBy("centre").agg(F.min("f").alias("to"), F.max("f").alias("last")).filter(F.col("to") < F.col("last"))
    return centres.join(first.select("centre", "to"), "centre").filter(F.col("f") > F.col("to")).select("f", "to").distinct()


def components_within(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, text_key, fingerprint, group, component) of every row; groups are joined by links of up to 2 bits.

    ``component`` is the group's smallest id, null if it has none; ``text_key`` tells texts of one id apart.
    """
    prints = staged(fingerprints(docs, doc_id, text, shingle))
    distinct = staged(prints.groupBy(F.col("f0").alias("f")).agg(F.min("doc").alias("least")))
    groups = components(links_within_two(distinct.select("f")), "f", "to")
    named = distinct.join(groups.withColumnRenamed("node", "f"), "f", "left").withColumn("group", F.coalesce("component", "f"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    final = named.join(least, "group").select(F.col("f").alias("f0"), "group", "component_id")
    return prints.join(final, "f0").select(
        "doc", "text_key", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "group", F.col("component_id").alias("component")
    )
