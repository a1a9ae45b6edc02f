"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rolled) by its place; a text's vector bundles
(adds) those of its n-grams, and a language's prototype bundles the unit vectors of its documents.
The prediction is the prototype with the largest cosine.  What documents of all languages share is
taken off first: the mean of all prototypes is subtracted from prototypes and texts alike.

Learning is one pass whose tasks return one sum per language, so what is gathered is languages times
``dimensions`` numbers; more than ``MOST_LANGUAGES`` distinct labels are an error rather than a
large model on the driver.  Prediction is a map over the documents without a shuffle.  Whole texts
count; a batch is worked on in parts of bounded size, and a long text is summed over its parts.

Text that is null or has no letter is ``und`` with score 0, and teaches nothing; so is every text if
nothing was learned.  Null languages teach nothing.  Ties go to the language that sorts first.  Repeated rows count each time.
An empty table gives no rows.  Other columns are kept by ``predict``; one with the name of a column it adds is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
ORDER = 3
SEED = 7
MOST_LANGUAGES = 10_000
UNKNOWN = "und"
_PART = 1 << 20  # code points worked on at once
_PAIRS = 1 << 21  # entries of a dense count table
_DENSE = 1 << 21  # n-gram numbers told apart by a table; beyond, by sorting
_KINDS = 4096  # n-grams bundled at once


@cache
def _letters() -> np.ndarray:
    """For each code point: itself in lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(4096)  # 4 MB
def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8)
    return bits * 2 - 1


def _gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """One row per n-gram (a row of code points)."""
    found = np.ones((len(grams), dimensions), dtype=np.int8)
    for place in range(grams.shape[1]):
        codes, at = np.unique(grams[:, place], return_inverse=True)
        rolled = np.stack([np.roll(_letter_vector(int(c), dimensions), place) for c in codes])
        found *= rolled[at]
    return found.astype(np.float32)


def _grams(text: str, order: int) -> np.ndarray:
    """Code points of the text's n-grams; a run of other characters is one border, 0."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    framed = np.zeros(len(codes) + 2, dtype=np.uint32)
    framed[1:-1] = codes
    framed = framed[(framed > 0) | np.append(True, framed[:-1] > 0)]
    if len(framed) <= 2:
        return np.zeros((0, order), dtype=np.uint32)
    if len(framed) < order:
        framed = np.concatenate([framed, np.zeros(order - len(framed), dtype=framed.dtype)])
    return np.lib.stride_tricks.sliding_window_view(framed, order)


def bundles(texts: list[str | None], dimensions: int = DIMENSIONS, order: int = ORDER) -> np.ndarray:
    """One row per text, 0 where it has no letter."""
    total = np.zeros((len(texts), dimensions), dtype=np.float32)
    part: list[tuple[int, np.ndarray]] = []  # a text is in it once at most
    size = 0

    def flush() -> None:
        if not part:
            return
        owners = np.repeat(np.arange(len(part), dtype=np.int32), [len(g) for _, g in part])
        alphabet = np.zeros(0x110000, dtype=bool)
        for _, grams in part:
            alphabet[grams[:, 0]] = alphabet[grams[-1]] = True
        letters = np.flatnonzero(alphabet)
        small = np.zeros(0x110000, dtype=np.int32)
        small[letters] = np.arange(len(letters))
        most = len(letters) ** order
        code = np.zeros(len(owners), dtype=np.int32 if most < 1 << 31 else np.int64)
        for place in range(order):
            code *= len(letters)
            code += np.concatenate([small[grams[:, place]] for _, grams in part])
        kinds, code = _compact(code, most)
        spelled = np.stack([letters[kinds // len(letters) ** (order - 1 - p) % len(letters)] for p in range(order)], axis=1)
        rows = np.array([i for i, _ in part])
        for at in range(0, len(kinds), _KINDS):
            vectors = _gram_vectors(spelled[at : at + _KINDS], dimensions)
            inside = (code >= at) & (code < at + len(vectors))
            own, kind = owners[inside], code[inside] - at
            step = max(1, _PAIRS // len(vectors))
            for first in range(0, len(part), step):
                n = min(step, len(part) - first)
                here = slice(*np.searchsorted(own, [first, first + n]))
                counts = np.bincount((own[here] - first) * len(vectors) + kind[here], minlength=n * len(vectors))
                total[rows[first : first + n]] += counts.reshape(n, -1).astype(np.float32) @ vectors
        part.clear()

    for i, text in enumerate(texts):
        found = _grams(text or "", order)
        for at in range(0, len(found), _PART):
            part.append((i, found[at : at + _PART]))
            size += len(part[-1][1])
            if size >= _PART:
                flush()
                size = 0
    flush()
    return total


def _compact(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each value's place among them."""
    if most > _DENSE:
        return np.unique(code, return_inverse=True)
    there = np.zeros(most, dtype=bool)
    there[code] = True
    kinds = np.flatnonzero(there)
    place = np.zeros(most, dtype=np.int32)
    place[kinds] = np.arange(len(kinds), dtype=np.int32)
    return kinds, place[code]


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, order: int = ORDER) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, from every row with a language."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                langs = np.array(rows.column(0).to_pylist(), dtype=object)
                units = _unit(bundles(rows.column(1).to_pylist(), dimensions, order))
                for name in set(langs):
                    own = units[langs == name].sum(axis=0, dtype=np.float64)
                    total[name] = total[name] + own if name in total else own
        kept = {k: v for k, v in total.items() if v.any()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.string()), pa.array(list(kept.values()), pa.list_(pa.float64()))], names=["lang", "bundle"]
        )

    taught = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    parts = taught.mapInArrow(sums, "lang string, bundle array<double>")
    by_place = parts.select("lang", F.posexplode("bundle").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = by_place.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("bundle"))
    found = rows.select("lang", F.col("bundle.value").alias("bundle")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct languages")
    found.sort(key=lambda r: r["lang"])
    if not found:
        return [], np.zeros((0, dimensions), dtype=np.float32)
    return [r["lang"] for r in found], _unit(np.array([r["bundle"] for r in found], dtype=np.float64)).astype(np.float32)


def predict(
    docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", dimensions: int = DIMENSIONS, order: int = ORDER
) -> DataFrame:
    """``docs`` with lang_pred and score, the cosine with the predicted prototype, 0 if it is negative."""
    docs = docs.drop("lang_pred", "score")
    names, prototypes = model
    middle = prototypes.mean(axis=0) if len(names) > 1 else np.zeros(dimensions, dtype=np.float32)
    centred = _unit(prototypes - middle)
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    columns = docs.columns
    at_text = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                units = _unit(bundles(batch.column(at_text).to_pylist(), dimensions, order))
                known = units.any(axis=1) & bool(names)
                cosines = _unit(units - middle) @ centred.T if names else np.zeros((len(units), 1), dtype=np.float32)
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0, 1)
                lang = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                arrays = [*batch.columns, pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3
