"""Benchmark decontamination: size-partitioned MinHash containment search.

The query side is the benchmark, a stated query set.  Its items are partitioned by
their number of shingles into classes [2**c, 2**(c+1)).  A document's shingles are cut
into blocks; for class c, windows of two neighbouring blocks of 2**(c+1) shingles each
get a MinHash sketch (one permutation, ``BINS`` bins), so a window is never more than
about four times as large as the items that it is compared with, however long the
document is.  Sketches of larger classes are minima of those of smaller ones.  A window
and an item that agree in one bin make a candidate (document, item), and the candidate
is verified by the exact containment of the item's shingles in the whole document.

Items of fewer than 16 shingles have too few for a sketch that is sure to be met: they
are looked up exactly, by so many of their shingles that none contained to the wanted
share can lack all of them.  For larger ones all bins must miss, which was never met in
tests (see README).

One pass over the documents, no shuffle.  The index is built from blocks of the
benchmark of at most about ``max_block_words`` words: a larger benchmark takes several
passes, one a block, so what is shipped to the workers never grows with the input.

Defined results: null, empty and wordless texts match nothing, on either side; an item
of 1 to 4 words is one shingle of its own width; repeated rows give repeated results.  A
text is worked on whole, with about 10 bytes of arrays a byte of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

NGRAM = 5
CONTAINMENT = 0.8
BINS = 128
MAX_BLOCK_WORDS = 2_000_000
SMALLEST = 4  # class of 16 to 31 shingles; smaller items are looked up exactly


@dataclass
class _Index:
    """The items of one shingle width."""

    width: int
    ids: list
    grams: list[np.ndarray]
    small: tuple[np.ndarray, np.ndarray, np.ndarray] | None  # of items below the smallest class: sorted shingles, their items, filter bits
    classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # class: sorted bin minima, their items, filter bits


def _bits(keys: np.ndarray) -> np.ndarray:
    size = 1 << min(24, max(12, math.ceil(math.log2(64 * len(keys) + 1))))
    bits = np.zeros(size, bool)
    bits[(keys & np.uint64(size - 1)).astype(np.int64)] = True
    return bits


def _bin_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - int(math.log2(BINS)))).astype(np.int64)


def _sorted(found: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, the item of each, and the keys' filter bits."""
    keys = np.concatenate([x for x, _ in found])
    items = np.concatenate([np.full(len(x), k) for x, k in found])
    order = np.argsort(keys, kind="stable")
    return keys[order], items[order], _bits(keys)


def build_index(ids: list, texts: list[str | None], n: int = NGRAM, containment: float = CONTAINMENT) -> list[_Index]:
    by_width: dict[int, list[tuple[object, np.ndarray]]] = {}
    col = pa.array(texts, pa.string())
    for block in words.blocks(col):
        for i in range(block.rows):
            w = block.words[block.at[i] : block.at[i + 1]]
            if len(w):
                grams, _ = words.shingles(w, np.array([0, len(w)]), width := min(n, len(w)))
                by_width.setdefault(width, []).append((ids[block.first + i], np.unique(grams)))
    out = []
    for width, items in sorted(by_width.items()):
        sketches: dict[int, list[tuple[np.ndarray, int]]] = {}
        small: list[tuple[np.ndarray, int]] = []
        for k, (_, grams) in enumerate(items):
            c = len(grams).bit_length() - 1
            if c < SMALLEST:
                small.append((grams[: len(grams) - math.ceil(containment * len(grams) - 1e-9) + 1], k))
                continue
            least = np.full(BINS, ~np.uint64(0))
            np.minimum.at(least, _bin_of(grams), grams)
            sketches.setdefault(c, []).append((least[least != ~np.uint64(0)], k))
        out.append(_Index(width, [x for x, _ in items], [g for _, g in items], _sorted(small) if small else None, {c: _sorted(found) for c, found in sorted(sketches.items())}))
    return out


def _merged(least: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of twice as large blocks: neighbours 0+1, 2+3, ... of each document."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1))
    local = np.arange(len(doc)) - np.repeat(first, np.diff(np.concatenate((first, [len(doc)]))))
    starts = np.flatnonzero(local % 2 == 0)
    return np.minimum.reduceat(least, starts, axis=0), doc[starts]


def _met(flat: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Places of ``flat`` whose value is a key, with the key's items."""
    keys, items, bits = table
    hit = np.flatnonzero(bits[(flat & np.uint64(len(bits) - 1)).astype(np.int64)] & (flat != ~np.uint64(0)))
    if len(hit):
        lo, hi = np.searchsorted(keys, flat[hit], "left"), np.searchsorted(keys, flat[hit], "right")
        for x in np.flatnonzero(lo < hi):
            yield int(hit[x]), items[lo[x] : hi[x]]


def candidates(index: _Index, grams: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
    """(row, item) pairs of which a window's sketch meets the item's, or a shingle a small item's."""
    found: set[tuple[int, int]] = set()
    if not len(grams):
        return found
    if index.small:
        for place, items in _met(grams, index.small):
            row = int(np.searchsorted(at, place, "right")) - 1
            found.update((row, int(k)) for k in items)
    if not index.classes:
        return found
    step = 1 << (SMALLEST + 1)
    count = np.diff(at)
    blocks = -(-count // step)
    first_block = np.concatenate(([0], np.cumsum(blocks)))
    block = (np.arange(len(grams)) - np.repeat(at[:-1], count)) // step + np.repeat(first_block[:-1], count)
    least = np.full((int(first_block[-1]), BINS), ~np.uint64(0))
    np.minimum.at(least.reshape(-1), block * BINS + _bin_of(grams), grams)
    doc = np.repeat(np.arange(len(count)), blocks)
    for c in range(SMALLEST, max(index.classes) + 1):
        if c > SMALLEST:
            least, doc = _merged(least, doc)
        if c not in index.classes:
            continue
        window = least.copy()
        if len(doc) > 1:
            same = doc[1:] == doc[:-1]
            window[:-1][same] = np.minimum(least[:-1][same], least[1:][same])
        for place, items in _met(window.reshape(-1), index.classes[c]):
            found.update((int(doc[place // BINS]), int(k)) for k in items)
    return found


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    n: int = NGRAM,
    max_block_words: int = MAX_BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment) for every document row and item found in it."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / max_block_words))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", items.schema["item_id"].dataType),
        T.StructField("item_shingles", T.LongType()), T.StructField("shared", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item_type = pa.int64() if isinstance(items.schema["item_id"].dataType, T.LongType) else None
    out = None
    for k in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else items
        rows = part.collect()  # at most about max_block_words words
        shipped = spark.sparkContext.broadcast(build_index([r["item_id"] for r in rows], [r["text"] for r in rows], n, containment))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            indexes = shipped.value
            for batch in batches:
                hits: list[tuple[int, object, int, int]] = []
                for block in words.blocks(batch.column(1)):
                    for index in indexes:
                        grams, at = words.shingles(block.words, block.at, index.width)
                        for row, item in sorted(candidates(index, grams, at)):
                            wanted = index.grams[item]
                            shared = int(np.isin(wanted, grams[at[row] : at[row + 1]]).sum())
                            if shared >= containment * len(wanted):
                                hits.append((block.first + row, index.ids[item], len(wanted), shared))
                if hits:
                    row, item, size, shared = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), pa.array(item, item_type), pa.array(size, pa.int64()), pa.array(shared, pa.int64()), pa.array(np.array(shared) / np.array(size))],
                        names=schema.names,
                    )

        found = source.mapInArrow(words.thrifty(run), schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.

    The rows are dropped by a key over id and text, so a clean row that shares its id
    with a leaking one stays.
    """
    from . import store
    from .ngram_join import fresh

    key = fresh(docs, "linkmill_key")
    keyed = docs.withColumn(key, F.sha2(F.concat_ws("\x1f", F.col(id_col).cast("string"), F.col(text_col)), 256))
    leaks, _ = store.write_table(contamination(keyed, benchmark, key, text_col, **options).select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").select(*[keyed[c] for c in docs.columns])
