"""N-gram Jaccard join of a text column with itself: MinHash banding, exact verification.

Plan
    1. One pass hashes words and n-grams, and writes for each row its ``node`` (a
       128-bit hash of the word sequence, so equal word sequences are one node) and
       its band hashes.  Bands and rows a band follow from the target recall.
    2. Shuffle on band hashes.  Of buckets with the same members (near copies share
       many) one is kept.  A bucket's least node is its leader; only the pairs (leader,
       member) become candidates, never all pairs of a bucket.
    3. Candidates are verified on their full n-gram sets: the members of a leader come
       to its text in ``SALTS`` tasks, each holding one copy of it.
    4. Connected components by alternating large-star and small-star steps.
    5. Buckets of more than ``SMALL`` members that still hold more than one component get
       a few rounds of pivots: members outside a bucket's largest component are compared
       with some members of it, which joins most of what belongs together at a linear price.
    6. What then is still apart in a bucket of three or more is compared exactly, across
       components only, in blocks inside tasks that give out at most one link for each
       component that they join.  So no similar pair that shares a bucket stays apart:
       every such pair ends up in one class.
    7. Each class is compared with itself exactly, in blocks inside tasks that give out
       partial counts a node, not pairs: the number of links of each text.  The links
       themselves come from the same blocks, when they are asked for.

Blocks come to the tasks sorted, many in a batch, so small ones cost little.  Nothing is
collected; hot buckets and hot nodes only meet aggregates with partial sums, salted
pieces and blocks of bounded size.

Defined results: null, empty and wordless texts have no n-grams and are in a class
of their own; a text of 1 to n-1 words has one n-gram, all its words; repeated rows
share a class; class ids are the least doc_id of the class (null if all are null).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store, words

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
PIVOTS = 4
ROUNDS = 3
SMALL = 64
#: Tasks that a leader's members are spread over, and those of a bucket.
SALTS = 64
SPREAD = 8
#: Members and bytes of text of a chunk; two chunks make a block.
CHUNK = 256
CHUNK_BYTES = 8_000_000
SLAB = 4096


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows a band): the most selective plan that meets ``recall`` at ``threshold`` within ``max_hashes``."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-hit))) if hit < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _multipliers(n: int) -> np.ndarray:
    return words.mix(np.arange(1, n + 1, dtype=np.uint64) * words.BASE) | np.uint64(1)


def minhashes(grams: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of each row with grams: one row of the result for each such row."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), n), np.uint64)
    if len(starts):
        for k, a in enumerate(_multipliers(n)):
            out[:, k] = np.minimum.reduceat(grams * a, starts)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = words.mix(h * words.BASE + sig[:, b * rows + r])
        out[:, b] = h
    return out.view(np.int64)


def _node_array(k1: np.ndarray, k2: np.ndarray, has: np.ndarray) -> pa.Array:
    raw = np.empty((len(k1), 2), ">u8")
    raw[:, 0], raw[:, 1] = k1, k2
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(k1), [None, pa.py_buffer(raw.tobytes())])
    return pa.compute.if_else(pa.array(has), fixed.cast(pa.binary()), pa.scalar(None, pa.binary()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def with_node(df: DataFrame, text: str, node: str) -> DataFrame:
    """All columns of ``df`` and the 128-bit word-sequence hash of ``text`` (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words.blocks(batch.column(text)):
                k1, k2 = words.sequence_keys(block.words, block.at)
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([*part.columns, _node_array(k1, k2, np.diff(block.at) > 0)], names=[*part.schema.names, node])

    return df.mapInArrow(words.thrifty(run), T.StructType([*df.schema.fields, T.StructField(node, T.BinaryType())]))


def signatures(docs: DataFrame, id_col: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, node, bands) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words.blocks(batch.column(1)):
                k1, k2 = words.sequence_keys(block.words, block.at)
                has = np.diff(block.at) > 0
                grams, at = words.shingles(block.words, block.at, n)
                bh = band_hashes(minhashes(grams, at, bands * rows), bands, rows)
                offsets = np.concatenate(([0], np.cumsum(np.where(has, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), _node_array(k1, k2, has), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bh.ravel()))],
                    names=["doc_id", "node", "bands"],
                )

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(words.thrifty(run), schema)


def _gram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct n-grams of each text."""
    grams: list[np.ndarray] = []
    for b in words.blocks(texts):
        flat, at = words.shingles(b.words, b.at, n)
        grams += [np.unique(flat[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
    return grams


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sets share."""
    both = np.sort(np.concatenate((x, y)), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose full n-gram sets have the wanted Jaccard similarity.

    The text of ``a`` is sent once for each of its salts that occurs, not once for each pair.
    """
    keyed = pairs.select("a", "b", F.pmod(F.xxhash64("b", F.lit(5)), F.lit(SALTS)).cast("int").alias("salt"))
    own = texts.select("node", "text")
    leads = keyed.select("a", "salt").distinct().join(own, F.col("a") == F.col("node")).select("a", "salt", F.lit(None).cast("binary").alias("b"), "text")
    members = keyed.join(own, F.col("b") == F.col("node")).select("a", "salt", "b", "text")
    both = leads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.zeros(0, np.uint64)
        for batch in batches:
            is_lead = np.asarray(batch.column(2).is_null())
            sims = np.full(batch.num_rows, -1.0)
            for lo, hi in words.row_blocks(words.text_buffers(batch.column(3))[1], 2 * words.BLOCK_BYTES):
                for i, grams in enumerate(_gram_sets(batch.column(3).slice(lo, hi - lo), n), lo):
                    if is_lead[i]:
                        lead = grams
                    else:
                        common = _common(lead, grams)
                        sims[i] = common / max(1, len(lead) + len(grams) - common)
            keep = pa.array(sims >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(2).filter(keep), pa.array(sims).filter(keep)], names=["a", "b", "jaccard"])

    return both.mapInArrow(words.thrifty(run), "a binary, b binary, jaccard double")


def _largest(placed: DataFrame, least: int, *more: Column) -> DataFrame:
    """(bucket, members, top) of the buckets of at least ``least`` members with more than one component; ``top`` is the largest one, with aggregates ``more`` over it."""
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"), *more)
    top = F.max(F.struct("size", "root", *[c for c in parts.columns if c not in ("bucket", "root", "size")])).alias("top")
    return parts.groupBy("bucket").agg(F.sum("size").alias("members"), F.count(F.lit(1)).alias("parts"), top).where((F.col("parts") > 1) & (F.col("members") >= least)).drop("parts")


def _of_buckets(placed: DataFrame, buckets: DataFrame, on: Column | None = None) -> DataFrame:
    """Members joined with rows about their buckets; a hot bucket's members meet them in ``SPREAD`` tasks."""
    keyed = placed.withColumn("spread", F.pmod(F.xxhash64("node", F.lit(9)), F.lit(SPREAD)).cast("int"))
    spread = buckets.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    joined = keyed.join(spread, ["bucket", "spread"]).drop("spread")
    return joined if on is None else joined.where(on)


def _pivot_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """For each large bucket of more than one component: its members outside the largest one, with ``PIVOTS`` members of that.

    As many pairs as members times ``PIVOTS`` at most; each turn draws other pivots.
    """
    pivots = [F.min(F.struct(F.xxhash64("node", F.lit(turn * PIVOTS + k)).alias("h"), F.col("node").alias("p"))).alias(f"p{k}") for k in range(PIVOTS)]
    outside = _of_buckets(placed, _largest(placed, SMALL + 1, *pivots), F.col("root") != F.col("top.root"))
    pairs = outside.select("node", F.explode(F.array_distinct(F.array(*[F.col(f"top.p{k}.p") for k in range(PIVOTS)]))).alias("p"))
    return pairs.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


class Block:
    """The rows of one block: one chunk of a group, or two chunks of it with each other."""

    def __init__(self, rows: pa.RecordBatch, grams: list[np.ndarray]):
        self.rows, self.grams = rows, grams
        self.size = np.array([len(g) for g in grams])
        chunk, i, j = (np.asarray(rows.column(c)) for c in ("chunk", "i", "j"))
        self.same = i[0] == j[0]
        self.left, self.right = np.flatnonzero(chunk == i[0]), np.flatnonzero(chunk == j[0])

    def shared(self) -> np.ndarray:
        """How many n-grams each row of the left chunk shares with each of the right one."""
        if len(self.grams) <= 6:
            return np.array([[_common(self.grams[x], self.grams[y]) for y in self.right] for x in self.left], np.int64).reshape(len(self.left), len(self.right))
        _, gram = np.unique(np.concatenate(self.grams), return_inverse=True)
        owner = np.repeat(np.arange(len(self.grams)), self.size)
        out = np.zeros((len(self.left), len(self.right)), np.int64)
        held = np.bincount(gram)
        often = held * 16 > len(self.grams)
        # N-grams of many members: matrix products, exact because no sum reaches 2**24.
        column = np.cumsum(often) - 1
        place = np.flatnonzero(often[gram] & (held[gram] > 1))
        place = place[np.argsort(column[gram[place]], kind="stable")]
        columns = column[gram[place]]
        for lo in range(0, int(often.sum()), SLAB):
            some = slice(*np.searchsorted(columns, (lo, lo + SLAB)))
            has = np.zeros((len(self.grams), SLAB), np.float32)
            has[owner[place[some]], columns[some] - lo] = 1
            out += (has[self.left] @ has[self.right].T).astype(np.int64)
        # The others: the lists of their holders.
        rare = np.flatnonzero(~often[gram] & (held[gram] > 1))
        order = rare[np.argsort(gram[rare], kind="stable")]
        holders, first = owner[order], np.searchsorted(gram[order], np.arange(len(held) + 1))
        at = np.searchsorted(owner[rare], np.arange(len(self.grams) + 1))
        for k, x in enumerate(self.left):
            own = gram[rare[at[x] : at[x + 1]]]
            if len(own):
                out[k] += np.bincount(np.concatenate([holders[first[g] : first[g + 1]] for g in own]), minlength=len(self.grams))[self.right]
        return out

    def links(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers x and y and the similarity of every link; each pair once."""
        shared = self.shared()
        jaccard = shared / np.maximum(1, self.size[self.left][:, None] + self.size[self.right] - shared)
        ok = jaccard >= threshold
        x, y = np.nonzero(np.triu(ok, 1) if self.same else ok)
        return self.left[x], self.right[y], jaccard[x, y]


def _chunks(members: str, size: str) -> Column:
    return F.greatest(F.ceil(F.col(members) / CHUNK), F.ceil(F.col(size) / CHUNK_BYTES), F.lit(1)).cast("int")


def _side_by_side(rows: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """Rows (key, i, j, chunk, node, text and ``carry``), those of a block (key, i, j) next to each other."""
    return rows.select(key, "i", "j", "chunk", "node", "text", *carry).repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node")


def _in_blocks(rows: DataFrame, n: int, each: Callable[[Block], pa.RecordBatch | None], schema: T.StructType) -> DataFrame:
    """``each`` of every block of ``_side_by_side``; a block may reach over several batches."""

    def whole(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = [rows.column(k) for k in range(3)]
        begins = np.flatnonzero(np.concatenate(([True], np.any([np.asarray(pc.not_equal(c[1:], c[:-1])) for c in keys], axis=0))))
        ends = np.append(begins[1:], rows.num_rows)
        # The n-grams of many small blocks at a time, of a large one alone.
        sizes = np.concatenate(([0], np.cumsum(np.asarray(pc.binary_length(rows.column("text")), np.int64))))
        for lo, hi in words.row_blocks(sizes[np.append(begins, rows.num_rows)], 2 * CHUNK_BYTES):
            first, last = begins[lo], ends[hi - 1]
            grams = _gram_sets(rows.column("text").slice(first, last - first), n)
            found = [each(Block(rows.slice(x, y - x), grams[x - first : y - first])) for x, y in zip(begins[lo:hi], ends[lo:hi], strict=True) if y - x > 1]
            yield from (f for f in found if f is not None and f.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(k)[batch.num_rows - 1] for k in range(3)]
            same = np.logical_and.reduce([np.asarray(pc.equal(batch.column(k), last[k])) for k in range(3)])
            begin = int(np.flatnonzero(same)[0])  # of the block that the next batch may continue
            if begin or (waiting and any(waiting[0].column(k)[waiting[0].num_rows - 1] != last[k] for k in range(3))):
                rows = pa.Table.from_batches([*waiting, batch.slice(0, begin)]).combine_chunks().to_batches()
                waiting = []
                for r in rows:
                    yield from whole(r)
            waiting.append(batch.slice(begin))
        for r in pa.Table.from_batches(waiting).combine_chunks().to_batches() if waiting else ():
            yield from whole(r)

    return rows.mapInArrow(words.thrifty(run), schema)


PAIR = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("jaccard", T.DoubleType())])
COUNT = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType())])


def _pairs_of(block: Block, x: np.ndarray, y: np.ndarray, jaccard: np.ndarray) -> pa.RecordBatch:
    """Rows of a block are in the nodes' order, so the lesser row is the lesser node."""
    nodes = block.rows.column("node")
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(np.minimum(x, y))), nodes.take(pa.array(np.maximum(x, y))), pa.array(jaccard)], names=["a", "b", "jaccard"])


def _joining_links(block: Block, threshold: float) -> pa.RecordBatch | None:
    """Links between different components of a block, as few as join what they join: fewer than there are components."""
    root = np.unique(np.array(block.rows.column("root").to_pylist(), object), return_inverse=True)[1]
    if not len(root) or (root == root[0]).all():
        return None
    x, y, jaccard = block.links(threshold)
    across = root[x] != root[y]
    x, y, jaccard = x[across], y[across], jaccard[across]
    _, one = np.unique(np.minimum(root[x], root[y]) * len(root) + np.maximum(root[x], root[y]), return_index=True)  # one of two components is enough
    up = list(range(len(root)))

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    keep = []
    for k in one.tolist():
        a, b = find(int(root[x[k]])), find(int(root[y[k]]))
        if a != b:
            up[a] = b
            keep.append(k)
    return _pairs_of(block, x[keep], y[keep], jaccard[keep])


def _block_links(placed: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links that join the components of a bucket that belong together, found exactly, in blocks.

    A pair across components has a member outside the largest one.  So chunks of outside
    members (0, 1, ...) are compared with each other and with chunks of inside members
    (-1, -2, ...), which are not compared among themselves.  A bucket of one chunk is one
    block; a bucket of two has its only pair verified already.
    """
    some = _of_buckets(placed, _largest(placed, 3).select("bucket", F.col("top.root").alias("top"))).join(texts, "node")
    some = some.select("bucket", "node", "root", "text", (F.col("root") != F.col("top")).alias("outside"))
    size, out = F.octet_length("text"), F.col("outside")
    sizes = some.groupBy("bucket").agg(F.count(F.lit(1)).alias("all_n"), F.sum(size).alias("all_b"), F.count_if(out).alias("out_n"), F.sum(F.when(out, size).otherwise(0)).alias("out_b"))
    sizes = sizes.withColumns({"in_n": F.col("all_n") - F.col("out_n"), "in_b": F.col("all_b") - F.col("out_b")})
    sizes = sizes.select("bucket", _chunks("all_n", "all_b").alias("all"), _chunks("out_n", "out_b").alias("outs"), _chunks("in_n", "in_b").alias("ins"))
    cut = _of_buckets(some, sizes)
    own = F.when(F.col("all") == 1, F.lit(0)).when(F.col("outside"), F.pmod(F.xxhash64("node", F.lit(-2)), F.col("outs"))).otherwise(-1 - F.pmod(F.xxhash64("node", F.lit(-2)), F.col("ins"))).cast("int")
    outs = F.sequence(F.lit(0), F.col("outs") - 1)
    # An outside chunk meets all chunks; an inside one the outside chunks.
    others = F.when(F.col("all") == 1, F.array(F.lit(0))).when(F.col("outside"), F.concat(outs, F.sequence(F.lit(-1), -F.col("ins")))).otherwise(outs)
    cut = cut.withColumn("chunk", own).withColumn("c", F.explode(others))
    # The larger number first: an inside chunk is always the second one.
    rows = cut.withColumns({"i": F.greatest("chunk", "c"), "j": F.least("chunk", "c")})
    return _in_blocks(_side_by_side(rows, "bucket", ["root"]), n, lambda block: _joining_links(block, threshold), PAIR)


def _class_blocks(roots: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """The members of each class of at least ``least`` nodes, in blocks of two chunks."""
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    placed = nodes.join(texts, "node").select("root", "node", "text")
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("text")).alias("bytes")).where(F.col("members") >= least)
    sizes = sizes.select("root", _chunks("members", "bytes").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", F.lit(-2)), F.col("chunks")).cast("int").alias("chunk")
    cut = placed.join(sizes, "root").select("root", "node", "text", chunk, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"))
    return _side_by_side(cut.withColumns({"i": F.greatest("chunk", "c"), "j": F.least("chunk", "c")}), "root", [])


def link_counts(roots: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, n_links) of every node with links: exact, and without a row for each pair."""

    def count(block: Block) -> pa.RecordBatch:
        x, y, _ = block.links(threshold)
        times = np.bincount(np.concatenate((x, y)), minlength=block.rows.num_rows)
        some = np.flatnonzero(times)
        return pa.RecordBatch.from_arrays([block.rows.column("node").take(pa.array(some)), pa.array(times[some])], names=["node", "n"])

    blocks = _in_blocks(_class_blocks(roots, texts, 3), n, count, COUNT)
    # The two nodes of a class of two have the one link that made it.
    two = roots.groupBy("root").agg(F.count(F.lit(1)).alias("others"), F.min("node").alias("node")).where("others = 1")
    two = two.select(F.explode(F.array("root", "node")).alias("node"), F.lit(1).cast("long").alias("n"))
    return blocks.unionByName(two).groupBy("node").agg(F.sum("n").alias("n_links"))


def all_links(roots: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b, jaccard): every link inside a class, each once; as many rows as there are links."""
    return _in_blocks(_class_blocks(roots, texts, 2), n, lambda block: _pairs_of(block, *block.links(threshold)), PAIR)


def connected_components(edges: DataFrame, name: str = "components") -> tuple[DataFrame, list[str]]:
    """(node, root) for every node of the undirected edges (a, b); root is the component's least node.

    Alternating large-star and small-star steps; each round's edges are written to the shared folder.
    """
    spark = edges.sparkSession

    def stars(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b != m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        return moved.union(low.select("a", F.col("m").alias("b"))).distinct()

    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(38,0)))")).first())
    before, paths = None, []
    while True:
        edges, path = store.write_table(stars(edges), name)
        paths.append(path)
        now = mark(edges)
        if now == before:
            break
        before = now
        if len(paths) > 2:
            store.remove(spark, paths.pop(-3))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")), paths


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
) -> tuple[DataFrame, DataFrame]:
    """(membership, links).

    membership: one row for each row of ``docs``: doc_id, node, class_key, class_id, n_links.
    links: the verified pairs of different word sequences: a, b (nodes), jaccard.  All
    pairs of a class are compared, so a group of g near copies can have g squared / 2
    of them; they are made only when the table is read.  ``n_links`` is the number of
    links of the document's text, counted without making them.
    """
    spark = docs.sparkSession
    bands, rows = band_plan(threshold, recall, max_hashes)
    sig, sig_path = store.write_table(signatures(docs, id_col, text_col, n, bands, rows), "signatures")
    member = sig.where(F.col("node").isNotNull()).select(F.explode("bands").alias("bucket"), "node")
    member = member.distinct()
    # Buckets with the same members, told by 128 bits of hashes over them, are one.
    marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"mark{k}") for k in range(2)]
    shared = member.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("top"), F.count(F.lit(1)).alias("members"), *marks).where("lead < top")
    kept = shared.groupBy("lead", "top", "members", "mark0", "mark1").agg(F.min("bucket").alias("bucket")).select("bucket", "lead")
    members, members_path = store.write_table(member.join(kept, "bucket").select("bucket", "lead", "node"), "members")
    star, star_path = store.write_table(members.where("lead < node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "star")

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    needed = members.select("node").distinct()
    texts, _ = store.write_table(with_node(source, "text", "node").where(F.col("node").isNotNull()).join(needed, "node", "left_semi").dropDuplicates(["node"]), "texts")

    links, links_path = store.write_table(_verified(star, texts, n, threshold), "links")
    roots, root_paths = connected_components(links)

    paths = [members_path, star_path, links_path]
    in_bucket = members.select("bucket", "node")
    for turn in range(ROUNDS):
        placed = in_bucket.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs, pairs_path = store.write_table(_pivot_pairs(placed, turn), "pivots")
        more, more_path = store.write_table(_verified(pairs, texts, n, threshold), "links")
        paths += [pairs_path, more_path]
        if more.isEmpty():
            break
        paths += root_paths
        roots, root_paths = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more.select("a", "b")))
    placed = in_bucket.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest, rest_path = store.write_table(_block_links(placed, texts, n, threshold), "links")
    paths.append(rest_path)
    if not rest.isEmpty():
        paths += root_paths
        roots, root_paths = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest.select("a", "b")))

    counts = link_counts(roots, texts, n, threshold)
    per_node = counts.join(roots, "node", "left")
    placed = sig.select("doc_id", "node").join(per_node, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed, _ = store.write_table(placed, "placed")
    store.remove(spark, sig_path, *paths)
    least = placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"))
    member_rows = (
        placed.join(least, "root", "left")
        .withColumn("class_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")))
        .select("doc_id", "node", F.col("root").alias("class_key"), "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )
    return member_rows, all_links(roots, texts, n, threshold)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: the least (doc_id, node), null ids last; of repeated rows, one."""
    node = fresh(docs, "linkmill_node")
    membership, _ = ngram_join(docs, id_col, text_col, **options)
    rows = membership.where(F.col("node").isNotNull()).groupBy("class_key", "doc_id", "node").agg(F.count(F.lit(1)).alias("times"))
    least = rows.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "times")).alias("k"))
    keepers, _ = store.write_table(least.select(F.col("k.doc_id").alias("keep_id"), F.col("k.node").alias("keep_node"), F.col("k.times").alias("keep_times")), "keepers")
    marked = with_node(docs, text_col, node)
    kept = marked.join(keepers, (F.col(node) == F.col("keep_node")) & marked[id_col].eqNullSafe(F.col("keep_id")))
    columns = [marked[c] for c in docs.columns]
    out = kept.where("keep_times = 1").select(*columns)
    if not keepers.where("keep_times > 1").isEmpty():
        out = out.unionByName(kept.where("keep_times > 1").dropDuplicates(["keep_node", "keep_id"]).select(*columns))
    return out.unionByName(marked.where(F.col(node).isNull()).select(*columns))
