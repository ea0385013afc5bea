"""Language identification with a linear-chain conditional random field over words.

Each word of a text has a hidden language; texts may switch between languages.  A
word's potential sums learned weights of its byte bigrams and trigrams, its prefixes
and suffixes of one to three bytes, and, for frequent training words, its lexicon
entry.  Transition weights are learned too, from training sequences in which segments
of different languages follow each other.  Forward-backward gives every word's
marginals; a document's language is the one with the largest sum of marginals, and its
score that sum's share.

Features are computed for all bytes of a batch at once, and forward-backward runs on
all pieces of ``PIECE`` words side by side: each piece's product of transfer matrices
first, then a scan over a document's pieces, then the marginals inside the pieces.  So
a very long text takes no long Python loop.

Training: on a bounded sample, at most about ``rows_per_language`` labelled rows of each
language and ``max_rows`` of all, with at most ``max_chars`` characters each; everything
else covers all rows.  One row a distinct label comes to the driver.

Defined results: a text that is null or has no letter is ``und`` with score 0; a null id
counts as held out; equal texts get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

FOLDS = 5
ROWS_PER_LANGUAGE = 80
MAX_ROWS = 4_000
MAX_CHARS = 20_000
LEXICON = 300
TABLE = 1 << 17
PIECE = 64
STEPS = 20
UNKNOWN = "und"

LETTERS = words.LOWER.copy()
LETTERS[48:58] = 0


@dataclass
class Model:
    languages: list[str]
    pairs: np.ndarray  # 65536 x L: byte bigrams
    hashed: np.ndarray  # TABLE x L: trigrams and affixes
    lexicon: np.ndarray  # sorted hashes of the lexicon's words
    entries: np.ndarray  # lexicon x L
    change: np.ndarray  # L x L: transition scores


@dataclass
class Features:
    """Feature numbers of a block: of each byte of each word, and of each word."""

    begin: np.ndarray  # first byte of each word among the words' bytes
    pair: np.ndarray
    triple: np.ndarray
    affixes: np.ndarray  # words x 6
    key: np.ndarray  # word hashes


def _hash(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return ((x ^ (x >> np.uint32(15))) & np.uint32(TABLE - 1)).astype(np.int32)


def block_features(data: np.ndarray, offsets: np.ndarray) -> tuple[Features, np.ndarray]:
    """Features of all words of the rows, and the rows' offsets among the words."""
    low = LETTERS[data]
    word = low != 0
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner], ends[inner - 1] = word[inner], word[inner - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    row_at = np.searchsorted(s, offsets)
    key = words.hash_words(low, s, e)
    # Only the words' bytes count; a word's neighbours are 0.
    at = np.flatnonzero(word)
    b0 = low[at].astype(np.uint32)
    last = np.zeros(len(at), bool)
    n = e - s
    begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    last[begin + n - 1] = True
    b1 = np.zeros(len(at), np.uint32)
    b1[:-1] = b0[1:]
    b1[last] = 0
    b2 = np.zeros(len(at), np.uint32)
    b2[:-1] = b1[1:]
    b2[last] = 0
    b2[b1 == 0] = 0
    pair = (b0 << np.uint32(8) | b1).astype(np.int32)
    triple = _hash(b0 << np.uint32(16) | b1 << np.uint32(8) | b2)
    affixes = np.empty((len(s), 6), np.int32)
    code_p = np.zeros(len(s), np.uint32)
    code_s = np.zeros(len(s), np.uint32)
    for k in range(3):
        has = n > k
        code_p = code_p << np.uint32(8) | np.where(has, b0[begin + np.minimum(k, n - 1)], 0).astype(np.uint32)
        code_s = code_s << np.uint32(8) | np.where(has, b0[begin + np.maximum(n - 1 - k, 0)], 0).astype(np.uint32)
        affixes[:, k] = _hash(code_p | np.uint32((k + 1) << 24))
        affixes[:, 3 + k] = _hash(code_s | np.uint32((k + 5) << 24))
    return Features(begin, pair, triple, affixes, key), row_at


def _entry(model: Model, key: np.ndarray) -> np.ndarray:
    """Lexicon entry of each word, -1 for none."""
    if not len(model.lexicon):
        return np.full(len(key), -1)
    k = np.minimum(np.searchsorted(model.lexicon, key), len(model.lexicon) - 1)
    return np.where(model.lexicon[k] == key, k, -1)


def emissions(model: Model, f: Features) -> np.ndarray:
    """words x L scores."""
    if not len(f.key):
        return np.zeros((0, len(model.languages)), np.float32)
    out = np.add.reduceat(model.pairs[f.pair] + model.hashed[f.triple], f.begin, axis=0)
    for k in range(f.affixes.shape[1]):
        out += model.hashed[f.affixes[:, k]]
    entry = _entry(model, f.key)
    known = entry >= 0
    out[known] += model.entries[entry[known]]
    return out


def marginals(scores: np.ndarray, at: np.ndarray, change: np.ndarray, transitions: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward of every row at once: words x L marginals.

    To ``transitions``, if given, the expected number of each transition of all rows is
    added: the sum of the exact marginals of neighbouring pairs.
    """
    labels = scores.shape[1]
    total = len(scores)
    if not total:
        return scores
    trans = np.exp(change - change.max())
    count = np.diff(at)
    pieces = -(-count // PIECE)
    first = np.concatenate(([0], np.cumsum(pieces)))
    row = np.repeat(np.arange(len(count)), count)
    local = np.arange(total) - np.repeat(at[:-1], count)
    place = (first[row] + local // PIECE) * PIECE + local % PIECE
    n = int(first[-1])
    e = np.ones((n * PIECE, labels))
    e[place] = np.exp(scores - scores.max(1, keepdims=True))
    real = np.zeros(n * PIECE, bool)
    real[place] = True
    e, real = e.reshape(n, PIECE, labels), real.reshape(n, PIECE)
    # Transfer matrix of each piece; a row's first word has no transition.
    opening = np.zeros(n, bool)
    opening[first[:-1][pieces > 0]] = True
    m = np.broadcast_to(np.eye(labels), (n, labels, labels)).copy()
    for t in range(PIECE):
        step = m.reshape(-1, labels) @ trans
        step = step.reshape(n, labels, labels)
        if not t:
            step[opening] = np.eye(labels)
        step *= e[:, t, None, :]
        step /= step.max((1, 2), keepdims=True)
        on = real[:, t]
        m = step if on.all() else np.where(on[:, None, None], step, m)
    # Scan over the pieces of a row, all rows at once.
    ahead = np.full((n, labels), 1.0 / labels)
    behind = np.ones((n, labels))
    order = np.argsort(-pieces, kind="stable")
    alive = np.searchsorted(-pieces[order], -np.arange(1, int(pieces.max()) + 1), "right")
    for k in range(1, int(pieces.max())):
        p = first[order[: alive[k]]] + k
        a = np.einsum("di,dij->dj", ahead[p - 1], m[p - 1])
        ahead[p] = a / a.sum(1, keepdims=True)
    for k in range(int(pieces.max()) - 1, 0, -1):
        p = first[order[: alive[k]]] + k
        b = np.einsum("dij,dj->di", m[p], behind[p])
        behind[p - 1] = b / b.sum(1, keepdims=True)
    # Inside the pieces.
    forward = np.empty((n, PIECE, labels))
    a = ahead
    for t in range(PIECE):
        step = a @ trans
        if not t:
            step[opening] = 1.0
        step *= e[:, t]
        step /= step.sum(1, keepdims=True)
        a = np.where(real[:, t, None], step, a)
        forward[:, t] = a
    b = behind
    for t in range(PIECE - 1, -1, -1):
        forward[:, t] *= b
        own = e[:, t] * b
        if transitions is not None:
            on = real[:, t] if t else real[:, 0] & ~opening
            pair = (forward[on, t - 1] if t else ahead[on])[:, :, None] * trans * own[on, None, :]
            transitions += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        step = own @ trans.T
        step /= step.sum(1, keepdims=True)
        b = np.where(real[:, t, None], step, b)
    out = forward.reshape(-1, labels)[place]
    return out / out.sum(1, keepdims=True)


def _switched(n: np.ndarray, language: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all rows cut into segments, shuffled and strung into sequences; the words' languages."""
    cuts, label = [], []
    start = 0
    for rows, lang in zip(n, language, strict=True):
        at = 0
        while at < rows:
            size = int(rng.integers(5, 61))
            cuts.append((start + at, start + min(rows, at + size)))
            label.append(lang)
            at += size
        start += int(rows)
    order = rng.permutation(len(cuts))
    place = np.concatenate([np.arange(*cuts[k]) for k in order])
    gold = np.concatenate([np.full(cuts[k][1] - cuts[k][0], label[k]) for k in order])
    return place, gold


def train(texts: list[str], languages: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Fit the field on labelled texts by Adam on the whole sample's log-likelihood."""
    names = sorted(set(languages))
    k = len(names)
    data, offsets = words.text_buffers(pa.array(texts, pa.string()))
    f, at = block_features(data[: offsets[-1]], offsets)
    n = np.diff(at)
    gold_rows = np.array([names.index(x) for x in languages], np.int64)
    # The lexicon: each language's most frequent words.
    lexicon: set[int] = set()
    owner = np.repeat(gold_rows, n)
    for j in range(k):
        keys, times = np.unique(f.key[owner == j], return_counts=True)
        lexicon.update(keys[np.lexsort((keys, -times))[:LEXICON]].tolist())
    model = Model(names, np.zeros((65536, k), np.float32), np.zeros((TABLE, k), np.float32), np.array(sorted(lexicon), np.uint64), np.zeros((len(lexicon), k), np.float32), np.zeros((k, k)))
    if not len(f.key) or k < 2:
        return model
    place, gold = _switched(n, gold_rows, np.random.default_rng(seed))
    back = np.argsort(place)
    length = 2 * PIECE
    seq = np.append(np.arange(0, len(place), length), len(place))
    target = np.zeros((len(gold), k))
    target[np.arange(len(gold)), gold] = 1
    inner = np.ones(len(gold), bool)
    inner[seq[:-1]] = False
    pairs_gold = np.zeros((k, k))
    np.add.at(pairs_gold, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    word_of = np.repeat(np.arange(len(f.begin)), np.diff(np.append(f.begin, len(f.pair))))
    entry = _entry(model, f.key)
    params = [model.pairs, model.hashed, model.entries, model.change]
    moments = [(np.zeros_like(p, np.float64), np.zeros_like(p, np.float64)) for p in params]

    def spread(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(index, values[:, j], size) for j in range(k)], 1)

    for step in range(1, steps + 1):
        expected = np.zeros((k, k))
        post = marginals(emissions(model, f)[place].astype(np.float64), seq, model.change, expected)
        rest = (target - post)[back]  # by word
        byte_rest = rest[word_of]
        known = entry >= 0
        grads = [
            spread(f.pair, byte_rest, 65536),
            spread(f.triple, byte_rest, TABLE) + sum(spread(f.affixes[:, j], rest, TABLE) for j in range(6)),
            spread(entry[known], rest[known], len(model.entries)),
            pairs_gold - expected,
        ]
        for p, g, (m1, m2) in zip(params, grads, moments, strict=True):
            g = g / len(gold) - 1e-6 * p
            m1 += 0.2 * (g - m1)
            m2 += 0.05 * (g * g - m2)
            p += (0.3 * (m1 / (1 - 0.8**step)) / (np.sqrt(m2 / (1 - 0.95**step)) + 1e-8)).astype(p.dtype)
    return model


def held_out(id_col: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(True))


#: Share of the way from chance to certainty that an accepted row's score has come.
ABOVE_CHANCE = 1 / 5


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_language: int = ROWS_PER_LANGUAGE, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> tuple[list[str], list[str]]:
    """A bounded sample of labelled rows outside the held-out fold, as many of each language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull() & (F.length("text") <= max_chars))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    wanted = min(rows_per_language, max_rows / len(counts))
    # One lookup, however many labels there are.
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, wanted / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    sample = sorted((r["text"], r["lang"]) for r in rows.where(draw < share).select("text", "lang").collect())
    return [t for t, _ in sample], [x for _, x in sample]


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all by default), lang_pred and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    carry = docs.columns if carry is None else carry
    schema = T.StructType([*[docs.schema[c] for c in carry], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def has_letter(col: pa.Array, i: int, raw: np.ndarray) -> bool:
        return bool((LETTERS[raw[raw < 128]] != 0).any()) or any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        names = np.array(model.languages or [UNKNOWN], object)
        for batch in batches:
            data, offsets = words.text_buffers(batch.column(text_col))
            for lo, hi in words.row_blocks(offsets, words.BLOCK_BYTES):
                off = offsets[lo : hi + 1] - offsets[lo]
                own = data[offsets[lo] : offsets[hi]]
                best, score = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
                f, at = block_features(own, off)
                n = np.diff(at)
                if len(f.key) and len(model.languages):
                    post = marginals(emissions(model, f).astype(np.float64), at, model.change)
                    sums = np.zeros((hi - lo, post.shape[1]))
                    sums[n > 0] = np.add.reduceat(post, at[:-1][n > 0], axis=0)
                    best = sums.argmax(1)
                    score = sums.max(1) / np.maximum(n, 1)
                ok = np.array([n[i] > 0 and has_letter(batch.column(text_col), i, own[off[i] : off[i + 1]]) for i in range(hi - lo)], bool) & bool(model.languages)
                lang = np.where(ok, names[best], UNKNOWN)
                part = batch.slice(lo, hi - lo)
                columns = [part.column(c) for c in carry]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang.tolist(), pa.string()), pa.array(np.where(ok, np.clip(score, 0, 1), 0.0))], names=schema.names)

    return docs.mapInArrow(words.thrifty(run), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; trained on the rows outside the held-out fold."""
    model = train(*training_sample(docs, id_col, text_col, lang_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return predict(rows, model, "text", ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def least_score(languages: int, above: float = ABOVE_CHANCE) -> float:
    """The score that lies ``above`` of the way from chance, one in ``languages``, to 1."""
    chance = 1 / max(1, languages)
    return chance + above * (1 - chance) - 1e-6  # a single language always scores 1, but for rounding


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", above: float = ABOVE_CHANCE) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with a score of ``least_score`` of the learned languages or more."""
    model = train(*training_sample(docs, id_col, text_col, lang_col))
    names = {"lang_pred": "lang_pred", "score": "score"}
    clash = [c for c in docs.columns if c.lower() in names]
    rows = docs
    for c in clash:  # the result's own names must be free
        rows = rows.withColumnRenamed(c, f"__kept_{c}")
    out = predict(rows, model, f"__kept_{text_col}" if text_col in clash else text_col)
    out = out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score(len(model.languages), above))).drop("lang_pred", "score")
    for c in clash:
        out = out.withColumnRenamed(f"__kept_{c}", c)
    return out
