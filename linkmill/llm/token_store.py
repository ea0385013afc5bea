"""Token-ID output: one wavelet matrix a shard, in a compressed file with rank and select.

A shard file holds the ids of whole documents, in ascending doc_id order, as succinct
bit-planes: plane b has bit b (from the top) of every id, the ids being stably split by
the planes before it.  Each plane is stored in compressed frames of ``FRAME`` bytes, with
a directory of ones before every 512 bits.  The documents' ids and lengths are in the
file too.  ``WaveletMatrix`` answers access, rank (how often an id stands before a place)
and select (where its k-th occurrence is) from one file, and decompresses only the frames
that an answer touches; ``occurrences`` asks all files for the places of some ids.

Encoding: see ``TokenEncoder``; the ids are the library's own.

The files are binary cells of a Parquet table in the shared folder, because executors
share nothing else that is sure to be writable; ``export`` copies cells to plain files.

Defined results: null text counts as empty and has the end id alone; null ids come
first; rows with equal ids are ordered by text; a document never spans files, so a file
has more than ``SHARD_TOKENS`` ids only where one document has.  A text is worked on
whole, with some 30 bytes of arrays a byte of text.
"""

from __future__ import annotations

import functools
import io
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store, words

SHARD_TOKENS = 1 << 20
END_ID = 1
MAGIC = b"WMX2"
DIRECTORY = 512
FRAME = 8192
CACHE = 400_000
BLOCK = 4_000_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# ---- encoding -------------------------------------------------------------------

#: Below this no characters compose, and all letters but U+0130 have one lower-case letter, below it too.
LATIN = 0x180
WHITE, LETTER, NUMBER, OTHER = range(4)
#: White space as the library sees it, below U+0180.
SPACE = "\t\n\x0b\x0c\r \x85\xa0"
_KIND = np.array([WHITE if c in SPACE else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in map(chr, range(LATIN))], np.uint8)
_BYTE_KIND = np.concatenate((_KIND[:128], np.full(128, OTHER, np.uint8)))
#: U+001C to U+001F, which need care, and the first bytes of characters from U+0180 on.
_IS_ODD = np.zeros(256, bool)
_IS_ODD[0x1C:0x20] = _IS_ODD[0xC6:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Control characters, which byte-level BPE writes with other letters.
CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")
#: The pre-tokenizer's rules that a cut by kinds of characters follows (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable letter of each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]


class _Known:
    """Strings met more than once in a block, and the ids of each in one array.

    They are looked up by Arrow's hash tables, so known strings never become Python
    objects.  Most strings of a block that are new stand in it once; keeping them would
    make the table slow for little.
    """

    def __init__(self) -> None:
        self.strings = pa.array([], pa.large_string())
        self.flat = np.zeros(0, "<u4")
        self.at = np.zeros(1, np.int64)

    def spans(self, asked: pa.Array, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where each string's ids begin and how many they are; ``learn`` gives ids and lengths of unknown strings."""
        found = pc.index_in(asked, self.strings)
        flat, at = self.flat, self.at
        numbers = np.asarray(found.fill_null(0), np.int64)
        if found.null_count:
            unknown = asked.filter(found.is_null()).dictionary_encode()
            index = np.asarray(unknown.indices, np.int64)
            ids, lengths = learn(unknown.dictionary)
            numbers[np.asarray(found.is_null())] = len(self.strings) + index
            flat, at = np.concatenate((flat, ids)), np.concatenate((at, at[-1] + np.cumsum(lengths)))
            often = np.bincount(index) > 1
            if len(self.strings) > CACHE:
                self.__init__()
            self.strings = pa.concat_arrays([self.strings, unknown.dictionary.filter(pa.array(often))])
            self.flat = np.concatenate((self.flat, ids[np.repeat(often, lengths)]))
            self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(lengths[often])))
        return flat, at[numbers], np.diff(at)[numbers]


def pre_tokens(low: np.ndarray, offsets: np.ndarray, skipped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pre-tokens of rows of ASCII-lowered UTF-8 begin and end, by ``SPLIT``, and which bytes are theirs; ``skipped`` rows have none."""
    n = len(low)
    kind = _BYTE_KIND[low]
    two = np.flatnonzero(low >= 0xC2)
    two = two[low[two] < 0xC6]
    kind[two] = kind[two + 1] = _KIND[(low[two].astype(np.int64) & 0x1F) << 6 | low[two + 1] & 0x3F]
    for r in skipped:
        kind[offsets[r] : offsets[r + 1]] = WHITE
    row = np.zeros(n + 1, bool)
    row[offsets] = True
    starts = row[:n].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    apostrophes = np.flatnonzero(starts & (low == ord("'")))
    starts |= (kind == NUMBER) & ((low & 0xC0) != 0x80)
    starts &= kind != WHITE
    # An apostrophe that begins a run takes an ending with it; what follows the ending begins anew.
    apostrophes = apostrophes[apostrophes + 1 < n]
    apostrophes = apostrophes[~row[apostrophes + 1]]
    second = np.minimum(apostrophes + 2, n - 1)
    pair = np.where((apostrophes + 2 < n) & ~row[np.minimum(apostrophes + 2, n)], low[second], 0)
    for ending in ENDINGS:
        ok = low[apostrophes + 1] == ord(ending[0])
        if len(ending) == 2:
            ok &= pair == ord(ending[1])
        at = apostrophes[ok]
        starts[at + 1] = False
        after = at + 1 + len(ending)
        after = after[after < n]
        starts[after] |= kind[after] == LETTER
    kept = kind != WHITE
    ends = kept.copy()
    ends[:-1] &= (kind[1:] == WHITE) | starts[1:]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1, kept


class TokenEncoder:
    """Encodes texts by their distinct pre-tokens.

    Below U+0180 the vocabulary's normaliser only lower-cases single characters and joins
    white space, and its pre-tokens follow from the kinds of characters.  So pre-tokens
    are found among a block's bytes, each distinct one is encoded once by the library's
    model, and a text's ids are gathered from them.  The model marks each pre-token's last
    id as a word end, which shows where its ids stop.  Texts with characters from U+0180
    on, unusual separators, or special
    tokens go through the library whole.  About ``CACHE`` pre-tokens are kept
    at most.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError("the vocabulary cuts by other rules")
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(spec))
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.letters = _byte_letters() | {10: "\n"}
        self.known = _Known()

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of distinct pre-tokens, by the library's model in one call."""
        text = "\n".join(new.to_pylist())
        if not text.isascii() or CONTROL.search(text):
            text = text.lower().encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the vocabulary doesn't mark word ends")
        return ids, np.diff(ends, prepend=0)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of UTF-8 ``data``, the end id after each, and how many each row has."""
        rows = len(offsets) - 1
        odd = _IS_ODD[data]
        for first, second in (b"<|", b"\xc4\xb0"):  # special tokens; U+0130
            at = np.flatnonzero(data[:-1] == first)
            odd[at[data[at + 1] == second]] = True
        odd_rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)
        low = _LOWER[data]
        begin, end, kept = pre_tokens(low, offsets, odd_rows)
        at = np.concatenate(([0], np.cumsum(end - begin)))
        tokens = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(low[kept]))
        flat, starts, lengths = self.known.spans(tokens, self._learn)
        # Each row's tail: the end id, or all ids of a row that goes through the library whole.
        flat = np.append(flat, np.uint32(END_ID))
        tail, tail_length = np.full(rows, len(flat) - 1), np.ones(rows, np.int64)
        if len(odd_rows):
            texts = [data[offsets[r] : offsets[r + 1]].tobytes().decode() for r in odd_rows]
            whole = [np.array([*e.ids, END_ID], "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            tail_length[odd_rows] = [len(w) for w in whole]
            tail[odd_rows] = len(flat) + np.cumsum(tail_length[odd_rows]) - tail_length[odd_rows]
            flat = np.concatenate((flat, *whole))
        row_end = np.searchsorted(begin, offsets[1:])
        starts = np.insert(starts, row_end, tail)
        lengths = np.insert(lengths, row_end, tail_length)
        stops = np.cumsum(lengths)[row_end + np.arange(rows)]
        return gather(flat, starts, lengths), np.diff(stops, prepend=0)

    def blocks(self, col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, rows, ids, lengths) of all blocks of a string column; null counts as empty."""
        data, offsets = words.text_buffers(col)
        for lo, hi in words.row_blocks(offsets, BLOCK):
            yield lo, hi - lo, *self.block(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text, the end id appended."""
        return [x for _, _, ids, lengths in self.blocks(pa.array(texts, pa.string())) for x in np.split(ids, np.cumsum(lengths)[:-1])]


# ---- files ----------------------------------------------------------------------


def build_file(ids: np.ndarray, lengths: np.ndarray, owners: pa.Array | None = None) -> bytes:
    """The shard file of the documents' ids, one after the other; ``lengths``: ids of each document; ``owners``: their doc_ids."""
    levels = max(1, (int(ids.max()) if len(ids) else 0).bit_length())
    a = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    compress = zstandard.ZstdCompressor(level=1).compress
    named = io.BytesIO()
    owners = pa.nulls(len(lengths), pa.int64()) if owners is None else owners
    with pa.ipc.new_stream(named, pa.schema([("doc_id", owners.type)])) as w:
        w.write_batch(pa.record_batch([owners], ["doc_id"]))
    sections, zeros = [compress(np.asarray(lengths, "<u8").tobytes()), compress(named.getvalue())], []
    for b in range(levels - 1, -1, -1):
        bit = (a & a.dtype.type(1 << b)) != 0
        plane = np.zeros(-(-len(bit) // DIRECTORY) * (DIRECTORY // 8), np.uint8)
        plane[: -(-len(bit) // 8)] = np.packbits(bit)
        ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, DIRECTORY // 64).sum(1, dtype=np.int64)
        zeros.append(len(bit) - int(ones.sum()))
        sections.append(compress(np.concatenate(([0], np.cumsum(ones))).astype("<u8").tobytes()))
        raw = plane.tobytes()
        sections += [compress(raw[i : i + FRAME]) for i in range(0, len(raw), FRAME)]
        if b:
            split = np.empty_like(a)
            np.compress(~bit, a, out=split[: zeros[-1]])
            np.compress(bit, a, out=split[zeros[-1] :])
            a = split
    head = [struct.pack("<BQQ", levels, len(ids), len(lengths)), np.array(zeros, "<u8").tobytes(), np.array([len(s) for s in sections], "<u8").tobytes()]
    return b"".join([MAGIC, *head, *sections])


class WaveletMatrix:
    """One shard file: the ids' number, its documents and their lengths, and queries on the ids.

    Opening reads the header alone; frames and directories are decompressed when first asked for.
    """

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        self.levels, self.n, self.documents = struct.unpack_from("<BQQ", data, 4)
        plane = -(-self.n // DIRECTORY) * (DIRECTORY // 8)
        self.frames = -(-plane // FRAME)
        at = 4 + 17
        self.zeros = np.frombuffer(data, "<u8", self.levels, at).tolist()
        at += 8 * self.levels
        count = 2 + self.levels * (1 + self.frames)
        sizes = np.frombuffer(data, "<u8", count, at).astype(np.int64)
        self.begin = np.concatenate(([0], np.cumsum(sizes))) + at + 8 * count
        if self.begin[-1] != len(data):
            raise ValueError("truncated shard file")
        self.data = data
        self.decompress = zstandard.ZstdDecompressor().decompress
        self.read: dict[int, np.ndarray] = {}

    def _section(self, k: int) -> bytes:
        return self.decompress(self.data[self.begin[k] : self.begin[k + 1]])

    @property
    def lengths(self) -> np.ndarray:
        return np.frombuffer(self._section(0), "<u8").astype(np.int64)

    @property
    def owners(self) -> pa.Array:
        """doc_ids, in file order."""
        return pa.ipc.open_stream(self._section(1)).read_all().column(0).combine_chunks()

    def _ones(self, level: int) -> np.ndarray:
        k = 2 + level * (1 + self.frames)
        if k not in self.read:
            self.read[k] = np.frombuffer(self._section(k), "<u8").astype(np.int64)
        return self.read[k]

    def _cell(self, level: int, cell: int) -> np.ndarray:
        """The bits of one directory cell."""
        frame, inside = divmod(cell * (DIRECTORY // 8), FRAME)
        k = 2 + level * (1 + self.frames) + 1 + frame
        if k not in self.read:
            self.read[k] = np.frombuffer(self._section(k), np.uint8)
        return np.unpackbits(self.read[k][inside : inside + DIRECTORY // 8])

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before place i."""
        cell, rest = divmod(i, DIRECTORY)
        return int(self._ones(level)[cell]) + (int(self._cell(level, cell)[:rest].sum()) if rest else 0)

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit = int(self._cell(level, i // DIRECTORY)[i % DIRECTORY])
            one = self._rank1(level, i)
            i = self.zeros[level] + one if bit else i - one
            value = value << 1 | bit
        return value

    def _range(self, symbol: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``symbol`` before place i stand below the last plane."""
        lo, hi = 0, min(i, self.n)
        for level in range(self.levels):
            if lo == hi:
                break
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if symbol >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` stands before place i."""
        if symbol >> self.levels or i <= 0:
            return 0
        lo, hi = self._range(symbol, i)
        return hi - lo

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) zero or one of a plane."""
        ones = self._ones(level)
        before = ones if bit else np.minimum(np.arange(len(ones)) * DIRECTORY, self.n) - ones
        cell = int(np.searchsorted(before, k, "right")) - 1
        bits = self._cell(level, cell)[: self.n - cell * DIRECTORY]
        return cell * DIRECTORY + int(np.flatnonzero(bits == bit)[k - int(before[cell])])

    def select(self, symbol: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of ``symbol``."""
        lo, hi = (0, 0) if symbol >> self.levels else self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(self.levels - 1, -1, -1):
            bit = symbol >> (self.levels - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, in order."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            k = 2 + level * (1 + self.frames) + 1
            plane = np.frombuffer(b"".join(map(self._section, range(k, k + self.frames))), np.uint8)
            bit = np.unpackbits(plane, count=self.n).view(bool)
            before = np.empty_like(a)
            before[np.flatnonzero(~bit)] = a[: self.zeros[level]]
            before[np.flatnonzero(bit)] = a[self.zeros[level] :]
            before |= bit.astype(kind) << kind(self.levels - 1 - level)
            a = before
        return a.astype(np.uint32)


@functools.cache
def encoder_of(path: str) -> TokenEncoder:
    """One encoder a worker process: a task's function travels by value, so what it keeps must be in a function of this module."""
    return TokenEncoder(path)


def write_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` in ascending id order and write the shard files to the Parquet table ``path``."""
    tokenizer = tokenizer or tokenizer_path()
    names = ["part", "seq", "n_tokens", "file"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer)
        part, seq, n = TaskContext.get().partitionId(), 0, 0
        waiting: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, n
            ids, lengths, owners = zip(*waiting, strict=True)
            file = build_file(np.concatenate(ids), np.concatenate(lengths), pa.concat_arrays(owners))
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([n], pa.int64()), pa.array([file], pa.binary())], names=names)
            waiting.clear()
            seq, n = seq + 1, 0
            return row

        for batch in batches:
            for first, rows, ids, lengths in encoder.blocks(batch.column(1)):
                at = np.concatenate(([0], np.cumsum(lengths)))
                lo = 0
                while lo < rows:
                    hi = int(np.searchsorted(at, at[lo] + shard_tokens - n, "right")) - 1
                    if hi <= lo and waiting:
                        yield flush()
                        continue
                    hi = max(hi, lo + 1)
                    waiting.append((ids[at[lo] : at[hi]], lengths[lo:hi], batch.column(0).slice(first + lo, hi - lo)))
                    n += int(at[hi] - at[lo])
                    lo = hi
        if waiting:
            yield flush()

    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("file", T.BinaryType())])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    n = store.partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
    ordered.select("doc_id", "text").mapInArrow(words.thrifty(run), schema).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_files(files: DataFrame, id_type: T.DataType | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone; ``id_type``: the type of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                wm = WaveletMatrix(batch.column(2)[r].as_py())
                raw = memoryview(wm.decode().astype("<u4")).cast("B")
                lengths = wm.lengths
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                own = pa.array([r] * len(crc), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), wm.owners, pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())], names=schema.names)

    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()), T.StructField("doc_id", id_type or T.LongType()), T.StructField("inside", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    rows = files.select("part", "seq", "file").mapInArrow(words.thrifty(run), schema)
    # The global order: parts, one row each, then the files inside a part.
    sizes = files.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).withColumn("before", F.sum("all").over(W.orderBy("part")) - F.col("all"))
    inside = sizes.withColumn("within", F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).drop("n_tokens")
    starts = inside.join(parts.select("part", "before"), "part").select("part", "seq", (F.col("before") + F.col("within")).alias("at"))
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(files: DataFrame, ids: list[int], id_type: T.DataType | None = None) -> DataFrame:
    """(id, doc_id, place) of every occurrence of some ids, by rank and select; place counts from the document's first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                wm = WaveletMatrix(file.as_py())
                starts = np.cumsum(wm.lengths) - wm.lengths
                owners = wm.owners
                for symbol in dict.fromkeys(ids):
                    places = np.array([wm.select(symbol, k) for k in range(wm.rank(symbol, wm.n))], np.int64)
                    document = np.searchsorted(starts, places, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), symbol, np.int64)), owners.take(pa.array(document)), pa.array(places - starts[document])], names=["id", "doc_id", "place"])

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("doc_id", id_type or T.LongType()), T.StructField("place", T.LongType())])
    return files.select("file").mapInArrow(words.thrifty(run), schema)


def token_output(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Write the shard files and return what they hold, one row a document."""
    spark = docs.sparkSession
    path = path or store.new_path(spark, "tokens")
    write_files(docs, path, id_col, text_col, tokenizer)
    return read_files(spark.read.parquet(path), docs.schema[id_col].dataType)


def export(files: DataFrame, folder: str) -> int:
    """Copy the shard files to ``folder`` as part-seq.wmx, one at a time; the number of files."""
    from pathlib import Path

    n = 0
    for row in files.select("part", "seq", "file").toLocalIterator():
        (Path(folder) / f"{row['part']:05d}-{row['seq']:08d}.wmx").write_bytes(bytes(row["file"]))
        n += 1
    return n
