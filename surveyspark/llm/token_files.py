"""Token-ID files: one shared zstandard dictionary, one frame per document, an offset index.

A file is a Parquet table that Spark writes (so it works on any store and a retried task cannot
leave half a file). Each row is a shard of at most ``shard_bytes`` of frames, in the format

    magic ``b"TIDS"`` | version u32 | dictionary hash u64 | documents u32 | payload bytes u64
    index: documents x (doc_id i64, has_id u8 padded to u64, start in part u64, n_tokens u64, offset u64)
    payload: one zstandard frame per document, made with the shared dictionary

so any document can be read alone by its offset. Beside the shards lie the dictionary and the
parts' first positions (one row per written partition).

Cases: a null text is an empty one (it still gets the end id); an empty table gives empty files;
rows repeat as they are given; a null doc_id sorts first; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import struct
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyspark.llm.common import batch_of, id_and_text, slices, small_batches, stored
from surveyspark.session import scratch_path

HEAD, ENTRY = "<4sIQIQ", np.dtype([("doc_id", "<i8"), ("has_id", "<u8"), ("start", "<u8"), ("n", "<u8"), ("offset", "<u8")])
MAGIC, VERSION = b"TIDS", 1
#: Words of small letters (ASCII or Latin-1, in UTF-8) that normalisation leaves as they are.
_SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

#: Bytes of a word that is kept at most: with the number of words this bounds the memory.
LONGEST = 64
#: Bytes of text that are cut into words, and whose words are told apart, at a time.
BLOCK_BYTES, CHUNK_BYTES = 1 << 18, 4 << 20
#: New words that the library encodes in one call.
RUN_WORDS = 300


def little_endian(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers; an array is made faster than one of numpy for the few ids of a word."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


def _among(codes) -> np.ndarray:
    return np.isin(np.arange(256), list(codes))


_A_TO_Z, _MARKS = _among(range(0x61, 0x7B)), _among(b".,;:!?#$%&*")
#: Second bytes (in UTF-8) of the small Latin-1 letters, and of all Latin-1 letters.
_SMALL_LATIN, _LATIN = _among({*range(0x9F, 0xC0)} - {0xB7}), _among({*range(0x80, 0xC0)} - {0x97, 0xB7})


def _cuts(letters: np.ndarray) -> np.ndarray:
    """Places of marks that follow a letter (a-z, or of Latin-1): the pre-tokenizer always cuts there."""
    at = np.flatnonzero(_MARKS[letters])
    before = letters[at - 1]
    return at[(at > 0) & (_A_TO_Z[before] | (_LATIN[before] & (letters[at - 2] == 0xC3) & (at > 1)))]


def _small(words: pa.Array) -> list[bool]:
    """Of each word: whether it is of small letters (what _SMALL tells) and not longer than LONGEST."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[: len(words) + 1]
    letters = np.frombuffer(data, dtype=np.uint8)[: offsets[-1]]
    odd = ~_A_TO_Z[letters]
    first = np.flatnonzero(odd[:-1] & (letters[:-1] == 0xC3) & _SMALL_LATIN[letters[1:]])
    odd[first] = odd[first + 1] = False
    return (~np.logical_or.reduceat(odd, offsets[:-1]) & (np.diff(offsets) <= LONGEST)).tolist() if len(words) else []


def _cut_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of texts (runs of bytes but space and line feed, cut at ``_cuts`` where no special token may stand): end to end, their sizes, and the first of each text."""
    letters, ends = np.frombuffer(b" ".join(texts), dtype=np.uint8), np.cumsum([0, *(len(t) + 1 for t in texts)])
    gap = (letters == 32) | (letters == 10)
    edges, cuts = np.flatnonzero(np.diff(gap, prepend=True, append=True)), _cuts(letters)  # edges: starts and stops in turn
    uncut = np.array([b"<|" in t for t in texts], dtype=bool)
    if uncut.any():
        cuts = cuts[~uncut[np.searchsorted(ends, cuts, side="right") - 1]]
    starts, stops = (np.sort(np.concatenate((x, cuts)), kind="stable") for x in (edges[::2], edges[1::2]))
    return letters[~gap].tobytes(), (stops - starts).astype(np.int32), np.searchsorted(starts, ends[:-1])


class WordEncoder(dict):
    """Token ids of texts (UTF-8) by the tokenizers library, word by word: a dict from words to ids.

    The pre-tokenizer drops white space and never joins across it, and normalisation (NFC, lower
    case) does not reach across a space, so a text's ids are its words' ids in turn. For the same reason
    A-Z may be lower-cased and a mark that follows a letter cut off, but in texts that may hold
    a special token. Each distinct word of some texts is looked up once; those first met are encoded by the
    library, words of small letters all at once, and kept; beyond ``limit`` words only
    those that are met again stay. Words of more than LONGEST bytes are encoded each time.
    """

    def __init__(self, path: str, limit: int = 100_000):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit, self.before = Tokenizer.from_file(path), limit, {}
        self.normal, self.split, self.model = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize
        # how the pre-tokenizer writes the small Latin-1 letters (by their bytes, or as they are)
        self.written = str.maketrans({c: "".join(piece for piece, _ in self.split(c)) for c in map(chr, range(0xDF, 0x100)) if c.isalpha()})
        # the same model behind a mere split at spaces; its ids show where words end, if the last ones bear a suffix
        suffix, self.bare = self.tokenizer.model.end_of_word_suffix, Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        by_byte = {chr(c).encode().decode("latin-1"): to for c, to in self.written.items()}
        self.at_once = bool(suffix) and all(len(to) == 2 and to[0] == "\xc3" for to in by_byte.values())
        self.second = [(byte[1], to[1]) for byte, to in by_byte.items() if byte != to]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = little_endian(self._ids(word))
            if len(word) > LONGEST:
                return ids
        self[word] = ids
        return ids

    def _ids(self, word: bytes) -> list[int]:
        if _SMALL.fullmatch(word):  # one piece, as it is
            return [t.id for t in self.model(word.decode() if word.isascii() else word.decode().translate(self.written))]
        if b"<|" in word:
            return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return [t.id for piece, _ in self.split(self.normal(word.decode())) for t in self.model(piece)]

    def _look_up(self, words: pa.Array) -> list[bytes]:
        """The ids of distinct words."""
        names, small, before = words.to_numpy(zero_copy_only=False).tolist(), _small(words), self.before
        out, new = list(map(self.get, names)), []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            word = names[k]
            ids = before.get(word)
            if ids is not None:
                out[k] = self[word] = ids
            elif small[k] and self.at_once:
                new.append(k)
            else:
                out[k] = self[word]
        for at in range(0, len(new), RUN_WORDS):
            run = new[at : at + RUN_WORDS]
            for k, ids in zip(run, self._run([names[k] for k in run]), strict=True):
                out[k] = self[names[k]] = ids
        return out

    def _run(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of small letters, encoded by the library in one call."""
        text = b" ".join(words).decode("latin-1")  # bytes as letters, as the pre-tokenizer writes them, but some
        for byte, to in self.second:
            text = text.replace(byte, to)
        ids = np.array(self.bare.encode(text, add_special_tokens=False).ids, dtype="<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(words):
            return [little_endian(self._ids(w)) for w in words]
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    def encode(self, texts: Iterable[bytes]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        return list(self.encoded(texts))

    def encoded(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """``encode`` in turn, for texts that need not be held at once."""
        parts, held, size, total = [], [], 0, 0
        for t in texts:
            held.append(t if b"<|" in t else t.lower())
            size += len(t)
            if size >= BLOCK_BYTES:
                parts.append(_cut_words(held))
                total, held, size = total + size, [], 0
                if total >= CHUNK_BYTES:
                    yield from self._encode(parts)
                    parts, total = [], 0
        if held:
            parts.append(_cut_words(held))
        if parts:
            yield from self._encode(parts)

    def _encode(self, parts: list[tuple[bytes, np.ndarray, np.ndarray]]) -> Iterator[bytes]:
        counts = np.cumsum([0, *(len(sizes) for _, sizes, _ in parts)])
        offsets = np.zeros(counts[-1] + 1, dtype=np.int64)
        np.cumsum(np.concatenate([sizes for _, sizes, _ in parts]), out=offsets[1:])
        firsts = np.concatenate([*(first + n for (_, _, first), n in zip(parts, counts, strict=False)), counts[-1:]])
        data = b"".join([data for data, _, _ in parts])
        parts.clear()  # what is not needed any more goes, here and below: several of these lie in an executor's memory
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        del offsets, data
        if len(self) + len(words.dictionary) > self.limit:
            self.before = {}
            self.before = dict(self)
            self.clear()
        ids = pa.array(self._look_up(words.dictionary), type=pa.large_binary()).take(words.indices)
        del words
        _, places, data = ids.buffers()
        places = np.frombuffer(places, dtype=np.int64)[firsts].tolist() if len(ids) else [0] * len(firsts)
        data = memoryview(data or b"")
        for i, j in zip(places, places[1:], strict=False):
            yield bytes(data[i:j])
        del ids, data
        pa.default_memory_pool().release_unused()


#: Ids of a piece that the dictionary is trained on.
PIECE_IDS = 4096


def _encode_pieces(path: str, end_id: int):
    """Whole id arrays of the sampled documents, cut into pieces: (h, ids)."""
    schema = pa.schema([("h", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(path), struct.pack("<I", end_id)
        for batch in slices(batches):
            rows = []
            for x in encoder.encoded(t.as_py() or b"" for t in batch.column(1)):
                x += end
                pieces = [x[i : i + 4 * PIECE_IDS] for i in range(0, len(x), 4 * PIECE_IDS)]
                rows += [(xxhash.xxh3_64_intdigest(piece, seed=i) >> 1, piece) for i, piece in enumerate(pieces)]
            yield batch_of(schema, *zip(*rows, strict=True))

    return run


def train_dictionary(docs: DataFrame, path: str, end_id: int, sample: int, size: int) -> bytes:
    """A zstandard dictionary from whole id arrays of a bounded sample: about ``sample`` documents, chosen by a hash of id
    and text, cut into pieces of PIECE_IDS ids, of which the ``sample`` with the lowest hashes are read. Empty if the
    sample is too small to train on. Texts stay with the tasks; the driver gets ``sample`` pieces of ids."""
    share = math.ceil(min(1.0, sample / max(docs.count(), 1)) * (1 << 30))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share).select("doc_id", F.col("text").cast("binary").alias("text"))
    pieces = chosen.mapInArrow(_encode_pieces(path, end_id), "h long, ids binary").orderBy("h", "ids").limit(sample).collect()
    try:
        return zstandard.train_dictionary(size, [bytes(r.ids) for r in pieces]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=shared)


#: Frames that go back to Spark at a time.
FRAME_ROWS = 500
FRAMES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])


def _encode_frames(path: str, end_id: int, dictionary: bytes, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor, end = WordEncoder(path), _compressor(dictionary, level), struct.pack("<I", end_id)
        ids, rows = deque(), []

        def texts() -> Iterator[bytes]:
            for batch in batches:
                ids.extend(batch.column(0).to_pylist())
                yield from (t.as_py() or b"" for t in batch.column(1))

        for x in encoder.encoded(texts()):
            rows.append((ids.popleft(), len(x) // 4 + 1, compressor.compress(x + end)))
            if len(rows) == FRAME_ROWS:
                yield batch_of(FRAMES, *zip(*rows, strict=True))
                rows = []
        if rows:
            yield batch_of(FRAMES, *zip(*rows, strict=True))

    return run


SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])


def _write_shards(dictionary: bytes, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, start, mark = TaskContext.get().partitionId(), 0, 0, xxhash.xxh3_64_intdigest(dictionary)
        index, frames, held, first = [], [], 0, 0

        def flush():
            nonlocal index, frames, held, first, shard
            payload = b"".join(frames)
            data = struct.pack(HEAD, MAGIC, VERSION, mark, len(index), len(payload)) + np.array(index, dtype=ENTRY).tobytes() + payload
            out = batch_of(SHARDS, [part], [shard], [len(index)], [start - first], [data])
            index, frames, held, first, shard = [], [], 0, start, shard + 1
            return out

        for batch in batches:
            for doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index.append((doc_id or 0, doc_id is not None, start, n, held))
                frames.append(frame)
                held, start = held + len(frame), start + n
                if held >= shard_bytes:
                    yield flush()
        if index:
            yield flush()

    return run


def parse_shard(data: bytes, dictionary: bytes) -> tuple[np.ndarray, memoryview]:
    """Index and payload of a shard; checks the format and the dictionary's hash."""
    magic, version, mark, docs, size = struct.unpack_from(HEAD, data)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a token-id shard of this version")
    if mark != xxhash.xxh3_64_intdigest(dictionary):
        raise ValueError("the shard was written with another dictionary")
    index = np.frombuffer(data, dtype=ENTRY, count=docs, offset=struct.calcsize(HEAD))
    at = struct.calcsize(HEAD) + docs * ENTRY.itemsize
    return index, memoryview(data)[at : at + size]


def read_document(data: bytes, dictionary: bytes, k: int) -> np.ndarray:
    """The ids of the ``k``-th document of a shard, without touching the others."""
    index, payload = parse_shard(data, dictionary)
    return np.frombuffer(_frame(index, payload, k, _decompressor(dictionary)), dtype="<u4")


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _frame(index: np.ndarray, payload: memoryview, k: int, decompressor) -> bytes:
    end = int(index["offset"][k + 1]) if k + 1 < len(index) else len(payload)
    ids = decompressor.decompress(payload[int(index["offset"][k]) : end])
    if len(ids) != 4 * int(index["n"][k]):
        raise ValueError("a frame does not hold the ids its index names")
    return ids


class TokenFiles:
    """Paths of one written set: ``shards``, ``dictionary`` and ``parts`` (first position of each part)."""

    def __init__(self, root: str):
        self.shards, self.dictionary, self.parts = f"{root}/shards", f"{root}/dictionary", f"{root}/parts"


def write_token_files(docs: DataFrame, path: str, root: str | None = None, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                      sample: int = 1000, dictionary_bytes: int = 65536, level: int = 3, shard_bytes: int = 4 << 20, part_docs: int = 20_000) -> TokenFiles:
    """Encode every whole text with the tokenizer at ``path``, append ``end_id``, and write the ids in ascending doc_id order.

    The dictionary is fitted on a bounded sample (``sample`` documents); all else covers all rows. Frames are
    stored once, then range-partitioned by doc_id: only compressed ids are shuffled, never texts.
    """
    spark = docs.sparkSession
    files = TokenFiles(root or scratch_path(spark, "token-files"))
    given = id_and_text(docs, id_col, text_col)
    with small_batches(spark):
        dictionary = train_dictionary(given, path, end_id, sample, dictionary_bytes)
        encoded = given.select("doc_id", F.col("text").cast("binary")).mapInArrow(_encode_frames(path, end_id, dictionary, level), "doc_id long, n_tokens long, frame binary")
        frames = stored(encoded, "token-frames")
    spark.createDataFrame([(dictionary,)], "dictionary binary").coalesce(1).write.parquet(files.dictionary)
    parts = max(spark.sparkContext.defaultParallelism, frames.count() // part_docs + 1)
    ordered = frames.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("frame"))
    with small_batches(spark):
        ordered.mapInArrow(_write_shards(dictionary, shard_bytes), "part int, shard int, n_docs long, n_ids long, data binary").write.parquet(files.shards)
    totals = spark.read.parquet(files.shards).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per written partition
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base")).coalesce(1).write.parquet(files.parts)
    return files


DOCS = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read_shards(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = _decompressor(dictionary)
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index, payload = parse_shard(data, dictionary)
                crcs = [zlib.crc32(_frame(index, payload, k, decompressor)) for k in range(len(index))]
                ids = pa.array(index["doc_id"], mask=index["has_id"] == 0)
                yield batch_of(DOCS, [part] * len(index), ids, index["start"].astype("i8"), index["n"].astype("i8"), crcs)

    return run


def read_token_files(spark, files: TokenFiles) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    dictionary = bytes(spark.read.parquet(files.dictionary).first().dictionary)
    rows = spark.read.parquet(files.shards).select("part", "data").mapInArrow(_read_shards(dictionary), "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    parts = spark.read.parquet(files.parts)  # a row per written partition; Spark broadcasts it if small
    with small_batches(spark):  # a shard at a time
        rows = stored(rows, "token-rows")
    return rows.join(parts, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
