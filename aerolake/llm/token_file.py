"""Token ids in bit-packed binary files with random access.

One file (shard) per range of document ids, in ascending order. Layout, all
numbers little-endian:

    header   b"PIDS", version u32, bits u32, ids per block u32
    payload  blocks one after the other; a block packs up to ``ids per block``
             ids of ``bits`` bits each, lowest bit first, padded to 8 bytes
    index    u64 byte offset of every block, then of the payload's end
    docs     i64 id of every document, then u64 end position of each (in ids,
             within the shard)
    footer   u64 documents, u64 ids, u64 blocks, b"SDIP"

Blocks unpack with numpy bit arithmetic, and any id range needs only the
blocks that hold it. A task writes under a name of its own and renames, so a
repeated attempt after a lost executor leaves one whole file; the manifest
that Spark returns names the file of the attempt that counts.

Defined cases: a null text is empty; every document ends with the end id, so
an empty one is that id alone; equal document ids keep their rows, ordered by
text; a null document id comes first and is stored as the smallest i64; an
empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, release, text_chunks

HEAD, HEAD_SIZE = "<4sIII", 16
FOOT, FOOT_SIZE = "<QQQ4s", 28
BLOCK_IDS = 1 << 14
NO_ID = -(1 << 63)
# Ids held at once while reading back.
_READ_IDS = 1 << 20
# Distinct parts whose ids a task remembers, and words encoded in one call.
_KNOWN, _AT_ONCE = 1 << 18, 2000
# Bytes of text encoded in one numpy step, in which every different run is looked up once.
_SLICE = 4 << 20
_MARK = "\x01"
# ASCII punctuation but the apostrophe, which may start a contraction.
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits per id, lowest first, in 8-byte words."""
    if bits == 16:
        raw = ids.astype("<u2").tobytes()
        return raw + bytes(-len(raw) % 8)
    flags = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    raw = np.packbits(flags.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return raw + bytes(-len(raw) % 8)


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    if bits == 16:
        return np.frombuffer(raw, "<u2", count).astype(np.uint32)
    words = np.concatenate([np.frombuffer(raw, "<u8"), np.zeros(1, np.uint64)])
    at = np.arange(count, dtype=np.uint64) * np.uint64(bits)
    slot, low = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    # The upper part comes from the next word; shifting twice avoids a shift by 64.
    high = (words[slot + 1] << (np.uint64(63) - low)) << np.uint64(1)
    return (((words[slot] >> low) | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder, as Spark names it."""
    if "://" not in uri:
        return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ShardWriter:
    """Appends documents to one shard file; holds a slice of ids, eight bytes
    per block and sixteen per document."""

    def __init__(self, folder: str, bits: int):
        self.store, self.folder = open_store(folder)
        self.bits, self.rest, self.held = bits, [], 0
        self.offsets, self.docs, self.ends, self.total = [0], [], [], 0
        self.name = f"{uuid.uuid4().hex}.pids"
        self.store.create_dir(self.folder, recursive=True)
        self.out = self.store.open_output_stream(f"{self.folder}/.{self.name}")
        self.out.write(struct.pack(HEAD, b"PIDS", 1, bits, BLOCK_IDS))

    def add(self, docs: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Some documents' own ids, their token ids in order, and each one's number of them."""
        self.docs.append(docs)
        self.ends.append(self.total + np.cumsum(sizes, dtype=np.int64))
        self.total += len(ids)
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            ids = np.concatenate(self.rest)
            cut = len(ids) - len(ids) % BLOCK_IDS
            self._blocks(ids[:cut])
            self.rest, self.held = [ids[cut:]], len(ids) - cut

    def _blocks(self, ids: np.ndarray) -> None:
        for i in range(0, len(ids), BLOCK_IDS):
            raw = pack(ids[i:i + BLOCK_IDS], self.bits)
            self.out.write(raw)
            self.offsets.append(self.offsets[-1] + len(raw))

    def close(self) -> tuple[str, int, int]:
        self._blocks(np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32))
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0, np.int64)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.concatenate([np.zeros(0, np.int64), *self.docs]).astype("<i8").tobytes())
        self.out.write(ends.astype("<u8").tobytes())
        self.out.write(struct.pack(FOOT, len(ends), self.total, len(self.offsets) - 1, b"SDIP"))
        self.out.close()
        self.store.move(f"{self.folder}/.{self.name}", f"{self.folder}/{self.name}")
        return self.name, len(ends), self.total


class Shard:
    """Random access to a shard file."""

    def __init__(self, folder: str, name: str):
        store, path = open_store(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        size = self.file.size()
        magic, _, self.bits, self.per_block = struct.unpack(HEAD, self.file.read_at(HEAD_SIZE, 0))
        self.n_docs, self.n_ids, self.n_blocks, end = struct.unpack(FOOT, self.file.read_at(FOOT_SIZE, size - FOOT_SIZE))
        if (magic, end) != (b"PIDS", b"SDIP"):
            raise ValueError(f"{name} is not a token file")
        self.ends_at = size - FOOT_SIZE - 8 * self.n_docs
        self.docs_at = self.ends_at - 8 * self.n_docs
        self.index_at = self.docs_at - 8 * (self.n_blocks + 1)

    def _numbers(self, at: int, first: int, count: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(8 * count, at + 8 * first), "<i8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.per_block, (stop - 1) // self.per_block
        offsets = self._numbers(self.index_at, first, last - first + 2)
        raw = self.file.read_at(int(offsets[-1] - offsets[0]), HEAD_SIZE + int(offsets[0]))
        offsets = offsets - offsets[0]
        parts = [unpack(raw[offsets[i]:offsets[i + 1]], self.bits,
                        min(self.per_block, self.n_ids - (first + i) * self.per_block))
                 for i in range(last - first + 1)]
        base = first * self.per_block
        return np.concatenate(parts)[start - base:stop - base]

    def doc_ends(self, first: int, stop: int) -> np.ndarray:
        """Ends of documents ``first`` to ``stop``, with the start of the first before them."""
        ends = self._numbers(self.ends_at, max(0, first - 1), stop - max(0, first - 1))
        return ends if first else np.concatenate([[0], ends]).astype(np.int64)

    def doc_ids(self, first: int, stop: int) -> np.ndarray:
        return self._numbers(self.docs_at, first, stop - first)

    def doc(self, i: int) -> np.ndarray:
        start, stop = self.doc_ends(i, i + 1)
        return self.ids(int(start), int(stop))

    def crcs(self, first: int, stop: int) -> list[int]:
        """crc32 of each document's ids as little-endian u32, reading a bounded run at a time."""
        ends, out, i = self.doc_ends(first, stop), [], 0
        while i < len(ends) - 1:
            k = max(i + 1, int(np.searchsorted(ends, ends[i] + _READ_IDS, side="right")) - 1)
            if k == i + 1:  # perhaps one very long document
                crc = 0
                for at in range(int(ends[i]), int(ends[k]), _READ_IDS):
                    crc = zlib.crc32(self.ids(at, min(int(ends[k]), at + _READ_IDS)).astype("<u4").tobytes(), crc)
                out.append(crc)
            else:
                ids = self.ids(int(ends[i]), int(ends[k])).astype("<u4")
                out += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[i:k] - ends[i], ends[i + 1:k + 1] - ends[i])]
            i = k
        return out


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _texts(values: pa.StringArray) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


class _Table:
    """Growing lists of ids, numbered; entry 0 is empty."""

    def __init__(self):
        self.flat, self.first, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])

    def get(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists one after the other, and their sizes."""
        size = self.size[index]
        ends = np.cumsum(size)
        at = np.repeat(self.first[index] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at], size


class Encoder:
    """Ids of texts (UTF-8), with every distinct word encoded once, and looked up once a slice.

    Right for tokenizers that join neither what white space parts nor letters
    and the punctuation after them. Texts fall into runs without white space; a
    run of letters with ASCII punctuation behind is the two parts, any other run
    (also one whose letters are not all letters once normalised) is one part,
    encoded by the library as it stands. If the tokenizer makes no
    difference between ASCII cases, upper and lower case share their entry.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.mark = self._whole(_MARK)
        self.folds = all(self._whole(w) == self._whole(w.lower()) for w in (*map(chr, range(65, 91)), "WORD", "Word."))
        # Only text that cannot hold a special token is folded.
        self.specials = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.direct = self.tokenizer.model, None
        self._forget()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self):
        self.parts, self.part_ids = _Numbers({"": 0}), _Table()

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Each word's ids by the whole tokenizer: one text, with a mark after each word."""
        if len(self.mark) == 1 and not any(_MARK in w for w in words):
            ids = np.array(self._whole(f" {_MARK} ".join([*words, ""])), np.uint32)
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) == len(words):
                return [x[:-1].tolist() for x in np.split(ids, marks[:-1] + 1)]
        return [self._whole(w) for w in words]

    def _by_model(self, pieces: list[str]) -> list[list[int]]:
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(x)] for x in pieces]

    def _by_steps(self, words: list[str]) -> list[list[int]]:
        """The ids of words of letters, by the tokenizer's own normaliser, splitter
        and model: much faster, as no positions in the text are kept."""
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return self._encode(words)
        text = self.tokenizer.normalizer.normalize_str(" ".join(words))
        pieces = [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self._by_model(pieces) if len(pieces) == len(words) else self._encode(words)

    def _are_words(self, heads: pa.StringArray) -> np.ndarray:
        """Whether each is all letters, and still is when the tokenizer has normalised it
        (some letters fall apart into a letter and marks)."""
        import pyarrow.compute as pc
        out = pc.ascii_is_alpha(heads).to_numpy(zero_copy_only=False)
        beyond = np.flatnonzero(~pc.string_is_ascii(heads).to_numpy(zero_copy_only=False))
        alpha = [(i, x) for i, x in zip(beyond.tolist(), _texts(heads.take(pa.array(beyond)))) if x.isalpha()]
        normal = self.tokenizer.normalizer
        for k in range(0, len(alpha), _AT_ONCE):
            some = alpha[k:k + _AT_ONCE]
            # Letters don't join over a space, so that many are normalised in one call.
            words = [x for _, x in some] if normal is None else normal.normalize_str(" ".join([x for _, x in some])).split(" ")
            if len(words) != len(some):
                words = [normal.normalize_str(x) for _, x in some]
            out[[i for i, _ in some]] = [x.isalpha() for x in words]
        return out

    def _learn_parts(self, fresh: list[str], words: set[str]) -> None:
        """``words``: the parts that are all letters."""
        lists: list = [None] * len(fresh)
        plain, letters, rest = [], [], []
        for i, x in enumerate(fresh):
            (rest if x not in words else plain if x.isascii() else letters).append(i)
        if self.direct is None and plain:  # whether plain ASCII words reach the model as they are
            some = [fresh[i] for i in plain[:200]]
            self.direct = self._encode(some) == self._by_model(some)
        for numbers, encode in ((plain, self._by_model if self.direct else self._by_steps), (letters, self._by_steps),
                                (rest, self._encode)):
            for k in range(0, len(numbers), _AT_ONCE):
                some = numbers[k:k + _AT_ONCE]
                for i, ids in zip(some, encode([fresh[i] for i in some])):
                    lists[i] = ids
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.part_ids.add(np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size)

    def _numbers(self, runs: pa.StringArray) -> np.ndarray:
        """The numbers of the two parts of each run; what is new is encoded."""
        import pyarrow.compute as pc
        part, before = self.parts.__getitem__, len(self.parts)
        heads = pc.ascii_rtrim(runs, characters=_PUNCTUATION)
        cut = pc.dictionary_encode(heads)
        words = self._are_words(cut.dictionary)
        at = cut.indices.to_numpy()
        out, of_head = np.zeros((len(runs), 2), np.int64), np.zeros(len(words), np.int64)
        texts = _texts(cut.dictionary.filter(pa.array(words)))
        of_head[words] = np.fromiter(map(part, texts), np.int64, len(texts))
        out[:, 0] = of_head[at]
        whole = np.flatnonzero(~words[at])
        out[whole, 0] = np.fromiter(map(part, _texts(runs.take(pa.array(whole)))), np.int64, len(whole))
        longer = pc.greater(pc.binary_length(runs), pc.binary_length(heads)).to_numpy(zero_copy_only=False)
        tailed = pa.array(np.flatnonzero(words[at] & longer))
        # Few different tails: each is looked up once.
        tails = pc.dictionary_encode(pa.array([run[len(head):] for run, head in zip(_texts(runs.take(tailed)), _texts(heads.take(tailed)))],
                                              pa.string()))
        if len(tailed):
            out[tailed.to_numpy(), 1] = np.array([part(x) for x in tails.dictionary.to_pylist()], np.int64)[tails.indices.to_numpy()]
        if len(self.parts) > before:
            self._learn_parts(list(islice(self.parts, before, None)), set(texts))
        return out

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, with the end id after each text, and ids per text."""
        import pyarrow.compute as pc
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.parts) > _KNOWN:
            self._forget()
        folded = []
        for text in texts:
            text = text or b""
            low = text.lower()
            folded.append(low if self.folds and not any(x in low for x in self.specials) else text)
        # Every different run of the slice once; white space at an end leaves an empty run.
        split = pc.ascii_split_whitespace(pa.array(folded, pa.string()))
        runs = pc.dictionary_encode(split.flatten())
        numbers = self._numbers(runs.dictionary)
        flat, size = self.part_ids.get(numbers.ravel())
        ids = _Table()
        ids.add(np.append(flat, self.end_id).astype(np.uint32), np.append(size.reshape(-1, 2).sum(axis=1), 1))
        counts = np.diff(split.offsets.to_numpy()) + 1
        index = np.zeros(int(counts.sum()), np.int64)
        ends = np.cumsum(counts) - 1
        inside = np.ones(len(index), bool)
        inside[ends] = False
        index[inside] = runs.indices.to_numpy() + 1
        index[ends] = len(runs.dictionary) + 1
        flat, size = ids.get(index)
        return flat, np.add.reduceat(size, ends - counts + 1)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocab_size: int) -> DataFrame:
    """Encode and write all documents in ascending id order.

    Returns the manifest: shard (its place in the order), file, n_docs, n_ids,
    start (ids in the shards before). The manifest is written beside the files.
    """
    spark, bits = docs.sparkSession, bits_for(vocab_size)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    ordered = _by_id(ordered).sortWithinPartitions("doc_id", "text")
    shard_dir = f"{folder}/shards"
    bound_batches(spark)

    def write(batches):
        import pyarrow.compute  # noqa: F401
        from pyspark import TaskContext
        encoder, writer = None, None
        for chunk in text_chunks(batches, limit=_SLICE):
            if writer is None:
                encoder, writer = Encoder(tokenizer_path, end_id), ShardWriter(shard_dir, bits)
            docs = chunk.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            writer.add(docs, *encoder.encode(chunk.column(1).to_pylist()))
        if writer is not None:
            name, n_docs, n_ids = writer.close()
            encoder = writer = None
            release()
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([name]),
                                   pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                                  names=["shard", "file", "n_docs", "n_ids"])

    ordered.mapInArrow(write, "shard bigint, file string, n_docs bigint, n_ids bigint") \
        .write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def _by_id(docs: DataFrame) -> DataFrame:
    """Ranges of ids, about as many as the scan has splits."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartitionByRange(parts, "doc_id")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Shards in order. A row per file, so the running sum is over few rows."""
    rows = sorted(spark.read.parquet(f"{folder}/manifest").collect())
    start, out = 0, []
    for k, r in enumerate(rows):
        out.append((k, r.file, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return spark.createDataFrame(out, "shard long, file string, n_docs long, n_ids long, start long")


def read_tokens(spark: SparkSession, folder: str, docs_per_read: int = 4096) -> DataFrame:
    """Every document read back from the files: doc_id, shard, position (in the
    shard), start (ids of all documents before it), n_tokens, ids_crc32.

    Tasks are ranges of documents, found through the shard's own index.
    """
    shard_dir = f"{folder}/shards"
    spans = (manifest(spark, folder)
             .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1,
                                                       F.lit(docs_per_read).cast("long"))))
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "first"))

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shard, first = Shard(shard_dir, r["file"]), r["first"]
                stop = min(first + docs_per_read, shard.n_docs)
                ends, docs = shard.doc_ends(first, stop), shard.doc_ids(first, stop)
                yield pa.record_batch([
                    pa.array(docs, pa.int64(), mask=docs == NO_ID), pa.array([r["shard"]] * (stop - first), pa.int64()),
                    pa.array(range(first, stop), pa.int64()), pa.array(r["start"] + ends[:-1], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()), pa.array(shard.crcs(first, stop), pa.int64())],
                    names=["doc_id", "shard", "position", "start", "n_tokens", "ids_crc32"])

    return spans.mapInArrow(read, "doc_id bigint, shard bigint, position bigint, start bigint, "
                                  "n_tokens bigint, ids_crc32 bigint")
