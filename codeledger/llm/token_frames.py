"""Token ids in files of independent zstandard frames that can be read one document at a time.

A file holds, in ascending order of ``doc_id``: a frame for each document; a
skippable frame with the document index; and the seek table of the zstandard
seekable format, a skippable frame that lists the sizes and the checksum of
every frame and ends the file.  A reader finds a document in the index, its frame
by the seek table, and decompresses that frame only.

Index: u32 partition, u32 file of the partition, u32 bytes per id, u32 documents,
then i64 ids and u8 flags (1: the id is null).
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeledger.llm.tables import pieces, text_bytes
from codeledger.session import checkpointed, ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END = 2
#: Bytes of text in a partition, and of compressed frames after which a file is closed.
PARTITION_BYTES = 16 << 20
FILE_BYTES = 32 << 20
#: Words whose ids a worker remembers.
CACHED_WORDS = 1_200_000

#: Fixed values of the zstandard seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = b"\xb1\xea\x92\x8f"
WITH_CHECKSUMS = 0x80

ROWS = "partition long, file long, at long, doc_id long, start long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END) -> str:
    """Encode every text, write the files to the shared folder, and return their folder.

    A null or empty text is the end id alone.  Null ids come first; repeated rows and
    equal ids stay, in any order among themselves.  Other columns are not
    written.  An empty table gives a folder without documents.  A partition or a hot
    id beyond FILE_BYTES is spread over several files; Spark's writer commits
    them, so a lost executor leaves no half file.
    """
    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/token-frames-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    dealt = rows.repartitionByRange(pieces(text_bytes(docs), PARTITION_BYTES), "doc_id").sortWithinPartitions("doc_id")
    files = dealt.mapInArrow(_writer(tokenizer, end), "file binary")
    # the text writer puts bytes as they are, and a line's end is the end of the seek table
    writer = files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1)
    writer.option("encoding", "ISO-8859-1").option("lineSep", FOOTER_MAGIC.decode("latin-1")).text(folder)
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    start counts the ids of all documents before it, over all files.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = checkpointed(files.mapInArrow(_reader, ROWS))
    # one row per file, for their offsets
    sizes = rows.groupBy("partition", "file").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("partition", "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("partition", "file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    placed = rows.join(offsets, ["partition", "file"])
    return placed.select("doc_id", (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


class Encoder:
    """The library's ids, remembered word by word.

    The tokenizer drops white space and never joins what it parts, so a text's ids
    are those of its words in a row; texts that may hold a special token go
    to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text, as little-endian numbers of ``kind``."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        split = [None if any(s in t for s in self.special) else t.split() for t in texts]
        new = set().union(*(words for words in split if words)).difference(self.known)
        if new:
            self._learn(list(new))
        whole = iter(self._whole([t for t, words in zip(texts, split, strict=True) if words is None]))
        return [next(whole) if words is None else b"".join(map(self.known.__getitem__, words)) for words in split]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as one text and cut the ids where words begin.

        The tokenizer ignores case, and a full stop or comma right after a letter
        is always a part of its own, so most spellings share one stem.
        """
        stems, ends = [w.lower() if w.isascii() else w for w in words], [b""] * len(words)
        for i, w in enumerate(stems):
            if w[-1:] in (b".", b",") and w[-2:-1].isalpha():
                stems[i], ends[i] = w[:-1], w[-1:]
        new = list({*stems, *ends}.difference(self.known, (b"",)))
        texts = [w.decode() for w in new]
        found = self.library.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(found.ids, self.kind)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = np.array([a for a, _ in found.offsets], np.int64)
        cuts = np.searchsorted(at, starts).tolist()
        data, size = ids.tobytes(), self.kind.itemsize
        for stem, low, high in zip(new, cuts, cuts[1:], strict=False):
            self.known[stem] = data[size * low : size * high]
        self.known[b""] = b""
        for word, stem, end in zip(words, stems, ends, strict=True):
            self.known[word] = self.known[stem] + self.known[end]

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(f.ids, self.kind).tobytes() for f in found]


@cache
def encoder(tokenizer: str) -> Encoder:
    return Encoder(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))


def _writer(tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, partition, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], own.kind).tobytes()
        compress = zstandard.ZstdCompressor(level=3).compress
        ids, frames, table, size = [], [], [], 0

        def file() -> pa.RecordBatch:
            head = struct.pack("<4I", partition, number, own.kind.itemsize, len(ids))
            index = head + np.array([i or 0 for i in ids], "<i8").tobytes() + bytes(i is None for i in ids)
            data = closed_file(frames, table, index)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["file"])

        for batch in batches:
            for rows in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                texts = [t or b"" for t in rows.column("text").to_pylist()]
                for doc, data in zip(rows.column("doc_id").to_pylist(), own.encode(texts), strict=True):
                    data += last
                    frame = compress(data)
                    ids.append(doc)
                    frames.append(frame)
                    table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
                    size += len(frame)
                    if size >= FILE_BYTES:
                        yield file()
                        ids, frames, table, size, number = [], [], [], 0, number + 1
        if ids:
            yield file()

    return run


def closed_file(frames: list[bytes], table: list[tuple[int, int, int]], index: bytes) -> bytes:
    """Frames, index and seek table, without the four bytes that end the file."""
    skipped = struct.pack("<II", INDEX_MAGIC, len(index)) + index
    entries = np.array([*table, (len(skipped), 0, 0)], "<u4").tobytes()
    footer = struct.pack("<IB", len(table) + 1, WITH_CHECKSUMS)
    head = struct.pack("<II", SEEK_TABLE_MAGIC, len(entries) + len(footer) + len(FOOTER_MAGIC))
    return b"".join([*frames, skipped, head, entries, footer])


class TokenFile:
    """A file's index and seek table; frames are decompressed when asked for."""

    def __init__(self, data: bytes):
        if data[-4:] != FOOTER_MAGIC:
            raise ValueError("no seek table at the end")
        count, flags = struct.unpack("<IB", data[-9:-4])
        if flags != WITH_CHECKSUMS:
            raise ValueError("a seek table without checksums")
        self.data = memoryview(data)
        self.table = np.frombuffer(data, "<u4", 3 * count, len(data) - 9 - 12 * count).reshape(-1, 3).astype(np.int64)
        self.ends = np.cumsum(self.table[:, 0])
        index = self.data[self.ends[-2] + 8 if count > 1 else 8 : self.ends[-1]]
        self.partition, self.number, self.width, n = struct.unpack("<4I", index[:16])
        ids, null = np.frombuffer(index, "<i8", n, 16), np.frombuffer(index, np.uint8, n, 16 + 8 * n)
        self.doc_ids = [None if gone else i for i, gone in zip(ids.tolist(), null.tolist(), strict=True)]
        self.counts = self.table[:-1, 1] // self.width

    def ids(self, at: int) -> np.ndarray:
        """The ids of document ``at``, checked against the table."""
        size, length, checksum = self.table[at].tolist()
        end = int(self.ends[at])
        data = zstandard.ZstdDecompressor().decompress(self.data[end - size : end], max_output_size=length)
        if len(data) != length or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {at} is damaged")
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Only the ``wanted`` documents: (doc_id, ids)."""
        wanted = set(wanted)
        for at, doc in enumerate(self.doc_ids):
            if doc in wanted:
                yield doc, self.ids(at)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in ROWS.split(",")]
    for batch in batches:
        for i in range(batch.num_rows):
            file = TokenFile(batch.column("content")[i].as_py())
            n = len(file.doc_ids)
            sums = [zlib.crc32(file.ids(at).tobytes()) for at in range(n)]
            columns = [[file.partition] * n, [file.number] * n, range(n), file.doc_ids]
            columns += [np.cumsum(file.counts) - file.counts, file.counts, sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
