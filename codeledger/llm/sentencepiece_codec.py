"""SentencePiece ids, decoded text, and the bytes of the original behind every piece.

The library cuts the pieces.  It says nothing of the original text, so the
normalisation is done again here, by the longest prefix in the model's compiled
character map, writing down for each byte it makes the byte of the text it came
from.  A piece covers a range of normalised bytes, and so a span of the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codeledger.llm.tables import with_fields

MODEL = "piece_bpe_32k.model"
SPACE = "▁".encode()
#: Texts given to the library at once hold about this many bytes.
SLICE_BYTES = 4 << 20

DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("spans_sha256", T.StringType()),
        T.StructField("covered_bytes", T.LongType()),
    ]
)
PIECES = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
)


def encode(docs: DataFrame, model: str = MODEL, pieces: bool = False) -> DataFrame:
    """``docs`` without text, with the digests of its ids, decoded text and spans.

    ids_sha256 is over the decimal ids joined by commas, spans_sha256 over the
    little-endian int32 starts, then ends, of all pieces; covered_bytes counts
    the bytes of the text that some piece covers.  With ``pieces`` the arrays ids, starts
    and ends (byte offsets in the UTF-8 text) and the decoded text are added.

    A null or empty text has no piece.  Rows are independent: repeated rows
    give repeated results, other columns pass through, and one named like a
    result is replaced.  Empty table: no rows.  No shuffle.
    """
    new = T.StructType(DIGEST.fields + PIECES.fields) if pieces else DIGEST
    rest = T.StructType([f for f in docs.schema if f.name.lower() != "text"])
    schema = with_fields(rest, new)
    passed = [f.name for f in schema if f.name not in new.names]
    rows = docs.select(*passed, F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_encoder(model, to_arrow_schema(schema), passed), schema)


class CharacterMap:
    """The compiled map of a model: a double-array trie of prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(bytes matched, replacement) of the longest prefix of ``data[at:]``; one character as it is if none."""
        found, node = None, 0
        if self.units:
            node = _offset(self.units[0])
            for i in range(at, len(data)):
                node ^= data[i]
                if node >= len(self.units) or (unit := self.units[node]) & 0x800000FF != data[i]:
                    break
                node ^= _offset(unit)
                if unit >> 8 & 1:
                    found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found:
            return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, data[at : at + size]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


class Codec:
    """A model with its normalisation rules and the normalised length of every piece."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            proto = file.read()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        spec = _normalizer(proto)
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        count = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(count)]
        self.lengths = np.array([1 if self.model.is_byte(i) else len(n.encode()) for i, n in enumerate(names)], np.int64)
        self.unknown = self.model.unk_id()

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the place in ``data``."""
        if not data:
            return b"", np.zeros(1, np.int64)
        if self.map.units:
            out, source, at = [], [], 0
            while at < len(data):
                size, text = self.map.longest(data, at)
                out.append(text)
                source += [at] * len(text)
                at += size
            text, places = b"".join(out), np.array(source, np.int64)
        else:
            text, places = data, np.arange(len(data))
        if self.squeeze:
            keep = np.frombuffer(text, np.uint8) != 0x20
            keep[1:] |= keep[:-1]  # the first of a run of spaces
            keep[0] &= text[0] != 0x20
            while len(text) and keep.any() and not keep[len(keep) - 1]:
                text, places, keep = text[:-1], places[:-1], keep[:-1]
            text, places = np.frombuffer(text, np.uint8)[keep].tobytes().rstrip(b" "), places[keep]
            places = places[: len(text)]
        if self.prefix and text:
            text, places = b" " + text, np.concatenate([places[:1], places])
        spaces = np.frombuffer(text, np.uint8) == 0x20
        places = np.append(np.repeat(places, np.where(spaces, len(SPACE), 1)), len(data))
        return text.replace(b" ", SPACE), places

    def spans(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end in ``data`` of every piece."""
        text, places = self.normalise(data)
        lengths = self.lengths[ids]
        if (ids == self.unknown).any():
            lengths = self._with_unknown(text, ids, lengths)
        ends = np.cumsum(lengths)
        if len(ids) and ends[-1] != len(text):
            raise ValueError("pieces and normalised text differ in length")
        return places[ends - lengths], places[ends]

    def _with_unknown(self, text: bytes, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """An unknown piece reaches to where the next known piece begins."""
        lengths, at = lengths.copy(), 0
        for i, number in enumerate(ids.tolist()):
            if number == self.unknown:
                known = i + 1 < len(ids) and ids[i + 1] != self.unknown
                end = text.find(self.model.id_to_piece(int(ids[i + 1])).encode(), at + 1) if known else len(text)
                lengths[i] = end - at
            at += lengths[i]
        return lengths


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def _normalizer(proto: bytes) -> dict[int, int | bytes]:
    """The normaliser's settings: 2 is the compiled map, 3 the leading space, 4 the squeezing of spaces."""
    for number, value in _fields(proto):
        if number == 3:
            return dict(_fields(value))
    return {}


@cache
def codec(model: str) -> Codec:
    return Codec(public_tokenizers.path(model) if "/" not in model else model)


def _encoder(model: str, schema: pa.Schema, passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for rows in _slices(batch):
                texts = [t or b"" for t in rows.column("text").to_pylist()]
                results = [_one(own, t) for t in texts]
                columns = dict(zip(DIGEST.names + PIECES.names, zip(*results, strict=True), strict=True))
                columns |= {n: rows.column(n) for n in passed}
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema
                )

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about SLICE_BYTES of text at a time."""
    column = batch.column("text")
    sizes = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + SLICE_BYTES)))
        yield batch.slice(start, end - start)
        start = end


def _one(own: Codec, data: bytes) -> tuple:
    ids = own.model.encode(data, num_threads=1)
    numbers = np.array(ids, np.int32)
    starts, ends = own.spans(data, numbers)
    starts, ends = starts.astype(np.int32), ends.astype(np.int32)
    decoded = own.model.decode(ids)
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
        hashlib.sha256(starts.tobytes() + ends.tobytes()).hexdigest(),
        int((ends - starts).sum()),
        numbers,
        starts,
        ends,
        decoded,
    )
