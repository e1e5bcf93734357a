"""SimHash fingerprints and their near-duplicate groups, compared bit plane by bit plane.

Two fingerprints that differ in at most r bits agree on all but r of any blocks
that the 64 bits are cut into; each choice of agreeing blocks is a key.  Rows of
a key are compared many at a time: the bits of all rows stand in planes, one
machine word holds one bit of 64 rows, and for a distance s down the rows the
planes are laid over themselves shifted by s.  Carry-save counters add up the
differing bits of all pairs at once, and a block is left as soon as every pair
in it has passed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.llm.components import components
from codeledger.session import checkpointed

BITS = 64
SEED = 42
#: Rows of one key that are compared in one task; more are dealt to pairs of pieces.
MOST_ROWS = 8192
#: Rows of small keys that are laid out in planes together.
PLANE_ROWS = 32768
#: Bytes of text hashed at once.
SLICE_BYTES = 4 << 20


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Shingles are of ``shingle`` words, A-Z lower-cased, repeats included; fewer
    words are one shingle, and no words (a null, empty or blank text) give the
    fingerprint zero, which is compared like any other.  Fingerprints link at
    ``radius`` or fewer differing bits; component_id is the least ``doc_id`` of all that links reach.

    Repeated rows each give a row.  A null ``doc_id`` is kept and never the
    least; a component of null ids only has a null component_id.  Other columns
    are not read.  Empty table: no rows.

    Copies share one fingerprint and meet as one row.  ``blocks`` sets the number
    of keys a fingerprint has and their length: choose more for more rows.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    joined = components(links(nodes.select("print"), radius, blocks))
    # a left join: most fingerprints have no link
    groups = nodes.join(joined.withColumnRenamed("node", "print"), "print", "left")
    groups = groups.withColumn("component", F.coalesce("component", "print"))
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.select("print", "component").join(least, "component").select("print", "component_id")
    rows = prints.join(named, "print")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed 64-bit number.  No shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints, start, size = [np.zeros(0, np.uint64)], 0, 0
            for i, text in enumerate(texts):
                size += len(text or b"")
                if size >= SLICE_BYTES or i + 1 == len(texts):
                    prints.append(_prints(texts[start : i + 1], shingle))
                    start, size = i + 1, 0
            numbers = np.concatenate(prints).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(numbers)], ["doc_id", "print"])

    return rows.mapInArrow(run, f"doc_id {kind}, print long")


def _prints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    digest, hashes, counts = xxhash.xxh64_intdigest, [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split() if text else []
        grams = zip(*(words[j:] for j in range(shingle)), strict=False) if len(words) >= shingle else [words] if words else []
        before = len(hashes)
        hashes += [digest(b" ".join(g), SEED) for g in grams]
        counts[i] = len(hashes) - before
    ones = np.zeros((len(texts), BITS), np.int64)
    values = np.array(hashes, "<u8")
    ends = np.cumsum(counts)
    for i in np.flatnonzero(counts):
        own = values[ends[i] - counts[i] : ends[i]]
        ones[i] = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def links(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(a, b): links that join all distinct ``print`` within ``radius`` bits, a spanning set of each key's links."""
    if not radius < blocks <= BITS:
        raise ValueError("blocks must be more than radius and at most 64")
    keyed = nodes.select("print", F.posexplode(F.array(*_keys(radius, blocks))).alias("table", "key"))
    hot = keyed.groupBy("table", "key").count().where(F.col("count") > MOST_ROWS)
    hot = hot.select("table", "key", F.ceil(F.col("count") * 2 / MOST_ROWS).cast("int").alias("pieces"))
    keyed = keyed.join(hot, ["table", "key"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    own = F.pmod(F.xxhash64("print"), F.col("pieces")).cast("int")
    paired = keyed.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, pieces - 1)")))
    run = F.xxhash64("table", "key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = paired.select(run.alias("run"), "print").repartition("run").sortWithinPartitions("run")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, prints in _whole_runs(batches):
            a, b = spanning_links(runs, prints, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def _keys(radius: int, blocks: int) -> list:
    """One number for each choice of ``blocks - radius`` blocks: their bits, packed."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for chosen in combinations(range(blocks), blocks - radius):
        key = F.lit(0).cast("long")
        for i in chosen:
            low, width = edges[i], edges[i + 1] - edges[i]
            bits = F.shiftrightunsigned("print", low).bitwiseAND((1 << width) - 1 if width < 64 else -1)
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    return keys


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of whole runs, at least PLANE_ROWS at a time; a run has at most a few MOST_ROWS."""
    runs, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        runs = np.concatenate([runs, batch.column("run").to_numpy()])
        prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
        if len(runs) >= PLANE_ROWS:
            whole = int(np.searchsorted(runs, runs[-1]))
            if whole:
                yield runs[:whole], prints[:whole]
                runs, prints = runs[whole:], prints[whole:]
    if len(runs):
        yield runs, prints


def spanning_links(runs: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one run within ``radius`` bits, without those that earlier pairs join already."""
    left, right = spanning_rows(runs, prints, radius)
    return prints[left], prints[right]


def spanning_rows(runs: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of these pairs; a fingerprint is a number, or a row of several."""
    none = np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(runs[1:] != runs[:-1]) + 1])
    sizes = np.diff(np.append(starts, len(runs)))
    if not (sizes > 1).any():
        return none, none
    # largest runs first: for a shift, the rows that still have a partner stand in front
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 1]
    starts, sizes = starts[order], sizes[order]
    rows = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    prints, run = prints[rows], np.repeat(np.arange(len(sizes)), sizes)
    planes = bit_planes(prints)
    ends = np.cumsum(sizes)
    label = np.arange(len(prints))
    left, right = [], []
    for shift in range(1, int(sizes[0])):
        most = int(ends[np.searchsorted(-sizes, -shift) - 1]) - shift  # rows of runs longer than the shift
        pairs = np.flatnonzero(_near(planes, most, shift, radius))
        pairs = pairs[run[pairs] == run[pairs + shift]]
        for i in pairs[label[pairs] != label[pairs + shift]].tolist():
            a, b = label[i], label[i + shift]
            if a != b:
                left.append(i)
                right.append(i + shift)
                low, high = _range_of_run(ends, sizes, run[i])
                part = label[low:high]
                part[part == max(a, b)] = min(a, b)
    return rows[np.array(left, np.int64)], rows[np.array(right, np.int64)]


def _range_of_run(ends: np.ndarray, sizes: np.ndarray, run: int) -> tuple[int, int]:
    return int(ends[run] - sizes[run]), int(ends[run])


def bits_of(prints: np.ndarray) -> np.ndarray:
    """A row of zeros and ones for each fingerprint."""
    return np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word, with a word to spare."""
    packed = np.packbits(bits_of(prints).T, axis=1, bitorder="little")
    words = -(-len(prints) // 64) + 2
    planes = np.zeros((len(packed), words * 8), np.uint8)
    planes[:, : packed.shape[1]] = packed
    return planes.view("<u8")


def _near(planes: np.ndarray, most: int, shift: int, radius: int) -> np.ndarray:
    """For the first ``most`` rows, whether the row ``shift`` further on differs in at most ``radius`` bits.

    Digit d of all counts stands in one plane.  Counts stop mattering beyond the
    radius: ``far`` remembers lanes that have passed it.
    """
    words, skip, low = -(-most // 64), shift // 64, np.uint64(shift % 64)
    digits = [np.zeros(words, np.uint64) for _ in range(max(1, radius.bit_length()))]
    far = np.zeros(words, np.uint64)
    if most % 64:
        far[-1] = ~np.uint64(0) << np.uint64(most % 64)
    every = len(planes) // 16
    for bit, row in enumerate(planes):
        moved = row[skip : skip + words]
        if low:
            moved = (moved >> low) | (row[skip + 1 : skip + 1 + words] << (np.uint64(64) - low))
        count_bit(digits, far, row[:words] ^ moved)
        if bit % every == every - 1 and all_far(digits, far, radius):
            break
    near = np.unpackbits((~far).astype("<u8").view(np.uint8), bitorder="little")
    return near[:most].astype(bool)


def count_bit(digits: list[np.ndarray], far: np.ndarray, carry: np.ndarray) -> None:
    """Add one to the counts of the lanes in ``carry``, digit by digit."""
    for i, digit in enumerate(digits):
        digits[i], carry = digit ^ carry, digit & carry
    far |= carry  # a count of 2 ** len(digits)


def all_far(digits: list[np.ndarray], far: np.ndarray, radius: int) -> bool:
    """Bring ``far`` up to date; whether every lane has passed the radius."""
    if radius + 1 < 1 << len(digits):
        far |= _above(digits, radius)
    return bool((far == ~np.uint64(0)).all())


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is more than ``radius``."""
    above = np.zeros_like(digits[0])
    equal = ~above
    for i in reversed(range(len(digits))):
        if radius >> i & 1:
            equal = equal & digits[i]
        else:
            above = above | (equal & digits[i])
            equal = equal & ~digits[i]
    return above
