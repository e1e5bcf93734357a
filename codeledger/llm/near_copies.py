"""Near copies of documents, found with wide SimHash fingerprints.

The 64 bits of ``simhash`` tell texts apart that are almost equal.  Documents
that share four fifths of their shingles of five words differ in too many of so few
bits; here a fingerprint has 256.  Every bit belongs to one key of each of
several shuffles, and documents with an equal key are compared bit plane by bit
plane: a block of fingerprints against the planes of all rows of the key, with carry-save
counters, left as soon as every pair has passed the radius.

What is near by its bits is then counted: a link stands only if the two sets of
shingles are as similar as asked.  Where a group does not hold together by what has been
counted, all its pairs within the radius are, so that a pair is never lost behind another text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeledger.llm.components import components
from codeledger.llm.simhash import MOST_ROWS, PLANE_ROWS, SLICE_BYTES, all_far, bit_planes, bits_of, count_bit, spanning_rows
from codeledger.llm.tables import aside, small
from codeledger.session import checkpointed

WORDS = 4
PRINT = [f"p{i}" for i in range(WORDS)]
#: Texts that share 0.8 of their shingles differ in 39 of 256 bits on average, give or take 6; what is near by chance is counted out.
RADIUS = 50
#: Shuffles of the bits; each gives 16 keys of 16 bits.  More rows ask for longer keys and more shuffles.
SHUFFLES, KEY_BITS = 3, 16
#: Rows of a key that are compared by shifts of all rows; more are compared block by block.
SMALL_RUN, BLOCK = 64, 256
#: Rows that are compared with one copy of a set of shingles; more get a copy each.
SET_ROWS = 256
#: A group is dealt to so many pieces when its rows get their name.
PIECES = 64
#: Rows, and hashes of shingles, of a group that are compared in one task; more are dealt to pairs of pieces.
GROUP_ROWS, GROUP_SHINGLES = 2048, 2 << 20
#: Keys with more than MOST_ROWS rows that are broadcast, 20 bytes each; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def keep_first(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the least ``doc_id``.

    All rows of that id stay, and rows of a null id; all columns stay as they are, whatever their names.
    """
    return keep_least(docs, lambda known: near_copies(known, shingle, similarity, radius))


def keep_least(docs: DataFrame, *methods: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` with the least ``doc_id`` of each group that any of ``methods`` links, or several of them together.

    A method gives (doc_id, component_id) for rows with an id.  All rows of the id stay, and rows of a null id.
    """
    hidden, back = aside(docs, "doc_id", "text")
    known = hidden.where("doc_id is not null")
    found = [checkpointed(m(known).where("component_id <> doc_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))) for m in methods]
    # one method's groups are whole; those of several are joined where they meet
    groups = found[0].toDF("node", "component") if len(found) == 1 else components(reduce(DataFrame.union, found))
    gone = checkpointed(groups.where("component < node").select(F.col("node").alias("__gone")).distinct())
    return back(hidden.join(small(gone), F.col("doc_id") == F.col("__gone"), "left_anti"))


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` with an id.

    Shingles are of ``shingle`` words, A-Z lower-cased, a repeated one counts once; fewer
    words are one shingle, and no words (a null, empty or blank text) are copies of each other.
    Documents meet in one group when a key and all but ``radius`` of 256 bits are equal, of them or
    of others between them.  Those of a group link when all but ``radius`` bits are equal, and
    ``similarity`` of their joint shingles are in both; texts with the same 256 bits are copies.
    component_id is the least ``doc_id`` of all that links reach.

    Rows of equal ids are rows of their own, and the id has the component of each.  Rows of a
    null id are left out.  Other columns are not read.  Empty table: no rows.
    """
    known = docs.where("doc_id is not null")
    prints = checkpointed(wide_prints(known, shingle))
    # copies meet as one row
    nodes = prints.groupBy(*PRINT).agg(F.min("doc_id").alias("first"))
    nodes = checkpointed(nodes.withColumn("node", F.xxhash64(*PRINT)))
    near = checkpointed(links(nodes, radius))
    alike = similar_links(known, nodes, near, shingle, similarity, radius)
    groups = checkpointed(nodes.join(components(alike), "node", "left"))
    linked, alone = groups.where("component is not null"), groups.where("component is null")
    # a large group is dealt out before it gets its name
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    least = least.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    named = linked.withColumn("piece", F.pmod("node", F.lit(PIECES)).cast("int")).join(least, ["component", "piece"])
    named = named.select(*PRINT, "component_id").union(alone.select(*PRINT, "first"))
    return prints.join(named, PRINT).select("doc_id", "component_id")


def similar_links(
    docs: DataFrame, nodes: DataFrame, near: DataFrame, shingle: int, similarity: float, radius: int = RADIUS
) -> DataFrame:
    """(a, b): links between nodes whose sets of shingles are similar, by exact count.

    First every node is compared with one of its group, as joined by ``near``: one pair a
    node, however large the group.  In a group that this does not join whole, all nodes
    within ``radius`` bits that are not joined yet are compared.
    """
    loose = checkpointed(components(near))
    ends = nodes.join(loose.select("node"), "node").select("node", "first")
    sets = checkpointed(shingle_sets(docs, ends, shingle))
    star = loose.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    star = checkpointed(similar(star, sets, similarity))
    rows = loose.join(star.withColumnRenamed("a", "node"), "node", "left")
    rows = checkpointed(rows.select("node", "component", F.coalesce("b", "node").alias("joined")))
    return star.union(links_within(rows, nodes, sets, similarity, radius))


def links_within(rows: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float, radius: int) -> DataFrame:
    """(a, b): links that join all similar nodes of a component within ``radius`` bits, beside what is ``joined`` in ``rows``.

    Tasks hold the sets themselves: only a link that stands spares another comparison.
    """
    sizes = rows.join(sets.select("node", F.size("shingles").alias("size")), "node")
    parts = F.greatest(F.count(F.lit(1)) / GROUP_ROWS, F.sum("size") / GROUP_SHINGLES)
    # a component in one piece is compared with itself; the rows of a larger one meet as pairs of pieces
    pieces = F.when(parts <= 1, F.lit(1)).otherwise(F.ceil(2 * parts)).cast("int")
    open_ = sizes.groupBy("component").agg(pieces.alias("pieces"), F.max(F.col("joined") != F.col("component")).alias("open"))
    open_ = open_.where("open").drop("open").withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    dealt = rows.withColumn("piece", F.pmod("node", F.lit(PIECES)).cast("int")).join(open_, ["component", "piece"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    dealt = dealt.join(nodes.select("node", *PRINT), "node").join(sets, "node")
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, pieces - 1)")))
    run = F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(run.alias("run"), "node", "joined", "own", *PRINT, "shingles")
    dealt = dealt.repartition("run").sortWithinPartitions("run")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs_with_sets(batches):
            found, groups, own = (rows.column(c).to_numpy() for c in ("node", "joined", "own"))
            prints = np.stack([rows.column(p).to_numpy() for p in PRINT], axis=1).view(np.uint64)
            left, right = alike_rows(prints, rows.column("shingles").combine_chunks(), groups, own, similarity, radius)
            yield pa.RecordBatch.from_arrays([pa.array(found[left]), pa.array(found[right])], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _runs_with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each run, whole."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = batch.column("run").to_numpy()
        starts = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist()]
        for start, stop in zip(starts, [*starts[1:], len(runs)], strict=True):
            if held and held[-1].column("run")[0].as_py() != runs[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def alike_rows(
    prints: np.ndarray, sets: pa.ListArray, groups: np.ndarray, own: np.ndarray, similarity: float, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that join all rows within ``radius`` bits whose sets are similar.

    Rows of equal ``groups`` are joined already.  If there are two pieces (``own``), only rows
    of different ones are compared.
    """
    label = np.unique(groups, return_inverse=True)[1]
    numbers, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    sizes = pc.list_value_length(sets).to_numpy().astype(np.int64)
    stops = np.cumsum(sizes)
    in_row = [flat[stop - size : stop] for stop, size in zip(stops.tolist(), sizes.tolist(), strict=True)]
    mark, open_, two = np.zeros(len(numbers), bool), np.ones(len(prints), bool), (own != own[0]).any()
    # two rows that are joined to this one need no comparison
    most = int(np.flatnonzero(label == np.argmax(np.bincount(label)))[0])
    left, right = [], []
    for row in range(len(prints)):
        if label[row] == label[most]:
            continue
        open_[row] = False
        other = open_ & (label != label[row])
        # sets of sizes further apart can't be similar
        other &= np.minimum(sizes, sizes[row]) >= similarity * np.maximum(sizes, sizes[row])
        if two:
            other &= own != own[row]
        others = np.flatnonzero(other)
        others = others[np.bitwise_count(prints[others] ^ prints[row]).sum(axis=1) <= radius]
        mark[in_row[row]] = True
        for at in others.tolist():
            if label[at] == label[row]:
                continue
            both = np.count_nonzero(mark[in_row[at]])
            if both >= similarity * (sizes[row] + sizes[at] - both):
                left.append(row)
                right.append(at)
                label[label == label[at]] = label[row]
        mark[in_row[row]] = False
    return np.array(left, np.int64), np.array(right, np.int64)


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar.  A set that many pairs ask for is copied for each SET_ROWS of them."""
    pairs = checkpointed(pairs)
    rows, copies = pairs, {}
    # the copies are numbered while rows are narrow; the sets come after
    for end, other in (("a", "b"), ("b", "a")):
        asked = pairs.groupBy(end).agg(F.ceil(F.count(F.lit(1)) / SET_ROWS).cast("int").alias("copies"))
        rows = rows.join(asked, end).withColumn(f"{end}_copy", F.pmod(F.xxhash64(other), F.col("copies")).cast("int")).drop("copies")
        copies[end] = asked.withColumn(f"{end}_copy", F.explode(F.expr("sequence(0, copies - 1)"))).drop("copies")
    for end, asked in copies.items():
        given = asked.join(sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set")), end)
        rows = rows.join(given, [end, f"{end}_copy"])
    sizes = F.size("a_set") + F.size("b_set")
    both = F.size(F.array_intersect("a_set", "b_set"))
    return rows.where(both >= F.lit(similarity) * (sizes - both)).select("a", "b")


def shingle_sets(docs: DataFrame, ends: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): the distinct 64-bit hashes of the shingles of each node's text."""
    ids = ends.select(F.col("first").alias("__first")).distinct()
    texts = docs.join(ids, F.col("doc_id") == F.col("__first"), "left_semi").select(F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _slices(batch.column("text").to_pylist()):
                numbers = prints_of(texts, shingle).view(np.int64)
                sets = [[xxhash.xxh3_64_intdigest(g) - (1 << 63) for g in shingles(t, shingle)] for t in texts]
                columns = [*(pa.array(np.ascontiguousarray(numbers[:, j])) for j in range(WORDS)), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [*PRINT, "shingles"])

    made = texts.mapInArrow(run, ", ".join(f"{p} long" for p in PRINT) + ", shingles array<long>")
    made = made.select(F.xxhash64(*PRINT).alias("node"), "shingles")
    return made.join(ends, "node", "left_semi").dropDuplicates(["node"])


def wide_prints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, p0 to p3): the fingerprint as signed 64-bit numbers.  No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [prints_of(texts, shingle) for texts in _slices(batch.column("text").to_pylist())]
            numbers = np.concatenate([np.zeros((0, WORDS), np.uint64), *prints]).view(np.int64)
            columns = [batch.column("doc_id"), *(pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *PRINT])

    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{p} long" for p in PRINT))


def _slices(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """``texts`` in runs of about SLICE_BYTES."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= SLICE_BYTES or i + 1 == len(texts):
            yield texts[start : i + 1]
            start, size = i + 1, 0


def shingles(text: bytes | None, shingle: int) -> set[bytes]:
    """The distinct shingles of a text."""
    words = text.lower().split() if text else []
    if len(words) < shingle:
        return {b" ".join(words)} if words else set()
    return {b" ".join(g) for g in zip(*(words[j:] for j in range(shingle)), strict=False)}


def prints_of(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """A row of four numbers per text: a bit is 1 if set in over half of the hashes of its distinct shingles."""
    digest, seeds = xxhash.xxh3_128_digest, range(WORDS // 2)
    out = np.zeros((len(texts), WORDS), np.uint64)
    for i, text in enumerate(texts):
        joined = shingles(text, shingle)
        if not joined:
            continue
        hashes = np.frombuffer(b"".join(digest(g, s) for g in joined for s in seeds), np.uint8).reshape(len(joined), -1)
        ones = np.zeros(64 * WORDS, np.int64)
        for low in range(0, len(hashes), 1 << 16):
            ones += np.unpackbits(hashes[low : low + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")
    return out


def keys_of(prints: np.ndarray) -> np.ndarray:
    """For each fingerprint its keys, a column for each of every shuffle's."""
    bits, keys = bits_of(prints), []
    for shuffle in range(SHUFFLES):
        order = np.random.default_rng(shuffle).permutation(64 * WORDS)
        packed = np.ascontiguousarray(np.packbits(bits[:, order], axis=1, bitorder="little"))
        keys.append(packed.view(f"<u{KEY_BITS // 8}").astype(np.int64))
    keys = np.concatenate(keys, axis=1)
    return keys + (np.arange(keys.shape[1], dtype=np.int64) << KEY_BITS)


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that join all ``node`` with an equal key within ``radius`` bits, a spanning set of each key's links."""
    columns = ", ".join(f"{p} long" for p in PRINT)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                prints = np.stack([some.column(p).to_numpy() for p in PRINT], axis=1).view(np.uint64)
                keys = keys_of(prints)
                at = np.repeat(np.arange(len(prints)), keys.shape[1])
                same = [pa.array(some.column(c).to_numpy()[at]) for c in ("node", *PRINT)]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *same], ["key", "node", *PRINT])

    rows = nodes.mapInArrow(keyed, f"key long, node long, {columns}")
    hot = rows.groupBy("key").count().where(F.col("count") > MOST_ROWS)
    hot = checkpointed(hot.select("key", F.ceil(F.col("count") * 2 / MOST_ROWS).cast("int").alias("pieces")))
    if hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    rows = rows.join(hot, "key", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    # the rows of a hot key meet as pairs of pieces
    own = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, pieces - 1)")))
    run = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = rows.select(run.alias("run"), "node", *PRINT).repartition("run").sortWithinPartitions("run")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, found, prints in _whole_runs(batches):
            left, right = linked_rows(runs, prints, radius)
            yield pa.RecordBatch.from_arrays([pa.array(found[left]), pa.array(found[right])], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(runs, nodes, fingerprints) of whole runs, at least PLANE_ROWS at a time; a run has at most a few MOST_ROWS."""
    held = np.zeros((0, 2 + WORDS), np.int64)
    for batch in batches:
        held = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("run", "node", *PRINT)], axis=1)])
        if len(held) >= PLANE_ROWS:
            whole = int(np.searchsorted(held[:, 0], held[-1, 0]))
            if whole:
                yield _columns(held[:whole])
                held = held[whole:]
    if len(held):
        yield _columns(held)


def _columns(held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return held[:, 0].copy(), held[:, 1].copy(), np.ascontiguousarray(held[:, 2:]).view(np.uint64)


def linked_rows(runs: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that join all rows of one run within ``radius`` bits."""
    starts = np.concatenate([[0], np.flatnonzero(runs[1:] != runs[:-1]) + 1])
    sizes = np.diff(np.append(starts, len(runs)))
    small = np.flatnonzero(np.repeat(sizes <= SMALL_RUN, sizes))
    a, b = spanning_rows(runs[small], prints[small], radius) if len(small) else (small, small)
    left, right = [small[a]], [small[b]]
    for start, size in zip(starts[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist(), strict=True):
        a, b = joined(prints[start : start + size], radius)
        left.append(a + start)
        right.append(b + start)
    return np.concatenate(left), np.concatenate(right)


def joined(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join all ``prints`` within ``radius`` bits.

    Blocks of rows are compared with all rows, until every row outside the largest
    group has been: two rows of that group need no comparison, they are joined.
    """
    planes, bits = bit_planes(prints), bits_of(prints).T
    label, open_ = np.arange(len(prints)), np.ones(len(prints), bool)
    left, right = [], []
    while True:
        largest = np.argmax(np.bincount(label))
        block = np.flatnonzero(open_ & (label != largest))[:BLOCK]
        if not len(block):
            return np.array(left, np.int64), np.array(right, np.int64)
        open_[block] = False
        near = _near_block(planes, bits[:, block], len(prints), radius)
        for row, found in zip(block.tolist(), near, strict=True):
            groups, first = np.unique(label[found], return_index=True)
            for group, at in zip(groups.tolist(), np.flatnonzero(found)[first].tolist(), strict=True):
                if group != label[row]:
                    left.append(row)
                    right.append(at)
                    low, high = sorted((group, int(label[row])))
                    label[label == high] = low


def _near_block(planes: np.ndarray, bits: np.ndarray, rows: int, radius: int) -> np.ndarray:
    """For each fingerprint of a block (a column of ``bits``), which rows differ in at most ``radius`` bits."""
    words = -(-rows // 64)
    masks = np.uint64(0) - bits.astype(np.uint64)
    digits = [np.zeros((bits.shape[1], words), np.uint64) for _ in range(max(1, radius.bit_length()))]
    far = np.zeros((bits.shape[1], words), np.uint64)
    if rows % 64:
        far[:, -1] = ~np.uint64(0) << np.uint64(rows % 64)
    every = len(planes) // 16
    for bit, (plane, mask) in enumerate(zip(planes, masks, strict=True)):
        count_bit(digits, far, plane[None, :words] ^ mask[:, None])
        if bit % every == every - 1 and all_far(digits, far, radius):
            break
    near = np.unpackbits((~far).astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return near[:, :rows].astype(bool)
