"""Operators on documents, against plain Python over small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from codeledger.llm import backoff_join, decontamination, lm_scores, near_copies, quality, sentencepiece_codec, simhash, substring_dedup
from codeledger.llm.packing import cut, distinct, pack, pack_sorted, rolling, unpack, unpack_sorted

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
RANDOM = random.Random(7)
VOCABULARY = [f"w{i}" for i in range(400)]


def words(text):
    return SPACE.findall(text or "")


def prose(n):
    return " ".join(RANDOM.choice(VOCABULARY) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, repeated rows and ids, nulls, blanks and a long text."""
    passage, base = prose(60), prose(300)
    rows = [(i, prose(RANDOM.randrange(1, 120))) for i in range(30)]
    rows += [(100 + i, base) for i in range(6)]
    rows += [(120 + i, base.replace(" ", "\n", i) + f" extra{i}") for i in range(5)]
    rows += [(140 + i, f"{prose(30)}\n{passage}\t{prose(30)}") for i in range(6)]
    rows += [(160, ""), (161, None), (162, " \n\t"), (163, "\x1f a\x0bb  c"), (164, "one two"), (165, "One two")]
    rows += [(170, prose(6000)), (171, "x " * 5000), (5, base), (5, base), (None, base), (None, prose(20) + " " + passage)]
    return rows


def test_packing_round_trips():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2))
    assert (unpack_sorted(pack_sorted(keys)) == keys).all()
    counts = np.arange(300, dtype=np.uint32)
    assert (unpack(pack(counts), np.uint32) == counts).all()
    assert len(unpack(pack(counts[:0]), np.uint32)) == 0
    blocks = cut(keys, 7)
    assert [b[1] for b in blocks] == [0, *(b[2] for b in blocks[:-1])] and blocks[-1][2] == len(keys)
    assert [b[0] for b in blocks] == sorted({b[0] for b in blocks}) and cut(keys[:0], 7) == []


@pytest.mark.parametrize("width", [1, 2, 3, 8, 13, 16])
def test_rolling_hash_is_the_polynomial(width):
    values = np.random.default_rng(2).integers(0, 2**63, 40, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    want = []
    for i in range(len(values) - width + 1):
        total = 0
        for v in values[i : i + width].tolist():
            total = (total * base + v) % 2**64
        want.append(total)
    assert rolling(values, width, base).tolist() == want
    assert len(rolling(values[: width - 1], width, base)) == 0


def test_equal_keys_with_other_checks_stay_apart():
    order, first = distinct(np.array([5, 5, 5, 1], np.uint64), np.array([2, 1, 2, 9], np.uint16))
    assert order.tolist() == [3, 1, 0, 2] and first.tolist() == [True, True, True, False]


def repeats_by_hand(rows, window=13):
    holder = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            holder[key] = min(holder.get(key, math.inf), math.inf if doc is None else doc)
    out = []
    for doc, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            if holder[tuple(w[i : i + window])] < (math.inf if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_bytes, phrases", [(24 << 20, 32_000), (4_000, 5)])
def test_repeats(documents, monkeypatch, shard_bytes, phrases):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(substring_dedup, "PART_KEYS", shard_bytes // 4)
    monkeypatch.setattr(substring_dedup, "AUTOMATON_PHRASES", phrases)
    rows = corpus()
    # columns that clash with results and with inner names
    docs = documents(rows).withColumns({"N_Words": F.lit("x"), "part": F.lit(1)})
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "part", "n_words", "n_removed", "kept_sha256"]
    kept = got.collect()
    found = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in kept], key=str)
    assert found == repeats_by_hand(rows)
    for r in kept:
        assert hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest() == r.kept_sha256
        if not r.n_removed:
            assert (r.doc_id, r.text) in rows


def test_automata_find_every_occurrence(monkeypatch):
    monkeypatch.setattr(substring_dedup, "AUTOMATON_PHRASES", 7)
    rows = [(d, t) for d, t in corpus() if d is not None]
    table = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    shard = substring_dedup._Shard(substring_dedup._in_order(table), 13)
    places = shard.at[::37]
    phrases = {tuple(shard.words[p : p + 7]) for p in places}
    want = [tuple(shard.words[i : i + 7]) in phrases for i in range(len(shard.words))]
    assert substring_dedup._occurrences(shard, places, 7).tolist() == want


def test_matches_decide_what_is_removed(monkeypatch):
    rows = [(d, t) for d, t in corpus() if d is not None]
    table = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    shard = substring_dedup._Shard(substring_dedup._in_order(table), 13)
    looked = []

    def equal(shard, around, *rest):
        looked.append(len(around))
        return compare(shard, around, *rest)

    compare, locate = substring_dedup._equal_windows, substring_dedup._occurrences
    monkeypatch.setattr(substring_dedup, "_equal_windows", equal)
    none = np.zeros(int(shard.first.sum()), bool)
    gone = []
    for found in (locate, lambda s, *_: np.ones(len(s.words), bool), lambda s, *_: np.zeros(len(s.words), bool)):
        monkeypatch.setattr(substring_dedup, "_occurrences", found)
        gone.append(substring_dedup._covered(shard, none, 13))
    # without matches nothing is compared and nothing goes; with matches everywhere all is compared and no more goes
    assert gone[0].any() and (gone[0] == gone[1]).all() and not gone[2].any()
    assert looked[2] == 0 < looked[0] < looked[1] == len(shard.at)


def test_words_decide_where_hashes_are_equal(monkeypatch):
    monkeypatch.setattr(substring_dedup, "rolling", lambda hashes, width, base: np.zeros(max(0, len(hashes) - width + 1), np.uint64))
    rows = [(1, prose(40)), (2, prose(60)), (3, prose(30))]
    rows.append((4, " ".join(rows[1][1].split()[10:40])))
    table = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    shard = substring_dedup._Shard(substring_dedup._in_order(table), 13)
    around, places = np.arange(len(shard.at)), shard.at[shard.docs == 1]
    after = np.full(len(places), 2)
    equal = substring_dedup._equal_windows(shard, around, np.zeros(len(places), np.uint64), places, after, 13)
    assert sorted(equal.tolist()) == np.flatnonzero(shard.docs == 3).tolist()


@pytest.mark.parametrize("window", [1, 2, 5, 8, 13])
def test_every_window_of_a_passage_holds_a_phrase(window):
    begin = np.array([3, *range(20, 61), 70, 71, *range(100, 107)])
    places, length = set(substring_dedup._phrases(begin, window).tolist()), substring_dedup._phrase_length(window)
    for b in begin:
        assert any(p in places for p in range(b, b + window - length + 1))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))


def test_sentencepiece(documents, library):
    rows = [*corpus(), (200, "é 𝒳 ﬁ  x▁y\t z  "), (201, "</s> <s> a"), (202, " "), (203, "日本語 テキスト\n\n")]
    docs = documents(rows).withColumn("N_TOKENS", F.lit("clash"))
    got = sentencepiece_codec.encode(docs, pieces=True).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(list)
    for doc, text in rows:
        ids = library.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        by_text[doc].append((len(ids), digest, decoded))
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in by_text[r.doc_id]
    text = dict(rows)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        if r.doc_id is None or r.doc_id == 5 or not data:
            continue
        # spans are in order, without gaps, and give the text again
        assert r.starts[0] == 0 and r.ends[-1] == len(data) == r.covered_bytes
        assert r.starts[1:] == r.ends[:-1]
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends, strict=True)) == data


def trie(entries):
    """A character map in the compiled form: a double array of the prefixes, then the replacements."""
    texts, offsets = b"", {}
    for prefix, text in entries.items():
        offsets[prefix] = len(texts)
        texts += text + b"\0"
    units, used = {0: 0}, {0}

    def place(node, prefix):
        labels = sorted({p[len(prefix)] for p in entries if p.startswith(prefix) and len(p) > len(prefix)})
        leaf = prefix in entries
        slots = ([0] if leaf else []) + labels
        base = next(b for b in range(1, 5000) if all(node ^ b ^ s not in used for s in slots))
        used.update(node ^ base ^ s for s in slots)
        units[node] = units.get(node, 0) & 0xFF | (0x100 if leaf else 0) | base << 10
        if leaf:
            units[node ^ base] = 0x80000000 | offsets[prefix]
        for s in labels:
            units[node ^ base ^ s] = s
            place(node ^ base ^ s, prefix + bytes([s]))

    place(0, b"")
    array = np.zeros(max(units) + 256, "<u4")
    for at, unit in units.items():
        array[at] = unit
    return len(array.tobytes()).to_bytes(4, "little") + array.tobytes() + texts


def test_longest_prefix_in_the_character_map():
    entries = {"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"<ab>", b"\t": b" ", "é".encode(): b""}
    rules = sentencepiece_codec.CharacterMap(trie(entries))
    data = "xabaé\tﬁ日".encode()
    at, out = 0, []
    while at < len(data):
        size, text = rules.longest(data, at)
        out.append((data[at : at + size].decode(), text.decode()))
        at += size
    assert out == [("x", "x"), ("ab", "<ab>"), ("a", "A"), ("é", ""), ("\t", " "), ("ﬁ", "fi"), ("日", "日")]


def test_normalised_bytes_lead_back_to_their_source():
    codec = sentencepiece_codec.codec(sentencepiece_codec.MODEL)
    own = object.__new__(sentencepiece_codec.Codec)
    own.__dict__.update(codec.__dict__, map=sentencepiece_codec.CharacterMap(trie({"ﬁ".encode(): b"fi"})), squeeze=True)
    text, places = own.normalise("  ﬁ  n ".encode())
    assert text.decode() == "▁fi▁n"
    assert places.tolist() == [2, 2, 2, 2, 2, 5, 5, 5, 7, 9]


def simhash_by_hand(text, shingle=3):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words(lower)
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, radius=3):
    """Index of the first member of each item's component."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_simhash_groups(documents):
    rows = corpus()
    got = simhash.near_duplicates(documents(rows).withColumn("component", F.lit(0))).collect()
    prints = [simhash_by_hand(t) for _, t in rows]
    groups = groups_by_hand(prints)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    want = [(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, groups, strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def grams_by_hand(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()


def wide_by_hand(text):
    grams = grams_by_hand(text)
    hashes = [int.from_bytes(b"".join(xxhash.xxh3_128_digest(g.encode(), s) for s in (0, 1)), "little") for g in grams]
    return sum(1 << b for b in range(256) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups_by_hand(rows):
    """{doc_id: least doc_id of its group}: an equal key, at most RADIUS bits apart, and 0.8 of the shingles shared."""
    orders = [np.random.default_rng(k).permutation(256).tolist() for k in range(near_copies.SHUFFLES)]
    masks = [sum(1 << b for b in order[i : i + 16]) for order in orders for i in range(0, 256, 16)]
    rows = [(d, wide_by_hand(t), grams_by_hand(t)) for d, t in rows if d is not None]
    least = {d: d for d, _, _ in rows}
    for _ in rows:
        before = dict(least)
        for a, x, p in rows:
            for b, y, q in rows:
                near = (x ^ y).bit_count() <= near_copies.RADIUS and any(not (x ^ y) & m for m in masks)
                if x == y or near and 5 * len(p & q) >= 4 * len(p | q):
                    least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return least


@pytest.mark.parametrize("small, most", [(64, 8192), (2, 8192), (2, 4)])
def test_near_copies(documents, llm, monkeypatch, small, most):
    """Copies with some words changed go; texts that share a passage, null ids and other texts stay."""
    monkeypatch.setattr(near_copies, "SMALL_RUN", small)
    monkeypatch.setattr(near_copies, "MOST_ROWS", most)
    monkeypatch.setattr(near_copies, "PLANE_ROWS", 50)
    monkeypatch.setattr(near_copies, "BLOCK", 3)
    base, passage = prose(300), prose(100)
    rows = [(100 + i, prose(60)) for i in range(10)] + [(200 + i, f"{prose(100)} {passage}") for i in range(4)]
    for i in range(12):
        changed = base.split()
        for at in range(i % 4):
            changed[20 + 70 * at + i] = f"new{i}"
        rows.append((300 + i, " ".join(changed)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "few words"), (5, "FEW words"), (None, base), (None, None), (300, base)]
    docs = documents(rows).withColumn("component", F.lit(0)).withColumn("p0", F.lit("clash"))
    want = near_groups_by_hand(rows)
    got = near_copies.near_copies(docs).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, want[d]) for d, _ in rows if d is not None)
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(d) for d, _ in rows if d is None or want[d] == d)
    assert sorted(i for i in ids if i is not None) == [1, 4, *range(100, 110), *range(200, 204), 300, 300]


@pytest.mark.parametrize("pieces", [256, 3])
def test_only_similar_links_stand(documents, llm, monkeypatch, pieces):
    """Every pair that is near by its bits is given; what stays are the groups by exact similarity."""
    monkeypatch.setattr(near_copies, "SET_ROWS", pieces)
    rows, base = [], prose(200).split()
    for i in range(24):  # each text is further from the first
        base[8 * i] = f"other{i}"
        rows.append((i, " ".join(base)))
    rows += [(50 + i, " ".join(base[: 100 + 12 * i])) for i in range(6)]
    docs = documents(rows)
    prints = near_copies.wide_prints(docs, 5)
    nodes = prints.withColumnRenamed("doc_id", "first").withColumn("node", F.xxhash64(*near_copies.PRINT)).cache()
    name = {r.node: r.first_ for r in nodes.select("node", F.col("first").alias("first_")).collect()}
    left, right = nodes.select(F.col("node").alias("a")), nodes.select(F.col("node").alias("b"))
    got = near_copies.similar_links(docs, nodes, left.join(right, F.col("a") < F.col("b")), 5, 0.8).collect()
    sets = {d: grams_by_hand(t) for d, t in rows}
    alike = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    found = {tuple(sorted((name[r.a], name[r.b]))) for r in got}
    assert found <= alike and len(alike) < len(sets) * (len(sets) - 1) // 2

    def groups(links):
        least = {d: d for d in sets}
        for _ in sets:
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        return least

    assert groups(found) == groups(alike) and len(set(groups(found).values())) > 1


def template_family(texts=50):
    """Texts of one template, similar by less than 0.8, and for each a copy that shares more than 0.8 of its shingles."""
    numbers, rows = random.Random(2), []
    template = numbers.choices(VOCABULARY, k=200)
    for i in range(texts):
        places = numbers.sample(range(4, 196, 6), 6)
        own = list(template)
        for at in places[:3]:
            own[at] = f"own{i}at{at}"
        twin = list(own)
        for at in places[3:]:
            twin[at] = f"twin{i}at{at}"
        rows += [(i, " ".join(own)), (1000 - i, " ".join(twin))]
    return rows


@pytest.mark.parametrize("group_rows", [2048, 30])
def test_pairs_of_a_family_below_the_similarity_are_found(documents, monkeypatch, group_rows):
    """The texts are near by their bits, so that most pairs met are refused: the groups are those of plain similarity."""
    monkeypatch.setattr(near_copies, "GROUP_ROWS", group_rows)
    rows = template_family()
    sets = {d: grams_by_hand(t) for d, t in rows}
    alike = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert {(i, 1000 - i) for i in range(50)} <= alike
    want = {d: d for d in sets}
    for _ in sets:
        for a, b in alike:
            want[a] = want[b] = min(want[a], want[b])
    assert len(set(want.values())) > 4
    got = near_copies.near_copies(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_rows_alike_are_all_joined():
    """Large groups of random sets, some joined before, in one piece and in two."""
    numbers = np.random.default_rng(2)
    bases = [numbers.choice(200, 40, replace=False) for _ in range(9)]
    sets = [np.sort(numbers.choice(bases[i % 9], 40 - i % 8, replace=False)) for i in range(200)] + [np.zeros(0, np.int64)]
    prints = np.zeros((len(sets), 4), np.uint64)
    prints[::7, 1] = 2**64 - 1
    given = pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))
    for own in (np.zeros(len(sets), np.int32), np.arange(len(sets), dtype=np.int32) % 2):
        for groups in (np.arange(len(sets)), np.arange(len(sets)) // 20):
            left, right = near_copies.alike_rows(prints, given, groups, own, 0.8, 50)
            known = [set(s.tolist()) for s in sets]
            near = {
                (a, b)
                for a in range(len(sets))
                for b in range(len(sets))
                if (prints[a] == prints[b]).all() and (own[0] == own[1] or own[a] != own[b])
                if 5 * len(known[a] & known[b]) >= 4 * len(known[a] | known[b])
            }
            found = set(zip(left.tolist(), right.tolist(), strict=True))
            assert found and found <= near

            def joined(links, groups=groups):
                label = groups.copy()
                for a, b in links:
                    label[label == label[b]] = label[a]
                return {tuple(np.flatnonzero(label == g).tolist()) for g in label}

            assert joined(found) == joined(near)


def test_joined_rows_lose_no_group():
    """Large runs: clusters of several sizes, copies, and rows near to none."""
    numbers = np.random.default_rng(5)
    centres = numbers.integers(0, 2, (6, 256), np.uint8)
    bits = centres[numbers.choice(6, 700, p=[0.6, 0.2, 0.1, 0.05, 0.03, 0.02])] ^ (numbers.random((700, 256)) < 0.07)
    bits = np.concatenate([bits, numbers.integers(0, 2, (30, 256), np.uint8), bits[:5]]).astype(np.uint8)
    prints = np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)
    numbers_of = [int.from_bytes(p.tobytes(), "little") for p in prints]
    runs = np.repeat(np.arange(3), [40, 600, len(prints) - 640])
    left, right = near_copies.linked_rows(runs, prints, 42)
    assert (runs[left] == runs[right]).all()
    assert all((numbers_of[a] ^ numbers_of[b]).bit_count() <= 42 for a, b in zip(left, right, strict=True))
    for run in range(3):
        places = np.flatnonzero(runs == run).tolist()
        group = {p: p for p in places}
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            if runs[a] == run:
                low, high = sorted((group[a], group[b]))
                group = {p: low if g == high else g for p, g in group.items()}
        want = groups_by_hand([numbers_of[p] for p in places], 42)
        assert [group[p] - places[0] for p in places] == want


@pytest.mark.parametrize("radius, blocks, most", [(3, 5, 8192), (3, 5, 16), (2, 4, 64), (1, 2, 64), (4, 6, 64)])
def test_links_lose_no_component(llm, monkeypatch, radius, blocks, most):
    """Clusters around a few centres, also with keys that are dealt to pairs of pieces."""
    monkeypatch.setattr(simhash, "MOST_ROWS", most)
    monkeypatch.setattr(simhash, "PLANE_ROWS", 100)
    numbers = random.Random(radius)
    centres = [numbers.getrandbits(64) for _ in range(12)]
    prints = {0, 2**64 - 1}
    for _ in range(500):
        x = numbers.choice(centres)
        for _ in range(numbers.randrange(5)):
            x ^= 1 << numbers.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = simhash.links(llm.createDataFrame(signed, "print long").repartition(3), radius, blocks).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= radius for r in found)
    at = {s[0]: i for i, s in enumerate(signed)}
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in found:
        a, b = root(at[r.a]), root(at[r.b])
        parent[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(prints))] == groups_by_hand(prints, radius)


def tokens(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def leaks_by_hand(docs, items, similarity=0.8):
    found = {}
    for doc, text in docs:
        d = tokens(text)
        for item, passage in items:
            b = tokens(passage)
            n = min(13, len(b))
            if n < decontamination.SPAN:
                continue
            for i in range(len(d) - n + 1):
                for j in range(len(b) - n + 1):
                    same = sum(x == y for x, y in zip(d[i : i + n], b[j : j + n], strict=True))
                    if same >= math.ceil(n * similarity):
                        found[doc, item] = max(same, found.get((doc, item), 0))
    return sorted((str(d), str(i), n) for (d, i), n in found.items())


def test_decontamination_finds_replaced_words(documents, llm):
    items = [(i, prose(RANDOM.randrange(14, 40))) for i in range(6)] + [(6, prose(9)), (7, prose(5)), (8, ""), (9, None)]
    items.append((10, items[0][1]))
    rows = [(i, prose(60)) for i in range(8)]
    for n in range(24):
        item = items[n % 7][1].split()
        for at in RANDOM.sample(range(len(item)), n % 3 if len(item) > 12 else 0):
            item[at] = "Replaced!"
        rows.append((100 + n, f"{prose(20)} {', '.join(item).upper()} {prose(20)}"))
    rows += [(200, None), (201, ""), (202, rows[10][1]), (202, rows[10][1]), (None, rows[10][1])]
    benchmark = llm.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = decontamination.contaminated(documents(rows), benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.n_equal) for r in got) == leaks_by_hand(rows, items)
    assert {100 + n for n in range(24)} <= {r.doc_id for r in got}
    left = decontamination.remove_contaminated(documents(rows), benchmark)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {r.doc_id for r in got}


def test_masks_fit_beside_any_two_replaced_words():
    for a in range(decontamination.WINDOW):
        for b in range(decontamination.WINDOW):
            places = range(decontamination.WINDOW - decontamination.SPAN + 1)
            assert any(not {a, b} & {s + o for o in mask} for mask in decontamination.MASKS for s in places)


def test_masks_fit_beside_the_replaced_words_of_short_items():
    masks = decontamination.MASKS + decontamination.SHORT_MASKS
    for n in range(decontamination.SPAN, decontamination.WINDOW):
        for hidden in combinations(range(n), n - math.ceil(n * decontamination.SIMILARITY)):
            assert any(not {*hidden} & {s + o for o in mask} for mask in masks for s in range(n - mask[-1]))


def test_decontamination_finds_every_replacement_in_short_items(documents, llm):
    numbers = random.Random(11)
    items = [(n, " ".join(numbers.sample(VOCABULARY, n))) for n in (7, 8, 9, 10, 11, 12, 20)]
    rows = []
    for n, text in items:
        for hidden in combinations(range(n), min(2, n - math.ceil(n * 0.8))):
            changed = ["other" if i in hidden else w for i, w in enumerate(text.split())]
            rows.append((len(rows), " ".join([*["left"] * (len(rows) % 3), *changed, *["right"] * (len(rows) % 4)])))
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(documents(rows), benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.n_equal) for r in got) == leaks_by_hand(rows, items)
    found = Counter(r.item_id for r in got)
    assert [found[n] for n in (7, 8, 9, 10, 11, 12)] == [0, 8, 9, 45, 55, 66]


def quality_by_hand(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(documents):
    block = prose(9)
    rows = [*corpus(), (300, f"{block} {block} {prose(60)}"), (301, "\n".join([prose(6)] * 3 + [" ", " "] + [prose(30)])), (302, "é# <" * 40)]
    got = quality.measured(documents(rows).withColumn("n_words", F.lit("clash"))).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted(map(str, found)) == sorted(str((d, *quality_by_hand(t))) for d, t in rows)


def test_quality_follows_each_source(llm):
    """A share of symbols that is normal for one source is not for another."""
    rows = [(i, prose(50), "en", "plain") for i in range(40)] + [(100 + i, prose(50) + " |" * 20, "en", "tables") for i in range(40)]
    rows += [(200, prose(50) + " |" * 20, "en", "plain"), (201, prose(50), None, None), (202, prose(5), None, None), (203, None, "en", "plain")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == set(range(40)) | set(range(100, 140)) | {201}


def test_quality_keeps_the_middle_of_wide_bins(llm):
    """Unspaced scripts: words of 50 characters and more, where a bin is wider than the least reach."""
    rows = []

    def add(source, total):
        parts = [total // 25 + (i < total % 25) for i in range(25)]
        rows.append((len(rows), " ".join(f"{i:02d}".ljust(n, "字") for i, n in enumerate(parts)), "zh", source))

    for length in (5100, 10000):
        add(f"one {length}", length // 4)
        low = {5100: 4864, 10000: 9728}[length]
        for i in range(40):
            add(f"uniform {length}", (low + 4 + i * (low // 19 - 8) // 40) // 4)
    normal = len(rows)
    add("uniform 5100", 10000)
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == set(range(normal))


def test_sketches_merge(documents):
    rows = quality.measured(documents(corpus()))
    halves = quality.sketches(rows.where("doc_id % 2 = 0")).union(quality.sketches(rows.where("doc_id % 2 = 1 or doc_id is null")))
    merged = halves.groupBy("lang", "source", "measure", "bin").agg(F.sum("n").alias("n"))
    assert sorted(merged.collect()) == sorted(quality.sketches(rows).collect())


def backoff_by_hand(rows, order=3, min_count=2, alpha=0.4):
    counts = Counter()
    for _, text in rows:
        w = words(text)
        counts.update(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)

    def micro(x):
        return round(1e6 * math.log(x))

    out = []
    for doc, text in rows:
        w, score, alone = words(text), 0, 0
        for i in range(len(w)):
            longest = min(order, i + 1)
            n = longest
            while n > 1 and counts[tuple(w[i - n + 1 : i + 1])] < min_count:
                n -= 1
            gram = tuple(w[i - n + 1 : i + 1])
            score += micro(counts[gram]) - micro(counts[gram[:-1]] if n > 1 else total) + (longest - n) * micro(alpha)
            alone += n == 1
        out.append((doc, len(w), alone, score))
    return sorted(map(str, out))


@pytest.mark.parametrize("shard_bytes, order", [(32 << 20, 3), (4_000, 3), (4_000, 1), (4_000, 5)])
def test_backoff(documents, monkeypatch, shard_bytes, order):
    monkeypatch.setattr(lm_scores, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lm_scores, "PART_KEYS", shard_bytes)
    rows = corpus()
    got = lm_scores.score(documents(rows).withColumn("n_words", F.lit("clash")), order=order).collect()
    assert sorted(str(tuple(r)) for r in got) == backoff_by_hand(rows, order)


@pytest.mark.parametrize("order, min_count", [(3, 2), (3, 1), (1, 2), (5, 2)])
def test_backoff_by_joins(documents, order, min_count):
    rows = corpus()
    got = backoff_join.score(documents(rows).withColumn("n_words", F.lit("clash")), order=order, min_count=min_count).collect()
    assert sorted(str(tuple(r)) for r in got) == backoff_by_hand(rows, order, min_count)


def test_empty_tables(documents, llm):
    docs = documents([])
    benchmark = llm.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert sentencepiece_codec.encode(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert near_copies.near_copies(docs).count() == 0
    assert near_copies.keep_first(docs).columns == docs.columns
    assert near_copies.keep_first(docs).count() == 0
    assert decontamination.contaminated(docs, benchmark).count() == 0
    assert decontamination.remove_contaminated(documents([(1, prose(30))]), benchmark).count() == 1
    assert quality.keep_good(docs).count() == 0
    assert lm_scores.score(docs).count() == 0
    assert backoff_join.score(docs).count() == 0
