"""Operators on urls, archives, token files, conversations and graphs, and the pipeline."""

import glob
import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from test_texts import corpus, leaks_by_hand, near_groups_by_hand, prose, quality_by_hand, repeats_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from codeledger.llm import near_copies, quality, quotes, simhash, token_frames, url_filters, warc
from codeledger.llm.components import components


def roots(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None:
            continue
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components(llm, seed):
    numbers = random.Random(seed)
    edges = [(numbers.randrange(300), numbers.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1064)] + [(2000, 2000 + i) for i in range(200)]
    edges += [(5, None), (None, 6), (7, 7), edges[0], edges[0][::-1]]
    found = components(llm.createDataFrame(edges, "a long, b long")).collect()
    want = roots([e for e in edges if e[0] != e[1]])
    assert len(found) == len(want) and {r.node: r.component for r in found} == want


PAGES = [
    (1, "http://a.net/x", '<link rel="canonical" href="https://B.example.org/en/12">'),
    (2, "http://b.example.org/en/12#z", ""),
    (3, "HTTP://C.net/", "<META http-equiv=refresh content='0; url=/q?x'>"),
    (4, "http://c.net/q?x", "<link href='//a.net/x' rel=canonical>"),
    (5, None, None),
    (6, "no scheme", "<link rel=canonical href=http://a.net/x>"),
    (7, "http://z.net/a/b", "<link rel=canonical href=c>"),
    (8, "http://z.net/a/c", None),
    (9, "http://www.shop.com/de/1", "<link rel=canonical href='http://allowed.org/1'>"),
    (10, "http://mixed.net/", "<link rel=canonical href='http://shop.com/de/2'><link rel='canonical' href='http://allowed.org/1'>"),
    (11, "http://example.org/es/1", ""),
    (12, "http://x.example.org/en/2", ""),
    (13, "http://notexample.org/es/", ""),
    (14, "http://example.org", ""),
    (15, "http://target.net/", "<link rel=canonical href='http://shop.com/de/not-a-page'>"),
    (8, "http://z.net/a/c", None),
]
JUDGED = {
    1: ("a.net", "/x", None, "block"),
    2: ("b.example.org", "/en/12", "example.org/en/1", "block"),
    3: ("c.net", "/", None, "block"),
    4: ("c.net", "/q", None, "block"),
    5: ("", "", None, "allow"),
    6: ("", "", None, "allow"),
    7: ("z.net", "/a/b", None, "allow"),
    8: ("z.net", "/a/c", None, "allow"),
    9: ("www.shop.com", "/de/1", "com/de/", "block"),
    10: ("mixed.net", "/", None, "allow"),
    11: ("example.org", "/es/1", "example.org/es/", "block"),
    12: ("x.example.org", "/en/2", "org/", "allow"),
    13: ("notexample.org", "/es/", "org/", "allow"),
    14: ("example.org", "", None, "allow"),
    15: ("target.net", "/", None, "block"),
}


def test_urls(llm):
    pages = llm.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = url_filters.judge_urls(pages.repartition(4)).collect()
    assert len(found) == len(PAGES)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found} == JUDGED


def archived(pages):
    folder = warc.write_archives(pages)
    return folder, warc.merged_index(warc.read_runs(pages.sparkSession, folder))


def test_archives(llm, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3_000)
    monkeypatch.setattr(warc, "RANGE_ROWS", 7)
    long, numbers = "é" * 50, random.Random(3)
    rows = [(i, f"http://h{i % 5}.net/{i % 3}", numbers.choice([long, long + "!", "short", "x" * 99, "y" * 100])) for i in range(60)]
    rows += [(100, None, "\r\n\r\nWARC/1.1\r\n" * 20), (101, "http://a.b/\r\nX: y", ""), (102, "", None), (None, "u", long), (7, "u", "z" * 500)]
    rows += [(110, "u", "r" * 200), (110, "u", "r" * 200), (None, "u", "n" * 300), (None, "u", "n" * 300), (111, "http://long.net", "w " * 200_000)]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    folder, index = archived(pages)
    found = index.collect()
    # globally ordered, whatever the ranges
    assert [warc._order(tuple(r)) for r in found] == sorted(warc._order(tuple(r)) for r in found)
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html] = min(page, first.get(html, page))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        origin = first.get(html) if len(data) >= 100 else None
        revisit = origin is not None and (page is None or page > origin)
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", origin if revisit else None))
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found))) == sorted(map(str, want))
    # offsets lead to the records
    files = {p.rpartition("/")[2]: open(p, "rb").read() for p in glob.glob(folder.removeprefix("file:") + "/part*")}
    assert len(files) > 3
    for r in found:
        record = files[r.archive][r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_decisions_reach_the_pages_without_a_shuffle_of_html(llm, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", limit)
    threshold = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold if limit else "-1")
    pages = [(i, f"http://a.net/{i}", "x" * 90 + str(i % 3) * 20) for i in range(9)] + [(None, None, "x" * 90 + "0" * 20)]
    frame = llm.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.sha2("html", 256))
    decided = warc._decided(frame)
    assert sorted((str(r.page_id), r.first) for r in decided.collect()) == sorted(
        [(str(i), None if i < 3 else i % 3) for i in range(9)] + [("None", 0)]
    )
    plan = decided._jdf.queryExecution().executedPlan().toString()
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ("Exchange hashpartitioning" in plan) == (not limit) and ("BroadcastExchange" in plan) == bool(limit)


@pytest.mark.parametrize("seed", range(30))
def test_loser_tree(seed):
    numbers = random.Random(seed)
    runs = [sorted((str(numbers.randrange(9)), "t", numbers.randrange(4), n) for _ in range(numbers.randrange(8))) for n in range(numbers.randrange(9))]
    got = list(warc.loser_tree_merge(runs, lambda row: row[:3]))
    assert got == sorted((x for r in runs for x in r), key=lambda row: (row[:3], row[3]))


@pytest.mark.parametrize("file_bytes", [32 << 20, 2_000])
def test_token_files(documents, llm, monkeypatch, file_bytes):
    monkeypatch.setattr(token_frames, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(token_frames, "PARTITION_BYTES", file_bytes * 4)
    rows = [*corpus(), (200, "it's <|endoftext|> É é İ don't,yes"), (201, "½ ² 日本語 x́ Σίσυφος")]
    folder = token_frames.write_tokens(documents(rows).withColumn("ids", F.lit("clash")))
    found = token_frames.read_tokens(llm, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path(token_frames.TOKENIZER))
    ids = defaultdict(list)
    for doc, text in rows:
        own = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        ids[doc].append((len(own), zlib.crc32(own.tobytes())))
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in found))) == sorted(str((d, *x)) for d, own in ids.items() for x in own)
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert order == sorted(order)


def test_a_reader_decompresses_what_it_is_asked_for(monkeypatch):
    frames = [zstandard.ZstdCompressor().compress(np.arange(n, dtype="<u2").tobytes()) for n in (3, 0, 5)]
    sizes = [6, 0, 10]
    sums = [token_frames.xxhash.xxh64_intdigest(np.arange(s // 2, dtype="<u2").tobytes()) & 0xFFFFFFFF for s in sizes]
    index = struct.pack("<4I", 0, 0, 2, 3) + np.array([4, 0, 9], "<i8").tobytes() + bytes([0, 1, 0])
    table = [(len(f), s, c) for f, s, c in zip(frames, sizes, sums, strict=True)]
    data = token_frames.closed_file(frames, table, index) + token_frames.FOOTER_MAGIC
    # any zstandard reader sees the frames and skips the rest
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data).startswith(np.arange(3, dtype="<u2").tobytes())
    file = token_frames.TokenFile(data)
    assert file.doc_ids == [4, None, 9]
    assert [(d, i.tolist()) for d, i in file.documents([9])] == [(9, [0, 1, 2, 3, 4])]
    broken = bytearray(data)
    broken[len(frames[0]) + len(frames[1]) + len(frames[2]) - 1] ^= 1
    damaged = token_frames.TokenFile(bytes(broken))
    assert damaged.ids(0).tolist() == [0, 1, 2]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.ids(2)
    with pytest.raises(ValueError):
        token_frames.TokenFile(data[:-1])


MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?"),
    (1, 1, "assistant", "On Monday A wrote:\n> Hello there.\n> How are you?\n\nFine, thanks."),
    (1, 2, "user", "> > how are you\n> Fine, thanks.\n\nGood."),
    (2, 0, "user", "> Fine,   THANKS\nOther"),
    (3, 0, "user", None),
    (3, 1, "user", "> nobody said so"),
    (4, 0, "user", "Other"),
    (4, 1, "user", ">Other\n>\n> Hello there.\nmine > yours"),
    (None, 1, "x", "> Good."),
    (5, None, "x", "> Good."),
    (6, 0, "x", "Good."),
    (6, 0, "x", "Good."),
    (7, 3, "x", "> Good.\n> Never mind."),
]


def test_quotes(llm):
    rows = llm.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string").withColumn("body", F.lit(1))
    found = {(r.conv_id, r.turn): r for r in quotes.link_quotes(rows.repartition(3)).collect()}
    assert quotes.link_quotes(rows).count() == len(MESSAGES)

    def of(conv, turn):
        r = found[conv, turn]
        return r.body, r.n_quotes, r.n_linked, r.max_level, (r.reply_conv, r.reply_turn), (r.thread_conv, r.thread_turn), r.depth

    none = (None, None)
    assert of(1, 0) == ("Hello there.\nHow are you?", 0, 0, 0, none, (1, 0), 0)
    assert of(1, 1) == ("Fine, thanks.", 1, 1, 1, (1, 0), (1, 0), 1)
    assert of(1, 2) == ("Good.", 2, 2, 2, (1, 1), (1, 0), 2)
    assert of(2, 0) == ("Other", 1, 1, 1, (1, 1), (1, 0), 2)
    assert of(3, 0) == ("", 0, 0, 0, none, (3, 0), 0)
    assert of(3, 1) == ("", 1, 0, 1, none, (3, 1), 0)
    # its own conversation comes first; blank quoted lines part passages
    assert of(4, 1) == ("mine > yours", 2, 2, 1, (4, 0), (4, 0), 1)
    assert of(None, 1) == ("", 1, 0, 1, none, (None, 1), 0)
    # a passage that nobody said in one piece is found by its lines
    assert of(7, 3) == ("", 1, 1, 1, (1, 2), (1, 0), 3)


def quotes_by_hand(rows):
    """Plain links and reply order: passages as word lists, originals by search, a walk through each tree."""

    def norm(text):
        return tuple(re.findall(r"\w+", text.casefold()))

    def split(text):
        said, quoted, run = [], [], None
        for line in (text or "").split("\n"):
            marks = re.match(r"(?:[ \t]{0,3}>)*", line).group()
            level, rest = marks.count(">"), line[len(marks) :].strip()
            if not level:
                said.append(line)
                run = None
            elif not rest:
                run = None
            elif run is not None and quoted[-1][0] == level:
                quoted[-1][1].append(rest)
            else:
                quoted.append((level, [rest]))
                run = level
        return "\n".join(said).strip("\n"), quoted

    speakers = defaultdict(set)
    for conv, turn, _, text in rows:
        if conv is not None and turn is not None:
            said = split(text)[0]
            for part in [said, *re.split(r"\n\s*\n", said), *said.split("\n")]:
                speakers[norm(part)].add((conv, turn))

    def original(conv, turn, lines):
        for words in [norm(" ".join(lines)), *map(norm, lines)]:
            by = speakers[words] if words else ()
            own = [s for s in by if s[0] == conv and s[1] < turn]
            of_all = min(by, default=None)
            to = min(s for s in by if s[0] == conv) if own else of_all if of_all and of_all[0] < conv else None
            if to:
                return to
        return None

    reply = {}
    for conv, turn, _, text in rows:
        links = [(level, no, to) for no, (level, lines) in enumerate(split(text)[1]) if (to := original(conv, turn, lines))]
        if links:
            reply[conv, turn] = min(links)[2]
    children = defaultdict(list)
    for message in sorted(reply):
        children[reply[message]].append(message)
    order = {}
    for start in set(children) - set(reply):
        stack, n = [(start, 0)], 0
        while stack:
            message, depth = stack.pop()
            order[message] = (*start, depth, n)
            n += 1
            stack += [(c, depth + 1) for c in reversed(children[message])]
    return {(c, t): (split(x)[0], reply.get((c, t), (None, None)), order.get((c, t), (c, t, 0, 0))) for c, t, _, x in rows}


def test_quotes_in_nested_threads(llm):
    pick = random.Random(0)
    texts, rows = {}, []
    for conv in range(6):
        for turn in range(25):
            own = [f"say {pick.randrange(400)} of {pick.randrange(3)}" for _ in range(pick.choice([1, 1, 2, 3]))]
            if pick.random() < 0.03:
                own.append(" ".join(f"w{i}" for i in range(60_000)))
            quoted = []
            if texts and pick.random() < 0.85:
                # one message is quoted again and again; others from anywhere, with their own quotations a level deeper
                told = texts[0, 0] if (0, 0) in texts and pick.random() < 0.3 else texts[pick.choice(list(texts))]
                quoted = [">" + (" " if not x.startswith(">") else "") + x for x in told.split("\n")]
            lines = own + quoted if pick.random() < 0.5 else quoted + own
            texts[conv, turn] = "\n".join(lines)
            rows.append((conv, turn, "user", texts[conv, turn]))
    # a thread as deep as it is long
    rows += [(9, i, "x", f"deep {i} step" + (f"\n> deep {i - 1} step" if i else "")) for i in range(40)]
    want = quotes_by_hand(rows)
    frame = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = quotes.link_quotes(frame).collect()
    got = {
        (r.conv_id, r.turn): (r.body, (r.reply_conv, r.reply_turn), (r.thread_conv, r.thread_turn, r.depth, r.position)) for r in found
    }
    assert got == want
    assert sum(reply != (None, None) for _, reply, _ in want.values()) > 80 and max(o[2] for _, _, o in want.values()) == 39
    assert max(len(v) for v in [[m for m in want if want[m][1] == to] for to in {w[1] for w in want.values()} - {(None, None)}]) > 10


def test_announcements_go_whole():
    long = "On " + "day " * 300 + "A wrote:"
    for above, left in (
        (long, ""),
        ("Yes.\n\n" + long, "Yes."),
        ("Yes.\n\nOn Monday, at noon,\nA B <a@b.org>\nwrote:", "Yes."),
        ("Yes.\nOn Monday A\nwrote :\n", "Yes."),
        ("On this I agree.\n\nA writes:", "On this I agree."),
        ("Am Montag\nschrieb A:", "Am Montag\nschrieb A:"),
        ("A wrote: no", "A wrote: no"),
    ):
        assert quotes.parse_message(above + "\n> Hello.") == (left, [(1, ["Hello."])])
    # what stands above an earlier quotation is no part of a later announcement
    assert quotes.parse_message("On it.\n> a\nwrote:\n> b") == ("On it.", [(1, ["a"]), (1, ["b"])])
    assert quotes.parse_message("wrote:\n" * 3)[0] == "wrote:\n" * 2 + "wrote:"


def brute_pipeline(rows, items, llm):
    """The stages in plain Python; the limits of the quality rules come from the operator's table."""
    docs = llm.createDataFrame([(i, t, "en", "src0", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    limits = quality.thresholds(quality.sketches(quality.measured(docs))).first().asDict()
    kept = []
    for doc, text in rows:
        n, chars, symbols, dup, repeat, failed = quality_by_hand(text)
        lines = len([x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")])
        measures = {
            "symbols": symbols * 1000 // max(n, 1),
            "dup_lines": dup * 1000 // max(lines, 1),
            "repeats": repeat * 1000 // max(n, 1),
            "word_length": chars * 100 // max(n, 1),
        }
        if not failed and all(limits[f"__{m}_low"] <= v <= limits[f"__{m}_high"] for m, v in measures.items()):
            kept.append((doc, text))
    groups = near_groups_by_hand(kept)
    kept = [(d, t) for d, t in kept if groups[d] == d]
    removed = {d: sha for d, _, _, sha in repeats_by_hand(kept)}
    return kept, removed, {int(d) for d, _, _ in leaks_by_hand(kept, items)}


def test_pipeline(llm, tmp_path):
    leak = prose(30)
    rows = [(i, prose(60 + i)) for i in range(20)] + [(30 + i, prose(40) + " " + leak) for i in range(2)]
    shared, copy = prose(80), prose(120)
    rows += [(40 + i, f"{prose(50)}\n{shared}\n{prose(50)}") for i in range(3)] + [(50 + i, copy) for i in range(4)]
    rows += [(60, copy.replace(copy.split()[3], "other", 1)), (61, "junk"), (62, "a " * 60), (63, None), (64, prose(30) + " #|%" * 200)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = llm.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], schema)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(0, leak), (1, prose(20))]
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    stages, kept = [], llm.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(llm, kept, str(tmp_path))
        if k < 4:
            assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        result.write.parquet(f"{tmp_path}/{k}")
        kept = llm.read.parquet(f"{tmp_path}/{k}")
        stages.append({r.doc_id: r for r in kept.collect()})
    want, removed, leaks = brute_pipeline(rows, items, llm)
    assert set(stages[1]) == {d for d, _ in want}
    assert {61, 62, 63, 64} & set(stages[0]) == set() and set(range(20)) <= set(stages[0])
    assert {51, 52, 53, 60} & set(stages[1]) == set()
    for doc, row in stages[2].items():
        assert hashlib.sha256(" ".join(row.text.split()).encode()).hexdigest() == removed[doc] and row.n_chars == len(row.text)
    assert leaks >= {30} and 30 not in stages[3] and set(range(20)) <= set(stages[3])
    found = corpus_pipeline.run(llm, str(tmp_path)).collect()
    assert sorted(map(str, found)) == sorted(str(r) for r in stages[4].values())


def test_near_dedup_links_as_simhash_does(llm, documents):
    """1 and 2 share a fingerprint of op5 and few distinct shingles; 2 and 3 share these, but no fingerprint near."""
    phrase, tails = prose(7), [prose(120), prose(120)]
    rows = [(1, f"{phrase} " * 300 + tails[0]), (2, f"{phrase} " * 300 + tails[1]), (3, f"{phrase} {tails[1]}"), (4, prose(300))]
    docs = documents(rows)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.doc_id for r in near_copies.keep_first(docs).collect()} == {1, 2, 4}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(llm, docs, "").collect()} == {1, 4}


def test_empty_tables(llm, documents):
    pages = llm.createDataFrame([], "page_id long, url string, html string")
    assert url_filters.judge_urls(pages).count() == 0
    assert archived(pages)[1].count() == 0
    assert token_frames.read_tokens(llm, token_frames.write_tokens(documents([]))).count() == 0
    assert quotes.link_quotes(llm.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
