"""Conversation repair, collocations and licence scans against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from codeledger.llm import collocations, conversation_repair, license_scan
from codeledger.llm.conversation_repair import Costs

TURNS = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256(b"").hexdigest()
STATES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def repaired_by_hand(rows, costs=Costs()):
    """The summary columns but conv_id for one conversation, by trying all edits."""

    def digest(r):
        return hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()

    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
    faults, seen = [], set()
    for _, _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    turns = {r[1] for r in rows if r[1] is not None}

    @cache
    def best(i, state, inserts):
        """(cost, audit, lines) from row i on."""
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 4:
            for role in ("user", "assistant"):
                if (state, role[0]) in STATES:
                    cost, audit, lines = best(i, STATES[state, role[0]], inserts + 1)
                    ways.append((cost + costs.insert, "I" + audit, (role + ":", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            ways.append((cost + costs.delete, "D" + audit, lines))
            if faults[i] not in ("b", "d"):
                extra = costs.truncated if faults[i] else 0
                for new, price, edit in ((role, 0, "K"), ("user", costs.rerole, "R"), ("assistant", costs.rerole, "R")):
                    if (state, new[:1]) in STATES:
                        cost, audit, lines = best(i + 1, STATES[state, new[:1]], 0)
                        ways.append((cost + price + extra, edit + audit, (f"{new}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        faults.count("b"),
        faults.count("d"),
        faults.count("t"),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def conversations(seed, n=40):
    numbers = random.Random(seed)
    texts = ["Yes.", "No!", "why", "So?", "", " \t\n", "Ünd so.", "…", "A\nB."]
    roles = ["user", "assistant", "system", "tool", "u", "User", "", None]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(numbers.randrange(9)):
            role = numbers.choice(roles[:2] * 4 + roles)
            text = numbers.choice(texts) if numbers.random() < 0.5 else f"{conv} {turn} {numbers.choice('.!?x')}"
            rows.append((conv, numbers.choice([turn, turn, turn, turn - 1, turn + 3, None]), role, numbers.choice([text, text, text, None])))
    return rows


@pytest.mark.parametrize(
    "seed, costs", [(1, Costs()), (2, Costs()), (3, Costs(1, 2, 1, 0)), (4, Costs(3, 4, 1, 1)), (5, Costs(1, 9, 2, 1)), (6, Costs(2, 2, 2, 0))]
)
def test_repair_matches_all_edits(llm, seed, costs):
    rows = conversations(seed)
    given = llm.createDataFrame(rows, TURNS).repartition(4)
    by_conv = defaultdict(list)
    for row in damaged_by_hand(rows):
        by_conv[row[0]].append(row)
    found = conversation_repair.repair(conversation_repair.damage(given), given, costs).collect()
    assert len(found) == len({r[0] for r in rows})
    for row in found:
        assert tuple(row)[1:] == repaired_by_hand(by_conv[row.conv_id], costs), row


def test_repaired_turns_are_what_the_digest_covers(llm):
    given = llm.createDataFrame(conversations(7), TURNS)
    left = defaultdict(list)
    turns = conversation_repair.repaired_turns(given, Costs(1, 9, 2, 1)).collect()
    for row in sorted(turns, key=lambda r: (str(r.conv_id), r.place)):
        assert row.place == len(left[row.conv_id]) and row.edit in "KRI" and (row.edit != "I" or row.text == "" and row.turn is None)
        left[row.conv_id].append(f"{row.role}:{row.text}")
    assert any(r.edit == "I" for r in turns)
    for row in conversation_repair.repair(given, costs=Costs(1, 9, 2, 1)).collect():
        assert row.repaired_sha256 == hashlib.sha256("\n".join(left[row.conv_id]).encode()).hexdigest()


def test_giant_conversation_goes_through_files(llm, monkeypatch):
    numbers = random.Random(8)
    rows = [(5, i, numbers.choice(["user", "assistant"]), f"{i} {'long ' * 50}{numbers.choice(['.', '.', ''])}") for i in range(30_000)]
    rows[20_000] = (5, 20_000, *rows[10][2:])
    frame = llm.createDataFrame(rows, TURNS).repartition(8)
    large = conversation_repair.repair(frame).first()
    monkeypatch.setattr(conversation_repair, "SPOOL_BYTES", 1 << 40)
    in_memory = conversation_repair.repair(frame).first()
    assert large == in_memory and len(large.audit) == 30_000 and large.duplicate == 1 and large.audit[20_000] == "D"


def test_repair_of_odd_tables(llm):
    empty = llm.createDataFrame([], TURNS)
    assert conversation_repair.repair(empty).count() == 0 and conversation_repair.repaired_turns(empty).count() == 0
    ids = llm.createDataFrame([(1,), (1,), (None,)], "conv_id long")
    found = sorted((tuple(r) for r in conversation_repair.repair(empty, ids).collect()), key=str)
    assert found == [(1, 0, 0, 0, 0, 0, 0, "", NOTHING), (None, 0, 0, 0, 0, 0, 0, "", NOTHING)]
    extra = "same string, kind int, at long, fault string, copy long, first long, told string, id string, n long, place long"
    rows = [("c", 0, "user", "Hi.", *[None] * 10), ("c", 1, "assistant", "Ho.", *[None] * 10)]
    clash = llm.createDataFrame(rows, f"conv_id string, turn long, role string, text string, {extra}")
    assert [(r.conv_id, r.audit) for r in conversation_repair.repair(clash, clash).collect()] == [("c", "KK")]
    assert conversation_repair.damage(clash).columns == ["conv_id", "turn", "role", "text"]


def collocations_by_hand(rows, max_words, min_count, top=2_000):
    counts, words_of = defaultdict(Counter), Counter()
    for lang, text in rows:
        text = (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            words_of[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        most = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * most[p] < 50 * a:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words_of[lang], -score))
    return sorted(out)


def phrase_rows(seed, n=300):
    numbers = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "ÉTÉ", "été", "x y", "日本", "a"] + [f"w{i}" for i in range(30)]
    weights = [9, 9, 7, 30, 40, 2, 2, 2, 2, 9] + [1] * 30
    rows = []
    for _ in range(n):
        text = " ".join(numbers.choices(words, weights, k=numbers.randrange(25)))
        text = re.sub(" ", lambda m: numbers.choice([" "] * 8 + [", ", ".", "\t", "\n", " ? ", "  "]), text)
        rows.append((numbers.choice(["en", "en", "fr", None, "und"]), numbers.choice([text] * 9 + [None])))
    return rows + [("en", "New York City. " * 400), ("de", "solo"), ("xx", ""), ("xx", None)]


@pytest.mark.parametrize("max_words, min_count, shares, bits, held", [(3, 10, 1024, 27, 300_000), (3, 2, 8, 6, 40), (4, 3, 5, 15, 7), (2, 1, 64, 16, 100)])
def test_collocations(llm, monkeypatch, max_words, min_count, shares, bits, held):
    monkeypatch.setattr(collocations, "SHARES", shares)
    monkeypatch.setattr(collocations, "HELD", held)
    real = collocations.stripes
    monkeypatch.setattr(collocations, "stripes", lambda docs, k, n: real(docs, k, n, bits))
    rows = phrase_rows(max_words)
    docs = llm.createDataFrame(rows, "lang string, text string").repartition(5)
    found = sorted(tuple(r) for r in collocations.collocations(docs, max_words, min_count).collect())
    assert found == collocations_by_hand(rows, max_words, min_count) and found


def test_collocations_top_ties_and_odd_tables(llm):
    rows = [("en", f"p{i} q{i}. " * 3) for i in range(90)] + [("fr", "b a! " * 3)]
    docs = llm.createDataFrame([(*r, 1, 2, "x") for r in rows], "lang string, text string, rank int, part int, phrase string")
    found = sorted(tuple(r) for r in collocations.collocations(docs, min_count=3, top=7).collect())
    assert found == collocations_by_hand(rows, 3, 3, top=7) and len(found) == 8
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_stripes_hold_totals_and_extensions_and_split_hot_prefixes(llm, monkeypatch):
    monkeypatch.setattr(collocations, "SHARES", 4)
    docs = llm.createDataFrame([("en", f"the w{i % 50}") for i in range(500)], "lang string, text string").repartition(3)
    none, one = (level.collect() for level in collocations.stripes(docs, 2, 1))
    assert sum(r.total for r in none) == 1_000 and {r.prefix for r in none} == {""}
    the = [r for r in one if r.prefix == "the"]
    assert len(the) == 2 and sum(r.total for r in the) == 500 and sum(len(r.words) for r in the) == 50


def test_scores_stay_exact_past_64_bits(llm):
    a, left, right = 4_000_000_000_000, 7_999_999_999_999, 5_000_000_000_001
    frame = llm.createDataFrame([(a, left, right)], "a long, l long, r long")
    wide = {c: f"cast({c} as decimal(16,0))" for c in "alr"}
    score = frame.select(F.expr(f"cast(({wide['a']} * {wide['a']} * 1000000bd) div ({wide['l']} * {wide['r']}) as bigint)")).first()[0]
    assert score == 1_000_000 * a * a // (left * right)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def licence_words(text):
    return WORD.findall((text or "").encode().lower().decode())


def places_by_hand(words):
    out = []
    for phrase, label in license_scan.PHRASES:
        wanted = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return out


def statistics_by_hand(words, templates):
    passages = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    out = []
    for end in range(len(words)):
        start = next((s for s in range(end + 1) if tuple(words[s : end + 1]) in passages), None)
        if start is not None:
            out.append((end, end - start + 1))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_matching_statistics(seed):
    numbers = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefgh"
    notices = [("x", " ".join(numbers.choices(letters, k=numbers.randrange(1, 14)))) for _ in range(6)]
    phrases = [(" ".join(numbers.choices(letters, k=numbers.randrange(1, 4))), "p") for _ in range(4)]
    automaton = license_scan.LicenceAutomaton(phrases, notices)
    templates = automaton.templates + automaton.phrase_words
    for _ in range(60):
        words = [w.encode() for w in numbers.choices(letters + "z", k=numbers.randrange(30))]
        told = list(automaton.statistics(words))
        assert [(at, n) for at, _, n in told] == statistics_by_hand(words, templates)
        for at, state, n in told:
            ends = {(t, e) for t, w in enumerate(automaton.templates) for e in range(len(w)) if w[: e + 1][-n:] == words[at - n + 1 : at + 1]}
            assert set(automaton.anchors[state]) == ends
        found, _ = automaton.scan(words)
        want = [(p, i) for p, w in enumerate(automaton.phrase_words) for i in range(len(words)) if words[i : i + len(w)] == w]
        assert sorted(found) == sorted(want)


def scanned(llm, *texts):
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in license_scan.scan_licences(docs).collect()}


def test_base_places_of_random_texts(llm):
    numbers = random.Random(3)
    parts = ["GNU General Public License", "gnu", "general", "public", "license", "Apache", "CC-BY", "cc by cc", "MIT License", "mit", "é", "cc by", "9"]
    texts = ["".join(numbers.choice(parts) + numbers.choice([" ", "-", "_", "\n", ", "]) for _ in range(numbers.randrange(30))) for _ in range(80)]
    for number, row in scanned(llm, *texts).items():
        words = licence_words(texts[number])
        places = places_by_hand(words)
        starts = [i for i, _ in places]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(","))) and 0 <= row.score <= 1


def test_notices_are_found_whole_broken_and_changed(llm):
    notices = dict(reversed(license_scan.NOTICES))
    mit, apache, bsd = notices["mit"], notices["apache"], notices["bsd"]
    words = mit.split()
    changed = " ".join(w if i % 9 else "other" for i, w in enumerate(words))
    lost = " ".join(words[:20] + words[26:])
    half = " ".join(words[: len(words) // 2])
    rows = scanned(
        llm,
        "Before. " + mit + " After.",
        "// " + apache.replace(" ", "\n// ", 9),
        changed,
        lost,
        half,
        f"{bsd} then {mit}",
        f"{mit} {mit}",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the CC BY 4.0.",
        "permission is hereby granted, of the software the of to any",
    )
    labels = {number: row.labels for number, row in rows.items()}
    assert labels == {0: "mit", 1: "apache", 2: "mit", 3: "mit", 4: "", 5: "bsd,mit", 6: "mit", 7: "cc-by-nc", 8: "cc-by,cc-by-nc", 9: "cc-by", 10: ""}
    assert rows[0].score == 1 and rows[0].spans[0].first_word == 1 and rows[0].spans[0].last_word == len(licence_words(mit))
    assert 0.8 <= rows[2].score < 1 and 0.9 < rows[3].score < 1 and rows[4].score == 0
    assert len(rows[6].spans) == 2 and rows[6].spans[1].first_word == len(licence_words(mit))


def test_licence_scan_of_odd_tables(llm):
    docs = llm.createDataFrame(
        [("a", None, 1, "x", 2.0), ("a", "", 2, None, None), (None, "MIT License", 3, "y", 0.5), (None, "MIT License", 3, "y", 0.5)],
        "doc_id string, text string, n_words int, labels string, score double",
    )
    found = sorted((tuple(r) for r in license_scan.scan_licences(docs).collect()), key=str)
    assert found == [("a", 0, 0, None, None, "", "", 0.0, [])] * 2 + [(None, 2, 1, 0, 0, "mit", "mit", 0.0, [])] * 2
    assert license_scan.scan_licences(docs.limit(0)).count() == 0
    long = scanned(llm, "word " * 400_000 + "Released under the MIT License." + " word" * 200_000)[0]
    assert (long.n_words, long.first_word, long.labels, long.score) == (600_005, 400_003, "mit", 1.0)
    many = scanned(llm, "Released under the MIT License. " * 30_000)[0]
    assert many.n_base == 30_000 and len(many.spans) == 30_000
