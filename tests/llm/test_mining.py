"""Operators 11, 12 and 13 against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest

from tillmart.llm import collocations, decontamination, divergence
from tillmart.llm.slots import EMPTY, marks_of, slot_table
from tests.llm.cases import documents, frame, lower, prose

LANGS = "de", "en", "", None, "und"


def rows_with_langs():
    """The awkward documents and short prose over few words, with languages, sources and a clashing `n`."""
    draw = random.Random(5)
    rows = [(number, text, LANGS[i % 5], source, "x") for i, (number, text, source, *_) in enumerate(documents())]
    some = ["red", "Green", "blue", "Äpfel", "x1", "b-c", "zu", "na", "d'or"]
    for i in range(120):
        text = "".join(draw.choice(some) + draw.choice([" ", " ", "  ", ", ", ".\n", "\t", ":"]) for _ in range(80))
        rows.append((500 + i, text, LANGS[i % 3], f"s{i % 4}" if i % 7 else None, "y"))
    rows += [(900, None, "fr", "only", "y"), (901, "", "fr", None, "y"), rows[-1]]
    return rows


def mining_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n string").repartition(3)


def brute_divergence(rows, least, top):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text)))
             for _, text, lang, source, *_ in rows]
    docs: dict[str, Counter] = defaultdict(Counter)
    counts: dict[tuple, Counter] = defaultdict(Counter)
    for lang, source, words in terms:
        docs[lang].update(set(words))
        counts[lang, source].update(words)
    out = Counter()
    for lang, seen in docs.items():
        kept = sorted((w for w, n in seen.items() if n >= least), key=str.encode)
        sources = sorted({s for x, s in counts if x == lang}, key=str.encode)

        def share(of):
            whole = sum(of[w] for w in kept) + len(kept)
            return {w: 1 + 10**9 * (of[w] + 1) // whole for w in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))

        def f(a, b):
            return (a - b) * (a - b) // b

        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s]
            best = [(-f(p[s][w], q[w]), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", best, top)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out.update((lang, s, part, item, -v, r) for r, (v, item) in enumerate(ranked, 1))
    return out


@pytest.mark.parametrize("shard_terms, round_bytes, block, top", [(1 << 15, 64 << 20, 2048, 200), (7, 150, 5, 3)])
def test_divergence(spark, monkeypatch, shard_terms, round_bytes, block, top):
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard_terms)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = rows_with_langs()
    got = divergence.audit(mining_frame(spark, rows), top=top, round_bytes=round_bytes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_divergence(rows, 3, top)


def test_divergence_without_kept_terms(spark):
    rows = [(1, "a b", "en", "x", ""), (2, None, "en", "y", ""), (3, "c", None, None, "")]
    got = divergence.audit(mining_frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == Counter(
        [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    )


@pytest.mark.parametrize("size", [1, 2, 3, 50, 5000])
def test_perfect_hash_is_minimal(size):
    hashes = divergence.term_hashes([b"term%d" % i for i in range(size)])
    displace, slots = divergence.perfect_hash(hashes)
    assert sorted(slots.tolist()) == list(range(size))
    keys = [b""] * size
    for slot, i in zip(slots.tolist(), range(size), strict=True):
        keys[slot] = b"term%d" % i
    lengths = np.array([len(k) for k in keys], dtype=np.int32).tobytes()
    table = divergence._Slots([("en", 0, 10, 0, displace.tobytes(), lengths, b"".join(keys))], {"en": 1})
    asked = [b"term%d" % i for i in range(2 * size)]
    found = [(p, s) for places, at in table.find("en", asked) for p, s in zip(places.tolist(), at.tolist(), strict=True)]
    assert sorted(found) == [(i, int(slots[i])) for i in range(size)]


def test_shares_beyond_64_bits():
    counts = np.array([0, 5 * 10**10], dtype=np.int64)
    assert divergence.shares(counts, 10**11, 2).tolist() == [
        1 + 10**9 * (c + 1) // (10**11 + 2) for c in (0, 5 * 10**10)
    ]


def brute_collocations(rows, threshold, keep):
    total, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: n for k, n in f.items() if n >= threshold and len(k[1]) > 1}
    out = Counter()
    for lang in total:
        mine = {words: a for (x, words), a in candidates.items() if x == lang}
        found = []
        for words, a in mine.items():
            score, k = min((2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
            inside = any(
                len(other) > len(words)
                and 100 * b >= 80 * a
                and any(other[i : i + len(words)] == words for i in range(len(other)))
                for other, b in mine.items()
            )
            if not inside:
                found.append((-score, -a, " ".join(words), f[lang, words[:k]], f[lang, words[k:]]))
        found.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        for rank, (score, a, phrase, left, right) in enumerate(found[:keep], 1):
            out[lang, rank, phrase, -a, left, right, total[lang], -score] += 1
    return out


@pytest.mark.parametrize("shards, bits, keep", [(1, (18, 27), 2000), (2, (3, 4), 2000), (5, (6, 20), 10)])
def test_collocations(spark, shards, bits, keep):
    """Slot tables of a few slots, in which nearly all phrases clash, change nothing."""
    rows = rows_with_langs() + [(2000, "over and over again, " * 40, "en", "s", "")]
    got = collocations.mine(mining_frame(spark, rows), shards=shards, slot_bits=bits, keep=keep)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_collocations(rows, 30, keep)
    assert {k[0] for k in expected} >= {"de", "en", ""}
    assert Counter(map(tuple, got.collect())) == expected


def test_each_phrase_meets_each_shard_once():
    """Whatever step a phrase starts in, it is active for one cycle."""
    table = np.full(1 << 10, EMPTY, dtype=np.uint8)
    blob = collocations.normalised("Aa bb\tcc. dd  ee ff gg".encode())
    assert blob == b"aa bb cc\n dd ee ff gg"
    words = collocations.word_hashes(blob)
    slots = (collocations._slot_hashes(words, 1, "en") >> np.uint64(54)).astype(int)
    table[slots] = [1, 2, 1, 3, 1, 1, 0]
    seen = Counter()
    for step in range(8):
        for size, start, phrases in collocations.active_phrases(blob, "en", step, 3, 2, table):
            seen.update((p, start) for p in phrases)
    assert len(set(slots)) == 7
    assert seen == {(p, s): 3 for p, s in [(b"aa bb", 2), (b"bb cc", 2), (b"dd ee", 3), (b"ee ff", 1), (b"ff gg", 1)]}


def test_long_texts_are_cut_between_pieces():
    data = b"\n".join(b"w%d x" % i for i in range(500)) + b"\n" + b"y " * 300
    parts = list(collocations._cut(data, 100))
    assert b"\n".join(parts) == data and all(b"\n" not in p for p in parts if len(p) > 100)


def test_slot_table(spark):
    rows = [(-1, 3), (-1, 2), (5, 7), (1 << 62, 0)]
    table = slot_table(spark.createDataFrame(rows, "hash long, mark int"), 20)
    hashes = np.array([-1, 5, 1 << 62, -(1 << 62)], dtype=np.int64).view(np.uint64)
    assert len(table) == 1 << 20 and marks_of(table, hashes).tolist() == [2, 7, 0, EMPTY]


def brute_leaks(rows, items, longest=10):
    def words(text):
        return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))

    windows: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        found = words(text)
        size = min(longest, len(found))
        for i in range(len(found) - size + 1) if found else ():
            windows[tuple(found[i : i + size])].add(item)
    out = []
    for number, text, *_ in rows:
        found, hit, names = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    names |= windows[tuple(found[i : i + size])]
        listed = sorted(str(n) for n in names if n is not None)
        out.append((number, len(found), len(hit), tuple(listed), bool(hit)))
    return Counter(out)


def leak_cases():
    draw = random.Random(3)
    passage = prose(20, 30)
    items = [
        (1, passage), (2, passage), (2, prose(21, 12)), (None, prose(22, 15)), (3, None), (4, " .,- "),
        (10, "lone"), (11, "one, two three"), (12, "A b c d e f g h i"), (13, " ".join(["ab"] * 25)), (9, passage + " tail"),
    ]
    cut = passage.split()
    texts = [
        passage, passage.upper(), " ".join(cut[:9]), " ".join(cut[4:14]), prose(23, 400) + " " + " ".join(cut[11:24]),
        " ".join(cut[:10]) + " x " + " ".join(cut[10:]), prose(22, 15), "Lone wolf", "one two\nthree; one two",
        "a-b-c-d-e-f-g-h-i", "ab " * 9, "ab " * 12, " ".join(draw.choice(cut) for _ in range(3000)), "x" * 5000,
    ]
    rows = [(i, t, None, 7, "r", "i", "w", -1, "k") for i, t in enumerate([*texts, None, "", passage, passage])]
    rows += [(3, passage, None, 7, "r", "i", "w", -1, "k"), (None, passage, None, 7, "r", "i", "w", -1, "k")]
    return rows + documents(), items


@pytest.mark.parametrize("window", [10, 7, 1])
def test_decontamination(spark, window):
    rows, items = leak_cases()
    benchmark = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, context string")
    got = decontamination.find_leaks(frame(spark, rows), benchmark, window=window).collect()
    found = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got)
    assert found == brute_leaks(rows, items, window)
    for row in got:
        covered = {w for s in row["spans"] for w in range(s["start"], s["end"])}
        assert len(covered) == row["n_hit"]


def test_shared_windows_share_a_fingerprint():
    """The guarantee of winnowing, for every length of a window."""
    draw = np.random.Generator(np.random.PCG64(1))
    for window in range(1, 11):
        words = draw.integers(0, 6, 400).astype(np.uint64)
        places, _ = decontamination.fingerprints(words, window)
        size = decontamination.gram_size(window)
        for begin in range(len(words) - window + 1):
            assert ((places >= begin) & (places + size <= begin + window)).any()
        assert all(b - a <= window - size + 1 for a, b in pairwise(places.tolist()))


def test_without_leaks(spark):
    rows, items = leak_cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    clean = Counter(n for n, _, _, _, bad in brute_leaks(rows, items).elements() if not bad)
    assert Counter(r["doc_id"] for r in kept.collect()) == clean


def test_empty_tables(spark):
    docs, items = mining_frame(spark, rows_with_langs()).limit(0), spark.createDataFrame([], "item_id long, text string")
    assert divergence.audit(docs).count() == collocations.mine(docs).count() == 0
    assert decontamination.find_leaks(docs, items).count() == 0
    full = frame(spark)
    assert decontamination.find_leaks(full, items).filter("n_hit = 0 and not contaminated").count() == full.count()
    assert decontamination.without_leaks(full, items).count() == full.count()
