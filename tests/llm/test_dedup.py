"""Operators 1, 6 and 7 against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillmart.llm import common, components, exact_dedup, near_dedup, substring_dedup
from tests.llm.cases import documents, frame, lower, prose, words_of


def brute_repeats(rows, window=50):
    """(id, words, removed, kept text) of rows with an id."""
    first: dict[tuple, int] = {}
    for number, text, *_ in rows:
        words = words_of(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if number is not None:
                first[key] = min(first.get(key, number), number)
    out = []
    for number, text, *_ in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if number is not None and first[tuple(words[i : i + window])] < number:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((number, len(words), len(gone), kept))
    return out


def edge_rows():
    """One passage in many documents, each with its own words around it, and copies of copies."""
    passage = prose(50, 60)
    rows = [(100 + i, f"{prose(60 + i, 55)} {passage} {prose(90 + i, 55)}", "a") for i in range(12)]
    rows += [(200 + i, passage, "a") for i in range(4)]
    return [(*r, 7, "r", "i", "w", -1, "k") for r in rows]


@pytest.mark.parametrize("crowd", [1000, 2])
@pytest.mark.parametrize("shard_words", [20_000, 100])
def test_substring_dedup(spark, monkeypatch, crowd, shard_words):
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard_words)
    rows = documents() + edge_rows()
    got = substring_dedup.remove_repeats(frame(spark, rows)).select(
        "doc_id", "n_words", "n_removed", "kept_text"
    )
    assert Counter(map(tuple, got.collect())) == Counter(brute_repeats(rows))


def test_substring_spans_are_maximal(spark):
    rows = substring_dedup.remove_repeats(frame(spark, edge_rows())).collect()
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows}
    assert spans[100] == [] and spans[101] == [(55, 115)] and spans[200] == [(0, 60)]


def test_suffix_automaton_statistics():
    sequences = [list("abcbc"), list("bcbca"), list("cabcb")]
    automaton = substring_dedup.SuffixAutomaton()
    for number, sequence in enumerate(sequences):
        automaton.add(sequence, number)
    automaton.close()
    for sequence in sequences:
        for window in (1, 2, 3):
            expected = [
                min(n for n, s in enumerate(sequences) if "".join(sequence[i : i + window]) in "".join(s))
                for i in range(len(sequence) - window + 1)
            ]
            assert automaton.owners(sequence, window) == expected


def brute_components(rows):
    def shingles(text):
        words = words_of(lower(text))
        return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = [(r[0], shingles(r[1])) for r in rows]
    label = {n: n for n, _ in sets if n is not None}
    changed = True
    while changed:
        changed = False
        for a, one in sets:
            for b, two in sets:
                if a is None or b is None or not one or not two:
                    continue
                if 100 * len(one & two) >= 85 * len(one | two) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return Counter((n, len(s), label.get(n), n == label.get(n)) for n, s in sets)


def test_near_dedup(spark):
    rows = documents()
    got = near_dedup.components(frame(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == brute_components(rows)


def test_near_dedup_crowd(spark):
    """A large group of near copies, one word changed in each, is one component."""
    base = prose(11, 200).split()
    rows = [(i, " ".join([*base[: i % 200], f"w{i}", *base[i % 200 + 1 :]])) for i in range(400)]
    rows += [(1000 + i, prose(500 + i, 200)) for i in range(50)]
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert found == {i: 0 if i < 400 else i for i, _ in rows}


def star_rows(copies, changes=3):
    """An original and copies with some words changed in each, like the original but not each other."""
    base = prose(12, 200).split()
    rows = [(5000, " ".join(base))]
    for i in range(copies):
        words, draw = list(base), random.Random(i)
        for k in range(changes):
            words[draw.randrange(5, 195 // changes) + 195 // changes * k] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("copies, cell, large", [(1000, 2048, 64), (120, 2048, 10**9), (120, 30, 10**9)])
def test_near_dedup_star(spark, monkeypatch, copies, cell, large):
    """Only the original's own links hold a star of copies together; with and without its hub."""
    monkeypatch.setattr(near_dedup, "CELL", cell)
    monkeypatch.setattr(near_dedup, "LARGE", large)
    rows = star_rows(copies) + [(6000 + i, prose(700 + i, 200)) for i in range(20)]
    sets = {i: set(near_dedup.shingle_set(t.encode()).tolist()) for i, t in rows}

    def alike(a, b):
        return 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])

    assert all(alike(5000, i) for i in range(copies))
    assert sum(alike(a, b) for a in range(40) for b in range(a)) < 40
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert found == {i: 0 if i <= 5000 else i for i, _ in rows}


def test_near_dedup_crowd_of_strangers(spark, monkeypatch):
    """Copies that are alike at 0.67 and linked to nobody hardly meet, and nothing grows with their square."""
    rows = [(i, t) for i, t in star_rows(1600, 8) if i < 5000]
    base = rows[0][1].split()
    base[60] = "other"
    rows.append((7000, " ".join(base)))
    made = {}

    def counted(frame, label):
        made[label] = made.get(label, 0) + frame.count()
        return common.written(frame, label)

    monkeypatch.setattr(near_dedup, "written", counted)
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert found == {i: 0 if i == 7000 else i for i, _ in rows}
    assert made["hub-pairs"] + made["rare-shingles"] + made["links"] < 20_000
    assert made["candidates"] <= 2 * near_dedup.NEIGHBOURS * near_dedup.TREES * len(rows)
    assert made["crowd-sets"] > 1000


def brute_cells(rows, percent):
    sets = {i: set(near_dedup.shingle_set(t.encode()).tolist()) for i, t in rows}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_crowd_join_is_exact(spark, monkeypatch, percent):
    """The join by rare shingles alone finds all components, at any similarity and with small blocks."""
    monkeypatch.setattr(near_dedup, "CELL", 5)
    draw, bases = random.Random(percent), [prose(40 + i, 60).split() for i in range(3)]
    rows = []
    for i in range(90):
        words = list(bases[i % 3])[: 60 - draw.randrange(8)]
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(30)}"
        rows.append((i, " ".join(words)))
    texts = spark.createDataFrame(rows, "id long, text string").repartition(3)
    members = spark.createDataFrame([(i, 0, i) for i, _ in rows], "rep long, n long, component long")
    links = near_dedup.crowd_links(members, texts, percent)
    found = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert {i: found.get(i, i) for i, _ in rows} == brute_cells(rows, percent)


def test_near_dedup_of_repeated_ids(spark):
    """Any text of an id counts, and its texts hold together."""
    one, two, three = prose(80, 120), prose(81, 120), prose(82, 120)
    rows = [(1, one), (1, two), (2, three + " end"), (2, two + " end"), (3, three), (4, None), (4, "four"), (5, "FOUR")]
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_near_dedup_keeps_columns_and_clean_documents(spark):
    docs = frame(spark)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert 6 in ids and 7 not in ids and 9 not in ids and 13 not in ids and {0, 1, 2, 10, 11, 12} <= ids


def test_components_of_a_long_chain(spark):
    links = spark.range(0, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.unionAll(spark.createDataFrame([(500, 400), (400, 500), (7, 7)], "a long, b long"))
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("hot_rows", [1000, 2])
def test_exact_dedup(spark, keep, hot_rows):
    rows = documents()
    groups: dict[str, list] = {}
    for number, text, *_ in rows:
        groups.setdefault(text or "", []).append(number)
    choose = max if keep == "largest" else min
    expected = Counter()
    for number, text, *_ in rows:
        members = groups[text or ""]
        best = choose(n for n in members if n is not None)
        expected[(number, best, len(members), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    got = exact_dedup.content_groups(frame(spark, rows), keep=keep, hot_rows=hot_rows)
    assert Counter(map(tuple, got.drop("kept").collect())) == expected
    kept = Counter(r["text_sha256"] for r in got.filter("kept").collect())
    assert kept == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})


def test_copies_are_settled_as_neighbours(spark):
    """A text within the bound is one run; a hot text has a run for each part, and only those carry it on."""
    rows = [(i, f"text {i % 40}") for i in range(400)] + [(1000 + i, "hot") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    runs = exact_dedup.sorted_runs(docs, hot_rows=50).collect()
    firsts = Counter(r["digest"].hex() for r in runs if r["first"])
    hot = hashlib.sha256(b"hot").hexdigest()
    assert {d: n for d, n in firsts.items() if d != hot} == {
        hashlib.sha256(f"text {i}".encode()).hexdigest(): 1 for i in range(40)
    }
    assert 2 <= firsts[hot] <= 6
    assert sum(r["part_text"] == "hot" for r in runs) == firsts[hot] == sum(r["part_text"] is not None for r in runs)


def test_drop_copies_leaves_one_row_a_text(spark):
    docs = frame(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = Counter(r["text"] or "" for r in kept.collect())
    assert texts == Counter({t or "": 1 for _, t, *_ in documents()})


def test_empty_tables(spark):
    empty = frame(spark, [])
    for run in (
        substring_dedup.remove_repeats, near_dedup.components, near_dedup.keep_one,
        exact_dedup.content_groups, exact_dedup.drop_copies,
    ):
        assert run(empty).count() == 0
