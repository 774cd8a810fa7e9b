"""Operators 2, 4 and 10: edge cases; the SQL forms are compared in test_queries."""

import base64
import gzip
import hashlib
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillmart.llm import mixing, quality_rules, warc
from tests.llm.cases import documents, frame, prose, words_of


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            again.update((i, i + 1, i + 2))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(again),
    )


def test_rule_counts(spark):
    rows = documents() + [(99, "a b c a b c d # $$ |\nx y\nx y\n \nx  y", "s", 7, "r", "i", "w", -1, "k")]
    got = quality_rules.judge(frame(spark, rows)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    expected = Counter()
    for number, text, *_ in rows:
        counts = brute_counts(text)
        expected[(number, *counts, counts[0] < 50 or 2 * counts[4] > counts[0])] += 1
    assert Counter(map(tuple, got.collect())) == expected


def test_rules_keep_prose_and_drop_junk(spark):
    stop = "the of and in it was on".split()
    lines = [[f"{w} {stop[(i + j) % 7]}" if j % 4 == 0 else w for j, w in enumerate(prose(i, 12).split())] for i in range(8)]
    good = "\n".join(" ".join(line) for line in lines)
    rows = [(1, good), (2, good.replace(" ", " ### ")), (3, prose(1, 300)), (4, "spam spam " * 90), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in quality_rules.keep_good(docs).collect()] == [1]
    failed = {r["doc_id"]: r["failed"] for r in quality_rules.judge(docs).select("row.doc_id", "failed").collect()}
    assert failed[1] == [] and "at most one symbol to ten words" in failed[2]


def brute_targets(sizes: dict, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: share[s] if s in share else 2.0 * sizes[s] for s in order}
        stopped |= over


def test_mixing_targets_and_limits(spark):
    rows = documents()
    sizes: dict = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    wanted = brute_targets(sizes)
    got = mixing.mix_sources(frame(spark, rows), block=8, shard_words=64)
    assert len(set(sizes.values())) == len(sizes)
    by = got.groupBy("source_size").agg(F.max("target").alias("t"), F.sum("taken").alias("k")).collect()
    by = {r["source_size"]: r for r in by}
    for source, target in wanted.items():
        found = by[sizes[source]]
        assert found["t"] == pytest.approx(target)
        assert abs(found["k"] - target) <= 8
    assert got.filter("taken > 2 * size or taken < 0").isEmpty()
    assert got.count() == len(rows)
    assert Counter(map(tuple, got.collect())) == Counter(
        map(tuple, mixing.mix_sources(frame(spark, rows).repartition(5), block=8, shard_words=64).collect())
    )


def test_each_source_comes_near_its_target(spark):
    """Within a block; blocks that many small sources round off may go to a large one."""
    rows = [(i, prose(i, 200), f"s{i:02}") for i in range(9)]
    rows += [(100 + i, prose(100 + i, 30 + 7 * i), "large") for i in range(60)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_words=2000)
    sources = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    for r in sources.collect():
        many = r["size"] // r["source_size"]  # sources of one size and target
        assert abs(r["taken"] - many * r["target"]) <= max(many * mixing.BLOCK, 0.01 * r["target"])


def test_rows_of_one_id_keep_their_own_words(spark):
    rows = [(7, prose(1, 300), "a"), (7, "seven words of a text are here", "a"), (7, "", "a"), (7, None, "b"), (8, "x y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = Counter(r["text"] for r in mixing.mixed_documents(docs, limit=1, share=1.0, block=1).collect())
    assert texts == Counter(t for _, t, _ in rows if t)


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [r for r in documents()[:21]]
    docs = frame(spark, rows)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(words_of(r["text"]))
    assert words == Counter({k: v for k, v in taken.items() if v})


def sainte_lague(weights: list[float], seats: int) -> list[int]:
    won = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1003])
def test_apportionment_is_sainte_lague(spark, seats):
    weights = [1000, 1, 1, 1, 1, 30, 30, 77, 0, 5000, 2, 2]
    parties = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w long, s long")
    got = mixing.apportion(parties, "g", "i", "w", "s")
    assert [r["seats"] for r in got.orderBy("i").collect()] == sainte_lague(weights, seats)


def test_mixing_without_words(spark):
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    blank = frame(spark, [(1, None, None, 7, "r", "i", "w", -1, "k"), (2, " ", "a", 7, "r", "i", "w", -1, "k")])
    assert {(r["target"], r["taken"]) for r in mixing.mix_sources(blank).collect()} == {(0.0, 0)}


PAGES = [
    (1, "http://a/\r\nx", "same"), (2, None, "same"), (3, "http://c", None), (4, "http://d", ""),
    (5, "http://e", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n\r\n"), (6, "http://f", "\r\n\r\n"), (7, "http://g", "é你" * 50_000),
    (8, "http://h", "\r\n" * 1001), (9, "http://i", "x\n"), (9, "http://i", "x\n"), (None, "http://j", "same"),
]


@pytest.mark.parametrize("chunk", [64 << 10, 7, 1])
@pytest.mark.parametrize("least", [0, 3])
def test_warc_round_trip(spark, chunk, least):
    rows = [(n, u, h if chunk > 100 or len(h or "") < 9000 else "short") for n, u, h in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = Counter(map(tuple, warc.archive_round_trip(pages, chunk, least).collect()))
    groups: dict[bytes, list] = {}
    for number, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(number)
    expected = Counter()
    for number, _, html in rows:
        data = (html or "").encode()
        best = max((n for n in groups[data] if n is not None), default=None)
        revisit = len(data) >= least and number != best
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected[(number, len(data), digest, "revisit" if revisit else "response", best if revisit else None)] += 1
    assert got == expected


def test_warc_chunks_carry_digests(spark, root):
    text = "é" * 1000
    pages = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    warc.write_archives(pages, f"{root}/w", chunk_bytes=300)
    rows = warc.read_chunks(spark, f"{root}/w", 300).orderBy("chunk_no").collect()
    data, so_far = text.encode(), b""
    for r in rows:
        so_far += bytes(r["chunk"])
        assert r["running_sha1"] == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
        assert len(r["chunk"]) <= 300 and r["last"] == (len(so_far) == len(data))
    assert so_far == data and len(rows) == 7


def test_warc_segments_stay_in_one_file(spark):
    """More records in a task than a file once had, with a page across that border."""
    rows = [(i, f"u{i}", chr(97 + i) * 7001) for i in range(15)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = warc.archive_round_trip(pages, 1).select("page_id", "payload_bytes", "record_type").collect()
    assert sorted(map(tuple, got)) == [(i, 7001, "response") for i in range(15)]


def test_warc_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_records_are_valid(spark, root):
    """What the standard asks of each record, read without the operator's own parser."""
    rows = [(1, "u1", "same"), (2, "u2", "same"), (2, "u3", "same"), (3, None, "x" * 900), (None, "u", None), (4, "u4", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{root}/w", chunk_bytes=400, captured="2020-02-02T02:02:02Z")
    records = []
    for path in sorted(Path(f"{root}/w").glob("*.gz")):
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines)
            length = int(headers["Content-Length"])
            block, end, data = data[:length], data[length : length + 4], data[length + 4 :]
            assert version == "WARC/1.1" and end == b"\r\n\r\n" and headers["WARC-Date"] == "2020-02-02T02:02:02Z"
            records.append((headers, block))
    ids = [h["WARC-Record-ID"] for h, _ in records]
    assert len(ids) == len(set(ids)) == 8
    kinds = Counter(h["WARC-Type"] for h, _ in records)
    assert kinds == {"response": 5, "revisit": 1, "continuation": 2}
    for headers, block in records:
        if headers["WARC-Type"] == "revisit":
            assert headers["WARC-Profile"] == warc.PROFILE and headers["WARC-Refers-To"] in ids and not block
        elif headers["WARC-Type"] == "response":
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and b"\r\n\r\n" in block
            assert headers["Content-Type"] == "application/http; msgtype=response"
        else:
            assert headers["WARC-Segment-Origin-ID"] in ids
    segments = [(int(h["WARC-Segment-Number"]), h, b) for h, b in records if "WARC-Segment-Number" in h]
    total = [h["WARC-Segment-Total-Length"] for _, h, _ in segments if "WARC-Segment-Total-Length" in h]
    assert total == [str(sum(len(b) for _, _, b in segments))]
