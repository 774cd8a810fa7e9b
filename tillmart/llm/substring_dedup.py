"""Substring dedup with suffix automata of reference shards (operator 1).

A word of a document goes if a window of `WINDOW` consecutive words that covers it also
starts in a document with a smaller id. All windows of all documents are judged, on the
input as it is.

1. Anchors. Among the `GRAM`-word sequences of a window the one with the smallest hash is its
   anchor, so equal windows have equal anchors. Consecutive windows with one anchor form a
   run; a text has about 2 runs in `WINDOW - GRAM + 2` words. Anchors that occur in one text
   only (exact copies count as one) cannot belong to a repeated window and are left out here.
2. Shards. The texts of the remaining runs, each kept once with its smallest id, are dealt by
   anchor and form the reference shards: what can match a run is in the run's own shard. A
   shard holds at most about `SHARD_WORDS` words. A task builds the suffix automaton of a shard,
   with the smallest document per state, and streams the runs through it: the matching statistic
   at each word, cut to `WINDOW` words, gives the smallest document that holds the window.
3. Removal. Every document gets the windows whose smallest document is not itself, as spans
   joined to maximal ones, and its words outside them.

The reference is the corpus itself and has no size bound, so automata are not broadcast: each is
built where the runs that need it arrive. An anchor with more than `CROWD` distinct runs (the edge
of a passage that many documents hold, with other words around it in each) would make one shard
grow with the corpus; windows of such runs are compared by their 128-bit hashes instead, summed
up before the shuffle.

Defined results: a null or empty text has no words; a text shorter than a window loses
nothing; a document repeated within itself is no duplicate; rows repeated with the same id are
not smaller than each other, and each is judged by its own text; of exact copies all but those with the smallest id lose every word
if they have a window; a null id loses nothing and counts for nobody; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import gram_hashes, mix, text_bytes, word_hashes, written

WINDOW = 50
GRAM = 12
SHARD_WORDS = 20_000
CROWD = 1_000

_RUNS = "id long, text_key long, anchor long, start int, windows int"
_PIECES = "id long, text_key long, anchor long, start int, piece binary"
_OWNERS = "anchor long, piece_key binary, owners array<long>"


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text, spans (first word, end) removed."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # An id may come with several texts: each has its own runs and spans.
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    runs = written(texts.mapInArrow(_runs(window, gram), _RUNS), "anchor-runs")
    firsts = written(
        runs.groupBy("text_key").agg(F.min("id").alias("first_id")), "first-texts"
    )
    shared = written(
        runs.groupBy("anchor")
        .agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"))
        .filter("low < high")
        .select("anchor"),
        "shared-anchors",
    )
    # Only the first of equal texts is searched; the others lose all their windows.
    wanted = written(
        runs.join(shared.hint("merge"), "anchor")
        .join(firsts.hint("merge"), "text_key")
        .filter("id = first_id")
        .groupBy("id", "text_key")
        .agg(F.collect_set(F.struct("start", "windows", "anchor")).alias("runs")),
        "wanted-runs",
    )
    pieces = texts.join(wanted.hint("merge"), ["id", "text_key"]).select("id", "text_key", "text", "runs")
    pieces = written(
        pieces.mapInArrow(_pieces(window), _PIECES).withColumn(
            "piece_key", F.unhex(F.md5("piece"))
        ),
        "pieces",
    )
    reference = written(
        pieces.groupBy("anchor", "piece_key")
        .agg(F.min("id").alias("first_id"), F.first("piece").alias("piece")),
        "reference",
    )
    owners = _owners(reference, window)
    covered = (
        pieces.select("id", "text_key", "anchor", "start", "piece_key")
        .join(owners.hint("merge"), ["anchor", "piece_key"])
        .select("id", "text_key", "start", F.transform("owners", lambda o: o < F.col("id")).alias("taken"))
        .filter(F.exists("taken", lambda t: t))
        .groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("start", "taken")).alias("taken"))
    )
    copies = (
        runs.select("id", "text_key")
        .distinct()
        .join(firsts.hint("merge"), "text_key")
        .filter("id > first_id")
        .select("id", "text_key", F.lit(True).alias("copy"))
        .distinct()
    )
    found = written(
        covered.join(copies.hint("merge"), ["id", "text_key"], "full").select(
            "id", "text_key", "taken", F.coalesce("copy", F.lit(False)).alias("copy")
        ),
        "covered",
    )
    out = texts.join(found.hint("merge"), ["id", "text_key"], "left").mapInArrow(
        _cut(window), "id long, n_words long, n_removed long, kept_text string, spans array<struct<start:int,end:int>>"
    )
    return out.withColumnRenamed("id", id_col)


def _owners(reference: DataFrame, window: int) -> DataFrame:
    """Smallest document of every window of every reference piece, by anchor and piece."""
    crowds = written(
        reference.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("anchor"),
        "crowded-anchors",
    )
    usual = reference.join(crowds.hint("merge"), "anchor", "left_anti")
    sharded = (
        usual.select("anchor", "piece_key", "first_id", "piece")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_automata(window), _OWNERS)
    )
    spread = (
        reference.join(crowds.hint("merge"), "anchor", "left_semi")
        .mapInArrow(
            _windows(window), "anchor long, piece_key binary, first_id long, place int, h1 long, h2 long"
        )
    )
    spread = written(spread, "crowded-windows")
    least = written(
        spread.groupBy("h1", "h2").agg(F.min("first_id").alias("owner")), "crowded-owners"
    )
    crowded = (
        spread.join(least.hint("merge"), ["h1", "h2"])
        .groupBy("anchor", "piece_key")
        .agg(F.array_sort(F.collect_list(F.struct("place", "owner"))).alias("found"))
        .select("anchor", "piece_key", F.col("found.owner").alias("owners"))
    )
    return written(sharded.unionAll(crowded), "owners")


# --- in tasks -------------------------------------------------------------------------


def anchors(text: bytes | None, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of each run of a text."""
    words = word_hashes(text)
    none = np.empty(0, dtype=np.int64)
    if len(words) < window:
        return none.astype(np.uint64), none, none
    grams = gram_hashes(words, gram)
    width = window - gram + 1
    places = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    places += np.arange(len(places))
    starts = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    sizes = np.diff(np.append(starts, len(places)))
    return grams[places[starts]], starts, sizes


def _runs(window: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _RUNS.split(", ")]
        for batch in batches:
            ids, keys = batch.column("id").to_pylist(), batch.column("text_key").to_pylist()
            parts: list[tuple] = []
            for number, key, text in zip(ids, keys, text_bytes(batch.column("text")), strict=True):
                if number is None:
                    continue
                found, starts, sizes = anchors(text, window, gram)
                if len(starts):
                    many = len(starts)
                    parts.append((np.full(many, number), np.full(many, key), found, starts, sizes))
                if len(parts) >= 500:
                    yield _columns(parts, names)
                    parts = []
            if parts:
                yield _columns(parts, names)

    return run


def _columns(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    number, key, found, starts, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(number.astype(np.int64)),
            pa.array(key.astype(np.int64)),
            pa.array(found.astype(np.int64)),
            pa.array(starts.astype(np.int32)),
            pa.array(sizes.astype(np.int32)),
        ],
        names=names,
    )


def _pieces(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in batches:
            rows, size = [], 0
            texts = text_bytes(batch.column("text"))
            columns = (batch.column("id"), batch.column("text_key"), texts, batch.column("runs"))
            for number, key, text, runs in zip(*columns, strict=True):
                words = text.split()
                for found in runs.as_py():
                    start = found["start"]
                    piece = b" ".join(words[start : start + found["windows"] + window - 1])
                    rows.append((number.as_py(), key.as_py(), found["anchor"], start, piece))
                    size += len(piece)
                if size > 4 << 20:
                    yield _piece_batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _piece_batch(rows, names)

    return run


def _piece_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


class SuffixAutomaton:
    """Suffix automaton of several word sequences; a state knows its smallest document."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least: list[int] = [2**63 - 1]

    def _new(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        self.least.append(2**63 - 1)
        return len(self.link) - 1

    def _split(self, state: int, word, target: int) -> int:
        """A copy of `target` for the strings that come from `state` by `word`."""
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list, document: int) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                if self.length[target] != self.length[last] + 1:
                    target = self._split(last, word, target)
                last = target
            else:
                fresh = self._new(self.length[last] + 1, {}, 0)
                state = last
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = fresh
                    state = self.link[state]
                if state >= 0:
                    target = self.next[state][word]
                    if self.length[target] != self.length[state] + 1:
                        target = self._split(state, word, target)
                    self.link[fresh] = target
                last = fresh
            if document < self.least[last]:
                self.least[last] = document

    def close(self) -> None:
        """Hand the smallest documents down the suffix links, from long strings to short ones."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def owners(self, words: list, window: int) -> list[int]:
        """Smallest document of each window of `words`, from the matching statistic cut to a window."""
        state, size, out = 0, 0, []
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size += 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
            size = min(size, window)
            if place >= window - 1:
                out.append(self.least[state] if size >= window else 2**63 - 1)
        return out


def _automata(window: int):
    def shard_owners(shard: list[tuple]) -> Iterator[tuple]:
        automaton = SuffixAutomaton()
        for _, _, first, words in shard:
            automaton.add(words, first)
        automaton.close()
        for anchor, key, _, words in shard:
            yield anchor, key, automaton.owners(words, window)

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Pieces of one anchor at a time; a partition is sorted by anchor."""
        group: list[tuple] = []
        for batch in batches:
            for anchor, key, first, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if group and group[0][0] != anchor:
                    yield group
                    group = []
                group.append((anchor, key, first, piece.split()))
        if group:
            yield group

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        words, out = 0, []
        for group in groups(batches):
            if len(group) == 1:
                # One text only: all its windows match themselves.
                anchor, key, first, piece = group[0]
                out.append((anchor, key, [first] * (len(piece) - window + 1)))
            else:
                shard += group
                words += sum(len(piece) for _, _, _, piece in group)
            if words >= SHARD_WORDS:
                out += shard_owners(shard)
                shard, words = [], 0
            if len(out) >= 5_000:
                yield _owner_batch(out)
                out = []
        out += shard_owners(shard)
        if out:
            yield _owner_batch(out)

    return run


def _owner_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=["anchor", "piece_key", "owners"],
    )


def _windows(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            pieces = [word_hashes(p.as_py()) for p in batch.column("piece")]
            for words in pieces:
                parts.append((gram_hashes(words, window), gram_hashes(mix(words + np.uint64(1)), window)))
            if not parts:
                continue
            sizes = np.array([len(p[0]) for p in parts])
            rows = pa.array(np.repeat(np.arange(len(parts)), sizes))
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in ("anchor", "piece_key", "first_id")),
                    pa.array(places),
                    *(pa.array(np.concatenate([p[i] for p in parts]).astype(np.int64)) for i in (0, 1)),
                ],
                names=["anchor", "piece_key", "first_id", "place", "h1", "h2"],
            )

    return run


def _cut(window: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                cut_text(text, taken.as_py(), copy.as_py(), window)
                for text, taken, copy in zip(
                    text_bytes(batch.column("text")), batch.column("taken"), batch.column("copy"), strict=True
                )
            ]
            words, removed, kept, spans = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([k.decode() for k in kept], pa.string()),
                    pa.array(spans, pa.list_(span)),
                ],
                names=["id", "n_words", "n_removed", "kept_text", "spans"],
            )

    return run


def cut_text(text: bytes | None, taken: list | None, copy: bool | None, window: int):
    """(words, removed words, kept text, removed spans) of a document."""
    words = (text or b"").split()
    if copy and len(words) >= window:
        return len(words), len(words), b"", [{"start": 0, "end": len(words)}]
    if not taken:
        return len(words), 0, b" ".join(words), []
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for found in taken:
        starts = found["start"] + np.flatnonzero(found["taken"])
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    spans = [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)]
    kept = b" ".join([w for w, out in zip(words, gone.tolist(), strict=True) if not out])
    return len(words), int(gone.sum()), kept, spans
