"""Benchmark decontamination by winnowing (operator 13).

A window is `WINDOW` consecutive words of a benchmark item; an item of fewer words is one window.
A document word inside any occurrence of a window is hit.

1. Fingerprints. Of the word sequences of `gram_size(window)` words in a window the one with the
   smallest hash is its fingerprint. Equal windows have equal fingerprints, wherever they stand, so
   a span of a window's length that a document and an item share always shares one. Items of
   fewer words have windows of their own length and fingerprints of their own kind.
2. Join. Fingerprints of the items fill a slot table of `2 ** SLOT_BITS` bytes, which goes to every
   task and keeps most fingerprints of documents from being written. The rest meets the items'
   on the hash. Of equal texts one takes part; of equal surroundings in many items, too.
3. Extension. A fingerprint carries the words around it, as far as a window can reach. A pair of
   equal word sequences is extended to both sides word by word; if the common words make up a window,
   they are hit, and the items of that surrounding occur. All windows around a fingerprint lie in
   its surroundings, so nothing has to be looked up in the texts again.

Words are runs of digits, letters a-z (A-Z in lower case) and characters above U+007F.

Defined results: a null or empty text has no words, nothing hit and no items; an item without
words has no windows; a null item id marks words but is not listed; rows repeated with one item id
are one item; each document row is judged by itself, null and repeated ids included; empty tables
give an empty result or one without hits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import gram_hashes, mix, text_bytes, word_hashes, written
from tillmart.llm.slots import EMPTY, marks_of, slot_table

WINDOW = 10
SLOT_BITS = 23

_MARK = "window int, hash long, place int, gram string, before array<string>, after array<string>"
_ITEM_MARKS = f"item string, {_MARK}"
_READ = (
    "id {kind}, text_key binary, n_words long, found array<struct<"
    "window:int,hash:bigint,place:int,gram:string,before:array<string>,after:array<string>>>"
)
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document row: id, n_words, n_hit, items (ids as strings, sorted), spans, contaminated.

    `spans` are (first word, end) of hit words in order; they may overlap.
    """
    item_rows = items.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")
    )
    marks = written(item_rows.mapInArrow(_item_marks(window), _ITEM_MARKS), "item-marks").withColumn(
        "context", F.concat_ws("|", F.concat_ws(" ", "before"), "gram", F.concat_ws(" ", "after"))
    )
    # At most one length for each number of words up to the window.
    lengths = sorted(r["window"] for r in marks.select("window").distinct().collect())
    table = slot_table(marks.select("hash", F.lit(0).alias("mark")), SLOT_BITS)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())
    read = written(
        rows.mapInArrow(
            _doc_marks(lengths, shared), _READ.format(kind=rows.schema["id"].dataType.simpleString())
        ),
        "document-marks",
    )
    found = (
        read.filter(F.size("found") > 0)
        .groupBy("text_key")
        .agg(F.first("found").alias("found"))
        .select("text_key", F.explode("found").alias("f"))
        .select("text_key", "f.*")
    )
    contexts = marks.select(
        "window",
        "hash",
        F.col("gram").alias("item_gram"),
        F.col("before").alias("item_before"),
        F.col("after").alias("item_after"),
        "context",
    ).distinct()
    size = F.size(F.split("gram", " "))
    left, right = _common("before", "item_before"), _common("after", "item_after")
    met = written(
        found.join(contexts, ["window", "hash"])
        .filter(F.col("gram") == F.col("item_gram"))
        .filter(left + size + right >= F.col("window"))
        .select(
            "text_key",
            "context",
            "place",
            (F.col("place") - left).alias("start"),
            (F.col("place") + size + right).alias("end"),
        ),
        "benchmark-hits",
    )
    hit = (
        met.groupBy("text_key", "place")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    )
    owners = marks.filter("item is not null").select("context", "item").distinct()
    named = (
        met.select("text_key", "context")
        .distinct()
        .join(owners, "context")
        .select("text_key", "item")
        .distinct()
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    hits = written(
        hit.join(named, "text_key", "left").select("text_key", "spans", "items"), "benchmark-spans"
    )
    none = F.array().cast("array<string>")
    return (
        read.select("id", "text_key", "n_words")
        .join(hits, "text_key", "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce(_covered("spans"), F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            F.col("spans").isNotNull().alias("contaminated"),
        )
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` without a hit, with all their columns."""
    numbered = docs.select(F.struct(*docs.columns).alias("row")).select(
        "row", F.struct(f"row.{id_col}", F.sha2(F.coalesce(f"row.{text_col}", F.lit("")), 256)).alias("key")
    )
    texts = numbered.select("key", F.col(f"row.{text_col}").alias("text"))
    leaks = find_leaks(texts, items, "key", "text", **options).filter("contaminated").select("key").distinct()
    return numbered.join(written(leaks, "leaks"), "key", "left_anti").select("row.*")


def gram_size(window: int) -> int:
    """Words of a fingerprint: three fifths of the window, rounded up."""
    return -(-3 * window // 5)


def _common(one: str, two: str) -> Column:
    """Number of leading elements that two arrays share."""
    same = F.zip_with(one, two, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _covered(spans: str) -> Column:
    """Number of words in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("reach"))

    def add(seen: Column, span: Column) -> Column:
        fresh = span["end"] - F.greatest(span["start"], seen["reach"])
        return F.struct(
            (seen["words"] + F.greatest(fresh, F.lit(0))).alias("words"),
            F.greatest(seen["reach"], span["end"]).alias("reach"),
        )

    return F.aggregate(spans, start, add, lambda seen: seen["words"])


# --- in tasks -------------------------------------------------------------------------


def fingerprints(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the fingerprints of all windows, given the hashes of the words."""
    size = gram_size(window)
    many = len(words) - window + 1
    if many < 1:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    grams = gram_hashes(words ^ np.uint64(window), size)
    least, places = grams[:many].copy(), np.zeros(many, dtype=np.int64)
    for step in range(1, window - size + 1):
        other = grams[step : step + many]
        less = other < least
        least[less] = other[less]
        places[less] = step
    places += np.arange(many)
    # The first of equal hashes: places never go back.
    chosen = places[np.concatenate(([True], places[1:] != places[:-1]))]
    return chosen, mix(grams[chosen])


def _surroundings(words: list[bytes], place: int, window: int) -> tuple[str, list[str], list[str]]:
    """The fingerprint, and the words before (nearest first) and behind it that a window can reach."""
    size = gram_size(window)
    reach = window - size
    before = [w.decode() for w in words[max(0, place - reach) : place]]
    after = [w.decode() for w in words[place + size : place + size + reach]]
    return b" ".join(words[place : place + size]).decode(), before[::-1], after


def _item_marks(longest: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item", "window", "hash", "place", "gram", "before", "after"]
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch.column("text")), strict=True):
                folded = (text or b"").translate(_FOLD)
                words = folded.split()
                if not words:
                    continue
                window = min(longest, len(words))
                places, hashes = fingerprints(word_hashes(folded), window)
                for place, value in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    rows.append((item, window, value, place, *_surroundings(words, place, window)))
            types = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.list_(pa.string())] * 2)
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return run


def _doc_marks(lengths: list[int], shared) -> Callable:
    kind = pa.list_(
        pa.struct(
            [("window", pa.int32()), ("hash", pa.int64()), ("place", pa.int32()), ("gram", pa.string())]
            + [(name, pa.list_(pa.string())) for name in ("before", "after")]
        )
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            keys, counts, found = [], [], []
            for text in text_bytes(batch.column("text")):
                folded = (text or b"").translate(_FOLD)
                hashes = word_hashes(folded)
                keys.append(hashlib.blake2b(folded, digest_size=16).digest())
                counts.append(len(hashes))
                found.append(_met(folded, hashes, lengths, table))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, kind)],
                names=["id", "text_key", "n_words", "found"],
            )

    return run


def _met(folded: bytes, hashes: np.ndarray, lengths: list[int], table: np.ndarray) -> list[tuple]:
    """Fingerprints of a text that may be an item's."""
    out, words = [], []
    for window in lengths:
        places, values = fingerprints(hashes, window)
        hit = marks_of(table, values) != EMPTY
        if hit.any():
            words = words or folded.split()
            for place, value in zip(places[hit].tolist(), values[hit].view(np.int64).tolist(), strict=True):
                out.append((window, value, place, *_surroundings(words, place, window)))
    return out
