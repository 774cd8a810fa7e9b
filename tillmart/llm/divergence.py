"""Source divergence audit by a minimal-perfect-hash recount (operator 11).

How far the word use of a source differs from that of the other sources of its language, and by
which terms. Terms are runs of letters a-z (A-Z in lower case) and characters above U+007F. A
language keeps the terms that occur in at least `LEAST_DOCS` of its documents, V of them. With N kept
terms in a group, a term that occurs c times there has p = 1 + floor(10^9 (c + 1) / (N + V)), and
f = floor((p - q)^2 / q) compares the p of a group with a q.

1. Filter. Exact document frequencies, summed up in tasks before the shuffle.
2. Perfect hashes. The kept terms of a language are dealt into shards of about `SHARD_TERMS` terms; a
   task builds a minimal perfect hash for each (hash and displace: buckets of a few terms, the large
   ones first, get the first displacement without a clash; single terms get a free slot named).
   The shard keeps its terms in slot order.
3. Recount. Shards go to the tasks in rounds of at most `ROUND_BYTES`, whatever the vocabulary; a round
   reads the documents of its languages only. A task looks a term up, compares the stored key, and
   increments a dense array of slots per (language, source), passed on as sparse sums.
4. Comparison. Slots in blocks of `BLOCK` terms: a block's task lays its counts out as a dense matrix of
   sources and terms, and gives the sums of f for each pair of sources and each source's `TOP` best
   terms. Their sums and best are taken over all blocks.

Defined results: null text, language and source count as empty texts; each row is a document; a group without terms
has N = 0; a language without kept terms has pairs of value 0 and no terms; an empty table gives an
empty result. Other columns are ignored. Arithmetic is exact; where 64 bits would not do, Python's
integers are used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import mix, text_bytes, written

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
SHARD_TERMS = 1 << 15
ROUND_BYTES = 64 << 20
BLOCK = 2048

_HELD_TERMS = 400_000
_HELD_SLOTS = 8 << 20
_PART_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_SHARD = "lang string, shard int, terms long, seed int, displace binary, lengths binary, keys binary"
_TABLES = ("displace", "lengths", "keys")
_FOUND = "part string, lang string, source string, item string, value long"


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank."""
    rows = docs.select(
        *(
            F.coalesce(F.col(given), F.lit("")).alias(name)
            for given, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        )
    )
    shards = perfect_hashes(kept_terms(rows, least_docs))
    counts, terms = recount(rows, shards, round_bytes)
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(
        rows.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v"))),
        "audit-groups",
    )
    found = written(_blocks(groups, counts, terms).applyInArrow(_compare(top), _FOUND), "audit-blocks")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        groups.select("lang", "source")
        .join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .join(sums, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    best = found.filter("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionAll(best.select("*", rank).filter(F.col("rank") <= top))


def kept_terms(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term: the terms of enough documents."""
    seen = rows.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    return written(
        seen.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term"),
        "kept-terms",
    )


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """A row per shard: its terms in slot order and the displacements that lead to them."""
    dealt = kept.join(shard_counts(kept.select("lang", F.lit(1).alias("terms"))), "lang").mapInArrow(_deal, "lang string, shard int, term string")
    return written(dealt.groupBy("lang", "shard").applyInArrow(_build, _SHARD), "perfect-hashes")


def shard_counts(sized: DataFrame) -> DataFrame:
    """lang, shards: among how many shards the terms of a language are dealt."""
    return sized.groupBy("lang").agg(F.ceil(F.sum("terms") / SHARD_TERMS).cast("int").alias("shards"))


def recount(rows: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> tuple[DataFrame, DataFrame]:
    """Occurrences (lang, source, id, n) of the kept terms, and the terms (lang, id, term) of the ids.

    Ids count the slots of a language's shards on. A table of shards has a row per
    `SHARD_TERMS` terms; the driver plans the rounds with their sizes.
    """
    spark = rows.sparkSession
    size = F.octet_length("displace") + F.octet_length("lengths") + F.octet_length("keys")
    listed = shards.select("lang", "shard", "terms", size.alias("size")).orderBy("lang", "shard").collect()
    bases, rounds, room = {}, [], 0
    ends: Counter = Counter()
    for row in listed:
        bases[row["lang"], row["shard"]] = ends[row["lang"]]
        ends[row["lang"]] += row["terms"]
        if not rounds or row["size"] > room:
            rounds.append([])
            room = round_bytes
        rounds[-1].append((row["lang"], row["shard"]))
        room -= row["size"]
    many = {row["lang"]: row["shards"] for row in shard_counts(shards).collect()}
    counts = None
    for chosen in rounds:
        spans = [
            (lang, min(s for x, s in chosen if x == lang), max(s for x, s in chosen if x == lang))
            for lang in sorted({lang for lang, _ in chosen})
        ]
        wanted = F.lit(False)
        for lang, low, high in spans:
            wanted |= (F.col("lang") == lang) & F.col("shard").between(low, high)
        tables = [
            (r["lang"], r["shard"], bases[r["lang"], r["shard"]], r["seed"], *(bytes(r[c]) for c in _TABLES))
            for r in shards.filter(wanted).collect()
        ]
        shared = spark.sparkContext.broadcast((tables, {lang: many[lang] for lang, _, _ in spans}))
        texts = rows.filter(F.col("lang").isin([lang for lang, _, _ in spans]))
        part = written(texts.mapInArrow(_slot_counts(shared), "lang string, source string, id long, n long"), "slots")
        counts = part if counts is None else counts.unionAll(part)
    if counts is None:
        counts = rows.select("lang", "source", F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("n")).limit(0)
    summed = written(counts.groupBy("lang", "source", "id").agg(F.sum("n").alias("n")), "term-counts")
    before = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.select("lang", "shard", "terms").withColumn("base", F.coalesce(F.sum("terms").over(before), F.lit(0)))
    named = shards.select("lang", "shard", "lengths", "keys").join(based.select("lang", "shard", "base"), ["lang", "shard"])
    terms = named.mapInArrow(_names, "lang string, id long, term string")
    return summed, written(terms, "terms")


def _blocks(groups: DataFrame, counts: DataFrame, terms: DataFrame):
    """All that a block of terms needs, under its language and number: its terms, its counts, all groups."""
    block = F.floor(F.col("id") / BLOCK).alias("block")
    none = {"source": "string", "term": "string", "id": "long", "n": "long", "total": "long", "v": "long"}

    def laid(frame: DataFrame, *have: str) -> DataFrame:
        rest = [F.col(c) if c in have else F.lit(None).cast(kind).alias(c) for c, kind in none.items()]
        return frame.select("lang", "block", *rest)

    names = terms.select("lang", block, "id", "term")
    parts = laid(names, "id", "term").unionAll(laid(counts.select("*", block), "source", "id", "n"))
    heads = names.select("lang", "block").distinct().join(groups, "lang")
    return parts.unionAll(laid(heads, "source", "total", "v")).groupBy("lang", "block")


# --- in tasks -------------------------------------------------------------------------


def term_parts(text: bytes, size: int = _PART_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, in parts of about `size` bytes."""
    folded = text.translate(_FOLD)
    begin = 0
    while len(folded) - begin > size:
        end = folded.find(b" ", begin + size)
        if end < 0:
            break
        yield folded[begin:end].split()
        begin = end
    yield folded[begin:].split()


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def passed() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts), pa.string()),
                    pa.array(list(counts), pa.binary()).cast(pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "term", "docs"],
            )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text")), strict=True):
            terms = set()
            for part in term_parts(text):
                terms.update(part)
            held.setdefault(lang, Counter()).update(terms)
            if sum(map(len, held.values())) > _HELD_TERMS:
                yield from passed()
    yield from passed()


def term_hashes(terms: list[bytes], seed: int = 0) -> np.ndarray:
    import xxhash

    hashed = xxhash.xxh3_64_intdigest
    return np.fromiter((hashed(t, seed) for t in terms), dtype=np.uint64, count=len(terms))


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(hashes ^ _STEP) % np.uint64(shards)).astype(np.int64)


def _deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = term_hashes(text_bytes(batch.column("term")))
        shards = mix(hashes ^ _STEP) % batch.column("shards").to_numpy().astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(shards.astype(np.int32)), batch.column("term")],
            names=["lang", "shard", "term"],
        )


def _places(hashes: np.ndarray, displace: np.ndarray, size: int) -> np.ndarray:
    """Slot of each hash, given the displacement of its bucket."""
    return (mix(hashes + displace.astype(np.uint64) * _STEP) % np.uint64(size)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, slot per hash) of distinct hashes, as many slots as hashes.

    A displacement of 0 or more moves the terms of a bucket; -1 - s names slot s for its single term.
    """
    size = len(hashes)
    buckets = max(1, size // 2)
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    many = np.bincount(bucket, minlength=buckets)
    first = np.concatenate(([0], np.cumsum(many)[:-1]))
    displace = np.zeros(buckets, dtype=np.int32)
    slots = np.empty(size, dtype=np.int64)
    used = np.zeros(size, dtype=bool)
    by_size = np.argsort(-many, kind="stable")
    for b in by_size[: int((many > 1).sum())]:
        members = order[first[b] : first[b] + many[b]]
        begin, tried = 0, 32
        while True:
            steps = np.arange(begin, begin + tried)
            places = _places(hashes[members][:, None], steps[None, :], size)
            ordered = np.sort(places, axis=0)
            good = ~used[places].any(axis=0) & (ordered[1:] != ordered[:-1]).all(axis=0)
            if good.any():
                at = int(np.argmax(good))
                break
            begin, tried = begin + tried, min(tried * 2, 4096)
        displace[b] = steps[at]
        slots[members] = places[:, at]
        used[places[:, at]] = True
    alone = by_size[(many > 1).sum() : (many > 0).sum()]
    free = np.flatnonzero(~used)
    displace[alone] = -1 - free
    slots[order[first[alone]]] = free
    return displace, slots


def _build(rows: pa.Table) -> pa.Table:
    terms = text_bytes(rows.column("term").combine_chunks())
    seed = 0
    hashes = term_hashes(terms)
    while len(np.unique(hashes)) < len(terms):
        seed += 1
        hashes = term_hashes(terms, seed)
    displace, slots = perfect_hash(hashes)
    keys = [b""] * len(terms)
    for slot, term in zip(slots.tolist(), terms, strict=True):
        keys[slot] = term
    return pa.table(
        {
            "lang": rows.column("lang").slice(0, 1),
            "shard": rows.column("shard").slice(0, 1),
            "terms": pa.array([len(terms)], pa.int64()),
            "seed": pa.array([seed], pa.int32()),
            "displace": pa.array([displace.tobytes()], pa.binary()),
            "lengths": pa.array([np.array([len(k) for k in keys], dtype=np.int32).tobytes()], pa.binary()),
            "keys": pa.array([b"".join(keys)], pa.binary()),
        }
    )


def _stored(lengths: bytes, keys: bytes) -> pa.Array:
    """The terms of a shard in slot order."""
    sizes = np.frombuffer(lengths, dtype=np.int32)
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(keys)])


def _names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            terms = _stored(row["lengths"], row["keys"])
            many = len(terms)
            ids = np.arange(row["base"], row["base"] + many)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * many, pa.string()), pa.array(ids), terms.cast(pa.string())],
                names=["lang", "id", "term"],
            )


class _Slots:
    """The perfect hashes of one round: where a term of a language counts."""

    def __init__(self, tables: list[tuple], shards: dict[str, int]):
        self.shards = shards
        self.tables: dict[str, dict[int, tuple]] = {}
        for lang, shard, base, seed, displace, lengths, keys in tables:
            stored = _stored(lengths, keys)
            self.tables.setdefault(lang, {})[shard] = (base, seed, np.frombuffer(displace, dtype=np.int32), stored)
        self.low = {lang: min(t[0] for t in x.values()) for lang, x in self.tables.items()}
        self.size = {lang: max(t[0] + len(t[3]) for t in x.values()) - self.low[lang] for lang, x in self.tables.items()}

    def find(self, lang: str, terms: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in `terms`, slots counted from `low`) of the terms that are kept."""
        hashes = term_hashes(terms)
        shard_of = _shard_of(hashes, self.shards[lang])
        given = pa.array(terms, pa.binary())
        for shard, (base, seed, displace, stored) in self.tables[lang].items():
            places = np.flatnonzero(shard_of == shard)
            if not len(places):
                continue
            h = hashes[places] if not seed else term_hashes([terms[i] for i in places], seed)
            moved = displace[((h >> np.uint64(32)) % np.uint64(len(displace))).astype(np.int64)]
            slots = np.where(moved < 0, -1 - moved.astype(np.int64), _places(h, np.maximum(moved, 0), len(stored)))
            equal = pc.equal(stored.take(pa.array(slots)), given.take(pa.array(places)))
            same = equal.to_numpy(zero_copy_only=False)
            yield places[same], slots[same] + (base - self.low[lang])


def _slot_counts(shared) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots(*shared.value)
        dense: dict[tuple, np.ndarray] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for (lang, source), sums in dense.items():
                hit = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(hit), pa.string()),
                        pa.array([source] * len(hit), pa.string()),
                        pa.array(hit + slots.low[lang]),
                        pa.array(sums[hit]),
                    ],
                    names=["lang", "source", "id", "n"],
                )
            dense.clear()

        def count(group: tuple, terms: Counter) -> None:
            sums = dense[group]
            times = np.fromiter(terms.values(), dtype=np.int64, count=len(terms))
            for places, found in slots.find(group[0], list(terms)):
                sums[found] += times[places]

        for batch in batches:
            pending: dict[tuple, Counter] = {}
            columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for lang, source, text in zip(*columns, text_bytes(batch.column("text")), strict=True):
                terms = pending.setdefault((lang, source), Counter())
                for part in term_parts(text):
                    terms.update(part)
            for group, terms in pending.items():
                if group not in dense:
                    if sum(map(len, dense.values())) + slots.size[group[0]] > _HELD_SLOTS:
                        yield from passed()
                    dense[group] = np.zeros(slots.size[group[0]], dtype=np.int64)
                count(group, terms)
        yield from passed()

    return run


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of each count: 1 + floor(10^9 (c + 1) / (N + V))."""
    if total + kept < 9_000_000_000:
        return 1 + SCALE * (counts + 1) // (total + kept)
    return (1 + SCALE * (counts.astype(object) + 1) // (total + kept)).astype(np.int64)


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f of each pair of shares; both are at most 10^9 + 1, so the square fits 64 bits."""
    return (p - q) ** 2 // q


def _compare(top: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        lang = rows.column("lang")[0].as_py()
        heads = rows.filter(pc.is_valid(rows.column("total"))).sort_by("source")
        names = rows.filter(pc.is_valid(rows.column("term"))).sort_by("id")
        given = rows.filter(pc.is_valid(rows.column("n")))
        sources = heads.column("source").to_pylist()
        totals = heads.column("total").to_pylist()
        kept = heads.column("v")[0].as_py()
        ids = names.column("id").to_numpy()
        counts = np.zeros((len(sources), len(ids)), dtype=np.int64)
        line = {s: i for i, s in enumerate(sources)}
        at = np.array([line[s] for s in given.column("source").to_pylist()], dtype=np.int64)
        counts[at, np.searchsorted(ids, given.column("id").to_numpy())] = given.column("n").to_numpy()
        whole = shares(counts.sum(axis=0), sum(totals), kept)
        p = np.array([shares(c, t, kept) for c, t in zip(counts, totals, strict=True)])
        words = text_bytes(names.column("term").combine_chunks())
        out: list[tuple] = []
        for i, source in enumerate(sources):
            sums = distances(p[i], p).sum(axis=1).tolist()
            out += [("pair", lang, source, s, v) for j, (s, v) in enumerate(zip(sources, sums, strict=True)) if j != i]
            more = np.flatnonzero((counts[i] > 0) & (p[i] > whole))
            values = distances(p[i][more], whole[more])
            if len(more) > top:
                few = values >= np.partition(values, -top)[-top]
                more, values = more[few], values[few]
            best = sorted(zip((-values).tolist(), more.tolist(), strict=True), key=lambda x: (x[0], words[x[1]]))
            out += [("term", lang, source, words[m].decode(), -v) for v, m in best[:top]]
        fields = [c.split() for c in _FOUND.split(", ")]
        columns = zip(*out, strict=True) if out else [[]] * len(fields)
        kinds = {"string": pa.string(), "long": pa.int64()}
        return pa.table({n: pa.array(list(c), kinds[k]) for (n, k), c in zip(fields, columns, strict=True)})

    return run
