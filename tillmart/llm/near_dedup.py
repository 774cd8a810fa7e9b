"""MinHash near-dedup with an LSH forest (operator 6).

A document's set is its distinct `SHINGLE`-word shingles (A-Z in lower case). Documents with
equal sets form a class, which its smallest id stands for. Every class has `TREES` MinHash
signatures of `DEPTH` values. Each tree sorts all signatures by range partitioning, and a
class meets the `NEIGHBOURS` next in order with which it shares at least `LEAST_DEPTH`
leading values. Where signatures are crowded the neighbours in order share longer prefixes.

Candidates are confirmed on the full sets (64-bit shingle hashes): linked at
`100 * intersection >= percent * union`. Components of the links come from alternating stars.

A run of classes that share `LEAST_DEPTH` values and are more than meet each other so is a
crowd if it still holds several components. Each class of a large crowd meets the one whose
values are the most frequent there, which is the original of independently edited copies. The
classes of the crowds that are left go through an exact join by rare shingles: in the order of
their frequency among them, rarest first, two sets that are alike share one of the first
`n - ceil(percent * n / 100) + 1` shingles of both. Shingles of one class only take
up such places and meet nobody, so classes that differ by shingles of their own hardly meet. A
shingle whose classes are all of one component is left out. The classes of a shingle and their sets
are dealt to a task, in blocks of `CELL`, which compares them where the shingle is the first in common and
enough shingles follow, and passes on the links that join components only: fewer than it has classes.
Sets go only to cells where sizes and places leave a class a partner.

At similarity 0.85 two values agree with probability 0.85, a prefix of three in 61 of 100
trees; sixteen trees all miss a pair with probability 3e-7 (1e-5 at 0.8). Rows on both sides of a
partition's border are not compared in that tree, unless they are of a crowd.

Defined results: a document without words or text has an empty set and is a component of
its own; with fewer words than a shingle the whole sequence is the only one; rows repeated
with one id and text are one class, with several texts they are linked with each other; a null id is linked
with nothing and its component is null; an empty table gives an empty result. Other columns are
kept by `keep_one` only, under any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import gram_hashes, mix, text_bytes, word_hashes, written
from tillmart.llm.components import connected_components

SHINGLE = 5
TREES, DEPTH, LEAST_DEPTH, NEIGHBOURS = 16, 8, 3, 2
BLOCK, LARGE, CELL = 512, 64, 2048
PERCENT = 85  # linked if 100 * intersection >= PERCENT * union

_RNG = np.random.Generator(np.random.PCG64(6))
_FACTORS = _RNG.integers(1, 2**32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_CHUNK = 1 << 16
_SET_COLUMNS = "id long, n_shingles long, k1 long, k2 long, signature binary"


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = written(texts.mapInArrow(_sets, _SET_COLUMNS), "shingle-sets")
    full = sets.filter("n_shingles > 0 and id is not null")
    classes = written(
        full.groupBy("k1", "k2").agg(
            F.min("id").alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
        ),
        "shingle-classes",
    )
    links = confirm(candidates(classes, percent), texts, percent)
    named = _merged(classes.withColumn("component", F.col("rep")), links.unionAll(_same_id(full, classes)))
    members = crowd_members(named)
    if not members.isEmpty():
        links = confirm(hub_pairs(members, percent), texts, percent)
        if not links.isEmpty():
            named = _merged(named, links)
            members = crowd_members(named)
        links = crowd_links(members, texts, percent)
        if not links.isEmpty():
            named = _merged(named, links)
    return (
        sets.select("id", "n_shingles", "k1", "k2")
        .join(named.select("k1", "k2", "component"), ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(
                (F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")
            ).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows that stay, with all their columns: one document of each component."""
    kept = components(docs, id_col, text_col, percent).filter("kept").select(F.col(id_col).alias("id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.join(
        kept.hint("merge"), F.col(f"row.{id_col}").cast("long").eqNullSafe(F.col("id")), "left_semi"
    ).select("row.*")


def _same_id(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of the classes that rows of one id belong to."""
    several = (
        full.groupBy("id")
        .agg(F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high"))
        .filter("low < high")
        .select("id")
    )
    reps = full.select("id", "k1", "k2").join(several, "id").join(classes.select("k1", "k2", "rep"), ["k1", "k2"])
    hubs = reps.groupBy("id").agg(F.min("rep").alias("a"))
    return reps.join(hubs, "id").select("a", F.col("rep").alias("b")).filter("a < b").distinct()


def candidates(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b), a < b, of classes that are neighbours in some tree."""
    width = 2 * DEPTH
    trees = classes.select(
        "rep",
        F.col("n").cast("int").alias("n"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(TREES - 1)),
                lambda t: F.substring(F.col("signature"), t * width + 1, F.lit(width)),
            )
        ).alias("tree", "key"),
    ).withColumn("tree", F.col("tree").cast("byte"))
    ordered = trees.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep")
    return written(
        ordered.mapInArrow(_neighbours(percent), "a long, b long").groupBy("a", "b").agg(F.lit(1)).select("a", "b"),
        "candidates",
    )


def crowd_members(named: DataFrame) -> DataFrame:
    """run, members, rep, n, component, signature: runs of a tree with pairs that have not met and may be linked."""
    width = 2 * DEPTH
    runs = named.select(
        "rep",
        "component",
        F.explode(
            F.array(
                *(
                    F.xxhash64(F.lit(t), F.substring("signature", t * width + 1, 2 * LEAST_DEPTH))
                    for t in range(TREES)
                )
            )
        ).alias("run"),
    )
    crowds = written(
        runs.groupBy("run")
        .agg(F.count("*").alias("members"), F.min("component").alias("least"), F.max("component").alias("most"))
        .filter((F.col("members") > NEIGHBOURS + 1) & (F.col("least") < F.col("most")))
        .select("run", "members"),
        "crowds",
    )
    return written(
        runs.select("run", "rep")
        .join(crowds, "run")
        .join(named.select("rep", F.col("n").cast("long").alias("n"), "component", "signature"), "rep")
        .select("run", "members", "rep", "n", "component", "signature"),
        "crowd-members",
    )


def hub_pairs(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b), a < b, of the classes of each large crowd and its most typical one."""
    large = members.filter(F.col("members") > LARGE).withColumn("block", _block())
    typical = large.repartition("run", "block").sortWithinPartitions("run", "block").mapInArrow(
        _typical, "run long, rep long, n long, component long, score double"
    )
    hubs = written(
        typical.groupBy("run").agg(F.max(F.struct("score", "rep", "n", "component")).alias("hub")), "hubs"
    )
    met = large.join(hubs, "run").filter(F.col("component") != F.col("hub.component"))
    met = met.filter(100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n"))
    return written(
        met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct(),
        "hub-pairs",
    )


def crowd_links(members: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join the components of classes in crowds: an exact join by rare shingles."""
    crowd = members.select("rep", "n", "component").distinct()
    sets = written(
        texts.join(crowd.hint("merge"), texts["id"] == crowd["rep"])
        .mapInArrow(_crowd_sets, "key long, rep long, n long, component long, shingles binary")
        .dropDuplicates(["rep", "key"])
        .withColumn("row", F.monotonically_increasing_id()),
        "crowd-sets",
    )
    common = written(
        sets.mapInArrow(_shingle_counts, "shingle long, times long")
        .groupBy("shingle")
        .agg(F.sum("times").alias("times"))
        .filter("times > 1"),
        "common-shingles",
    )
    least = F.ceil(F.col("n") * percent / 100)
    # Narrow rows, one for each shingle of a set that others have, too.
    shared = (
        sets.mapInArrow(_exploded, "row long, shingle long")
        .join(common, "shingle")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("common"))
    )
    rare = (
        shared.join(sets.select("row", "n", "component"), "row")
        .withColumn("alone", F.col("n") - F.size("common"))
        .withColumn("many", (F.col("n") - least + 1 - F.col("alone")).cast("int"))
        .filter("many > 0")
        .select("row", "n", "component", "alone", F.slice("common.shingle", F.lit(1), F.col("many")).alias("rare"))
    )
    rare = written(rare, "rare-shingles")
    cells = rare.select("component", F.explode("rare").alias("cell"))
    cells = written(
        cells.groupBy("cell")
        .agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("cell", "size"),
        "shingle-cells",
    )
    dealt = (
        rare.select("row", "n", "component", "alone", F.posexplode("rare").alias("place", "cell"))
        .join(cells, "cell")
        .withColumn("before", F.col("alone") + F.col("place"))
        .withColumn("blocks", F.ceil(F.col("size") / CELL))
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).cast("long"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    # Sets go only where a partner of fitting size has the shingle at a fitting place.
    viable = written(
        dealt.select("cell", "low", "high", "block", "row", "n", "component", "before", "place")
        .repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_viable(percent), "cell long, low long, high long, block long, row long, before long, place int"),
        "viable-cells",
    )
    rows = (
        viable.join(rare.select("row", "rare"), "row")
        .withColumn("early", F.slice("rare", F.lit(1), F.col("place")))
        .drop("rare", "place")
        .join(sets.drop("key").hint("merge"), "row")
    )
    met = (
        rows.repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_cell_links(percent), "a long, b long")
    )
    return written(met.distinct(), "crowd-links")


def _block():
    return F.pmod(F.xxhash64("rep", F.lit(1)), F.ceil(F.col("members") / BLOCK)).cast("long")


def _merged(named: DataFrame, links: DataFrame) -> DataFrame:
    """`named` with the components that the links between classes make of its own."""
    names = named.select("rep", "component")
    joined = (
        links.join(names.select(F.col("rep").alias("a"), F.col("component").alias("one")), "a")
        .join(names.select(F.col("rep").alias("b"), F.col("component").alias("two")), "b")
        .select(F.col("one").alias("a"), F.col("two").alias("b"))
    )
    found = connected_components(joined).select("node", F.col("component").alias("found"))
    return written(
        named.join(found, F.col("component") == F.col("node"), "left")
        .withColumn("component", F.coalesce("found", "component"))
        .drop("node", "found"),
        "class-components",
    )


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sets are as similar as asked for; of an id with several texts, any counts."""
    named = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    involved = texts.join(named.hint("merge"), "id").filter("text is not null").distinct()
    involved = written(involved.select("id", "text"), "candidate-texts")
    left = pairs.join(involved.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(involved.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    met = both.select("a", "b", "text_a", "text_b").mapInArrow(_confirmed(percent), "a long, b long")
    return written(met, "links")


# --- in tasks -------------------------------------------------------------------------


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    if len(words) < shingle:
        return gram_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(gram_hashes(words, shingle))


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id")
        texts = text_bytes(batch.column("text"))
        at = 0
        while at < len(texts):
            sets, total, begin = [], 0, at
            while at < len(texts) and total < _CHUNK:
                sets.append(shingle_set(texts[at]))
                total += len(sets[-1])
                at += 1
            yield _set_batch(ids.slice(begin, at - begin), sets)


def _set_batch(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    signatures = np.zeros((len(sets), TREES * DEPTH), dtype=np.uint16)
    keys = np.zeros((len(sets), 2), dtype=np.uint64)
    if len(full):
        hashes = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        keys[full, 0] = np.add.reduceat(mix(hashes), starts)
        keys[full, 1] = np.add.reduceat(mix(hashes ^ np.uint64(0x5DEECE66D)), starts)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for i in range(TREES * DEPTH):
            least = np.minimum.reduceat(short * _FACTORS[i] + _OFFSETS[i], starts)
            signatures[full, i] = (mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(sizes.astype(np.int64)),
            pa.array(keys[:, 0].astype(np.int64)),
            pa.array(keys[:, 1].astype(np.int64)),
            pa.array([row.tobytes() for row in signatures], pa.binary()),
        ],
        names=["id", "n_shingles", "k1", "k2", "signature"],
    )


def _neighbours(percent: int):
    """Pairs of rows at most `NEIGHBOURS` apart that share `LEAST_DEPTH` leading values of a tree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.table(batch)
            fresh = 0
            if held is not None:
                fresh = held.num_rows
                rows = pa.concat_tables([held, rows]).combine_chunks()
            tree, rep, size = (rows.column(c).to_numpy() for c in ("tree", "rep", "n"))
            keys = np.frombuffer(b"".join(rows.column("key").to_pylist()), dtype=np.uint16).reshape(-1, DEPTH)
            found = []
            for step in range(1, NEIGHBOURS + 1):
                if len(rep) <= step:
                    break
                same = (tree[step:] == tree[:-step]) & (
                    keys[step:, :LEAST_DEPTH] == keys[:-step, :LEAST_DEPTH]
                ).all(axis=1)
                # Sets of too different sizes cannot be similar enough.
                small, large = np.minimum(size[step:], size[:-step]), np.maximum(size[step:], size[:-step])
                same &= 100 * small.astype(np.int64) >= percent * large.astype(np.int64)
                places = np.flatnonzero(same)
                places = places[places + step >= fresh]  # the others were met with the last batch
                found.append((rep[places], rep[places + step]))
            if found:
                one, two = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"]
                )
            held = rows.slice(max(0, rows.num_rows - NEIGHBOURS))

    return run


def _groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each group, of a stream that is sorted by the keys."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)]).combine_chunks()
        marks = [rows.column(key).to_numpy() for key in keys]
        edges = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
        begin = 0
        for edge in edges:
            yield rows.slice(begin, edge - begin)
            begin = edge
        held = rows.slice(begin)
    if held is not None and held.num_rows:
        yield held


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(-1, TREES * DEPTH)


def _typical(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block the class whose signature's values are the most frequent, as a share of the block."""
    for rows in _groups(batches, "run", "block"):
        scores = np.zeros(rows.num_rows)
        for values in _signatures(rows).T:
            _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
            scores += counts[inverse]
        scores /= rows.num_rows
        best = int(np.argmax(scores))
        chosen = rows.select(["run", "rep", "n", "component"]).slice(best, 1)
        yield chosen.append_column("score", pa.array(scores[best : best + 1])).to_batches()[0]


def _crowd_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of each row, sorted; `key` tells the sets of an id apart."""
    for batch in batches:
        keys, sets = [], []
        for text in text_bytes(batch.column("text")):
            found = shingle_set(text)
            keys.append(int(np.bitwise_xor.reduce(mix(found))) if len(found) else 0)
            sets.append(found)
        kept = pa.array([len(s) > 0 for s in sets], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                batch.column("rep"),
                pa.array([len(s) for s in sets], pa.int64()),
                batch.column("component"),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["key", "rep", "n", "component", "shingles"],
        ).filter(kept)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed sets, and their numbers."""
    parts = [np.frombuffer(x, dtype=np.int64) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64), np.array([len(x) for x in parts], dtype=np.int64)


def _shingle_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shingles, times = np.unique(_flat(batch.column("shingles"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(shingles), pa.array(times)], names=["shingle", "times"])


def _exploded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shingles, sizes = _flat(batch.column("shingles"))
        rows = np.repeat(batch.column("row").to_numpy(), sizes)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(shingles)], names=["row", "shingle"])


def _viable(percent: int):
    """The rows of a cell that have a partner to be compared with there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "low", "high", "block", "row", "before", "place"]
        for rows in _groups(batches, "cell", "low", "high"):
            size, component, block, before = (
                rows.column(c).to_numpy() for c in ("n", "component", "block", "before")
            )
            apart = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
            good = np.zeros(len(size), dtype=bool)
            for i in range(len(size) - 1):
                may = _may_be_alike(i, size, component, before, percent)
                if apart:
                    may &= block[i + 1 :] != block[i]
                if may.any():
                    good[i] = True
                    good[i + 1 :] |= may
            if good.any():
                yield from rows.select(names).filter(pa.array(good)).combine_chunks().to_batches()

    return run


def _may_be_alike(i: int, size, component, before, percent: int) -> np.ndarray:
    """Whether each row behind `i` is of another component, and enough shingles can be in common."""
    rest = slice(i + 1, None)
    small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
    # intersection / union >= percent / 100 needs this many in common.
    needed = -(-percent * (size[rest] + size[i]) // (100 + percent))
    return (
        (component[rest] != component[i])
        & (100 * small >= percent * large)
        & (np.minimum(size[rest] - before[rest], size[i] - before[i]) >= needed)
    )


def _cell_links(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "cell", "low", "high"):
            found = cell_links(rows, percent)
            if found:
                a, b = np.array(found, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                )

    return run


def cell_links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that join the components of the classes that share a rare shingle, of one block or two.

    A pair is compared where the cell's shingle is the first of the rare ones it shares, and only if so
    many shingles follow in both that their sets can be alike.
    """
    rep, size, component, block, before = (
        rows.column(c).to_numpy().copy() for c in ("rep", "n", "component", "block", "before")
    )
    flat, sizes = _flat(rows.column("shingles").combine_chunks())
    values, flat = np.unique(flat, return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    early = rows.column("early").combine_chunks()
    many = np.diff(early.offsets.to_numpy())
    early_flat = np.searchsorted(values, early.flatten().to_numpy())
    early_starts = np.concatenate(([0], np.cumsum(many)))
    apart = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
    member = np.zeros(len(values), dtype=bool)
    links: list[tuple[int, int]] = []

    def shared(ids: np.ndarray, others: np.ndarray, others_at: np.ndarray, first: int) -> np.ndarray:
        """Number of `ids` in each of the rows behind `first`."""
        member[ids] = True
        hits = np.concatenate(([0], np.cumsum(member[others[others_at[first] :]])))
        member[ids] = False
        at = others_at[first:] - others_at[first]
        return hits[at[1:]] - hits[at[:-1]]

    for i in range(len(rep) - 1):
        rest = slice(i + 1, None)
        may = _may_be_alike(i, size, component, before, percent)
        if apart:
            may &= block[rest] != block[i]
        if not may.any():
            continue
        mine = early_flat[early_starts[i] : early_starts[i + 1]]
        may &= shared(mine, early_flat, early_starts, i + 1) == 0
        if not may.any():
            continue
        common = shared(flat[starts[i] : starts[i + 1]], flat, starts, i + 1)
        for j in np.flatnonzero(may & (100 * common >= percent * (size[rest] + size[i] - common))) + i + 1:
            if component[j] != component[i]:
                links.append((int(rep[i]), int(rep[j])))
                component[component == component[j]] = component[i]
    return links


def _confirmed(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            last, last_set = None, None
            for one, two in zip(text_bytes(batch.column("text_a")), text_bytes(batch.column("text_b")), strict=True):
                if two != last:
                    last, last_set = two, shingle_set(two)
                first = shingle_set(one)
                common = len(np.intersect1d(first, last_set, assume_unique=True))
                keep.append(0 < common and 100 * common >= percent * (len(first) + len(last_set) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run
