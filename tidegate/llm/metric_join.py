"""Operator 9: documents whose shingle sets have a Jaccard similarity of 0.8 or more, as classes.

The join is exact and works in the metric space of sets.

Pivots and regions. Whole documents make poor pivots here: nearly all documents share no shingle, so
nearly all distances are 1 and no triangle inequality parts them. The first level of pivots are
single shingles. A set lies at distance 1 - 1/size from each of its own and at 1 from others;
ties go to the first shingle of one fixed order, whose region is the set's Voronoi cell. A set linked
to x shares at least least_shared(x) of its shingles, so its pivots lie in the first size - least_shared + 1
shingles of x: this window says into which regions x is copied, and no link is lost. Shingles frequent
in the corpus come last in the order, so that crowded regions take in only sets made of little else.

Regions join recursively. In a region the set with the fewest rarer shingles becomes the pivot of all others of fitting
size, and so on with those left over; they are compared with it. Copies of one text differ from it by shingles of their own, which
are rare, so the pivot of a crowd is the copy that was changed least and lies near nearly all others. What lies near one pivot is one
group already, and a group is not compared within itself again. In regions that still hold several groups, all pairs of
different groups are compared, so the classes are exact. A region of more than BLOCK_MEMBERS sets is cut into blocks,
and every two blocks meet in a unit of their own, so no task holds a crowd as a whole.

Links. Every link lies within a group, but not all of its pairs were compared by then. jaccard_links compares all pairs of
different sets of a group whose sizes fit: a group is cut into blocks of ascending size, and the whole sets of two
blocks meet in one task, where a product of 0/1 matrices counts what all their pairs share.

Before sets are compared, equal sets are one (a class key of the whole set), and bucket counts of
both sets and the overlap of their windows bound their overlap from above. Sets are compared whole, from the texts.

Defined results: a null text, or one without words, has 0 shingles, is its own class and linked with nothing;
so is a row with a null doc_id, whose component_id is null; rows with the same doc_id are one
node of the graph; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm import scan, shingles
from tidegate.llm.common import fresh_name, shuffle_partitions, stage
from tidegate.llm.components import connected_components

PERCENT = 80
HOT_SHARE, HOT_LOCAL, HOT_MOST = 0.001, 4, 1 << 16
BLOCK_MEMBERS = 4096  # sets of a region compared as one unit; no result depends on it
FULL = 255  # a bucket count that stands for itself or any larger one
SHARDS_PER_TASK = 4  # a task holds the windows of one shard at a time
BLOCK_SHINGLES, BLOCK_SETS, COLUMNS = 1 << 18, 256, 4096  # sets compared at a time; no result depends on them
_U = np.uint64


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (its set's size, class and bucket counts), and the shingles frequent in the batch."""
    names = ["doc_id", "n_shingles", "class", "buckets", "hot", "hot_count"]

    def out(n: int, **columns) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, k)) for c, k in zip(names, kinds)], names)

    for batch in batches:
        keys = []
        for a, b, texts in shingles.pieces(batch.column(1)):
            sets = shingles.sets_of(texts)
            rows = np.minimum(sets.histograms(), FULL).astype(np.uint8)
            yield out(b - a, doc_id=batch.column(0).slice(a, b - a), n_shingles=pa.array(sets.sizes),
                      **{"class": pa.array(sets.class_keys().view(np.int64))},
                      buckets=pa.array([r.tobytes() for r in rows], pa.binary()))
            keys.append(sets.keys)
        if keys:
            every = np.sort(np.concatenate(keys))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            counts = np.diff(np.append(first, len(every)))
            often = counts >= max(HOT_LOCAL, HOT_SHARE * batch.num_rows)
            if often.any():
                yield out(int(often.sum()), hot=pa.array(every[first][often].astype(np.int64)), hot_count=pa.array(counts[often]))


def _regions(batches: Iterator[pa.RecordBatch], percent: int, hot: tuple[np.ndarray, np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """The window of every set as arrays, cut by shard of the shingle; equal sets of a batch only once."""
    for batch in batches:
        parts, seen = [], set()
        for _, _, texts in shingles.pieces(batch.column(0)):
            sets = shingles.sets_of(texts)
            classes = sets.class_keys()
            fresh = np.zeros(len(classes), bool)
            for i, c in enumerate(classes.tolist()):
                if c not in seen:
                    seen.add(c)
                    fresh[i] = True
            key, owner, place = shingles.windows(sets, percent, *hot)
            new = fresh[owner]
            key, owner, place = key[new], owner[new], place[new]
            parts.append((key, classes[owner], sets.sizes[owner], place))
        if not parts:
            continue
        key, own, size, place = (np.concatenate(x) for x in zip(*parts))
        shard = (scan.mix(key) % _U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        full = np.flatnonzero(np.diff(edges))
        columns = [x[order] for x in (key.astype("<u8"), own.astype("<u8"), size.astype("<u4"), place.astype("<u4"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), *[pa.array([c[edges[s]:edges[s + 1]].tobytes() for s in full], pa.binary()) for c in columns]],
            ["shard", "key", "class", "size", "place"])


def _pivots(size: np.ndarray, run: np.ndarray, percent: int) -> np.ndarray:
    """For members sorted by (region, place, class key), the member each is first compared with (its own index if none).

    The first opens a range of fitting sizes, and so on with the members left over. A small place says that few rarer
    shingles come before the region's, so the pivot of near copies is the one with the fewest changes of its own. Near copies share
    most of their regions, so they mostly meet the same pivot everywhere.
    """
    pivot = np.arange(len(size))
    left = np.arange(len(size))
    while len(left):
        first = np.concatenate([[True], run[left][1:] != run[left][:-1]])
        opened = left[np.flatnonzero(first)[np.cumsum(first) - 1]]
        fits = (100 * np.minimum(size[left], size[opened]) >= percent * np.maximum(size[left], size[opened]))
        pivot[left[fits]] = opened[fits]
        left = left[~fits]
    return pivot


def _meet(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Regions with two sets or more: every member with its pivot. Rows come sorted by shard."""
    now, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        key, own, size, place = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((own, place, key))
        key, own, size, place = key[order], own[order], size[order].astype(np.int64), place[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        key, own, size, place = key[fresh], own[fresh], size[fresh], place[fresh]
        same = key[1:] == key[:-1]
        many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        key, own, size, place = key[many], own[many], size[many], place[many]
        if len(key):
            pivot = own[_pivots(size, key, percent)]
            for a in range(0, len(key), 1 << 16):
                cut = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[cut].astype(np.int64)), pa.array(own[cut].view(np.int64)), pa.array(size[cut]),
                    pa.array(place[cut].astype(np.int64)), pa.array(pivot[cut].view(np.int64))],
                    ["region", "class", "size", "place", "pivot"])

    for batch in batches:
        for shard, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != now and held:
                yield from close()
                held = []
            now = shard
            held.append(tuple(np.frombuffer(x, t) for x, t in zip(blobs, ("<u8", "<u8", "<u4", "<u4"))))
    if held:
        yield from close()


def _across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of members of different groups that may reach the similarity; rows come sorted by unit (region, low, high).

    A unit holds two blocks of a region, or one block when low equals high. Sizes, places and bucket counts bound what
    two members share.
    """

    def fitting(size, place, group, block, apart, buckets, left, right) -> np.ndarray:
        low, high = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        need = -(-percent * (low + high) // (100 + percent))
        room = np.minimum(place[left], place[right]) + np.minimum(size[left] - place[left], size[right] - place[right])
        take = (group[left] != group[right]) & (room >= need) & (~apart[left] | (block[left] != block[right]))
        at = np.flatnonzero(take)
        for p in range(0, len(at), 1 << 14):
            q = at[p:p + (1 << 14)]
            take[q] = _room(buckets[left[q]], buckets[right[q]]) >= need[q]
        return take

    def pairs(rows: list[np.ndarray], unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, low, high, own, size, place, group, block, buckets = rows
        order = np.lexsort((size, unit))  # ascending size: a row ends where the sizes no longer fit
        unit, own, size, place, group, block, buckets = (x[order] for x in (unit, own, size, place, group, block, buckets))
        apart = (low != high)[order]
        left, step = np.arange(len(unit)), 1
        while len(left):
            left = left[left + step < len(unit)]
            left = left[(unit[left] == unit[left + step]) & (100 * size[left] >= percent * size[left + step])]
            take = fitting(size, place, group, block, apart, buckets, left, left + step)
            if take.any():
                low_end, high_end = left[take], left[take] + step
                one, two = own[low_end], own[high_end]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)),
                                                  pa.array(size[low_end]), pa.array(size[high_end])], ["a", "b", "smaller", "larger"])
            step += 1

    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:8]] + [_counts(batch.column(8))]
        if rest is not None:
            rows = [np.concatenate(x) for x in zip(rest, rows)]
        unit = np.cumsum(np.concatenate([[False], np.any([x[1:] != x[:-1] for x in rows[:3]], axis=0)]))
        cut = int(np.searchsorted(unit, unit[-1], "left"))  # the last unit may go on in the next batch
        if cut:
            yield from pairs([r[:cut] for r in rows], unit[:cut])
        rest = [r[cut:] for r in rows]
    if rest is not None:
        yield from pairs(rest, np.zeros(len(rest[0]), np.int64))


def _counts(column: pa.Array) -> np.ndarray:
    """Bucket counts, a row per set."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _room(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The most shingles that sets with these bucket counts can share; where both fill a bucket, it says nothing."""
    least = np.minimum(one, two)
    return np.where((least == FULL).any(1), np.iinfo(np.int64).max, least.sum(1, dtype=np.int64))


def _may_link(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose bucket counts leave room for the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
        keep = _room(_counts(batch.column(4)), _counts(batch.column(5))) >= -(-percent * (one + two) // (100 + percent))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in (0, 1)], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose whole sets reach the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = []
        for c in (2, 3):  # a text that stands in many pairs of a batch is read once
            texts = batch.column(c).dictionary_encode()
            sets = [s.keys[p:q] for _, _, piece in shingles.pieces(texts.dictionary) for s in [shingles.sets_of(piece)]
                    for p, q in zip(s.bounds[:-1], s.bounds[1:])]
            sides.append((texts.indices.to_numpy(), sets))
        keep = [shingles.linked(sides[0][1][i], sides[1][1][j], percent) for i, j in zip(sides[0][0], sides[1][0])]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in (0, 1)], ["a", "b"])


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has the class it came with."""
    for batch in batches:
        for a, b, texts in shingles.pieces(batch.column(1)):
            rows = batch.slice(a, b - a)
            yield rows.filter(pa.array(shingles.sets_of(texts).class_keys().view(np.int64) == rows.column(0).to_numpy()))


SLOTS = 1 << 20


def _wanted_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (doc_id, text) whose doc_id may be wanted, so that few texts enter the join that decides.

    Ids fall into SLOTS slots; at most SLOTS numbers reach the driver and the tasks. Where many ids are wanted, more
    rows pass, and none is lost.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    found = wanted.select(slot("doc").alias("slot")).distinct().toArrow().column(0).to_numpy()
    flags = np.zeros(SLOTS, bool)
    flags[found] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(held[batch.column(2).to_numpy(zero_copy_only=False)])).select([0, 1])

    return rows.filter("doc_id IS NOT NULL").select("doc_id", "text", slot("doc_id").alias("slot")).mapInArrow(
        run, "doc_id bigint, text string")


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys that may be links."""
    side = lambda n: classes.select(F.col("class").alias(n), F.col("n_shingles").alias(f"n{n}"), F.col("buckets").alias(f"k{n}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ka", "kb")
    return near.mapInArrow(lambda x: _may_link(x, percent), "a bigint, b bigint")


def _checked(near: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int, label: str) -> DataFrame:
    """The pairs (a, b) of class keys that are links."""
    near = stage(near, f"{label}-candidates")
    if near.isEmpty():
        return near
    found = stage(texts(near.select(F.explode(F.array("a", "b")).alias("class")).distinct()), f"{label}-texts")
    text = lambda n: found.select(F.col("class").alias(n), F.col("text").alias(f"t{n}"))
    both = near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
    return stage(both.mapInArrow(lambda x: _verify(x, percent), "a bigint, b bigint"), f"{label}-links")


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The groups (class, group) after links between classes."""
    if links.isEmpty():
        return groups
    side = lambda n: groups.select(F.col("class").alias(n), F.col("group").alias(f"_{n}"))
    edges = links.join(side("a"), "a").join(side("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    merged = connected_components(edges, "jaccard").withColumnRenamed("node", "group")
    return stage(groups.join(merged, "group", "left").select("class", F.coalesce("component", "group").alias("group")), "jaccard-groups")


def hot_shingles(found: DataFrame, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in a share of HOT_SHARE of all documents, at most HOT_MOST; they only change the order."""
    counts = found.filter("hot IS NOT NULL").groupBy("hot").agg(F.sum("hot_count").alias("n")).filter(
        F.col("n") >= max(HOT_LOCAL, HOT_SHARE * documents))
    rows = counts.orderBy(F.desc("n"), "hot").limit(HOT_MOST).toArrow()
    keys = rows.column(0).to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column(1).to_numpy()[order]


@dataclass(frozen=True)
class _Walk:
    members: DataFrame  # a row per row of docs: doc_id, n_shingles, class
    classes: DataFrame  # class, doc (its least doc_id), n_shingles
    groups: DataFrame  # class, group
    texts: Callable[[DataFrame], DataFrame]  # a text of each wanted class

    def split(self) -> tuple[DataFrame, DataFrame]:
        """The members that may have links, and the others."""
        linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
        return self.members.filter(linkable), self.members.filter(~linkable)


def _grouped(docs: DataFrame, percent: int) -> _Walk:
    """The classes of equal sets and the groups that links make of them."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    schema = "doc_id bigint, n_shingles bigint, class bigint, buckets binary, hot bigint, hot_count bigint"
    found = stage(rows.mapInArrow(_first_pass, schema), "jaccard-sets")
    members = found.filter("n_shingles IS NOT NULL")
    hot = spark.sparkContext.broadcast(hot_shingles(found, members.count()))  # at most HOT_MOST entries
    classes = stage(members.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("buckets").alias("buckets")), "jaccard-classes")
    shards = shuffle_partitions(spark)
    windows = rows.filter("doc_id IS NOT NULL").select("text").mapInArrow(
        lambda b: _regions(b, percent, hot.value, SHARDS_PER_TASK * shards), "shard int, key binary, class binary, size binary, place binary")
    meeting = windows.repartition(shards, "shard").sortWithinPartitions("shard")
    regions = stage(meeting.mapInArrow(lambda b: _meet(b, percent),
                                       "region bigint, class bigint, size bigint, place bigint, pivot bigint"), "jaccard-regions")

    def texts(some: DataFrame) -> DataFrame:
        wanted = stage(some.join(classes, "class").select("class", "doc"), "jaccard-wanted")
        # Rows with one doc_id may hold different texts, of which only the class's own counts.
        near = _wanted_rows(rows, wanted)
        held = near.join(wanted, near["doc_id"] == wanted["doc"]).select("class", "text")
        return held.mapInArrow(_own_text, "class bigint, text string").dropDuplicates(["class"])

    star = regions.filter("pivot <> class").select(F.least("pivot", "class").alias("a"), F.greatest("pivot", "class").alias("b")).distinct()
    first = _checked(_near(star, classes, percent), texts, percent, "jaccard-first")
    groups = _merged(classes.select("class", F.col("doc").alias("group")), first)
    # Regions that still hold several groups.
    placed = stage(regions.join(groups, "class").select("region", "class", "size", "place", "group"), "jaccard-placed")
    mixed = placed.groupBy("region").agg(F.count("*").alias("n"), F.min("group").alias("least"), F.max("group").alias("most")).filter(
        "least <> most").select("region", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int").alias("blocks"))
    dealt = placed.join(mixed, "region").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = dealt.join(classes.select("class", "buckets"), "class").select(
        "region", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "class", "size", "place", "group", "block", "buckets")
    met = units.repartition(shards, "region", "low", "high").sortWithinPartitions("region", "low", "high")
    # A pair that may be a link comes once from each region of both windows. Of two windows, one ends first in the order of
    # shingles; what its set shares with the other set within the window lies in regions of both.
    common = met.mapInArrow(lambda b: _across(b, percent), "a bigint, b bigint, smaller bigint, larger bigint").groupBy("a", "b").agg(
        F.count("*").alias("n"), F.first("smaller").alias("smaller"), F.first("larger").alias("larger"))
    need, beyond = F.expr(f"({percent} * (smaller + larger) + {99 + percent}) div {100 + percent}"), F.expr(f"({percent} * larger + 99) div 100 - 1")
    last = common.filter(F.col("n") + beyond >= need).select("a", "b")
    groups = _merged(groups, _checked(last, texts, percent, "jaccard-last"))
    return _Walk(members.select("doc_id", "n_shingles", "class"), classes.select("class", "doc", "n_shingles"), groups, texts)


def jaccard_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    walk = _grouped(docs, percent)
    linkable, others = walk.split()
    # Written out, one row per class, so that adaptive execution may split the join on a class of many copies.
    final = walk.groups.withColumnRenamed("group", "component_id")
    placed = linkable.join(final, "class").select("doc_id", "n_shingles", "component_id")
    return placed.unionByName(others.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set of each text (class, text), as bytes."""
    for batch in batches:
        for a, b, texts in shingles.pieces(batch.column(1)):
            sets = shingles.sets_of(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(
                [sets.keys[p:q].astype("<u8").tobytes() for p, q in zip(sets.bounds[:-1], sets.bounds[1:])], pa.binary())], ["class", "keys"])


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each set of `left` shares with each of `right` (indices)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for a in range(0, int(column[-1]) + 1, COLUMNS):
        p, q = np.searchsorted(column, (a, a + COLUMNS))
        flags = np.zeros((len(sets), COLUMNS), np.float32)
        flags[owner[p:q], column[p:q] - a] = 1
        out += (flags[left] @ flags[right].T).astype(np.int64)  # at most COLUMNS, so exact
    return out


def _within(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links between two blocks (or inside one); rows come sorted by (group, left, right)."""
    now, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        side, own = np.array([h[0] for h in held]), np.array([h[1] for h in held], np.int64)
        sets = [np.frombuffer(h[2], "<u8") for h in held]
        size = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        inside = now[1] == now[2]
        if inside:
            right = left
        shared = _shared(sets, left, right)
        near = 100 * shared >= percent * (size[left][:, None] + size[right] - shared)
        if inside:
            near &= np.triu(np.ones(near.shape, bool), 1)
        x, y = np.nonzero(near)
        one, two = own[left[x]], own[right[y]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(shared[x, y])], ["a", "b", "n_shared"])

    for batch in batches:
        for group, left, right, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (group, left, right) != now:
                yield from close()
                held = []
            now = (group, left, right)
            held.append(row)
    if held:
        yield from close()


def jaccard_links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(links, members): every link between different texts, and what each row of (doc_id, text) belongs to.

    Links are (a, b, n_shared, doc_a, doc_b): class keys with a < b, the shingles both share, and the least doc_id of each
    class. Members are (doc_id, n_shingles, class, component_id, n_links), n_links being the links of the class. Rows of one
    class have equal sets, and are linked with one another without a row of their own.
    """
    walk = _grouped(docs, percent)
    shards = shuffle_partitions(docs.sparkSession)
    ascending = Window.partitionBy("group").orderBy("n_shingles", "class").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.greatest("n_shingles", F.lit(BLOCK_SHINGLES // BLOCK_SETS))
    placed = walk.groups.join(walk.classes, "class").withColumn("n", F.count("*").over(Window.partitionBy("group"))).filter("n > 1")
    placed = stage(placed.select("group", "class", "n_shingles", F.floor(
        F.coalesce(F.sum(weight).over(ascending), F.lit(0)) / BLOCK_SHINGLES).alias("block")), "jaccard-blocks")
    blocks = placed.groupBy("group", "block").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    side = lambda n: blocks.select("group", F.col("block").alias(n), F.col("least").alias(f"least_{n}"), F.col("most").alias(f"most_{n}"))
    # Blocks ascend in size, so the largest set of the left and the smallest of the right one are the closest.
    units = side("left").join(side("right"), "group").filter(
        (F.col("left") <= F.col("right")) & (100 * F.col("most_left") >= percent * F.col("least_right"))).select("group", "left", "right")
    sets = stage(walk.texts(placed.select("class")).mapInArrow(_keys, "class bigint, keys binary"), "jaccard-whole-sets")
    whole = placed.join(sets, "class").select("group", "block", "class", "keys")

    def meet(own: str, number: int, where) -> DataFrame:
        return whole.join(units.filter(where).withColumn("block", F.col(own)), ["group", "block"]).select(
            "group", "left", "right", F.lit(number).alias("side"), "class", "keys")

    both = meet("left", 0, F.lit(True)).unionByName(meet("right", 1, F.col("left") < F.col("right")))
    met = both.repartition(shards, "group", "left", "right").sortWithinPartitions("group", "left", "right")
    links = stage(met.mapInArrow(lambda x: _within(x, percent), "a bigint, b bigint, n_shared bigint"), "jaccard-all-links")
    doc = lambda n: walk.classes.select(F.col("class").alias(n), F.col("doc").alias(f"doc_{n}"))
    counts = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("n_links"))
    linkable, others = walk.split()
    final = walk.groups.withColumnRenamed("group", "component_id").join(counts, "class", "left").withColumn(
        "n_links", F.coalesce("n_links", F.lit(0)))
    columns = ["doc_id", "n_shingles", "class", "component_id", "n_links"]
    members = linkable.join(final, "class").select(columns).unionByName(others.select(
        "doc_id", "n_shingles", F.lit(None).cast("bigint").alias("class"), F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links")))
    return links.join(doc("a"), "a").join(doc("b"), "b").select("a", "b", "n_shared", "doc_a", "doc_b"), members


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` with one row of each group of near copies: the one with the least doc_id, if any has one.

    Rows are known by a hash of their doc_id and text, so rows that share a doc_id or have none are judged by their own
    texts. Of equal rows one stays. Rows without words are near copies of nothing but their equal rows.
    """
    number, place = fresh_name(docs, "_row"), fresh_name(docs, "_place")
    numbered = docs.withColumn(number, F.xxhash64("doc_id", "text"))
    groups = jaccard_classes(numbered.select(F.col(number).alias("doc_id"), "text"), percent).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group")).distinct()
    ids = numbered.select(F.col(number).alias("row"), F.col("doc_id").alias("id")).distinct()
    least = groups.join(ids, "row").groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("least"))
    kept = least.select(F.col("least.row").alias("row"))
    whole = numbered.join(kept, numbered[number] == kept["row"], "left_semi")
    equal = Window.partitionBy(number, "doc_id", "text").orderBy(F.lit(0))
    return whole.withColumn(place, F.row_number().over(equal)).filter(F.col(place) == 1).drop(number, place)
