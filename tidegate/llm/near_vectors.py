"""Operator 6: near-duplicate vectors within a label, by product quantisation and exact cosines.

Equal vectors of a label collapse into one representative with a multiplicity. Cells and codebooks are
fitted on FIT_VECTORS representatives at most; every representative is indexed in its cell and
looks for neighbours in all probed cells. Estimates from lookup tables discard what cannot
be a link, exact cosines in double precision decide. Cells and their queries are cut into
blocks, so a crowded cell becomes many bounded pairs of blocks, and a block gives
one row per vector with its number of links and one member of its group, never all pairs.

Defined results: a vector without links (also one that is null, zero, or holds null or non-finite
components, or has a null label or vec_id) has n_links 0 and itself as component; vectors of different length
never link; rows with equal vec_id are counted as several vectors and one node of the graph; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import stage
from tidegate.llm.components import connected_components
from tidegate.llm.quantiser import Quantiser

THRESHOLD = 0.93
FIT_VECTORS = 16_384
VECTORS_PER_CELL, MAX_CELLS = 1024, 4096
BLOCK = 2048


def _can_link() -> Column:
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    some = F.exists(values, lambda x: F.coalesce(x != 0, F.lit(False)))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False))


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link, with the vector as array<double>, its length and a 128-bit key."""
    plain = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))  # zeros of both signs are one value
    text = F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string")))
    return vectors.filter(_can_link()).withColumn("embedding", plain).withColumns(
        {"_key": F.md5(text.cast("binary")), "_size": F.size("embedding")})


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _index(reps: DataFrame, quantiser: Quantiser) -> DataFrame:
    width = quantiser.cells.shape[1]
    shared = reps.sparkSession.sparkContext.broadcast(quantiser)  # bounded by MAX_CELLS and the codebooks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column(3), width))
            cell, code, least = shared.value.encode(x)
            probes = shared.value.probes(x, cell)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(cell, pa.int32()),
                pa.array([c.tobytes() for c in code], pa.binary()), pa.array(least), pa.array(probes, pa.list_(pa.int32()))],
                ["id", "label", "copies", "unit", "cell", "code", "least", "probes"])

    schema = ("id bigint, label string, copies bigint, unit array<double>, cell int, code binary, least double, probes array<int>")
    return reps.select("id", "label", "copies", "embedding").mapInArrow(run, schema)


def local_groups(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The least node of each node's component, for the edges a-b."""
    label = np.arange(nodes)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _links(table: pa.Table, quantiser: Quantiser) -> pa.Table:
    """Links of the queries of one block with the indexed vectors of one block of one cell."""
    schema = pa.schema([("id", pa.int64()), ("mate", pa.int64()), ("links", pa.int64())])
    width = quantiser.cells.shape[1]
    query = np.asarray(table["query"])
    asked, held = table.filter(pa.array(query)), table.filter(pa.array(~query))
    if not len(asked) or not len(held):
        return schema.empty_table()
    x, y = _matrix(asked["unit"], width), _matrix(held["unit"], width)
    xid, yid = asked["id"].to_numpy(), held["id"].to_numpy()
    xn, yn = asked["copies"].to_numpy(), held["copies"].to_numpy()
    xcell = asked["home"].to_numpy().astype(np.int64)
    cell = int(held["cell"][0].as_py())
    codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(held), -1)
    least = held["least"].to_numpy()
    found_a, found_b = [], []
    for a in range(0, len(x), 256):
        i, j = np.nonzero(quantiser.estimates(x[a:a + 256], cell, codes) >= least)
        i += a
        own = xid[i] != yid[j]
        i, j = i[own], j[own]
        for p in range(0, len(i), 1 << 16):
            q = slice(p, p + (1 << 16))
            close = (x[i[q]] * y[j[q]]).sum(1) >= quantiser.threshold
            found_a.append(i[q][close])
            found_b.append(j[q][close])
    i, j = np.concatenate(found_a or [np.zeros(0, int)]), np.concatenate(found_b or [np.zeros(0, int)])
    if not len(i):
        return schema.empty_table()
    links = np.zeros(len(x) + len(y), np.int64)
    np.add.at(links, i, yn[j])
    # The indexed vector finds the query by itself unless it does not probe the query's cell.
    lists = held["probes"].combine_chunks()
    member = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    span = len(quantiser.cells)
    blind = ~np.isin(j * span + xcell[i], member * span + lists.flatten().to_numpy())
    np.add.at(links, len(x) + j[blind], xn[i[blind]])
    ids = np.concatenate([xid, yid])
    group = local_groups(i, len(x) + j, len(ids))
    touched = np.unique(np.concatenate([i, len(x) + j]))
    return pa.table([ids[touched], ids[group[touched]], links[touched]], schema=schema)


def _search(index: DataFrame, quantiser: Quantiser, block: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(quantiser)
    asked = index.withColumn("at", F.explode("probes"))
    listed = index.groupBy("label", F.col("cell").alias("at")).agg(F.ceil(F.count("*") / block).alias("blocks"))
    queries = asked.groupBy("label", "at").agg(F.ceil(F.count("*") / block).alias("query_blocks"))
    sizes = listed.join(queries, ["label", "at"])
    mine = F.xxhash64("id")
    pick = lambda n: F.pmod(mine, F.col(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    wide = ["label", "at", "list_block", "query_block", "query", "id", "copies", "unit", "home", "cell", "code", "least", "probes"]
    lists = index.withColumn("at", F.col("cell")).join(sizes, ["label", "at"]).withColumn("list_block", pick("blocks")).withColumn(
        "query_block", all_of("query_blocks")).withColumn("query", F.lit(False)).withColumn("home", F.col("cell")).select(*wide)
    empty = F.lit(None)
    probing = asked.withColumn("home", F.col("cell")).join(sizes, ["label", "at"]).withColumn(
        "query_block", pick("query_blocks")).withColumn("list_block", all_of("blocks")).withColumn("query", F.lit(True)).withColumn(
        "code", empty.cast("binary")).withColumn("probes", empty.cast("array<int>")).select(*wide)
    blocks = lists.unionByName(probing).groupBy("label", "at", "list_block", "query_block")
    return blocks.applyInArrow(lambda t: _links(t, shared.value), "id bigint, mate bigint, links bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, fit_vectors: int = FIT_VECTORS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    usable = _usable(rows)
    members = stage(usable.select("vec_id", "label", "_key", "_size"), "vector-members")
    classes = stage(members.groupBy("label", "_key", "_size").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    reps = usable.join(classes.withColumnRenamed("id", "vec_id"), ["label", "_key", "_size", "vec_id"]).dropDuplicates(
        ["label", "_key", "_size"]).withColumnRenamed("vec_id", "id")
    reps = stage(reps.select("id", "label", "copies", "embedding", "_size"), "vector-representatives")
    found = None
    for size in reps.groupBy("_size").count().orderBy("_size").collect():  # one quantiser per length of vectors
        own = reps.filter(F.col("_size") == size["_size"])
        sample = own.orderBy(F.xxhash64("id"), "id").limit(fit_vectors).select("embedding").toArrow()
        cells = max(min(size["count"] // VECTORS_PER_CELL, MAX_CELLS), 1)
        quantiser = Quantiser.fit(_unit(_matrix(sample.column(0), size["_size"])), cells, threshold)
        links = _search(stage(_index(own, quantiser), "vector-index"), quantiser, block)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id bigint, mate bigint, links bigint")
    found = stage(found, "vector-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("mate").alias("b")), "vector")
    known = classes.join(counts, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "label", "_key", "_size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    linked = members.join(known, ["label", "_key", "_size"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~_can_link()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

