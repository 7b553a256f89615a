"""Near-duplicate documents with an LSH forest of MinHash signatures.

Method. Equal shingle sets become one vertex. A vertex's signature is ``trees * depth`` minhashes; each tree orders all vertices by its
``depth`` of them. Spark range-sorts every order, so no region of it is one task's alone. Vertices that share a prefix of ``ROOT`` minhashes are a
region; within it sketches of the whole signatures tell which neighbours may be similar, and the region passes on a spanning forest of those. In
a region of more than ``region_rows`` the prefixes get longer: vertices meet those of the longest common prefix, in overlapping runs of the order, and
the vertex nearest to what the region agrees on, which holds the region together.

The forests join to groups of vertices that may be linked, and every link is confirmed there on full shingle sets, all pairs of a group
through its inverted index. A group larger than ``block_rows`` is cut into runs of that many vertices in several of the sorted orders, and its
hubs (the vertices with most forest edges) are in every run, which links nearly all there is to link; then every vertex outside
the group's largest component meets all vertices of the group, in blocks. Tasks thus hold about ``2 * block_rows`` sets at most, and what
comes out is one spanning forest of confirmed links for each block.

What can be missed is a group: two linked documents whose signatures meet in none of ``trees`` orders, with probability
``(1 - threshold**3)**trees`` at the threshold (2e-7 at 0.85 and 16 trees, and far less above it), or whose sketches err by five standard
errors, 3 in 10 million. Within a group no link between different components is.

Defined results: a text that is null or has no words has no shingles, is its own component and linked with nothing; fewer words than a
shingle are one shingle; rows with equal sets are linked; rows that share an id share a vertex if it is the least of theirs; a row with a null id is in the
component it belongs to, has that component's least id, and is kept only where no row of the component has an id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import WordHashes, bounded, written
from telemetry_spark.llm.components import components
from telemetry_spark.plans.caps import first_n

SHINGLE, PERCENT = 5, 80
TREES, DEPTH, ROOT = 16, 6, 3
REGION_ROWS, BLOCK_ROWS, BLOCK_ORDERS, HUBS = 512, 512, 4, 8
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles. Words are what is between ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h, k = hashes.of(words), min(size, len(words))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(out)


def signature(hashed: np.ndarray) -> np.ndarray:
    """The upper halves of the least products with each multiplier."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashed), 2048):
        np.minimum(least, (MULTIPLIERS[:, None] * hashed[None, at : at + 2048]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def described(docs: DataFrame, size: int, with_set: bool) -> DataFrame:
    """``id, n_shingles, mark`` and the signature, or the set itself; mark is a 128-bit digest of the set, null for an empty one."""

    @F.pandas_udf("n_shingles bigint, mark binary, body binary")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for texts in batches:
            rows = []
            for text in texts:
                own = shingles(text, size, hashes)
                body = own if with_set else signature(own)
                rows.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), body.tobytes()) if len(own) else (0, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "mark", "body"])

    # Else a filter on its result would be moved below the joins in front of it, and all documents described.
    describe = describe.asNondeterministic()
    return docs.select("id", "text_hash", describe("text").alias("d")).select("id", "text_hash", "d.*")


def in_orders(vertices: DataFrame, orders: int, region: str | None = None) -> DataFrame:
    """A row for each vertex in each of the first ``orders`` trees: ``region, rest, node, sketch``.

    A region is a tree and the first ``ROOT`` minhashes in it, or the tree and the column ``region``; ``rest`` orders the rows within.
    """
    columns = ["node", "body"] + [region] * bool(region)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0)
            bodies = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(nodes), TREES * DEPTH)
            sketch = pa.array([r.tobytes() for r in (bodies & 0xFF).astype(np.uint8)], pa.binary())
            for tree in range(orders):
                own = bodies[:, tree * DEPTH : (tree + 1) * DEPTH]
                key, skip = np.full(len(own), tree + 1, np.uint64), 0 if region else ROOT
                parts = [batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)] if region else [own[:, i].astype(np.uint64) for i in range(ROOT)]
                for part in parts:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + part)
                rest = pa.array([r.tobytes() for r in own[:, skip:].astype(">u4")], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), rest, nodes, sketch], ["region", "rest", "node", "sketch"])

    rows = vertices.select(*columns).mapInArrow(run, "region bigint, rest binary, node bigint, sketch binary")
    ranges = int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(ranges, "region", "rest", "node").sortWithinPartitions("region", "rest", "node")


def segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of one region (region, nodes, sketches), a region of more than ``most`` rows in overlapping runs."""
    region, nodes, sketches = None, [], []

    def held() -> tuple[int, np.ndarray, np.ndarray]:
        return region, np.array(nodes, np.int64), np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), -1)

    for batch in batches:
        for r, node, sketch in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if r != region:
                if len(nodes) > 1:
                    yield held()
                region, nodes, sketches = r, [], []
            elif len(nodes) == most:
                yield held()
                nodes, sketches = nodes[-most // 4 :], sketches[-most // 4 :]
            nodes.append(node)
            sketches.append(sketch)
    if len(nodes) > 1:
        yield held()


def spanning(sketches: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """A spanning forest (row, row, agreeing minhashes) of most agreement over pairs that agree in at least ``least``."""
    n = len(sketches)
    best, to, left, edges = np.full(n, -1), np.zeros(n, np.int64), np.ones(n, bool), []
    for _ in range(n):
        at = int(np.argmax(np.where(left, best, -2)))
        left[at] = False
        if best[at] >= least:
            edges.append((int(to[at]), at, int(best[at])))
        agree = (sketches == sketches[at]).sum(axis=1)
        nearer = left & (agree > best)
        best[nearer], to[nearer] = agree[nearer], at
    return edges


def consensus(sketches: np.ndarray) -> int:
    """The row that agrees most with the commonest minhash of each place."""
    modes = np.array([np.bincount(c, minlength=256).argmax() for c in sketches.T], np.uint8)
    return int((sketches == modes).sum(axis=1).argmax())


def forest_edges(vertices: DataFrame, percent: int, region_rows: int) -> DataFrame:
    """``a, b`` of vertices whose sketches may belong to linked sets."""
    share = percent / 100
    places = TREES * DEPTH
    least = int(places * (share - 5 * np.sqrt(share * (1 - share) / places)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen, hub = [], None, None
        for region, nodes, sketches in segments(batches, region_rows):
            found += [(int(nodes[a]), int(nodes[b])) for a, b, _ in spanning(sketches, least)]
            # Later runs of a large region meet the hub of its first one.
            if region == seen:
                near = np.flatnonzero((sketches == hub[1]).sum(axis=1) >= least)
                found += [(hub[0], int(nodes[i])) for i in near[:1]]
            elif len(nodes) == region_rows:
                at = consensus(sketches)
                seen, hub = region, (int(nodes[at]), sketches[at])
            if len(found) > 1 << 16:
                yield pairs(found)
                found = []
        yield pairs(found)

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        array = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(array[:, 0]), pa.array(array[:, 1])], ["a", "b"])

    met = in_orders(vertices, TREES).mapInArrow(run, "a bigint, b bigint")
    return met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def large_groups(groups: DataFrame, block_rows: int) -> DataFrame:
    """``component, count`` of the groups that are too large for one block, of which there are few."""
    sizes = groups.groupBy("component").count().where(F.col("count") > block_rows)
    return bounded(written(sizes, "neardup-sizes"), 200_000)


def blocks_of(groups: DataFrame, sizes: DataFrame, edges: DataFrame, vertices: DataFrame, block_rows: int) -> DataFrame:
    """``block, node``: the runs of vertices within which links are confirmed."""
    small = groups.join(sizes, "component", "left_anti").select(F.concat(F.lit("g"), F.col("component")).alias("block"), "node")
    large = written(groups.join(sizes, "component").select("node", "component"), "neardup-large")
    if large.isEmpty():
        return small

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for region, nodes, _ in segments(batches, block_rows):
            yield pa.RecordBatch.from_arrays([pa.array([f"r{region}.{task}.{number}"] * len(nodes)), pa.array(nodes)], ["block", "node"])
            number += 1

    ordered = in_orders(vertices.join(large, "node"), BLOCK_ORDERS, "component")
    runs = written(ordered.mapInArrow(cut, "block string, node bigint"), "neardup-runs")
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count().join(large, "node")
    hubs = first_n(degree, ["component"], [F.desc("count"), F.col("node")], HUBS).select("component", F.col("node").alias("hub"))
    within = runs.join(large, "node").groupBy("block").agg(F.min("component").alias("component"))
    return small.unionByName(runs).unionByName(within.join(hubs, "component").select("block", F.col("hub").alias("node"))).distinct()


def confirmed(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links ``100 * intersection >= percent * union`` among sets, each pair counted exactly."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(shingle, kind="stable")
    ends, holders = np.concatenate([[0], np.cumsum(np.bincount(shingle))]), owner[order]
    starts, labels, links = np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(sets)), []
    for i in range(1, len(sets)):
        own = shingle[starts[i] : starts[i + 1]]
        lists = [holders[ends[s] : ends[s + 1]] for s in own]
        common = np.bincount(np.concatenate(lists), minlength=len(sets))[:i]
        linked = np.flatnonzero(100 * common >= percent * (sizes[:i] + sizes[i] - common))
        for label in np.unique(labels[linked]):
            if label != labels[i]:
                links.append((int(linked[labels[linked] == label][0]), i))
                labels[labels == label] = labels[i]
    return links


def sets_of(blocks: DataFrame, vertices: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``node, mark, members``: the full shingle sets of the vertices in blocks."""
    asked = vertices.join(blocks.select("node").distinct(), "node").select("id", "node", "mark")
    # Only the documents that stand for these vertices are read again.
    wanted = bounded(written(asked.select("id").distinct(), "neardup-asked"), 200_000).withColumnRenamed("id", "asked")
    again = docs.join(wanted, docs["id"].eqNullSafe(F.col("asked")), "left_semi")
    full = described(again, size, True).where("mark is not null").select("mark", F.col("body").alias("members"))
    full = full.join(asked.select("node", "mark"), "mark").dropDuplicates(["node", "mark"])
    return written(full.select("node", "mark", "members"), "neardup-sets")


def links_within(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: confirmed links that span the components of each block."""

    def link(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["node", "mark"])
        sets = [np.frombuffer(b, np.uint64) for b in block["members"]]
        nodes = block["node"].to_numpy(np.int64)
        found = [(nodes[a], nodes[b]) for a, b in confirmed(sets, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return blocks.join(sets, "node").groupBy("block").applyInPandas(link, "a bigint, b bigint").where("a <> b").distinct()


def rest_of(groups: DataFrame, sizes: DataFrame, linked: DataFrame, block_rows: int) -> DataFrame | None:
    """``block, node``: what links in a large group may still be missing, or None if there can be none.

    Two vertices that are not linked yet are not both in the group's largest component, so each vertex outside of it meets
    every vertex of the group: those outside are cut into chunks, all into blocks, and each chunk meets each block.
    """
    named = linked.select("node", F.col("component").alias("label"))
    labelled = groups.join(sizes, "component").join(named, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = labelled.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"), F.first("count").alias("all"))
    main = counts.groupBy("component").agg(F.max(F.struct("n", "label")).alias("main"), F.first("all").alias("all"))
    part = lambda n: F.ceil(n / block_rows).cast("int")
    shape = main.select("component", F.col("main.label").alias("main"), part(F.col("all")).alias("blocks"), part(F.col("all") - F.col("main.n")).alias("chunks"))
    shape = bounded(written(shape.where("chunks > 0"), "neardup-shape"), 200_000)
    placed = written(labelled.select("component", "node", "label").join(shape, "component"), "neardup-rest")
    if placed.isEmpty():
        return None
    name = lambda block, chunk: F.concat_ws(".", F.lit("x"), "component", block, chunk).alias("block")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    everyone = placed.select("component", "node", own("blocks").alias("b"), upto("chunks").alias("c"))
    outside = placed.where("label <> main").select("component", "node", own("chunks").alias("c"), upto("blocks").alias("b"))
    return everyone.unionByName(outside).select(name("b", "c"), "node").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, region_rows: int = REGION_ROWS, block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash``: documents are linked where ``100 * intersection >= percent * union``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    known = written(described(rows, shingle, False), "neardup-signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "body")).alias("first")
    by_set = known.where("mark is not null").groupBy("mark").agg(first)
    # A set that only rows without an id have gets a number below all ids in use, from its digest.
    nameless = -F.abs(F.xxhash64("mark") / 4).cast("bigint") - F.lit(1 << 61)
    vertices = written(
        by_set.select("mark", F.col("first.id").alias("id"), F.coalesce("first.id", nameless).alias("node"), F.col("first.body").alias("body")),
        "neardup-vertices",
    )
    edges = written(forest_edges(vertices.select("node", "body"), percent, region_rows), "neardup-edges")
    groups = components(edges)
    sizes = large_groups(groups, block_rows)
    blocks = written(blocks_of(groups, sizes, edges, vertices.select("node", "body"), block_rows), "neardup-blocks")
    sets = sets_of(blocks, vertices.drop("body"), rows, shingle)
    links = written(links_within(blocks, sets, percent), "neardup-links")
    linked = components(links)
    rest = rest_of(groups, sizes, linked, block_rows)
    if rest is not None:
        linked = components(links.unionByName(links_within(rest, sets, percent)))
    labelled = vertices.select("mark", "id", "node").join(linked, "node", "left").withColumn("label", F.coalesce("component", "node"))
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    names = labelled.select("mark", "label").join(least, "label").select("mark", "component_id")
    out = known.select("id", "text_hash", "n_shingles", "mark").join(names, "mark", "left")
    component = F.when(F.col("mark").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.when(F.col("id").isNull(), component.isNull()).otherwise(F.col("id") == component).alias("kept"), "text_hash",
    )


def without_duplicates(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``near_duplicates`` keeps, all columns as they are; of rows that repeat an id and a text, one."""
    rows = docs.withColumns({"__id": F.col(id_col).cast("bigint"), "__hash": F.xxhash64(F.col(text_col))})
    named = lambda df: df.select(F.col("doc_id").alias("__a"), F.col("text_hash").alias("__b"))
    same = F.col("__id").eqNullSafe(F.col("__a")) & (F.col("__hash") == F.col("__b"))
    dropped = written(named(found.where(~F.col("kept"))).distinct(), "neardup-dropped")
    kept = rows.join(bounded(dropped, 200_000), same, "left_anti")
    repeated = written(named(found.where("kept")).groupBy("__a", "__b").count().where("count > 1").drop("count"), "neardup-repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["__id", "__hash"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.drop("__id", "__hash")
