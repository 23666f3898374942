"""Near-duplicates among vectors: a robust-pruned flat graph, built on overlapping shards and searched by range."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.llm.common import bounded_batches, written
from hustings.llm.components import connected_components
from hustings.llm.simhash import forest

#: Least cosine of a link.
LEAST = 0.9
#: Vectors whose nearest centroid is one's own, on average, and the most centroids of one dimension.
CELL, MOST_CENTROIDS = 2048, 4096
#: Centroids are fitted on this many vectors each, and on no more bytes than SAMPLE_BYTES for one dimension.
SAMPLE_EACH, SAMPLE_BYTES = 32, 64 << 20
#: Dimensions that get centroids, the most frequent ones; vectors of others make one cell for each dimension.
DIMENSIONS = 16
#: Shards that each vector is built into, the most vectors of a shard (about), and queries that search one shard together.
OVERLAP, SHARD, QUERIES = 2, 6144, 12288
#: Out-degree of a node in a shard, how much nearer a kept neighbour must be to prune another one, and candidates for it.
DEGREE, ALPHA, CANDIDATES = 24, 1.2, 48
#: Beam of a search, and how much farther than its nearest centroid a query looks for shards (cosine): in turn, until the
#: audit's recall is enough.
ROUNDS = ((48, 0.12), (96, 0.25), (192, 0.5))
#: Vectors whose links the audit finds by brute force, half of them among those with links, and the recall it asks for.
AUDITED, RECALL = 256, 0.95
#: Queries that are searched at once, and bytes of neighbours that one step gathers.
BATCH, STEP_BYTES = 256, 16 << 20


class Found(NamedTuple):
    """links: (vec_id, n_links, component_id, kept); recall: what the audit measured; rounds: how many searches it took."""

    links: DataFrame
    recall: float
    rounds: int


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose lists have one length, as unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


# ---- the graph of one shard ----


def searched(near: np.ndarray, x: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int, least: float | None = None):
    """What a greedy search from starts over the adjacency lists `near` finds: for each query its `beam` nearest nodes (n, one
    past the last node, for none); with `least`, arrays of queries and nodes of at least that similarity.

    near has a row for each node and a last one of only n; n stands for no neighbour. All queries take a step together:
    each looks at the neighbours of the best nodes of its beam that it hasn't opened. With `least`, queries whose beam is
    more than half in range go on with a beam twice as wide, so its width cuts off nothing that is in range.
    """
    n = len(near) - 1
    seen, opened = np.full((len(queries), n + 1), -np.inf, np.float32), np.zeros((len(queries), n + 1), bool)
    seen[:, starts] = queries @ x[starts].T
    active, width = np.arange(len(queries)), min(beam, n)
    while True:
        ids, step = np.full((len(queries), width), n), min(width, max(4, width // 16))
        best = np.argpartition(-seen[active, :n], width - 1, axis=1)[:, :width]
        ids[active] = np.where(np.take_along_axis(seen[active], best, axis=1) > -np.inf, best, n)
        expand = active
        while len(expand):
            moved = []
            for rows in np.array_split(expand, -(-len(expand) * step * near.shape[1] * x.shape[1] * 4 // STEP_BYTES)):
                own = ids[rows]
                value = np.where(opened[rows[:, None], own], -np.inf, seen[rows[:, None], own])
                best = np.argpartition(-value, step - 1, axis=1)[:, :step]
                chosen = np.where(np.take_along_axis(value, best, axis=1) > -np.inf, np.take_along_axis(own, best, axis=1), n)
                more = (chosen < n).any(axis=1)
                rows, own, chosen = rows[more], own[more], chosen[more]
                opened[rows[:, None], chosen] = True
                around = near[chosen].reshape(len(rows), step * near.shape[1])
                around.sort(axis=1)
                around[:, 1:][around[:, 1:] == around[:, :-1]] = n
                around[seen[rows[:, None], around] > -np.inf] = n
                r, c = np.nonzero(around < n)
                seen[rows[r], around[r, c]] = np.einsum("ij,ij->i", x[around[r, c]], queries[rows[r]])
                pool = np.concatenate([own, around], axis=1)
                best = np.argpartition(-seen[rows[:, None], pool], width - 1, axis=1)[:, :width]
                ids[rows] = np.take_along_axis(pool, best, axis=1)
                moved.append(rows)
            expand = np.concatenate(moved)
        if least is None:
            return ids
        active = active[2 * (seen[active] >= least).sum(axis=1) > width]
        if width >= n or not len(active):
            return np.nonzero(seen >= least)
        width = min(2 * width, n)


def closed(near: np.ndarray) -> np.ndarray:
    """Adjacency lists with -1 for none as searched() takes them."""
    n = len(near)
    return np.concatenate([np.where(near < 0, n, near), np.full((1, near.shape[1]), n, near.dtype)])


def pruned(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """(rows, degree): of each row's candidates (n for none) those that robust pruning keeps: the nearest one stays and
    removes all that are alpha times nearer to it than to the row's own node, and so on."""
    n = len(x)
    candidates = np.sort(np.where(candidates == own[:, None], n, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
    there = x[np.minimum(candidates, n - 1)]
    far = np.where(candidates < n, 1 - np.einsum("ijk,ik->ij", there, x[own]), np.inf)
    alive, out, rows = candidates < n, np.full((len(own), degree), n, np.int32), np.arange(len(own))
    for r in range(degree):
        j = np.where(alive, far, np.inf).argmin(axis=1)
        some = alive[rows, j]
        if not some.any():
            break
        out[some, r] = candidates[rows, j][some]
        between = 1 - np.matmul(there, there[rows, j][:, :, None])[:, :, 0]
        alive &= ~(some[:, None] & (alpha * alpha * between <= far))
        alive[rows, j] = False
    return out


def linked(x: np.ndarray, seed: int) -> np.ndarray:
    """Adjacency lists (-1 for none) of a robust-pruned graph over the unit rows x (float32)."""
    n, random = len(x), np.random.default_rng(seed)
    if n < 2:
        return np.full((n, 1), -1, np.int32)
    degree = min(DEGREE, n - 1)
    near = closed(random.integers(0, n, (n, degree), dtype=np.int32))
    start = np.array([int((x @ x.mean(axis=0)).argmax())])
    order = random.permutation(n).astype(np.int32)
    for at in range(0, n, BATCH):
        batch = order[at : at + BATCH]
        met = searched(near, x, start, x[batch], CANDIDATES)
        near[batch] = kept = pruned(x, batch, np.concatenate([met.astype(np.int32), near[batch]], axis=1), degree, ALPHA)
        # Edges back: a node's list is filled up, or pruned where it would grow too long.
        source, target = np.repeat(batch, degree), kept.ravel()
        source, target = source[target < n], target[target < n]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        for low in range(0, int(count.max(initial=0)), degree):
            some = (place >= low) & (place < low + degree)
            back = np.full((len(nodes), degree), n, np.int32)
            back[np.searchsorted(nodes, target[some]), place[some] - low] = source[some]
            hit = (back < n).any(axis=1)
            for rows in np.array_split(np.flatnonzero(hit), -(-int(hit.sum()) // BATCH)):
                near[nodes[rows]] = pruned(x, nodes[rows], np.concatenate([near[nodes[rows]], back[rows]], axis=1), degree, ALPHA)
    return np.where(near[:n] < n, near[:n], -1)


def entrances(near: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The medoid, and for what can't be reached from it the medoid of the rest, until all nodes can be reached."""
    reached, out = np.zeros(len(near), bool), []
    while not reached.all():
        rest = np.flatnonzero(~reached)
        new = rest[[int((x[rest] @ x[rest].mean(axis=0)).argmax())]]
        out.append(int(new[0]))
        reached[new] = True
        while len(new):
            new = np.unique(near[new])
            new = new[new >= 0]
            new = new[~reached[new]]
            reached[new] = True
    return np.array(out)


# ---- shards ----


def fitted(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k unit centroids of the unit rows x, by rounds of assignment and mean."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centroids)
    return centroids


def centroids(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids by dimension, fitted on the driver to the vectors of least hash, SAMPLE_EACH a centroid."""
    out = {}
    for row in nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(DIMENSIONS).collect():
        dim, n = row["dim"], row["count"]
        k = min(-(-n // CELL), MOST_CENTROIDS, max(1, SAMPLE_BYTES // (8 * dim * SAMPLE_EACH)))
        if k > 1:
            some = nodes.filter(F.col("dim") == dim).orderBy(F.xxhash64("node", F.lit(1))).limit(k * SAMPLE_EACH).select("embedding").toArrow()
            out[dim] = fitted(matrix(some.column("embedding")), k)
    return out


def routed(nodes: DataFrame, held: dict[int, np.ndarray], slack: float) -> DataFrame:
    """nodes with clusters: the nearest centroids, nearest first, OVERLAP at least and all within slack of the nearest."""
    sent = nodes.sparkSession.sparkContext.broadcast(held)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            lists: list[list[int]] = [[0]] * len(dims)
            for dim in np.unique(dims):
                if (c := sent.value.get(int(dim))) is None:
                    continue
                rows = np.flatnonzero(dims == dim)
                sims = matrix(batch.column("embedding").take(pa.array(rows))) @ c.T
                order = np.argsort(-sims, axis=1, kind="stable")
                many = np.maximum((sims >= sims.max(axis=1, keepdims=True) - slack).sum(axis=1), OVERLAP)
                for row, own, k in zip(rows, order, many, strict=True):
                    lists[row] = own[:k].tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "clusters"])

    return nodes.mapInArrow(route, T.StructType([*nodes.schema, T.StructField("clusters", T.ArrayType(T.IntegerType()))]))


def dealt(rows: DataFrame, clusters: Column, most: int, part: str) -> DataFrame:
    """A row for each of its clusters, with the cluster's number of parts; what has over `most` rows is parted by hash."""
    rows = rows.select("*", F.posexplode(clusters).alias("place", "cluster"))
    parts = rows.groupBy("dim", "cluster").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(f"{part}s"))
    return rows.join(written(parts), ["dim", "cluster"]).withColumn(part, F.pmod(F.xxhash64("node", F.lit(2)), F.col(f"{part}s")).cast("int"))


SHARDED = ("dim", "cluster", "part")


def graph(nodes: DataFrame) -> DataFrame:
    """(node, near): each node's neighbours in all shards that it was built into. nodes has clusters as routed() has."""
    shards = dealt(nodes.select("node", "dim", "embedding", "clusters"), F.slice("clusters", 1, OVERLAP), SHARD, "part")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        ids, x = table.column("node").to_numpy(), matrix(table.column("embedding")).astype(np.float32)
        near = linked(x, int(ids[0]) & 0xFFFF)
        there = near >= 0
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32), pa.array(ids[near[there]]))
        return pa.table({"node": table.column("node"), "near": lists})

    built = shards.select(*SHARDED, "node", "embedding").groupBy(*SHARDED).applyInArrow(build, "node long, near array<long>")
    return built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def links_found(nodes: DataFrame, near: DataFrame, beam: int, least: float) -> DataFrame:
    """(node, links, root): for each node and shard how many rows it links to there, and edges (node, root) that connect
    what is linked. Each node counts in the shard of its nearest centroid alone, so no link counts twice."""
    members = dealt(nodes.select("node", "dim", "n_rows", "embedding", "clusters"), F.slice("clusters", 1, OVERLAP), SHARD, "part")
    own = members.join(near, "node").select(*SHARDED, "parts", "node", "n_rows", "embedding", "near", (F.col("place") == 0).alias("home"))
    asked = dealt(nodes.select("node", "dim", "embedding", "clusters"), F.col("clusters"), QUERIES, "turn").select("dim", "cluster", "turns", "turn", "node", "embedding")
    sizes = written(own.groupBy("dim", "cluster").agg(F.max("parts").alias("parts")))
    turns = written(asked.groupBy("dim", "cluster").agg(F.max("turns").alias("turns")))
    # Every query of a cluster visits each of its parts, every part is searched by each turn of queries.
    asked = asked.drop("turns").join(sizes, ["dim", "cluster"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    own = own.drop("parts").join(turns, ["dim", "cluster"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    # New names: both sides come from the same table.
    key = (*SHARDED, "turn")
    asked = asked.toDF(*(f"q_{c}" for c in asked.columns))

    def search(table: pa.Table, queries: pa.Table) -> pa.Table:
        if not table.num_rows or not queries.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        table = table.sort_by("node")
        ids, x, asking, q = table.column("node").to_numpy(), matrix(table.column("embedding")), queries.column("q_node").to_numpy(), matrix(queries.column("q_embedding"))
        lists = table.column("near").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        to = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
        adjacent = np.full((len(ids), max(1, int(size.max()))), -1, np.int32)
        adjacent[np.repeat(np.arange(len(ids)), size), np.arange(len(to)) - np.repeat(np.cumsum(size) - size, size)] = np.where(ids[at] == to, at, -1)
        x32, weight = x.astype(np.float32), np.where(table.column("home").to_numpy(zero_copy_only=False), table.column("n_rows").to_numpy(), 0)
        starts, adjacent = entrances(adjacent, x32), closed(adjacent)
        every, place = np.unique(np.concatenate([ids, asking]), return_inverse=True)
        node_at, query_at = place[: len(ids)], place[len(ids) :]
        root, links = np.arange(len(every)), np.zeros(len(asking), np.int64)
        # Long lists of starts or wide shards: fewer queries at once, as each holds a value for each node.
        batch = max(8, min(BATCH, STEP_BYTES // (4 * len(ids))))
        for low in range(0, len(asking), batch):
            some = q[low : low + batch]
            i, j = searched(adjacent, x32, starts, some.astype(np.float32), beam, least - 1e-4)
            good = ids[j] != asking[low + i]
            i, j = i[good], j[good]
            sure = np.concatenate([np.einsum("ij,ij->i", some[i[k : k + 65536]], x[j[k : k + 65536]]) >= least for k in range(0, len(i), 65536)] or [np.empty(0, bool)])
            i, j = i[sure], j[sure]
            np.add.at(links, low + i, weight[j])
            if len(i):
                root = forest(len(every), np.concatenate([query_at[low + i], np.arange(len(every))]), np.concatenate([node_at[j], root]))
        joined = np.flatnonzero(root != np.arange(len(every)))
        counted = np.flatnonzero(links)
        return pa.table({
            "node": np.concatenate([asking[counted], every[joined]]), "links": np.concatenate([links[counted], np.zeros(len(joined), np.int64)]),
            "root": np.concatenate([asking[counted], every[root[joined]]]),
        })

    return own.groupBy(*key).cogroup(asked.groupBy(*(f"q_{c}" for c in key))).applyInArrow(search, "node long, links long, root long")


def audit(nodes: DataFrame, counts: DataFrame, least: float) -> float:
    """The share of links that counts (node, links) has, of those of AUDITED nodes that brute force finds over all nodes."""
    half = AUDITED // 2
    order = F.xxhash64("node", F.lit(3))
    with_links = [r["node"] for r in counts.orderBy(order).limit(half).select("node").collect()]
    others = [r["node"] for r in nodes.orderBy(order).limit(AUDITED - len(with_links)).select("node").collect()]
    asked = nodes.filter(F.col("node").isin(sorted({*with_links, *others}))).select("node", "dim", "n_rows", "embedding").toArrow()
    if not asked.num_rows:
        return 1.0
    held = nodes.sparkSession.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, dims = held.value.column("node").to_numpy(), held.value.column("dim").to_numpy()
        queries = {int(d): (ids[dims == d], matrix(held.value.column("embedding").combine_chunks().take(pa.array(np.flatnonzero(dims == d))))) for d in np.unique(dims)}
        met_by = dict.fromkeys(ids.tolist(), 0)
        for batch in batches:
            kind = batch.column("dim").to_numpy()
            for dim, (names, q) in queries.items():
                rows = np.flatnonzero(kind == dim)
                if len(rows):
                    met = q @ matrix(batch.column("embedding").take(pa.array(rows))).T >= least
                    met &= names[:, None] != batch.column("node").to_numpy()[rows][None, :]
                    for name, n in zip(names.tolist(), (met @ batch.column("n_rows").to_numpy()[rows]).tolist(), strict=True):
                        met_by[name] += n
        yield pa.RecordBatch.from_pydict({"node": list(met_by), "n": list(met_by.values())})

    truth = nodes.select("node", "dim", "n_rows", "embedding").mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).filter("n > 0")
    both = truth.join(counts, "node", "left").agg(F.sum("n").alias("n"), F.sum(F.least("n", F.coalesce("links", F.lit(0)))).alias("found")).first()
    return 1.0 if not both["n"] else both["found"] / both["n"]


def near_duplicates(vectors: DataFrame, least: float = LEAST, recall: float = RECALL) -> Found:
    """Links between the rows of vectors (vec_id, embedding; others are left out) whose cosine is at least `least`.

    n_links counts the other rows that a row is linked to, component_id is the smallest vec_id that it reaches, itself
    included; a missing one never names a component unless all members lack one. kept marks vec_id = component_id. Vectors
    that are missing, empty, zero or hold missing or non-finite components link with nothing, nor do vectors of different
    lengths. Rows that repeat come back as often and are linked. An empty table gives an empty result.

    Equal vectors are one node. Centroids fitted on a bounded sample split nodes into overlapping shards of bounded size; a
    robust-pruned graph is built on each shard and the adjacency lists are united. Each node searches the graph from the
    medoids of the shards near it with a beam that widens as long as most of it is in range; what is found is verified in
    double precision. Brute force over AUDITED nodes measures recall; below `recall`, the search is repeated with a wider
    beam and more shards. Only counts and edges of spanning forests leave a task, never the pairs.
    """
    kind = vectors.schema["embedding"].dataType
    as_float = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if as_float else 'double'}>").alias("embedding"))
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    usable = F.coalesce((F.size("embedding") > 0) & F.forall("embedding", fine) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    groups = rows.filter(usable).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n_rows"))
    nodes = written(groups.select(F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("dim"), "n_rows", "least", "embedding"))
    bounded_batches(vectors.sparkSession)
    held = centroids(nodes)
    near = found = reached = None
    for turn, (beam, slack) in enumerate(ROUNDS, 1):
        placed = written(routed(nodes, held, slack))
        if near is None:
            near = written(graph(placed))
        found = written(links_found(placed, near, beam, least))
        counts = written(found.groupBy("node").agg(F.sum("links").alias("links")).filter("links > 0"))
        if (reached := audit(nodes, counts, least)) >= recall:
            break
    roots = written(connected_components(found.filter("node <> root"), "node", "root"))
    member = nodes.select("node", "least", "n_rows", "embedding").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = written(member.join(counts, "node", "left").select("root", "least", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n_rows") - 1).alias("n_links")))
    heads = written(member.groupBy("root").agg(F.min("least").alias("component_id")))
    judged = written(member.join(heads, "root").select("embedding", "n_links", "component_id").withColumn("met", F.lit(True)))
    met = rows.withColumn("embedding", F.when(usable, F.col("embedding"))).join(judged, "embedding", "left")
    component = F.when(F.col("met").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = met.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return Found(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), reached, turn)
