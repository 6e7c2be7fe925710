"""Operator 9, approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node, with the smallest ids of the rows that share it. So that inner product becomes a proximity
that a graph can follow, nodes are scaled by the largest norm and given one more component that makes them unit
vectors; a query's order of nodes by inner product is unchanged. The graph starts from the best within small groups
of nodes on the same side of random hyperplanes (groups above GROUP nodes are dealt out by a hash). Each NN-descent
round joins a sample of a node's new and old neighbours, forward and reverse, with their vectors, scores pairs
that involve a new one, and keeps the best NEIGHBOURS of every node, until few edges change. A query starts at its own
node and at the longest ones and keeps a beam of BEAM nodes; each round expands the best that are unexpanded by joining
their neighbours, along edges of both directions (a long vector may be wanted by many and be in no one's own list), until
all of the beam is expanded. The beam is re-scored in double precision on the original vectors.

Defined results: rows whose vector is null, zero, of another length than most, or holds null or non-finite components
take no part, nor do rows without an id; rows that repeat an id are one candidate, of their vectors the least in array
order; ties go to the smaller vec_id; fewer candidates than k give fewer rows, and a query whose beam ended with fewer than
it could have is compared with all rows instead; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, ship, table

NEIGHBOURS, SAMPLE, OFFERS = 32, 16, 12
GROUP, SEEDS = 96, 2
ROUNDS, SETTLED = 12, 0.05
BEAM, EXPAND, ENTRIES = 96, 12, 8
QUERY_BLOCK = 512


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size("v").alias("width")).count().agg(F.max(F.struct("count", "width")).alias("x")).select("x.width")
    return rows.join(F.broadcast(width), F.size("v") == F.col("width"), "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """One row a distinct vector: id (smallest vec_id), v, members (the k + 1 smallest vec_ids)."""
    w = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
    return few.groupBy("v").agg(F.min("vec_id").alias("id"), F.array_sort(F.collect_list("vec_id")).alias("members")).select("id", "v", "members")


def _unit(batch_v, top: float) -> np.ndarray:
    """Rows of a list column as unit vectors with the added component."""
    flat = batch_v.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(batch_v), -1) / top
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])


def packed(nodes: DataFrame, top: float, planes: np.ndarray) -> DataFrame:
    """id, h (half-precision unit vector), side0.. (hyperplane signs for each seed group)."""

    def run(batches):
        for b in batches:
            x = _unit(b.column(1), top)
            cols = [b.column(0), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())]
            for p in planes:
                bits = x @ p.T > 0
                cols.append(pa.array(bits @ (1 << np.arange(bits.shape[1], dtype=np.int64)) if bits.shape[1] else np.zeros(len(x), np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "h", *(f"side{i}" for i in range(len(planes)))])

    sides = "".join(f", side{i} long" for i in range(len(planes)))
    return nodes.select("id", "v").mapInArrow(run, f"id long, h binary{sides}")


EDGES = "id long, q long, sim float"


def _best(ids: np.ndarray, sims: np.ndarray, most: int):
    """For each row of a similarity matrix the `most` best columns (as flat id, neighbour, similarity)."""
    k = min(most, sims.shape[1])
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.broadcast_to(np.arange(k), sims.shape)
    s = np.take_along_axis(sims, at, axis=1)
    good = s > -2
    return np.repeat(ids, good.sum(axis=1)), ids[at][good], s[good]


def within_groups(grouped: DataFrame, most: int) -> DataFrame:
    """Rows with a list `g` of structs (id, h): the best neighbours of each inside its list."""

    def run(batches):
        for b in batches:
            out = []
            for g in b.column(0):
                ids = np.array(g.values.field("id"), np.int64)
                if len(ids) > 1:
                    x = np.frombuffer(b"".join(g.values.field("h").to_pylist()), np.float16).reshape(len(ids), -1).astype(np.float32)
                    s = x @ x.T
                    np.fill_diagonal(s, -9)
                    out.append(_best(ids, s, most))
            yield _edges(out)

    return grouped.mapInArrow(run, EDGES)


def _edges(parts) -> pa.RecordBatch:
    parts = parts or [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
    cols = [np.concatenate([p[i] for p in parts]) for i in range(3)]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2].astype(np.float32), pa.float32())], names=["id", "q", "sim"])


def best_edges(edges: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """id, q, sim, fresh -> each pair once, the `most` best of every id; dealt out once, by id."""
    pairs = edges.repartition("id").groupBy("id", "q").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("id").orderBy(F.col("sim").desc(), "q")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).drop("rank")


def seed_graph(pack: DataFrame, seeds: int) -> DataFrame:
    """Edges from groups on the same side of the hyperplanes."""
    out = None
    for i in range(seeds):
        side = f"side{i}"
        sizes = pack.groupBy(side).count().select(F.col(side).alias("s"), F.ceil(F.col("count") / GROUP).alias("parts"))
        dealt = pack.join(sizes, F.col(side) == F.col("s")).withColumn("part", F.pmod(F.xxhash64("id", F.lit(i)), F.col("parts")))
        grouped = dealt.groupBy(side, "part").agg(F.collect_list(F.struct("id", "h")).alias("g")).select("g")
        e = within_groups(grouped, NEIGHBOURS).withColumn("fresh", F.lit(True))
        out = e if out is None else out.union(e)
    return best_edges(out)


def descend(graph: DataFrame, pack: DataFrame, turn: int) -> DataFrame:
    """One round: neighbours of neighbours through sampled forward and reverse edges."""
    draw = F.xxhash64("id", "q", F.lit(turn))
    taken = F.row_number().over(Window.partitionBy("id", "fresh").orderBy(draw)) <= SAMPLE
    forward = graph.withColumn("taken", taken)
    forward = forward.select("id", "q", "sim", "fresh", "taken")
    used = forward.where("taken").select("id", "q", "fresh")
    back = used.select(F.col("q").alias("id"), F.col("id").alias("q"), "fresh")
    back = back.withColumn("n", F.row_number().over(Window.partitionBy("id", "fresh").orderBy(draw))).where(F.col("n") <= SAMPLE).drop("n")
    meet = used.union(back).join(pack.select(F.col("id").alias("q"), "h"), "q")
    lists = meet.groupBy("id").agg(F.collect_list(F.struct("q", "fresh", "h")).alias("g")).select("g")

    def run(batches):
        for b in batches:
            out = []
            for g in b.column(0):
                ids, first = np.unique(np.array(g.values.field("q"), np.int64), return_index=True)
                fresh = np.array(g.values.field("fresh").to_pylist(), bool)[first]
                if len(ids) < 2 or not fresh.any():
                    continue
                raw = g.values.field("h").to_pylist()
                x = np.frombuffer(b"".join(raw[i] for i in first), np.float16).reshape(len(ids), -1).astype(np.float32)
                s = x @ x.T
                np.fill_diagonal(s, -9)
                s[~(fresh[:, None] | fresh[None, :])] = -9
                out.append(_best(ids, s, OFFERS))
            yield _edges(out)

    offers = lists.mapInArrow(run, EDGES).withColumn("fresh", F.lit(True))
    kept = forward.withColumn("fresh", F.col("fresh") & ~F.col("taken")).drop("taken")
    return best_edges(kept.select("id", "q", "sim", "fresh").union(offers.select("id", "q", "sim", "fresh")))


def build_graph(nodes: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, float]:
    """(graph: id, q, sim, fresh; pack: id, h; largest norm) of a node table."""
    spark = nodes.sparkSession
    ship(spark)
    n, top, width = nodes.agg(
        F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))), F.max(F.size("v"))
    ).first()
    planes = np.random.default_rng(7).standard_normal((SEEDS, max(0, int(np.ceil(np.log2(max(1, n or 1) / GROUP)))), (width or 1) + 1)).astype(np.float32)
    pack = table(packed(nodes, (top or 1.0) * (1 + 1e-9), planes), "ann-pack")
    graph = table(seed_graph(pack, SEEDS), "ann-graph")
    for turn in range(rounds):
        new = table(descend(graph, pack, turn), "ann-graph")
        discard(spark, graph.table_path)
        graph = new
        if graph.where("fresh").count() <= SETTLED * NEIGHBOURS * (n or 0):
            break
    return graph, pack, top or 1.0


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, pack: DataFrame, k: int) -> DataFrame:
    """queries (qid, at: own node, h) -> qid, node: the nodes of each query's final beam."""
    spark = nodes.sparkSession
    both = graph.select("id", F.col("q").alias("next")).union(graph.select(F.col("q").alias("id"), F.col("id").alias("next")))
    links = table(both.distinct(), "ann-links")  # an edge a row, so that hubs need no long lists
    # large inner products are most often with long vectors
    most = ENTRIES * max(1, nodes.count().bit_length())
    entries = nodes.orderBy(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).desc(), "id").limit(most).select(F.col("id").alias("node"))
    start = queries.select("qid", F.col("at").alias("node")).union(queries.select("qid").crossJoin(F.broadcast(entries)))
    beam = table(_scored(start.distinct(), queries, pack).withColumn("done", F.lit(False)), "ann-beam")
    by_score = Window.partitionBy("qid").orderBy(F.col("sim").desc(), "node")
    todo = Window.partitionBy("qid", "done").orderBy(F.col("sim").desc(), "node")
    while True:
        marked = beam.withColumn("go", ~F.col("done") & (F.row_number().over(todo) <= EXPAND))
        step = marked.where("go").join(links, F.col("node") == F.col("id")).select("qid", F.col("next").alias("node")).distinct()
        found = _scored(step.join(beam, ["qid", "node"], "left_anti"), queries, pack).withColumn("done", F.lit(False))
        merged = marked.select("qid", "node", "sim", (F.col("done") | F.col("go")).alias("done")).union(found)
        new = table(merged.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= BEAM).drop("rank"), "ann-beam")
        discard(spark, beam.table_path)
        beam = new
        if beam.where("not done").isEmpty():
            break
    return beam.select("qid", "node")


def _scored(pairs: DataFrame, queries: DataFrame, pack: DataFrame) -> DataFrame:
    """qid, node -> also sim, from half-precision vectors."""

    def run(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.float16).reshape(b.num_rows, -1).astype(np.float32) if b.num_rows else np.empty((0, 1)) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((x * y).sum(axis=1), pa.float32())], names=["qid", "node", "sim"])

    both = pairs.join(pack.select(F.col("id").alias("node"), F.col("h").alias("nh")), "node").join(queries.select("qid", "h"), "qid")
    return both.select("qid", "node", "h", "nh").mapInArrow(run, "qid long, node long, sim float")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Rows whose vec_id is divisible by `every` against all rows: query_id, rank, vec_id, score."""
    rows = table(valid(vectors), "ann-rows")
    nodes = table(nodes_of(rows, k), "ann-nodes")
    graph, pack, top = build_graph(nodes)
    asked = rows.where(F.col("vec_id") % every == 0)
    own = asked.join(nodes.select("id", "v"), "v").select(F.col("vec_id").alias("qid"), F.col("id").alias("at"), "v")

    def halves(batches):
        for b in batches:
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) / top
            h = np.hstack([flat, np.zeros((b.num_rows, 1))]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in h], pa.binary())], names=["qid", "at", "h"])

    queries = table(own.mapInArrow(halves, "qid long, at long, h binary"), "ann-queries")
    beam = search(queries, nodes, graph, pack, k)
    q = rows.select(F.col("vec_id").alias("qid"), F.col("v").alias("qv"))
    pairs = beam.join(q, "qid").join(nodes, F.col("node") == F.col("id")).select("qid", "qv", "v", "members")

    def exact(batches):
        for b in batches:
            x, y = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.empty((0, 1)) for i in (1, 2))
            s = np.einsum("ij,ij->i", x, y)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(s, pa.float64())], names=["query_id", "members", "score"])

    scored = pairs.mapInArrow(exact, "query_id long, members array<long>, score double")
    all_ = scored.select("query_id", F.explode("members").alias("vec_id"), "score").where(F.col("query_id") != F.col("vec_id"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = table(all_.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ann-found")
    most = min(k, rows.count() - 1)
    full = out.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= most)
    short = table(asked.select(F.col("vec_id").alias("query_id"), "v").join(full, "query_id", "left_anti"), "ann-short")
    if most < 1 or short.isEmpty():
        return out
    every_row = compared(short, rows, k).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.join(short, "query_id", "left_anti").union(every_row.select("query_id", "rank", "vec_id", "score"))


def compared(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score of each query (query_id, v) against all rows, the k best of every batch of rows; queries go to
    the rows in blocks of QUERY_BLOCK."""
    out, n = None, queries.count()
    blocks = 1 + (n - 1) // QUERY_BLOCK
    for i in range(blocks):
        # a share of the ids by hash is near QUERY_BLOCK queries; they are a part of the stated query set
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).orderBy("query_id").toArrow()
        if not part.num_rows:
            continue
        ids = part.column("query_id").to_numpy()
        q = np.array(part.column("v").to_pylist(), np.float64)

        def run(batches, ids=ids, q=q):
            for b in batches:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.empty((0, q.shape[1]))
                own = b.column(0).to_numpy()
                found = []
                for one, v in zip(ids, q):
                    at = np.flatnonzero(own != one)
                    s = np.einsum("ij,j->i", x[at], v)
                    order = np.lexsort((own[at], -s))[:k]
                    found.append((np.full(len(order), one), own[at][order], s[order]))
                cols = [np.concatenate([f[j] for f in found]) for j in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

        best = rows.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score double")
        out = best if out is None else out.union(best)
    return out
