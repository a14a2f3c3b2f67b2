"""Approximate nearest neighbours by inner product: balanced posting lists, searched centroids, pruned probing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tarn.llm.common import saved

#: The index is fitted on this many vectors at most, those least by a hash of the vector.
SAMPLE_ROWS = 40_000
#: Vectors of a list on average, and the most lists; beyond that lists grow.
LIST_ROWS = 256
MAX_LISTS = 8192
#: Queries and vectors multiplied at once, vectors a task holds, and what it finds before it keeps the best; queries all tasks hold.
PIECE_ROWS = 2048
HELD_ROWS = 1 << 16
FOUND_ROWS = 1 << 20
QUERY_ROWS = 8192
#: Queries of a task that looks for their lists.
PROBE_ROWS = 1024
#: A vector enters further lists whose centroid is at most this much farther than the nearest, up to REPLICAS.
CLOSURE = 1.15
REPLICAS = 4
#: The ratio that prunes a query's lists is the least that keeps this share of the sample's true neighbours.
KEPT_SHARE = 0.97
SAMPLE_QUERIES = 256
LEAST_LISTS = 8
DEGREE, LONG_LINKS = 16, 8
#: A step of a search opens this part of its beam, and numbers of a search's steps that are held at once.
OPENED_SHARE = 16
SEARCH_NUMBERS = 1 << 22


def split(x: np.ndarray, parts: int, random: np.random.Generator) -> list[np.ndarray]:
    """Index groups of a balanced split: a group's size makes it look farther away."""
    center = x[random.choice(len(x), parts, replace=False)].astype(np.float64)
    for _ in range(8):
        apart = ((x[:, None, :] - center[None]) ** 2).sum(axis=2) if x.nbytes * parts < 1 << 23 else np.stack(
            [((x - c) ** 2).sum(axis=1) for c in center], axis=1)
        weight, load = apart.mean(), np.zeros(parts)
        label = np.empty(len(x), np.int64)
        for s in range(0, len(x), max(1, len(x) // 16)):  # sizes are felt while vectors are placed
            piece = slice(s, s + max(1, len(x) // 16))
            label[piece] = (apart[piece] + weight * np.maximum(0, load * parts / len(x) - 1)).argmin(axis=1)
            load += np.bincount(label[piece], minlength=parts)
        for j in range(parts):
            if (label == j).any():
                center[j] = x[label == j].mean(axis=0)
    return [np.nonzero(label == j)[0] for j in range(parts) if (label == j).any()]


def centroids(x: np.ndarray, most: float, seed: int = 3) -> np.ndarray:
    """Means of groups of at most ``most`` vectors, by splitting again and again."""
    random, todo, done = np.random.default_rng(seed), [np.arange(len(x))], []
    while todo:
        part = todo.pop()
        if len(part) <= max(1.0, most) or (x[part] == x[part[0]]).all():
            done.append(x[part].mean(axis=0))
            continue
        groups = split(x[part], min(8, max(2, int(np.ceil(len(part) / most))), len(part)), random)
        if len(groups) == 1:
            groups = [g for g in np.array_split(groups[0], 2) if len(g)]
        todo += [part[g] for g in groups]
    return np.array(done, np.float32)


@dataclass
class Graph:
    """Centroids and links between them: the nearest ones and a few far ones; a search starts from the pivots."""

    points: np.ndarray
    links: np.ndarray
    pivots: np.ndarray


def graph_of(points: np.ndarray, seed: int = 5) -> Graph:
    n, random = len(points), np.random.default_rng(seed)
    square = (points ** 2).sum(axis=1)
    links = np.empty((n, min(n, DEGREE) + LONG_LINKS), np.int64)
    for s in range(0, n, 1024):
        apart = square[None] - 2 * points[s:s + 1024] @ points.T
        near = np.argpartition(apart, min(n, DEGREE) - 1, axis=1)[:, :min(n, DEGREE)]
        links[s:s + 1024] = np.concatenate([near, random.integers(0, n, (len(near), LONG_LINKS))], axis=1)
    return Graph(points, links, random.choice(n, min(n, max(16, int(n ** 0.5))), replace=False))


def search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of many queries at once: the centroids met with the least distances, ascending.

    A step opens the nearest one, or of a wide beam the nearest few, which
    meets about the same ones in fewer steps.
    """
    n, rows = len(graph.points), np.arange(len(queries))[:, None]
    beam = min(beam, n)
    width = max(1, beam // OPENED_SHARE)

    def distance(row, at):
        return ((graph.points[at] - queries[row]) ** 2).sum(axis=1)

    seen = np.zeros((len(queries), n), bool)
    found = np.broadcast_to(graph.pivots, (len(queries), len(graph.pivots)))
    seen[:, graph.pivots] = True
    apart = np.stack([distance(rows[:, 0], found[:, j]) for j in range(found.shape[1])], axis=1)
    opened = np.zeros(found.shape, bool)
    while True:
        order = np.argsort(apart, axis=1, kind="stable")[:, :beam]
        found, apart, opened = found[rows, order], apart[rows, order], opened[rows, order]
        closed = opened | np.isinf(apart)
        if closed.all():
            return found, np.sqrt(apart)
        best = np.argsort(closed, axis=1, kind="stable")[:, :width]
        idle = closed[rows, best]
        opened[rows, best] = True
        following = np.where(idle[:, :, None], -1, graph.links[found[rows, best]])
        following = np.sort(following.reshape(len(queries), -1), axis=1)
        fresh = (following >= 0) & ~seen[rows, following]
        fresh[:, 1:] &= following[:, 1:] != following[:, :-1]
        far = np.full(fresh.shape, np.inf, np.float32)
        row, column = np.nonzero(fresh)
        far[row, column] = distance(row, following[row, column])
        seen[row, following[row, column]] = True
        found = np.concatenate([found, following], axis=1)
        apart, opened = np.concatenate([apart, far], axis=1), np.concatenate([opened, ~fresh], axis=1)


def lists_of(graph: Graph, x: np.ndarray) -> list[np.ndarray]:
    """Lists of each vector: the nearest, and those nearly as near."""
    found, apart = search(graph, x, 4 * REPLICAS)
    near = apart <= CLOSURE * apart[:, :1] + 1e-12
    near[:, REPLICAS:] = False
    return [ids[keep] for ids, keep in zip(found, near)]


def calibrated(graph: Graph, rows: np.ndarray, queries: np.ndarray, k: int) -> tuple[float, int]:
    """The distance ratio that prunes, and the beam that then suffices, measured by brute force on the sample."""
    lists = [ids for s in range(0, len(rows), 1024) for ids in lists_of(graph, rows[s:s + 1024])]
    ratios, widths = [], []
    for q in queries:
        near = np.argsort(((rows - q) ** 2).sum(axis=1), kind="stable")[:k + 1]
        apart = np.sqrt(((graph.points - q) ** 2).sum(axis=1))
        apart /= max(float(apart.min()), 1e-12)
        ratios += [apart[lists[i]].min() for i in near]
        widths.append(apart)
    ratio = float(np.quantile(ratios, KEPT_SHARE))
    return ratio, max(int((apart <= ratio).sum()) for apart in widths)


def probes_of(graph: Graph, sizes: np.ndarray, q: np.ndarray, k: int, ratio: float, beam: int) -> list[np.ndarray]:
    """Lists each query reads: pruned by the distance ratio, and as many as hold over k vectors in any case."""
    found, apart = search(graph, q, max(beam, LEAST_LISTS))
    out = []
    for i, (ids, far) in enumerate(zip(found, apart)):
        ids, far = ids[np.isfinite(far)], far[np.isfinite(far)]
        upto = np.cumsum(sizes[ids])
        if upto[-1] <= k and len(ids) < len(sizes):  # too few rows near by: all lists, nearest first
            ids = np.argsort(((graph.points - q[i]) ** 2).sum(axis=1), kind="stable")
            out.append(ids[: int(np.searchsorted(np.cumsum(sizes[ids]), k, side="right")) + 1])
        else:
            enough = int(np.searchsorted(upto, k, side="right")) + 1
            out.append(ids[: max(LEAST_LISTS, enough, int((far <= ratio * far[0]).sum()))])
    return out


def inner_products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """All products in double precision, summed component by component: the measure that results carry, by brute force."""
    out = np.zeros((len(q), len(p)))
    for d in range(q.shape[1]):
        out += q[:, d, None] * p[None, :, d]
    return out


def best_products(q: np.ndarray, p: np.ndarray, floor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score): for each q[i] the ``most`` p[j] of largest product, none below floor[i]; ties to the smaller j.

    The matrix product rounds by position, so it only chooses, with a margin
    for its error, what is then summed component by component in double
    precision: equal vectors get equal scores.
    """
    rough = q @ p.T
    margin = q.shape[1] * 2.0**-50 * np.sqrt((q ** 2).sum(axis=1) * (p ** 2).sum(axis=1).max())
    hit = rough >= (floor - margin)[:, None]
    many = np.nonzero(np.count_nonzero(hit, axis=1) > most)[0]
    if len(many):
        least = np.maximum(floor[many], np.partition(rough[many], len(p) - most, axis=1)[:, len(p) - most])
        hit[many] = rough[many] >= (least - margin[many])[:, None]
    i, j = np.nonzero(hit)
    score = np.zeros(len(i))
    for d in range(q.shape[1]):
        score += q[i, d] * p[j, d]
    order = np.lexsort((j, -score, i))
    order = order[score[order] >= floor[i[order]]]
    i, j, score = i[order], j[order], score[order]
    start = np.searchsorted(i, i)  # i ascends
    kept = np.arange(len(i)) - start < most
    return i[kept], j[kept], score[kept]


@dataclass
class Asked:
    """Queries that are compared at once: a row of bits for eight lists with a byte per query, set where the query reads the list."""

    ids: pa.Array
    v: np.ndarray
    reads: np.ndarray
    floor: np.ndarray

    def of(self, number: int) -> np.ndarray:
        return np.nonzero(self.reads[number >> 3] & (128 >> (number & 7)))[0]


def bits(rows: np.ndarray, lists: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """A row of bits for each query, set at its lists."""
    out = np.zeros((shape[0], -(-shape[1] // 8)), np.uint8)
    np.bitwise_or.at(out, (rows, lists >> 3), (128 >> (lists & 7)).astype(np.uint8))
    return out


def leaders(i: np.ndarray, j: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs, some of them repeated, the ``most`` of largest score for each i, ties to the smaller j."""
    order = np.lexsort((j, -score, i))
    i, j, score = i[order], j[order], score[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (j[1:] != j[:-1])  # equal pairs have equal scores
    i, j, score = i[new], j[new], score[new]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < most
    return i[kept], j[kept], score[kept]


def compare(asked: Asked, lists: pa.ListArray, p: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score): the ``most`` best vectors for each query among those in lists that it reads."""
    member = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    order = np.argsort(member, kind="stable")
    member, row = member[order], row[order]
    floor, kept, n = asked.floor.copy(), [], 0

    def best():
        return leaders(*(np.concatenate([x[c] for x in kept]) for c in range(3)), most)

    for s, e in zip(starts := np.nonzero(np.diff(member, prepend=-1))[0], [*starts[1:], len(member)]):
        queries = asked.of(int(member[s]))
        for a in range(0, len(queries), PIECE_ROWS):
            some = queries[a:a + PIECE_ROWS]
            left = asked.v[some]
            for b in range(s, e, PIECE_ROWS):
                rows = row[b:min(e, b + PIECE_ROWS)]
                i, j, score = best_products(left, p[rows], floor[some], most)
                kept.append((some[i], rows[j], score))
                n += len(i)
                if n > FOUND_ROWS:
                    kept = [best()]
                    i, _, score = kept[0]
                    n, last = len(i), np.nonzero(np.arange(len(i)) - np.searchsorted(i, i) == most - 1)[0]
                    floor[i[last]] = np.maximum(floor[i[last]], score[last])
    return best() if kept else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k vectors of largest inner product found for each query, its own id left out.

    Vectors of equal components share one entry of the index, with their k + 1
    least ids: no other id of theirs can be among a query's first k.  Every
    entry is in at least one list.  Inner products become distances by one more
    component, sqrt(max norm^2 - norm^2).  Vectors that are null, zero, of
    another length than most, or hold null or non-finite components, and null
    ids, take no part; ties go to the smaller id; repeated rows count once;
    with fewer than k candidates all are returned; an empty table gives an
    empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    v, wide = F.col("v"), F.col("v").cast("array<double>")
    norm = F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x)
    clean = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
             .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
             .withColumn("norm", norm).where("norm > 0"))
    sized = clean.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    usual = sized.orderBy(F.desc("n"), "width").first()
    kind = vectors.schema[id_col].dataType.simpleString()
    if usual is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    width, largest = usual["width"], usual["norm"]
    clean = clean.where(F.size("v") == width)
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = saved(clean.select("id", "v").distinct().withColumn("r", rank).where(F.col("r") <= k + 1)
                    .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    n = entries.count()
    sample = entries.orderBy(F.xxhash64("v")).limit(SAMPLE_ROWS).select("v").toPandas()["v"]

    def lifted(rows, query=False):
        x = np.array(rows, np.float64).reshape(-1, width)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, largest - (x ** 2).sum(axis=1)))
        return np.concatenate([x, last[:, None]], axis=1).astype(np.float32)

    lists = max(1, min(MAX_LISTS, -(-n // LIST_ROWS)))
    x = lifted(list(sample))
    graph = graph_of(centroids(x, len(x) / lists))
    ratio, beam = calibrated(graph, x, lifted(list(sample[:SAMPLE_QUERIES]), True), k)
    shared = spark.sparkContext.broadcast(graph)  # its points are bounded by the sample and MAX_LISTS

    def place(frames):
        for pdf in frames:
            for s in range(0, len(pdf), 1024):
                part = pdf.iloc[s:s + 1024]
                yield part.assign(lists=[x.astype(np.int32) for x in lists_of(shared.value, lifted(list(part["v"])))])[["lists", "v", "ids"]]

    # A vector is stored once, with its lists: their copies of it are made in the memory of the tasks that compare.
    vector = vectors.schema[vector_col].dataType.simpleString()
    placed = saved(entries.mapInPandas(place, f"lists array<int>, v {vector}, ids array<{kind}>"), "placed")
    counts = placed.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    sizes = np.zeros(len(graph.points), np.int64)
    for row in counts.collect():  # a row per list
        sizes[row["list"]] = -(-row["n"] // REPLICAS)  # an entry may be met in so many lists

    wide = max(1, beam // OPENED_SHARE) * graph.links.shape[1]
    together = min(512, max(16, SEARCH_NUMBERS // (max(wide, beam) * (width + 1))))  # queries searched at once

    def probe(frames):
        for pdf in frames:
            for s in range(0, len(pdf), together):
                part = pdf.iloc[s:s + together]
                chosen = probes_of(shared.value, sizes, lifted(list(part["v"]), True), k, ratio, beam)
                reads = bits(np.repeat(np.arange(len(part)), [len(c) for c in chosen]), np.concatenate(chosen), (len(part), len(sizes)))
                yield part.assign(reads=[x.tobytes() for x in reads], first=[c[:LEAST_LISTS].astype(np.int32) for c in chosen])

    queries = saved(clean.where(is_query(F.col("id"))).select("id", "v").distinct(), "queries")
    asking = queries.count()
    blocks = -(-asking // QUERY_ROWS)
    probes = saved(queries.repartition(-(-asking // PROBE_ROWS) or 1, "id")
                   .mapInPandas(probe, f"id {kind}, v {vector}, reads binary, first array<int>")
                   .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))), "probes")

    def compared(asked: Asked) -> tuple[DataFrame, Broadcast]:
        """The best entries for each query among those in the lists it reads, of every task's entries."""
        sent = spark.sparkContext.broadcast(asked)  # bounded by QUERY_ROWS and MAX_LISTS

        def run(batches):
            held, n = [], 0

            def found():
                table = pa.Table.from_batches(held).combine_chunks()
                ids = table.column("ids").chunk(0)
                table = table.take(pc.sort_indices(pc.list_element(ids, 0)))  # ties go to the smaller id
                lists, v, ids = (table.column(c).combine_chunks() for c in ("lists", "v", "ids"))
                p = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
                i, j, score = compare(sent.value, lists, p, k + 1)
                return pa.RecordBatch.from_arrays([sent.value.ids.take(pa.array(i)), pa.array(score), ids.take(pa.array(j))],
                                                  ["query_id", "score", "ids"])

            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    n += batch.num_rows
                if n >= HELD_ROWS:
                    yield found()
                    held, n = [], 0
            if n:
                yield found()

        return placed.mapInArrow(run, f"query_id {kind}, score double, ids array<{kind}>"), sent

    def leading(found: DataFrame):
        """Distinct entries of each query with their place, the k + 1 first ones."""
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("ids")[0])
        distinct = found.groupBy("query_id", "ids").agg(F.max("score").alias("score"))
        return distinct.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)

    def answered(asked: pd.DataFrame) -> DataFrame:
        """The nearest lists come first.  Their k + 1 best entries bound the score of a result from below: other lists give only what reaches it."""
        reads = np.stack([np.frombuffer(x, np.uint8) for x in asked["reads"]])
        first = bits(np.repeat(np.arange(len(asked)), asked["first"].map(len)), np.concatenate(list(asked["first"])), (len(asked), len(sizes)))
        ids, v = pa.array(asked["id"], to_arrow_type(vectors.schema[id_col].dataType)), np.array(list(asked["v"]), np.float64)
        found, sent = compared(Asked(ids, v, np.ascontiguousarray(first.T), np.full(len(asked), -np.inf)))
        early = saved(leading(found), "nearest-lists")
        sent.destroy()
        floors = early.where(F.col("r") == k + 1).select("query_id", "score").toPandas().set_index("query_id")["score"]
        floor = asked["id"].map(floors).fillna(-np.inf).to_numpy(np.float64)
        found, sent = compared(Asked(ids, v, np.ascontiguousarray((reads & ~first).T), floor))
        near = saved(leading(early.drop("r").unionByName(found)), "near")
        sent.destroy()
        return near

    if not asking:
        return spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    near = reduce(DataFrame.unionByName, (answered(asked) for b in range(blocks)
                                          if len(asked := probes.where(F.col("block") == b).drop("block").toPandas())))
    each = (near.select("query_id", "score", F.explode("ids").alias("id")).where("id <> query_id")
            .groupBy("query_id", "id").agg(F.max("score").alias("score")))
    final = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (each.withColumn("rank", final).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
