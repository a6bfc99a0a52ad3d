"""Approximate nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample (``FIT_ROWS`` distinct vectors by a hash of
their id), every row is put into a leaf, and a query visits leaves best-bin-first: a
priority queue holds tree nodes by their distance to the query, the nearest is
opened, leaves are visited as they come up. How many leaves a query visits is
calibrated: ``PROBES`` calibration vectors are searched exhaustively in blocks, and
the visits are widened until the mean recall of their true neighbours reaches
``TARGET``. Inner products become distances by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm (zero for queries).

Equal vectors are one row of the index, with their k + 1 smallest ids (more can
never be returned, since ties go to the smaller id), so a vector with a third of
all rows costs one comparison per query. Neighbouring leaves share a cell of about
``BLOCK_ROWS`` rows (a larger leaf is cut into several). Queries are dealt in the order
of their own leaf into blocks of about ``BLOCK_QUERIES``, so a block's queries visit much
the same leaves, and a cell is sent only to the blocks that visit it. A task compares one
cell with one block, leaf by leaf for the queries that visit it, and returns k + 1 hits
per query and cell.

Defined results: vectors that are null, zero or hold null or non-finite components take
no part, nor do null ids. Every other row does: an id with several vectors is a query, and
a candidate, with each of them (a candidate's id may then come up more than once, and an
id's own other vectors are its candidates); rows equal in id and vector are one. An inner
product needs equal lengths, so vectors of each length are searched among themselves. Very
long vectors are rows of their length; fewer than k candidates give all of them; equal
scores go to the smaller id; an empty table gives no rows; other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import received, record_batches, sent, written
from cartwise.operators.ranking import range_positions

#: Distinct vectors the tree is fitted on, children per node, rows aimed at per leaf.
FIT_ROWS = 20_000
BRANCHES = 8
LEAF_ROWS = 256
#: Calibration vectors, and the mean recall that their visits must reach.
PROBES = 256
TARGET = 0.96
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 1024


@dataclass
class Tree:
    centers: np.ndarray   # one row per node
    children: list        # node -> list of nodes, empty for a leaf
    leaf_of: list         # node -> leaf number or -1
    leaves: int

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child from the root down."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_of[node]
                continue
            near = _distances(x[rows], self.centers[kids]).argmin(axis=1)
            todo += [(kid, rows[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return out

    def best_first(self, keys: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in the order the priority queue brings them up;
        ``keys`` are the query's distances to all nodes."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for kid in self.children[node]:
                    heapq.heappush(queue, (keys[kid], kid))
            else:
                out.append(self.leaf_of[node])
        return out

    def visits(self, q: np.ndarray, most: int):
        for at in range(0, len(q), 256):
            for keys in _distances(q[at:at + 256], self.centers):
                yield self.best_first(keys.tolist(), most)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant of each row of ``x``."""
    return (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)


def _means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means; starts are evenly spaced along the first principal direction."""
    spread = x - x.mean(axis=0)
    line = spread @ np.linalg.svd(spread[:2000], full_matrices=False)[2][0]
    c = x[np.argsort(line, kind="stable")[((np.arange(k) + 0.5) * len(x) / k).astype(int)]].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(axis=1)
        for i in range(k):
            if (near == i).any():
                c[i] = x[near == i].mean(axis=0)
    return c


def fit_tree(sample: np.ndarray, leaf_rows: int) -> Tree:
    """Splits nodes into up to ``BRANCHES`` children until they hold ``leaf_rows`` sample rows."""
    centers, children, leaf_of, leaves = [sample.mean(axis=0)], [[]], [-1], 0
    todo = [(0, sample)]
    while todo:
        node, x = todo.pop()
        kids = []
        if len(x) > leaf_rows:
            c = _means(x, min(BRANCHES, -(-len(x) // leaf_rows)))
            near = _distances(x, c).argmin(axis=1)
            parts = [x[near == i] for i in range(len(c))]
            kids = [(c[i], p) for i, p in enumerate(parts) if len(p)] if sum(len(p) > 0 for p in parts) > 1 else []
        if not kids:
            leaf_of[node], leaves = leaves, leaves + 1
        for center, part in kids:
            children[node].append(len(centers))
            todo.append((len(centers), part))
            centers.append(center)
            children.append([])
            leaf_of.append(-1)
    return Tree(np.array(centers), children, leaf_of, leaves)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _flat(q: np.ndarray) -> np.ndarray:
    return np.hstack([q, np.zeros((len(q), 1))])


def _hits(scores: np.ndarray, ids: np.ndarray, k: int):
    """(query index, row index) of each query's k best rows, ties to the smaller id."""
    n = scores.shape[1]
    if n > 4 * k:
        floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        q, r = np.nonzero(scores >= floor)
    else:
        q, r = np.divmod(np.arange(scores.size), n)
    order = np.lexsort((ids[r], -scores[q, r], q))
    q, r = q[order], r[order]
    heads = np.searchsorted(q, np.arange(len(scores)))
    keep = np.arange(len(q)) - heads[q] < k
    return q[keep], r[keep]


def _best(rows: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n best rows of each ``by``; the limit also runs before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.col("score").desc(), F.col(tie))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the finite non-zero vectors of doubles, repeated rows once."""
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where("id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
               "AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)").distinct()


def _fraction(rows: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """About ``most`` of ``n`` rows, by a hash of the key."""
    part = min(1.0, most / max(n, 1))
    return rows.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000)) < int(part * 1_000_000) + 1)


class Index:
    """Every vector (of one length) in a leaf of the tree, and the calibrated number of
    visits. A distinct vector's key is its place by its smallest id, so ties by key are
    ties by id."""

    def __init__(self, rows: DataFrame, k: int, target: float = TARGET, fit_rows: int = FIT_ROWS,
                 leaf_rows: int = LEAF_ROWS, probes: int = PROBES):
        self.k, self.rows = k, rows
        least = rows.groupBy("v").agg(F.min("id").alias("least"))
        distinct = written(range_positions(least, [F.col("least").asc(), F.col("v").asc()], "key").select("key", "v"),
                           "ann-vectors")
        self.distinct = distinct
        facts = distinct.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"),
                             F.max(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")).alias("m")).first()
        self.n, self.dim = facts["n"], facts["d"] or 0
        if not self.n:
            return
        self.norm = float(np.sqrt(facts["m"]))
        sample = np.array([r["v"] for r in _fraction(distinct, self.n, fit_rows, 1).toLocalIterator()], np.float64)
        if not len(sample):
            sample = np.array([distinct.first()["v"]], np.float64)
        tree = fit_tree(_lifted(sample, self.norm), max(8, int(leaf_rows * len(sample) / self.n)))
        self.leaves = tree.leaves
        self.fitted, self.tree = tree, sent(rows.sparkSession, tree)
        self.leaf_rows = written(distinct.mapInArrow(self._assign(), "key bigint, v array<double>, leaf int"), "ann-index")
        # the members of each distinct vector that can be returned; the limit also runs before the shuffle
        first = Window.partitionBy("v").orderBy("id")
        top = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("id", "v")
        self.members = written(top.join(distinct, "v").select("key", "id"), "ann-members")
        self.visits = self._calibrated(_fraction(distinct, self.n, probes, 2), target)

    def _assign(self):
        tree_sent, dim, norm = self.tree, self.dim, self.norm

        def run(batches):
            tree = received(tree_sent)
            for b in batches:
                leaf = tree.leaf(_lifted(_matrix(b.column("v"), dim), norm))
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("v"), pa.array(leaf)], ["key", "v", "leaf"])

        return run

    def _calibrated(self, probes: DataFrame, target: float) -> int:
        """The smallest number of visited leaves that finds ``target`` of the probes' neighbours."""
        got = probes.collect()
        if not got:
            return self.leaves
        keys = np.array([r["key"] for r in got], np.int64)
        q = np.array([r["v"] for r in got], np.float64)
        probes_sent, dim, k = sent(probes.sparkSession, (keys, q)), self.dim, self.k
        schema = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("leaf", pa.int32()), ("score", pa.float64())])

        def run(batches):
            keys, q = received(probes_sent)
            for b in batches:
                ids, leaf = b.column("key").to_numpy(), b.column("leaf").to_numpy()
                for at in range(0, len(ids), BLOCK_ROWS):
                    s = slice(at, at + BLOCK_ROWS)
                    scores = q @ _matrix(b.column("v"), dim)[s].T
                    scores[keys[:, None] == ids[None, s]] = -np.inf
                    i, r = _hits(scores, ids[s], k)
                    yield from record_batches(schema, [keys[i], ids[s][r], leaf[s][r], scores[i, r]])

        true = _best(self.leaf_rows.mapInArrow(run, "query bigint, key bigint, leaf int, score double")
                     .where("score > double('-Infinity')"), "query", k, "key").select("query", "leaf").collect()
        if not true:
            return self.leaves
        tree = self.fitted
        place = {int(key): {leaf: i for i, leaf in enumerate(order)}
                 for key, order in zip(keys, tree.visits(_flat(q), tree.leaves))}
        need = np.sort([place[r["query"]][r["leaf"]] for r in true])
        return int(need[min(len(need) - 1, int(np.ceil(target * len(need))) - 1)]) + 1

    def search(self, chosen) -> DataFrame:
        """(query_id, rank, vec_id, score) for the rows whose id meets the condition ``chosen``."""
        spark = self.rows.sparkSession
        out = "query_id bigint, rank int, vec_id bigint, score double"
        if not self.n:
            return spark.createDataFrame([], out)
        asked = written(self.rows.where(chosen).join(self.distinct, "v").select(F.col("id").alias("query_id"), "key", "v"),
                        "ann-asked")
        queries = written(self.leaf_rows.join(asked.select("key").distinct(), "key", "left_semi"), "ann-queries")
        # rows per leaf: as many figures as leaves, bounded by the fitted sample
        sizes = {r["leaf"]: r["count"] for r in self.leaf_rows.groupBy("leaf").count().collect()}
        rows_of = np.array([sizes.get(i, 0) for i in range(self.leaves)], np.int64)
        cell_of = ((np.cumsum(rows_of) - rows_of) // BLOCK_ROWS).astype(np.int32)
        parts_of = -(-np.bincount(cell_of, rows_of).astype(np.int64) // (2 * BLOCK_ROWS))
        asks_of = np.zeros(self.leaves, np.int64)
        for r in queries.groupBy("leaf").count().collect():
            asks_of[r["leaf"]] = r["count"]
        # blocks follow the leaves; a leaf with very many queries fills several
        block_of = (np.cumsum(asks_of) - asks_of) // BLOCK_QUERIES
        more = np.maximum(1, -(-asks_of // BLOCK_QUERIES))
        block_of = block_of + np.cumsum(more - 1) - (more - 1)
        dealt = spark.createDataFrame([(i, int(block_of[i]), int(more[i])) for i in range(self.leaves)],
                                      "leaf int, b0 int, more int")
        cells = spark.createDataFrame([(i, int(c), int(parts_of[c])) for i, c in enumerate(cell_of)],
                                      "leaf int, cell int, parts int")
        asks = (queries.join(F.broadcast(dealt), "leaf")
                .withColumn("b", (F.col("b0") + F.pmod(F.xxhash64("key"), F.col("more"))).cast("int")).select("key", "v", "b")
                .mapInArrow(self._probe(cell_of, parts_of), "key bigint, v array<double>, b int, cell int, part int, "
                                                            "leaves array<int>"))
        asks = written(asks, "ann-asks")
        met = asks.groupBy("cell").agg(F.collect_set("b").alias("bs"))  # cells times the blocks that visit them
        rows = self.leaf_rows.join(F.broadcast(cells), "leaf").join(met, "cell") \
            .withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")) \
            .withColumn("b", F.explode("bs"))
        by = ["cell", "part", "b"]
        hits = (rows.select(*by, "key", "v", "leaf").groupBy(*by)
                .cogroup(asks.select(*by, "key", "v", "leaves").groupBy(*by))
                .applyInArrow(self._compare(), "query bigint, key bigint, score double"))
        near = _best(hits, "query", self.k + 1, "key").select("query", "key", "score")
        named = _best(near.join(self.members, "key"), "query", self.k + 1, "id").select(
            F.col("query").alias("key"), F.col("key").alias("found"), "id", "score")
        final = asked.drop("v").join(named, "key").where("NOT (query_id = id AND key = found)")
        placed = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), F.col("id").asc(), F.col("found").asc())
        return final.withColumn("rank", F.row_number().over(placed)).where(F.col("rank") <= self.k).select(
            "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")

    def _probe(self, cell_of: np.ndarray, parts_of: np.ndarray):
        """Per query and cell (and part of a large one), the leaves it visits there."""
        tree_sent, dim, most = self.tree, self.dim, self.visits

        def run(batches):
            tree = received(tree_sent)
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    row, cell, piece, leaves = [], [], [], []
                    for i, order in enumerate(tree.visits(_flat(_matrix(part.column("v"), dim)), most)):
                        order = np.sort(np.array(order, np.int32))
                        for own in np.split(order, np.flatnonzero(np.diff(cell_of[order])) + 1):
                            c = int(cell_of[own[0]])
                            for p in range(int(parts_of[c])):
                                row.append(i)
                                cell.append(c)
                                piece.append(p)
                                leaves.append(own)
                    row = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key").take(row), part.column("v").take(row), part.column("b").take(row),
                         pa.array(cell, pa.int32()), pa.array(piece, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))],
                        ["key", "v", "b", "cell", "part", "leaves"])

        return run

    def _compare(self):
        dim, k = self.dim, self.k
        schema = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("score", pa.float64())])

        def run(rows, asks):
            if not rows.num_rows or not asks.num_rows:
                return schema.empty_table()
            rows = rows.sort_by("leaf")
            x, leaf, ids = _matrix(rows.column("v"), dim), rows.column("leaf").to_numpy(), rows.column("key").to_numpy()
            spans = {int(n): (np.searchsorted(leaf, n), np.searchsorted(leaf, n, "right")) for n in np.unique(leaf)}
            out = []
            for at in range(0, asks.num_rows, 128):
                part = asks.slice(at, 128)
                q, asked = _matrix(part.column("v"), dim), part.column("key").to_numpy()
                visits = [set(v) for v in part.column("leaves").to_pylist()]
                scores = np.full((len(q), len(x)), -np.inf)
                for n, (s, e) in spans.items():
                    here = [i for i, v in enumerate(visits) if n in v]
                    if here:
                        scores[here, s:e] = q[here] @ x[s:e].T
                i, r = _hits(scores, ids, k + 1)
                seen = scores[i, r] > -np.inf
                i, r = i[seen], r[seen]
                score = (q[i] * x[r]).sum(axis=1)  # the same sum for a pair, whatever block it met in
                out.append(pa.Table.from_arrays([pa.array(asked[i]), pa.array(ids[r]), pa.array(score)], schema=schema))
            return pa.concat_tables(out)

        return run


def nearest(df: DataFrame, chosen, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each row
    whose id meets ``chosen`` (a condition on the column ``id``). One index per length."""
    rows = written(valid_vectors(df, id_col, vec_col), "ann-rows")
    lengths = [r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect()]  # as many rows as lengths
    out = df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for n in sorted(lengths):
        same = rows.where(F.size("v") == n) if len(lengths) > 1 else rows
        out = out.unionByName(Index(same, k, **options).search(chosen))
    return out
