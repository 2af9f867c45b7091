"""Embedding near-duplicates by NN-descent.

Equal vectors are collapsed first. Random hyperplane cells give every vector a
first neighbour list; rounds of local joins (all vectors of one list against
each other, with a bounded product per list) refine the lists through
neighbours of neighbours. A list whose last neighbour is still over the
threshold is saturated: it is enlarged and its vector refined again. When no
list changes any more, recall is audited per vector against brute force: for a
bounded number of random vectors and, where links are rare among them, for
vectors that cells drawn independently of the search found linked. Below the
target, twice as many fresh cells reseed the lists, until cells would compare as
much as all pairs: then all pairs are compared. Edges over the threshold, checked in double
precision, are the links.
"""

from __future__ import annotations

import logging
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, shared_folder
from .graph import components

log = logging.getLogger(__name__)

THRESHOLD = 0.9
LIST = 10                   # neighbours under the threshold that a list keeps
LINKS = 1024                  # links a list holds before it is saturated and grows
CELL = 256                  # vectors compared at a time in a cell, at most
TREES = 8                   # hyperplane cells a vector is put into
AUDIT = 512                 # vectors with 1 to LIST links that an audit looks for
AUDIT_SLICES = 4            # random slices searched for them against all vectors, at most
WITNESS_SEEDS = (1001, 1002, 1003)  # cells that the search itself never uses, in turn
RECALL = 0.98               # audited share of a vector's links, on average, that ends the search
_GROWTH = 16
_SHOWN = 3                  # lists of a round that show a vector with a long list, about
_SLICE = 4096               # vectors searched against all at a time, at most


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors (double) of a binary column whose rows are equally long."""
    x = np.stack([np.frombuffer(v, kind) for v in column.to_pylist()]).astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _cells(kind: str, bits: int, trees: int, seed: int):
    """(node, dim, vec) -> one row per tree: the cell of the vector."""
    def run(it):
        for b in it:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                x = _matrix(part.column("vec"), kind)
                for t in range(trees):
                    planes = np.random.default_rng([seed, t, int(d)]).normal(size=(int(d), bits))
                    sign = (x @ planes > 0).astype(np.int64) @ (1 << np.arange(bits))
                    n = len(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((sign << 32) | t), pa.array(np.full(n, d, np.int32)), part.column("node")],
                        names=["cell", "dim", "node"])
    return run


def _local_join(kind: str, threshold: float):
    """Buckets (lists of node, vec, k, kth) -> directed candidates for a list: a
    bucket offers a vector at most k links, and at most LIST others."""
    schema = pa.schema([("node", pa.int64()), ("nbr", pa.int64()), ("sim", pa.float64())])

    def best(s, ok, most):
        """``ok`` cut to the ``most`` highest (and ties) of each row."""
        for r in np.flatnonzero(ok.sum(axis=1) > most):
            values = s[r][ok[r]]
            ok[r] &= s[r] >= np.partition(values, -most[r])[-most[r]]
        return ok

    def run(it):
        for b in it:
            lists = b.column("members")
            bounds, rows = lists.offsets.to_numpy(), lists.values
            node, k, kth = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "k", "kth"))
            vec, out, held = rows.field("vec"), [], 0
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                x, ids = _matrix(vec.slice(lo, hi - lo), kind), node[lo:hi]
                for i in range(0, hi - lo, 512):
                    s = x[i:i + 512] @ x.T
                    mine = slice(lo + i, lo + i + len(s))
                    free = (ids[i:i + 512, None] != ids) & (s > kth[mine, None])
                    good = best(s, free & (s >= threshold), k[mine]) | \
                        best(s, free & (s < threshold), np.minimum(k[mine], LIST))
                    p, q = np.nonzero(good)
                    out.append((ids[i + p], ids[q], s[p, q]))
                    held += len(p)
                    if held > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
                        out, held = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
    return run


def _against(kind: str, threshold: float, sets: list, pairs: bool = False):
    """(node, dim, vec) -> links (node of ``sets``, how many) in a part of a
    batch, or the ``pairs`` (a of ``sets`` < b)."""
    def run(it):
        for b in it:
            of = b.column("dim").to_numpy()
            for d, ids, y in sets:
                part = b.filter(pa.array(of == d))
                for lo in range(0, part.num_rows, 512):
                    rows = part.slice(lo, 512)
                    linked = _matrix(rows.column("vec"), kind) @ y.T >= threshold
                    node = rows.column("node").to_numpy()
                    if pairs:
                        p, q = np.nonzero(linked & (node[:, None] > ids))
                        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(node[p])], names=["a", "b"])
                        continue
                    n = (linked & (node[:, None] != ids)).sum(axis=0)
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some])], names=["node", "n"])
    return run


class _Search:
    """Neighbour lists over distinct vectors (node, dim, vec, copies)."""

    def __init__(self, nodes: DataFrame, kind: str, threshold: float):
        self.nodes, self.kind, self.threshold = nodes, kind, threshold
        self.n, widest = nodes.agg(F.count("*"), F.max("dim")).first()
        self.slices = int(np.ceil(self.n / max(64, min(_SLICE, 2 ** 21 // (widest or 1)))))
        self.truth = None

    def seeded(self, seed: int, trees: int = TREES) -> DataFrame:
        """Membership (bucket, node) of hyperplane cells; large cells are cut by hash."""
        bits = max(0, int(np.ceil(np.log2(max(1, self.n / (CELL / 2))))))
        cells = self.nodes.mapInArrow(_cells(self.kind, bits, trees, seed), "cell long, dim int, node long")
        sizes = cells.groupBy("cell", "dim").agg(F.count("*").alias("size"))
        part = F.pmod(F.xxhash64("node", "cell"), F.ceil(F.col("size") / CELL))
        return cells.join(sizes, ["cell", "dim"]).select(F.xxhash64("cell", "dim", part).alias("bucket"), "node")

    def refined(self, graph: DataFrame | None, membership: DataFrame) -> DataFrame:
        """New lists (node, k, nbrs, changed) from comparing all of each bucket."""
        if graph is None:
            graph = self.nodes.select("node", F.lit(LINKS).alias("k"),
                                      F.expr("cast(array() as array<struct<sim:double,nbr:long>>)").alias("nbrs"))
        state = graph.select("node", "k", F.when(F.size("nbrs") >= F.col("k"), F.expr("element_at(nbrs, -1).sim"))
                             .otherwise(-2.0).alias("kth"))
        vectors = self.nodes.select("node", "vec").join(state, "node")
        found = membership.join(vectors, "node") \
            .groupBy("bucket").agg(F.collect_list(F.struct("node", "vec", "k", "kth")).alias("members")) \
            .select("members").mapInArrow(_local_join(self.kind, self.threshold), "node long, nbr long, sim double")
        old = graph.select("node", F.explode("nbrs").alias("e")).select("node", "e.nbr", "e.sim", F.lit(1).alias("old"))
        both = old.unionByName(found.withColumn("old", F.lit(0))).repartition("node")
        best = both.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
        lists = best.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sim", "nbr", "old")), False).alias("all"))
        nothing = F.expr("cast(array() as array<struct<sim:double,nbr:long,old:int>>)")
        links = F.expr(f"size(filter(all, x -> x.sim >= {self.threshold}))")
        kept = graph.select("node", "k").join(lists, "node", "left").withColumn("all", F.coalesce("all", nothing)) \
            .withColumn("all", F.slice("all", F.lit(1), F.least(F.col("k"), links + LIST)))
        full = (F.size("all") >= F.col("k")) & (F.expr("element_at(all, -1).sim") >= self.threshold)
        saturated = F.coalesce(full, F.lit(False))
        return save(kept.select(
            "node", F.when(saturated, F.col("k") * _GROWTH).otherwise(F.col("k")).alias("k"),
            F.expr("transform(all, x -> named_struct('sim', x.sim, 'nbr', x.nbr))").alias("nbrs"),
            (saturated | F.expr(f"exists(all, x -> x.old = 0 and x.sim >= {self.threshold})")
             | (links < LIST) & F.expr("exists(all, x -> x.old = 0)")).alias("changed")), "lists")

    def around(self, graph: DataFrame, step: int) -> DataFrame:
        """Membership of the lists' local joins: changed lists only; of lists over
        2 LIST long a share that still shows every vector about _SHOWN of them."""
        size = F.size("nbrs")
        one_in = F.when(size > 2 * LIST, F.floor(size / _SHOWN)).otherwise(1)
        turn = F.pmod(F.xxhash64("node", F.lit(step)), one_in) == 0
        centre = graph.where(F.col("changed") & turn)
        own = centre.select(F.col("node").alias("bucket"), "node")
        return own.unionByName(centre.select(F.col("node").alias("bucket"), F.explode("nbrs.nbr").alias("node")))

    def links(self, graph: DataFrame) -> DataFrame:
        """Distinct pairs a < b over the threshold."""
        e = graph.select("node", F.explode("nbrs").alias("e")).where(F.col("e.sim") >= self.threshold)
        return e.select(F.least("node", "e.nbr").alias("a"), F.greatest("node", "e.nbr").alias("b")).distinct()

    def sets_of(self, some: DataFrame) -> list:
        """(dim, nodes, unit vectors) of at most a slice of vectors."""
        part = some.select("node", "dim", "vec").toArrow().combine_chunks()
        dims, sets = part.column("dim").to_numpy(), []
        for d in np.unique(dims):
            of = part.filter(pa.array(dims == d))
            sets.append((int(d), of.column("node").to_numpy(), _matrix(of.column("vec"), self.kind)))
        return sets

    def sliced(self, k: int) -> DataFrame:
        """The k-th random slice of all vectors."""
        return self.nodes.where(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(self.slices)) == k)

    def witnesses(self, seed: int, known: DataFrame) -> DataFrame:
        """At most a slice of vectors that cells of ``seed`` put beside 1 to LIST
        links, and that are not ``known``."""
        pairs = self.links(self.refined(None, self.seeded(seed)))
        found = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count() \
            .where(F.col("count") <= LIST).join(known, "node", "left_anti")
        few = found.orderBy(F.xxhash64("node", F.lit(7))).limit(self.n // self.slices + 1).select("node")
        return self.nodes.join(few, "node")

    def audited(self) -> DataFrame:
        """(node, n_true) of linked vectors, by brute force against all vectors,
        until AUDIT of them have at most LIST links: of AUDIT_SLICES random slices
        at most, then of the witnesses of cells that the search does not use. The
        work is a bounded number of passes over the vectors."""
        if self.truth is None:
            spark, schema = self.nodes.sparkSession, "node long, n_true long"
            path = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
            self.truth = spark.createDataFrame([], schema)
            turns = [lambda k=k: self.sliced(k) for k in range(min(self.slices, AUDIT_SLICES))]
            if self.slices > AUDIT_SLICES:
                turns += [lambda seed=seed: self.witnesses(seed, self.truth) for seed in WITNESS_SEEDS]
            for turn in turns:
                self.nodes.select("node", "dim", "vec") \
                    .mapInArrow(_against(self.kind, self.threshold, self.sets_of(turn())), "node long, n long") \
                    .groupBy("node").agg(F.sum("n").alias("n_true")).write.mode("append").parquet(path)
                self.truth = spark.read.schema(schema).parquet(path)
                if self.truth.where(f"n_true <= {LIST}").count() >= AUDIT:
                    break
        return self.truth

    def recall(self, graph: DataFrame) -> float:
        """Share of the audited vectors' links that the lists hold, the lowest of
        three: the mean over vectors with at most LIST links, that over those with
        more (so that a large group does not hide lost pairs, nor pairs a group),
        and the share of all their links. 1 if no audited vector is linked."""
        links = self.links(graph)
        held = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("held"))
        seen = F.least(F.col("n_true"), F.coalesce("held", F.lit(0)))
        rows = self.audited().join(held, "node", "left").groupBy(F.col("n_true") <= LIST) \
            .agg(F.avg(seen / F.col("n_true")), F.sum(seen), F.sum("n_true")).collect()
        return min([r[1] for r in rows] + [sum(r[2] for r in rows) / sum(r[3] for r in rows)]) if rows else 1.0

    def exact(self) -> DataFrame:
        """All links by brute force, slice by slice."""
        spark, path = self.nodes.sparkSession, f"{shared_folder(self.nodes.sparkSession)}/exact-{uuid.uuid4().hex}"
        for k in range(self.slices):
            self.nodes.select("node", "dim", "vec") \
                .mapInArrow(_against(self.kind, self.threshold, self.sets_of(self.sliced(k)), pairs=True), "a long, b long") \
                .write.mode("append").parquet(path)
        return spark.read.schema("a long, b long").parquet(path)

    def run(self) -> DataFrame:
        """The links: of lists that pass the audit, or of all pairs."""
        graph, step, reseeds = self.refined(None, self.seeded(0)), 0, 0
        while True:
            if not graph.agg(F.max("changed")).first()[0]:
                got = self.recall(graph)
                log.info("audited recall %.4f after %d rounds", got, step)
                if got >= RECALL:
                    return self.links(graph)
                reseeds += 1
                trees = TREES << reseeds
                if trees * CELL >= self.n:
                    return self.exact()
                graph = self.refined(graph, self.seeded(reseeds, trees))
            step += 1
            graph = self.refined(graph, self.around(graph, step))


def vector_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: ``id_col, n_links, component_id, kept``.

    Equal vectors count as links of each other (cosine 1) without being
    compared again. Vectors that are null, empty, zero or hold a null or
    non-finite component, and vectors of different length, link with nothing.
    A null id is never a component's smallest id unless it has no other, and is
    not kept where another id is; repeated rows are vectors of their own.
    """
    item = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "<f4" if item == "float" else "<f8"
    values = F.col(vector_col).cast("array<double>")
    ok = F.coalesce(F.size(values) > 0, F.lit(False)) & \
        F.coalesce(~F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False)) & \
        F.coalesce(F.exists(values, lambda v: v != 0), F.lit(False))

    def packed(it):
        for b in it:
            raw = [None if v is None else np.array(v, kind).tobytes() for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], names=["id", "vec"])

    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.when(ok, F.col(vector_col)).alias("vec")) \
        .mapInArrow(packed, f"id {id_type}, vec binary")
    rows = save(rows.withColumn("key", F.sha2("vec", 256)), "vectors")
    width = np.dtype(kind).itemsize
    classes = rows.where("vec is not null").groupBy("key") \
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.min("vec").alias("vec"))
    nodes = save(classes.withColumn("node", F.monotonically_increasing_id())
                 .withColumn("dim", (F.octet_length("vec") / width).cast("int")), "vector-classes")
    search = _Search(nodes, kind, threshold)
    links = save(search.run(), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b") \
        .groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("linked"))
    group = nodes.select("node", "key", "first", "copies").join(components(links, "a", "b"), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = group.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = group.join(least, "component").join(degree, "node", "left") \
        .select("key", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = rows.drop("vec").join(per_class, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
