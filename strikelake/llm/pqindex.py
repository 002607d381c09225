"""Embedding near-duplicates with product quantisation: inverted lists, residual codes, exact cosine rerank.

Vectors are compared at unit length. Coarse centroids and residual codebooks are fitted on a bounded sample; every
vector is stored in the list of its nearest centroid, with one codeword per subspace for the residual, and is asked in
every list whose border lies within half the distance that the threshold stands for: of two vectors on either side of a
border that are no further apart, one is that near to it, so no link is lost to the choice of lists. In a list, asymmetric
distances come from a table per query and subspace; pairs within the threshold plus the quantisation error are reranked
by their exact cosine in double precision.

Vectors of different lengths link with nothing of each other, and every length has a quantizer of its own; few vectors
have fewer lists and codewords.

Equal vectors are one class with a weight. A (label, length, list) cell is cut into blocks of ``BLOCK`` rows and every pair of
blocks is a group of its own, so a hot label or list is spread out; a group returns link counts per vector and the
edges of a spanning forest, never its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strikelake.llm.components import components, forest
from strikelake.sources.storage import as_table

COSINE = 0.93
SAMPLE = 20_000
LISTS, SUBSPACES, CODEWORDS = 64, 8, 64
LEAST_PER_LIST = 16  # vectors that a list or a codeword is fitted on, at least
VECTORS_PER_LIST = 1000  # beyond LISTS * this, more lists, as far as the sample can fit them
BLOCK = 512
ROUNDS = 12
ERROR_QUANTILE = 0.999


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids of the rows by Lloyd's rounds from a seeded start; at most as many as there are distinct rows."""
    x = np.asarray(x, float)
    start = np.unique(x, axis=0)
    if len(start) <= k:
        return start
    c = start[np.sort(np.random.default_rng(seed).choice(len(start), k, replace=False))]
    for _ in range(ROUNDS):
        near = ((c**2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(c))
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


@dataclass(frozen=True)
class Quantizer:
    """Coarse centroids, codebooks per subspace, and the allowance for the quantisation error."""

    coarse: np.ndarray
    books: list
    cuts: np.ndarray
    allowance: float

    def place(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, list[list[int]]]:
        """(home list, lists asked) of unit vectors: home and those whose border is within the margin."""
        square = np.maximum((x**2).sum(axis=1)[:, None] + (self.coarse**2).sum(axis=1)[None, :] - 2 * x @ self.coarse.T, 0)
        home = square.argmin(axis=1)
        norms = (self.coarse**2).sum(axis=1)
        between = np.sqrt(np.maximum(norms[:, None] + norms[None, :] - 2 * self.coarse @ self.coarse.T, 1e-12))
        border = (square - square[np.arange(len(x)), home][:, None]) / (2 * between[home])
        near = border <= margin
        near[np.arange(len(x)), home] = True
        return home, [np.flatnonzero(r).tolist() for r in near]

    def encode(self, residual: np.ndarray) -> np.ndarray:
        """Codeword per subspace."""
        parts = [residual[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        return np.stack([((b**2).sum(axis=1)[None, :] - 2 * p @ b.T).argmin(axis=1) for p, b in zip(parts, self.books)],
                        axis=1).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Residuals of codes."""
        return np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)

    def distances(self, query: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of unit queries to coded members of a list: sums of table entries."""
        q, out = query - self.coarse[home], np.zeros((len(query), len(codes)))
        for i, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books)):
            table = ((q[:, None, a:b] - book[None, :, :]) ** 2).sum(axis=2)
            out += table[:, codes[:, i]]
        return out


def fit(sample: np.ndarray, cosine: float, lists: int, subspaces: int, codewords: int) -> Quantizer:
    """A quantizer of unit vectors; the same sample gives the same one."""
    coarse = kmeans(sample, lists, 1)
    home = ((coarse**2).sum(axis=1)[None, :] - 2 * sample @ coarse.T).argmin(axis=1)
    residual = sample - coarse[home]
    cuts = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
    books = [kmeans(residual[:, a:b], codewords, 2 + i) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    plain = Quantizer(coarse, books, cuts, 0.0)
    error = np.sqrt(((residual - plain.decode(plain.encode(residual))) ** 2).sum(axis=1))
    radius = np.sqrt(max(2 - 2 * cosine, 0.0)) + float(np.quantile(error, ERROR_QUANTILE, method="higher"))
    return Quantizer(coarse, books, cuts, radius**2)


def prepared(vectors: DataFrame) -> DataFrame:
    """Classes of equal usable vectors: id (smallest vec_id), label, embedding in doubles, weight (rows)."""
    v = F.col("embedding").cast("array<double>")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        v, lambda x: x != 0)
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.alias("embedding")).groupBy(
        "label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, *, sample: int = SAMPLE, lists: int = LISTS, subspaces: int = SUBSPACES,
    codewords: int = CODEWORDS, margin: float | None = None, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links join vectors of equal label and length whose cosine is at least ``cosine``; vectors without a label, or that
    are null, empty or zero or hold null or non-finite components, link with nothing; a null vec_id links with nothing and has a null component. Rows that repeat a vec_id count as
    vectors of their own and share a component. An empty table gives no rows; other columns are ignored.
    """
    margin = np.sqrt(max(2 - 2 * cosine, 0.0)) / 2 if margin is None else margin
    classes = as_table(prepared(vectors).withColumn("width", F.size("embedding")), "pq-classes")
    widths = {r["width"]: r["count"] for r in classes.groupBy("width").count().collect()}
    models = {}
    for width, n in widths.items():
        picked = classes.filter(F.col("width") == width).select("embedding", "id").orderBy(
            F.xxhash64("id"), "id").limit(sample).collect()
        learned = np.array([r["embedding"] for r in picked])
        learned = learned / np.abs(learned).max(axis=1)[:, None]
        learned = learned / np.sqrt((learned**2).sum(axis=1))[:, None]
        room = max(len(learned) // LEAST_PER_LIST, 1)
        models[width] = fit(learned, cosine, min(room, max(lists, n // VECTORS_PER_LIST)), subspaces, min(codewords, room))
    if widths:
        counts, edges = _links(classes, classes.sparkSession.sparkContext.broadcast(models), cosine, margin, block)
        found = components(edges, "pq-components")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                       F.col("embedding").cast("array<double>").alias("embedding"))
    if not widths:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    per_class = as_table(
        classes.join(counts, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left").select(
            "label", "embedding", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id")), "pq-found")
    out = v.join(per_class, ["label", "embedding"], "left").select(
        "vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias(
            "n_links"), F.when(F.col("vec_id").isNull(), None).otherwise(F.coalesce("component_id", "vec_id")).alias(
                "component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _unit(column: pa.Array) -> np.ndarray:
    x = np.array(column.to_pylist(), float)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def _links(classes: DataFrame, models, cosine: float, margin: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(id, links) and forest edges (a, b) of the classes."""
    label = classes.schema["label"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                own = batch.filter(pa.array(widths == width))
                model, unit = models.value[width], _unit(own.column("embedding"))
                home, asked = model.place(unit, margin)
                codes = model.encode(unit - model.coarse[home])
                yield pa.RecordBatch.from_arrays(
                    [own.column(c) for c in ("id", "label", "width", "embedding", "weight")]
                    + [pa.array(home.astype(np.int32)), pa.array(asked, pa.list_(pa.int32())),
                       pa.array([c.tobytes() for c in codes], pa.binary())],
                    ["id", "label", "width", "embedding", "weight", "home", "asked", "code"])

    placed = as_table(classes.mapInArrow(
        place, f"id bigint, label {label}, width int, embedding array<double>, weight bigint, home int, "
               "asked array<int>, code binary"), "pq-placed")
    sizes = as_table(placed.groupBy("label", "width", "home").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("int").alias("blocks")).withColumnRenamed(
            "home", "cell"), "pq-cells")
    own = F.col("cell") == F.col("home")
    part = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    each = placed.withColumn("cell", F.explode("asked")).join(sizes, ["label", "width", "cell"]).withColumn("part", part)
    # a member meets the blocks at or after its own as the first side, those before as the second; a visitor all
    spread = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    role = F.when(~own, F.lit("visit")).otherwise(F.lit("member"))
    member = spread.filter(own).select("*", role.alias("role"), F.least("part", "other").alias("x"),
                                       F.greatest("part", "other").alias("y"))
    # visitors are dealt over the same blocks, so that a group holds at most one block of each side
    visitor = spread.filter(~own).select("*", role.alias("role"), F.col("other").alias("x"),
                                         (F.col("blocks") + F.col("part")).alias("y"))
    host = each.filter(own).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), F.lit("host").alias("role"),
        F.col("part").alias("x"), (F.col("blocks") + F.col("other")).alias("y"))
    rows = member.unionByName(visitor).unionByName(host).select(
        "label", "width", "cell", "x", "y", "id", "embedding", "weight", "home", "asked", "code", "role", "part")

    def meet(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).to_pylist()[0]
        role, part = (np.array(table.column(c).to_pylist()) for c in ("role", "part"))
        if first["role"] == "member":
            left, right = np.flatnonzero(part == first["x"]), np.flatnonzero(part == first["y"])
        else:
            left, right = np.flatnonzero(role == "visit"), np.flatnonzero(role == "host")
        out = {}, []
        if len(left) and len(right):
            q = models.value[first["width"]]
            ids, weight, home = (table.column(c).combine_chunks().to_numpy() for c in ("id", "weight", "home"))
            x = np.array(table.column("embedding").to_pylist(), float)
            unit = x / np.abs(x).max(axis=1)[:, None]
            unit = unit / np.sqrt((unit**2).sum(axis=1))[:, None]
            codes = np.array([np.frombuffer(c, np.uint8) for c in table.column("code").to_pylist()])
            near = q.distances(unit[left], first["cell"], codes[right]) <= q.allowance
            if first["role"] == "member":
                if first["x"] == first["y"]:
                    near = np.triu(near | near.T, 1)
            else:  # a pair whose members ask each other's lists is counted in the smaller one
                asked = table.column("asked").to_pylist()
                back = np.zeros((len(right), len(q.coarse)), bool)
                for i, r in enumerate(right.tolist()):
                    back[i, asked[r]] = True
                near &= ~((home[left][:, None] < first["cell"]) & back[:, home[left]].T)
            i, j = np.nonzero(near)
            linked = np.zeros_like(near)
            for s in range(0, len(i), 1 << 16):
                a, b = left[i[s : s + (1 << 16)]], right[j[s : s + (1 << 16)]]
                linked[i[s : s + (1 << 16)], j[s : s + (1 << 16)]] = (unit[a] * unit[b]).sum(axis=1) >= cosine
            out[1].extend(forest(linked, ids[left], ids[right]))
            for own, n in ((left, linked @ weight[right]), (right, linked.T @ weight[left])):
                for k in np.flatnonzero(n).tolist():
                    out[0][int(ids[own[k]])] = out[0].get(int(ids[own[k]]), 0) + int(n[k])
        counts, edges = out
        return pa.table({
            "a": pa.array([*counts, *(e[0] for e in edges)], pa.int64()),
            "b": pa.array([*[None] * len(counts), *(e[1] for e in edges)], pa.int64()),
            "links": pa.array([*counts.values(), *[None] * len(edges)], pa.int64())})

    met = as_table(rows.groupBy("label", "width", "cell", "x", "y").applyInArrow(meet, "a bigint, b bigint, links bigint"), "pq-met")
    counts = met.filter(F.col("links").isNotNull()).groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    return counts, met.filter(F.col("b").isNotNull()).select("a", "b")


def op7_pq_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of the whole embeddings table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
