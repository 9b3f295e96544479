"""Near-duplicate vectors over an inverted multi-index.

Codebooks of the two halves of unit vectors are fitted to a bounded sample (``sample`` vectors); their product is a grid of
cells, and every vector is listed in the cell of its nearest pair of code words. A vector visits cells in the order of the
summed squared distances of its halves (multi-sequence traversal) until the sum exceeds that of its own cell by more than a
slack. The slack is calibrated for ``target_recall``: vectors of exactly the wanted cosine to those of the sample, in random
directions, must lie in visited cells; nearer ones do so more often. In a cell the cosines decide, in double precision.

Equal vectors of a label are one class with its count, so copies never multiply. A pair of classes is looked at by the one of
the smaller number only, in the other's cell, hence counted once. A cell answers with counts and with the links of a spanning
forest, never with all its pairs. Cells with more vectors than ``CELL`` and a 4096th of all are split into blocks, which every
visitor of the cell sees; they are 4096 at most, and so are the classes whose rows are salted on the way back.

Only vectors of equal label and equal length are compared. Those that are null, empty, zero or hold null or non-finite
components, and those without label, link with nothing. Rows without id take part; if nothing in a component has an id, its
``component_id`` is null and its rows are kept. A repeated id names separate rows. Every row gives one row, an empty table
none; further columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import keep, ship
from leadloom.llm.components import components

SAMPLE, CELL, HOT = 20_000, 512, 4096
IN_CELL, MOST_CODES, ROUNDS, CHUNK = 256, 1024, 12, 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def padded(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


class Grid:
    """Code words of both halves, and how much farther than the nearest cell a vector looks."""

    def __init__(self, sample: np.ndarray, codes: int, cosine: float, target_recall: float):
        rng = np.random.default_rng(7)
        self.width, self.half = sample.shape[1], (sample.shape[1] + 1) // 2
        self.words = [self._fit(x, min(codes, len(sample)), rng) for x in (sample[:, :self.half], sample[:, self.half:])]
        self.codes = len(self.words[0])
        noise = rng.normal(size=sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        near = cosine * sample + np.sqrt(max(0.0, 1 - cosine * cosine)) * noise
        there = self.extra(near)
        cost = sum(e[np.arange(len(e)), t.argmin(axis=1)] for e, t in zip(self.extra(sample), there))
        self.slack = float(np.quantile(cost, target_recall)) if len(cost) else 0.0

    @staticmethod
    def _fit(x: np.ndarray, codes: int, rng) -> np.ndarray:
        words = x[rng.choice(len(x), codes, replace=False)].copy()
        for _ in range(ROUNDS):
            nearest = ((words * words).sum(axis=1) - 2 * x @ words.T).argmin(axis=1)
            sums, sizes = np.zeros_like(words), np.bincount(nearest, minlength=codes)
            np.add.at(sums, nearest, x)
            words[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
        return words

    def extra(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For either half: by how much each code word's squared distance exceeds the least one."""
        out = []
        for words, x in zip(self.words, (vectors[:, :self.half], vectors[:, self.half:])):
            d = (words * words).sum(axis=1) - 2 * x @ words.T
            out.append(d - d.min(axis=1, keepdims=True))
        return out

    def visited(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells by rising sum of one value of each sequence, until the slack: the nearest cell comes first."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        x, y = first[a].tolist(), second[b].tolist()
        cells, queue = [], [(0.0, 0, 0)]
        while queue:
            cost, i, j = heapq.heappop(queue)
            if cost > self.slack:
                break
            cells.append(int(a[i]) * self.codes + int(b[j]))
            if j + 1 < len(y):
                heapq.heappush(queue, (x[i] + y[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(x):
                heapq.heappush(queue, (x[i + 1] + y[0], i + 1, 0))
        return cells


def usable(label: str, vec: str) -> Column:
    x = F.col(vec).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def runs(batch: pa.RecordBatch, names: list[str]) -> list[int]:
    """Where a new value of the columns begins, and the end."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for name in names:
        column = batch.column(name)
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return [*np.flatnonzero(new).tolist(), batch.num_rows]


class Cell:
    """The members of a block of a cell, the counts of their links, and which of them are known to be connected."""

    def __init__(self):
        self.parts, self.vectors = [], None

    def add(self, nodes, cids, counts, vectors):
        self.parts.append((nodes, cids, counts, vectors))

    def close(self):
        self.nodes = pa.concat_arrays([p[0] for p in self.parts])
        self.cids, self.counts, self.vectors = (np.concatenate([p[k] for p in self.parts]) for k in (1, 2, 3))
        self.found, self.root = np.zeros(len(self.cids), dtype=np.int64), np.arange(len(self.cids))

    def visit(self, cosine: float, nodes, cids, counts, vectors) -> list[tuple]:
        """Compare visitors; their counts and links as ``(nodes, others or None, counts)``."""
        if not self.parts:
            return []
        if self.vectors is None:
            self.close()
        linked = (vectors @ self.vectors.T >= cosine) & (self.cids > cids[:, None])
        self.found += counts @ linked
        own, member = np.nonzero(linked)
        if not len(own):
            return []
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        who = own[starts]
        roots = self.root[member]
        least, most = np.minimum.reduceat(roots, starts), np.maximum.reduceat(roots, starts)
        ends = np.append(starts[1:], len(own))
        a, b = [], []
        for s, e in zip(starts[least < most], ends[least < most]):  # a visitor that connects members
            first, *others = np.unique(self.root[member[s:e]])
            if others:
                a.extend(others)
                b.extend([first] * len(others))
                self.root[np.isin(self.root, others)] = first
        out = [(nodes.take(pa.array(who)), self.nodes.take(pa.array(self.root[member[starts]])), linked[who] @ self.counts)]
        if a:
            out.append((self.nodes.take(pa.array(a)), self.nodes.take(pa.array(b)), np.zeros(len(a), dtype=np.int64)))
        return out

    def counted(self) -> list[tuple]:
        if self.vectors is None or not self.found.any():
            return []
        with_links = np.flatnonzero(self.found)
        return [(self.nodes.take(pa.array(with_links)), None, self.found[with_links])]


def compare(cosine: float, of_cell: list[str], node_type: pa.DataType):
    """Step over rows sorted by cell and role: members (role 0) first, then visitors. Gives ``node, other, found``."""
    def run(batches):
        cell, last = Cell(), None

        def rows_of(found):
            for nodes, others, counts in found:
                others = pa.nulls(len(nodes), node_type) if others is None else others
                yield pa.RecordBatch.from_arrays([nodes, others, pa.array(counts, pa.int64())], names=["node", "other", "found"])

        for batch in batches:
            if not batch.num_rows:
                continue
            vec = batch.column("vec")
            flat, ends = vec.flatten().to_numpy(), vec.offsets.to_numpy() - vec.offsets[0].as_py()
            cids, counts = batch.column("cid").to_numpy(), batch.column("n").to_numpy()
            cuts = runs(batch, [*of_cell, "role"])
            for s, e in zip(cuts, cuts[1:]):
                key = [batch.column(c)[s].as_py() for c in of_cell]
                if key != last:
                    yield from rows_of(cell.counted())
                    cell, last = Cell(), key
                role = batch.column("role")[s].as_py()
                if role and not cell.parts:
                    continue
                for k in range(s, e, CHUNK):
                    stop = min(k + CHUNK, e)
                    part = (batch.column("node").slice(k, stop - k), cids[k:stop], counts[k:stop],
                            unit(flat[ends[k]:ends[stop]].reshape(stop - k, -1)))
                    if role:
                        yield from rows_of(cell.visit(cosine, *part))
                    else:
                        cell.add(*part)
        yield from rows_of(cell.counted())

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.93, target_recall: float = 0.99, vec_id: str = "vec_id",
                 embedding: str = "embedding", label: str = "label", sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row."""
    spark = vectors.sparkSession
    ship(spark)
    kind = "float" if vectors.schema[embedding].dataType.elementType.simpleString() == "float" else "double"
    id_kind = vectors.schema[vec_id].dataType.simpleString()
    rows = (vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("vec"))
            .withColumn("ok", usable("label", "vec")).withColumn("vec", F.col("vec").cast(f"array<{kind}>"))
            .withColumns({"k1": F.xxhash64("label", "vec"), "k2": F.xxhash64(F.lit(1), "vec", "label")}))  # 128 bits name a class
    classes = rows.where("ok").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"),
                                                       F.first("vec").alias("vec"))
    classes = keep(classes.withColumn("cid", F.monotonically_increasing_id()).select(
        "k1", "k2", "n", "label", F.size("vec").alias("dim"), "vec", "cid",
        F.struct(F.col("id").isNull().alias("unknown"), "id", "cid").alias("node")), "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("c"), F.sum("n").alias("n")).agg(
        F.sum("c"), F.sum(F.col("c") * F.col("c").cast("double")), F.max("dim"), F.sum("n")).first()
    plain = rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if not sizes[0]:
        return named(plain, vec_id)
    n_classes, squares, width, n_rows = sizes
    share = F.pmod("k1", F.lit(1 << 20)) < int(min(1.0, 1.2 * sample / n_classes) * (1 << 20)) + 1
    taken = classes.where(share).limit(sample).select("vec").toArrow()["vec"].to_pylist()
    codes = int(np.clip(np.ceil(np.sqrt(squares / n_classes / IN_CELL)), 4, MOST_CODES))
    grid = Grid(np.concatenate([padded(unit(np.array([v])), width) for v in taken]), codes, cosine, target_recall)
    shared = spark.sparkContext.broadcast(grid)

    def visits(batches):
        grid = shared.value
        for batch in batches:
            vec, out = batch.column("vec"), []
            flat, ends = vec.flatten().to_numpy(), vec.offsets.to_numpy() - vec.offsets[0].as_py()
            units = np.zeros((batch.num_rows, grid.width))
            cuts = runs(batch, ["dim"])
            for s, e in zip(cuts, cuts[1:]):
                units[s:e] = padded(unit(flat[ends[s]:ends[e]].reshape(e - s, -1)), grid.width)
            for first, second in zip(*grid.extra(units)):
                out.append(grid.visited(first, second))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(out, pa.list_(pa.int32()))], names=[*passed, "cells"])

    passed = ["label", "dim", "vec", "cid", "n", "node"]
    listed = classes.select(*passed)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listed.schema) + ", cells array<int>"
    listed = keep(listed.mapInArrow(visits, schema), "vector-cells")
    of_cell = ["label", "dim", "cell"]
    members = listed.withColumn("cell", F.element_at("cells", 1))
    hot = (members.groupBy(*of_cell).count().where(F.col("count") > max(CELL, n_classes // HOT))
           .select(*of_cell, F.ceil(F.col("count") / CELL).cast("int").alias("blocks")))  # HOT rows at most
    hot = F.broadcast(keep(hot, "hot-cells"))
    members = members.join(hot, of_cell, "left").withColumn("block", F.pmod(F.xxhash64("cid"), F.coalesce("blocks", F.lit(1))))
    visitors = (listed.select("*", F.explode("cells").alias("cell")).join(hot, of_cell, "left")
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)).cast("long") - 1))))
    of_block = [*of_cell, "block"]
    both = [d.select(*of_block, F.lit(role).alias("role"), "cid", "n", "node", "vec") for role, d in enumerate((members, visitors))]
    dealt = both[0].union(both[1]).repartition(*of_block).sortWithinPartitions(*of_block, "role")
    node = f"struct<unknown:boolean,id:{id_kind},cid:bigint>"
    from pyspark.sql.pandas.types import to_arrow_schema

    node_type = to_arrow_schema(classes.select("node").schema).field(0).type
    found = keep(dealt.mapInArrow(compare(cosine, of_block, node_type), f"node {node}, other {node}, found long"), "vector-links")
    joined = components(found.where("other IS NOT NULL"), "node", "other").withColumnRenamed("key", "node")
    sums = found.groupBy("node").agg(F.sum("found").alias("found"))
    result = (classes.select("k1", "k2", "n", "node").join(sums, "node", "left").join(joined, "node", "left")
              .select("k1", "k2", (F.col("n") - 1 + F.coalesce("found", F.lit(0))).cast("long").alias("n_links"),
                      F.coalesce("component", "node").getField("id").alias("component_id"), "n"))
    result = keep(result, "vector-results")
    salted = F.broadcast(result.where(F.col("n") > max(CELL, n_rows // HOT))  # HOT rows at most
                         .select("k1", "k2", F.ceil(F.col("n") / CELL).cast("int").alias("salts")))
    salts = F.least(F.coalesce("salts", F.lit(1)), F.lit(HOT)).cast("long")
    spread = result.drop("n").join(salted, ["k1", "k2"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    asked = (rows.where("ok").select("id", "k1", "k2").join(salted, ["k1", "k2"], "left")
             .withColumn("salt", F.pmod(F.xxhash64("id"), salts)))
    linked = asked.join(spread.drop("salts"), ["k1", "k2", "salt"]).select("id", "n_links", "component_id")
    others = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return named(linked.union(others), vec_id)


def named(rows: DataFrame, vec_id: str) -> DataFrame:
    return rows.select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
