"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full sets.

Texts with one set of shingles are one class. Each class has ``TREES`` labels of ``DEPTH`` minimum hashes. The classes
are sorted by label, once per tree; those that agree on the first hashes of one are a region: on as many as leave a pair of
just the wanted similarity in no region with a probability of a thousandth at most (four at 80 percent). A region of at most
``BLOCK`` classes is compared as a whole; in a denser one the order by the deeper hashes decides which neighbours are
compared, so blocks hold those with the longest common prefixes. Within a block a largest spanning forest by estimated
similarity gives the candidates: one less than classes at most, never all pairs. Candidates are confirmed on full sets and joined to components.

What blocks and forests left out follows: in each region that is not yet one component, the classes outside its largest
component are compared, in cells of two blocks, with all classes of the region in other components, and confirmed on full
sets there; a pair is compared in the first tree that it shares a region in. Nothing is capped: only classes already
joined are not compared again.

Null and empty texts have an empty set and are linked with nothing. Repeated rows are copies of each other. A row without
id is linked like others; the component's id is its smallest known id (null if there is none), and the row is kept only in
that case. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import id_type, keep, map_texts, ship
from leadloom.llm.components import components

TREES, DEPTH, BLOCK = 16, 8, 1024
_seeds = np.random.default_rng(20240607)
FACTORS = _seeds.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _seeds.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different shingles of each text."""
    split = [t.lower().split() for t in texts]  # of bytes: lower-cases A-Z alone
    sizes = np.array([len(w) for w in split])
    hash_ = xxhash.xxh3_64_intdigest
    words = np.fromiter((hash_(w) for ws in split for w in ws), np.uint64, int(sizes.sum()))
    sets, at = [], 0
    for n in sizes.tolist():
        own = words[at:at + n]
        at += n
        k = min(width, n)
        mixed = np.full(max(0, n - k + 1) if n else 0, k, dtype=np.uint64)
        for j in range(k):
            mixed = (mixed ^ own[j:j + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        sets.append(np.unique(mixed))
    return sets


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum hashes (32 bits) of each set; those of an empty set are 0."""
    out = np.zeros((len(sets), TREES * DEPTH), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        joined = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for k in range(TREES * DEPTH):
            out[full, k] = np.minimum.reduceat(joined * FACTORS[k] + SHIFTS[k], starts) >> np.uint64(32)
    return out


def shallow_for(percent: int) -> int:
    """How many first hashes make a region."""
    return max((d for d in range(1, DEPTH) if (1 - (percent / 100) ** d) ** TREES <= 0.001), default=1)


def least_estimate(percent: int) -> float:
    """Similarity estimated from all hashes below which a pair is no candidate: 3.5 deviations under the wanted one."""
    p = percent / 100
    return p - 3.5 * (p * (1 - p) / (TREES * DEPTH)) ** 0.5


def roots(labels: np.ndarray, shallow: int) -> np.ndarray:
    """32 bits for the region of each set in each tree."""
    mixed = np.zeros((len(labels), TREES), dtype=np.uint64)
    for k in range(shallow):
        mixed = (mixed ^ labels[:, k::DEPTH].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def set_key(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def signatures(docs: DataFrame, width: int, shallow: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, key, labels, sketch, roots``.

    Labels are the minimum hashes tree by tree, a sketch has a byte of each, ``roots`` a hash of each tree's first ones.
    """
    def make():
        def step(rows, texts):
            sets = shingle_sets(texts, width)
            labels = signature(sets)
            return [rows.column(0), [len(s) for s in sets], [set_key(s) for s in sets], [v.tobytes() for v in labels.astype(">u4")],
                    [v.tobytes() for v in (labels & 0xFF).astype(np.uint8)], [v.tobytes() for v in roots(labels, shallow)]]

        return step

    return map_texts(docs.select(F.col(doc_id), F.col(text)), text, make,
                     f"`{doc_id}` {id_type(docs, doc_id)}, n_shingles long, key binary, labels binary, sketch binary, roots binary")


def full_sets(docs: DataFrame, width: int, text: str) -> DataFrame:
    """``key, shingles`` of each text."""
    def make():
        def step(rows, texts):
            sets = shingle_sets(texts, width)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            return [[set_key(s) for s in sets], pa.ListArray.from_arrays(ends, flat)]

        return step

    return map_texts(docs.select(F.col(text)), text, make, "key binary, shingles array<long>")


def spanning_pairs(sketches: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a largest spanning forest by estimated similarity, none below ``least``."""
    n, width = sketches.shape
    best, of = np.full(n, -1.0), np.zeros(n, dtype=np.int64)
    open_, at, pairs = np.ones(n, dtype=bool), 0, []
    for _ in range(n - 1):
        open_[at] = False
        rest = np.flatnonzero(open_)
        alike = (sketches[rest] == sketches[at]).sum(axis=1) / width
        nearer = alike > best[rest]
        best[rest[nearer]], of[rest[nearer]] = alike[nearer], at
        at = int(rest[best[rest].argmax()])
        if best[at] >= least:
            pairs.append((int(of[at]), at))
    return pairs


def grouped(batches, columns):
    """Rows of consecutive equal first values, whatever batches they come in."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    for key, own in groupby(rows(), key=lambda r: r[0]):
        yield key, own


def block_pairs(members: DataFrame, least: float) -> DataFrame:
    """Candidates ``a, b`` between neighbours of the sorted labels."""
    def run(batches):
        a, b = [], []

        def compare(block):
            sketches = np.frombuffer(b"".join(r[2] for r in block), np.uint8).reshape(len(block), -1)
            for i, j in spanning_pairs(sketches, least):
                x, y = sorted((block[i][1], block[j][1]))
                a.append(x)
                b.append(y)

        for _, own in grouped(batches, ("node", "key", "sketch")):
            block = []
            for row in own:
                block.append(row)
                if len(block) == BLOCK:
                    compare(block)
                    block = block[-1:]  # the last one ties the blocks
            if len(block) > 1:
                compare(block)
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a.clear(), b.clear()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    ordered = members.repartitionByRange("node", "deeper", "key").sortWithinPartitions("node", "deeper", "key")
    return ordered.select("node", "key", "sketch").mapInArrow(run, "a binary, b binary").distinct()


def rest_links(members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components of one region, one for each class and component that have any."""
    ship(members.sparkSession)
    least = least_estimate(percent)
    held = keep(members.join(parts, "key", "left").withColumn("component", F.coalesce("component", "key")), "regions")
    regions = (held.groupBy("node", "component").count().groupBy("node")
               .agg(F.sum("count").alias("n"), F.max("count").alias("n_main"), F.max_by("component", F.struct("count", "component")).alias("main"))
               .where("n > n_main"))
    rows = held.join(keep(regions, "open-regions"), "node").join(sets, "key")
    blocks, outer = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int")
    spread = F.xxhash64("key")
    own = ["node", "key", "component", "sketch", "roots", "shingles"]
    inside = rows.select(*own, F.lit(False).alias("outside"), F.pmod(spread, blocks).cast("int").alias("j"),
                         F.explode(F.sequence(F.lit(0), outer - 1)).alias("i"))
    outside = rows.where(F.col("component") != F.col("main")).select(
        *own, F.lit(True).alias("outside"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"), F.pmod(spread, outer).cast("int").alias("i"))
    cells = inside.unionByName(outside).select(F.concat_ws(",", "node", "i", "j").alias("cell"), *own[1:], "outside")

    def linked(row, others, sizes, flat, starts, candidates):
        """The first candidate of each component that is similar enough."""
        done = set()
        mine = np.array(row[5], dtype=np.int64)
        for k in candidates.tolist():
            if others[k][2] in done:
                continue
            n = sizes[k]
            shared = np.isin(flat[starts[k]:starts[k] + n], mine, assume_unique=True).sum()
            if 100 * shared >= percent * (n + len(mine) - shared):
                done.add(others[k][2])
                yield sorted((row[1], others[k][1]))

    def run(batches):
        for cell, rows in grouped(batches, ("cell", "key", "component", "sketch", "roots", "shingles", "outside")):
            rows = list(rows)
            few, many = [r for r in rows if r[6]], [r for r in rows if not r[6]]
            if not few or not many:
                continue
            tree = int(cell.split(",")[0].rsplit("-", 1)[1])
            sketches = np.frombuffer(b"".join(r[3] for r in many), np.uint8).reshape(len(many), -1)
            roots = np.frombuffer(b"".join(r[4] for r in many), np.uint32).reshape(len(many), -1)[:, :tree]
            number: dict[bytes, int] = {}
            of = np.array([number.setdefault(r[2], len(number)) for r in many])
            sizes = np.array([len(r[5]) for r in many])
            starts = np.cumsum(sizes) - sizes
            flat = np.concatenate([np.array(r[5], dtype=np.int64) for r in many])
            pairs = []
            for row in few:
                alike = (sketches == np.frombuffer(row[3], np.uint8)).mean(axis=1)
                n = len(row[5])
                open_ = ((alike >= least) & (of != number.get(row[2], -1)) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
                         & ~(roots == np.frombuffer(row[4], np.uint32)[:tree]).any(axis=1))
                candidates = np.flatnonzero(open_)
                pairs.extend(linked(row, many, sizes, flat, starts, candidates[np.argsort(-alike[candidates], kind="stable")]))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return (cells.repartition("cell").sortWithinPartitions("cell")
            .select("cell", "key", "component", "sketch", "roots", "shingles", "outside").mapInArrow(run, "a binary, b binary").distinct())


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked`` by the full sets."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    n, m = F.size("x"), F.size("y")
    both = pairs.join(left, "a").join(right, "b").where(F.least(n, m) * 100 >= F.greatest(n, m) * percent)
    shared = F.size(F.array_intersect("x", "y"))
    return keep(pairs.join(both.where(shared * 100 >= (n + m - shared) * percent).select("a", "b", F.lit(True).alias("linked")), ["a", "b"], "left")
                .select("a", "b", F.coalesce("linked", F.lit(False)).alias("linked")), "tested")


def joined_components(links: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, component, component_id`` of the classes that have links, with the key and id of the component's first class.

    The smallest id goes along in the nodes, so no component is gathered to find it.
    """
    nodes = classes.select("key", F.struct(F.col("first").isNull().alias("unknown"), "first", "key").alias("node"))
    edges = (links.join(nodes.select(F.col("key").alias("a"), F.col("node").alias("u")), "a")
             .join(nodes.select(F.col("key").alias("b"), F.col("node").alias("v")), "b").select("u", "v"))
    return keep(components(edges, "u", "v").select(F.col("key.key").alias("key"), F.col("component.key").alias("component"),
                                                   F.col("component.first").alias("component_id")), "components")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row, linked at ``percent`` of the union."""
    ship(docs.sparkSession)
    shallow = shallow_for(percent)
    known = keep(signatures(docs, width, shallow, doc_id, text), "signatures")
    classes = keep(known.where("key IS NOT NULL").groupBy("key").agg(
        F.min(doc_id).alias("first"), F.first("labels").alias("labels"), F.first("sketch").alias("sketch"),
        F.first("roots").alias("roots")), "classes")
    size, cut = DEPTH * 4, shallow * 4
    rows = classes.select("key", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "key", F.expr(f"concat(hex(substring(labels, tree * {size} + 1, {cut})), '-', tree)").alias("node"),
        F.expr(f"substring(labels, tree * {size} + {cut + 1}, {size - cut})").alias("deeper"))
    shared = keep(rows.groupBy("node").count().where("count > 1").select("node"), "regions")
    members = keep(rows.join(shared, "node").join(classes.select("key", "sketch", "roots"), "key"), "members")
    alike = members.select("key").distinct().join(classes.select("key", "first"), "key")
    # a class is read from its first row; of classes whose rows all lack an id, from those
    named = docs.select(doc_id, text)
    texts = named.join(keep(alike.select(F.col("first").alias(doc_id)).distinct(), "alike"), doc_id, "left_semi").union(
        named.where(F.col(doc_id).isNull()))
    sets = keep(full_sets(texts, width, text).where("key IS NOT NULL").groupBy("key").agg(F.first("shingles").alias("shingles")), "sets")

    tested = confirm(block_pairs(members, least_estimate(percent)), sets, percent)
    linked = tested.where("linked").select("a", "b")
    parts = joined_components(linked, classes)
    rest = keep(rest_links(members, parts.select("key", "component"), sets, percent), "rest-links")
    if not rest.isEmpty():
        parts = joined_components(linked.union(rest), classes)
    ids = keep(classes.select("key", "first").join(parts.select("key", "component_id", F.lit(True).alias("linked")), "key", "left")
               .select("key", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id")), "class-ids")
    some = known.where("key IS NOT NULL").select(doc_id, "n_shingles", "key").join(ids, "key").select(doc_id, "n_shingles", "component_id")
    none = known.where("key IS NULL").select(doc_id, "n_shingles", F.col(doc_id).alias("component_id"))
    return some.union(none).withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id")))
