"""Ranked lexical search, reversed: the items' terms are the index, the documents stream through it.

An inverted index over the terms of a block of items is broadcast: term -> items, with the term's weight. Each task counts
the terms of its documents, multiplies the counts' scores with the index and keeps the best ``k`` documents of each item in
a bounded heap; the heaps of all tasks are merged in two steps, so no item's candidates meet in one task at once.

Items are taken in blocks of at most ``block_bytes`` of text (an item that is larger alone makes a block): only a block's
index is broadcast, and each block takes one pass over the documents for its frequencies and one for its scores. ``N``, ``L``
and the frequencies are of all documents.

Null and empty texts have no terms: such a document is no document, such an item gets no rows. Equal scores are ranked by
ascending id, null ids last; every row is a document of its own, also when its id is repeated. Items of one id (also null)
are one query with the terms of all of them. Empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadloom.llm.common import id_type, keep, map_texts

#: one space for each byte outside terms; A-Z in lower case; bytes from 0x80 on belong to terms
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BLOCK_BYTES, BUCKETS, SALTS = 4 << 20, 4096, 64
SCORED = 1024  # documents that are scored together


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items in parts of bounded size: buckets of the id's hash, packed by their bytes. Only sizes reach the driver."""
    bucketed = items.select(F.col(item_id).alias("item"), F.col(text).alias("body"),
                            F.pmod(F.xxhash64(item_id), F.lit(BUCKETS)).alias("bucket"))
    sizes = sorted(bucketed.where("body <> ''").groupBy("bucket").agg(F.sum(F.octet_length("body"))).collect())
    first, held, last = None, 0, None
    for bucket, size in sizes:
        if first is not None and held + size > block_bytes:
            yield bucketed.where(F.col("bucket").between(first, last))
            first, held = None, 0
        first, held, last = bucket if first is None else first, held + size, bucket
    if first is not None:
        yield bucketed.where(F.col("bucket").between(first, last))


class Index:
    """Inverted index of a block of items: number of each term, and the numbers of the items that hold it."""

    def __init__(self, rows):
        held: dict = {}
        for item, body in rows:
            held.setdefault(item, set()).update(terms_of(body.encode("utf-8", "surrogatepass")))
        self.items = [item for item, terms in held.items() if terms]
        self.number = {t: k for k, t in enumerate(sorted({t for terms in held.values() for t in terms}))}
        self.postings = [[] for _ in self.number]
        for place, item in enumerate(self.items):
            for t in held[item]:
                self.postings[self.number[t]].append(place)
        self.postings = [np.array(p, dtype=np.int32) for p in self.postings]
        self.weights = np.zeros(len(self.number), dtype=np.int64)

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        self.weights = np.array([weight(n_docs, df.get(k, 0)) for k in range(len(self.number))], dtype=np.int64)


def frequencies(docs: DataFrame, shared, text: str) -> DataFrame:
    """``term, n``: documents that hold each term of the index; at -1 all documents with terms, at -2 all their terms."""
    def make():
        number, df, n_docs, n_terms = shared.value.number, Counter(), 0, 0

        def step(rows, texts):
            nonlocal n_docs, n_terms
            for t in texts:
                words = terms_of(t)
                if words:
                    n_docs, n_terms = n_docs + 1, n_terms + len(words)
                    df.update(number.keys() & set(words))
            return [[], []]

        def finish():
            return [[-1, -2, *(number[t] for t in df)], [n_docs, n_terms, *df.values()]]

        step.finish = finish
        return step

    counted = map_texts(docs.select(text), text, make, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def best_of_tasks(docs: DataFrame, shared, n_docs: int, n_terms: int, k: int, doc_id: str, text: str) -> DataFrame:
    """``place, doc, score``: the best ``k`` documents of each item among the documents of each task."""
    def make():
        index = shared.value
        number, postings, weights = index.number, index.postings, index.weights
        heaps: list[list] = [[] for _ in index.items]
        least = np.zeros(len(heaps), dtype=np.int64)  # a score must reach it, and be above 0

        def scored(found: list[tuple[int, int, int]]) -> None:
            """``found``: place of the document, term, ``w * tf part``, of at most ``SCORED`` documents."""
            docs_at, terms, value = (np.array(x, dtype=np.int64) for x in zip(*found))
            used, column = np.unique(terms, return_inverse=True)
            grid = np.zeros((docs_at[-1] + 1, len(used)), dtype=np.int64)
            grid[docs_at, column] = value
            total = np.zeros((len(grid), len(heaps)), dtype=np.int64)
            for c, t in enumerate(used):  # a term's items at once, in whole numbers
                own = np.flatnonzero(grid[:, c])
                total[np.ix_(own, postings[t])] += grid[own, c][:, None]
            floor = least
            if len(total) > k:
                floor = np.maximum(floor, np.partition(total, len(total) - k, axis=0)[len(total) - k])
            for d, place in zip(*np.nonzero((total >= floor) & (total > 0))):
                doc, heap = ids[base + d], heaps[place]
                entry = (int(total[d, place]), doc is not None, -doc if doc is not None else 0)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    least[place] = heap[0][0]

        ids, base = [], 0

        def step(rows, texts):
            nonlocal ids, base
            ids = rows.column(0).to_pylist()
            for base in range(0, len(texts), SCORED):
                found = []
                for place, t in enumerate(texts[base:base + SCORED]):
                    words = terms_of(t)
                    m = 8 * (100 - 90 + (90 * len(words) * n_docs) // n_terms) if words else 0
                    counts = Counter(words)
                    for word in number.keys() & counts.keys():
                        term, tf = number[word], counts[word]
                        found.append((place, term, int(weights[term]) * (1_000_000_000 * tf // (1000 * tf + m))))
                if found and heaps:
                    scored(found)
            return [[], [], []]

        def finish():
            out = [(place, -less if known else None, score) for place, heap in enumerate(heaps) for score, known, less in heap]
            return [list(x) for x in zip(*out)] if out else [[], [], []]

        step.finish = finish
        return step

    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text))
    return map_texts(source, text, make, "place int, doc long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest score above 0 for each item.

    Document ids are integers. A score sums, over the item's terms, the term's weight times its saturated count.
    """
    spark = docs.sparkSession
    schema = f"`{item_id}` {id_type(items, item_id)}, rank int, `{doc_id}` long, score long"
    parts = []
    for block in blocks(items, item_id, text, block_bytes):
        rows = block.where("body <> ''").select("item", "body").collect()  # of ``block_bytes`` at most
        index = Index(rows)
        if not index.items:
            continue
        shared = spark.sparkContext.broadcast(index)
        df = dict(frequencies(docs, shared, text).collect())  # a row for each term of the block at most
        n_docs, n_terms = df.pop(-1, 0), df.pop(-2, 0)
        if not n_docs:
            break
        index.weigh(n_docs, df)
        weighed = spark.sparkContext.broadcast(index)
        found = keep(best_of_tasks(docs, weighed, n_docs, n_terms, k, doc_id, text), "search-heaps")
        order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
        salted = Window.partitionBy("place", "salt").orderBy(*order)
        some = (found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
                .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k))
        best = some.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(index.items)), f"place int, `{item_id}` {id_type(items, item_id)}")
        parts.append(best.join(names, "place").select(item_id, "rank", F.col("doc").alias(doc_id), "score"))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def oracle(k: int = 10) -> str:
    """DuckDB SQL of query op13."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents WHERE text IS NOT NULL),
t AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
g AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
c AS (SELECT item_id, r, doc_id,
             sum(g.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN g USING (term), s GROUP BY item_id, r, doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank, doc_id, score
      FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {k}"""
