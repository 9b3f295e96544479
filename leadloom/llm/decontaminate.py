"""Benchmark passages in documents, found by an FM-index of each training shard.

A shard is a run of documents of one task, up to ``SHARD_WORDS`` words (a longer document is a shard by itself). Its
words are numbers of the benchmark's vocabulary; a word outside it ends a stretch, and stretches shorter than the
shortest phrase cannot hold one. The index of the stretches is searched backwards for all phrases at once, occurrences
are located by sampled positions, and their words are merged to spans. A phrase is a window of ``window`` consecutive
words of an item, or the whole item if it has fewer words.

An item without text or words has no phrases. An item without id hits words like others, but is not named; repeated items
count once by id. A null or empty document has no
words. Every input row gives one row; further columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import id_type, keep, map_texts
from leadloom.llm.fm_index import FmIndex

BLOCK_BYTES = 8 << 20
#: lower-cases A-Z and turns every other byte below 128 that is no letter or digit into a space
TO_WORDS = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Phrases:
    """All different phrases of a block of items, as numbers of its vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for k in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[k:k + window]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for length in sorted({len(p) for p in found}):
            own = [p for p in found if len(p) == length]
            self.by_length[length] = np.array(own, dtype=np.int64), [found[p] for p in own]
        self.shortest = min(self.by_length, default=0)

    def occurrences(self, numbers: np.ndarray, breaks: np.ndarray):
        """``(place, length, items)`` of every occurrence in a shard; no phrase crosses a place in ``breaks``."""
        if not self.by_length:
            return
        known = numbers > 0
        edge = np.zeros(len(numbers) + 1, dtype=bool)
        edge[breaks] = True
        starts = np.flatnonzero(known & (edge[:-1] | np.concatenate([[True], ~known[:-1]])))
        ends = np.flatnonzero(known & (edge[1:] | np.concatenate([~known[1:], [True]]))) + 1
        long_enough = ends - starts >= self.shortest
        starts, ends = starts[long_enough], ends[long_enough]
        if not len(starts):
            return
        sizes = ends - starts + 1  # with a separator behind each stretch
        firsts = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(firsts - starts, sizes)
        text = np.zeros(len(place), dtype=np.int64)
        inside = np.ones(len(place), dtype=bool)
        inside[firsts + sizes - 1] = False
        text[inside] = numbers[place[inside]]
        index = FmIndex(text, len(self.vocabulary))
        for length, (patterns, items) in self.by_length.items():
            low, high = index.search(patterns)
            hits = np.flatnonzero(high > low)
            n = high[hits] - low[hits]
            rows = np.repeat(low[hits] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield place[index.locate(rows)], length, np.repeat(hits, n), items


def search(docs: DataFrame, block, window: int, doc_id: str, text: str, shard_words: int) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` by the items of one block."""
    def make():
        phrases = Phrases(block.value, window)

        def shard(words, lengths):
            ends = np.cumsum(lengths)
            covered = np.zeros(len(words) + 1, dtype=np.int32)
            named = [set() for _ in lengths]
            get = phrases.vocabulary.get
            numbers = np.array([get(w, 0) for w in words], dtype=np.int64)
            for place, length, which, items in phrases.occurrences(numbers, ends - lengths):
                np.add.at(covered, place, 1)
                np.add.at(covered, place + length, -1)
                doc = np.searchsorted(ends, place, side="right")
                for d, w in set(zip(doc.tolist(), which.tolist())):
                    named[d] |= items[w]
            hit = np.cumsum(covered[:-1]) > 0
            return [(hit[e - n:e], sorted(names - {None})) for e, n, names in zip(ends, lengths, named)]

        def step(rows, texts):
            split = [words_of(t) for t in texts]
            results, at = [], 0
            while at < len(split):
                stop, total = at + 1, len(split[at])
                while stop < len(split) and total + len(split[stop]) <= shard_words:
                    total += len(split[stop])
                    stop += 1
                results.extend(shard([w for words in split[at:stop] for w in words], np.array([len(w) for w in split[at:stop]])))
                at = stop
            spans = []
            for hit, _ in results:
                turns = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                spans.append([{"first": int(a), "n": int(b - a)} for a, b in zip(turns[::2], turns[1::2])])
            return [rows.column(0), [len(w) for w in split], [int(hit.sum()) for hit, _ in results], spans,
                    [names for _, names in results]]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    return map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, n_words long, n_hit long, "
                                         "spans array<struct<first:long,n:long>>, items array<string>")


def merged(spans):
    """Spans in order, those that meet or overlap as one."""
    def add(done, s):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["first"].alias("first"), F.greatest(last["n"], s["first"] + s["n"] - last["first"]).alias("n"))
        meets = (F.size(done) > 0) & (s["first"] <= last["first"] + last["n"])
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<first:long,n:long>>"), add)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", shard_words: int = 1 << 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items``: spans are ``(first word, words)``, items those with a phrase in the text.

    Of a benchmark of several blocks one at a time is broadcast, and searched in a pass of its own; what the passes found of
    a document is then put together.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("body")).where(F.col("body").isNotNull())
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_blocks = 1 + size // block_bytes
    number = F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks))

    def found_by(source: DataFrame, b: int, name: str) -> DataFrame:
        own = [(r["item"], r["body"].encode("utf-8")) for r in items.where(number == b).collect()]
        return search(source, spark.sparkContext.broadcast(own), window, name, text, shard_words)

    if n_blocks == 1:
        return found_by(docs, 0, doc_id)
    # equal rows have one name, and equal results
    name = F.struct(F.col(doc_id).alias("id"), F.xxhash64(doc_id, text).alias("h1"), F.xxhash64(F.lit(1), doc_id, text).alias("h2"))
    named = docs.select(name.alias("name"), F.col(text))
    passes = [keep(found_by(named, b, "name"), "found-phrases") for b in range(n_blocks)]
    hits = passes[0].where("n_hit > 0")
    for other in passes[1:]:
        hits = hits.union(other.where("n_hit > 0"))
    together = hits.groupBy("name").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    spans = merged(F.coalesce("f.spans", F.array().cast("array<struct<first:long,n:long>>")))
    joined = passes[0].select("name", "n_words").join(together.select("name", F.struct("spans", "items").alias("f")), "name", "left")
    return joined.select(F.col("name.id").alias(doc_id), "n_words", spans.alias("spans"),
                         F.array_sort(F.array_distinct(F.coalesce("f.items", F.array().cast("array<string>")))).alias("items")).select(
        doc_id, "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("n_hit"), "spans", "items")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
