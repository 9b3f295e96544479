"""Removal of passages that occur elsewhere, by relative Lempel-Ziv parsing.

A window is ``window`` consecutive words; words under a window whose sequence starts anywhere else are removed, all copies
alike. Each window has an anchor: the group of ``GRAM`` words in it with the smallest hash, so equal windows have equal
anchors. Windows whose anchor occurs once are unique. The others are cut into regions (neighbouring windows with one
anchor) and sent to the reference block of their anchor; there a suffix array indexes all regions, and each is parsed
greedily into its longest factors that occur elsewhere in the block. A factor of at least a window is a duplicate span; the next factor
begins at the first window that crosses the end of the last, so none at a border is missed.

Texts with one sequence of words are one class: beyond one copy it goes as a whole. Regions that are equal are merged before they are
sent on. Anchors with more than ``DENSE`` different regions are not put into one block; their windows are counted by
hash instead, which splits any group and finds the same spans.

Null texts have no words; each input row gives one row, null and repeated ids too; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import id_type, keep, map_texts, ship
from leadloom.llm.fm_index import suffix_array
from leadloom.llm.near_dedup import grouped

GRAM, DENSE, BLOCK_WORDS = 8, 4096, 300_000
#: bytes of a word's hash that are sent and compared
WIDTH = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


def hashed(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hash of each word of each text."""
    split = [t.split() for t in texts]
    hash_ = xxhash.xxh3_64_intdigest
    flat = np.fromiter((hash_(w) for ws in split for w in ws), np.uint64, sum(map(len, split)))
    return np.split(flat, np.cumsum([len(w) for w in split])[:-1]) if split else []


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first window, last window, hash)`` of each run of windows that share an anchor's place."""
    n, gram = len(words) - window + 1, min(GRAM, window)
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        mixed = (mixed ^ words[k:k + len(mixed)]) * _ODD
        mixed ^= mixed >> np.uint64(31)
    place = sliding_window_view(mixed, window - gram + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.concatenate([first[1:], [n]]) - 1, mixed[place[first]].view(np.int64)


def described(docs: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, link, n_words, whole, anchors``: ``whole`` is the sha256 of the words, ``link`` a hash of id and text."""
    def make():
        def step(rows, texts):
            own = [anchors(w, window)[2] for w in hashed(texts)]
            split = [t.split() for t in texts]
            ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
            return [rows.column(0), rows.column(1), [len(w) for w in split], [hashlib.sha256(b" ".join(w)).hexdigest() for w in split],
                    pa.ListArray.from_arrays(ends, np.concatenate([*own, np.zeros(0, np.int64)]))]

        return step

    return map_texts(linked(docs, doc_id, text), text, make,
                     f"`{doc_id}` {id_type(docs, doc_id)}, link long, n_words long, whole string, anchors array<long>")


def linked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id), F.xxhash64(doc_id, text).alias("link"), F.col(text))


def regions(affected: DataFrame, window: int, text: str) -> DataFrame:
    """``whole, start, anchor, region, words``: windows from word ``start`` on whose anchor occurs more than once."""
    def make():
        def step(rows, texts):
            out = [[], [], [], [], []]
            for whole, hits, words in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), hashed(texts)):
                first, last, hash_ = anchors(words, window)
                raw = np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :WIDTH]).tobytes()
                for k in np.flatnonzero(np.isin(hash_, np.array(hits, dtype=np.int64))).tolist():
                    own = raw[first[k] * WIDTH:(last[k] + window) * WIDTH]
                    for column, value in zip(out, (whole, int(first[k]), int(hash_[k]), hashlib.blake2b(own, digest_size=16).digest(), own)):
                        column.append(value)
            return out

        return step

    return map_texts(affected.select("whole", "hits", text), text, make,
                     "whole string, start int, anchor long, region binary, words binary")


def longest_elsewhere(t: np.ndarray) -> np.ndarray:
    """For each place of ``t``, the length of the longest match that starts at another place; 0 at separators (below 0).

    Separators are all different.
    """
    sa = suffix_array(t)
    match = np.zeros(len(sa), dtype=np.int64)  # with the suffix before, in sorted order
    a, b, pair, k = sa[:-1], sa[1:], np.arange(1, len(sa)), 0
    while len(pair):
        inside = np.maximum(a, b) + k < len(t)
        a, b, pair = a[inside], b[inside], pair[inside]
        same = (t[a + k] == t[b + k]) & (t[a + k] >= 0)
        a, b, pair = a[same], b[same], pair[same]
        match[pair] += 1
        k += 1
    out = np.empty(len(sa), dtype=np.int64)
    out[sa] = np.maximum(match, np.append(match[1:], 0))
    return out


def factor_spans(longest: list[int], last: int, window: int) -> list[tuple[int, int]]:
    """Greedy parse: ``(start, words)`` of long factors, the next beginning at the first window that no factor holds."""
    spans, at = [], 0
    while at <= last:
        if longest[at] >= window:
            spans.append((at, longest[at]))
            at += longest[at] - window + 1
        else:
            at += 1
    return spans


def parsed(distinct: DataFrame, window: int) -> DataFrame:
    """``region, spans`` of regions with a duplicate span; equal anchors are in one task and block."""
    schema = "region binary, spans array<struct<first:int,n:int>>"

    def run(batches):
        def parse(block):
            raw = np.frombuffer(b"".join(w for _, w, _ in block), np.uint8).reshape(-1, WIDTH)
            padded = np.zeros((len(raw), 8), np.uint8)
            padded[:, :WIDTH] = raw
            sizes = np.array([len(w) // WIDTH for _, w, _ in block])
            starts = np.cumsum(sizes + 1) - (sizes + 1)
            t = np.full(int((sizes + 1).sum()), -1, dtype=np.int64)
            t[starts + sizes] = -1 - np.arange(len(block))
            t[np.arange(len(raw)) + np.repeat(np.arange(len(block)), sizes)] = padded.view(np.int64).ravel()
            longest = longest_elsewhere(t)
            names, found = [], []
            for (name, _, copies), s, n in zip(block, starts.tolist(), sizes.tolist()):
                spans = [(0, n)] if copies > 1 else factor_spans(longest[s:s + n].tolist(), n - window, window)
                if spans:
                    names.append(name)
                    found.append([{"first": a, "n": b} for a, b in spans])
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, kind)], names=["region", "spans"])

        kind = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))
        block, size = [], 0
        for _, own in grouped(batches, ("anchor", "region", "words", "copies")):
            group = [(r[1], r[2], r[3]) for r in own]
            if len(group) == 1 and group[0][2] == 1:
                continue
            block.extend(group)
            size += sum(len(w) for _, w, _ in group) // WIDTH
            if size >= BLOCK_WORDS:
                yield parse(block)
                block, size = [], 0
        if block:
            yield parse(block)

    return distinct.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "region", "words", "copies").mapInArrow(run, schema)


def counted(dense: DataFrame, window: int) -> DataFrame:
    """``region, spans`` of regions of dense anchors: their windows counted by hash, over any number of tasks."""
    def run(batches):
        for batch in batches:
            names, at, n, keys = [], [], [], []
            for name, words, copies in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for k in range(len(words) // WIDTH - window + 1):
                    names.append(name)
                    at.append(k)
                    n.append(copies)
                    keys.append(hashlib.blake2b(words[k * WIDTH:(k + window) * WIDTH], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(names, pa.binary()), pa.array(at, pa.int32()), pa.array(n, pa.int64())],
                                             names=["key", "region", "first", "copies"])

    windows = keep(dense.select("region", "words", "copies").mapInArrow(run, "key binary, region binary, first int, copies long"), "windows")
    twice = keep(windows.groupBy("key").agg(F.sum("copies").alias("n")).where("n > 1").select("key"), "repeated-windows")
    return windows.join(twice, "key").groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("first", F.lit(window).alias("n")))).alias("spans"))


def duplicate_spans(classes: DataFrame, docs: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """``whole, body, spans`` (first word, words) of each class that shares a passage with another, or with itself."""
    places = classes.select("whole", F.explode("anchors").alias("anchor"))
    repeated = keep(places.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    hits = keep(places.join(repeated, "anchor").groupBy("whole").agg(F.collect_set("anchor").alias("hits")), "hits")
    wanted = keep(hits.join(classes.select("whole", "link"), "whole"), "wanted")
    bodies = linked(docs, doc_id, text).select("link", F.col(text).alias("body")).join(wanted, "link")
    # rows repeated with their id have one link
    affected = keep(bodies.dropDuplicates(["link"]).select("whole", "hits", "body"), "affected")
    found = keep(regions(affected, window, "body"), "regions")
    distinct = keep(found.groupBy("anchor", "region").agg(F.count("*").alias("copies"), F.first("words").alias("words")), "distinct-regions")
    dense = keep(distinct.groupBy("anchor").count().where(F.col("count") > DENSE).select("anchor"), "dense-anchors")
    spans = parsed(distinct.join(dense, "anchor", "left_anti"), window).union(counted(distinct.join(dense, "anchor", "left_semi"), window))
    own = (found.select("whole", "start", "region").join(keep(spans, "spans"), "region")
           .groupBy("whole").agg(F.flatten(F.collect_list(F.transform(
               "spans", lambda s: F.struct((F.col("start") + s["first"]).alias("first"), s["n"].alias("n"))))).alias("spans")))
    return affected.select("whole", "body").join(own, "whole")


def substring_dedup(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, link, n_words, n_removed, kept_sha256, kept_text``.

    ``kept_text`` is the kept words joined by one space, null if no word goes (the text stays as it is). ``link`` is
    ``xxhash64(doc_id, text)`` of the input row.
    """
    ship(docs.sparkSession)
    known = keep(described(docs, window, doc_id, text), "described")
    classes = keep(known.groupBy("whole").agg(F.count("*").alias("copies"), F.min("link").alias("link"), F.first("anchors").alias("anchors")), "classes")
    shared = duplicate_spans(classes.where(F.size("anchors") > 0), docs, window, doc_id, text)

    def make():
        def step(rows, texts):
            removed, sha, kept = [], [], []
            for spans, t in zip(rows.column(1).to_pylist(), texts):
                words = t.split()
                turn = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans:
                    turn[s["first"]] += 1
                    turn[s["first"] + s["n"]] -= 1
                gone = np.cumsum(turn[:-1]) > 0
                left = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8"))
            return [rows.column(0), removed, sha, kept]

        return step

    cut = map_texts(shared.select("whole", "spans", "body"), "body", make, "whole string, removed long, sha string, kept string")
    cut = keep(cut.dropDuplicates(["whole"]), "cut")
    state = classes.select("whole", "copies").join(cut, "whole", "left")
    joined = known.drop("anchors").join(keep(state, "states"), "whole")
    all_ = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return joined.select(
        doc_id, "link", "n_words", F.when(all_, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
        F.when(all_, F.lit("")).when(F.col("removed") > 0, F.col("kept")).alias("kept_text"))
