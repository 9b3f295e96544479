"""Alignment of two tokenizers over the bytes of each text, by ``pandas.merge_asof``.

Each token is a range of bytes. Within a batch of words the start of every token finds the token of the other side that covers
it; the pairs of both directions together are all overlaps. Overlapping tokens of equal ends are links, and their ends cut a
document into groups. How often an id pair is linked is counted over all documents: the counts of the most frequent
pairs (``FREQUENT`` at most, chosen by a histogram) are broadcast, those of all others are joined, and no pair among these is
held by many rows.

Both tokenizers begin a new token at a single space between two characters that are not white space, so each text is encoded
and aligned word by word: a bounded cache holds the alignment of each word, a document's is the sum of its words', and that of a
very long one is added up in parts. Texts that are null, empty, or that either side
does not give back byte by byte have no tokens: zeros and an empty digest. Every row is a document of its own, also of a
repeated or null id; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import id_type, keep, map_texts, of_stage

words_of = re.compile(r"(?<=\S) (?=\S)").split
BATCH_BYTES, BATCH_WORDS, PART_WORDS, RUN_WORDS = 1 << 20, 1 << 14, 1 << 15, 64
CACHED_WORDS, CACHED_LENGTH, FREQUENT = 400_000, 40, 1 << 17
STEPS = 8  # of the histogram, for each doubling of a count


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class Sides:
    """Both tokenizers: ids of a word behind a space, and the bytes of each id."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        symbols = byte_symbols()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(symbols[c] for c in entry)
        pieces = ((self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.vocab_size()))
        self.bytes_b = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
        self.size_a, self.size_b = np.array([*map(len, self.bytes_a)]), np.array([*map(len, self.bytes_b)])
        self.wide = np.int32 if len(self.bytes_a) * len(self.bytes_b) < 1 << 31 else np.int64  # holds a pair of ids
        # how each id is written, followed by what stands behind it inside and at the end of a group
        self.written_a = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"], dtype=object)
        self.written_b = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_b)) for end in ",;"], dtype=object)
        self.cache: dict[str, tuple | None] = {}

    def ids_a(self, words: list[str], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words behind a space and how many each has. Words are encoded in runs, cut where one has white space at an end."""
        edged = [k for k, w in enumerate(words) if w[0].isspace() or w[-1].isspace()]
        starts = sorted({*range(0, len(words), RUN_WORDS), *edged, *[k + 1 for k in edged if k + 1 < len(words)]})
        runs = [" " + " ".join(words[i:j]) for i, j in zip(starts, [*starts[1:], len(words)])]
        # encode_batch without offsets
        flat, _ = flattened([x.ids for x in self.a.encode_batch_fast(runs, add_special_tokens=False)])
        total, ends = np.cumsum(self.size_a[flat]), np.cumsum(sizes)
        last = np.searchsorted(total, ends)
        if len(total) and total[-1] == ends[-1] and (total[last] == ends).all():
            return flat, np.diff(last, prepend=-1)
        return flattened([x.ids for x in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)])

    def encoded(self, words: list[str]) -> list[tuple | None]:
        """Each word as ``aligned_words`` gives it; None if a side does not give its bytes back."""
        whole = [(" " + w).encode() for w in words]
        sizes, lost, found = [*map(len, whole)], set(), []
        for (flat, counts), of, size in ((self.ids_a(words, sizes), self.bytes_a, self.size_a),
                                         (flattened(self.b.encode(words, num_threads=1)), self.bytes_b, self.size_b)):
            ends, ids = np.concatenate([[0], np.cumsum(counts)]), flat.tolist()
            total = np.concatenate([[0], np.cumsum(size[flat])])
            if (np.diff(total[ends]) != sizes).any() or b"".join(map(of.__getitem__, ids)) != b"".join(whole):
                lost.update(k for k, own in enumerate(whole) if b"".join(map(of.__getitem__, ids[ends[k]:ends[k + 1]])) != own)
            found.append((flat, counts))
        if lost:
            left = np.ones(len(words), dtype=bool)
            left[list(lost)] = False
            found = [(flat[np.repeat(left, n)], n[left]) for flat, n in found]
        done = iter(aligned_words(self, *found))
        return [None if k in lost else next(done) for k in range(len(words))]

    def ids(self, texts: list[str]) -> list[list[tuple] | None]:
        """The words of each text as ``aligned_words`` gives them; None if it has no tokens."""
        split = [words_of(t) if t else [] for t in texts]
        every = set(chain.from_iterable(split))
        cache = self.cache
        fresh = [*every.difference(cache)]
        if len(cache) + len(fresh) > CACHED_WORDS:
            used = {w: cache[w] for w in every if w in cache}
            cache.clear()
            cache.update(used)
        for part in batches(fresh):
            cache.update(zip(part, self.encoded(part)))
        found = []
        for text, words in zip(texts, split):
            ids = [*map(cache.__getitem__, words)]
            if None in ids:  # a word's bytes are lost; the rule is about the whole text
                whole = self.encoded([text])[0]
                ids = whole and [whole]
            found.append(ids or None)
        for w in fresh:
            if len(w) > CACHED_LENGTH:
                del cache[w]
        return found


def batches(words: list[str]) -> Iterator[list[str]]:
    """``words`` in parts of at most ``BATCH_WORDS``, ended by the word that reaches ``BATCH_BYTES``."""
    part, held = [], 0
    for w in words:
        part.append(w)
        held += len(w.encode())
        if len(part) == BATCH_WORDS or held >= BATCH_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and how many each has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, counts.sum()), counts


def both_sides(byte_file: str, piece_file: str) -> Sides:
    """Loaded once for the tasks of a stage in a worker: those that follow find its cache of words."""
    return of_stage(("sides", byte_file, piece_file), lambda: Sides(byte_file, piece_file))


def aligned_words(sides: Sides, side_a: tuple, side_b: tuple) -> list[tuple]:
    """Words by the ids of all and how many each has: ``ids, ids, overlaps, groups as text, linked pairs`` of each, in bytes."""
    (a, n_a), (b, n_b) = side_a, side_b
    if not len(n_a):
        return []
    end_a, end_b = np.cumsum(sides.size_a[a]), np.cumsum(sides.size_b[b])
    word_a, word_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    left = pd.DataFrame({"start": end_a - sides.size_a[a], "a": np.arange(len(a))})
    right = pd.DataFrame({"start": end_b - sides.size_b[b], "b": np.arange(len(b))})
    # the token under the start of each of a; never one of another word, since both sides begin each word at the same byte
    over_a = pd.merge_asof(left, right, on="start")["b"].to_numpy()
    over_b = pd.merge_asof(right, left, on="start")["a"].to_numpy()
    again = left["start"].to_numpy()[over_b] == right["start"].to_numpy()  # equal starts are found from both sides
    overlaps = (n_a + np.bincount(word_b[~again], minlength=len(n_b))).tolist()
    partner = np.full(len(a), -1)
    same = end_a == end_b[over_a]
    partner[same] = over_a[same]
    same = end_b == end_a[over_b]
    partner[over_b[same]] = np.flatnonzero(same)
    tied_a = partner >= 0
    tied_b = np.zeros(len(b), dtype=bool)
    tied_b[partner[tied_a]] = True
    group_a, group_b = np.cumsum(tied_a) - tied_a, np.cumsum(tied_b) - tied_b
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    written = np.concatenate([sides.written_a[2 * a + tied_a], sides.written_b[2 * b + tied_b]])[order].tolist()
    linked = np.flatnonzero(tied_a)
    pairs = (a[linked].astype(np.int64) * len(sides.size_b) + b[partner[linked]]).astype(sides.wide)
    n_links = np.bincount(word_a[linked], minlength=len(n_a))

    def cut(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
        packed, ends = values.tobytes(), (values.itemsize * np.cumsum(counts)).tolist()
        return [packed[x:y] for x, y in zip([0, *ends], ends)]

    ends = np.cumsum(n_a + n_b).tolist()
    groups = [b"".join(written[x:y]) for x, y in zip([0, *ends], ends)]
    return [*zip(cut(a, n_a), cut(b, n_b), overlaps, groups, cut(pairs, n_links))]


def align(sides: Sides, parts: list[list[tuple]]) -> list[tuple]:
    """Parts of documents, each its aligned words: ``tokens, tokens, overlaps, links, groups as text, pairs, times`` of each."""
    sums, texts, packed = [], [], []
    for part in parts:
        a, b, overlaps, groups, pairs = zip(*part)
        texts.append(b"".join(groups))
        packed.append(b"".join(pairs))
        sums.append((sum(map(len, a)) // 4, sum(map(len, b)) // 4, sum(overlaps), len(packed[-1]) // np.dtype(sides.wide).itemsize))
    span = len(sides.size_a) * len(sides.size_b)
    owners = np.repeat(np.arange(len(parts)), [x[3] for x in sums])
    own, times = np.unique(owners * span + np.frombuffer(b"".join(packed), sides.wide), return_counts=True)
    cuts = np.searchsorted(own, np.arange(len(parts) + 1) * span).tolist()
    pairs = own % span
    return [(*x, text, pairs[i:j], times[i:j]) for x, text, i, j in zip(sums, texts, cuts, cuts[1:])]


class Aligned:
    """What is known of one document while its parts are aligned."""

    def __init__(self):
        self.sums, self.hash, self.before = np.zeros(4, dtype=np.int64), hashlib.sha256(), b""
        self.pairs, self.times = [], []

    def add(self, part: tuple) -> None:
        self.sums += part[:4]
        self.hash.update(self.before + part[4][:-1])
        self.before = b";"
        self.pairs.append(part[5])
        self.times.append(part[6])

    def row(self, pair_type) -> tuple:
        if not self.pairs:
            return 0, 0, 0, 0, "", [], []
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, number = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(times, number, np.concatenate(self.times))
        return (*self.sums.tolist(), self.hash.hexdigest(), pairs.astype(pair_type), times.astype(np.int32))


def alignments(docs: DataFrame, byte_file: str, piece_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, doc_id, n_a, n_b, n_overlaps, n_links, groups_sha256, pairs, times``; a pair is ``a id * size of b's ids + b id``."""
    def make():
        sides = both_sides(byte_file, piece_file)

        def step(rows, texts):
            done = [Aligned() for _ in texts]
            parts, owners, held = [], [], 0

            def flush():
                nonlocal parts, owners, held
                for owner, part in zip(owners, align(sides, parts) if parts else []):
                    owner.add(part)
                parts, owners, held = [], [], 0

            for owner, t, words in zip(done, texts, sides.ids([t.decode("utf-8", "surrogatepass") for t in texts])):
                for k in range(0, len(words or ()), PART_WORDS):
                    parts.append(words[k:k + PART_WORDS])
                    owners.append(owner)
                    held += len(t) * len(parts[-1]) // len(words)
                    if held >= BATCH_BYTES:
                        flush()
            flush()
            return [rows.column(0), rows.column(1), *map(list, zip(*[x.row(sides.wide) for x in done]))]

        return step

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id), F.col(text))
    kind = "int" if _sizes(byte_file, piece_file)[0] * _sizes(byte_file, piece_file)[1] < 1 << 31 else "long"
    return map_texts(source, text, make, f"row long, `{doc_id}` {id_type(docs, doc_id)}, n_a long, n_b long, n_overlaps long, "
                                         f"n_links long, groups_sha256 string, pairs array<{kind}>, times array<int>")


def _sizes(byte_file: str, piece_file: str) -> tuple[int, int]:
    """How many ids the two vocabularies have."""
    import sentencepiece

    with open(byte_file, encoding="utf-8") as file:
        size_a = max(json.load(file)["model"]["vocab"].values()) + 1
    return size_a, sentencepiece.SentencePieceProcessor(model_file=piece_file).vocab_size()


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links of each id pair in all documents; whether no pair of its second id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counted = keep(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    second = (F.col("pair") % size_b).alias("second")
    most = counted.groupBy(second).agg(F.max("n").alias("most"))  # a row for each id at most: bounded by the vocabulary
    return counted.withColumn("second", second).join(F.broadcast(most), "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pairs of the highest counts, ``most`` at most: whole steps of a histogram of the counts."""
    level = F.floor(F.log2("n") * STEPS)
    sizes = dict(counts.groupBy(level.alias("level")).count().collect())  # a few hundred rows: counts are 64-bit numbers
    least, held = math.inf, 0
    for lv in sorted(sizes, reverse=True):
        held += sizes[lv]
        if held > most:
            break
        least = lv
    return counts.where(level >= (least if least < math.inf else 1 << 20))


def alignment_scores(docs: DataFrame, byte_file: str, piece_file: str, doc_id: str = "doc_id", text: str = "text",
                     most: int = FREQUENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps`` of each document."""
    spark = docs.sparkSession
    aligned = keep(alignments(docs, byte_file, piece_file, doc_id, text), "aligned")
    counts = keep(pair_counts(aligned, _sizes(byte_file, piece_file)[1]), "pair-best")
    top = frequent(counts, most).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    shared = spark.sparkContext.broadcast([top[c].to_numpy()[order] for c in ("pair", "n", "best")])
    whole = aligned.schema["pairs"].dataType.elementType.simpleString()

    def split(batches):
        pair, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            own, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
            known = pair[at] == own if len(pair) else np.zeros(len(own), dtype=bool)
            sums = np.zeros((2, len(lists)), dtype=np.int64)
            np.add.at(sums[0], owner[known], n[at[known]] * times[known])
            np.add.at(sums[1], owner[known], best[at[known]] * times[known])
            rest = np.searchsorted(owner[~known], np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(rest, pa.array(own[~known])),
                 pa.ListArray.from_arrays(rest, pa.array(times[~known]))], names=["row", "count_sum", "n_best", "rare", "times"])

    looked = keep(aligned.select("row", "pairs", "times").mapInArrow(
        split, f"row long, count_sum long, n_best long, rare array<{whole}>, times array<int>"), "aligned-sums")
    rare = looked.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), "x.times")

    def total(column: str | Column) -> Column:
        return F.sum(column).cast("long")

    joined = rare.join(counts, "pair").select("row", (F.col("n") * F.col("times")).alias("count_sum"),
                                              F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"))
    sums = (joined.union(looked.select("row", "count_sum", "n_best")).groupBy("row")
            .agg(total("count_sum").alias("count_sum"), total("n_best").alias("n_best")))
    return aligned.drop("pairs", "times").join(sums, "row").select(
        doc_id, "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
