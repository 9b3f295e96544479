"""Language-model scores by word classes (Brown): exchange clustering, class transitions, words within classes.

The probability of a word after another is that of its class after the class before, times that of the word in its class,
mixed with that of the word alone (``MIXED`` of the former). Counts are taken from all training documents.

Every word of the training documents has a class, and every word is exchanged in each round, rare ones too. A round moves the
``CLUSTERED`` most frequent words one after another on the driver, which holds their steps to each other and to the classes of all
other words (a bounded grid). Then all other words are judged at once where their neighbours lie: the occurrences are dealt by word
and stay there, a round sends out the classes and gets back the moves that raise the likelihood. Moves made together may lower it;
then the lesser half of them is undone. At first the other words are one class, which each leaves in the first round. The end of a
text is a token and a class of its own. Words that no training document has are a class, whose steps are those of words seen once.

Documents become numbers once. The most frequent words, at most ``TABLED`` of them and the end, are looked up in a broadcast table,
all rarer words of a block of documents through a shuffle to the words of the corpus. Of each word a byte for its class goes to
every task in a round, and its count as well when documents are scored. There may be ``MOST`` words.

Null texts are empty: their only token is the end. A null or repeated id is scored like any other: each input row gives one
row. Further columns are not read. Without training documents every word is unknown.
"""

from __future__ import annotations

from collections import Counter
from functools import cached_property
from itertools import chain, groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import fold_of, id_type, keep, map_texts
from leadloom.operators.checkpoints import let_go

CLUSTERED, CLASSES, TABLED, ROUNDS = 1_024, 48, 1 << 17, 6
#: classes of words not yet assigned, of words not in the training documents, of the end
OPEN, RARE, LAST = CLASSES, CLASSES + 1, CLASSES + 2
ALL, MIXED = CLASSES + 3, 0.8
END = b" "  # no word holds a space
HELD_OUT = 1
MOST = 1 << 30
#: occurrences and words of a part of the corpus dealt by word; neighbours that are summed up before they are sent
PART_TOKENS, PART_WORDS, SENT = 1 << 21, 1 << 15, 1 << 22


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: lower-cases A-Z alone, splits at the bytes 9 to 13 and 32


def unigrams(docs: DataFrame, text: str) -> DataFrame:
    """``word, n`` over all tokens; each task sums a bounded number of words before the shuffle."""
    def make():
        held: Counter = Counter()

        def flush():
            out = [list(held), list(held.values())]
            held.clear()
            return out

        def step(rows, texts):
            for t in texts:
                held.update(words_of(t))
            held[END] += len(texts)
            return flush() if len(held) > 500_000 else [[], []]

        step.finish = flush
        return step

    return map_texts(docs.select(text), text, make, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def threshold(counts: DataFrame, most: int) -> int:
    """The smallest power of two that at most ``most`` words reach."""
    powers = [1 << k for k in range(48)]
    row = counts.agg(*[F.count_if(F.col("n") >= p).alias(f"p{p}") for p in powers]).first()
    return next(p for p in powers if row[f"p{p}"] <= most)


def packed(numbers: np.ndarray, kind=np.uint32) -> bytes:
    """``numbers`` in a few bytes each; :func:`unpacked` reads them."""
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(len(numbers), np.dtype(kind).itemsize).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind=np.uint32) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(memoryview(data)[8:], decompressed_size=size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, size).T).view(kind).reshape(size)


class Words:
    """The words of the training documents, numbered: the end is 0, then by count as far as they are tabled, then all others."""

    def __init__(self, counts: DataFrame):
        self.n_words, self.n_tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if self.n_words >= MOST:
            raise ValueError(f"{self.n_words} words; there may be {MOST}")
        least = threshold(counts, TABLED)
        wanted = (F.col("n") >= least) | (F.col("word") == F.lit(bytearray(END)))
        frame = counts.where(wanted).toPandas()
        tabled = sorted(((bytes(w), int(n)) for w, n in zip(frame["word"], frame["n"])), key=lambda r: (r[0] != END, -r[1], r[0]))
        self.tabled = {w: i for i, (w, _) in enumerate(tabled)}
        placed = keep(counts.where(~wanted).select("word", "n", F.monotonically_increasing_id().alias("at")), "rare-words")
        part = F.shiftright("at", 33).cast("int")
        sizes = dict(placed.groupBy(part.alias("part")).count().collect())
        first = np.cumsum([len(tabled), *(sizes.get(k, 0) for k in range(max(sizes, default=0) + 1))]).tolist()
        self.rare = placed.select("word", "n", (F.element_at(F.lit(first), part + 1) + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number"))
        self.n = np.zeros(self.n_words, dtype=np.min_scalar_type(max([least, *(n for _, n in tabled)])))
        self.n[:len(tabled)] = [n for _, n in tabled]

        def pack(batches):
            for batch in batches:
                numbers, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
                yield pa.RecordBatch.from_arrays([pa.array([packed(x, np.uint64)], pa.binary()) for x in (numbers, n)], names=["numbers", "n"])

        for numbers, n in self.rare.select("number", "n").mapInArrow(pack, "numbers binary, n binary").collect():
            self.n[unpacked(numbers, np.uint64)] = unpacked(n, np.uint64)
        #: of a text, and of a word that is not among these
        self.end, self.unknown = 0 if self.n_words else 1, self.n_words


def coded(docs: DataFrame, text: str, words: Words, ids: tuple[str, ...] = ()) -> DataFrame:
    """``codes`` of blocks of documents: the numbers of their words, each document ended by the end, and lists of their ``ids``."""
    spark, unknown, end = docs.sparkSession, words.unknown, words.end
    shared = spark.sparkContext.broadcast(words.tabled)
    kinds = [f"`{c}` array<{id_type(docs, c)}>" for c in ids]

    def make():
        get = shared.value.get

        def step(rows, texts):
            split = [words_of(t) for t in texts]
            flat = list(chain.from_iterable([*w, END] for w in split))
            codes = np.array([get(w, -1) for w in flat], dtype=np.int64)
            codes[np.cumsum([len(w) + 1 for w in split]) - 1] = end
            own: dict = {}  # rarer words of the block are numbered from 2 behind the last word on, until the shuffle
            at = np.flatnonzero(codes < 0)
            codes[at] = [unknown + 2 + own.setdefault(flat[k], len(own)) for k in at.tolist()]
            lists = [pa.ListArray.from_arrays(np.array([0, len(split)], dtype=np.int32), rows.column(c)) for c in ids]
            return [*lists, pa.array([packed(codes)], pa.binary()), pa.array([list(own)], pa.list_(pa.binary()))]

        return step

    found = map_texts(docs.select(*ids, text), text, make, ", ".join([*kinds, "codes binary", "others array<binary>"]))
    blocks = keep(found.withColumn("block", F.monotonically_increasing_id()), "blocks")
    others = (blocks.select("block", F.posexplode("others").alias("k", "word")).join(words.rare.select("word", "number"), "word", "left")
              .select(F.col("block").alias("of_block"), "k", F.coalesce("number", F.lit(unknown)).alias("number")))

    def joined(block, other):
        numbers = np.zeros(other.num_rows, dtype=np.int64)
        numbers[other.column("k").to_numpy()] = other.column("number").to_numpy()
        out = []
        for data in block.column("codes").to_pylist():
            codes = unpacked(data).astype(np.int64)
            late = codes >= unknown + 2
            codes[late] = numbers[codes[late] - unknown - 2]
            out.append(packed(codes))
        return block.drop_columns(["block", "codes"]).append_column("codes", pa.array(out, pa.binary()))

    whole = keep(blocks.drop("others").groupBy("block").cogroup(others.groupBy("of_block"))
                 .applyInArrow(joined, ", ".join([*kinds, "codes binary"])), "coded")
    let_go(blocks)
    return whole


def dealt(blocks: DataFrame, size: int, n_words: int, n_tokens: int) -> tuple[RDD, int]:
    """What stands before and after the words numbered above ``size``, and steps among the others, dealt by word to parts.

    Elements are ``(part, (words and sides, neighbours, counts))``. They stay where the shuffle has put them, for all rounds.
    """
    parts = 1 + max(n_tokens // PART_TOKENS, n_words // PART_WORDS)
    each = n_words // parts + 1

    def deal(rows):
        held, n_held = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            word, beside = keys >> 32, keys & (2 * MOST - 1)
            bounds = np.searchsorted(word, np.arange(parts + 1) * each)
            entry = word % each * 2 + (keys >> 31 & 1)
            for k in np.flatnonzero(np.diff(bounds)).tolist():
                own = slice(bounds[k], bounds[k + 1])
                yield k, (packed(np.diff(entry[own], prepend=0)), packed(beside[own]), packed(n[own]))

        for row in rows:
            after = unpacked(row.codes).astype(np.int64)
            before = np.concatenate([[0], after[:-1]])
            left, right = after > size, (before > size) | (after <= size)
            for word, side, beside in ((after[left], 0, before[left]), (before[right], 1, after[right])):
                held.append((word % parts * each + word // parts) << 32 | side << 31 | beside)
                n_held += len(word)
            if n_held > SENT:
                yield from flush()
                held, n_held = [], 0
        if held:
            yield from flush()

    return blocks.select("codes").rdd.mapPartitions(deal).partitionBy(parts, int), parts


def entries(rows, parts: int):
    """Of each part its number; words, sides (0: before, 1: after), neighbours and counts of what was dealt to it."""
    for part, own in groupby(rows, key=lambda r: r[0]):
        columns = [[unpacked(x) for x in one] for _, one in own]
        entry = np.concatenate([np.cumsum(c[0], dtype=np.int64) for c in columns])
        yield part, entry >> 1, entry & 1, *(np.concatenate([c[k] for c in columns]).astype(np.int64) for k in (1, 2))


def among(found: RDD, size: int, parts: int) -> np.ndarray:
    """Steps among the end and the ``size`` most frequent words."""
    def run(rows):
        for part, word, side, beside, n in entries(rows, parts):
            number = word * parts + part
            own = (number <= size) & (side == 1)
            keys, at = np.unique(number[own] * (size + 1) + beside[own], return_inverse=True)
            yield packed(keys, np.uint64), packed(np.bincount(at, n[own], len(keys)), np.uint64)

    grid = np.zeros((size + 1) ** 2)
    for keys, n in found.mapPartitions(run).collect():
        grid[unpacked(keys, np.uint64)] = unpacked(n, np.uint64)
    return grid.reshape(size + 1, -1)


def steps_of(found: RDD, of: np.ndarray, common: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps between symbols: the end and the most frequent words, whose steps ``common`` holds, then the classes of all other words.

    Also the classes before (below ``ALL``) and after those other words that were seen once.
    """
    size = len(common) - 1
    n_left, n_right = (size + 1 + ALL) * ALL, ALL * (size + 1)
    shared = found.ctx.broadcast(of)

    def run(rows):
        classes = shared.value
        out = np.zeros(n_left + n_right + 2 * ALL, dtype=np.int64)
        for part, word, side, beside, n in entries(rows, parts):
            number = word * parts + part
            of_word, of_beside = classes[number].astype(np.int64), classes[beside].astype(np.int64)
            left = side == 0
            symbol = np.where(beside <= size, beside, size + 1 + of_beside)
            out[:n_left] += np.bincount((symbol * ALL + of_word)[left], n[left], n_left).astype(np.int64)
            right = (side == 1) & (number > size) & (beside <= size)
            out[n_left:n_left + n_right] += np.bincount((of_word * (size + 1) + beside)[right], n[right], n_right).astype(np.int64)
            once = (np.bincount(word[left], n[left], int(word.max(initial=0)) + 1) == 1)[word] & (number > size)
            out[n_left + n_right:] += np.bincount((side * ALL + of_beside)[once], minlength=2 * ALL)
        yield out

    total = found.mapPartitions(run).treeReduce(add)
    shared.destroy()
    grid = np.zeros((size + 1 + ALL,) * 2)
    grid[:size + 1, :size + 1] = common
    grid[:, size + 1:] = total[:n_left].reshape(-1, ALL)
    grid[size + 1:, :size + 1] = total[n_left:n_left + n_right].reshape(ALL, -1)
    return grid, total[n_left + n_right:]


def exchange(pairs: np.ndarray, counts: np.ndarray, own_class: np.ndarray, free: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each symbol: each of ``free`` moves, in turn, to the class (below ``classes``) that raises the likelihood most.

    ``pairs`` are rows ``(a, b, n)``; symbols that are not free keep their class.
    """
    of = own_class.copy()
    total = int(of.max()) + 1
    order = np.argsort(pairs[:, 0], kind="stable")
    right, right_at = pairs[order], np.searchsorted(pairs[order, 0], np.arange(len(of) + 1))
    order = np.argsort(pairs[:, 1], kind="stable")
    left, left_at = pairs[order], np.searchsorted(pairs[order, 1], np.arange(len(of) + 1))
    grid = np.zeros((total, total))
    np.add.at(grid, (of[pairs[:, 0]], of[pairs[:, 1]]), pairs[:, 2])

    for _ in range(rounds):
        moved = 0
        for w in free:
            after, before = right[right_at[w]:right_at[w + 1]], left[left_at[w]:left_at[w + 1]]
            out = np.bincount(of[after[:, 1]], after[:, 2], total)
            into = np.bincount(of[before[:, 0]], before[:, 2], total)
            same = float(after[after[:, 1] == w, 2].sum())
            home = of[w]
            out[home] -= same  # steps from the word to itself move with it
            into[home] -= same
            grid[home] -= out
            grid[:, home] -= into
            grid[home, home] -= same
            # sums of a class without the word, but with the steps between it and the word
            own_out, own_in = grid.sum(axis=1)[:classes] + into[:classes], grid.sum(axis=0)[:classes] + out[:classes]
            n_out, n_in = out.sum() + same, into.sum() + same
            rows, columns = grid[:classes], grid[:, :classes].T
            gain = (xlog(rows + out) - xlog(rows)).sum(axis=1) + (xlog(columns + into) - xlog(columns)).sum(axis=1)
            d = np.arange(classes)
            inner = grid[d, d]
            gain += (xlog(inner + out[d] + into[d] + same) - xlog(inner + out[d]) - xlog(inner + into[d]) + xlog(inner))
            gain -= xlog(own_out + n_out) - xlog(own_out) + xlog(own_in + n_in) - xlog(own_in)
            best = int(gain.argmax())
            if gain[best] <= gain[home] + 1e-9 * abs(gain[home]):
                best = int(home)
            moved += best != home
            of[w] = best
            grid[best] += out
            grid[:, best] += into
            grid[best, best] += same
        if not moved:
            break
    return of


def xlog(v):
    return np.where(v > 0, v * np.log(np.maximum(v, 1)), 0.0)


def likelihood(steps: np.ndarray) -> float:
    """Of the corpus given the classes, but for what is the same for all classes."""
    return float(xlog(steps).sum() - xlog(steps.sum(axis=0)).sum() - xlog(steps.sum(axis=1)).sum())


def gains(steps: np.ndarray, home: np.ndarray, to: np.ndarray, into: np.ndarray, out: np.ndarray, same: np.ndarray) -> np.ndarray:
    """What :func:`likelihood` gains by one word's move from ``home`` to another class, for each word.

    ``into`` and ``out`` count the classes before and after the word, ``same`` the steps from the word to itself.
    """
    at = np.arange(len(home))
    into, out = into.astype(np.float64), out.astype(np.float64)
    into[at, home] -= same
    out[at, home] -= same
    n_out, n_into = out.sum(axis=1) + same, into.sum(axis=1) + same
    corners = [(home, home, -out[at, home] - into[at, home] - same), (to, to, out[at, to] + into[at, to] + same),
               (home, to, into[at, home] - out[at, to]), (to, home, out[at, home] - into[at, to])]
    gain = sum(xlog(steps[a, b] + change) - xlog(steps[a, b]) for a, b, change in corners)
    for v in (into, out):
        v[at, home] = v[at, to] = 0
    for grid, v, total in ((steps, out, n_out), (steps.T, into, n_into)):
        gain += (xlog(grid[home] - v) - xlog(grid[home]) + xlog(grid[to] + v) - xlog(grid[to])).sum(axis=1)
        sums = grid.sum(axis=1)
        gain -= xlog(sums[home] - total) - xlog(sums[home]) + xlog(sums[to] + total) - xlog(sums[to])
    return gain


def smoothed(steps: np.ndarray) -> np.ndarray:
    """Probability of a class after a class: smoothed by how common the class is, and that by all classes alike."""
    common = (steps.sum(axis=0) + 0.5) / (steps.sum() + 0.5 * ALL)
    return (steps + 20 * common) / (steps.sum(axis=1, keepdims=True) + 20)


def moves(found: RDD, of: np.ndarray, steps: np.ndarray, size: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words above ``size`` that another class suits better, this class, and what the likelihood gains by each such move alone
    (numbers in the order of the gains).

    The class is the one that makes the classes around all occurrences likeliest.
    """
    likely = np.log(np.concatenate([smoothed(steps.T)[:CLASSES].T, smoothed(steps)[:CLASSES].T]))  # 2 * ALL x CLASSES
    shared = found.ctx.broadcast(of)

    def run(rows):
        classes = shared.value
        for part, word, side, beside, n in entries(rows, parts):
            number = np.arange(int(word.max()) + 1) * parts + part
            around = np.bincount((word * 2 + side) * ALL + classes[beside], n, 2 * ALL * len(number)).reshape(-1, 2 * ALL)
            itself = (side == 1) & (beside == number[word])
            same = np.bincount(word[itself], n[itself], len(number))
            for start in range(0, len(number), 4096):
                some = start + np.flatnonzero((number > size)[start:start + 4096] & around[start:start + 4096].any(axis=1))
                suits = around[some] @ likely
                most = suits.max(axis=1, keepdims=True, initial=-np.inf)
                to = (suits >= most - 1e-9 * np.abs(most)).argmax(axis=1)  # of equals the first
                home = classes[number[some]].astype(np.int64)
                some, to, home = (v[to != home] for v in (some, to, home))
                if not len(some):
                    continue
                gain = gains(steps, home, to, around[some, :ALL], around[some, ALL:], same[some])
                gain[home == OPEN] = 1  # these all move
                better = gain > 1e-6
                # the places of words in a part take few bytes, and so do gains of few digits
                brief = np.clip(gain[better], 0, 1e30).astype(np.float32).view(np.uint32) >> 16
                yield part, packed(np.diff(some[better], prepend=0)), packed(to[better], np.uint8), packed(brief, np.uint16)

    told = found.mapPartitions(run).collect()
    shared.destroy()
    word, to, gain = ([np.zeros(0, dtype=kind)] for kind in (np.int64, np.uint8, np.uint16))
    for part, places, classes, brief in told:
        word.append(np.cumsum(unpacked(places), dtype=np.int64) * parts + part)
        to.append(unpacked(classes, np.uint8))
        gain.append(unpacked(brief, np.uint16))
    return tuple(map(np.concatenate, (word, to, gain)))


def classed(found: RDD, words: Words, size: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each word, steps between the classes, and classes around the words seen once, after the rounds of exchange."""
    of = np.full(words.n_words, OPEN, dtype=np.uint8)
    of[0] = LAST
    of[1:size + 1] = np.arange(size) % CLASSES
    common = among(found, size, parts)
    word, value = np.zeros(0, dtype=np.int64), -np.inf
    for k in range(ROUNDS + 1):
        symbols = np.concatenate([of[:size + 1], np.arange(ALL)]).astype(np.int64)
        while True:
            grid, once = steps_of(found, of, common, parts)
            if k < 2 or not len(word) or likelihood(summed(grid, symbols)) >= value:
                break
            kept = np.count_nonzero(gain > gain[len(gain) // 2])  # by value, so that the order of equals does not count
            of[word[kept:]] = before[kept:]
            word, before, gain = word[:kept], before[:kept], gain[:kept]
        pairs = np.stack([*np.nonzero(grid), grid[np.nonzero(grid)]], axis=1).astype(np.int64)
        symbols = exchange(pairs, grid.sum(axis=0), symbols, np.arange(1, size + 1), CLASSES, 1 if k else ROUNDS)
        of[:size + 1] = symbols[:size + 1]
        steps = summed(grid, symbols)
        value = likelihood(steps)
        if k == ROUNDS:
            break
        word, to, gain = moves(found, of, steps, size, parts)
        if not len(word):
            break
        order = np.argsort(gain)[::-1]
        word, to, gain = word[order], to[order], gain[order]
        before = of[word]
        of[word] = to
    single = 1 + np.flatnonzero(words.n[1:size + 1] == 1)
    for side, beside in enumerate((grid[:, single].sum(axis=1), grid[single].sum(axis=0))):
        once = once + np.bincount(side * ALL + symbols, beside, 2 * ALL)
    return of, steps, once


def summed(grid: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Steps between classes from those between symbols."""
    member = np.eye(ALL)[of]
    return member.T @ grid @ member


class ClassModel:
    """What scoring looks up: class and count of each word by its number; steps between classes."""

    def __init__(self, words: Words, of: np.ndarray, steps: np.ndarray):
        self.n_tokens, self.n_words, self.end = words.n_tokens, words.n_words, words.end
        self.step = np.log10(smoothed(steps))
        # then a word that is not in the training documents, and an end that was never seen
        self.of = np.concatenate([of, [RARE, LAST]]).astype(np.uint8)
        self.n = np.concatenate([words.n, np.zeros(2, words.n.dtype)])
        self.sizes = np.bincount(of, words.n, ALL)
        self.base_total = float(np.log10(self.n_tokens + 0.5 * (self.n_words + 1)))
        #: of the class of unknown words, which count as one among the words seen once: log10(count + 0.5) less this
        self.rare_total = float(np.log10(1.5 * np.count_nonzero(words.n == 1) + 0.5))
        self.words = words

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("n_tokens", "n_words", "end", "step", "of", "n", "sizes", "base_total", "rare_total")}

    @cached_property
    def number(self) -> dict[bytes, int]:
        """Number of each word; gathers all words, to look into a model of few."""
        return self.words.tabled | {bytes(w): k for w, k in self.words.rare.select("word", "number").collect()}

    @cached_property
    def emit(self) -> np.ndarray:
        """log10 probability of each word in its class."""
        return np.log10(self.in_class(np.arange(self.n_words + 2)))

    def in_class(self, numbers: np.ndarray) -> np.ndarray:
        found = self.n[numbers] / np.maximum(self.sizes, 1)[self.of[numbers]]
        found[numbers == self.n_words] = 0.5 / 10 ** self.rare_total
        found[numbers > self.n_words] = 0.5 / 10 ** self.base_total
        return found

    def scores(self, numbers: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each word alone, and after the class before it."""
        alone = (self.n[numbers] + 0.5) / 10 ** self.base_total
        by_class = 10 ** self.step[before, self.of[numbers]] * self.in_class(numbers)
        return np.log10(alone), np.log10(MIXED * by_class + (1 - MIXED) * alone)


def fit(training: DataFrame, counts: DataFrame, text: str, ids: tuple[str, ...] = ()) -> tuple[ClassModel, DataFrame]:
    """The model, and the blocks of the documents it learns from. ``counts`` are those of all training tokens."""
    words = Words(counts)
    blocks = coded(training, text, words, ids)
    of, steps = np.zeros(0, dtype=np.uint8), np.zeros((ALL, ALL))
    if words.n_words:
        size = min(CLUSTERED, len(words.tabled) - 1)
        found, parts = dealt(blocks, size, words.n_words, words.n_tokens)
        # a task goes through some parts, one by one, so fewer grids are added up
        some = found.coalesce(max(training.sparkSession.sparkContext.defaultParallelism, parts // 4))
        of, steps, once = classed(some, words, size, parts)
        steps[:, RARE] += once[:ALL]
        steps[RARE] += once[ALL:]
    return ClassModel(words, of, steps), blocks


def class_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (sums of log10 probabilities).

    Learns from the documents whose fold is not ``HELD_OUT``.
    """
    spark = docs.sparkSession
    held_out = fold_of(doc_id) == HELD_OUT
    training = docs.where(~held_out)
    model, learnt = fit(training, keep(unigrams(training, text), "word-counts"), text, (doc_id,))
    blocks = learnt.unionByName(coded(docs.where(held_out), text, model.words, (doc_id,)))
    shared = spark.sparkContext.broadcast(model)
    schema = f"`{doc_id}` {id_type(docs, doc_id)}, n_tokens long, n_known long, base_score double, score double"

    def run(batches):
        m = shared.value
        for batch in batches:
            for ids, codes in zip(batch.column(0), batch.column(1)):
                numbers = unpacked(codes.as_py()).astype(np.int64)
                ends = np.flatnonzero(numbers == m.end)
                starts = np.concatenate([[0], ends[:-1] + 1])
                base, score = m.scores(numbers, m.of[np.concatenate([[m.end], numbers[:-1]])])
                sums = [np.add.reduceat(v, starts) for v in ((numbers < m.n_words).astype(np.int64), base, score)]
                yield pa.RecordBatch.from_arrays([ids.values, *map(pa.array, (ends - starts + 1, *sums))], names=names)

    names = [doc_id, "n_tokens", "n_known", "base_score", "score"]
    return blocks.select(doc_id, "codes").mapInArrow(run, schema).select(
        doc_id, (fold_of(doc_id) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
