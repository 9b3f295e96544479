"""Toxic spans by a linear-chain conditional random field with two tags.

Labels are of documents, so tokens get theirs first: words that separate toxic from other documents of a bounded sample
are chosen if they stand between many different neighbours there; in toxic documents these words are the toxic tokens. The field (features of a word, of its neighbours, and the step between tags) is fitted to the sample by
forward-backward expectations, and applied to all texts: a document's score is calibrated from its largest marginal, and
the tokens beyond a half are returned as offending offsets. A chain has ``CHAIN`` tokens, a longer text several; no token
is left out. Null texts are empty and have no tokens; every input row gives one row; further columns are not read. Without
labels, or with labels of one kind, all scores are the share of toxic labels.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import fold_of, id_type, map_texts

CHAIN, HASHED = 64, 1 << 16
#: defaults of ``sample`` and ``sample_bytes``
SAMPLE_DOCS, SAMPLE_BYTES = 2_000, 50_000
EDGES = re.compile(rb"^[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+$").sub


def bare(word: bytes) -> bytes:
    """Lower-case word without punctuation around it."""
    return EDGES(b"", word) or word


def places(word: bytes) -> list[int]:
    """Hashed features of a word: itself, its beginning and end."""
    w = bare(word)
    return [zlib.crc32(k + x) % HASHED for k, x in ((b"w", w), (b"p", w[:4]), (b"s", w[-4:]))]


def chains(values: np.ndarray, fill) -> np.ndarray:
    """``values`` in rows of ``CHAIN``."""
    rows = -(-len(values) // CHAIN)
    out = np.full(rows * CHAIN, fill, dtype=values.dtype)
    out[:len(values)] = values
    return out.reshape(rows, CHAIN)


def marginals(emission: np.ndarray, real: np.ndarray, step: np.ndarray):
    """Probability of tag 1 at each token; expected steps between tags; log of the sum over all taggings.

    ``emission`` is the score of tag 1 against tag 0, ``real`` marks tokens (padding is at the end of a row), ``step`` is
    2 x 2.
    """
    n, length = emission.shape
    moves = np.exp(step)
    own = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], axis=2)
    forward, backward = np.empty((n, length, 2)), np.ones((n, length, 2))
    total = np.zeros(n)
    for t in range(length):
        f = own[:, t] if t == 0 else own[:, t] * (forward[:, t - 1] @ moves)
        f = np.where(real[:, t, None], f, forward[:, t - 1] if t else 1.0)
        size = f.sum(axis=1)
        total += np.where(real[:, t], np.log(size), 0)
        forward[:, t] = f / size[:, None]
    for t in range(length - 2, -1, -1):
        b = (own[:, t + 1] * backward[:, t + 1]) @ moves.T
        b = np.where(real[:, t + 1, None], b, backward[:, t + 1])
        backward[:, t] = b / b.sum(axis=1, keepdims=True)
    both = forward * backward
    p = both[:, :, 1] / both.sum(axis=2)
    left, right = forward[:, :-1], own[:, 1:] * backward[:, 1:]
    joint = left[:, :, :, None] * moves * right[:, :, None, :]
    joint /= joint.sum(axis=(2, 3), keepdims=True)
    pairs = (joint * real[:, 1:, None, None]).sum(axis=(0, 1))
    return p, pairs, total


def lexicon(docs: list[tuple[list[bytes], int]]) -> set[bytes]:
    """Words that (nearly) only toxic documents have, between many different neighbours: copies of one text count once."""
    contexts, toxic, clean = {}, {}, {}
    n_toxic = sum(y for _, y in docs)
    for own, y in docs:
        words = [bare(w) for w in own]
        counts = toxic if y else clean
        for w in set(words):
            counts[w] = counts.get(w, 0) + 1
        if y:
            for before, w, after in zip([b"", *words], words, [*words[1:], b""]):
                contexts.setdefault(w, set()).add((before, after))
    least = max(3, n_toxic // 50)
    return {w for w, c in contexts.items() if len(c) >= least and least <= toxic[w] and 10 * clean.get(w, 0) <= toxic[w]}


class Field:
    """Weights of the features of a word at its own, the next and the previous place, a bias, and steps between tags."""

    def __init__(self, share: float):
        self.weights = np.zeros((3, HASHED))
        self.bias, self.step = 0.0, np.zeros((2, 2))
        self.slope, self.offset = 0.0, float(np.log(share / (1 - share)))

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """What each word adds at its own, the next and the previous place."""
        return self.weights[:, np.array([places(w) for w in words])].sum(axis=2).T

    def emission(self, scores: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Score of each token from those of its word and neighbours; ``starts`` are first tokens of documents."""
        e = scores[:, 0] + self.bias
        inside = np.ones(len(scores), dtype=bool)
        inside[starts[starts < len(scores)]] = False
        e[1:] += np.where(inside[1:], scores[:-1, 1], 0)
        e[:-1] += np.where(inside[1:], scores[1:, 2], 0)
        return e

    def tag(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Marginal of tag 1 of each token of several documents."""
        ends = np.cumsum(lengths)
        e = self.emission(scores, ends - lengths)
        rows = -(-lengths // CHAIN)
        firsts = np.cumsum(rows) - rows
        place = np.arange(len(e)) + np.repeat(firsts * CHAIN - (ends - lengths), lengths)
        grid, real = np.zeros(int(rows.sum()) * CHAIN), np.zeros(int(rows.sum()) * CHAIN, dtype=bool)
        grid[place], real[place] = e, True
        out = np.empty(len(grid))
        for k in range(0, len(grid), CHAIN * 4096):
            part = slice(k, k + CHAIN * 4096)
            p, _, _ = marginals(grid[part].reshape(-1, CHAIN), real[part].reshape(-1, CHAIN), self.step)
            out[part] = p.ravel()
        return out[place]

    def calibrated(self, largest: np.ndarray) -> np.ndarray:
        p = np.clip(largest, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.offset)))


def fit(docs: list[tuple[list[bytes], int]], rounds: int = 40, rate: float = 0.4, penalty: float = 1e-3, clean_chains: int = 3_000) -> Field:
    """Fit to documents ``(lower-case words, toxic)``: chains with toxic tokens, and a bounded number of others."""
    n, n_toxic = len(docs), sum(y for _, y in docs)
    field = Field((n_toxic + 1) / (n + 2))
    words = lexicon(docs) if 0 < n_toxic < n else set()
    if not words:
        return field
    keys: dict[bytes, int] = {}
    parts, real, tags, kept = [], [], [], 0
    for own, y in docs:
        number = np.array([keys.setdefault(w, len(keys)) for w in own], dtype=np.int64)
        truth = np.array([y and bare(w) in words for w in own], dtype=bool)
        for a, b in zip(chains(number, -1), chains(truth, False)):
            if b.any() or kept < clean_chains:
                kept += not b.any()
                parts.append(a)
                tags.append(b)
    number, tags = np.array(parts), np.array(tags, dtype=float)
    real = number >= 0
    table = np.array([places(w) for w in keys])
    near = [np.where(real, number, -1), np.full_like(number, -1), np.full_like(number, -1)]
    near[1][:, 1:] = number[:, :-1]
    near[2][:, :-1] = number[:, 1:]
    squares, steps, bias = np.full((3, HASHED), 1e-8), np.full((2, 2), 1e-8), 1e-8
    seen_pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen_pairs[a, b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & real[:, 1:]).sum()
    for _ in range(rounds):  # adaptive steps on the log-likelihood
        by_word = field.weights[:, table].sum(axis=2)
        e = np.full(number.shape, field.bias)
        for k in range(3):
            e += np.where(near[k] >= 0, by_word[k][near[k]], 0)
        p, pairs, _ = marginals(e, real, field.step)
        wrong = np.where(real, tags - p, 0)
        for k in range(3):
            ok = near[k] >= 0
            per_word = np.bincount(near[k][ok], wrong[ok], len(keys))
            g = np.bincount(table.ravel(), np.repeat(per_word, table.shape[1]), HASHED) - penalty * field.weights[k]
            squares[k] += g * g
            field.weights[k] += rate * g / np.sqrt(squares[k])
        g = seen_pairs - pairs
        steps += g * g
        field.step += rate * g / np.sqrt(steps)
        bias += wrong.sum() ** 2
        field.bias += rate * wrong.sum() / np.sqrt(bias)
    lengths = np.array([len(w) for w, _ in docs])
    scores = (field.weights[:, table].sum(axis=2).T)[np.array([keys[w] for own, _ in docs for w in own], dtype=np.int64)]
    largest = largest_of(field.tag(scores, lengths), lengths)
    calibrate(field, largest, np.array([y for _, y in docs], dtype=float))
    return field


def largest_of(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths))
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.maximum.reduceat(p, (np.cumsum(lengths) - lengths)[full])
    return out


def calibrate(field: Field, largest: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression of the labels on the log-odds of the largest marginal, by Newton steps."""
    p = np.clip(largest, 1e-6, 1 - 1e-6)
    x = np.stack([np.log(p / (1 - p)), np.ones(len(p))], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (y - q) - 0.01 * w)
    field.slope, field.offset = float(w[0]), float(w[1])


def part_of(text: bytes, most: int) -> bytes:
    """``text`` if it has at most ``most`` bytes, else some of its chains of ``CHAIN`` words, chosen by hash from all of it."""
    if len(text) <= most:
        return text
    words = text.split()
    pieces = [b" ".join(words[k:k + CHAIN]) for k in range(0, len(words), CHAIN)]
    taken, room = [], most
    for k in sorted(range(len(pieces)), key=lambda k: (zlib.crc32(pieces[k]), k)):
        if len(pieces[k]) <= room:
            taken.append(k)
            room -= len(pieces[k]) + 1
    return b" ".join(pieces[k] for k in sorted(taken))


def training_docs(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, sample: int,
                  sample_bytes: int) -> list[tuple[list[bytes], int]]:
    """Labelled texts to learn from. The ids are picked from the labels alone; then one pass over the texts finds theirs."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("y"))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64(doc_id), doc_id).limit(sample) for y in (1, 0)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # ``sample`` rows of each kind at most

    def make():
        return lambda rows, texts: [rows.column(0), rows.column(1), [part_of(t, sample_bytes) for t in texts]]

    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body")).join(chosen.select(F.col(doc_id).alias("id"), "y"), "id").select("id", "y", "body")
    parts = map_texts(named, "body", make, f"id {id_type(docs, doc_id)}, y {known.schema['y'].dataType.simpleString()}, part binary")
    rows = parts.groupBy("id").agg(F.max("y").alias("y"), F.min("part").alias("part")).collect()  # one text of an id
    return [(p.lower().split(), y) for y in (1, 0) for p in sorted({bytes(r["part"]) for r in rows if r["y"] == y})]


def toxic_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
                 sample: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``doc_id, held_out, score, spans``; spans are ``(first word, words)`` of tokens that are likelier toxic than not.

    The field learns from the documents of ``sample`` labels of each kind, picked by the hash of the id, and at most
    ``sample_bytes`` of each: of a longer text some of its chains, picked by hash. All texts are scored as a whole.
    """
    learn = labels.where(fold_of(doc_id) != 0)
    field = fit(training_docs(docs, learn, label, doc_id, text, sample, sample_bytes))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        model = shared.value
        number, table = {}, np.zeros((0, 3))

        def step(rows, texts):
            nonlocal table
            split = [t.lower().split() for t in texts]
            if len(number) > 500_000:
                number.clear()
            fresh = list({w for words in split for w in words}.difference(number))
            if fresh:
                table = np.concatenate([table[:len(number)], model.of_words(fresh)])
                number.update(zip(fresh, range(len(number), len(table))))
            lengths = np.array([len(w) for w in split])
            p = model.tag(table[np.array([number[w] for words in split for w in words], dtype=np.int64)], lengths)
            spans, at = [], 0
            for n in lengths:
                turns = np.flatnonzero(np.diff(np.concatenate([[0], (p[at:at + n] > 0.5).astype(np.int8), [0]])))
                spans.append([{"first": int(a), "n": int(b - a)} for a, b in zip(turns[::2], turns[1::2])])
                at += n
            return [rows.column(0), model.calibrated(largest_of(p, lengths)), spans]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    scored = map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, score double, spans array<struct<first:long,n:long>>")
    return scored.select(doc_id, (fold_of(doc_id) == 0).alias("held_out"), "score", "spans")
