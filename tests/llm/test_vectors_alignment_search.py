"""Near vectors, token alignment and ranked search against plain versions, with the awkward rows of each."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from leadloom.llm import near_vectors, ranked_search, token_alignment
from tests.llm import brute

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    rng = np.random.default_rng(3)
    rows = []

    def add(v, label):
        rows.append((len(rows), None if v is None else [None if x is None else float(np.float32(x)) for x in v], label))

    for centre in rng.normal(size=(40, 16)):
        for _ in range(int(rng.integers(1, 6))):  # around the threshold, in two labels
            add(centre + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.3]), int(rng.integers(2)))
    for _ in range(700):  # one large group of near copies: its cell is split into blocks
        add(np.ones(16) + rng.normal(size=16) * 0.02, 1)
    for _ in range(30):
        add(np.arange(16), 0)  # equal ones, and one of another length below
    add(np.arange(3, 27), 0)
    add(np.arange(1, 17) * 1e30, 0)
    for odd in (None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15):
        add(odd, 0)
    add(np.arange(16), None)
    rows += [(3, rows[3][1], rows[3][2]), (4, rows[200][1], rows[200][2])]  # repeated ids
    return rows + [(None, rows[7][1], rows[7][2]), (None, rng.normal(size=16).tolist(), 0)]


def brute_vectors(rows, cosine):
    n = len(rows)
    parent, links, groups, least = list(range(n)), [0] * n, defaultdict(list), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append(i)
    for own in groups.values():
        m = np.array([rows[i][1] for i in own], dtype=np.float32).astype(float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        linked = m @ m.T >= cosine
        for a, i in enumerate(own):
            links[i] = int(linked[a].sum()) - 1
            for b in np.flatnonzero(linked[a]):
                parent[root(i)] = root(own[b])
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    return Counter((rows[i][0], links[i], least.get(root(i)), rows[i][0] == least.get(root(i))) for i in range(n))


@pytest.mark.parametrize("cosine", [0.93, 0.8])
def test_vectors(spark, cosine):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).select("*", *[F.lit("x").alias(c) for c in ("n", "node", "cid", "cell", "k1")]).repartition(3)
    found = Counter(tuple(r) for r in near_vectors.near_vectors(frame, cosine, target_recall=0.999).collect())
    assert found == brute_vectors(rows, cosine)


def test_vector_recall(spark):
    """Pairs of exactly the wanted cosine, the hardest ones: the least recall there is."""
    rng = np.random.default_rng(11)
    a = rng.normal(size=(3000, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = rng.normal(size=a.shape)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    b = 0.9301 * a + math.sqrt(1 - 0.9301 ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]))]
    found = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert found.where("n_links > 0").count() >= 0.97 * len(rows)


def test_no_vectors(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    rows = near_vectors.near_vectors(spark.createDataFrame([(1, None, 0), (None, [1.0], None)], VECTORS)).collect()
    assert {tuple(r) for r in rows} == {(1, 0, 1, True), (None, 0, None, True)}


def aligned_texts():
    rng = random.Random(2)
    letters = ["a", "b", "The", " ", "  ", "\n", "\t", "é", "▁", "　", "\x1c", "\x85", "\xa0", "🙂", "1", "23", ".", "'s", "<s>",
               "<|endoftext|>", "\x00", "中"]
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    return [None, "", " ", "hello world", "hello world", "x" * 3000, " ".join(f"word{rng.randrange(999)}" for _ in range(70_000)), *odd]


def brute_alignment(texts):
    sides = token_alignment.Sides(BYTES, PIECES)
    docs, count = [], Counter()
    for text in texts:
        a = sides.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sides.b.encode(text) if text else []
        joined = [b"".join(of[i] for i in ids) for ids, of in ((a, sides.bytes_a), (b, sides.bytes_b))]
        if not text or joined != [(" " + text).encode()] * 2:
            docs.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, sides.bytes_a), (b, sides.bytes_b)))
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        count.update(links)
        docs.append((len(a), len(b), ";".join(groups), links))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[3]), len(d[3]), sum(count[p] == most[p[1]] for p in d[3]), sum(count[p] for p in d[3]), brute.sha(d[2])) for d in docs]


@pytest.mark.parametrize("most", [0, 40, token_alignment.FREQUENT])
def test_alignment(spark, monkeypatch, most):
    texts = aligned_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        "*", *[F.lit("x").alias(c) for c in ("row", "pairs", "n", "best", "rare")]).repartition(3)
    found = {r[0]: tuple(r)[1:8] for r in token_alignment.alignment_scores(frame, BYTES, PIECES, most=most).collect()}
    want = brute_alignment(texts)
    assert len(found) == len(texts)
    assert [i for i, w in enumerate(want) if found[i] != w] == []


def test_overlaps():
    sides = token_alignment.Sides(BYTES, PIECES)
    text = "unbelievable internationalisation of 12345"
    words = sides.ids([text])[0]
    ranges = []
    for side, size in ((0, sides.size_a), (1, sides.size_b)):
        ids = np.concatenate([np.frombuffer(w[side], np.int32) for w in words])
        ends = np.cumsum(size[ids])
        ranges.append(list(zip(ends - size[ids], ends)))
    want = sum(a < d and c < b for a, b in ranges[0] for c, d in ranges[1])
    assert token_alignment.align(sides, [words])[0][2] == want


def test_words_aligned_once(monkeypatch):
    """A word's tokens are encoded and laid over each other once, not at every place where it stands."""
    laid, merge = [], token_alignment.pd.merge_asof
    monkeypatch.setattr(token_alignment.pd, "merge_asof", lambda left, right, **how: laid.append(len(left)) or merge(left, right, **how))
    once = "unbelievable internationalisation of 12345"
    sides = token_alignment.Sides(BYTES, PIECES)
    first, many = (token_alignment.align(sides, [sides.ids([t])[0]])[0] for t in (once, " ".join([once] * 50)))
    assert sum(laid) == first[0] + first[1]
    assert many[:4] == tuple(50 * x for x in first[:4]) and many[4] == 50 * first[4]
    assert many[5].tolist() == first[5].tolist() and many[6].tolist() == (50 * first[6]).tolist()


def test_long_words_in_batches(monkeypatch):
    monkeypatch.setattr(token_alignment, "BATCH_BYTES", 1000)
    words = ["中" * n for n in (400, 10, 20, 5, 900)] + ["a", "b"]
    assert [[len(w) for w in part] for part in token_alignment.batches(words)] == [[400], [10, 20, 5, 900], [1, 1]]
    assert list(token_alignment.batches([])) == []


def test_runs_of_words():
    """Words encoded in runs have the ids of each alone, also beside white space at their ends and words that lose bytes."""
    sides = token_alignment.Sides(BYTES, PIECES)
    words = [*{w for t in aligned_texts() if t for w in token_alignment.words_of(t)}]
    alone = {w: token_alignment.Sides.encoded(sides, [w])[0] for w in words}
    assert dict(zip(words, sides.encoded(words))) == alone
    assert {None} < {x and type(x) for x in alone.values()}
    assert [np.frombuffer(x[0], np.int32).tolist() for x in alone.values() if x] == [
        sides.a.encode(" " + w, add_special_tokens=False).ids for w, x in alone.items() if x]


def test_alignment_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.alignment_scores(empty, BYTES, PIECES).collect() == []
    nothing = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    rows = sorted((tuple(r)[:8] for r in token_alignment.alignment_scores(nothing, BYTES, PIECES).collect()), key=str)
    assert rows == [(1, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def brute_search(docs, items, k):
    def terms(text):
        return "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " " for c in text or "").split(" ")

    counts = [(d, Counter(w for w in terms(t) if w)) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df, queries, out = Counter(w for _, c in counts for w in c), defaultdict(set), []
    for item, text in items:
        queries[item] |= {w for w in terms(text) if w}
    for item, words in queries.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if w in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_search(spark, block_bytes):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "THE", "the", "a-b", "x_y", "日本　語"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(200)]
    docs += [(500 + i, docs[3][1]) for i in range(20)] + [(3, docs[5][1]), (None, docs[3][1]), (900, None), (901, ""), (902, "-- !"),
                                                         (903, "w1 " * 20_000), (904, "Éa")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(12))) for i in range(12)]
    items += [(50, docs[3][1]), (51, None), (52, ""), (53, "nowhere"), (54, "w1 w1 W1"), (54, "w2"), (None, "w5 THE")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select(
        "*", *[F.lit("x").alias(c) for c in ("item_id", "doc", "place", "score", "term")]).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("body", F.lit("x"))
    found = ranked_search.ranked_search(frame, asked, k=10, block_bytes=block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_search(docs, items, 10)


def test_search_without_rows(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.ranked_search(docs, items).collect() == []
    assert ranked_search.ranked_search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).collect() == []
