"""Every operator against its plain version, on texts with the awkward cases, empty tables and clashing columns."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from leadloom.llm import bpe, class_model, decontaminate, fm_index, near_dedup, piece_codec, quality_model, quality_rules, rans
from leadloom.llm import substring_dedup, token_counts, token_files, toxic_spans
from tests.llm import brute

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
#: the text column is repeated under names that operators use inside
CLASH = ["key", "words", "hits", "score", "n", "place", "link", "component"]


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "the", "THE", "$x"]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (60, 90, 120, 200, 80, 70)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    near = prose[3].split()
    near[50] = "changed"
    return [*prose, prose[0], prose[0].replace(" ", "\n"), " ".join(near), prose[4] + " " + passage, passage + " " + prose[5], "a b c\n" * 60,
            "x " * 150, None, "", " ", "\n\n", "one", "two words", "ab  cd   ▁e\x00\x1cf g <s> 🙂", "long" * 5000,
            " ".join(rng.choice(vocabulary) for _ in range(20_000))]


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(texts()))


def frame(spark, rows, clash=True):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *[F.col("text").alias(c) for c in CLASH]) if clash else docs


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3)


def collected(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_rules(spark, docs, rows):
    found = collected(quality_rules.quality_rules(docs))
    assert len(found) == len(rows)
    for d, t in rows:
        want = brute.base_rules(t)
        assert {k: found[d][k] for k in want if k != "base_failed"} == {k: v for k, v in want.items() if k != "base_failed"}
        assert 0 <= found[d]["posterior"] <= 1


def test_token_counts(docs, rows):
    library = brute.pieces()
    found = collected(token_counts.token_counts(docs, PIECES, 50))
    prefixes = collected(token_counts.prefix_counts(docs, PIECES).select("*", token_counts.within_budget(F.col("counts"), 50).alias("fits")))
    for d, t in rows:
        t = t or ""
        n, r = len(library.encode(t)), found[d]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 50)
        counts = prefixes[d]["counts"]
        assert len(counts) == len(t)
        for k in random.Random(d).sample(range(len(t)), min(len(t), 20)):
            assert counts[k] == len(library.encode(t[:k + 1]))
        assert prefixes[d]["fits"] == r["fits_chars"]


def test_long_runs():
    """Texts that once took quadratic time: long runs of spaces, and a long word behind several."""
    library, table = brute.pieces(), bpe.tables(PIECES)
    rng = random.Random(1)
    for text in (" " * 1_000_000, "  " + "abcdefghij" * 10_000, "x" + " " * 5_000 + "word  \n   y"):
        chunks = bpe.chunks_of(text)
        assert [i for c in chunks for i in table.chunk_ids(c)] == library.encode(text)
        assert sum(map(table.total, chunks)) == len(library.encode(text))
        for chunk in chunks:
            counts = table.counts(chunk)
            for k in (1, len(chunk), *(rng.randrange(1, len(chunk) + 1) for _ in range(3))):
                assert counts[k - 1] == len(table.chunk_ids(chunk[:k]))


def test_decoding_chunk_by_chunk():
    library, table = brute.pieces(), bpe.tables(PIECES)
    rng = random.Random(3)
    letters = ["a", "The", " ", "  ", "\n", "\t", "é", "▁", "　", "\x1c", "🙂", "1", "<s>", "\x00", "中"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        ids = library.encode(text)
        coded = [table.coded(c) for c in bpe.chunks_of(text)]
        assert sum(n for n, _, _ in coded) == len(ids) and b",".join(x for _, x, _ in coded).decode() == ",".join(map(str, ids))
        assert b"".join(x for _, _, x in coded)[1:].decode() == library.decode(ids)


def test_pieces(docs, rows):
    library = brute.pieces()
    found = collected(piece_codec.piece_digests(docs, PIECES))
    encoded = piece_codec.encode_pieces(docs, PIECES)
    ids, decoded = collected(encoded), collected(piece_codec.decode_pieces(encoded, PIECES))
    for d, t in rows:
        want = library.encode(t or "")
        assert ids[d]["ids"] == want and decoded[d]["text"] == (library.decode(want) if want else "")
        assert found[d]["ids_sha256"] == brute.sha(",".join(map(str, want))) and found[d]["n_tokens"] == len(want)
        assert found[d]["decoded_sha256"] == brute.sha(library.decode(want) if want else "")


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    found = collected(token_files.read_token_files(spark, token_files.write_token_files(docs, WORDS)))
    start = 0
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)
        assert (found[d]["start"], found[d]["n_tokens"]) == (start, len(ids))
        assert zlib.crc32(found[d]["ids"]) == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_rans_parts_and_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 100_001, 700_000):
        tokens = rng.zipf(1.3, n).clip(0, 999).astype(np.uint32)
        tables = rans.Tables(rans.frequencies(np.bincount(tokens, minlength=1000)))
        block = rans.encode(tokens, tables)
        assert (rans.decode(n, block, tables) == tokens).all()
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert (rans.decode(n, block, tables, a, b) == tokens[a:b]).all()
    row = dict(zip(["part", "block", "first_token", "n_tokens", "doc_ids", "doc_tokens", "lanes", "states", "words", "mark_words", "mark_states", "crc32"],
                   token_files.pack([tokens.tobytes()], np.dtype("<u4"), [1], 0, 0, 0, tables)))
    row["words"] = row["words"][:-1] + bytes([row["words"][-1] ^ 1])
    with pytest.raises(ValueError, match="checksum"):
        token_files.unpack(row)


def test_index():
    rng = np.random.default_rng(1)
    for n, symbols in ((1, 1), (50, 2), (400, 3), (400, 40)):
        t = rng.integers(0, symbols + 1, n)
        t[-1] = 0
        assert sorted(range(n), key=lambda i: t[i:].tolist()) == fm_index.suffix_array(t).tolist()
        index = fm_index.FmIndex(t, symbols)
        patterns = rng.integers(1, symbols + 1, (30, 3))
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(n - 2) if (t[i:i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, docs, rows, block_bytes):
    whole = dict(rows)
    items = [(1, " ".join(whole[3].split()[10:40])), (2, "two words"), (20, whole[9].upper()), (3, None), (None, "one"), (4, ""), (2, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = collected(decontaminate.decontaminate(docs, bench, 13, shard_words=500, block_bytes=block_bytes))
    want = brute.contamination(rows, items)
    for d, _ in rows:
        r = found[d]
        assert (r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(r["items"]))) == want[d][:4]
        assert sum(s["n"] for s in r["spans"]) == r["n_hit"]
        assert all(a["first"] + a["n"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, width):
    found = collected(near_dedup.near_duplicates(docs, width, 80))
    if width == 2:
        for d, (size, component) in brute.near_components(rows).items():
            assert (found[d]["n_shingles"], found[d]["component_id"], found[d]["kept"]) == (size, component, d == component)
    assert [d for d in (6, 7, 8) if found[d]["kept"]] == []


def test_near_duplicates_without_ids(spark):
    """A class whose rows all lack an id is read and linked like others; the component's id is the smallest known one."""
    rng = random.Random(8)
    text = [f"w{rng.randrange(500)}" for _ in range(120)]
    changed = text[:60] + ["other"] + text[61:]
    made = [(5, " ".join(text)), (None, " ".join(changed)), (None, " ".join(changed)), (9, " ".join(text)), (None, "alone here"), (None, None)]
    found = near_dedup.near_duplicates(frame(spark, made), 2, 80).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in found) == Counter(
        {(5, 5, True): 1, (None, 5, False): 2, (9, 5, False): 1, (None, None, True): 2})


def test_near_duplicates_at_other_thresholds(spark):
    rng = random.Random(12)
    made = []
    for d in range(40):
        own = [f"w{rng.randrange(3000)}" for _ in range(120)]
        made += [(4 * d + k, " ".join(own[:120 - cut] + [f"x{d}-{k}-{i}" for i in range(cut)])) for k, cut in enumerate((0, 18, 26, 29))]
    want = brute.near_components(made, 60)
    found = collected(near_dedup.near_duplicates(frame(spark, made, clash=False), 2, 60))
    assert {d: found[d]["component_id"] for d, _ in made} == {d: c for d, (_, c) in want.items()}
    assert len({c for _, c in want.values()}) < len(made) - 60


def test_near_duplicates_of_a_dense_region(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    made = []
    for d in range(60):
        own = list(base)
        for _ in range(rng.choice([1, 2, 4, 6])):
            own[rng.randrange(100)] = f"d{d}"
        made.append((d, " ".join(own)))
    found = collected(near_dedup.near_duplicates(frame(spark, made), 2, 80))
    assert {d: found[d]["component_id"] for d, _ in made} == {d: c for d, (_, c) in brute.near_components(made).items()}


@pytest.mark.parametrize("dense", [4096, 1])
def test_substrings(docs, rows, dense, monkeypatch):
    monkeypatch.setattr(substring_dedup, "DENSE", dense)
    found = collected(substring_dedup.substring_dedup(docs, 35))
    for d, want in brute.repeated_windows(rows).items():
        assert (found[d]["n_words"], found[d]["n_removed"], found[d]["kept_sha256"]) == want


def plain_score(model, count, words):
    """log10 probability by the tables of the model, word by word."""
    of, names = model.of, {w: i for w, i in model.number.items()}
    total, before = 0.0, class_model.LAST
    for w in words:
        k = names.get(w.encode(), len(names))
        in_class = count[w] / sum(count[v.decode()] for v, i in names.items() if of[i] == of[k]) if k < len(names) else (
            (count[w] + 0.5) / 10 ** model.rare_total)
        alone = (count[w] + 0.5) / 10 ** model.base_total
        total += math.log10(class_model.MIXED * 10 ** model.step[before, of[k]] * in_class + (1 - class_model.MIXED) * alone)
        before = of[k]
    return total


@pytest.mark.parametrize("tabled", [1 << 17, 4])
def test_class_scores(docs, rows, tabled, monkeypatch):
    monkeypatch.setattr(class_model, "TABLED", tabled)  # with 4, the end is rarer than the words of the table
    monkeypatch.setattr(class_model, "CLUSTERED", 40)
    found = collected(class_model.class_scores(docs))
    training = docs.where(class_model.fold_of("doc_id") != 1)
    model, _ = class_model.fit(training, class_model.unigrams(training, "text").cache(), "text")
    assert b" " in model.number and set(model.of[:-2]) <= {*range(class_model.CLASSES), class_model.LAST}  # no word is left without class
    for c in range(class_model.ALL):  # what may follow a class has a probability of one
        assert sum(10 ** (model.emit[i] + model.step[c, model.of[i]]) for i in range(len(model.number))) + 10 ** model.step[c, class_model.RARE] == (
            pytest.approx(1 - sum(10 ** model.step[c, k] for k in range(class_model.ALL) if k != class_model.RARE and k not in model.of[:-2])))
    words = {d: brute.WORDS((t or "").translate(brute.UPPER)) + [" "] for d, t in rows}
    count = Counter(w for d, ws in words.items() if brute.fold(d) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    for d, ws in words.items():
        r = found[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        if len(ws) < 300:
            assert r["score"] == pytest.approx(plain_score(model, count, ws))


def test_classes_beat_single_words(spark, monkeypatch):
    """Texts in three invented languages: words are in the classes of their language, also those that are not clustered."""
    monkeypatch.setattr(class_model, "CLUSTERED", 30)
    rng = random.Random(6)
    made = [(d, " ".join(f"{'abc'[d % 3]}{int(rng.paretovariate(0.6)) % 300}" for _ in range(150))) for d in range(240)]
    rows = class_model.class_scores(frame(spark, made, clash=False)).where("held_out").collect()
    assert len(rows) > 20 and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.25 * sum(r["n_tokens"] for r in rows)


def clustered(spark, monkeypatch, made, **limits):
    """Model of the training documents among ``made``, and the class of each word."""
    for name, value in limits.items():
        monkeypatch.setattr(class_model, name, value)
    training = frame(spark, made, clash=False).where(class_model.fold_of("doc_id") != 1)
    model, _ = class_model.fit(training, class_model.unigrams(training, "text").cache(), "text")
    return model, {w: int(model.of[i]) for w, i in model.number.items()}


def two_tongues():
    """Texts that change between two sets of words; each has a word of its own, and so most words are rare."""
    rng = random.Random(8)
    return [(d, " ".join(f"{'ab'[k % 2]}{int(rng.paretovariate(0.5)) % 400}" for k in range(60)) + f" b{d}once a{d}once") for d in range(160)]


def test_rare_words_have_classes_too(spark, monkeypatch):
    """Words beyond the broadcast table are exchanged like others: they join words that stand where they do."""
    made = two_tongues()
    model, of = clustered(spark, monkeypatch, made, TABLED=16, CLUSTERED=8)
    train = [t for d, t in made if brute.fold(d) != 1]
    assert set(of) == {w.encode() for t in train for w in t.split()} | {b" "} and len(model.words.tabled) <= 17
    assert sorted(model.number.values()) == list(range(len(of)))
    assert {c for w, c in of.items() if w != b" "} <= set(range(class_model.CLASSES))
    sides = {c: Counter(chr(w[0]) for w, k in of.items() if k == c and w.endswith(b"once")) for c in set(of.values())}
    assert sum(max(s.values()) for s in sides.values() if s) > 0.9 * sum(sum(s.values()) for s in sides.values())
    assert model.sizes.sum() == sum(len(t.split()) + 1 for t in train)  # no token is in a class for all rare words


@pytest.mark.parametrize("limits", [{}, {"PART_WORDS": 40, "PART_TOKENS": 500, "SENT": 100}])
def test_steps_of_classes_are_counted_from_all_words(spark, monkeypatch, limits):
    """The steps that the rounds keep are those of the corpus, however it is dealt; further rounds raise the likelihood."""
    made, kept, value = two_tongues(), [], {}
    own = class_model.ClassModel.__init__
    monkeypatch.setattr(class_model.ClassModel, "__init__", lambda self, words, of, steps: (kept.append(steps.copy()), own(self, words, of, steps))[1])
    for rounds in (1, 6):
        model, of = clustered(spark, monkeypatch, made, TABLED=32, CLUSTERED=8, ROUNDS=rounds, **limits)
        steps = np.zeros((class_model.ALL, class_model.ALL))
        for d, t in made:
            if brute.fold(d) != 1:
                words = [of[w.encode()] for w in [" ", *t.split(), " "]]
                np.add.at(steps, (words[:-1], words[1:]), 1)
        found = kept[-1].copy()
        found[:, class_model.RARE] = found[class_model.RARE] = 0
        assert (found == steps).all()
        once = Counter(w for d, t in made if brute.fold(d) != 1 for w in t.split())
        assert kept[-1][:, class_model.RARE].sum() == kept[-1][class_model.RARE].sum() == sum(n == 1 for n in once.values())
        value[rounds] = class_model.likelihood(steps)
    assert value[6] > value[1]


def test_gains_of_moves():
    """What a move gains is the likelihood after it less that before, also for words that follow themselves."""
    rng = np.random.default_rng(2)
    text, of = rng.integers(0, 12, 400), rng.integers(0, 4, 12)
    text[50:60] = 3

    def counted(of):
        steps = np.zeros((class_model.ALL, class_model.ALL))
        np.add.at(steps, (of[text[:-1]], of[text[1:]]), 1)
        return steps

    steps = counted(of)
    for w in range(12):
        into = np.bincount(of[text[:-1][text[1:] == w]], minlength=class_model.ALL)
        out = np.bincount(of[text[1:][text[:-1] == w]], minlength=class_model.ALL)
        same = ((text[1:] == w) & (text[:-1] == w)).sum()
        for to in set(range(6)) - {of[w]}:
            moved = of.copy()
            moved[w] = to
            gain = class_model.gains(steps, of[[w]], np.array([to]), into[None], out[None], np.array([same]))
            assert gain[0] == pytest.approx(class_model.likelihood(counted(moved)) - class_model.likelihood(steps))


def test_packed_numbers():
    for kind, numbers in ((np.uint32, [0, 1, 255, 256, 2**32 - 1]), (np.uint64, [2**63, 7]), (np.uint8, [1, 2]), (np.uint32, [])):
        assert class_model.unpacked(class_model.packed(np.array(numbers, dtype=np.uint64), kind), kind).tolist() == numbers


def test_exchange_finds_alternating_classes():
    pairs = np.array([(a, b, 10) for a in range(6) for b in range(6) if a % 2 != b % 2])
    of = class_model.exchange(pairs, np.ones(6), np.array([0, 0, 0, 1, 1, 1]), np.arange(6), 2)
    assert len(set(of[::2])) == len(set(of[1::2])) == 1 and of[0] != of[1]


def labelled(spark, n=400):
    rng = random.Random(9)
    made, labels = [], []
    for d in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(80)]
        good, toxic = rng.random() < 0.6, rng.random() < 0.4
        if toxic:
            words[rng.randrange(80)] = rng.choice(["scum", "Scum!", "vile"])
        made.append((d, " ".join(words) if good else " | ".join(words[:20] * 3 + words)))
        labels.append((d, int(good), int(toxic)))
    labels += [(None, 1, 1), (0, None, None), (10 ** 9, 1, 0)]
    return frame(spark, made), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_trained_scores(spark):
    docs, labels, truth = labelled(spark)
    quality = collected(quality_model.quality_scores(docs, labels, sample=200))
    toxic = collected(toxic_spans.toxic_scores(docs, labels))
    held = [t for t in truth[:400] if brute.fold(t[0]) == 0]
    assert held and all(quality[d]["held_out"] for d, _, _ in held)
    assert np.mean([(quality[d]["score"] >= 0.5) == q for d, q, _ in held]) > 0.95
    assert np.mean([(toxic[d]["score"] >= 0.5) == t for d, _, t in held]) > 0.95
    assert all(bool(toxic[d]["spans"]) == t for d, _, t in held)


def test_learning_from_long_texts(spark):
    """Labels on texts longer than the sample takes of each: chains of them are learned from."""
    rng = random.Random(21)
    made, labels = [], []
    for d in range(120):
        words = [f"w{rng.randrange(700)}" for _ in range(2500)]
        if d % 2:
            for k in range(0, 2500, 50):
                words[k + rng.randrange(50)] = rng.choice(["scum", "vile"])
        made.append((d, " ".join(words)))
        labels.append((d, d % 2))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = collected(toxic_spans.toxic_scores(frame(spark, made, clash=False), table, sample_bytes=4_000))
    assert np.mean([(found[d]["score"] >= 0.5) == y for d, y in labels if brute.fold(d) == 0]) > 0.95
    body = b" ".join(b"w%d" % k for k in range(5000))
    part = toxic_spans.part_of(body, 3000)
    assert 2000 < len(part) <= 3000 and part.split()[-1] not in body.split()[:2500] and toxic_spans.part_of(part, 3000) == part


def test_marginals_of_short_chains():
    rng = np.random.default_rng(2)
    e, step = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    real = np.array([[True] * 5 + [False]])
    weight = {}
    for tags in np.ndindex(*[2] * 5):
        weight[tags] = math.exp(sum(e[0, i] for i in range(5) if tags[i]) + sum(step[a, b] for a, b in zip(tags, tags[1:])))
    total = sum(weight.values())
    p, _, log_total = toxic_spans.marginals(e, real, step)
    assert log_total[0] == pytest.approx(math.log(total))
    for i in range(5):
        assert p[0, i] == pytest.approx(sum(w for t, w in weight.items() if t[i]) / total)


def operators(spark, path=None):
    none = "doc_id long, quality int, toxic int"
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], none)
    return {
        "rules": quality_rules.quality_rules, "counts": lambda d: token_counts.token_counts(d, PIECES),
        "files": lambda d: token_files.read_token_files(spark, token_files.write_token_files(d, WORDS)),
        "quality": lambda d: quality_model.quality_scores(d, labels), "classes": class_model.class_scores,
        "bench": lambda d: decontaminate.decontaminate(d, bench), "pieces": lambda d: piece_codec.piece_digests(d, PIECES),
        "near": near_dedup.near_duplicates, "toxic": lambda d: toxic_spans.toxic_scores(d, labels), "substrings": substring_dedup.substring_dedup}


@pytest.mark.parametrize("name", ["rules", "counts", "files", "quality", "classes", "bench", "pieces", "near", "toxic", "substrings"])
def test_empty_tables_and_null_ids(spark, name):
    run = operators(spark)[name]
    assert run(frame(spark, []).where("false")).collect() == []
    text = " ".join(f"w{i}" for i in range(50))
    made = [(None, None), (None, text), (7, text), (7, text), (7, None), (8, "")]
    found = run(frame(spark, made)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in made)


def test_word_ids_of_odd_texts():
    """The word table gives what the library gives: marks, capitals that compose otherwise, special strings, punctuation."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    parts = [*"abJjHhTt'.,;#<>|!09 \n", "̌", "̱", "́", "ͅ", "É", "é", "ß", "İ", "ı", "ǰ",
             " ", "\x1c", "K", "Σ", "中", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>"]
    chosen = np.random.default_rng(5).integers(0, len(parts), (3000, 24))
    texts = ["", "word, WORD. word", *("".join(parts[k] for k in row) for row in chosen)]
    words = token_files.WordIds(WORDS)
    expected = [np.array(e.ids, words.dtype).tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words.of_texts([t.encode() for t in texts]) == expected
    words.MOST = 3  # the table is emptied again and again
    assert words.of_texts([t.encode() for t in texts[:300]]) == expected[:300]
