"""Plain versions of the operators' contracts over rows held in memory."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers

WORDS = re.compile("[^\x20\x09-\x0D]+").findall
BENCH_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def base_rules(text):
    words = WORDS(text or "")
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(triples), set()
    for i, t in enumerate(triples):
        if count[t] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS(line):
            dup += line in seen
            seen.add(line)
    n, r = len(words), len(covered)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": dup, "n_repeat_words": r, "base_failed": n < 50 or 100 * r > 50 * n}


def contamination(docs, items, window=13):
    phrases = {}
    for item, text in items:
        words = BENCH_WORDS((text or "").translate(UPPER))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[k:k + window]), set()).add(str(item))
    lengths = {len(p) for p in phrases}
    out = {}
    for doc, text in docs:
        words, hit, named = BENCH_WORDS((text or "").translate(UPPER)), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                own = phrases.get(tuple(words[k:k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    named |= own - {"None"}
        out[doc] = (len(words), len(hit), len(named), sha(",".join(sorted(named))), bool(hit) and 20 * len(hit) >= len(words))
    return out


def near_components(docs, percent=80):
    """``doc_id -> (set size, component)`` by comparing all documents that share a shingle."""
    sets = {}
    for doc, text in docs:
        words = WORDS((text or "").translate(UPPER))
        sets[doc] = {tuple(words[i:i + 2]) for i in range(len(words) - 1)} or ({tuple(words)} if words else set())
    by_shingle = {}
    for doc, own in sets.items():
        for s in own:
            by_shingle.setdefault(s, []).append(doc)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    for doc, own in sets.items():
        # at 0.8 of the union at most a fifth of the set is missing from the other: enough to look at its rarest shingles
        rare = sorted(own, key=lambda s: len(by_shingle[s]))[:len(own) * (100 - percent) // 100 + 1]
        for other in {o for s in rare for o in by_shingle[s] if o < doc}:
            both = len(own & sets[other])
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                a, b = sorted((root(doc), root(other)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeated_windows(docs, window=35):
    """``doc_id -> (words, removed words, sha of the kept ones)``."""
    split = [(d, WORDS(t or "")) for d, t in docs]
    count = Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = {}
    for doc, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if count[tuple(words[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        out[doc] = (len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    return out
