"""Token counts of whole texts and of all their prefixes (prefix dynamic programming).

``token_counts`` gives one row per document; ``prefix_counts`` stores the count at every prefix, and ``within_budget``
answers truncation and budget questions from the stored counts by built-in expressions, without encoding again.
Null texts count as empty, a null or repeated id is kept as it is, each input row gives one row, further columns of the
input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.bpe import CACHED_CHUNKS, Cached, cached, chunks_of, tables
from leadloom.llm.common import id_type, map_texts


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fits_chars``: the last is the longest prefix of at most ``limit`` tokens."""
    def make():
        table = tables(model_file)
        totals = cached(model_file, "total", 2 * CACHED_CHUNKS)

        def fitting(chunks, counts, n_chars):
            room, chars = limit, -1  # the space before a text is not one of its characters
            for chunk, n in zip(chunks, counts):
                if n > room:
                    inside = table.counts(chunk)
                    return max(0, chars + max((k + 1 for k, c in enumerate(inside) if c <= room), default=0))
                room, chars = room - n, chars + len(chunk)
            return n_chars

        def step(rows, texts):
            n_tokens, fits = [], []
            for raw in texts:
                whole = raw.decode("utf-8")
                chunks = chunks_of(whole)
                counts = [totals[c] for c in chunks]
                n_tokens.append(sum(counts))
                fits.append(fitting(chunks, counts, len(whole)) if n_tokens[-1] > limit else len(whole))
            return [rows.column(0), [len(t) for t in texts], n_tokens, [n > limit for n in n_tokens], fits]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    return map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, n_bytes long, n_tokens long, "
                                         "over_limit boolean, fits_chars long")


def prefix_counts(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, counts``: the exact token count of the text's first 1, 2, ... characters (empty text: none)."""
    def make():
        table = tables(model_file)
        inside = Cached(table.counts)

        def step(rows, texts):
            out = []
            for raw in texts:
                counts, base = [], 0
                for chunk in chunks_of(raw.decode("utf-8")):
                    own = inside[chunk]
                    counts.extend([base + c for c in own])
                    base += own[-1]
                out.append(counts[1:])
            return [rows.column(0), out]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    return map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, counts array<int>")


def within_budget(counts: Column, budget: int) -> Column:
    """Length in characters of the longest prefix with at most ``budget`` tokens, from stored ``counts``."""
    places = F.filter(F.transform(counts, lambda c, i: F.when(c <= budget, i + 1)), lambda p: p.isNotNull())
    return F.coalesce(F.array_max(places), F.lit(0))
