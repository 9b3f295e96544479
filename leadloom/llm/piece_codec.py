"""Encoding to sentencepiece ids by prefix tables, and decoding.

One row per input row. A null text is an empty one and has no ids; ids of documents, null or repeated, are kept as they
are; further columns are not read. A text of any length is one row of one task.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.bpe import CACHED_CHUNKS, cached, chunks_of
from leadloom.llm.common import id_type, map_texts


def encode_pieces(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text."""
    def make():
        known = cached(model_file, "chunk_ids", CACHED_CHUNKS)

        def step(rows, texts):
            return [rows.column(0), [list(chain.from_iterable([known[c] for c in chunks_of(t.decode("utf-8"))])) for t in texts]]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    return map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, ids array<int>")


def decode_pieces(encoded: DataFrame, model_file: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of stored ids; null ids give a null text."""
    def run(batches):
        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for frame in batches:
            frame["text"] = [None if x is None else library.decode([int(i) for i in x]) for x in frame.pop(ids)]
            yield frame

    source = encoded.select(F.col(doc_id), F.col(ids))
    return source.mapInPandas(run, f"`{doc_id}` {id_type(encoded, doc_id)}, text string")


def piece_digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids are decoded chunk by chunk, a repeated chunk once; the text is what they join to.
    """
    def make():
        known, sha = cached(model_file, "coded", CACHED_CHUNKS), hashlib.sha256

        def step(rows, texts):
            n_tokens, ids_sha, text_sha = [], [], []
            for raw in texts:
                found = [known[c] for c in chunks_of(raw.decode("utf-8"))]
                n_tokens.append(sum([f[0] for f in found]))
                ids_sha.append(sha(b",".join([f[1] for f in found])).hexdigest())
                text_sha.append(sha(b"".join([f[2] for f in found])[1:]).hexdigest())  # without the space put before it
            return [rows.column(0), n_tokens, ids_sha, text_sha]

        return step

    source = docs.select(F.col(doc_id), F.col(text))
    return map_texts(source, text, make, f"`{doc_id}` {id_type(docs, doc_id)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
