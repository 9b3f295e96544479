"""Token ids of a corpus in a compressed binary form that is read back in parallel.

``write_token_files`` leaves a folder with three tables: ``tables`` (the frequency of each id, shared by all blocks),
``blocks`` (each row one independent block: its coded words, interleaved states, checkpoints, checksum, and the documents
in it) and ``parts`` (ids before each part; one row per part of the sorted corpus). Documents are in ascending id order,
null ids first, equal ids in input order; a document lies in one block whatever its length. Null texts are empty and hold only the
end id. Further columns are not read. An empty table gives empty tables.
"""

from __future__ import annotations

import json
import string
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import rans
from leadloom.llm.common import checkpoint_dir, id_type, keep, map_texts, of_stage, ship

BLOCK_TOKENS = 1 << 20
PUNCTUATION = string.punctuation.encode()
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: the character that stands for each byte in byte-level vocabularies: itself if visible, else the next from 256 on
BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
BLOCK = ("part int, block int, first_token long, n_tokens long, doc_ids array<{id}>, doc_tokens array<int>, lanes int, "
         "states binary, words binary, mark_words array<long>, mark_states binary, crc32 long")


class WordIds(dict):
    """``word -> ids`` (little-endian, of ``dtype``) by the library, for tokenizers that drop white space and never cross it.

    ASCII capitals are lower-cased before the look-up, as the tokenizer does; not in texts with combining marks (a capital
    may compose otherwise) or with the letters of a special string. Punctuation behind a letter or digit is a token of its
    own and looked up by itself. Words of lower-case Latin letters, which normalisation leaves alone, go straight to the
    library's model; all others go through its whole encoder.
    """

    MOST, LONGEST = 600_000, 48  # words kept; longer ones are not

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        told = json.loads(self.tokenizer.to_str())
        parts = [[x["type"] for x in told[k][v]] for k, v in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if parts != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]:
            raise ValueError(f"not a tokenizer of lower-cased words: {parts}")
        self.special = [x["content"].lower().encode() for x in told["added_tokens"]]
        #: bytes that every special string has: words without one are not looked through
        self.mark = bytes([min(set.intersection(*map(set, self.special)))]) if self.special else b"\x00"
        self.model, self.size = self.tokenizer.model, self.tokenizer.get_vocab_size()
        self.code = "H" if self.size <= 1 << 16 else "I"

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if self.code == "H" else "<u4")

    def words(self, text: bytes) -> list[bytes]:
        low = text.lower()
        if b"\xcc" in text or b"\xcd" in text or any(s in low for s in self.special):
            low = text
        return low.split()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(PUNCTUATION)
        if len(core) < len(word) and core[-1:].isalnum() and not (self.mark in word and any(s in word.lower() for s in self.special)):
            ids = self[core] + self[word[len(core):]]
        elif word.isalpha() and word.islower():
            ids = array(self.code, [t.id for t in self.model.tokenize(word.decode())]).tobytes()
        else:
            ids = self.encoded(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = ids
        return ids

    def encoded(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if not word.isascii() and max(text) < "\u0250" and text.isalpha() and text == text.lower():
            found = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(BYTE_CHARS))]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, found).tobytes()

    def of_texts(self, texts: list[bytes]) -> list[bytes]:
        return [b"".join(map(self.__getitem__, self.words(t))) for t in texts]


def word_ids(tokenizer_file: str) -> WordIds:
    """Loaded once for the tasks of a stage in a worker: those that follow find its words."""
    return of_stage(("words", tokenizer_file), lambda: WordIds(tokenizer_file))


def encode_ids(docs: DataFrame, tokenizer_file: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, ids, counts``: ids with the end id; a last row of each task has how often it met each id instead."""
    def make():
        known = word_ids(tokenizer_file)
        end, dtype = np.array([end_id], known.dtype).tobytes(), known.dtype
        total = np.zeros(max(known.size, end_id + 1), dtype=np.int64)

        def step(rows, texts):
            ids = [x + end for x in known.of_texts(texts)]
            total[:] += np.bincount(np.frombuffer(b"".join(ids), dtype), minlength=len(total))
            return [rows.column(0), ids, [None] * len(ids)]

        step.finish = lambda: [[None], [None], [total.tobytes()]]
        return step

    return map_texts(docs.select(F.col(doc_id), F.col(text)), text, make, f"`{doc_id}` {id_type(docs, doc_id)}, ids binary, counts binary")


def token_counts(encoded: DataFrame) -> DataFrame:
    """``id, n`` over all documents, from the counts of the tasks."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                total = np.frombuffer(own, np.int64) + (total if len(total) else 0)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return encoded.where("counts IS NOT NULL").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def load_tables(rows: list, size: int) -> rans.Tables:
    freq = np.zeros(size, dtype=np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return rans.Tables(freq)


def pack(tokens: list[bytes], dtype: np.dtype, ids: list, part: int, number: int, first: int, tables: rans.Tables) -> list:
    joined = np.frombuffer(b"".join(tokens), dtype)
    coded = rans.encode(joined, tables)
    states, words = coded["states"].tobytes(), coded["words"].tobytes()
    marks = b"".join(s.tobytes() for _, s in coded["marks"])
    return [part, number, first, len(joined), ids, [len(t) // dtype.itemsize for t in tokens], coded["lanes"], states, words,
            [int(w) for w, _ in coded["marks"]], marks, zlib.crc32(words, zlib.crc32(states))]


def unpack(row: dict) -> dict:
    """The parts of a stored block that ``rans.decode`` takes; a wrong checksum is an error."""
    if zlib.crc32(row["words"], zlib.crc32(row["states"])) != row["crc32"]:
        raise ValueError(f"checksum of block {row['block']} in part {row['part']} is wrong")
    marks = np.frombuffer(row["mark_states"], np.uint64).reshape(-1, row["lanes"])
    return {"lanes": row["lanes"], "states": np.frombuffer(row["states"], np.uint64),
            "words": np.frombuffer(row["words"], np.uint32), "marks": list(zip(row["mark_words"], marks))}


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 1, path: str | None = None,
                      doc_id: str = "doc_id", text: str = "text") -> str:
    """Write the three tables and return their folder."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    ship(spark)
    path = path or f"{checkpoint_dir(spark)}/llm/token-files-{uuid.uuid4().hex}"
    kind = id_type(docs, doc_id)
    encoded = keep(encode_ids(docs, tokenizer_file, end_id, doc_id, text), "token-ids")
    dtype = word_ids(tokenizer_file).dtype
    # one row for each id of the vocabulary at most
    counted = token_counts(encoded).toPandas().sort_values("id")
    freq = rans.frequencies(np.bincount(counted["id"], weights=counted["n"], minlength=end_id + 1).astype(np.int64))
    seen = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in seen], "id long, freq long").coalesce(1).write.parquet(f"{path}/tables")
    schema = BLOCK.format(id=kind)
    arrow, shared = to_arrow_schema(StructType.fromDDL(schema)), spark.sparkContext.broadcast(freq)

    def run(batches):
        tables, part = rans.Tables(shared.value), TaskContext.get().partitionId()
        ids, tokens, waiting, first, number = [], [], 0, 0, 0

        def emit():
            row = pack(tokens, dtype, ids, part, number, first, tables)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(key)
                tokens.append(own)
                waiting += len(own) // dtype.itemsize
                if waiting >= BLOCK_TOKENS:
                    yield emit()
                    ids, tokens, first, number, waiting = [], [], first + waiting, number + 1, 0
        if ids:
            yield emit()

    place = F.monotonically_increasing_id()  # equal ids stay in input order, and a repeated one can be split
    ordered = (encoded.where("ids IS NOT NULL").withColumn("place", place).repartitionByRange(F.col(doc_id), F.col("place"))
               .sortWithinPartitions(doc_id, "place").select(doc_id, "ids"))
    ordered.mapInArrow(run, schema).write.parquet(f"{path}/blocks")
    sums = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, parts = 0, []
    for r in sums:  # one row per part
        parts.append((r["part"], before))
        before += r["n"]
    spark.createDataFrame(parts, "part int, tokens_before long").coalesce(1).write.parquet(f"{path}/parts")
    return path


def read_token_files(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, blocks decoded independently of each other."""
    ship(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    rows = spark.read.parquet(f"{path}/tables").collect()
    shared = spark.sparkContext.broadcast((rows := [r.asDict() for r in rows], max([r["id"] for r in rows], default=0) + 1))

    def run(batches):
        tables = load_tables(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                tokens = rans.decode(row["n_tokens"], unpack(row), tables)
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                     pa.array([row["part"]] * len(ends), pa.int32()), pa.array(starts + row["first_token"], pa.int64()),
                     pa.array(row["doc_tokens"], pa.int64()),
                     pa.array([tokens[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                    names=[doc_id, "part", "within", "n_tokens", "ids"])

    parts = F.broadcast(spark.read.parquet(f"{path}/parts"))  # one row per part
    read = blocks.mapInArrow(run, f"`{doc_id}` {kind}, part int, within long, n_tokens long, ids binary")
    return read.join(parts, "part").select(doc_id, (F.col("tokens_before") + F.col("within")).alias("start"), "n_tokens", "ids")
