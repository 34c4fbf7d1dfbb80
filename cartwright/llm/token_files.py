"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters.

Documents are dealt by range of doc_id and sorted, so the files hold them in
ascending order, one after the other. A row is one document: its ids (which
ORC stores as run-length encoded integers), the number of its file, and how
many ids that file holds before it. Every stripe has a row index with the least
and largest doc_id of each ``STRIDE`` rows and a Bloom filter of doc_ids, so a
search for documents (``find``) skips stripes and row groups by metadata alone,
and a scan reads the stripes in parallel. The offset of a document in the whole
corpus is its offset in its file plus the ids of the files before; that is one
small row a file.

Ids are those of the ``tokenizers`` library with its defaults and without added
special tokens; every document ends with ``end_id``. Words repeat, so a block of
texts is cut at single spaces (where the byte-level pattern always parts
pieces), and each different chunk is encoded once.

Defined cases: null and empty texts have the end id alone; a null doc_id sorts
first; rows that share a doc_id are all kept, in the order of the input, and
are spread over files if there are many; texts are taken whole; an empty table
gives files without rows. Only doc_id and the text are read, so names cannot
clash.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import (delete_at_end, own_cache, shared_folder, starts_of,
                                   worker_cache)
from cartwright.llm.pieces import CLOSERS, compiled, cut_block, places, string_bytes
from cartwright.llm.token_counts import byte_letters

#: rows of one entry of the row index, and bytes of a stripe
STRIDE = 1_000
STRIPE_BYTES = 32 << 20
#: texts that are encoded together (or one long text); what a block needs besides is
#: about ten times its bytes
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 16_000
#: chunks that the library encodes in one call
CALL_CHUNKS = 4_000
#: pieces whose ids a worker keeps from block to block (about 50 bytes each, and as much
#: again while they are looked up); a larger table falls back to those of the last block
KEPT_PIECES = 300_000
#: lead bytes from here on make letters beyond Latin
BEYOND_LATIN = 0xC9


class ChunkEncoder:
    """Encodes blocks of texts; every different chunk of a block is encoded once.

    Chunks (``pieces.cut_block``) of plain letters and marks are cut into pieces
    here and the library's merge model gets the pieces; any other chunk goes
    through the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec["pre_tokenizer"] or {}
        if (spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"]
                or any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"])
                       for t in spec["added_tokens"])):
            raise ValueError("the tokenizer needs byte-level pieces that part at single spaces")
        self.merge = self.tokenizer.model.tokenize
        self.cut = compiled(PATTERN).findall
        self.letters = dict(enumerate(byte_letters()))
        # what is not cut here: letters beyond Latin, and special strings
        self.other = re.compile("|".join(["[^\x00-\u024f]", *(
            re.escape(t["content"]) for t in spec["added_tokens"])])).search
        self.known = pa.array([], pa.large_string())  # pieces, and their ids
        self.known_ids = pa.array([], pa.large_list(pa.int32()))

    def _merged(self, pieces: list[str]) -> pa.LargeListArray:
        """The ids of each piece, by the merge model."""
        ids, ends, merge = array("i"), array("q", [0]), self.merge
        for piece in pieces:
            if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
                plain = "\u0120" + piece[1:]
            else:
                plain = piece.encode().decode("latin-1").translate(self.letters)
            ids.extend([t.id for t in merge(plain)])
            ends.append(len(ids))
        return pa.LargeListArray.from_arrays(pa.array(np.frombuffer(ends, np.int64)),
                                             pa.array(np.frombuffer(ids, np.int32)))

    def _ids(self, pieces: pa.LargeStringArray) -> pa.LargeListArray:
        """The ids of different pieces; those of new ones are kept."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        if len(new):
            at = pc.coalesce(at, pa.scalar(-1, pa.int32())).to_numpy().copy()
            at[at < 0] = len(self.known) + np.arange(len(new))
            self.known_ids = pa.concat_arrays([self.known_ids, self._merged(new.to_pylist())])
            self.known = pa.concat_arrays([self.known, new])
        ids = self.known_ids.take(pa.array(at))
        if len(self.known) > KEPT_PIECES:
            self.known, self.known_ids = pieces, ids
        return ids

    def _packed(self, keys: pa.LargeStringArray) -> pa.LargeListArray:
        """The ids of each chunk.

        Chunks that are a word, or one and a mark, are cut all at once; others by the
        pattern. The different pieces are looked up together.
        """
        data, at = string_bytes(keys)
        words = pc.ascii_rtrim(keys, characters="".join(CLOSERS))
        cut = np.diff(at) - pc.binary_length(words).to_numpy()
        wide = np.maximum.reduceat(np.append(data, np.uint8(0)), at[:-1]) >= BEYOND_LATIN
        plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False) & (cut <= 1) & ~wide
        marked = plain & (cut == 1)
        n = np.where(plain, 1 + cut, 0)
        others: list[str] = []
        rest = []  # what the library has to cut
        for i, key in zip(np.flatnonzero(~plain).tolist(),
                          keys.filter(pa.array(~plain)).to_pylist()):
            text = key[1:] if key[:1] == "\n" else " " + key
            if self.other(key):
                rest.append((i, text))
            else:
                found = self.cut(text)
                n[i] = len(found)
                others += found
        coded = pa.concat_arrays([
            pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) for x in ("", " ")),
                                        words.filter(pa.array(plain)),
                                        pa.scalar("", pa.large_string())),
            pa.array([chr(b) for b in data[at[1:][marked] - 1].tolist()], pa.large_string()),
            pa.array(others, pa.large_string())]).dictionary_encode()
        pieces = coded.indices.to_numpy()
        tables = [self._ids(coded.dictionary)]
        cut_here = ~plain & (n > 0)
        n[[i for i, _ in rest]] = 1
        first = np.cumsum(n) - n
        order = np.empty(int(n.sum()), np.int64)
        n_plain, n_marked = int(plain.sum()), int(marked.sum())
        order[first[plain]] = pieces[:n_plain]
        order[first[marked] + 1] = pieces[n_plain:n_plain + n_marked]
        order[places(first[cut_here], n[cut_here])] = pieces[n_plain + n_marked:]
        for start in range(0, len(rest), CALL_CHUNKS):
            part = rest[start:start + CALL_CHUNKS]
            found = self.tokenizer.encode_batch_fast([t for _, t in part], add_special_tokens=False)
            order[first[[i for i, _ in part]]] = sum(map(len, tables)) + np.arange(len(part))
            tables.append(pa.array([e.ids for e in found], pa.large_list(pa.int32())))
        return joined(pa.concat_arrays(tables), order, n)

    def encode(self, texts: list[str], end_id: int) -> pa.ListArray:
        """The ids of each text, followed by ``end_id``."""
        if not texts:
            return pa.array([], pa.list_(pa.int32()))
        keys, order, n = cut_block(texts)
        table = pa.concat_arrays([self._packed(keys),
                                  pa.array([[end_id]], pa.large_list(pa.int32()))])
        ids = joined(table, np.insert(order, np.cumsum(n), len(keys)), n + 1)
        return pa.ListArray.from_arrays(ids.offsets.cast(pa.int32()), ids.values)


def joined(table: pa.LargeListArray, order: np.ndarray, n: np.ndarray) -> pa.LargeListArray:
    """The lists of a table in this order, as many as ``n`` says joined to one each time."""
    lists = table.take(pa.array(order))
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return pa.LargeListArray.from_arrays(
        pa.array(ends[np.concatenate(([0], np.cumsum(n)))]), lists.flatten())


@worker_cache
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encoded(df: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """(doc_id, file, first, n_tokens, ids) in ascending doc_id order.

    file: the number of the task that writes the row, in the order of doc_id;
    first: the ids that this task has written before.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(encoder)
        own, first = encoder(tokenizer), 0
        file = TaskContext.get().partitionId()
        for block in blocks(batches, "text", BLOCK_BYTES, BLOCK_ROWS):
            ids = own.encode([x or "" for x in block.column("text").to_pylist()], end_id)
            upto = ids.offsets.to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(np.full(len(ids), file, np.int32)),
                 pa.array(first + upto[:-1]), pa.array(np.diff(upto)), ids],
                names=["doc_id", "file", "first", "n_tokens", "ids"])
            first += int(upto[-1])
            del ids, upto
            # else freed arrays stay with the worker, beside the memory of its executor
            pa.default_memory_pool().release_unused()

    kind = df.schema["doc_id"].dataType.simpleString()
    # the place in the input splits a doc_id that many rows share
    rows = df.select("doc_id", "text").withColumn("__at", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("doc_id", "__at").sortWithinPartitions("doc_id", "__at")
    return dealt.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, file int, first long, n_tokens long, ids array<int>")


def write(df: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of all documents of ``df`` as ORC files below ``path``."""
    (encoded(df, tokenizer, end_id).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.compress", "ZSTD").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file, start, n_tokens, ids) of all documents; start: ids of all before it."""
    rows = spark.read.orc(path)
    # joined, the ids would be shuffled by file
    return rows.withColumn("__bases", starts_of(rows, "file", "n_tokens")).select(
        "doc_id", "file", (F.get("__bases", F.col("file")) + F.col("first")).alias("start"),
        "n_tokens", "ids")


def find(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents; stripes without them are skipped by their metadata."""
    return spark.read.orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def with_checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows with ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, at = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at), pa.int64()),
                 pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def write_documents(df: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to the shared folder and digest what the files hold."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-tokens-{uuid.uuid4().hex}"
    write(df, path, tokenizer)
    delete_at_end(spark, path)
    return with_checksums(read(spark, path))
