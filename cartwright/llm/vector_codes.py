"""Vector codes: product quantisation in whole numbers by Walsh-Hadamard transforms.

Components become integers, floor(4096 * x). A vector is cut into ``PARTS`` equal
parts; each part position has a codebook of ``ENTRIES`` entries, and a vector's
code names the nearest entry of each. Codebooks start from the first vectors and
are refined for ``ROUNDS`` rounds (nearest entry, then the floor of the mean).

Nearest entries are searched in the transformed domain. Parts and entries are
padded with zeros to a power of two, P, and transformed by the integer
Walsh-Hadamard matrix, which keeps squared distances up to the factor P. The
squared differences are added in sequency order, in which the first
coefficients tell most. The entry that leads after the first ones is measured
in full; any other is dropped as soon as its sum exceeds that, so the search is
exact, in 64-bit integers throughout.

A transform is linear, so only transformed vectors are stored (once), and the
sums that a round needs are added in the transformed domain and transformed
back. A round is one pass over the stored vectors: every task gives one sum for
each coefficient of each entry, and the driver gets their totals, whose number
depends on the codebook alone.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; all kept vectors need one length, a multiple of ``PARTS``, else
ValueError; so do components beyond ``most_component``, whose distances would
not fit 64 bits. The starting vectors are those of the smallest ids, null ids
last, equal ids by their components; with fewer than ``ENTRIES`` kept vectors
the codebooks have as many entries as there are vectors. Repeated rows count
each. Null labels form one label. An empty table gives an empty result.
Columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import staged

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: vectors whose distances are worked out together
BLOCK_ROWS = 2_048


def padded(length: int) -> int:
    """The least power of two that is not below ``length``."""
    return 1 << max(length - 1, 0).bit_length()


def sequency(size: int) -> np.ndarray:
    """The rows of the natural Hadamard matrix in the order of their sign changes."""
    row, at = np.arange(size), np.arange(size)
    odd = np.bitwise_count(row[:, None] & at[None, :]) & 1
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(axis=1))


def transform(values: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis (a power of two), in sequency order."""
    out, size, half = values.copy(), values.shape[-1], 1
    while half < size:
        pairs = out.reshape(*values.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :], pairs[..., 1, :] = a + b, a - b
        half *= 2
    return out[..., sequency(size)]


def inverse(coefficients: np.ndarray) -> np.ndarray:
    """The values whose transform is given."""
    size = coefficients.shape[-1]
    natural = np.empty_like(coefficients)
    natural[..., sequency(size)] = coefficients
    # the natural transform is its own inverse up to the size
    twice = transform(natural)
    out = np.empty_like(twice)
    out[..., sequency(size)] = twice
    return out // size


def most_component(length: int) -> int:
    """The largest component whose distances fit 64 bits, for parts of this length."""
    return math.isqrt((1 << 63) // (32 * padded(length) * max(length, 1)))


def transformed_parts(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Coefficients (row, part, P) of vectors (row, component)."""
    length = vectors.shape[1] // parts
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() > most_component(length):
        raise ValueError("a component is too large for 64-bit distances")
    out = np.zeros((len(vectors), parts, padded(length)), np.int64)
    out[:, :, :length] = scaled.astype(np.int64).reshape(len(vectors), parts, length)
    return transform(out)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, ties to the lower one; scaled squared distance) of rows."""
    size = rows.shape[1]
    upto = max(1, size // 4)
    lead = ((rows[:, None, :upto] - entries[None, :, :upto]) ** 2).sum(axis=2)
    guess = lead.argmin(axis=1)
    bound = ((rows - entries[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(lead <= bound[:, None])
    total = lead[row, entry]
    while upto < size:
        more = min(size, 2 * upto)
        total = total + ((rows[row, upto:more] - entries[entry, upto:more]) ** 2).sum(axis=1)
        left = total <= bound[row]
        row, entry, total, upto = row[left], entry[left], total[left], more
    # the pairs are in the order of row and entry, and every row's guess is among them
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
    least = np.minimum.reduceat(total, starts) if len(row) else total
    best = np.flatnonzero(total == np.repeat(least, np.diff(np.append(starts, len(row)))))
    first = best[np.append(True, row[best][1:] != row[best][:-1])] if len(row) else best
    return entry[first], least


def stored(df: DataFrame, vec_id: str, vector: str, label: str, parts: int) -> DataFrame:
    """(vec_id, label, coefficients) of the rows that are kept, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            keep = np.array([v is not None and None not in v and all(map(math.isfinite, v))
                             for v in column.to_pylist()], bool)
            batch = batch.filter(pa.array(keep, pa.bool_()))
            column = batch.column("vector")
            sizes = {len(v) for v in column}
            if len(sizes) > 1 or any(n % parts for n in sizes):
                raise ValueError(f"vectors need one length, a multiple of {parts}")
            if not batch.num_rows:
                continue
            flat = column.flatten().to_numpy(zero_copy_only=False)
            found = transformed_parts(flat.reshape(batch.num_rows, sizes.pop()), parts)
            wide = found.shape[1] * found.shape[2]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array(np.full(batch.num_rows, flat.size // batch.num_rows, np.int32)),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * wide),
                     pa.array(found.ravel()))],
                names=["vec_id", "label", "length", "coefficients"])

    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                     F.col(vector).alias("vector"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return staged(rows.mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, length int, "
             "coefficients array<long>"), "vectors")


def _coefficients(batch: pa.RecordBatch, shape: tuple[int, ...], length: int) -> np.ndarray:
    if batch.num_rows and set(batch.column("length").to_pylist()) != {length}:
        raise ValueError("vectors need one length")
    return batch.column("coefficients").flatten().to_numpy().reshape(batch.num_rows, *shape)


def _sums(rows: DataFrame, books: np.ndarray, length: int) -> list:
    """(part, entry, place, n, total): members of each entry and sums of their coefficients."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, size), object)  # whole numbers of any size
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                own = _coefficients(batch.slice(at, BLOCK_ROWS), (parts, size), length)
                for p in range(parts):
                    found, _ = nearest(own[:, p], books[p])
                    n[p] += np.bincount(found, minlength=entries)
                    sums = np.zeros((entries, size), np.int64)
                    np.add.at(sums, found, own[:, p])
                    total[p] += sums
        p, e, at = np.nonzero(np.repeat(n[:, :, None] > 0, size, axis=2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(at, pa.int32()),
             pa.array(n[p, e], pa.int64()),
             pa.array([str(x) for x in total[p, e, at]], pa.string())],
            names=["part", "entry", "place", "n", "total"])

    found = rows.select("length", "coefficients").mapInArrow(
        run, "part int, entry int, place int, n long, total string")
    return (found.groupBy("part", "entry", "place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect())  # parts x entries x P rows at most, whatever the input


def refined(rows: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """The codebooks (part, entry, component) after one round."""
    parts, entries, width = books.shape
    size = padded(width)
    wide = np.zeros((parts, entries, size), np.int64)
    wide[:, :, :width] = books
    total, n = np.zeros((parts, entries, size), object), np.zeros((parts, entries), object)
    for r in _sums(rows, transform(wide), length):
        total[r.part, r.entry, r.place], n[r.part, r.entry] = int(r.total), r.n
    means = inverse(total)[:, :, :width] // np.where(n == 0, 1, n)[:, :, None]
    return np.where((n == 0)[:, :, None], books, means).astype(np.int64)


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks (part, entry, component) of stored vectors; None if there are none."""
    first = (rows.orderBy(F.col("vec_id").asc_nulls_last(), "coefficients")
             .limit(entries).collect())
    if not first:
        return None
    length = first[0].length
    if any(r.length != length for r in first):
        raise ValueError("vectors need one length")
    own = np.array([r.coefficients for r in first], np.int64).reshape(
        len(first), parts, padded(length // parts))
    books = inverse(own)[:, :, :length // parts].transpose(1, 0, 2)
    for _ in range(rounds):
        books = refined(rows, books, length)
    return books


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of stored vectors."""
    parts, entries, width = books.shape
    size = padded(width)
    wide = np.zeros((parts, entries, size), np.int64)
    wide[:, :, :width] = books
    wide = transform(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(at, BLOCK_ROWS)
                own = _coefficients(block, (parts, size), parts * width)
                code = np.empty((block.num_rows, parts), np.uint8)
                error = np.zeros(block.num_rows, np.int64)
                for p in range(parts):
                    code[:, p], far = nearest(own[:, p], wide[p])
                    error += far // size
                yield pa.RecordBatch.from_arrays(
                    [block.column("vec_id"), block.column("label"),
                     pa.array([c.tobytes().hex() for c in code], pa.string()),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, "
                                "code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
             label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector."""
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits a part")
    rows = stored(df, vec_id, vector, label, parts)
    books = codebooks(rows, parts, entries, rounds)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"),
                           F.lit("").alias("codebooks_sha256"))
    found = staged(coded(rows, books), "codes")
    by_label = found.groupBy(F.col("label").alias("__label")).agg(
        F.sum("error").alias("label_error"))
    return (found.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", "code", "error", "label_error",
                    F.lit(digest(books)).alias("codebooks_sha256")))
