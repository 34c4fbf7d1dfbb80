"""Token files, vector codes and the source audit against plain restatements."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwright.llm import bpe, divergence, token_files, vector_codes
from cartwright.llm.common import read_table
from tests.conftest import SF01

from .conftest import ODD, SCHEMA, documents, prose

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- token files -----------------------------------------------------------------------

def library_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [[*e.ids, 0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def digests(rows):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows that are already in order."""
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, library_ids([t or "" for _, t in rows])):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_the_library_on_whole_tables(spark):
    docs = read_table(spark, SF01, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    found = token_files.write_documents(docs.repartition(5), TOKENIZER).collect()
    assert sorted(map(tuple, found)) == digests(rows)


def test_token_files_with_odd_texts(spark, odd, none):
    strange = [" two  spaces", "tail ", "a \n b", "a  ᠎ b", "<|endoftext|> x<|endoftext|>",
               "don't we'll 'S", "　  x", "line\nline \n\n x", " ", "  ", "\n", "x" * 20000,
               "a b " * 4000, "\x1c \x1d", "🙂 🙂🙂  é"]
    for texts in (strange, strange[::-1]):
        docs = documents(spark, texts)
        found = token_files.write_documents(docs, TOKENIZER).collect()
        assert sorted(map(tuple, found)) == digests([*enumerate(texts)])
    found = token_files.write_documents(odd, TOKENIZER).orderBy("start").collect()
    order = sorted(range(len(ODD)), key=lambda i: (ODD[i][0] is not None, ODD[i][0] or 0, i))
    assert [*map(tuple, found)] == digests([ODD[i] for i in order])
    assert token_files.write_documents(none, TOKENIZER).count() == 0


def test_blocks_of_odd_texts_equal_the_library():
    from .test_tokens import odd_texts
    texts = odd_texts(11, 3000)
    got = token_files.ChunkEncoder(TOKENIZER).encode(texts, 0).to_pylist()
    assert got == library_ids(texts)


def test_pieces_are_merged_once_and_known_in_later_blocks(monkeypatch):
    """Words alone, with a mark or before a line break share an entry; ids stay the library's."""
    rnd = random.Random(8)
    signs = ["a", "b", "É", "\u0240", "ȿ", "中", "ª", "µ", "٣", "1", ".", " ", ",", ")", "'s", "\n",
             "\t", "  ", "<|endoftext|>", "\u0301", "ß", "\x1c", "\x85", "#", "word", "Wort"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    own = token_files.ChunkEncoder(TOKENIZER)
    want = [[*e.ids, 0] for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    merge, calls = own.merge, []
    own.merge = lambda piece: calls.append(piece) or merge(piece)
    assert own.encode(["a word, a word\nword. (word) word"], 0).to_pylist() == [
        [*own.tokenizer.encode("a word, a word\nword. (word) word",
                               add_special_tokens=False).ids, 0]]
    assert len(calls) == len(set(calls)) and calls.count("\u0120word") == 1
    assert own.encode(texts, 0).to_pylist() == want
    assert len(calls) == len(set(calls))
    before = len(calls)
    assert own.encode(texts[::-1], 0).to_pylist() == want[::-1] and len(calls) == before
    monkeypatch.setattr(token_files, "KEPT_PIECES", 10)
    for at in range(0, 3000, 100):
        assert own.encode(texts[at:at + 100], 0).to_pylist() == want[at:at + 100]
    assert len(own.known) == len(own.known_ids) < 1000
    assert own.encode([], 0).to_pylist() == []


def test_blocks_of_many_new_words_take_little_memory():
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(3, 9)))
                      for _ in range(350)) for _ in range(6_000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    own = token_files.ChunkEncoder(TOKENIZER)
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)  # counts from here on
    pa.set_memory_pool(pool)
    try:
        found = []
        for block in bpe.blocks([batch], "text", token_files.BLOCK_BYTES, token_files.BLOCK_ROWS):
            found += own.encode(block.column("text").to_pylist(), 0)[:3].to_pylist()
    finally:
        pa.set_memory_pool(usual)
    assert found[:3] == library_ids(texts[:3])
    assert pool.max_memory() < 150 << 20, pool.max_memory()


def test_token_files_spread_a_doc_id_that_a_third_shares(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(7 if i % 3 == 0 else i, prose(rnd, 30), "clash", i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string, start int")
    path = f"file://{tmp_path}/hot"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(docs.repartition(4), path, TOKENIZER)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    back = token_files.read(spark, path).orderBy("start").collect()
    assert len(back) == 3000
    assert [r.doc_id for r in back] == sorted(d for d, *_ in rows)
    assert [r.start for r in back] == [0, *np.cumsum([r.n_tokens for r in back]).tolist()][:-1]
    assert len({r.file for r in back if r.doc_id == 7}) > 1
    found = sorted((r.doc_id, tuple(r.ids)) for r in back)
    assert found == sorted((d, tuple(i)) for (d, *_), i in zip(rows, library_ids(
        [t for _, t, _, _ in rows])))


def test_searches_skip_stripes_by_their_metadata(spark, tmp_path):
    docs = spark.range(40_000).select(
        (F.col("id") * 2).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    path = f"file://{tmp_path}/many"
    token_files.write(docs, path, TOKENIZER)

    def scanned(ids):
        found = token_files.find(spark, path, ids)
        assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString() or (
            "EqualTo(doc_id" in found._jdf.queryExecution().toString())
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        plan.execute().count()
        leaf = plan.collectLeaves().apply(0)
        return rows, leaf.metrics().apply("numOutputRows").value() // 2

    rows, read = scanned([20_000, 20_002])
    assert sorted(r.doc_id for r in rows) == [20_000, 20_002]
    assert [r.ids for r in sorted(rows)] == library_ids(["text 10000", "text 10001"])
    assert read <= 4 * token_files.STRIDE  # row groups by least and largest id
    rows, read = scanned([20_001, 20_003])  # inside the range of a row group, but not in its filter
    assert not rows and read <= 2 * token_files.STRIDE


# --- vector codes ----------------------------------------------------------------------

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(codes and errors by row, codebooks) with whole numbers and plain distances."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for c in cut:
                members[near(c[p], books[p])[1]].append(c[p])
            for k, m in members.items():
                books[p][k] = [sum(x) // len(m) for x in zip(*m)]
    out = []
    for (i, lab, _), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    sums = collections.Counter()
    for _, lab, _, e in out:
        sums[lab] += e
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(i, code, e, sums[lab], sha) for i, lab, code, e in out], books


EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def same_codes(spark, rows, **how):
    found = vector_codes.compress(spark.createDataFrame(rows, EMBEDDINGS).repartition(3), **how)
    key = lambda r: tuple((x is not None, x or 0) for x in r[:1]) + r[1:]
    expected, _ = plain_codes(rows, **how)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_codes_equal_plain_distances(spark):
    rnd = random.Random(3)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rnd.gauss(0, 0.2)) for _ in range(24)], i % 4 or None) for i in range(200)]
    same_codes(spark, rows)  # parts of 3, padded to 4
    same_codes(spark, [(i, v[:16], 1) for i, v, _ in rows], entries=5, rounds=2)
    same_codes(spark, [(i, v[:8], lab) for i, v, lab in rows], parts=2, entries=3)


def test_codes_with_nulls_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.25] * 8, 1), (5, [0.25] * 8, 1), (5, [-0.25] * 8, None), (None, [0.5] * 8, None),
            (1, None, 1), (2, [None] + [0.0] * 7, 1), (3, [nan] * 8, 2), (4, [inf] + [0.0] * 7, 2),
            (6, [-0.00001] * 8, 1), (7, [0.0] * 8, None), (7, [0.0] * 8, 3), (1 << 60, [0.3] * 8, 3)]
    same_codes(spark, rows)
    same_codes(spark, rows, entries=2)
    same_codes(spark, rows[4:8])
    same_codes(spark, [])
    # a third of all rows and more are one vector
    same_codes(spark, [(i, [0.125] * 16 if i % 3 else [i / 64.0] * 16, 1) for i in range(90)])


def test_codes_refuse_what_does_not_fit(spark):
    for rows in ([(1, [0.1] * 8, 1), (2, [0.1] * 16, 1)], [(1, [0.1] * 9, 1)],
                 [(1, [1e30] * 8, 1)]):
        with pytest.raises(Exception, match="need one length|too large"):
            vector_codes.compress(spark.createDataFrame(rows, EMBEDDINGS)).collect()


def test_walsh_hadamard():
    for size in (1, 2, 8, 32):
        eye = np.eye(size, dtype=np.int64)
        matrix = vector_codes.transform(eye)
        changes = (np.diff(np.sign(matrix), axis=0) != 0).sum(axis=0)
        assert changes.tolist() == list(range(size))  # sequency order
        assert (matrix @ matrix.T == size * eye).all()
        values = np.random.default_rng(1).integers(-9999, 9999, (3, size))
        assert (vector_codes.inverse(vector_codes.transform(values)) == values).all()
    rng = np.random.default_rng(2)
    rows, entries = rng.integers(-4, 5, (500, 8)), rng.integers(-4, 5, (16, 8))
    far = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
    at, least = vector_codes.nearest(rows, entries)
    assert (at == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()


# --- source audit ----------------------------------------------------------------------

def plain_audit(rows, least_docs=10, top=10):
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in
                 re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), d in docs.items() if g == lang and d >= least_docs]
        sources = [s for g, s in groups if g == lang]
        count = {s: {t: n[lang, s, t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
             for s, c in count.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], p[None][t]), t) for t in kept
                    if count[s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(items[:most])]
    return sorted(out)


def audit_table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, None) for i, (t, g, s) in enumerate(rows)], SCHEMA)


def test_audit_in_small_cells(spark):
    rnd = random.Random(8)
    words = ["Ähre", "éa", "one", "TWO", "three-four", "x1y", "Ünder_score", "zwölf", "中文", "ß"]
    rows = []
    for i in range(600):
        text = " ".join(rnd.choices(words, [1 + (i + k) % 7 for k in range(len(words))], k=12))
        rows.append((text, rnd.choice(["en", "de", None]),
                     "hot" if i % 3 == 0 else rnd.choice([None, *(f"s{k}" for k in range(6))])))
    rows += [(None, "en", "silent"), ("", "fr", "alone"), ("rare", "it", "a"), (None, "it", "b"),
             ("1 2 3", "it", "c")]
    docs, expected = audit_table(spark, rows).repartition(4), plain_audit(rows)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == expected
    # several group blocks and term blocks give the same
    assert sorted(map(tuple, divergence.audit(docs, group_block=2, term_block=3).collect())
                  ) == expected
    assert {r[0] for r in expected} == {"", "en", "de", "it"}  # fr has neither pair nor term


def test_audit_counts_whole_texts_and_passes_on_parts(spark, odd, none, monkeypatch):
    rows = [("word " * 30000 + "END", "en", "a")] + [("end word é", "en", f"s{i}") for i in range(12)]
    found = sorted(map(tuple, divergence.audit(audit_table(spark, rows)).collect()))
    assert found == plain_audit(rows)
    assert divergence.audit(none).count() == 0
    assert divergence.audit(odd).count() == 0  # one group, no kept term
    clash = audit_table(spark, rows).selectExpr("text", "lang", "source", "1 AS term", "2 AS p",
                                                "3 AS docs", "'x' AS g", "4 AS value")
    assert sorted(map(tuple, divergence.audit(clash).collect())) == found
