"""Byte-level BPE and token counts against the libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwright.llm import bpe, pieces, token_counts

from .conftest import ODD, documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
ALPHABET = ["a", "a", "b", "e", " ", " ", "\n", "\t", "'", "s", "l", "l", "é", "1", "２", "-", ".",
            "!", "中", "the", "re", "ing", "<|endoftext|>", " "]


def odd_texts(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [
        "", "a" * 3000, " ", " a", "a ", "I'll 'll", "\n\n a\n\n\nb"]


def library() -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS)[0],
                             special_tokens={})


def counts_of(texts: list[str]) -> list[int]:
    found = Tokenizer.from_file(JSON).encode_batch(texts, add_special_tokens=False)
    return [len(x.ids) for x in found]


def test_replay_equals_library_and_round_trips():
    texts = odd_texts(1, 4000)
    codec, want = bpe.Codec(RANKS, PATTERN), library()
    for _ in range(2):  # the second time from the tables
        ids = codec.encode(texts).to_pylist()
        assert ids == [want.encode_ordinary(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_replay_with_ranks_out_of_order():
    """A merge that comes up late with an early rank goes before the rest of its word."""
    rnd = random.Random(5)
    for _ in range(400):
        tokens = [bytes([b]) for b in range(256)]
        extra = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(2, 5))) for _ in range(12)}
        extra = sorted(extra)
        rnd.shuffle(extra)
        ranks = {t: i for i, t in enumerate(tokens + extra)}
        replay = bpe.MergeReplay(ranks, tokens + extra)
        want = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                 special_tokens={})
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))) for _ in range(40)]
        got = replay.encode_words([w.encode() for w in words])
        for word, packed in zip(words, got):
            ids = [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)]
            assert ids == want.encode_ordinary(word), word


def test_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 20)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    codec, want = bpe.Codec(RANKS, PATTERN), library()
    for seed in range(5):
        texts = [" ".join(f"w{i} w{i}" for i in range(seed, seed + 60))] + odd_texts(seed, 50)
        assert codec.encode(texts).to_pylist() == [want.encode_ordinary(t) for t in texts]
        assert len(codec.table.known) <= 20 and len(codec.words) <= 20


def test_documents(spark, odd, none):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in bpe.encode_documents(odd, RANKS, PATTERN).collect()}
    want = set()
    for doc_id, text in ODD:
        ids = library().encode_ordinary(text or "")
        want.add((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want
    assert bpe.encode_documents(none, RANKS, PATTERN).count() == 0


def test_columns_pass_through_and_decode(spark):
    docs = documents(spark, ["a b", "c"]).withColumn("tokens", F.lit(1))
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS)
    assert {bytes(r.decoded) for r in back.collect()} == {b"a b", b"c"}
    again = bpe.encode(docs.withColumn("IDS", F.lit("mine")), RANKS, PATTERN)
    assert again.columns == bpe.encode(docs, RANKS, PATTERN).columns
    counted = token_counts.token_counts(docs.withColumn("n_bytes", F.lit("mine")), JSON, PATTERN)
    assert sorted(r.n_bytes for r in counted.collect()) == [1, 3]
    codec = bpe.Codec(RANKS, PATTERN)
    with pytest.raises(ValueError, match="vocabulary"):
        codec.decode([[1 << 20]])


def test_counts_and_prefixes_equal_library():
    texts = odd_texts(2, 2500)
    counter = token_counts.TextCounter(JSON, PATTERN)
    assert counter.totals(texts) == counts_of(texts)
    for text in odd_texts(3, 500):
        if len(text) < 100:
            want = counts_of([text[:i] for i in range(len(text) + 1)])
            assert counter.prefixes(text) == want, text


def test_count_documents(spark, odd, none):
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
           for r in token_counts.count_documents(odd, JSON, PATTERN).collect()}
    texts = [t or "" for _, t in ODD]
    assert got == {(d, len(t.encode()), n, n > 512)
                   for (d, _), t, n in zip(ODD, texts, counts_of(texts))}
    assert token_counts.count_documents(none, JSON, PATTERN).count() == 0


def test_block_tables_equal_the_prefixes_of_each_text():
    counter = token_counts.TextCounter(JSON, PATTERN)
    texts = odd_texts(7, 400) + ["", " ", "naïve. Ärger, (ß)! x", "a  b", "x <|endoftext|> y z"]
    table, sizes = counter.tables(texts)
    assert sizes.tolist() == [len(t) for t in texts]
    at = 0
    for text, n in zip(texts, sizes.tolist()):
        assert [0, *table[at:at + n].tolist()] == counter.prefixes(text), text
        at += n


def test_prefix_tables_of_long_texts():
    """Prefixes of texts above 10,000 characters, against the library."""
    rnd = random.Random(9)
    long = [" ".join(rnd.choice(odd_texts(rnd.randrange(50), 30)).strip() for _ in range(1500))
            for _ in range(2)]
    long.append(" ".join(f"word{i}, it's {i * 7}" for i in range(1500)))
    assert min(map(len, long)) > 10_000
    counter = token_counts.TextCounter(JSON, PATTERN)
    table, sizes = counter.tables(long)
    at = 0
    for text, n in zip(long, sizes.tolist()):
        spots = sorted({*rnd.sample(range(1, len(text)), 40), len(text)})
        assert [int(table[at + i - 1]) for i in spots] == counts_of([text[:i] for i in spots])
        at += n


def test_count_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = token_counts.count_documents(docs, JSON, PATTERN).collect()
    assert [r.n_tokens for r in rows] == counts_of([texts[r.doc_id] for r in rows])
    for r in rows:
        assert r.over_limit == (r.n_tokens > 512)
        assert (r.n_chars_within == len(texts[r.doc_id])) == (not r.over_limit)
    cut = [texts[r.doc_id][:r.n_chars_within] for r in rows if r.over_limit]
    assert cut and max(counts_of(cut)) <= 512
    more = [texts[r.doc_id][:r.n_chars_within + 1] for r in rows if r.over_limit]
    assert min(counts_of(more)) > 512


def test_budget_questions(spark):
    text = "Truncation answers, without encoding again: 12345 x"
    table = token_counts.token_counts(documents(spark, [text]), JSON, PATTERN, prefixes=True)
    want = counts_of([text[:i] for i in range(len(text) + 1)])
    row = table.select(token_counts.tokens_in(F.col("prefix_tokens"), 20).alias("n"),
                       token_counts.tokens_in(F.col("prefix_tokens"), 999).alias("all"),
                       token_counts.longest_within(F.col("prefix_tokens"), 5).alias("fit")).first()
    assert (row.n, row["all"]) == (want[20], want[-1])
    assert row.fit == max(i for i, n in enumerate(want) if n <= 5)
