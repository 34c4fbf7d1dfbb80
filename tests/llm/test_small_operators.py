"""Sharding, licence scan, quality votes and unit dedup against brute force."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cartwright.llm import licenses, quality, sharding, unit_dedup, weak

from .conftest import ODD, documents, prose


def jump(key: int, shards: int) -> int:
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(spark, odd, none):
    rows = sharding.shard_documents(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25))
        assert r.grown_shard in (r.shard, 24)
    sums = collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert sums == collections.Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in ODD)
    assert sharding.shard_documents(none).count() == 0


def test_slots_are_gapless_with_a_hot_key(spark):
    rows = [(7 if i % 3 == 0 else i, f"t{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = sharding.shard_documents(docs, 5).collect()
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append((r.slot, r.doc_id, r.text_crc32))
    for slots in by.values():
        slots.sort()
        assert [s for s, _, _ in slots] == list(range(len(slots)))
        assert [x[1:] for x in slots] == sorted(x[1:] for x in slots)


def test_string_keys_and_bad_counts(spark):
    docs = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "name string, text string")
    found = sharding.assign_shards(docs, 9, key="name").collect()
    assert len({r.shard for r in found if r.name == "a"}) == 1
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, 0, key="name")


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def base_places(text: str) -> list[tuple[int, str]]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), sorted((i, label) for phrase, label in PHRASES.items()
                              for i in range(len(words))
                              if words[i:i + phrase.count(" ") + 1] == phrase.split())


def parsed(parts: list[str]) -> float:
    """Restriction of an expression by recursive descent; of a malformed one its strictest name."""
    at = 0

    def peek() -> str:
        return parts[at].lower() if at < len(parts) else ""

    def chain_of(word: str, below, combine):
        nonlocal at
        value = below()
        while peek() == word:
            at += 1
            value = combine(value, below())
        return value

    def atom() -> float:
        nonlocal at
        if peek() == "(":
            at += 1
            value = either()
            if peek() != ")":
                raise ValueError("unclosed")
            at += 1
            return value
        if peek() in ("", ")", "or", "and", "with"):
            raise ValueError("no name")
        at += 1
        return licenses.restriction(parts[at - 1])

    def either() -> float:
        return chain_of("or", lambda: chain_of("and", lambda: chain_of(
            "with", atom, lambda x, _: x / 2), max), min)

    try:
        value = either()
        if at < len(parts):
            raise ValueError("more")
        return value
    except ValueError:
        return max((licenses.restriction(p) for p in parts
                    if p.lower() not in ("(", ")", "or", "and", "with")), default=0.0)


def plain_scan(text: str) -> tuple:
    """Words, base places, labels and score of a text, from its list of words."""
    n, base = base_places(text)
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    known = {tuple(k.split()): v for k, v in {**licenses.BASE, **licenses.NOTICES}.items()}
    spots = [(i, size, known[tuple(words[i:i + size])]) for i in range(n)
             for size in sorted({len(k) for k in known}, reverse=True)
             if i + size <= n and tuple(words[i:i + size]) in known]
    kept: list = []
    for spot in spots:
        if kept and spot[0] < kept[-1][0] + kept[-1][1]:
            if spot[1] <= kept[-1][1]:
                continue
            kept.pop()
        kept.append(spot)
    expressions: list[list[str]] = []
    end = None
    for first, size, label in kept:
        between = words[end:first] if end is not None and first - end <= licenses.GAP else []
        links = [w for w in between if w in ("or", "and", "with")]
        if links and set(between) <= licenses.FILLERS:
            expressions[-1] += [links[-1], label]
        else:
            expressions.append([label])
        end = first + size
    tags = re.findall(r"(?<![0-9A-Za-z\x80-\U0010ffff])spdx-license-identifier:([^\r\n]*)", text,
                      re.IGNORECASE | re.ASCII)
    expressions += [re.findall(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*", t) for t in tags]
    expressions = [e for e in expressions if e]
    labels = {x for _, x in base} | {p for e in expressions for p in e
                                     if p.lower() not in ("(", ")", "or", "and", "with")}
    starts = [i for i, _ in base]
    return (n, len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)),
            max(map(parsed, expressions), default=0.0))


SCANNED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_license_scan_of_every_row(spark, odd, none):
    texts = ["CC-BY, CC BY!cc by", "All rights\nreserved. GNU General Public License, version 3",
             "ccby cc é by", "Licensed under the MIT License or the Apache License, Version 2.0.",
             "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0 WITH Classpath\nx\n"
             "// spdx-license-identifier:\tBSD-3-Clause\r\nSPDX-License-Identifier: MIT AND",
             "xspdx-license-identifier: MIT", "SPDX License Identifier: MIT", "é SPDX-License-Identifier:",
             "SPDX-License-Identifier: ) MIT (", "a" * 50 + " SPDX-License-Identifier: ISC OR MIT"]
    rows = [*enumerate(texts, 1000), *ODD]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], odd.schema)
    got = collections.Counter((r.doc_id, *(r[c] for c in SCANNED))
                              for r in licenses.scan_documents(docs).collect())
    assert got == collections.Counter((d, *plain_scan(t or "")) for d, t in rows)
    assert licenses.scan_documents(none).count() == 0


def test_license_scan_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = licenses.scan_documents(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in SCANNED) == plain_scan(texts[r.doc_id] or ""), r.doc_id
    assert sum(r.labels != r.base_labels for r in rows) > 0


def test_license_expressions():
    known = licenses.restriction
    assert licenses.to_postfix("A or B and C with D".split()) == "A B C D with and or".split()
    assert licenses.to_postfix("( A or B ) and C".split()) == "A B or C and".split()
    assert licenses.evaluate(["MIT", "OR", "GPL-3.0"]) == known("MIT")
    assert licenses.evaluate(["MIT", "AND", "GPL-3.0"]) == known("GPL-3.0")
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception AND MIT".split()) == known("GPL") / 2
    assert licenses.evaluate(["(", "MIT", "AND"]) == known("MIT")  # malformed
    assert licenses.evaluate([]) == 0.0
    found = licenses.scan("Dual: under the MIT License or the Apache License, Version 2.0.")
    assert found[3] == [["MIT", "or", "Apache-2.0"]] and found[5] == known("MIT")
    found = licenses.scan("# SPDX-License-Identifier: (MIT OR Apache-2.0) AND Unknown-1.0\nx")
    assert found[4] == {"MIT", "Apache-2.0", "Unknown-1.0"} and found[5] == licenses.UNKNOWN


def measures(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_quality_measures(spark, odd, none):
    rnd = random.Random(3)
    texts = [prose(rnd, 60) for _ in range(60)]
    texts += [t + "\n" + t[:200] + "\n" + t[:200] for t in texts[:10]]
    texts += [t.replace(" ", "%%% ") for t in texts[:8]] + [t.upper().replace(" ", "!! ")
                                                           for t in texts[:8]]
    docs = documents(spark, texts)
    rows = sorted(quality.judge_documents(docs).collect(), key=lambda r: r.doc_id)
    for r, text in zip(rows, texts):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == measures(text)
        assert r.kept <= (not r.base_failed)
    assert all(r.kept for r in rows[:60])
    assert not any(r.kept for r in rows[70:])
    got = collections.Counter((r.doc_id, r.n_words, r.n_repeat_words)
                              for r in quality.judge_documents(odd).collect())
    assert got == collections.Counter((d, measures(t or "")[0], measures(t or "")[4])
                                      for d, t in ODD)
    assert quality.judge_documents(none).count() == 0
    again = quality.judge(docs.withColumn("kept", F.lit("mine")).withColumn("Quality", F.lit(1)))
    assert again.filter("kept").count() == sum(r.kept for r in rows)


def test_expectation_maximisation_finds_reliabilities():
    rnd = random.Random(1)
    yes_true, yes_false = [0.9, 0.8, 0.7, 0.95], [0.2, 0.1, 0.4, 0.3]
    seen = collections.Counter()
    for _ in range(40_000):
        truth = rnd.random() < 0.7
        p = yes_true if truth else yes_false
        seen[tuple(-1 if rnd.random() < 0.1 else int(rnd.random() < q) for q in p)] += 1
    rules = list("abcd")
    model = weak.estimate(sorted(seen.items()), weak.VoteModel(rules, 0.5, [0.7] * 4, [0.3] * 4))
    assert abs(model.prior - 0.7) < 0.05
    assert all(abs(a - b) < 0.06 for a, b in zip(model.yes_if_true, yes_true))
    assert all(abs(a - b) < 0.08 for a, b in zip(model.yes_if_false, yes_false))


def units(text: str) -> list[tuple]:
    out = []
    for i, m in enumerate(re.finditer(r"[^.!?\n]+[.!?\n]*|[.!?\n]+", text)):
        words = re.sub(r"[\W_]+", " ", m.group().lower()).split()
        if len(words) >= 8:
            out.append((i, m.start(), m.end(), " ".join(words)))
    return out


def test_unit_dedup(spark, odd, none):
    rnd = random.Random(9)
    shared = prose(rnd, 60)
    texts = [prose(rnd, 80) for _ in range(30)]
    for i in range(0, 30, 3):  # inside a line
        words = texts[i].split(" ")
        texts[i] = " ".join(words[:20]) + ". " + shared.upper() + ". " + " ".join(words[20:])
    first, want = {}, set()
    for d, text in enumerate(texts):
        for i, start, end, words in units(text):
            if words in first:
                want.add((d, i, start, end, *first[words]))
            first.setdefault(words, (d, i))
    docs = documents(spark, texts)
    got = {(r.doc_id, r.unit, r.start, r.end, r.first_doc_id, r.first_unit)
           for r in unit_dedup.removed_from_documents(docs).collect()}
    assert got == want and {d for d, *_ in want} == set(range(3, 30, 3))
    named = docs.withColumn("removed", F.lit("mine")).withColumn("row", F.lit("mine"))
    cleaned = {r.doc_id: r for r in unit_dedup.deduplicated(named).collect()}
    for d, text in enumerate(texts):
        cut = sorted(x[2:4] for x in want if x[0] == d)
        assert [tuple(x) for x in cleaned[d].removed] == cut
        for start, end in reversed(cut):
            text = text[:start] + text[end:]
        assert cleaned[d].text == text
    assert unit_dedup.removed_from_documents(none).count() == 0
    assert unit_dedup.deduplicated(odd).count() == len(ODD)
    # the repeated long row loses its only unit, its earlier copy does not
    assert unit_dedup.removed_from_documents(odd).filter("doc_id = 9").count() == 1


def repeated_words(texts: list[str], size: int) -> dict[int, set[int]]:
    """Words of each text, by place, in a run of ``size`` words that an earlier text has."""
    seen, out = set(), {}
    for d, text in enumerate(texts):
        words = re.sub(r"[\W_]+", " ", text.lower()).split()
        runs = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
        out[d] = {i + k for i, run in enumerate(runs) if run in seen for k in range(size)}
        seen.update(runs)
    return out


def test_passages_of_short_sentences(spark, odd, none):
    rnd = random.Random(21)

    def short(n: int, most: int) -> str:
        out = ""
        while n > 0:
            size = min(n, rnd.randint(1, most))
            out += " ".join(prose(rnd, size).lower().replace(".", "").split()) + rnd.choice(
                [". ", "!! ", "\n"])
            n -= size
        return out

    planted = [short(50, 1), short(60, 4), short(55, 7)]
    texts = [prose(rnd, 40) + ". " + p + prose(rnd, 30) for p in planted]
    texts += [short(20, 6) + p + short(30, 6) for p in planted for _ in range(2)]
    texts += [texts[3], planted[0], "again. " * 200]
    docs = documents(spark, texts)
    cleaned = {r.doc_id: r for r in unit_dedup.deduplicated(docs, "passage").collect()}
    found = repeated_words(texts, 50)
    assert all(len(found[d]) >= 50 for d in range(3, 11)) and not any(found[d] for d in range(3))
    close = repeated_words(texts, unit_dedup.MIN_WORDS)
    for d in range(11):
        places = [m.start() for m in re.finditer(r"[^\W_]+", texts[d])]
        gone = {i for i, at in enumerate(places)
                for start, end in cleaned[d].removed if start <= at < end}
        assert found[d] <= gone <= close[d]
        assert len(cleaned[d].text) == len(texts[d]) - sum(e - s for s, e in cleaned[d].removed)
    assert cleaned[11].text.split() == ["again."] * unit_dedup.MIN_WORDS
    assert unit_dedup.removed_passages(none).count() == 0
    assert unit_dedup.deduplicated(odd, "passage").count() == len(ODD)
