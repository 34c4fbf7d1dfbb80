"""License scan: tags and notice phrases by Aho-Corasick, expressions by shunting-yard.

The words of a text (ASCII lower case) run through one automaton of all known
phrases. Phrases that are joined by "and", "or" or "with" (with nothing but
filler words between) and the values of ``SPDX-License-Identifier:`` tags are
licence expressions; a shunting-yard parser orders their operators (with before
and before or) and evaluates how much they restrict a user: "or" lets the user
choose (the smaller value), "and" binds to both (the larger value), "with"
grants an exception (half the value). A document's score is the largest value
of its expressions, 0 without any.

Defined cases: null and empty texts have no words, no labels and score 0; a
malformed expression counts as all its identifiers joined by "and"; identifiers
that are not known count like all rights reserved if in a tag; repeated rows are
scanned each by itself; texts are scanned whole. Other columns pass through,
except those with a name that the operator adds: they are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.bpe import blocks, widened, with_columns

# fixed values: the base phrases with their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: notice phrases of the method, as words, with the licence they name
NOTICES = {
    "mit license": "MIT", "mit licence": "MIT",
    "apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0",
    "apache 2 0": "Apache-2.0",
    "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause",
    "simplified bsd license": "BSD-2-Clause", "new bsd license": "BSD-3-Clause",
    "isc license": "ISC", "unlicense": "Unlicense", "public domain": "public-domain",
    "mozilla public license version 2 0": "MPL-2.0", "mozilla public license 2 0": "MPL-2.0",
    "eclipse public license 2 0": "EPL-2.0",
    "gnu general public license version 2": "GPL-2.0",
    "gnu general public license version 3": "GPL-3.0", "gnu gpl v3": "GPL-3.0",
    "gnu gpl v2": "GPL-2.0",
    "gnu lesser general public license": "LGPL", "gnu affero general public license": "AGPL",
    "cc0": "CC0-1.0", "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by nc 4 0": "CC-BY-NC-4.0", "cc by nd 4 0": "CC-BY-ND-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nc nd 4 0": "CC-BY-NC-ND-4.0",
    "creative commons attribution": "CC-BY",
    "classpath exception": "Classpath-exception", "llvm exception": "LLVM-exception",
}

#: how much a label restricts use; the first prefix of a label that fits counts
RESTRICTION = {
    "public-domain": 0.0, "CC0": 0.0, "Unlicense": 0.0, "MIT": 0.1, "ISC": 0.1, "BSD": 0.1,
    "Apache": 0.15, "cc-by": 0.25, "CC-BY-NC": 0.7, "CC-BY-ND": 0.6, "CC-BY-SA": 0.4,
    "CC-BY": 0.2, "MPL": 0.4, "EPL": 0.45, "LGPL": 0.5, "AGPL": 0.8, "GPL": 0.65, "gpl": 0.6,
    "reserved": 1.0,
}
UNKNOWN = 1.0
#: words that may stand between the phrases of one expression
FILLERS = frozenset("the a under terms of license licence version either both any later at your "
                    "option and or with".split())
OPERATORS = {"or": 1, "and": 2, "with": 3}
#: most words between two phrases of one expression
GAP = 6

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))
#: the words of an identifier tag, how it is written, and the words of a text with their places
TAG = "spdx license identifier"
_TAG_MARK = "spdx-license-identifier:"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TAG_PART = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")


def words_of(text: str) -> list[bytes]:
    """The words of a text: runs of ASCII letters and digits and of other characters."""
    return text.encode().translate(_WORDS).split()


def restriction(label: str) -> float:
    return next((v for k, v in RESTRICTION.items() if label.startswith(k)), UNKNOWN)


def to_postfix(parts: list[str]) -> list[str]:
    """Shunting-yard: operands in order, each operator behind its operands."""
    out: list[str] = []
    waiting: list[str] = []
    for part in parts:
        rank = OPERATORS.get(part.lower())
        if part == "(":
            waiting.append(part)
        elif part == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("unopened parenthesis")
            waiting.pop()
        elif rank:
            while waiting and waiting[-1] != "(" and OPERATORS[waiting[-1]] >= rank:
                out.append(waiting.pop())
            waiting.append(part.lower())
        else:
            out.append(part)
    while waiting:
        if waiting[-1] == "(":
            raise ValueError("unclosed parenthesis")
        out.append(waiting.pop())
    return out


def evaluate(parts: list[str]) -> float:
    """Restriction of a licence expression given as its parts."""
    try:
        stack: list[float] = []
        for part in to_postfix(parts):
            if part not in OPERATORS:
                stack.append(restriction(part))
                continue
            right, left = stack.pop(), stack.pop()
            stack.append({"or": min(left, right), "and": max(left, right),
                          "with": left / 2}[part])
        (value,) = stack
        return value
    except (ValueError, IndexError):
        names = [p for p in parts if p not in "()" and p.lower() not in OPERATORS]
        return max(map(restriction, names), default=0.0)


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE, TAG: ""}:
        found.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    found.make_automaton()
    return found


def scan(text: str) -> tuple:
    """(n_words, base places, places, expressions, labels, score) of a text."""
    words = words_of(text)
    joined = b" ".join(words).decode("latin-1")
    hits = [(end - len(phrase) - 1, phrase, size)
            for end, (phrase, size) in automaton().iter(f" {joined} ")] if words else []
    places: list[tuple[int, int, str]] = []  # first word, words, phrase
    if hits:
        spaces = [i for i, c in enumerate(f" {joined}") if c == " "]
        places = sorted((bisect_right(spaces, at) - 1, size, phrase) for at, phrase, size in hits)
    tags = [first for first, _, phrase in places if phrase == TAG]
    places = [p for p in places if p[2] != TAG]
    base = [p for p in places if p[2] in BASE]
    expressions = _sentences(words, places) + [_TAG_PART.findall(v) for v in _tagged(text, tags)]
    expressions = [e for e in expressions if e]
    labels = {BASE[p] for _, _, p in base} | {
        part for e in expressions for part in e
        if part not in "()" and part.lower() not in OPERATORS}
    score = max(map(evaluate, expressions), default=0.0)
    return len(words), base, places, expressions, labels, score


def _tagged(text: str, tags: list[int]) -> list[str]:
    """What stands behind the tags, up to the end of their lines; tags: their first words."""
    if not tags:
        return []
    wanted, out = set(tags), []
    for i, word in enumerate(_WORD.finditer(text)):
        start = word.start()
        if i in wanted and text[start:start + len(_TAG_MARK)].lower() == _TAG_MARK:
            rest = text[start + len(_TAG_MARK):]
            out.append(re.split(r"[\r\n]", rest, maxsplit=1)[0])
    return out


def _sentences(words: list[bytes], places: list[tuple[int, int, str]]) -> list[list[str]]:
    """Expressions that the phrases make; of overlapping phrases the longest, earliest."""
    kept: list[tuple[int, int, str]] = []
    for place in sorted(places, key=lambda p: (p[0], -p[1])):
        if kept and place[0] < kept[-1][0] + kept[-1][1]:
            if place[1] <= kept[-1][1]:
                continue
            kept.pop()
        kept.append(place)
    out: list[list[str]] = []
    end = None
    for first, size, phrase in kept:
        label = NOTICES.get(phrase) or BASE[phrase]
        between = [w.decode("latin-1") for w in words[end:first]] if (
            end is not None and first - end <= GAP) else None
        links = [w for w in between if w in OPERATORS] if between else []
        if links and FILLERS.issuperset(between):
            out[-1] += [links[-1], label]
        else:
            out.append([label])
        end = first + size
    return out


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, places, expressions, labels and the restriction score."""
    place = T.StructType([T.StructField("first_word", T.LongType()),
                          T.StructField("n_words", T.LongType()),
                          T.StructField("phrase", T.StringType()),
                          T.StructField("base_label", T.StringType())])
    rest, schema = widened(df, n_words=T.LongType(), places=T.ArrayType(place),
                           expressions=T.ArrayType(T.StringType()), labels=T.ArrayType(T.StringType()),
                           score=T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()),
                                   ("phrase", pa.string()), ("base_label", pa.string())]))
        for block in blocks(batches, text):
            rows = [scan(x or "") for x in block.column(text).to_pylist()]
            yield with_columns(
                block, n_words=pa.array([r[0] for r in rows], pa.int64()),
                places=pa.array([[{"first_word": a, "n_words": n, "phrase": p,
                                   "base_label": BASE.get(p)} for a, n, p in r[2]]
                                 for r in rows], kind),
                expressions=pa.array([[" ".join(e) for e in r[3]] for r in rows],
                                     pa.list_(pa.string())),
                labels=pa.array([sorted(r[4]) for r in rows], pa.list_(pa.string())),
                score=pa.array([r[5] for r in rows], pa.float64()))

    return rest.mapInArrow(run, schema)


def scan_documents(df: DataFrame) -> DataFrame:
    """Words, base places, labels and score for every document."""
    found = scan_licenses(df.select("doc_id", "text")).drop("text")
    base = F.filter("places", lambda p: p["base_label"].isNotNull())
    starts = F.transform(base, lambda p: p["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda p: p["base_label"]))),
                     ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
