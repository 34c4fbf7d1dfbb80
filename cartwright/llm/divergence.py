"""How far the sources of a language lie apart, by cubes of groups, groups and terms.

Groups are the (lang, source) pairs. Every language keeps the terms that stand
in at least ``LEAST_DOCS`` of its documents; a group's smoothed share of a term
is a whole number of billionths, and the divergence of two groups is the sum of
their terms' squared difference over sum.

The pairs are worked out in cells of a cube: a task owns (group block, group
block, term block). A group's slice of a term block is replicated to the cells
of its group block, one for each other block; a cell lays both blocks out
against the terms that occur there and adds up all pairs at once. The partial
sums are then reduced along the term axis. Terms that occur in neither block
of a cell all add the same, so only their number counts. A cell holds
``GROUP_BLOCK`` groups twice and about ``TERM_BLOCK`` terms, whatever the input.

Terms are counted in the tasks first, so a frequent term or a source with a
third of all documents is one row a task in the shuffle.

Defined cases: null text, lang and source count as empty; documents without
terms still make their group; a language without kept terms has divergence 0
between its sources and no term rows; a language with one source has no pairs;
repeated rows count each; ties are ranked by the item's UTF-8 bytes; texts are
taken whole; an empty table gives an empty result. Only text, lang and source
are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import staged

LEAST_DOCS = 10
TOP_TERMS = 10
GROUP_BLOCK = 8
TERM_BLOCK = 4_096
#: different (group, term) counts that a task gathers before it passes them on
HELD = 300_000
#: rows of a batch that a task passes on
ROWS = 50_000

# letters and all characters beyond ASCII make terms, other ASCII parts them
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of letters and characters beyond ASCII, with A to Z lower-cased, as UTF-8."""
    return text.encode().translate(_FOLD).split()


def occurrences(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), counted in each task; a null term counts documents."""
    def rows(n: dict, docs: dict, groups: Counter) -> Iterator[pa.RecordBatch]:
        out = [(g, t, c, docs[g][t]) for g, counts in n.items() for t, c in counts.items()]
        out += [(g, None, 0, c) for g, c in groups.items()]
        for at in range(0, len(out), ROWS):
            part = out[at:at + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g, *_ in part], pa.string()),
                 pa.array([g[1] for g, *_ in part], pa.string()),
                 pa.array([t for _, t, _, _ in part], pa.binary()).cast(pa.string()),
                 pa.array([c for _, _, c, _ in part], pa.int64()),
                 pa.array([d for _, _, _, d in part], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, docs, groups = defaultdict(Counter), defaultdict(Counter), Counter()
        for block in blocks(batches, "text"):
            for lang, source, text in zip(*(block.column(c).to_pylist()
                                            for c in ("lang", "source", "text"))):
                group = lang or "", source or ""
                groups[group] += 1
                found = Counter(terms_of(text or ""))
                n[group].update(found)
                docs[group].update(found.keys())
            if sum(map(len, n.values())) > HELD:
                yield from rows(n, docs, groups)
                n, docs, groups = defaultdict(Counter), defaultdict(Counter), Counter()
        yield from rows(n, docs, groups)

    return df.select("lang", "source", "text").mapInArrow(
        run, "lang string, source string, term string, n long, docs long")


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in billionths, plus one; exact for counts of any size."""
    whole = lambda x: x.cast("decimal(27,0)")
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * whole(n + 2)
    return F.call_function("div", top, whole(total + 2 * terms)).cast("long") + 1


def contribution(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def counted(df: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(groups, rows): shares of all groups, and of the kept terms that occur in a group.

    groups: lang, source, g (number in its language), n_groups, terms (kept in the
    language), rest (share of a term that does not occur). rows: lang, source, g,
    n_groups, term, p and the language's q.
    """
    counts = staged(occurrences(df).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    some = counts.filter("term is not null")
    kept = (some.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("lang_n"))
            .filter(F.col("d") >= least_docs).drop("d"))
    kept = staged(kept, "kept-terms")
    rows = staged(some.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"),
                                     F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term is null").select("lang", "source")
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_groups"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = (groups.withColumn("g", number).join(sizes, "lang")
              .join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
              .select("lang", "source", "g", "n_groups", zero("terms"), zero("lang_total"),
                      zero("total")))
    groups = groups.withColumn("rest", F.when(F.col("terms") > 0, share(
        F.lit(0), F.col("total"), F.col("terms"))).otherwise(1))
    groups = staged(groups, "groups")
    rows = rows.join(groups, ["lang", "source"]).select(
        "lang", "source", "g", "n_groups", "terms", "term",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    return groups, rows


def _slices(rows: DataFrame, group_block: int) -> DataFrame:
    """Every row once for each cell of its group block: (lang, i, j, k) with i <= j."""
    own = F.floor(F.col("g") / group_block)
    n_blocks = F.ceil(F.col("n_groups") / group_block)
    other = rows.withColumn("block", own.cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int"))))
    return other.select("lang", F.least("block", "other").alias("i"),
                        F.greatest("block", "other").alias("j"), "k", "block", "g", "source",
                        "terms", "term", "p")


def _cell(key: tuple, cell: pa.Table) -> pa.Table:
    """Sums over the terms of a cell, of all pairs of a group of block i and one of block j.

    The rows without a term name the groups of both blocks and give the share of
    terms that do not occur.
    """
    _, i, j, _ = (k.as_py() for k in key)
    heads = cell.filter(pc.is_null(cell["term"])).sort_by("g")
    rows = cell.filter(pc.is_valid(cell["term"]))
    g, rest, block = (heads[c].to_numpy() for c in ("g", "p", "block"))
    coded = rows["term"].combine_chunks().dictionary_encode()
    shares = np.repeat(rest[:, None], len(coded.dictionary), axis=1)
    shares[np.searchsorted(g, rows["g"].to_numpy()), coded.indices.to_numpy()] = (
        rows["p"].to_numpy())
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    a, b = np.array([(x, y) for x in left for y in right if x < y], np.int64).reshape(-1, 2).T
    value = np.empty(len(a), np.int64)
    for x in left:  # all pairs of one group at once
        p, q = shares[x][None, :], shares[b[a == x]]
        value[a == x] = ((p - q) ** 2 // (p + q)).sum(axis=1)
    source = heads["source"].combine_chunks()
    return pa.table({
        "lang": heads["lang"].combine_chunks().take(pa.array(a)),
        "a": source.take(pa.array(a)), "b": source.take(pa.array(b)), "value": value,
        "seen": np.full(len(a), len(coded.dictionary), np.int64),
        "terms": heads["terms"].to_numpy()[a],
        "apart": (rest[a] - rest[b]) ** 2 // (rest[a] + rest[b])})


def pair_divergences(groups: DataFrame, rows: DataFrame, group_block: int = GROUP_BLOCK,
                     term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, a before b."""
    n_blocks = lambda terms: F.greatest(F.ceil(terms / term_block), F.lit(1)).cast("int")
    placed = rows.withColumn("k", F.pmod(F.xxhash64("term"), n_blocks(F.col("terms"))).cast("int"))
    columns = ["lang", "source", "g", "n_groups", "terms", "term", "p", "k"]
    heads = groups.withColumn("term", F.lit(None).cast("string")).withColumn(
        "p", F.col("rest")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), n_blocks(F.col("terms")) - 1)))
    cells = _slices(placed.select(columns).union(heads.select(columns)), group_block)
    partial = cells.groupBy("lang", "i", "j", "k").applyInArrow(
        _cell, "lang string, a string, b string, value long, seen long, terms long, apart long")
    return (partial.groupBy("lang", "a", "b")
            .agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"),
                 F.max("terms").alias("terms"), F.max("apart").alias("apart"))
            .select("lang", "a", "b", F.when(F.col("terms") > 0, F.col("value") + (
                F.col("terms") - F.col("seen")) * F.col("apart")).otherwise(0).alias("value")))


def audit(df: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
          group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by divergence, and the terms
    that mark a source against its language."""
    groups, rows = counted(df, least_docs)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    marks = (rows.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        contribution(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))
    pairs = pair_divergences(groups, rows, group_block, term_block)
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = (pairs.select("lang", "value", sides.alias("s"))
            .select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
            .withColumn("rank", F.row_number().over(best)))
    return both.unionByName(marks)
