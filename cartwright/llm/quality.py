"""Quality rules under weak supervision (native).

Nine rules on surface features vote good, bad or abstain; their reliabilities
come from expectation-maximisation over the vote patterns of all documents
(``weak.py``), and a document is kept if its posterior quality probability is
at least one half. A document that trips one unreliable rule is therefore not
lost, as it would be if all rules had to pass. Before that, a base filter
rejects documents of fewer than 20 words or with more than 30 % of their words
in repeated 8-word windows.

Windows are compared by 64-bit hashes within one document (two different
windows of a document of n words collide with probability below n^2 / 2^65).

Defined cases: null and empty texts have no words, zero counts and fail the
base filter; long texts are measured whole, each within its own row; repeated
rows are judged alike; an empty table gives an empty result (the starting model
is never used). ``judge`` passes other columns through, except those with a name
that it adds: they are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import staged, whole_text, without
from cartwright.llm.weak import VoteModel, learn

# fixed values: white space between words, symbols that count, window, base limits
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

#: rule -> (measure, bad beyond, good up to); larger measures are worse
RULES = {
    "symbols": ("symbols_per_word", 0.2, 0.02),
    "edge_symbols": ("edge_symbols_per_word", 0.1, 0.02),
    "capitals": ("capital_share", 0.3, 0.12),
    "shouting": ("marks_per_word", 0.2, 0.05),
    "repetition": ("repeat_share", 0.3, 0.1),
    "poor_words": ("word_poverty", 0.45, 0.33),
    "same_lines": ("dup_line_share", 0.5, 0.1),
    "word_length": ("word_length_off", 5.0, 2.5),
    "open_lines": ("open_line_share", 0.6, 0.2),
}


#: columns that ``judge`` adds
ADDED = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
         "n_distinct", "n_edge_symbols", "n_capitals", "n_marks", "n_open_lines", *RULES,
         "quality", "base_failed", "kept"]


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Struct array (hash, place) of all windows, sorted."""
    windows = F.transform(F.sequence(F.lit(1), n_words - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n_words > WINDOW, windows)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures and the measures that the rules read.

    Each step is a projection of its own, so that the arrays of words, lines
    and windows are made once per row.
    """
    out = df.withColumn("__text", whole_text(text))
    out = out.withColumn("__words", F.array_remove(F.split("__text", SPACE), ""))
    out = out.withColumn("n_words", F.size("__words").cast("long"))
    out = out.withColumn("__windows", _repeat_words(F.col("__words"), F.size("__words")))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(NOT_SPACE))
    out = out.withColumn("__lines", lines)
    # only documents in which a window's hash comes twice go through the sorting below
    out = out.withColumn("__again", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.size("__again") - 1
    same = lambda p, j: F.get("__again", j)["h"] == p["h"]
    places = F.sort_array(F.transform(
        F.filter("__again", lambda p, k: ((k > 0) & same(p, k - 1)) | ((k < last) & same(p, k + 1))),
        lambda p: p["i"]))
    out = out.withColumn("__places", places)
    covered = F.aggregate(
        F.transform("__places", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get("__places", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    return (out
            .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count("__text", F.lit(SYMBOLS)).cast("long"))
            .withColumn("n_lines", F.size("__lines").cast("long"))
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines")))
                        .cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .withColumn("n_distinct", F.size(F.array_distinct("__words")))
            .withColumn("n_edge_symbols",
                        F.regexp_count("__text", F.lit(SYMBOLS + r"(?:[\x20\x09-\x0D]|$)")))
            .withColumn("n_capitals", F.regexp_count("__text", F.lit("[A-Z]")))
            .withColumn("n_marks", F.regexp_count("__text", F.lit("!")))
            .withColumn("n_open_lines", F.size(F.filter(
                "__lines", lambda x: ~x.rlike(r"[.!?:;\"'”»)][\x20\x09-\x0D]*$"))))
            .drop("__text", "__words", "__windows", "__again", "__places", "__lines"))


def votes(measured: DataFrame) -> DataFrame:
    """Add a vote column for each rule: 1 good, 0 bad, -1 abstains (as without words)."""
    n = F.col("n_words")
    per_word = lambda c: F.col(c) / n
    measures = {
        "symbols_per_word": per_word("n_symbols"),
        "edge_symbols_per_word": per_word("n_edge_symbols"),
        "capital_share": F.col("n_capitals") / F.col("word_chars"),
        "marks_per_word": per_word("n_marks"),
        "repeat_share": per_word("n_repeat_words"),
        # few different words for the length: 1 / (distinct / sqrt(words))
        "word_poverty": F.sqrt(n) / F.col("n_distinct"),
        "dup_line_share": F.col("n_dup_lines") / F.col("n_lines"),
        "word_length_off": F.abs(F.col("word_chars") / n - 6),
        "open_line_share": F.col("n_open_lines") / F.col("n_lines"),
    }
    out = measured
    for rule, (name, bad, good) in RULES.items():
        vote = F.when(n == 0, -1).when(measures[name] > bad, 0).when(measures[name] <= good, 1)
        out = out.withColumn(rule, vote.otherwise(-1))
    return out


def start_model() -> VoteModel:
    """Most documents are good; a rule rarely calls a good one bad, and sees some junk only."""
    k = len(RULES)
    return VoteModel(list(RULES), 0.8, [0.95] * k, [0.7] * k)


def decide(voted: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept."""
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    return (voted.withColumn("quality", model.posterior())
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("quality") >= threshold)))


def judge(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add the measures, the votes, base_failed, quality and kept to every row.

    The rows are staged with their measures (and all their columns), so that the
    texts are measured once although the model needs a pass of its own over all rows.
    """
    voted = votes(staged(measure(without(df, *ADDED), text), "quality"))
    return decide(voted, learn(voted.select(*RULES), start_model()), threshold)


def judge_documents(df: DataFrame) -> DataFrame:
    """The digest for every document; texts are measured once and left behind."""
    voted = votes(staged(measure(df.select("doc_id", "text")).drop("text"), "quality"))
    return decide(voted, learn(voted.select(*RULES), start_model())).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality")
