"""Personal data by weak supervision (native).

Candidates are all matches of the base patterns (also those that fail their
checks) and of a wider pattern for secrets, credentials and personal numbers.
Four labelers vote on each: the regex labeler (checks such as Luhn), the
gazetteer labeler (words that name personal data, or other numbers), the
context labeler (cue words before, letters glued to it) and the shape labeler.
Expectation-maximisation over the vote patterns of the corpus estimates how
reliable they are (``weak.py``). With the posteriors as soft labels a naive
Bayes span classifier is trained on features of the spans; candidates that it
accepts are added to the base spans unless they overlap one.

The regexes only start where a match can start and never backtrack into a run,
so they take linear time: dots and separators inside a domain or a card number
are first turned into marks (one character for one, so offsets stay).

Defined cases: null and empty texts have no spans; texts are searched whole;
repeated rows are searched each by itself; spans are ordered by start and then
kind; without candidates (or with an empty table) the result has no spans. Only
doc_id and the text are read; ``redacted`` passes other columns through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import packed, replaced, staged, unpacked, whole_text
from cartwright.llm.weak import VoteModel, learn

#: base kinds in their order, then the kinds that the method adds
BASE = ["email", "ip", "card", "phone"]
ADDED = ["secret", "credential", "national_id", "local_phone"]
KINDS = BASE + ADDED

_DOT, _GAP = "\u0002", "\u0001"
_LOCAL = r"A-Za-z0-9._%+\x02-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\x02[A-Za-z0-9\x02-]*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x01]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?:A[KS]IA[A-Z0-9]{16,}+|gh[pousr]_[A-Za-z0-9]{30,}+|"
              r"xox[abp]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    "credential": r"(?i)(?<![a-z])(?:password|passwd|pwd|token|secret|api_?key)\x20{0,2}[=:]\x20{0,2}"
                  r"[\x22']?[A-Za-z0-9_+/.\x2D]{6,}+[\x22']?",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+(.)\x20-])\x20?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}

#: gazetteer: words that name personal data, and words that name other numbers
NAMES_DATA = ("password passwd pwd token secret key akia email mail mailto phone tel mobile fax card "
              "visa ssn passport iban account kennwort telefon correo mot clave").split()
NAMES_OTHER = ("version page chapter section article figure table isbn issn doi vol volume no nr "
               "line release build seite kapitel pagina capitulo").split()
#: context: cues shortly before a span
CUES = ("call contact reach write send from to by at login user signed dial ring pay charge "
        "ip host server address with").split()
#: characters of context that are kept on either side
BEFORE, AFTER = 40, 8

RULES = ["votes_regex", "votes_gazetteer", "votes_context", "votes_shape"]
ACCEPT = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check: every second one from the right doubled."""
    one = lambda c, i: F.when(i % 2 == 0, c).when(c > 4, 2 * c - 9).otherwise(2 * c)
    numbers = F.transform(F.array_remove(F.split(F.reverse(digits), ""), ""),
                          lambda c: c.cast("int"))
    total = F.aggregate(F.transform(numbers, one), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == "card", F.when(n.between(14, 19), _luhn(_digits(value))).otherwise(False))
            .when(kind == "phone", n.between(10, 15))
            .otherwise(False))


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__found``: matches (kind, number, gap, value, before, after) of each text.

    ``gap`` is the length of the text between the match before and this one.
    Every pattern needs a digit or an @, except for words without digits after a
    credential's name; texts with none of these are not searched.
    """
    out = df.withColumn("__text", F.when(
        F.col(text).rlike(r"[0-9@=:]"), F.translate(whole_text(text), _GAP + _DOT, "\u0003\u0003")))
    dotted = F.regexp_replace("__text", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)
    joined = F.regexp_replace("__text", r"(?<=[0-9])[\x20-](?=[0-9])", _GAP)
    out = (out.withColumn("__dotted", F.when(F.contains("__text", F.lit("@")), dotted))
           .withColumn("__joined", F.when(F.col("__text").rlike("[0-9]"), joined)))
    source = {"email": "__dotted", "card": "__joined"}
    for kind, pattern in PATTERNS.items():
        column = F.col(source.get(kind, "__text"))
        if kind not in ("email", "credential"):
            column = F.when(F.col("__joined").isNotNull(), column)
        out = out.withColumn(f"__gaps_{kind}", F.split(column, pattern, -1))
        out = out.withColumn(f"__hits_{kind}", F.when(
            F.size(f"__gaps_{kind}") > 1, F.regexp_extract_all(column, F.lit(pattern), F.lit(0))))

    def told(kind: str) -> Column:
        gaps = F.col(f"__gaps_{kind}")
        plain = lambda c: F.translate(c, _GAP + _DOT, " .")
        return F.coalesce(F.transform(f"__hits_{kind}", lambda value, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("number"),
            F.length(F.get(gaps, i)).cast("long").alias("gap"), plain(value).alias("value"),
            plain(F.substring(F.get(gaps, i), -BEFORE, BEFORE)).alias("before"),
            plain(F.substring(F.get(gaps, i + 1), 1, AFTER)).alias("after"))),
            F.array().cast("array<struct<kind:string,number:int,gap:bigint,value:string,"
                           "before:string,after:string>>"))

    out = out.withColumn("__found", F.concat(*map(told, PATTERNS)))
    return out.select(*df.columns, "__found")


def located(found: DataFrame) -> DataFrame:
    """One row for each candidate of (row, __found), with offsets, votes and features."""
    each = found.select("row", F.explode("__found").alias("c")).select("row", "c.*")
    upto = Window.partitionBy("row", "kind").orderBy("number").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    size = F.length("value")
    each = each.withColumn("end", F.sum(F.col("gap") + size).over(upto))
    each = (each.withColumn("start", F.col("end") - size)
            .withColumn("valid", _valid(F.col("kind"), F.col("value"))))
    digits = F.length(_digits(F.col("value")))
    last_word = F.lower(F.regexp_extract("before", r"([A-Za-z_]+)[^A-Za-z]{0,3}$", 1))
    first_word = F.lower(F.regexp_extract("value", r"^([A-Za-z]+)", 1))
    glued = (F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]"))
    strict = F.col("kind").isin("secret", "national_id")
    cue = F.lower("before").rlike(rf"\b(?:{'|'.join(CUES + NAMES_DATA)})\b")
    return (each
            .withColumn("votes_regex", F.when(F.col("valid") | strict, 1)
                        .when(F.col("kind").isin(*BASE), 0).otherwise(-1))
            .withColumn("votes_gazetteer",
                        F.when(last_word.isin(*NAMES_DATA) | first_word.isin(*NAMES_DATA), 1)
                        .when(last_word.isin(*NAMES_OTHER), 0).otherwise(-1))
            .withColumn("votes_context", F.when(glued, 0).when(cue, 1).otherwise(-1))
            .withColumn("votes_shape", F.when((size >= 9) & ((digits >= 4) | F.contains(
                "value", F.lit("@"))), 1).when((digits < 7) & (size < 9), 0).otherwise(-1))
            .withColumn("features", F.array(
                F.concat(F.lit("kind="), "kind", F.lit("/"), F.col("valid").cast("string")),
                F.concat(F.lit("size="), F.least(F.floor(size / 4), F.lit(12)).cast("string")),
                F.concat(F.lit("digits="), F.floor(digits * 4 / size).cast("string")),
                F.concat(F.lit("glued="), glued.cast("string")),
                F.concat(F.lit("cue="), cue.cast("string")),
                F.concat(F.lit("gazetteer="), F.col("votes_gazetteer").cast("string"))))
            .drop("gap", "before", "after", "number"))


def start_model() -> VoteModel:
    return VoteModel(RULES, 0.5, [0.9, 0.9, 0.7, 0.9], [0.1, 0.3, 0.4, 0.3])


def train(spans: DataFrame) -> Column:
    """P(personal) as a column of the spans, from the classifier trained on all of them.

    The classifier's table has one row for each feature value, some 60 in all.
    """
    model = learn(spans.select(*RULES), start_model())
    soft = spans.withColumn("p", model.posterior())
    sums = soft.agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("f")).first()
    true_all, false_all = (sums["t"] or 0.0) + 1, (sums["f"] or 0.0) + 1
    weights = {r["feature"]: math.log((r["t"] + 0.5) / (true_all + 1) * (false_all + 1) / (r["f"] + 0.5))
               for r in soft.select(F.explode("features").alias("feature"), "p")
               .groupBy("feature").agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("f"))
               .collect()}
    table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv]) if weights \
        else F.create_map(F.lit(""), F.lit(0.0))
    total = F.aggregate("features", F.lit(math.log(true_all / false_all)),
                        lambda s, f: s + F.coalesce(table[f], F.lit(0.0)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def accepted(spans: DataFrame) -> DataFrame:
    """Base spans and the candidates that the classifier adds, none overlapping a base span.

    Adds ``is_base`` and ``order`` (the kind's place).
    """
    judged = (spans.withColumn("is_base", F.col("valid"))
              .withColumn("order", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
              .withColumn("p", train(spans))
              .filter(F.col("is_base") | (F.col("kind").isin(*ADDED) & (F.col("p") >= ACCEPT))))
    by = Window.partitionBy("row").orderBy("start", "order")
    base_end = F.max(F.when(F.col("is_base"), F.col("end"))).over(
        by.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("is_base"), F.col("start"))).over(
        by.rowsBetween(1, Window.unboundedFollowing))
    free = ((F.coalesce(base_end, F.lit(0)) <= F.col("start"))
            & (F.coalesce(base_start, F.col("end")) >= F.col("end")))
    return judged.withColumn("free", free).filter(F.col("is_base") | F.col("free")).drop("free")


def find_documents(df: DataFrame) -> DataFrame:
    """Counts, base digest and spans for every document."""
    found = candidates(df.select("doc_id", "text")).drop("text")
    found = staged(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    spans = accepted(staged(located(found), "located"))
    shown = F.concat_ws(":", "kind", "start", "end")
    per_row = spans.groupBy("row").agg(
        *[F.count(F.when(F.col("is_base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.sort_array(F.collect_list(F.struct("start", "order", "is_base", shown.alias("shown"))))
        .alias("all"))
    joined = found.select("row", "doc_id").join(per_row, "row", "left")
    every = F.coalesce("all", F.array().cast(
        "array<struct<start:bigint,order:bigint,is_base:boolean,shown:string>>"))
    base = F.array_join(F.transform(F.filter(every, lambda s: s["is_base"]), lambda s: s["shown"]), ",")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(every, lambda s: s["shown"]), ",").alias("spans"))


def redacted(df: DataFrame) -> DataFrame:
    """The rows with every accepted span replaced by <KIND>; where spans overlap, once.

    Only rows with candidates are staged and joined, the others pass straight
    through.
    """
    marked = candidates(packed(df))
    some = F.size("__found") > 0
    hit = staged(marked.filter(some).withColumn("row", F.monotonically_increasing_id()), "hits")
    spans = accepted(staged(located(hit.select("row", "__found")), "located"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "order").rowsBetween(
        Window.unboundedPreceding, -1))
    cuts = (spans.withColumn("start", F.greatest("start", F.coalesce(before, F.lit(0))))
            .filter("start < end").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                "start", "end", F.concat(F.lit("<"), F.upper("kind"), F.lit(">")).alias("label"))))
                .alias("__cuts")))
    joined = hit.join(cuts, "row", "left")
    text = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(
        replaced(F.col("text"), F.col("__cuts")))
    return unpacked(marked.filter(~some), df.columns).union(unpacked(joined, df.columns, text))
