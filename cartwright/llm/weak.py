"""Weak supervision shared by the quality and personal-data operators (native).

Labelling rules vote 1 (yes), 0 (no) or abstain (-1). How often each rule votes
yes when the truth is yes or no is estimated by expectation-maximisation. The
sufficient statistics are the counts of vote patterns: one aggregate over all
rows, whose result has at most 3^rules rows however large the input is (rules
are limited to ``MAX_RULES`` for that reason). The iterations run over that
small table; the posterior of every row is a column expression again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 3^10 patterns at most, some 60,000 small rows
MAX_RULES = 10
ITERATIONS = 60
#: pseudo counts that keep estimates away from 0 and 1
SMOOTHING = 0.5


class VoteModel:
    """Prior and, for each rule, P(votes yes | true) and P(votes yes | false), given a vote."""

    def __init__(self, rules: list[str], prior: float, yes_if_true: list[float],
                 yes_if_false: list[float]):
        self.rules, self.prior = rules, prior
        self.yes_if_true, self.yes_if_false = yes_if_true, yes_if_false

    def log_odds(self, votes: tuple[int, ...]) -> float:
        total = math.log(self.prior / (1 - self.prior))
        for vote, t, f in zip(votes, self.yes_if_true, self.yes_if_false):
            if vote == 1:
                total += math.log(t / f)
            elif vote == 0:
                total += math.log((1 - t) / (1 - f))
        return total

    def posterior(self) -> Column:
        """P(true) of a row, from its vote columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, t, f in zip(self.rules, self.yes_if_true, self.yes_if_false):
            total = total + (F.when(F.col(rule) == 1, math.log(t / f))
                             .when(F.col(rule) == 0, math.log((1 - t) / (1 - f))).otherwise(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def estimate(patterns: list[tuple[tuple[int, ...], int]], start: VoteModel) -> VoteModel:
    """Expectation-maximisation over (votes, rows) from a starting model."""
    model = start
    rows = sum(n for _, n in patterns)
    if not rows:
        return start
    for _ in range(ITERATIONS):
        soft = [(votes, n, sigmoid(model.log_odds(votes))) for votes, n in patterns]
        true_rows = sum(n * p for _, n, p in soft)
        t, f = [], []
        for j in range(len(model.rules)):
            yes_t = no_t = yes_f = no_f = SMOOTHING
            for votes, n, p in soft:
                if votes[j] == 1:
                    yes_t, yes_f = yes_t + n * p, yes_f + n * (1 - p)
                elif votes[j] == 0:
                    no_t, no_f = no_t + n * p, no_f + n * (1 - p)
            t.append(yes_t / (yes_t + no_t))
            f.append(yes_f / (yes_f + no_f))
        model = VoteModel(model.rules, (true_rows + SMOOTHING) / (rows + 2 * SMOOTHING), t, f)
    return model


def learn(votes: DataFrame, start: VoteModel) -> VoteModel:
    """Estimate the model from all rows of a table with the rules' vote columns."""
    if len(start.rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, so that the pattern table stays small")
    counts = votes.groupBy(*start.rules).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((tuple(int(r[j]) for j in start.rules), int(r["n"])) for r in counts)
    return estimate(patterns, start)
