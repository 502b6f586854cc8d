"""Quality rules as a learned decision list.

Sequential covering in the way of RIPPER (Cohen 1995): a rule for bad documents grows one threshold
condition at a time by FOIL's information gain on two thirds of the rows, is pruned
backwards on the rest, and is kept if it is precise enough there; the bad rows it covers are taken
out and the next rule is grown.  The list becomes one ordered ``CASE WHEN`` over the statistics,
so applying it is a plain Spark expression that a reader can check.

The list is fitted on a bounded sample of labelled rows (``SAMPLE``); statistics cover all rows
and whole texts.  Without labels of both kinds the list is empty and keeps everything.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findry.llm.scratch import Scratch
from findry.llm.textstats import RATIOS, labelled_sample, statistics

# Labelled rows the list is fitted on, at most (expected number of a hash sample).
SAMPLE = 40_000
MAX_RULES = 24
MAX_CONDITIONS = 4
CUTS = 64
MIN_PRECISION = 0.97
MIN_COVER = 5


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x >= self.cut if self.above else x <= self.cut

    def column(self) -> Column:
        value = F.col(self.name)
        return value >= F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self):
        return f"{self.name} {'>=' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        out &= condition.holds(x[condition.name])
    return out


def _best_condition(x, bad, inside, cuts):
    """The condition with the highest FOIL gain among the rows inside the rule so far."""
    p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for name, edges in cuts.items():
        place = np.searchsorted(edges, x[name][inside], side="right")
        p = np.bincount(place[bad[inside]], minlength=len(edges) + 1)
        n = np.bincount(place[~bad[inside]], minlength=len(edges) + 1)
        # Cut i: at or above edges[i] are the places after i.
        for above in (True, False):
            pc = (p[::-1].cumsum()[::-1][1:] if above else p.cumsum()[:-1]).astype(float)
            nc = (n[::-1].cumsum()[::-1][1:] if above else n.cumsum()[:-1]).astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = np.where(pc > 0, pc * (np.log2(pc / (pc + nc)) - base), 0)
            i = int(gains.argmax())
            if gains[i] > gain:
                # Below means strictly below the edge, written with the largest value there.
                cut = edges[i] if above else np.nextafter(edges[i], -np.inf)
                best, gain = Condition(name, above, float(cut)), gains[i]
    return best


def fit(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules for bad rows; a third of the rows, picked by a fixed seed, prunes."""
    x = {k: np.asarray(v, float) for k, v in x.items()}
    bad = np.asarray(bad, bool)
    rules: list[Rule] = []
    if not bad.any() or bad.all():
        return rules
    left = np.ones(len(bad), bool)
    fold = np.random.default_rng(5).integers(3, size=len(bad))
    prunes = fold == 2
    misses = 0
    while len(rules) < MAX_RULES and misses < 2:
        # Another fold prunes after a rule has failed, so that one unlucky split doesn't end it.
        grow, hold = left & ~prunes, left & prunes
        if (bad & grow).sum() < MIN_COVER:
            break
        gx, gb = {k: v[grow] for k, v in x.items()}, bad[grow]
        cuts = {k: np.unique(np.quantile(np.r_[v[gb], v[~gb]] if (~gb).any() else v,
                                         np.linspace(0, 1, CUTS)))
                for k, v in gx.items()}
        cuts = {k: np.unique(np.r_[c, np.quantile(gx[k][gb], np.linspace(0, 1, CUTS // 2))])
                for k, c in cuts.items()}
        rule: Rule = ()
        inside = np.ones(len(gb), bool)
        while len(rule) < MAX_CONDITIONS and (~gb & inside).any():
            condition = _best_condition(gx, gb, inside, cuts)
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(gx[condition.name])
        hx, hb = {k: v[hold] for k, v in x.items()}, bad[hold]

        def worth(r):
            hit = covers(r, hx) if r else np.ones(len(hb), bool)
            p, n = int((hit & hb).sum()), int((hit & ~hb).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covers(rule, x) & left if rule else left
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        held = covers(rule, hx) if rule else np.ones(len(hb), bool)
        precise = (held & hb).sum() >= MIN_PRECISION * max(1, held.sum())
        if rule and p >= MIN_COVER and p >= MIN_PRECISION * (p + n) and precise:
            rules.append(rule)
            left &= ~hit
            misses = 0
        else:
            misses += 1
            prunes = fold == 1
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where the decision list keeps a row: the first rule that holds drops it."""
    out = F
    for rule in rules:
        condition = rule[0].column()
        for more in rule[1:]:
            condition = condition & more.column()
        out = out.when(condition, F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def apply_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Statistics of every row of ``docs`` with ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base check.
    """
    stats = Scratch(docs.sparkSession, "rules").keep(statistics(docs), "stats")
    known = labelled_sample(stats, labels, "quality", sample, RATIOS)
    rules = fit({name: known[name].to_numpy() for name in RATIOS}, known["y"].to_numpy() == 0) \
        if len(known) else []
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (stats.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))
