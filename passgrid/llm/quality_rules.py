"""Quality rules as a learned decision list.

Sequential covering: a rule is a conjunction of thresholds on statistics of a text. It is grown on two thirds of the
labelled rows, condition by condition, by the gain in information about bad texts; then its last conditions are
pruned as long as that helps on the other third. Rows that a rule covers are set aside and the next one is grown, until
a new rule would not be precise enough on the rows that it was not grown on. The list becomes one conditional Spark
expression: the first rule that holds rejects, and what no rule covers is kept.

The statistics of a text are counted for every row; the list alone is learned on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.llm.text_stats import COUNTS, text_counts
from passgrid.llm.training import labelled_sample

SAMPLE_ROWS = 20_000
# A rule must reject so many bad rows for each row it rejects, counted with one good row on top, and cover so many.
LEAST_PRECISION, LEAST_COVER = 0.9, 3
MOST_CONDITIONS = 6

BASE_WORDS = 10
BASE_REPEATS_PERCENT = 20

# Share of one count in another, or the count itself.
RATIOS: dict[str, tuple[str, str | None]] = {
    "n_words": ("n_words", None),
    "n_lines": ("n_lines", None),
    "word_size": ("word_chars", "n_words"),
    "line_words": ("n_words", "n_lines"),
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "bare_words": ("n_bare_words", "n_words"),
    "marked_words": ("n_marked_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "variety": ("n_distinct_words", "n_words"),
}


def statistic(name: str) -> Column:
    """A statistic over the columns of :func:`text_counts`; a share of nothing is 0."""
    top, bottom = RATIOS[name]
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) == 0, F.lit(0.0)).otherwise(F.col(top) / F.col(bottom))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = statistic(self.name)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, values: np.ndarray) -> np.ndarray:
        own = values[:, list(RATIOS).index(self.name)]
        return own > self.threshold if self.above else own <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Rejects a text for which all conditions hold. ``bad`` and ``good`` are the labelled rows it covered first."""

    conditions: tuple[Condition, ...]
    bad: int = 0
    good: int = 0

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for c in self.conditions:
            out &= c.holds(values)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = field(default=())

    def rule(self) -> Column:
        """Number of the first rule that holds, from 1; null where none does."""
        out = F.lit(None).cast("int")
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(rule.column(), F.lit(i)).otherwise(out)
        return out

    def first(self, values: np.ndarray) -> np.ndarray:
        """As :meth:`rule` for rows of statistics; 0 where none holds."""
        out = np.zeros(len(values), int)
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            out[rule.holds(values)] = i
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {r}  # {r.bad} bad, {r.good} good" for r in self.rules) + "\nelse keep"


def _best_condition(values: np.ndarray, bad: np.ndarray) -> tuple[float, Condition] | None:
    """The threshold with the greatest gain: bad rows left times the bits by which a bad row became likelier."""
    p, n = int(bad.sum()), int(len(bad) - bad.sum())
    if not p or not n:
        return None
    before = np.log2(p / (p + n))
    best = None
    for j, name in enumerate(RATIOS):
        order = np.argsort(values[:, j], kind="stable")
        own = values[order, j]
        cut = np.flatnonzero(own[1:] > own[:-1])
        if not len(cut):
            continue
        below = np.cumsum(bad[order])[cut]
        size = cut + 1
        for above, hit, covered in ((False, below, size), (True, p - below, p + n - size)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(hit > 0, hit * (np.log2(hit / covered) - before), -np.inf)
            i = int(np.argmax(gain))
            if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-12):
                middle = (own[cut[i]] + own[cut[i] + 1]) / 2
                threshold = float(middle if middle < own[cut[i] + 1] else own[cut[i]])
                best = float(gain[i]), Condition(name, above, threshold)
    return best


def grow(values: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Conditions that lead to bad rows only, or as near as thresholds get."""
    conditions: list[Condition] = []
    while len(conditions) < MOST_CONDITIONS and (found := _best_condition(values, bad)):
        conditions.append(found[1])
        inside = found[1].holds(values)
        values, bad = values[inside], bad[inside]
    return conditions


def prune(conditions: list[Condition], values: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The shortest beginning of the rule with the greatest share of bad rows less good ones among rows not grown on."""
    best, worth = len(conditions), -2.0
    inside = np.ones(len(values), bool)
    worths = []
    for c in conditions:
        inside = inside & c.holds(values)
        covered = int(inside.sum())
        worths.append((2 * int(bad[inside].sum()) - covered) / covered if covered else -1.0)
    for size in range(len(conditions), 0, -1):
        if worths[size - 1] >= worth:
            best, worth = size, worths[size - 1]
    return conditions[:best]


def learn(values: np.ndarray, bad: np.ndarray, part: np.ndarray) -> DecisionList:
    """Rules by sequential covering. Rows with ``part`` 0 prune and judge, the others grow."""
    rules: list[Rule] = []
    left = np.ones(len(values), bool)
    while (bad & left).any():
        growing, judging = left & (part != 0), left & (part == 0)
        conditions = grow(values[growing], bad[growing])
        if not conditions:
            break
        rule = Rule(tuple(prune(conditions, values[judging], bad[judging])))
        covered = rule.holds(values) & left
        hit, judged = int((covered & bad).sum()), covered & judging
        own, all_own = int((judged & bad).sum()), int(judged.sum())
        if hit < LEAST_COVER or hit < LEAST_PRECISION * (int(covered.sum()) + 1) or own < LEAST_PRECISION * all_own:
            break
        rules.append(Rule(rule.conditions, hit, int(covered.sum()) - hit))
        left &= ~covered
    return DecisionList(tuple(rules))


def fit_rules(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DecisionList:
    """Learn the list from about ``sample_rows`` rows with a ``quality`` of 0 or 1 at most, none of them held out
    (crc32(id as text) modulo 5 is 0). Texts that fail the base rules teach nothing. Without labelled rows of both
    kinds the list is empty."""
    rows = labelled_sample(docs, labels, "quality", id_col=id_col, rows=sample_rows, extra=(text_col,))
    counted = text_counts(rows, text_col=text_col, keep=["id", "label"])
    part = F.pmod(F.xxhash64("id"), F.lit(3)).alias("part")
    asked = counted.filter(~base_failed()).select("label", part, *[statistic(s).alias(s) for s in RATIOS])
    frame = asked.orderBy("part", *RATIOS, "label").toPandas()
    return learn(frame[list(RATIOS)].to_numpy(float), frame["label"].to_numpy() == 0, frame["part"].to_numpy())


def base_failed() -> Column:
    """Fewer than ten words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < BASE_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_REPEATS_PERCENT
    )


def apply_rules(
    docs: DataFrame, rules: DecisionList, *, text_col: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Per row the columns ``keep``, all counts of :func:`text_counts`, ``base_failed``, ``rule`` (number of the rule
    that rejects, else null) and ``kept``; kept columns of those names give way.

    ``kept`` is false where the base rules fail or a rule of the list rejects. Null, empty and wordless texts have counts
    of 0, fail the base rules and aren't kept. Repeated rows count each; an empty table gives an empty result.
    """
    out = ["base_failed", "rule", "kept"]
    counted = text_counts(docs, text_col=text_col, keep=[c for c in keep if c.lower() not in out])
    rows = counted.withColumns({"base_failed": base_failed(), "rule": rules.rule()})
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


__all__ = ["COUNTS", "DecisionList", "apply_rules", "fit_rules"]
