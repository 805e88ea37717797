"""Quality rules whose cutoffs are fixed by labelled holdouts, with a bound on the harm.

Every rule is a score that is high for bad text and a cutoff above which a document goes. The
cutoffs are chosen per stratum (language) from a grid, on documents whose label is known, in
two ways, and the one with the better balance of bad and good documents rejected is taken:

* Together: the bad labels alone lay a path of ever stricter sets of cutoffs, one rule and step
  at a time. For each set the exact binomial test asks whether all its rules together reject
  good documents more often than `risk`. Good labels have no part in the path, so it is a
  fixed sequence: testing stops at the first set that cannot be certified, and one level
  serves the whole path. ln(level) / ln(1 - risk) good labels can be enough.
* Rule by rule, where there are labels enough: cutoffs of each rule from the mildest on, at
  `risk` / rules and level / rules.

The level is `error` / strata (Bonferroni), and half of it for each way where both are tried.
Strata with too few good labels for any test are not tested and not counted; the number of
labels alone decides that. With probability 1 - `error` no stratum loses more than `risk` of
its good documents to all rules together. Cutoffs that reject no more than they cost are not
taken; a stratum with too few labels, or none, gets no cutoff.

The counts behind the tests are summed by Spark: a stratum's tables have rules x steps rows and
as many as the path has sets, however many documents it has.

Nulls: a null text has no words and fails the base rule; a null stratum is a stratum; null
labels and labels of unknown documents are left out. A document labelled twice counts as good
if any label says so. Repeated rows are judged one by one. Empty tables give empty results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .arrow import set_aside, with_columns
from .repeats import thinned

SYMBOLS = "#*$%&|<>"
SPAN = 8
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Scores from 0 to 1, in the order of the columns they are made in.
RULES = ("symbol_share", "upper_share", "shout_share", "dup_line_share", "repeat_share")
SCORES = ", ".join(f"{r} double" for r in RULES)


@dataclass(frozen=True)
class Risk:
    """`risk`: most good documents a stratum may lose. `error`: chance that a bound fails.
    `steps`: grid of cutoffs between 0 and 1. `price`: bad documents that must go for each
    good one."""

    risk: float = 0.02
    error: float = 0.05
    steps: int = 64
    price: float = 20.0


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """Words in windows of `span` words that are found twice or more in the text."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(span):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (ids[i : i + n] ^ (ids[i : i + n] >> np.uint64(29)))
    order = np.argsort(mixed, kind="stable")
    ranked = mixed[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twin = np.zeros(n, bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    places = np.flatnonzero(twin)
    seen: dict[tuple, int] = {}  # the words themselves decide
    keys = [tuple(words[p : p + span]) for p in places]
    for k in keys:
        seen[k] = seen.get(k, 0) + 1
    covered = np.zeros(len(words) + 1, np.int64)
    for p, k in zip(places, keys):
        if seen[k] > 1:
            covered[p] += 1
            covered[p + span] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str | None) -> tuple:
    """The counts and then the scores of one text."""
    if not text:
        return (0,) * 5 + (0.0,) * len(RULES)
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * 5 + (0.0,) * len(RULES)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    letters = max(1, len(text) - sum(map(text.count, " \n")) - symbols)
    upper = sum(map(str.isupper, text.split()))
    shouts = text.count("!")
    scores = (
        min(1.0, symbols / chars), upper / n, min(1.0, shouts / letters), dup / max(1, len(lines)), repeat / n,
    )
    return (n, chars, symbols, dup, repeat) + scores


def measured(docs: DataFrame, text: str = "text", without: tuple[str, ...] = ("text",)) -> DataFrame:
    """The rows with the counts of COUNTS, the scores of RULES and `base_failed`, and without
    the text unless told so."""
    names = [x.split()[0] for x in f"{COUNTS}, {SCORES}".split(", ")]

    def one(batch: pa.RecordBatch) -> dict:
        rows = [measure(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
        return dict(zip(names, zip(*rows)))

    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return with_columns(docs, one, f"{COUNTS}, {SCORES}", without).withColumn("base_failed", failed)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p): summed from the largest term down, which is over as
    soon as a term no longer counts."""
    if k >= n:
        return 1.0
    if k >= n * p:  # no rate below p can be shown from so many
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total = 0.0
    while k >= 0:
        total += term
        if term < total * 1e-17:
            break
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return total


def certified_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, level: float, price: float) -> int | None:
    """Step whose documents and all above go; good and bad are counts per step."""
    n = int(good.sum())
    lost, caught = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    best, step = 0.0, None
    for s in range(len(good) - 1, 0, -1):  # from the mildest
        if n == 0 or binomial_tail(int(lost[s]), n, risk) > level:
            break
        if (gain := caught[s] - price * lost[s]) > best:
            best, step = gain, s
    return step


def path_of(bad: np.ndarray) -> list[tuple[int, int]]:
    """Moves (rule, new step) to ever stricter cutoffs, until all bad documents with a positive
    score go; bad has counts per rule and step. A move goes to the next step that has any, of
    the rule that catches most for the steps it goes down, now or further on."""
    rules, size = bad.shape
    left = [[int(x) for x in np.flatnonzero(bad[r]) if x] for r in range(rules)]
    at, moves = [size] * rules, []

    def rate(r: int) -> float:
        steps = np.array(left[r][::-1])
        return float((np.cumsum(bad[r][steps]) / (at[r] - steps)).max())

    while any(left):
        r = max((r for r in range(rules) if left[r]), key=rate)
        at[r] = left[r].pop()
        moves.append((r, at[r]))
    return moves


def places_on(moves: list[tuple[int, int]], rules: int, size: int) -> list[list[int]]:
    """For each rule and step the first move that rejects it, or the number of moves."""
    places = [[len(moves)] * size for _ in range(rules)]
    for i, (r, step) in enumerate(moves):
        places[r][step:] = [min(i, x) for x in places[r][step:]]
    return places


def certified_moves(good: np.ndarray, bad: np.ndarray, risk: float, level: float, price: float) -> tuple[int, float]:
    """How many moves to make, and their balance; counts per move that rejects first, and last
    of documents that no move rejects."""
    n, best, made = int(good.sum()), 0.0, 0
    lost, caught = np.cumsum(good), np.cumsum(bad)
    for i in range(len(good) - 1):
        if n == 0 or binomial_tail(int(lost[i]), n, risk) > level:
            break
        if (gain := caught[i] - price * lost[i]) > best:
            best, made = gain, i + 1
    return made, best


def labels_needed(risk: float, level: float) -> int:
    """The fewest good labels that can certify a cutoff: with none of them lost."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def levels(n: int, limits: Risk, n_strata: int) -> tuple[float, float]:
    """Levels of the path and of a single rule for a stratum with n good labels."""
    level, rules = limits.error / n_strata, len(RULES)
    if n < labels_needed(limits.risk / rules, level / 2 / rules):
        return level, 0.0
    return level / 2, level / 2 / rules


def step_of(score, steps: int):
    """0 for a score of 0, otherwise the step that a positive score falls into."""
    return F.least(F.ceil(score * steps), F.lit(steps)).cast("int")


def calibrate(scored: DataFrame, labels: DataFrame, limits: Risk, key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """stratum, and for every rule the cutoff step or null; a row for each labelled stratum.
    `scored` is what `measured` gave; only labelled documents that pass the base rule count."""
    known = (
        labels.filter(F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("key")).agg(F.max(F.col("quality")).alias("good"))
    )
    n_rules, size, price = len(RULES), limits.steps + 1, limits.price
    at = [f"at_{r}" for r in RULES]
    sums = [F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad")]
    joint = cut_lineage(
        scored.filter(~F.col("base_failed"))
        .select(F.col(key).alias("key"), F.col(stratum).alias("stratum"), *[step_of(F.col(r), limits.steps).alias(a) for r, a in zip(RULES, at)])
        .join(known, "key")
        .withColumns({"n_good": F.when(F.col("good") > 0, 1).otherwise(0), "n_bad": F.when(F.col("good") > 0, 0).otherwise(1)})
        .groupBy("stratum", *at).agg(*sums),
        "quality-counts",
    )
    totals = joint.groupBy("stratum").agg(F.sum("n_good").alias("n"))
    testable = totals.filter(F.col("n") >= labels_needed(limits.risk, limits.error)).agg(F.count("*").alias("strata"))
    n_strata = max(1, testable.first()["strata"])
    kind = scored.schema[stratum].dataType.simpleString()
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(a).alias("step")) for i, a in enumerate(at)]))
    counts = joint.select("stratum", "n_good", "n_bad", steps.alias("of")).groupBy("stratum", "of.rule", "of.step").agg(*sums)

    def proposals(table: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros((n_rules, size), np.int64), np.zeros((n_rules, size), np.int64)
        good[table["rule"], table["step"]], bad[table["rule"], table["step"]] = table["n_good"], table["n_bad"]
        moves, single = path_of(bad), levels(int(good[0].sum()), limits, n_strata)[1]
        alone = [single and certified_cutoff(g, b, limits.risk / n_rules, single, price) or size for g, b in zip(good, bad)]
        return pd.DataFrame([{
            "stratum": table["stratum"].iloc[0], "move_rules": [r for r, _ in moves], "move_steps": [x for _, x in moves],
            "places": places_on(moves, n_rules, size), "alone": alone,
        }])

    proposed = counts.groupBy("stratum").applyInPandas(
        proposals, f"stratum {kind}, move_rules array<int>, move_steps array<int>, places array<array<int>>, alone array<int>"
    )
    proposed = cut_lineage(proposed, "quality-paths")
    own = proposed.withColumnRenamed("stratum", "_of")
    place = F.least(*[F.col("places")[i][F.col(a)] for i, a in enumerate(at)])
    over = F.lit(False)
    for i, a in enumerate(at):
        over = over | (F.col(a) >= F.col("alone")[i])
    along = (
        joint.join(own, F.col("stratum").eqNullSafe(F.col("_of")))
        .groupBy("stratum", place.alias("place"), over.alias("over")).agg(*sums)
        .groupBy("stratum").agg(F.collect_list(F.struct("place", "over", "n_good", "n_bad")).alias("found"))
        .join(own, F.col("stratum").eqNullSafe(F.col("_of"))).drop("_of", "places")
    )

    def cutoffs(batches):
        for table in batches:
            rows = []
            for of, found, rules, to, alone in zip(*(table[c] for c in ("stratum", "found", "move_rules", "move_steps", "alone"))):
                good, bad = np.zeros(len(rules) + 1, np.int64), np.zeros(len(rules) + 1, np.int64)
                balance = 0.0
                for f in found:
                    good[f["place"]] += f["n_good"]
                    bad[f["place"]] += f["n_bad"]
                    balance += f["over"] * (f["n_bad"] - price * f["n_good"])
                n = int(good.sum())
                made, gain = certified_moves(good, bad, limits.risk, levels(n, limits, n_strata)[0], price)
                chosen = [int(x) for x in alone] if balance > gain else [size] * n_rules
                if balance <= gain:
                    for r, step in zip(rules[:made], to[:made]):
                        chosen[r] = int(step)
                rows.append((of, *(x if x < size else None for x in chosen)))
            names = ["stratum", *[f"{r}_step" for r in RULES]]
            yield pd.DataFrame(rows, columns=names).astype({f"{r}_step": "Int32" for r in RULES})

    return along.mapInPandas(cutoffs, f"stratum {kind}, " + ", ".join(f"{r}_step int" for r in RULES))


def judged(scored: DataFrame, cutoffs: DataFrame, limits: Risk, stratum: str = "lang") -> DataFrame:
    """The rows with `kept`. A stratum without a row in `cutoffs` has the base rule only."""
    own = cutoffs.withColumnRenamed("stratum", "_of")
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(step_of(F.col(r), limits.steps) >= F.col(f"{r}_step"), F.lit(False))
    return (
        scored.join(own, F.col(f"`{stratum}`").eqNullSafe(F.col("_of")), "left")
        .withColumn("kept", ~F.col("base_failed") & ~over)
        .drop("_of", *[f"{r}_step" for r in RULES])
    )


def quality_cutoffs(docs: DataFrame, labels: DataFrame, limits: Risk = Risk()) -> DataFrame:
    """The cutoffs of every labelled stratum, as a stored table. A filter of fixed size picks
    the labelled texts (and a few more, which find no label), so that no text is shuffled."""
    wanted = labels.filter("quality is not null").select("doc_id")
    labelled = thinned(docs.select("doc_id", "lang", "text"), wanted, "doc_id")
    return cut_lineage(calibrate(measured(labelled), labels, limits), "quality-cutoffs")


def quality_decisions(docs: DataFrame, labels: DataFrame, limits: Risk = Risk()) -> DataFrame:
    """The documents with counts, scores, base_failed and kept. Texts are measured twice: the
    labelled ones to find the cutoffs, then all, so that nothing has to be stored."""
    return judged(measured(docs), quality_cutoffs(docs, labels, limits), limits)


def filter_documents(docs: DataFrame, labels: DataFrame, limits: Risk = Risk()) -> DataFrame:
    """The documents that are kept, with their columns as they came. Columns have other names
    meanwhile, as some may be called like a measure."""
    held, names = set_aside(docs)
    scored = measured(held.withColumn("lang", F.col(names["lang"])), names["text"], ())
    kept = judged(scored, quality_cutoffs(docs, labels, limits), limits).filter("kept")
    return kept.select(*[F.col(held).alias(c) for c, held in names.items()])
