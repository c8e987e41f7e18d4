"""Quality rules whose cutoffs are certified on labelled documents.

A document fails a fixed base rule, or a rule ``measure > cutoff``. The cutoffs are chosen per stratum
by testing: walking from the laxest cutoff of a rule to the strictest, each step tests the hypothesis
"this cutoff rejects more than ``limit`` of the good documents of this stratum" with the exact binomial
tail of the labelled good documents it would reject. A rule's walk stops at the first step that cannot
reject its hypothesis (fixed-sequence testing needs no correction along the walk); the level is divided
by the number of walks (strata times rules, Bonferroni). So with probability ``1 - risk`` no rule
rejects more than its share of the good documents of any stratum. Among the certified cutoffs the
laxest is taken that rejects as many labelled bad documents as any certified one.

Defined results: a NULL or blank text has no words and fails the base rule; a stratum without enough
labels, or without any, has no cutoffs and keeps what the base rule keeps; NULL is a stratum of its own;
several labels of a document count as one, the lowest; a label applies to every row of its document;
unlabelled and NULL labels count nowhere; repeated rows are judged alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfprice.llm.text import ROW, carried, pairwise, unpacked, words
from shelfprice.plans.staging import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OTHER = ["n_lines", "n_capitals", "n_stutters"]

# Terms of the binomial tail that are summed one by one; beyond them a geometric series bounds the rest.
TAIL_TERMS = 4000


@dataclass(frozen=True)
class Rules:
    """Cutoffs to walk through per rule, laxest first, and the risk that is accepted."""

    walks: dict[str, list[float]]
    max_false_rejection: float = 0.10
    risk: float = 0.10

    @property
    def limit(self) -> float:
        """Share of the good documents of a stratum that one rule may reject."""
        return self.max_false_rejection / len(self.walks)


RULES = Rules(
    {
        "symbols": [2.0, 1.0, 0.6, 0.4, 0.3, 0.2, 0.1],
        "capitals": [0.8, 0.7, 0.6, 0.5, 0.4, 0.35],
        "stutter": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
        "same_lines": [0.95, 0.9, 0.8, 0.7, 0.6],
    }
)


def _measures() -> dict[str, Column]:
    per = {"symbols": ("n_symbols", "n_words"), "capitals": ("n_capitals", "word_chars")}
    per |= {"stutter": ("n_stutters", "n_words"), "same_lines": ("n_dup_lines", "n_lines")}
    return {rule: F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0)) for rule, (part, whole) in per.items()}


def count(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """One row per document: the counts the rules use, behind the columns of ``keep``.

    Everything is computed row by row inside the scan. A window of eight words is known by the hash of
    its words, built by doubling (one word, two, four, eight), so a text costs four hashes per word.
    """
    digest = lambda x, y: F.xxhash64(x, y)
    kept = [f"_k{i}" for i in range(len(keep))]
    names = docs.select(*keep).columns
    df = docs.select(
        *[c.alias(k) for c, k in zip(keep, kept, strict=True)],
        F.coalesce(text, F.lit("")).alias("text"),
        words(text).alias("words"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        *kept,
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
    )
    n = F.col("n")
    df = df.select(
        *kept, "n", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(pairwise(F.col("h1"), 1, n, lambda x, y: x == y), lambda same: same)).cast("long").alias("n_stutters"),
        pairwise(F.col("h1"), 1, n, digest).alias("h2"),
    )
    counted = ["n", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_stutters"]
    df = df.select(*kept, *counted, pairwise(F.col("h2"), 2, n - 1, digest).alias("h4"))
    df = df.select(*kept, *counted, pairwise(F.col("h4"), 4, n - 3, digest).alias("h8"))
    # Only texts with a repeated window sort theirs.
    repeats = F.size(F.array_distinct("h8")) < F.size("h8")
    placed = F.sort_array(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*kept, *counted, F.when(repeats, placed).alias("placed"))
    met = pairwise(
        F.col("placed"), 1, F.size("placed"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    df = df.select(*kept, *counted, F.sort_array(F.array_distinct(F.flatten(F.array_compact(met)))).alias("starts"))
    gaps = pairwise(F.col("starts"), 1, F.size("starts"), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    return df.select(
        *[F.col(k).alias(name) for k, name in zip(kept, names, strict=True)],
        F.col("n").cast("long").alias("n_words"),
        *[c for c in counted if c != "n"],
        F.when(F.size("starts") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series, shifted up by 8 where it is most exact."""
    z = x + 8
    shift = F.log(x * (x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5)))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p): exact up to ``TAIL_TERMS`` terms, then never below the true value.

    The terms are summed downwards from k; 1 where k is at or above the mean, where no test can reject.
    """
    k, n = k.cast("double"), n.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)  # noqa: E731  the term of i - 1 against that of i
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] * ratio(k - j)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    steps = F.least(k, F.lit(float(TAIL_TERMS))).cast("int")
    acc = F.when(steps > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(steps - 1, F.lit(0))), start, add)).otherwise(start)
    last = ratio(k - steps)
    rest = F.when(k > steps, acc["term"] * last / (1 - last)).otherwise(0.0)
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(top + F.log(acc["sum"] + rest)))).otherwise(1.0)


def certified_cutoffs(counts: DataFrame, labels: DataFrame, rules: Rules = RULES) -> DataFrame:
    """One row per stratum with labels: ``stratum`` and a cutoff per rule, NULL where none is certified.

    ``counts`` has ``doc_id``, ``stratum`` and the counts; ``labels`` has ``doc_id`` and ``quality``. All
    labelled rows are counted in one map-side combined aggregation; what is left has a row per stratum,
    rule and cutoff.
    """
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality IS NOT NULL")
    measured = counts.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    labelled = measured.select("doc_id", "stratum", *[c.alias(f"m_{r}") for r, c in _measures().items()]).join(known, "doc_id")
    steps = [(rule, i, cutoff) for rule, walk in rules.walks.items() for i, cutoff in enumerate(walk)]
    good, bad = F.col("quality") >= 1, F.col("quality") < 1
    sums = [
        F.count_if(who & (F.col(f"m_{rule}") > cutoff)).alias(f"{side}_{rule}_{i}")
        for rule, i, cutoff in steps
        for side, who in (("good", good), ("bad", bad))
    ]
    per_stratum = labelled.groupBy("stratum").agg(F.count_if(good).alias("n_good"), *sums)
    # Counted before the walks are laid out: it is the number of strata that corrects the level.
    per_stratum = per_stratum.withColumn("n_strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    tests = per_stratum.select(
        "stratum",
        "n_good",
        "n_strata",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"),
                        F.lit(i).alias("step"),
                        F.lit(cutoff).alias("cutoff"),
                        F.col(f"good_{rule}_{i}").alias("k"),
                        F.col(f"bad_{rule}_{i}").alias("hits"),
                    )
                    for rule, i, cutoff in steps
                ]
            )
        ).alias("t"),
    ).select("stratum", "n_good", "n_strata", "t.*")
    level = F.lit(rules.risk) / (F.col("n_strata") * len(rules.walks))
    passed = tests.withColumn("passed", binomial_tail(F.col("k"), F.col("n_good"), rules.limit) <= level)
    walk = Window.partitionBy("stratum", "rule").orderBy("step")
    certified = passed.withColumn("certified", F.min("passed").over(walk)).where("certified")
    best = F.max("hits").over(Window.partitionBy("stratum", "rule"))
    chosen = certified.withColumn("best", best).where("hits = best AND hits > 0")
    cut = [F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(rule) for rule in rules.walks]
    return chosen.groupBy("stratum").agg(*cut)


def judged(counts: DataFrame, cutoffs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``."""
    names = {rule: f"cut_{rule}" for rule in rules.walks}
    cuts = cutoffs.select(F.col("stratum").alias("cut_stratum"), *[F.col(r).alias(c) for r, c in names.items()])
    joined = counts.join(cuts, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    measures = _measures()
    rejected = F.lit(False)
    for rule, cut in names.items():
        rejected = rejected | F.coalesce(measures[rule] > F.col(cut), F.lit(False))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~rejected}).drop("cut_stratum", *names.values())


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: Rules = RULES
) -> DataFrame:
    """One row per document: ``doc_id, stratum``, the counts, ``base_failed``, ``kept``."""
    counts = stage(count(docs, F.col("text"), F.col("doc_id"), F.col(stratum).alias("stratum")), "quality_counts")
    cutoffs = stage(certified_cutoffs(counts, labels, rules), "quality_cutoffs")
    return judged(counts, cutoffs, rules)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: Rules = RULES) -> DataFrame:
    """The documents that pass, with their own columns. Texts are scanned once and never shuffled."""
    packed = carried(docs)
    cols = (F.col(ROW), F.col(f"{ROW}.doc_id").alias("doc_id"), F.col(f"{ROW}.{stratum}").alias("stratum"))
    counts = stage(count(packed, F.col(f"{ROW}.text"), *cols), "quality_counts")
    cutoffs = stage(certified_cutoffs(counts.drop(ROW), labels, rules), "quality_cutoffs")
    return unpacked(judged(counts, cutoffs, rules).where("kept"))
