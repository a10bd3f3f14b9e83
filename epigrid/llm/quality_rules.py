"""Quality rules by weak supervision, in DataFrame functions only.

Every rule looks at one measure of a text and votes bad, good, or abstains. The votes of all texts that pass the base test are
counted by pattern (at most 3 ** rules rows, however large the corpus), and expectation-maximisation over these counts estimates
the share of good texts and, for each rule, how often it votes what on good and on bad texts. It starts from the majority of each
pattern's votes. A text is kept if the posterior probability that it is good reaches the threshold, so a rule that is often wrong
is overruled where the others disagree with it. Nothing is sampled. The pseudo-counts are a few votes a rule, whatever the size
of the corpus; they only name the classes. A corpus without bad texts still gets two classes, the second being its oddest texts.

Null and empty texts have no words: all measures are 0 and the base test rejects them. Null ids are kept, repeated rows are
judged each for itself, an empty table gives no rows, and only the named columns are read. Long texts are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from epigrid.llm.common import WHITE, let, words
from epigrid.session import cut_lineage

SYMBOLS = "#*$%&|<>"
SIGNS = SYMBOLS + "!?.,;:()[]{}+=~^_/@"
BAD, ABSTAIN, GOOD = -1, 0, 1
ROUNDS = 300
#: Pseudo-counts of a rule's votes (bad, abstain, good) on good texts and on bad ones, and of good and bad texts.
PRIOR = {GOOD: (1.0, 1.0, 8.0), BAD: (4.0, 1.0, 5.0)}
PRIOR_TEXTS = (9.0, 1.0)


@dataclass(frozen=True)
class Rule:
    """Votes bad if the measure is at least `bad`, good if it is at most `good`, else abstains."""

    name: str
    measure: str
    bad: float
    good: float


#: Measures per word or per line, so that they do not depend on the length of a text; but for the last, which is a weak rule about length.
RULES = (
    Rule("symbols", "n_symbols / n_words", 0.10, 0.02),
    Rule("signs", "n_signs / greatest(word_chars, 1)", 0.15, 0.08),
    Rule("repeated_words", "n_repeat_words / n_words", 0.15, 0.05),
    Rule("repeated_lines", "n_dup_lines / n_lines", 0.20, 0.10),
    Rule("shouting", "n_marks / n_words", 0.30, 0.05),
    Rule("word_length", "abs(word_chars / n_words - 5)", 1.0, 0.5),
    Rule("no_sentences", "1 - least(1.0, n_stops * 60 / n_words)", 0.7, 0.2),
    Rule("short", "80 / n_words", 1.0, 0.5),
)


def _count(text: Column, signs: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, signs, ""))


def _repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text."""
    n = F.size(w)
    windows = F.transform(
        F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2))
    )

    def covered(pairs: Column) -> Column:
        last = F.size(pairs)
        hash_at = lambda k: F.element_at(pairs, k)["h"]
        found = F.filter(
            F.sequence(F.lit(1), last),
            lambda k: ((k > 1) & (hash_at(k) == hash_at(F.greatest(k - 1, F.lit(1)))))
            | ((k < last) & (hash_at(k) == hash_at(F.least(k + 1, last)))),
        )
        places = F.transform(found, lambda k: F.element_at(pairs, k)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

    def repeated(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(F.sort_array(pairs), covered))

    return F.when(n < 3, F.lit(0)).otherwise(let(windows, repeated))


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the further counts that the rules use."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    counted = let(
        words(text), lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words"))
    )
    blank = F.translate(text, WHITE, "")
    with_words = F.filter(F.split(text, "\n"), lambda line: F.translate(line, WHITE, "") != "")
    lines = let(with_words, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
    found = docs.select(
        F.col(id_column),
        counted.alias("w"),
        F.char_length(blank).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        lines.alias("l"),
        _count(text, "!").cast("long").alias("n_marks"),
        _count(text, ".?!").cast("long").alias("n_stops"),
        _count(text, SIGNS).cast("long").alias("n_signs"),
    )
    return found.select(
        id_column,
        F.col("w.n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("l.n") - F.col("l.different")).cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"),
        "n_marks",
        "n_stops",
        "n_signs",
    )


def votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures with one vote column per rule; a text without words gets no votes."""
    value = {r.name: F.expr(r.measure.replace("n_words", "greatest(n_words, 1)").replace("n_lines", "greatest(n_lines, 1)")) for r in rules}
    vote = {
        f"vote_{r.name}": F.when(F.col("n_words") == 0, F.lit(ABSTAIN))
        .when(value[r.name] >= r.bad, F.lit(BAD))
        .when(value[r.name] <= r.good, F.lit(GOOD))
        .otherwise(F.lit(ABSTAIN))
        for r in rules
    }
    return measured.withColumns(vote)


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and per class and rule the probabilities of the votes bad, abstain, good."""

    share_good: float
    chance: dict[int, list[tuple[float, float, float]]]

    def posterior(self, rules: tuple[Rule, ...] = RULES) -> Column:
        """Probability that the text is good, from the vote columns."""
        odds = F.lit(math.log(self.share_good / (1 - self.share_good)))
        for k, r in enumerate(rules):
            good, bad = self.chance[GOOD][k], self.chance[BAD][k]
            weight = [math.log(g / b) for g, b in zip(good, bad)]
            seen = F.col(f"vote_{r.name}")
            odds = odds + F.when(seen == BAD, weight[0]).when(seen == GOOD, weight[2]).otherwise(weight[1])
        return 1 / (1 + F.exp(-odds))


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts."""
    total = sum(n for _, n in patterns)
    width = len(patterns[0][0]) if patterns else len(RULES)
    belief = [(p.count(GOOD) + 0.5) / (p.count(GOOD) + p.count(BAD) + 1) for p, _ in patterns]
    for _ in range(rounds):
        share = (sum(b * n for b, (_, n) in zip(belief, patterns)) + PRIOR_TEXTS[0]) / (total + sum(PRIOR_TEXTS))
        chance = {}
        for side in (GOOD, BAD):
            weight = [(b if side == GOOD else 1 - b) * n for b, (_, n) in zip(belief, patterns)]
            chance[side] = []
            for k in range(width):
                counts = list(PRIOR[side])
                for w, (pattern, _) in zip(weight, patterns):
                    counts[pattern[k] + 1] += w
                chance[side].append(tuple(c / sum(counts) for c in counts))
        model, before = LabelModel(share, chance), belief
        belief = []
        for pattern, _ in patterns:
            odds = math.log(share / (1 - share))
            for k, v in enumerate(pattern):
                odds += math.log(chance[GOOD][k][v + 1] / chance[BAD][k][v + 1])
            belief.append(1 / (1 + math.exp(-max(odds, -700.0))))
        if all(abs(a - b) < 1e-9 for a, b in zip(belief, before)):
            break
    return model


def judge(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """Measures, base test, posterior probability and verdict of every text. The measures are stored once, in the folder
    that `spark.checkpoint.dir` names, because the vote counts and the verdicts both need them."""
    voted = votes(cut_lineage(measures(docs, id_column, text_column), "measures"), rules)
    names = [f"vote_{r.name}" for r in rules]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    seen = [(tuple(r[n] for n in names), r["count"]) for r in voted.where(~base).groupBy(*names).count().collect()]
    model = fit(sorted(seen))
    return voted.withColumns({"base_failed": base, "good_probability": model.posterior(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good_probability") >= threshold)
    )
