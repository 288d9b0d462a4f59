"""Quality rules: text statistics, and a decision list learned from labels by sequential covering. Native throughout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.session import cut

# White space between words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

RATIOS = {
    "chars_per_word": "word_chars / n_words",
    "symbols_per_char": "n_symbols / word_chars",
    "capitals_per_char": "n_capitals / word_chars",
    "marks_per_word": "n_marks / n_words",
    "dup_lines_per_line": "n_dup_lines / n_lines",
    "repeats_per_word": "n_repeat_words / n_words",
    "words": "n_words",
}


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """Counts over each whole text: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks);
    with `rows` also a struct `row` of all columns of docs.

    n_dup_lines counts \\n-split lines with a word that equal an earlier line; n_repeat_words counts the words that lie
    in a 3-word window found at least twice in the text, found by sorting window hashes only where some repeat.
    Null text counts as empty: all zero. Null ids and repeated rows are kept. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    split = docs.select(
        *whole,
        F.col(id_col).cast("long").alias("id"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)).alias("w"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.regexp_replace(text, "[!?]", ""))).cast("long").alias("n_marks"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    kept = [*["row"] * rows, "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_capitals", "n_marks"]
    counted = split.select(
        *["row"] * rows, "id", "word_chars", "n_symbols", "n_capitals", "n_marks",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") < 3, F.array().cast("array<bigint>"))
        .otherwise(F.expr("transform(sequence(0, size(w) - 3), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)))")).alias("h"),
    )
    placed = counted.select(*kept, F.when(F.size(F.array_distinct("h")) < F.size("h"), F.expr("sort_array(transform(h, (x, i) -> struct(x, i)))")).alias("s"))
    again = placed.select(*kept, F.expr("sort_array(transform(filter(s, (x, i) -> x.x = get(s, i - 1).x or x.x = get(s, i + 1).x), x -> x.i))").alias("at"))
    words = F.expr("aggregate(transform(at, (p, k) -> if(k = 0, 3, least(3, p - get(at, k - 1)))), 0L, (a, x) -> a + x)")
    return again.select(*kept, F.coalesce(words, F.lit(0)).cast("long").alias("n_repeat_words"))


@dataclass
class DecisionList:
    """Ordered rules; each is a conjunction of (ratio, '>=' or '<', bound), with its precision on held-back labels."""

    rules: list[list[tuple[str, str, float]]] = field(default_factory=list)
    precision: list[float] = field(default_factory=list)

    def condition(self, rule: list[tuple[str, str, float]]) -> Column:
        parts = [F.col(f) >= F.lit(bound) if op == ">=" else F.col(f) < F.lit(bound) for f, op, bound in rule]
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return F.coalesce(out, F.lit(False))

    def verdict(self) -> Column:
        """The number of the first rule that holds, from 1; null if none does."""
        out = F.lit(None).cast("int")
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(self.condition(rule), F.lit(k)).otherwise(out)
        return out

    def text(self) -> list[str]:
        return [" and ".join(f"{f} {op} {bound:.6g}" for f, op, bound in rule) for rule in self.rules]


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.withColumns({k: F.coalesce(F.expr(f"try_divide({a[0]}, {a[1]})" if len(a := v.split(" / ")) == 2 else v).cast("double"), F.lit(0.0)) for k, v in RATIOS.items()})


def learn(rows: DataFrame, label: str, key: str, most_rules: int = 6, most_terms: int = 3, cuts: int = 15, least_precision: float = 0.9, least_share: float = 0.002) -> DecisionList:
    """Learns a decision list for rows whose `label` is true, from all labelled rows, by aggregates alone.

    Ratios are binned at `cuts` quantiles of either label and equal bin vectors are counted once, two thirds of the
    rows (by hash of `key`) for growing and one third for pruning. A rule grows by the term with the best FOIL gain
    until no negative remains or it has `most_terms`; then it is cut back to the prefix with the best held-back
    precision. A rule is added if that is at least `least_precision` and the rule covers `least_share` of the positives
    (2 at least); else no later rule starts with its first ratio and direction. Only histograms of (ratios x bins) numbers come to the driver. Without labels of both kinds: no rules.
    """
    names = list(RATIOS)
    shares = [(k + 1) / (cuts + 1) for k in range(cuts)]
    quantiles = rows.groupBy(label).agg(*[F.percentile_approx(f, [0.0, *shares, 1.0], 20000).alias(f) for f in names]).collect()
    bounds = {f: sorted({x for row in quantiles for x in row[f] or []}) for f in names}
    bin_of = lambda f: sum((F.when(F.col(f) >= F.lit(b), 1).otherwise(0) for b in bounds[f]), F.lit(0))
    held = F.pmod(F.xxhash64(F.col(key)), F.lit(3)) == 0
    table = cut(
        rows.select(*[bin_of(f).alias(f) for f in names], held.alias("held"), F.col(label).cast("boolean").alias("y"))
        .groupBy(*names, "held").agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n"))
    )

    def holds(term):
        f, op, k = term
        return F.col(f) >= k if op == ">=" else F.col(f) < k

    def grown(left: DataFrame, rule: list) -> tuple[list, float]:
        """Adds the best term; its FOIL gain."""
        covered = left.where(~F.col("held"))
        for term in rule:
            covered = covered.where(holds(term))
        each = covered.select("p", "n", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("bin")) for i, f in enumerate(names)])).alias("x"))
        counts = {(r.f, r.bin): (r.p, r.n) for r in each.groupBy("x.f", "x.bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()}
        total = [sum(v[j] for (f, _), v in counts.items() if f == 0) for j in (0, 1)]
        if not total[0] or not total[1]:
            return rule, 0.0
        best = (0.0, None)
        for i, f in enumerate(names):
            for k in range(1, len(bounds[f]) + 1):
                above = [sum(v[j] for (g, b), v in counts.items() if g == i and b >= k) for j in (0, 1)]
                for op, (p, n) in ((">=", above), ("<", [total[0] - above[0], total[1] - above[1]])):
                    if p and (rule or (f, op) not in banned):
                        gain = p * (_log2(p, n) - _log2(*total))
                        best = max(best, (gain, (f, op, k)), key=lambda x: x[0])
        return (rule + [best[1]], best[0]) if best[1] and best[0] > 1e-9 else (rule, 0.0)

    positives = table.agg(F.sum("p"), F.sum("n")).first()
    found = DecisionList()
    if not positives[0] or not positives[1]:
        return found
    left, banned = table, set()
    while len(found.rules) < most_rules and len(banned) < 2 * len(names):
        rule: list = []
        while len(rule) < most_terms:
            longer, gain = grown(left, rule)
            if not gain:
                break
            rule = longer
        if not rule:
            break
        whole = [holds(t) for t in rule]
        on = [whole[0]]
        for c in whole[1:]:
            on.append(on[-1] & c)
        row = left.agg(*[F.sum(F.when(c & F.col("held"), F.col(v)).otherwise(0)) for c in on for v in ("p", "n")], *[F.sum(F.when(c, F.col("p")).otherwise(0)) for c in on]).first()
        scores = [((row[2 * k] + 1) / (row[2 * k] + row[2 * k + 1] + 1.1), -k) for k in range(len(rule))]
        precision, k = max(scores)
        if precision < least_precision or row[2 * len(rule) - k] < max(2, least_share * positives[0]):
            banned.add(rule[0][:2])
            continue
        rule = rule[: 1 - k]
        found.rules.append([(f, op, bounds[f][b - 1]) for f, op, b in rule])
        found.precision.append(float(precision))
        left = left.where(~on[-k])
    return found


def _log2(p: float, n: float) -> float:
    from math import log2

    return log2(p / (p + n))


def _judged(ratios: DataFrame, rules: DecisionList, least_words: int, most_repeats: int) -> DataFrame:
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeats)
    judged = ratios.withColumns({"base_failed": failed, "rule": rules.verdict()})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def _learned(ratios: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DecisionList:
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) == 0).alias("bad"))
    return learn(ratios.join(known, "id"), "bad", "id")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least_words: int = 50, most_repeats: int = 50) -> DataFrame:
    """One row per document: the statistics, base_failed, rule (number of the learned rule that rejects it) and kept.

    base_failed: fewer than `least_words` words, or more than `most_repeats` per cent of them in repeated windows. The
    decision list is learned for label 0 from all labelled documents; null labels and labels without a document are
    not used, and a document with two labels counts twice. kept: neither base_failed nor rejected by a rule.
    Null or empty text: zero counts, base_failed. Null ids and repeated rows are kept as rows of their own.
    """
    ratios = with_ratios(cut(text_statistics(docs, id_col, text_col)))
    rules = _learned(ratios, labels, id_col, label_col)
    return _judged(ratios, rules, least_words, most_repeats).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule", *[k for k in RATIOS if k != "words"]
    )


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least_words: int = 50, most_repeats: int = 50) -> DataFrame:
    """The rows of docs that quality_rules keeps. Learns from the statistics of a first pass, and judges each row by
    those of a second one in the same scan that returns it, so that no text is shuffled."""
    rules = _learned(with_ratios(cut(text_statistics(docs, id_col, text_col))), labels, id_col, label_col)
    judged = _judged(with_ratios(text_statistics(docs, id_col, text_col, rows=True)), rules, least_words, most_repeats)
    # as a generator: a filter would be pushed below the projections, and work out each array anew for each of its elements
    return judged.select(F.inline(F.when(F.col("kept"), F.array("row"))))
