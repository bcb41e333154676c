"""Quality rules: a decision list learned by sequential covering, applied as ordered Spark
conditional expressions.

The statistics of a text are column expressions over one row; nothing is exploded or shuffled.
Labelled statistics (a bounded sample of numbers) are fitted on the driver: each rule is a
conjunction of thresholds, grown on two thirds of the sample by information gain and pruned on
the rest, and covers rows that earlier rules left over.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import first_by_unit, unit_hash, written

WORD = "[^\\x20\\x09-\\x0D]+"
GAPS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
#: Labelled rows the rules are fitted on at most, taken by a hash of their id.
MAX_FIT_ROWS = 20_000
#: A rule must be this precise on the pruning rows, and cover this many of them.
MIN_PRECISION = 0.95
MIN_COVER = 5
MAX_RULES = 12
MAX_TERMS = 4
THRESHOLDS = 64

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules may test: the statistics and ratios of them.
FEATURES = {
    "n_words": "n_words",
    "n_dup_lines": "n_dup_lines",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
}


#: Low bits of a sorted number that hold a window's place; the rest are high bits of its hash.
PLACE_BITS = 24


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of three words that occurs twice or more.

    Windows are hashed (64 bits); hash and place are packed into one number and sorted, so equal
    windows are neighbours. Where two neighbours agree in the packed bits of the hash but not in
    the whole, or a text has more windows than places, hash and place are sorted side by side
    instead. The places of repeated windows cover ``min(3, distance to the next)`` words each.
    Texts whose windows all differ are settled by the distinct count alone.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def span(places: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("at"))
        return F.aggregate(F.sort_array(places), state, lambda acc, p: F.struct(
            (acc.n + F.least(p - acc.at, F.lit(WINDOW))).alias("n"), p.alias("at")),
            lambda acc: acc.n)

    def repeated(sorted_: Column, same) -> Column:
        last = F.size(sorted_) - 1
        return F.filter(sorted_, lambda x, j: (
            (j > 0) & same(F.get(sorted_, F.greatest(j - 1, F.lit(0))), x)
            | (j < last) & same(F.get(sorted_, F.least(j + 1, last)), x)))

    def place(x: Column) -> Column:
        return x.bitwiseAND((1 << PLACE_BITS) - 1)

    def packed_span(windows: Column) -> Column:
        packed = F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(
            -(1 << PLACE_BITS)).bitwiseOR(i.cast("long"))))

        def alike(x, y):
            return F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)

        def settled(found: Column) -> Column:
            clash = F.exists(F.transform(found, lambda x, j: (j > 0) & alike(
                F.get(found, F.greatest(j - 1, F.lit(0))), x)
                & (F.get(windows, place(F.get(found, F.greatest(j - 1, F.lit(0)))).cast("int"))
                   != F.get(windows, place(x).cast("int")))), lambda c: c)
            return F.when(clash, paired_span(windows)).otherwise(
                span(F.transform(found, place)))

        return _let(_let(packed, lambda p: repeated(p, alike)), settled)

    def paired_span(windows: Column) -> Column:
        paired = F.array_sort(F.transform(windows, lambda h, i: F.struct(
            h.alias("h"), i.cast("long").alias("i"))))
        return span(F.transform(_let(paired, lambda p: repeated(p, lambda x, y: x.h == y.h)),
                                lambda x: x.i))

    def count(windows: Column) -> Column:
        return (F.when(F.size(F.array_distinct(windows)) == F.size(windows),
                       F.lit(0).cast("long"))
                .when(F.size(windows) >= 1 << PLACE_BITS, paired_span(windows))
                .otherwise(packed_span(windows)))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(_let(hashes, count))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               keep: list[str] = ()) -> DataFrame:
    """doc_id and the statistics of every whole text (null text: no words), plus ``keep``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"), *kept)
    words = F.filter(F.split(F.col("_text"), GAPS, -1), lambda w: w != "")
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    return rows.select(
        "doc_id", *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        _let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n"), repeat_words(w).alias("repeats"),
            F.char_length(F.array_join(w, "")).cast("long").alias("chars"))).alias("_w"),
        F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("*", F.col("_w.n").alias("n_words"), F.col("_w.chars").alias("word_chars"),
             F.col("_w.repeats").alias("n_repeat_words")).drop("_w")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(values: np.ndarray, bad: np.ndarray, names: list[str], prune: np.ndarray
          ) -> list[list[tuple[str, str, float]]]:
    """Sequential covering: rules that reject, each a conjunction of (name, '<=' or '>',
    threshold). ``prune`` marks the rows that rules are pruned and judged on."""
    rules, left = [], np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow = left & ~prune
        rule = _grow(values[grow], bad[grow], names)
        rule = _prune(rule, values[left & prune], bad[left & prune], names)
        if not rule:
            break
        hit = _covers(rule, values, names)
        judged = hit & left & prune
        if judged.sum() < MIN_COVER or bad[judged].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def _covers(rule, values, names) -> np.ndarray:
    hit = np.ones(len(values), bool)
    for name, sign, limit in rule:
        column = values[:, names.index(name)]
        hit &= column <= limit if sign == "<=" else column > limit
    return hit


def _grow(values, bad, names):
    rule, inside = [], np.ones(len(bad), bool)
    while len(rule) < MAX_TERMS and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for f, name in enumerate(names):
            column = values[inside, f]
            limits = np.unique(np.quantile(column, np.linspace(0, 1, THRESHOLDS),
                                           method="lower"))
            for limit in limits[:-1]:
                low = column <= limit
                for sign, mask in (("<=", low), (">", ~low)):
                    p, n = (mask & bad[inside]).sum(), (mask & ~bad[inside]).sum()
                    if p and (gain := p * (np.log2(p / (p + n)) - base)) > best[0]:
                        above = column[column > limit].min()  # halfway to the next value
                        best = (gain, (name, sign, float((limit + above) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers(rule[-1:], values, names)
    return rule


def _prune(rule, values, bad, names):
    """The prefix of the rule that is worth most on rows it was not grown on."""
    def worth(part):
        hit = _covers(part, values, names)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0
    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (worth(part), -len(part)), default=[])


def expression(rules) -> Column:
    """The decision list: null when no rule fires, else the number of the first that does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        test = F.lit(True)
        for name, sign, limit in rule:
            value = F.expr(FEATURES[name])
            test = test & (value <= limit if sign == "<=" else value > limit)
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS):
    """Rules from the labelled rows (quality 0 is what they reject), at most ``max_rows`` of
    them by a hash of the id; rows that the base rule rejects anyway teach nothing. An id teaches
    once, however often it comes: by its lowest statistics."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .filter("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = (stats.filter(~base_failed()).join(known, "doc_id")
            .groupBy("doc_id").agg(F.min(F.struct(
                (F.col("quality") == 0).alias("bad"),
                *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])).alias("_row"))
            .select("doc_id", "_row.*", unit_hash("quality", F.col("doc_id")).alias("_u")))
    sample = first_by_unit(rows, "_u", ["doc_id"], max_rows).collect()
    if not sample:
        return []
    names = list(FEATURES)
    values = np.array([[r[n] for n in names] for r in sample], float)
    bad = np.array([r["bad"] for r in sample], bool)
    prune = np.arange(len(sample)) % 3 == 2
    return learn(values, bad, names, prune)


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept, rule (which rejected).

    Null and empty texts have no words and fail the base rule. Null ids are judged but teach
    nothing; repeated rows are judged each. Without usable labels there are no rules and the
    base rule decides. A document labelled twice counts as bad if either label says so. No
    rows: no rows. Other columns are not read.
    """
    stats = written(statistics(docs, id_col, text_col), "quality-stats")
    rules = fit(stats, labels, max_fit_rows)
    return judged(stats, rules).select("doc_id", *STATS, "base_failed", "kept", "rule")


def judged(stats: DataFrame, rules) -> DataFrame:
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", expression(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def without_rejected(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, without the rows that the base rule or the learned rules
    reject; the rules are fitted as in ``verdicts``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    packed = packed.select("row", F.col(f"row.`{id_col}`").alias("id"),
                           F.col(f"row.`{text_col}`").alias("text"))
    stats = written(statistics(packed, "id", "text", keep=["row"]), "quality-stats")
    rules = fit(stats.drop("row"), labels, max_fit_rows)
    return judged(stats, rules).filter("kept").select("row.*")
