"""Quality rules: a threshold table compiled into one projection over each text.

All measures come from one pass over the words and lines of the whole text, in built-in expressions;
the rules become Boolean columns of the same projection, so there is neither a shuffle nor a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import indices, let, words

# Frequent function words of the corpus's languages.
STOP_WORDS = {
    "en": "the of and to in is that for on with as by this are was be at from or an it a have not you he she they we",
    "fr": "le la les de des du et en un une que qui dans pour sur est avec par au aux ce il elle ne pas",
    "de": "der die das und in zu den von mit ist des im für auf dem ein eine als auch sich nicht es an",
    "es": "el la los las de del y en un una que por con para se es su al lo como más no",
}


@dataclass(frozen=True)
class Rule:
    """A text passes if ``per`` times its measure is within [least, most] times ``of``; all bounds are integers,
    so that a text exactly on a bound is judged alike everywhere. ``base`` rules are named apart in the result."""

    name: str
    measure: str
    least: int | None = None
    most: int | None = None
    per: int = 1
    of: str | None = None
    base: bool = False


#: Production thresholds.
RULES = (
    Rule("enough_words", "n_words", least=50, base=True),
    Rule("few_repeated_words", "n_repeat_words", most=50, per=100, of="n_words", base=True),
    Rule("word_length_low", "word_chars", least=2, of="n_words"),
    Rule("word_length_high", "word_chars", most=15, of="n_words"),
    Rule("few_symbols", "n_symbols", most=10, per=100, of="n_words"),
    Rule("stop_words", "n_stop_words", least=5, per=100, of="n_words"),
    Rule("few_repeated_lines", "n_dup_lines", most=50, per=100, of="n_lines"),
)


def _repeated(w: Column) -> Column:
    """Words of ``w`` in windows of three that occur twice or more.

    The windows are sorted by their words' hash; equal neighbours are repeats. Over the sorted starts of
    repeats, each adds the words up to the next start, three at most.
    """
    window = indices(F.size(w) - 2)
    keyed = F.transform(window, lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")))

    def starts(s: Column) -> Column:
        alike = lambda x, i, by: F.coalesce(F.get(s, i + by)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, i: alike(x, i, -1) | alike(x, i, 1)), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda a, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - a, F.lit(3))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)

    return let(F.sort_array(keyed), lambda s: let(starts(s), covered))


def measures(text: Column) -> Column:
    """One-element array of a struct with every measure of the text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    stop = sorted({x for ws in STOP_WORDS.values() for x in ws.split()})
    count = lambda c: c.cast("long")

    def of(w: Column, x: Column) -> Column:
        return F.struct(
            count(F.size(w)).alias("n_words"),
            count(F.char_length(F.array_join(w, ""))).alias("word_chars"),
            count(F.regexp_count(text, F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
            count(F.size(F.filter(w, lambda t: F.lower(t).isin(stop)))).alias("n_stop_words"),
            count(F.size(x)).alias("n_lines"),
            count(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            _repeated(w).alias("n_repeat_words"))

    return F.transform(F.array(F.struct(words(text).alias("w"), lines.alias("x"))), lambda p: of(p["w"], p["x"]))


def failed(rule: Rule) -> Column:
    """True where a text breaks the rule."""
    value = F.col(rule.measure) * F.lit(rule.per)
    scale = F.col(rule.of) if rule.of else F.lit(1)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (value < F.lit(rule.least) * scale)
    if rule.most is not None:
        broken = broken | (value > F.lit(rule.most) * scale)
    return broken


def judge(docs: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, its measures, ``failed_rules``, ``base_failed`` and ``kept``.

    One row per row, repeated rows included. Null and empty texts have no words: all measures 0, so
    ``enough_words`` fails. A text on a bound passes. Columns of ``docs`` that are not in ``keep`` are
    not read; one in ``keep`` may not have the name of a measure.
    """
    measured = docs.select(*[F.col(c) for c in keep], F.inline(measures(F.col(text))))
    names = F.array_compact(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]))
    base = [failed(r) for r in rules if r.base]
    any_base = base[0] if base else F.lit(False)
    for b in base[1:]:
        any_base = any_base | b
    return measured.withColumns({"failed_rules": names, "base_failed": any_base}).withColumn(
        "kept", F.size("failed_rules") == 0)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass every rule, all columns as they were."""
    cols = docs.columns
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.inline(measures(F.col("text"))))
    good = F.lit(True)
    for r in rules:
        good = good & ~failed(r)
    return judged.where(good).select(*[F.col("row")[c].alias(c) for c in cols])
