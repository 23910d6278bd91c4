"""Rule-based quality filter: a table of thresholds compiled into one
projection.

Every measure is a built-in expression over one row, so the plan is a scan and
projections: no shuffle, no user function, and memory bounded by a document.

Defined cases: a null text has no words and fails (fewer than ``min_words``);
an empty text likewise. Repeated rows are judged alike. Columns of the input
whose names equal a measure's are not read and are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD_RE, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so".split(),
    "fr": "le la les de des du un une et est en que qui dans pour pas sur par au aux avec ce se il elle ne plus son sa ses ou mais nous vous ils cette".split(),
    "de": "der die das und in den von zu ist mit sich auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über".split(),
    "es": "el la los las de del y en que un una es por con para no se su al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son".split(),
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [low, high]; None: no bound."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The production table.
RULES = (
    Rule("words_few", "n_words", 50, None),
    Rule("words_many", "n_words", None, 1_000_000),
    Rule("word_length", "mean_word_chars", 2.5, 14),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("alphabetic", "alpha_ratio", 0.7, None),
    Rule("stop_words", "stop_ratio", 0.05, None),
    Rule("dup_lines", "dup_line_ratio", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.4),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("repeat_words", "repeat_ratio", None, 0.5),
)

#: Rules whose failure is the base verdict of the contract.
BASE = ("words_few", "repeat_words")


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside a 3-word window that the text holds
    twice or more. Windows are sorted inside the row; equal neighbours are
    repeats, and the union of their spans is counted."""
    w = F.col("__w")
    n = F.size(w)
    grams = F.when(n >= 3, F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))))
    df = df.withColumn("__g", F.coalesce(grams, F.array().cast("array<string>")))
    g = F.col("__g")
    # most texts have no repeat at all: the sort runs for the others only
    df = df.withColumn("__s", F.when(F.size(F.array_distinct(g)) < F.size(g), F.array_sort(
        F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))))
    s = F.col("__s")

    def start(x: Column, j: Column) -> Column:
        same = F.coalesce(F.get(s, j - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["g"] == x["g"], F.lit(False))
        return F.when(same, x["i"]).otherwise(F.lit(-1))

    df = df.withColumn("__r", F.filter(F.sort_array(F.transform(s, start)), lambda x: x >= 0))
    r = F.col("__r")
    spans = F.transform(r, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(r, j + 1) - x, F.lit(3))))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


def measures(df: DataFrame, text: str = "text", stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` with every measure that a rule may name."""
    every = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    has_word = r"[^\x20\x09-\x0D]"
    df = df.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    t = F.col("__t")
    df = (df.withColumn("__w", words(t))
          .withColumn("__l", F.filter(F.split(t, "\n"), lambda x: x.rlike(has_word))))
    df = _repeated_words(df)
    w, lines = F.col("__w"), F.col("__l")
    count = lambda c: c.cast("long")
    df = df.withColumns({
        "n_words": count(F.size(w)),
        "word_chars": count(F.length(F.translate(t, " \t\n\x0b\x0c\r", ""))),
        "n_symbols": count(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))),
        "n_lines": count(F.size(lines)),
        "n_dup_lines": count(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_stop_words": count(F.size(F.filter(w, lambda x: F.lower(x).isin(every)))),
        "n_alpha_words": count(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))),
        "n_ellipsis_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")))),
        "n_bullet_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•‣]")))),
    })
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return df.withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "alpha_ratio": ratio("n_alpha_words", "n_words"),
        "stop_ratio": ratio("n_stop_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullet_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
    }).drop("__t", "__w", "__l", "__g", "__s", "__r")


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Array of the names of the rules that a row of ``measures`` breaks."""
    broken = []
    for r in rules:
        m = F.col(r.measure)
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (m < F.lit(r.low))
        if r.high is not None:
            bad = bad | (m > F.lit(r.high))
        broken.append(F.when(bad, F.lit(r.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
          stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` with the measures, ``failed`` (names of broken rules),
    ``base_failed`` and ``kept``."""
    out = measures(df, text, stop_words).withColumn("failed", compile_rules(rules))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & (F.size("failed") == 0))
