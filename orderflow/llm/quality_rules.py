"""Quality rules: a table of thresholds compiled into one projection.

``statistics`` gives every number the rules look at; ``compile_rules`` turns the
table into a boolean column over them. No user functions, no shuffle.

Words are runs without white space, lines are split at newlines. A window of five
words counts as repeated when its 64-bit hash occurs twice in the text.

Defined cases: a null text has no words and fails the base rules; ratios over
nothing are 0; repeated rows each get their own result. An empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.text import SPACE, SPACES, bound, whole, words

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"

#: Very common words of the languages that the corpus is expected to hold.
STOP_WORDS = {
    "en": "the of and to in is that it for on with as was be by at this are or an from not he a".split(),
    "fr": "le la les de des du un une et en est que qui dans pour par sur au il elle pas ne plus".split(),
    "de": "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "es": "el la los las de del un una y en que es por con para se no su al lo como más o".split(),
}


@dataclass(frozen=True)
class Rule:
    """``value`` must lie in [least, most], where set, once the text has ``from_words`` words."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The threshold table; values are SQL expressions over the statistics.
RULES = (
    Rule("length", "n_words", least=10),
    Rule("repeats", "100 * n_repeat_words / n_words", most=20),
    Rule("word_length", "1.0 * word_chars / n_words", least=2, most=15),
    Rule("symbols", "1.0 * n_symbols / n_words", most=0.1),
    Rule("stop_words", "1.0 * n_stop_words / n_words", least=0.02, from_words=50),
    Rule("capitals", "1.0 * n_capitals / word_chars", most=0.3),
    Rule("echoes", "1.0 * n_echo_words / n_words", most=0.2),
    Rule("duplicate_lines", "1.0 * n_dup_lines / n_lines", most=0.5, from_words=50),
    Rule("ellipsis_lines", "1.0 * n_ellipsis_lines / n_lines", most=0.3),
    Rule("bullet_lines", "1.0 * n_bullet_lines / n_lines", most=0.9),
)
BASE = ("length", "repeats")


def _n(value: Column) -> Column:
    return value.cast("long")


def _lost(text: Column, pattern: str) -> Column:
    """Number of characters that match a one-character pattern."""
    return _n(F.length(text) - F.length(F.regexp_replace(text, pattern, "")))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sorts the windows, keeps
    those with an equal neighbour and adds up the stretches they cover."""

    def positions(ranked: Column) -> Column:
        return F.array_sort(
            F.filter(
                F.transform(
                    ranked,
                    lambda x, j: F.when(
                        (F.get(ranked, j + 1)["h"] == x["h"])
                        | ((j > 0) & (F.get(ranked, j - 1)["h"] == x["h"])),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        )

    def stretch(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)

    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bound(bound(ranked, positions), stretch)


def n_repeat_words(tokens: Column) -> Column:
    def repeated(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _covered(hashes)
        )

    starts = F.sequence(F.lit(0), F.size(tokens) - WINDOW)
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(WINDOW)))
    )
    return F.when(F.size(tokens) <= WINDOW, F.lit(0).cast("long")).otherwise(bound(hashes, repeated))


def n_stop_words(tokens: Column) -> Column:
    known = sorted(set().union(*STOP_WORDS.values()))
    return _n(F.size(F.filter(tokens, lambda w: F.lower(F.rtrim(w, F.lit(".,;:"))).isin(known))))


def n_echo_words(tokens: Column) -> Column:
    """Words equal to the one before."""
    return _n(F.size(F.filter(tokens, lambda w, i: (i > 0) & (F.get(tokens, i - 1) == w))))


def _token_statistics(tokens: Column) -> Column:
    return F.struct(
        _n(F.size(tokens)).alias("n_words"),
        n_repeat_words(tokens).alias("n_repeat_words"),
        n_stop_words(tokens).alias("n_stop_words"),
        n_echo_words(tokens).alias("n_echo_words"),
    )


def _line_statistics(lines: Column) -> Column:
    return F.struct(
        _n(F.size(lines)).alias("n_lines"),
        _n(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        _n(F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…")))).alias(
            "n_ellipsis_lines"
        ),
        _n(F.size(F.filter(lines, lambda x: F.ltrim(x, F.lit(SPACES)).rlike(r"^[-*•]")))).alias(
            "n_bullet_lines"
        ),
    )


def full_lines(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and every statistic of its text."""
    text = whole("text")
    return docs.select(
        "doc_id",
        F.length(F.regexp_replace(text, f"{SPACE}++", "")).cast("long").alias("word_chars"),
        _lost(text, SYMBOLS).alias("n_symbols"),
        _lost(text, "[A-Z]").alias("n_capitals"),
        bound(words(text), _token_statistics).alias("t"),
        bound(full_lines(text), _line_statistics).alias("l"),
    ).select("doc_id", "word_chars", "n_symbols", "n_capitals", "t.*", "l.*")


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where a text meets every rule; a ratio over nothing counts as 0."""
    verdict = F.lit(True)
    for rule in rules:
        value = F.coalesce(F.expr(f"try_divide({_parts(rule.value)})"), F.lit(0.0))
        met = F.lit(True)
        if rule.least is not None:
            met &= value >= rule.least
        if rule.most is not None:
            met &= value <= rule.most
        verdict &= met | (F.col("n_words") < rule.from_words)
    return verdict


def _parts(value: str) -> str:
    over, _, under = value.partition(" / ")
    return f"{over}, {under or '1'}"


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Statistics with base_failed and the verdict of all rules."""
    base = tuple(rule for rule in rules if rule.name in BASE)
    return statistics(docs).select(
        "*", (~compile_rules(base)).alias("base_failed"), compile_rules(rules).alias("kept")
    )
