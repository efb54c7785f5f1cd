r"""Line-first quality rules, from DataFrame functions only.

Each line of a text is held against punctuation, navigation and boilerplate rules. Lines that fail are
removed; a document that loses too much of its words with them, or keeps too few, is rejected, and so is
one that fails the counts over the whole text (too few words, too many words in repeated windows).

Everything is worked out within a row, so there is no shuffle and no group that could grow hot. Costs are
n log n in the words of a text with repeated windows and linear in all others. Arrays that are used more
than once are bound by ``let``, and the verdict leaves by a generator, past which no filter is pushed, so
that nothing is worked out twice.

Results in the corner cases: a null or empty text has no words and fails; texts of any length are read to
their end; equal rows get equal results, one each; an empty table gives no rows; a null in another column
does not matter, and other columns, whatever their names, are not passed on.
"""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import let

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
#: A document is rejected if more than this share of its words lies in removed lines.
MAX_LOST_PERCENT = 40

#: Punctuation: a line ends in one of these, if need be inside quotes or brackets.
END_MARKS = ".!?:;…。！？\"'”’»)]"
#: Navigation: a line with so many separators, or a short one that holds a menu item alone.
SEPARATORS, MAX_SEPARATORS = "|»›•·>", 2
MENU_CHARS = 40
MENU = (
    r"(?i)^[^A-Z]*(home|menu|log ?in|sign (in|up)|register|next|previous|back to top|read more|share this"
    r"|skip to content)[^A-Z]*\z"
)
#: Boilerplate: runs of symbols or exclamation marks, lines in capitals, and stock phrases.
SYMBOL_RUNS, MAX_SYMBOL_RUNS = ("###", "***", "$$$", "%%%", "&&&"), 1
MAX_EXCLAMATIONS = 2
SHOUTED_WORDS = 3
PHRASES = (
    "cookie policy", "cookie settings", "cookie consent", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "javascript", "lorem ipsum", "click here",
)


def without(text: Column, chars) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_in(text: Column) -> Column:
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def times(text: Column, part: str) -> Column:
    """How often ``part`` occurs, from left to right."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def line_rules(line: Column) -> dict[str, Column]:
    """Rule -> whether a line with words fails it."""
    # One look for any of the marks spares most lines the counts.
    marked = line.rlike("[" + SEPARATORS + "#*$%&!]")
    return {
        "no_end_mark": ~F.right(F.rtrim(line, F.lit(SPACES)), F.lit(1)).isin(*END_MARKS),
        "navigation": marked & (F.length(line) - F.length(without(line, SEPARATORS)) > MAX_SEPARATORS),
        "menu": (F.length(line) <= MENU_CHARS) & line.rlike(MENU),
        "symbols": marked & (reduce(add, [times(line, r) for r in SYMBOL_RUNS]) > MAX_SYMBOL_RUNS),
        "exclamations": marked & (times(line, "!!") > MAX_EXCLAMATIONS),
        "shouted": ~line.rlike("[a-z]") & line.rlike("[A-Z]") & (F.size(words_in(line)) >= SHOUTED_WORDS),
        "boilerplate": let(F.lower(line), lambda small: reduce(or_, [small.contains(p) for p in PHRASES])),
    }


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def fails_a_rule(line: Column) -> Column:
    rules = line_rules(line)
    counts = [rules.pop(k) for k in ("navigation", "symbols", "exclamations")]
    return has_word(line) & (reduce(or_, rules.values()) | reduce(or_, counts))


def failed_rules(line: Column) -> Column:
    """Names of the rules that a line fails."""
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in line_rules(line).items()]))


def window_hashes(words: Column) -> Column:
    """Hash of each window of words."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda own: F.transform(starts, lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WINDOW)])),
    )


def repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more.

    Only a text with two equal hashes is looked at closer: windows are sorted by hash, neighbours compared
    word for word, and the positions of those that repeat are laid over the text.
    """
    none = F.lit(False)

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (F.slice(words, x["p"], WINDOW) == F.slice(words, y["p"], WINDOW))

    def covered(positions: Column) -> Column:
        step = lambda p, i: F.coalesce(F.get(positions, i + 1) - p, F.lit(WINDOW))
        return total(F.transform(positions, lambda p, i: F.least(F.lit(WINDOW), step(p, i))))

    def repeats(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, i: F.coalesce(same(x, F.get(ordered, i - 1)), none)
            | F.coalesce(same(x, F.get(ordered, i + 1)), none),
        )
        return let(F.sort_array(F.transform(again, lambda x: x["p"])), covered)

    def closer(hashes: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(F.sort_array(marked), repeats)
        )

    return let(window_hashes(words), closer)


def _judged(raw: Column, text: Column, words: Column, lines: Column, failed: Column, texts: bool) -> Column:
    """The result's columns as a struct; ``failed`` tells of each line whether it fails a rule."""
    spoken = F.filter(lines, has_word)
    bad = F.filter(lines, lambda line, i: F.get(failed, i))
    values = {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(without(text, SPACES)).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(without(text, SYMBOLS))).cast("bigint"),
        "n_dup_lines": let(spoken, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(spoken).cast("bigint"),
        "n_removed_lines": F.size(bad).cast("bigint"),
        "lost_words": total(F.transform(bad, lambda line: F.size(words_in(line)).cast("bigint"))),
    }
    if texts:
        stay = F.filter(lines, lambda line, i: ~F.get(failed, i))
        values["cleaned_text"] = F.when(raw.isNotNull(), F.array_join(stay, "\n"))
        values["removed"] = F.transform(bad, lambda x: F.struct(x.alias("line"), failed_rules(x).alias("rules")))
    return F.struct(*[v.alias(k) for k, v in values.items()])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """Counts, verdict and cleaned text of each document.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``n_lines``, ``n_removed_lines``, ``lost_words``, and with ``texts``
    ``cleaned_text``, the lines that stay (null if the text is), and ``removed`` (line, rules it failed).
    """
    raw = F.col(text_col)
    judged = let(
        F.coalesce(raw, F.lit("")),
        lambda text: let(
            F.split(text, "\n"),
            lambda lines: let(
                words_in(text),
                lambda words: let(
                    F.transform(lines, fails_a_rule), lambda bad: _judged(raw, text, words, lines, bad, texts)
                ),
            ),
        ),
    )
    rows = docs.select(F.col(id_col), F.explode(F.array(judged)).alias("__judged"))
    q = F.col("__judged")
    failed = (q.n_words < MIN_WORDS) | (100 * q.n_repeat_words > MAX_REPEATED_PERCENT * q.n_words)
    good = (100 * q.lost_words <= MAX_LOST_PERCENT * q.n_words) & (q.n_words - q.lost_words >= MIN_WORDS)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        id_col,
        *[q[c].alias(c) for c in counts],
        failed.alias("base_failed"),
        (~failed & good).alias("kept"),
        *[q[c].alias(c) for c in ("n_lines", "n_removed_lines", "lost_words")],
        *[q[c].alias(c) for c in (("cleaned_text", "removed") if texts else ())],
    )


def keep_good(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents that are kept, with cleaned texts, in the columns of ``docs``."""
    one = docs.withColumn("__row", F.struct(*docs.columns)).select("__row", F.col(text_col).alias("__doc_text"))
    judged = quality_rules(one, "__row", "__doc_text").filter("kept")
    new = {text_col: F.col("cleaned_text"), chars_col: F.length("cleaned_text").cast("bigint")}
    return judged.select(*[new[c].alias(c) if c in new else F.col("__row")[c].alias(c) for c in docs.columns])
