"""Quality rules: one table of thresholds, compiled into one projection of built-in functions."""

from pyspark.sql import functions as F

from pergamon.llm.text import SPACE_RUN, SPACES

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with as was on be by are this from at or an not "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an "
    "le la les de des et en un une du que qui dans pour par sur est pas au avec ce il "
    "el los las y una se no su con para como más lo pero sus al del por"
).split()

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"

#: Words of a window whose repetition counts.
WINDOW = 8

#: (rule, measure, comparison that rejects, threshold). A document that meets no row is kept.
RULES = (
    ("short_words", "word_chars / n_words", "<", 2.0),
    ("long_words", "word_chars / n_words", ">", 16.0),
    ("symbols", "n_symbols / n_words", ">", 0.25),
    ("exclamations", "n_exclamations / n_words", ">", 0.4),
    ("stop_words", "n_stop_words / n_words", "<", 0.02),
    ("echoed_words", "n_echo_words / n_words", ">", 0.3),
    ("duplicate_lines", "n_dup_lines / n_lines", ">", 0.5),
    ("bullet_lines", "n_bullet_lines / n_lines", ">", 0.9),
    ("cut_lines", "n_cut_lines / n_lines", ">", 0.5),
)


def _measures(text):
    """Projections in turn; each names what the next one uses more than once."""
    words, n = F.col("_words"), F.col("n_words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    first = F.btrim(text, F.lit(SPACES))
    yield {"_trimmed": first}
    split = F.split("_trimmed", SPACE_RUN)
    yield {"_words": F.when(F.length("_trimmed") > 0, split).otherwise(F.array().cast("array<string>")),
           "_lines": lines}
    yield {"n_words": F.size(words).cast("long"), "n_lines": F.size("_lines").cast("long")}
    yield {
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_exclamations": F.regexp_count(text, F.lit("!")).cast("long"),
        "n_dup_lines": (F.col("n_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: x.rlike("^[ \\t]*[-*\\u2022]"))).cast("long"),
        "n_cut_lines": F.size(F.filter("_lines", lambda x: x.rlike("(\\.\\.\\.|\\u2026)[ \\t\\r]*$"))).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "_h": F.transform(words, lambda w: F.xxhash64(w)),
    }
    last, next_ = (F.slice("_h", F.lit(i), F.greatest(F.size("_h") - 1, F.lit(0))) for i in (1, 2))
    echo = F.filter(F.zip_with(last, next_, lambda a, b: a == b), lambda same: same)
    yield {"n_echo_words": F.size(echo).cast("long")}
    # hashes of 2, 4, then 8 words in a row, each from two of the step before
    for step, (name, made) in enumerate((("_h", "_h2"), ("_h2", "_h4"), ("_h4", "_h8"))):
        shift = 2 ** step
        left = F.slice(name, F.lit(1), F.greatest(F.size(name) - shift, F.lit(0)))
        right = F.slice(name, F.lit(shift + 1), F.greatest(F.size(name) - shift, F.lit(0)))
        yield {made: F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))}
    yield {"_hit": F.size(F.array_distinct("_h8")) < F.size("_h8")}
    # only texts in which two windows have one hash are looked at word by word
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.struct(F.concat_ws(" ", F.slice(words, i, WINDOW)).alias("w"), i.alias("i")),
    )
    nothing = F.array().cast("array<struct<w:string,i:int>>")
    yield {"_sorted": F.when(F.col("_hit"), F.sort_array(windows)).otherwise(nothing)}
    one_on = F.slice("_sorted", F.lit(2), F.greatest(F.size("_sorted") - 1, F.lit(0)))
    yield {"_pairs": F.filter(
        F.zip_with(F.slice("_sorted", F.lit(1), F.greatest(F.size("_sorted") - 1, F.lit(0))), one_on,
                   lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"]))),
        lambda x: x.isNotNull())}
    yield {"_at": F.array_sort(F.array_distinct(F.flatten("_pairs")))}
    gaps = F.zip_with(
        F.slice("_at", F.lit(1), F.greatest(F.size("_at") - 1, F.lit(0))),
        F.slice("_at", F.lit(2), F.greatest(F.size("_at") - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda total, x: total + x)
    yield {"n_repeat_words": F.when(F.size("_at") > 0, covered).otherwise(F.lit(0).cast("long"))}


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_exclamations", "n_stop_words", "n_echo_words", "n_bullet_lines", "n_cut_lines")


def _compiled(rules):
    """An array of the names of the rules that a row breaks; a ratio over zero breaks none."""
    def broken(measure, comparison, threshold):
        over, under = (F.col(x.strip()).cast("double") for x in measure.split("/"))
        ratio = F.when(under > 0, over / under)
        return ratio < threshold if comparison == "<" else ratio > threshold

    named = [F.when(broken(m, c, t), F.lit(name)) for name, m, c, t in rules]
    return F.filter(F.array(*named), lambda x: x.isNotNull())


def quality_rules(docs, text="text", rules=RULES, min_words=20, max_repeat_percent=30):
    """All columns of `docs`, their measures, the rules broken, and whether the document is kept.

    Everything is one row's own work: no shuffle, and the time is n log n in the longest text. Null
    and empty texts have zero for every measure and are rejected for their length. Columns of `docs`
    that have a measure's name, or begin with the reserved `_q_`, don't clash: the input travels in a
    struct and its columns are replaced by the measures of the same name. Repeated rows stay repeated.
    """
    kept = [c for c in docs.columns if c not in (*MEASURES, "base_failed", "kept", "broken_rules")]
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    have = ["_row", "_text"]
    for step in _measures(F.col("_text")):
        out = out.select(*have, *[v.alias(k) for k, v in step.items()])
        have += list(step)
    base = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    # A filter on `kept` must stay above the measures: pushed below them it would hold every step's
    # expression inside the next one's, and run it for each word. No filter moves below a row number.
    out = out.select("_row", *MEASURES, F.monotonically_increasing_id().alias("_at"))
    out = out.select("_row", *MEASURES, base.alias("base_failed"), _compiled(rules).alias("broken_rules"), "_at")
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in kept], *MEASURES, "base_failed", "broken_rules",
        (~F.col("base_failed") & (F.size("broken_rules") == 0) & (F.col("_at") >= 0)).alias("kept"),
    )
