"""Answer, context and token columns."""

from pyspark.sql import functions as F

from pergamon import fixed_values as V


def _col(column):
    return F.col(column) if isinstance(column, str) else column


def answer_from_html(html):
    """Inside of the first paragraph; the whole string if there is none.

    An empty paragraph is a match, so the test is on the pattern, not on the extract.
    """
    html = _col(html)
    return F.when(
        html.rlike(V.ANSWER_PATTERN), F.regexp_extract(html, V.ANSWER_PATTERN, 1)
    ).otherwise(html)


def has_html_tags(text):
    return _col(text).rlike(V.TAG_PATTERN)


def format_answer(answer, sources):
    """Answer paragraph, heading, and the sources in the order given."""
    items = F.transform(_col(sources), lambda s: F.concat(F.lit("<li>"), s, F.lit("</li>")))
    return F.concat(
        F.lit("<p>"), F.replace(_col(answer), F.lit("\n"), F.lit("<br>")),
        F.lit(f"</p><p>{V.SOURCES_HEADING}</p><ul>"), F.array_join(items, ""), F.lit("</ul>"),
    )


def passage(text):
    return F.concat(F.lit(V.PASSAGE_PREFIX), _col(text), F.lit(V.PASSAGE_SUFFIX))


def system_prompt(context):
    """The answering prompt with the context text, and nothing but the text, put in."""
    before, after = V.ANSWER_SYSTEM_PROMPT.split("{context}")
    return F.concat(F.lit(before), _col(context), F.lit(after))


def tokens(text):
    """Runs of letters and digits."""
    return F.regexp_extract_all(_col(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def last_content(messages):
    """Content of the last message of an array, whatever its role; NULL if there is none."""
    return F.try_element_at(_col(messages), F.lit(-1))["content"]


def history_of(messages):
    """User and assistant messages of an array in order; other roles are dropped."""
    kept = F.filter(_col(messages), lambda m: m["role"].isin("user", "assistant"))
    return F.transform(
        kept,
        lambda m: F.struct(
            F.when(m["role"] == "user", F.lit("human")).otherwise(F.lit("ai")).alias("speaker"),
            F.when(m["role"] == "user", m["content"])
            .otherwise(answer_from_html(m["content"])).alias("content"),
        ),
    )


def _message(speaker, content):
    return F.array(F.struct(F.lit(speaker).alias("speaker"), content.alias("content")))


def rewrite_messages(history):
    """What the rewriting model gets: its prompt, then the history in the order of turns."""
    return F.concat(_message("system", F.lit(V.REWRITE_SYSTEM_PROMPT)), _col(history))


def answer_messages(context, history):
    """What the answering model gets: its prompt with the context, then the history."""
    return F.concat(_message("system", system_prompt(context)), _col(history))
