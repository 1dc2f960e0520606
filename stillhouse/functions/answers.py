"""Reading a model's free-form answer: labels, free text, SQL statements."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from stillhouse.functions.once import let
from stillhouse.functions.text import collapse_space, dotall, extract, is_blank, rstrip_chars, strip, unicode

FENCE = "```"
# What opens an SQL statement in an answer.
SQL_FENCE = r"(?is)```sql.*"
SQL_STATEMENT = r"(?is)(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\b.*"
SQL_STATEMENT_OR_CTE = r"(?is)\b(?:SELECT|WITH|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\b.*"
SQL_FROM_KEYWORD = r"(?is)\b(select|with|insert|update|delete)\b.*"
SQL_LEADING_PROSE = r"(?is)^.*?\b(select|with|insert|update|delete)\b"
# WITH only opens a statement where a CTE name follows it.
SQL_STRICT_START = r"(?is)\b(?:(?:select|insert|update|delete)\b|with\s+(?:recursive\s+)?\w+\s*(?:\([^)]*\)\s*)?as\s*\().*"


def single_label(response: Column, labels: list[str], regex: str | None = None) -> Column:
    """The label an answer names, lower case, or null.

    The first match of ``regex`` wins if its group 1 is a label. Otherwise the first label, in
    list order, that occurs anywhere in the answer (substring, no word boundary).
    """
    known = list(dict.fromkeys(label.lower() for label in labels))
    if not known:
        return F.lit(None).cast("string")
    anywhere = let(
        F.lower(response),
        lambda low: F.coalesce(*[F.when(F.contains(low, F.lit(label)), F.lit(label)) for label in known]),
    )
    if not regex:
        return anywhere
    named = F.lower(strip(F.regexp_extract(response, unicode(regex), 1)))
    return let(named, lambda n: F.when(n.isin(known), n).otherwise(anywhere))


def whole_word_label(response: Column, labels: list[str], regex: str | None = None) -> Column:
    """Strict variant: labels match as whole words, and the earliest in the text wins."""
    known = list(dict.fromkeys(label.lower() for label in labels))
    if not known:
        return F.lit(None).cast("string")
    words = "|".join(re.escape(label) for label in sorted(known, key=len, reverse=True))
    earliest = extract(F.lower(response), rf"\b({words})\b")
    if not regex:
        return earliest
    named = F.lower(strip(F.regexp_extract(response, "(?i)" + unicode(regex), 1)))
    return F.when(named.isin(known), named).otherwise(earliest)


def _after(text: Column, length: int) -> Column:
    """The text without its first characters."""
    return F.substr(text, F.lit(length + 1))


def _fence_body(opened: Column, mark: int) -> Column:
    """What stands between an opening of ``mark`` characters and the next fence; null if there is none."""
    def upto_fence(rest: Column) -> Column:
        end = F.instr(rest, FENCE)
        return F.when(end > 0, F.substr(rest, F.lit(1), end - 1))

    return let(_after(opened, mark), upto_fence)


def fenced(text: Column) -> Column:
    """The first fenced block without its ``sql`` tag, stripped; null if there is none. Two looks for a fence, by position."""
    def body(at: Column) -> Column:
        inside = F.when(at > 0, _fence_body(F.substr(text, at), len(FENCE)))
        return let(inside, lambda b: strip(F.when(F.startswith(b, F.lit("sql")), _after(b, len("sql"))).otherwise(b)))

    return let(F.instr(text, FENCE), body)


def free_text(response: Column, regex: str | None = None, group_may_be_absent: bool = False) -> Column:
    """Regex group 1 (or the whole match), else the first fenced block, else the stripped text.

    Blank text gives null. ``group_may_be_absent`` is for patterns whose group 1 sits in one
    alternative only: an empty group then means the whole match.
    """
    plain = F.when(~is_blank(response), strip(response))
    otherwise = F.coalesce(fenced(response), plain)
    if not regex:
        return otherwise
    pattern = dotall(regex)
    whole = strip(F.regexp_extract(response, pattern, 0))
    if re.compile(regex).groups == 0:
        found = whole
    else:
        group = strip(F.regexp_extract(response, pattern, 1))
        found = F.when(group == "", whole).otherwise(group) if group_may_be_absent else group
    return F.when(response.rlike(pattern), found).otherwise(otherwise)


def sql_text(response: Column, strict: bool = False) -> Column:
    """The first SQL statement of an answer: in a fence tagged ``sql``, or from a keyword to the next ``;``, whichever starts first.

    The default keyword list has no WITH, so a CTE loses its head; ``strict`` keeps it. Only the first tag and the first
    keyword are looked at: if nothing closes them, nothing closes a later one. So the time is linear in the answer.
    """
    plain = F.when(~is_blank(response), strip(response))

    def chosen(fence: Column, keyword: Column) -> Column:
        def first(inside: Column) -> Column:
            ended = F.contains(keyword, F.lit(";"))
            statement = F.when(ended, strip(F.concat(F.substring_index(keyword, ";", 1), F.lit(";"))))
            earlier = inside.isNotNull() & (~ended | (F.length(fence) > F.length(keyword)))
            return F.when(earlier, inside).otherwise(F.coalesce(statement, fenced(response), plain))

        return let(F.when(fence != "", strip(_fence_body(fence, len("```sql")))), first)

    opened = F.regexp_extract(response, SQL_FENCE, 0)
    started = F.regexp_extract(response, SQL_STATEMENT_OR_CTE if strict else SQL_STATEMENT, 0)
    return let(opened, lambda fence: let(started, lambda keyword: chosen(fence, keyword)))


def sql_statement(response: Column, strict: bool = False) -> Column:
    """One statement ending in ``;`` with the prose before it cut away, or null.

    By default an answer without any SQL is kept as text; ``strict`` rejects it.
    """
    def isolated(parsed: Column) -> Column:
        if strict:
            return strip(extract(parsed, SQL_STRICT_START, 0))
        text = F.when(parsed != "", parsed).otherwise(strip(extract(response, SQL_FROM_KEYWORD, 0)))
        return strip(F.regexp_replace(text, SQL_LEADING_PROSE, "$1"))

    def terminated(text: Column) -> Column:
        return F.when(F.endswith(text, F.lit(";")), text).otherwise(F.concat(text, F.lit(";")))

    return let(let(sql_text(response, strict), isolated), terminated)


def comparable_sql(response: Column) -> Column:
    """SQL text for comparing: no trailing ``;``, single blanks, lower case; null if empty."""
    return let(
        sql_text(response),
        lambda parsed: F.when(parsed != "", F.lower(collapse_space(rstrip_chars(strip(parsed), ";")))),
    )
