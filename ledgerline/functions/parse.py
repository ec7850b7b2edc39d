"""Named-group extraction from messages and unit names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.regex import Pattern, compile_pattern

BODY_GROUP = "P_MESSAGE"


#: Stands between the groups of a match; a code point that no text should hold.
MARK = "\uffff"


def _once(value: Column) -> Column:
    """A generator of one row: what it computes is neither repeated nor pushed down.

    Filters and later columns read its result, where they would otherwise each
    get their own copy of the regex.
    """
    return F.explode_outer(F.array(value))


def _match(text: Column, pattern: Pattern) -> Column:
    """What one run of the pattern finds: [before, group, group, ...], or one element.

    The run replaces the whole text by its groups, in order of ``pattern.named``,
    each after a mark. Texts that hold the mark themselves take the slower way.
    """
    whole = f"\\A(?s:.*?)(?:{pattern.java})(?s:.*)\\z"
    numbers = [i for _, i in pattern.named]
    marked = F.regexp_replace(text, F.lit(whole), F.lit(MARK + MARK.join(f"${i}" for i in numbers)))
    each = [F.regexp_extract(text, pattern.java, i) for i in numbers]
    apart = F.when(F.rlike(text, F.lit(pattern.java)), F.array(F.lit(""), *(each or [F.lit("")]))).otherwise(F.array(text))
    return F.when(F.contains(text, F.lit(MARK)), apart).otherwise(F.split(marked, MARK, -1))


def _found(match: str) -> Column:
    return F.coalesce(F.size(match) > 1, F.lit(False))


def _groups(match: str, pattern: Pattern) -> dict[str, Column]:
    """Group text by name; empty where there is no match or the group took no part."""
    return {
        name: F.when(_found(match), F.col(match)[at]).otherwise("") for at, (name, _) in enumerate(pattern.named, 1)
    }


def _with_match(df: DataFrame, message: str, pattern: Pattern) -> DataFrame:
    """Add ``_match``: of the whole text, or else of its first line (``_first_line``)."""
    text = F.col(message)
    line_end = F.instr(text, "\n")
    df = df.select("*", _once(_match(text, pattern)).alias("_whole"))
    again = F.when(~_found("_whole") & (line_end > 0), _match(F.left(text, line_end - 1), pattern))
    df = df.select("*", _once(again).alias("_again"))
    return df.withColumns(
        {"_match": F.when(_found("_whole"), F.col("_whole")).otherwise(F.col("_again")), "_first_line": _found("_again")}
    )


def _rest(message: str) -> Column:
    """Lines after the first, empty unless only the first one matched."""
    return F.when(
        F.col("_first_line"),
        F.expr(f"substring(`{message}`, instr(`{message}`, '\\n') + 1)"),
    ).otherwise("")


def _with_body(groups: dict[str, Column], rest: Column) -> dict[str, Column]:
    if BODY_GROUP not in groups:
        return groups
    body = groups[BODY_GROUP]
    joined = F.when(body == "", rest).otherwise(F.concat(body, F.lit("\n"), rest))
    return {**groups, BODY_GROUP: F.when(rest != "", joined).otherwise(body)}


def _collect(existing: Column | None, groups: dict[str, Column], override: Column | None = None) -> Column:
    """``existing`` plus the non-empty groups; keys already there keep their value.

    Where ``override`` holds, the body group replaces an existing one.
    """
    entries = F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in groups.items()])
    found = F.map_from_entries(F.filter(entries, lambda e: e["value"] != ""))
    if existing is None:
        return found
    kept = existing
    if override is not None:
        kept = F.when(override, F.map_filter(existing, lambda k, _: k != BODY_GROUP)).otherwise(existing)
    fresh = F.map_filter(found, lambda k, _: ~F.map_contains_key(kept, k))
    return F.when(F.coalesce(F.size(existing), F.lit(0)) <= 0, found).otherwise(F.map_concat(kept, fresh))


def parse_record(
    df: DataFrame,
    message_pattern: str | None = None,
    unit_pattern: str | None = None,
    no_match: str = "send_raw",
    message: str = "message",
    unit: str = "systemd_unit",
    parsed: str = "parsed",
    matched: str | None = None,
) -> DataFrame:
    """Add the groups of both patterns to the ``parsed`` map.

    The message pattern is tried on the whole text, then on its first line; in
    the second case the other lines are appended to the body group. With
    ``no_match='skip'`` messages that do not match are dropped. A unit that
    does not match never drops a row, and message groups win on a name clash.
    """
    if no_match not in ("send_raw", "skip"):
        raise ValueError(f"no_match must be send_raw or skip, not {no_match!r}")
    columns = df.columns
    existing = F.col(parsed) if parsed in columns else None
    groups: dict[str, Column] = {}
    override = None
    if message_pattern:
        pattern = compile_pattern(message_pattern)
        df = _with_match(df, message, pattern)
        if no_match == "skip":
            df = df.filter(_found("_match"))
        rest = _rest(message)
        groups = _with_body(_groups("_match", pattern), rest)
        if BODY_GROUP in groups:
            override = F.coalesce(rest != "", F.lit(False))
    if unit_pattern:
        pattern = compile_pattern(unit_pattern)
        df = df.select("*", _once(_match(F.col(unit), pattern)).alias("_unit_match"))
        for name, value in _groups("_unit_match", pattern).items():
            groups[name] = F.when(groups[name] != "", groups[name]).otherwise(value) if name in groups else value
    if groups:
        result = _collect(existing, groups, override)
    elif existing is not None:
        result = existing
    else:
        result = F.create_map().cast("map<string,string>")
    out = [F.col(c) for c in columns if c != parsed]
    if matched and message_pattern:
        out.append(_found("_match").alias(matched))
    return df.select(*out, result.alias(parsed))


def parse_message(
    df: DataFrame, pattern: str, message: str = "message", parsed: str = "parsed", matched: str = "matched"
) -> DataFrame:
    """The message pattern alone, with a ``matched`` flag."""
    return parse_record(df, pattern, None, "send_raw", message, parsed=parsed, matched=matched)


def parse_unit(df: DataFrame, pattern: str, unit: str = "systemd_unit", parsed: str = "parsed") -> DataFrame:
    """The unit pattern alone."""
    return parse_record(df, None, pattern, unit=unit, parsed=parsed)
