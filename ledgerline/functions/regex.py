"""RE2 patterns for Spark's Java regex functions.

Log pipelines state their patterns in RE2 syntax. Spark evaluates Java
patterns, so a pattern is rewritten once, on the driver, while the plan is
built; named groups become plain groups plus a name -> index table.
"""

from __future__ import annotations

from dataclasses import dataclass

# RE2 character classes and their Java spelling inside brackets.
POSIX_CLASSES = {
    "alnum": "\\p{Alnum}",
    "alpha": "\\p{Alpha}",
    "ascii": "\\p{ASCII}",
    "blank": "\\p{Blank}",
    "cntrl": "\\p{Cntrl}",
    "digit": "\\p{Digit}",
    "graph": "\\p{Graph}",
    "lower": "\\p{Lower}",
    "print": "\\p{Print}",
    "punct": "\\p{Punct}",
    "space": "\\p{Space}",
    "upper": "\\p{Upper}",
    "word": "\\w",
    "xdigit": "\\p{XDigit}",
}
RE2_SPACE = "\\t\\n\\f\\r "


class PatternError(ValueError):
    """The pattern is malformed or lies outside RE2."""


@dataclass(frozen=True)
class Pattern:
    source: str
    java: str
    groups: dict[str, int]

    @property
    def named(self) -> list[tuple[str, int]]:
        return list(self.groups.items())


def compile_pattern(source: str) -> Pattern:
    out: list[str] = []
    groups: dict[str, int] = {}
    n_groups = 0
    multiline = False
    scopes: list[bool] = []
    can_repeat = False
    i, n = 0, len(source)

    while i < n:
        ch = source[i]
        if ch == "\\":
            text, i = _escape(source, i, in_class=False)
            out.append(text)
            can_repeat = True
        elif ch == "[":
            text, i = _bracket(source, i)
            out.append(text)
            can_repeat = True
        elif ch == "(":
            scopes.append(multiline)
            can_repeat = False
            if not source.startswith("(?", i):
                n_groups += 1
                out.append("(")
                i += 1
            elif source.startswith(("(?P<", "(?<"), i) and source[i : i + 4] not in ("(?<=", "(?<!"):
                start = source.index("<", i) + 1
                end = source.find(">", start)
                name = source[start:end] if end > 0 else ""
                if not name or not all(c.isalnum() or c == "_" for c in name):
                    raise PatternError(f"invalid group name in {source!r}")
                if name in groups:
                    raise PatternError(f"duplicate group name {name!r}")
                n_groups += 1
                groups[name] = n_groups
                out.append("(")
                i = end + 1
            else:
                end = i + 2
                while end < n and source[end] in "imsU-":
                    end += 1
                if end >= n or source[end] not in ":)":
                    raise PatternError(f"unsupported group in {source!r}")
                flags = source[i + 2 : end]
                if "U" in flags:
                    raise PatternError("the ungreedy flag U has no Spark equivalent")
                on, _, off = flags.partition("-")
                if "m" in on:
                    multiline = True
                if "m" in off:
                    multiline = False
                # RE2 folds case by Unicode, Java only with the u flag.
                java_on = on + ("u" if "i" in on else "")
                java = java_on + ("-" + off if off else "")
                out.append(f"(?{java}{source[end]}")
                if source[end] == ")":
                    scopes.pop()
                i = end + 1
        elif ch == ")":
            if not scopes:
                raise PatternError(f"unmatched ) in {source!r}")
            multiline = scopes.pop()
            out.append(ch)
            can_repeat = True
            i += 1
        elif ch in "*+?" or (ch == "{" and _counted(source, i)):
            if not can_repeat:
                raise PatternError(f"nothing to repeat in {source!r}")
            end = i + 1 if ch != "{" else source.index("}", i) + 1
            out.append(source[i:end])
            if end < n and source[end] == "?":
                out.append("?")
                end += 1
            # A second quantifier is possessive in Java and an error in RE2.
            can_repeat = False
            i = end
        elif ch == "$" and not multiline:
            # Java's $ also matches before a final line feed; RE2's does not.
            out.append("\\z")
            can_repeat = True
            i += 1
        else:
            out.append("\\" + ch if ch in "{}]" else ch)
            can_repeat = ch not in "|"
            i += 1
    if scopes:
        raise PatternError(f"missing ) in {source!r}")
    # (?d): only LF ends a line, as in RE2.
    return Pattern(source, "(?d)" + "".join(out), groups)


def _counted(source: str, i: int) -> bool:
    end = source.find("}", i)
    body = source[i + 1 : end] if end > 0 else ""
    low, comma, high = body.partition(",")
    return low.isdigit() and (not comma or high == "" or high.isdigit())


def _escape(source: str, i: int, in_class: bool, negated: bool = False) -> tuple[str, int]:
    if i + 1 >= len(source):
        raise PatternError("trailing backslash")
    ch = source[i + 1]
    if ch == "Q" and not in_class:
        end = source.find("\\E", i + 2)
        body = source[i + 2 : end if end >= 0 else len(source)]
        quoted = "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in body)
        return f"(?:{quoted})", (end + 2 if end >= 0 else len(source))
    if ch in "pP":
        end = source.find("}", i) + 1 if source[i + 2 : i + 3] == "{" else i + 3
        return source[i:end], end
    if ch == "x" and source[i + 2 : i + 3] == "{":
        end = source.find("}", i) + 1
        return source[i:end], end
    if ch == "s":
        return (RE2_SPACE if in_class else f"[{RE2_SPACE}]"), i + 2
    if ch == "S":
        if in_class and negated:
            raise PatternError("\\S inside a negated class is not supported")
        return f"[^{RE2_SPACE}]", i + 2
    if ch.isdigit() and ch != "0":
        raise PatternError("back-references are not part of RE2")
    if ch in "zAbBdDwWatnrfv" or ch in "0x" or not ch.isalnum():
        if ch == "v":
            return "\\x0B", i + 2
        return source[i : i + 2], i + 2
    raise PatternError(f"unsupported escape \\{ch}")


def _bracket(source: str, i: int) -> tuple[str, int]:
    n = len(source)
    out = ["["]
    i += 1
    negated = source[i : i + 1] == "^"
    if negated:
        out.append("^")
        i += 1
    first = True
    while i < n and (source[i] != "]" or first):
        ch = source[i]
        if ch == "[" and source[i + 1 : i + 2] == ":":
            end = source.find(":]", i)
            name = source[i + 2 : end].lstrip("^") if end > 0 else ""
            if name not in POSIX_CLASSES:
                raise PatternError(f"unknown character class in {source!r}")
            java = POSIX_CLASSES[name]
            if source[i + 2] == "^":
                java = java[0] + java[1].upper() + java[2:]
            out.append(java)
            i = end + 2
        elif ch == "\\":
            text, i = _escape(source, i, in_class=True, negated=negated)
            out.append(text)
        else:
            # Java reads [ and && inside a class as set operations.
            out.append("\\" + ch if ch in "[]&" else ch)
            i += 1
        first = False
    if i >= n:
        raise PatternError(f"missing ] in {source!r}")
    out.append("]")
    return "".join(out), i + 1


def glob_to_java(mask: str) -> str | None:
    """An anchored Java pattern for a shell mask, or None when it is malformed.

    ``*`` and ``?`` stop at ``/``; a class is ``[...]`` or ``[^...]``.
    """
    out: list[str] = ["(?s)\\A"]
    i, n = 0, len(mask)
    while i < n:
        ch = mask[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            body, i = _glob_class(mask, i + 1)
            if body is None:
                return None
            out.append(body)
            continue
        elif ch == "\\":
            i += 1
            if i >= n:
                return None
            out.append(_quote(mask[i]))
        else:
            out.append(_quote(ch))
        i += 1
    return "".join(out) + "\\z"


def _glob_class(mask: str, i: int) -> tuple[str | None, int]:
    negated = mask[i : i + 1] == "^"
    i += negated
    ranges: list[str] = []
    n_ranges = 0
    while not (mask[i : i + 1] == "]" and n_ranges):
        low, i = _glob_char(mask, i)
        if low is None:
            return None, i
        high = low
        if mask[i : i + 1] == "-":
            high, i = _glob_char(mask, i + 1)
            if high is None:
                return None, i
        n_ranges += 1
        # An inverted range is legal in a mask and holds nothing.
        if low <= high:
            ranges.append(f"{_quote(low)}-{_quote(high)}")
    if not ranges:
        return ("[\\s\\S]" if negated else "(?!)"), i + 1
    return "[" + ("^" if negated else "") + "".join(ranges) + "]", i + 1


def _glob_char(mask: str, i: int) -> tuple[str | None, int]:
    if i >= len(mask) or mask[i] in "-]":
        return None, i
    if mask[i] == "\\":
        i += 1
        if i >= len(mask):
            return None, i
    return mask[i], i + 1


def _quote(ch: str) -> str:
    return ch if ch.isalnum() or ord(ch) > 127 else "\\" + ch
