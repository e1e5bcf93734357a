"""Regular expressions written for Python's ``re``, matched inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUANTIFIER = re.compile(r"\{\d*,?\d*\}")
_ESCAPED_PLAIN = re.compile(r"\\([.\-/@:_+ ])")
_PLAIN = re.compile(r"^[A-Za-z0-9 _\-/@:,;#%&=~]+$")


def java_regex(pattern: str) -> str:
    """``pattern`` in Java's dialect: bare braces escaped, named groups respelled."""
    out = []
    i = 0
    in_class = False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if in_class:
            if ch == "]":
                in_class = False
            elif ch == "[":
                ch = r"\["
            elif pattern.startswith("&&", i):
                ch = r"\&"
        elif ch == "[":
            in_class = True
            # a "]" right after the opening is a member of the class
            if pattern.startswith("[]", i) or pattern.startswith("[^]", i):
                head = pattern[i : pattern.index("]", i)]
                out.append(head + r"\]")
                i += len(head) + 1
                continue
        elif ch == "{":
            quantifier = _QUANTIFIER.match(pattern, i)
            if quantifier and quantifier.group() not in ("{}", "{,}") and i > 0:
                text = quantifier.group()
                out.append(text.replace("{,", "{0,"))
                i += len(text)
                continue
            ch = r"\{"
        elif ch == "}":
            ch = r"\}"
        elif pattern.startswith("(?P<", i):
            out.append("(?<")
            i += 4
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def _plain_text(pattern: str) -> str | None:
    """The text a pattern searches for when it holds no real regex syntax."""
    if "|" in pattern:
        return None
    core = pattern
    while core.startswith(".*"):
        core = core[2:]
    while core.endswith(".*") and not core.endswith("\\.*"):
        core = core[:-2]
    bare = _ESCAPED_PLAIN.sub(lambda m: "." if m.group(1) == "." else m.group(1), core)
    probe = _ESCAPED_PLAIN.sub("_", core)
    return bare if probe and _PLAIN.match(probe) else None


def sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def search_sql(column: str, pattern: str, *, ignore_case: bool = False, multiline: bool = False) -> str:
    """SQL for "``pattern`` occurs anywhere in ``column``" (``re.search`` semantics).

    Patterns that are only text become ``contains``, which is far cheaper than
    a regex; the rest keep Unicode classes and newline-only line ends.  Text,
    not Columns: a rule table of a thousand patterns is parsed in one call.
    """
    text, regex = search_parts(pattern, ignore_case=ignore_case, multiline=multiline)
    if text is None:
        return f"{column} RLIKE {sql_text(regex)}"
    return f"contains({f'lower({column})' if ignore_case else column}, {sql_text(text)})"


def search_parts(pattern: str, *, ignore_case: bool = False, multiline: bool = False) -> tuple[str | None, str | None]:
    """(text to look for, None) or (None, Java regex); the text is in lower case if case does not matter."""
    text = _plain_text(pattern)
    if text is not None:
        return text.lower() if ignore_case else text, None
    flags = "dU" + ("i" if ignore_case else "") + ("m" if multiline else "")
    return None, f"(?{flags}){java_regex(pattern)}"


def search(column: str, pattern: str, **flags: bool) -> Column:
    return F.expr(search_sql(column, pattern, **flags))


def search_any_sql(column: str, patterns, **flags: bool) -> str:
    """SQL for "any of ``patterns`` occurs"; false without patterns."""
    return "(" + (" OR ".join(search_sql(column, p, **flags) for p in patterns) or "false") + ")"


def literal_map(entries) -> Column:
    """A string-to-string map literal, parsed in one call."""
    pairs = [f"{sql_text(k)}, {sql_text(v)}" for k, v in dict(entries).items()]
    return F.expr(f"map({', '.join(pairs)})")
