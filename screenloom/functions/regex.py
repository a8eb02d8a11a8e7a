"""RE2 patterns as java.util.regex patterns with the same matches, and tests that come before them.

The rule language is written for RE2; Spark's rlike is Java's.  They differ in case
folding, `$`, `.`, `\\s` and word boundaries, and each difference is translated.  A
pattern of ASCII characters folds case in ASCII only, with the two characters outside
it that fold to `s` and `k` written out: much faster than folding all of Unicode.

A pattern that needs a literal is tried only on texts that contain it: see needed().
"""

from __future__ import annotations

import re

WORD = "0-9A-Za-z_"
BOUNDARY = f"(?-iu:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
INSIDE = f"(?-iu:(?<=[{WORD}])(?=[{WORD}])|(?<![{WORD}])(?![{WORD}]))"
#: \w without regard to case: two characters outside ASCII fold to letters in it.
FOLDED = WORD + r"\u017F\u212A"
BLANKS = r"\t\n\f\r "
#: Characters outside ASCII that equal a letter in it without regard to case.
FOLDS = {"s": r"\u017F", "k": r"\u212A"}
#: Every space that text normalising makes a plain one, for loosen().
SPACES = r"\t\n\x0B\f\r \x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


class UnsupportedPattern(ValueError):
    """A pattern that RE2 or the translation doesn't accept."""


def to_java(pattern: str, ignore_case: bool = True) -> str:
    """The Java pattern; raises UnsupportedPattern for what has no equal there."""
    narrow = ignore_case and pattern.isascii() and not re.search(r"\\[pP]", pattern)
    out, at, inside = [], 0, None
    while at < len(pattern):
        ch, two = pattern[at], pattern[at : at + 2]
        if ch == "\\":
            if len(two) < 2:
                raise UnsupportedPattern("pattern ends in a backslash")
            if two[1] == "b" and inside is None:
                out.append(_boundary(pattern, at))
            else:
                out.append(_escape(two[1], inside is not None, ignore_case))
            if two[1] in "pP":
                if pattern[at + 2 : at + 3] != "{":
                    raise UnsupportedPattern("one-letter classes need braces")
            at += 2
        elif inside is not None:
            if ch == "]":
                out.append(_class_folds(pattern[inside:at]) if narrow else "")
                inside = None
            out.append("\\[" if ch == "[" and pattern[at : at + 2] != "[:" else ch)
            if pattern[at : at + 2] == "[:":
                raise UnsupportedPattern("POSIX classes")
            at += 1
        elif ch == "[":
            out.append(ch)
            at += 1
            if pattern[at : at + 1] == "^":
                out.append("^")
                at += 1
            inside = at
            if pattern[at : at + 1] == "]":
                out.append("\\]")
                at += 1
        elif pattern[at : at + 2] == "(?":
            if pattern[at : at + 3] != "(?:":
                flags = re.match(r"\(\?i\)", pattern[at:])
                if not flags or at:
                    raise UnsupportedPattern(f"group {pattern[at : at + 4]}")
                at += 4
                continue
            out.append("(?:")
            at += 3
        else:
            fold = FOLDS.get(ch.lower()) if narrow else None
            out.append(f"[{ch}{fold}]" if fold else {"$": r"\z", ".": r"[^\n]"}.get(ch, ch))
            at += 1
    if inside is not None:
        raise UnsupportedPattern("class without an end")
    return ("(?i)" if narrow else "(?iu)" if ignore_case else "") + "".join(out)


def _class_folds(body: str) -> str:
    """What a class of ASCII characters must have besides, so that it folds as RE2 does."""
    if "\\w" in body:
        return ""  # has them
    body = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", body)
    own = re.compile("[" + ("\\" if body.startswith("]") else "") + body.replace("[", "\\[") + "]", re.IGNORECASE | re.ASCII)
    return "".join(fold for letter, fold in FOLDS.items() if own.match(letter))


def _boundary(pattern: str, at: int) -> str:
    """The word boundary at this place; beside a letter or digit of the pattern only its other side is open."""
    after, before = pattern[at + 2 : at + 4], pattern[max(0, at - 2) : at]
    plain = lambda ch: ch.isascii() and ch.isalnum() and ch.lower() not in FOLDS
    if after and plain(after[0]) and after[1:] not in ("?", "*", "{"):
        return f"(?<![{WORD}])"
    if before and plain(before[-1]) and before[:-1] != "\\":
        return f"(?![{WORD}])"
    return BOUNDARY


def needed(pattern: str) -> list[str] | None:
    """Literals in lower case of which every text that matches contains one, also in lower case; None if no such are known.

    Read off the pattern: of each alternative the longest run of plain ASCII characters
    outside groups, classes and repeats.  `s` and `k` end a run, as they fold to
    characters outside ASCII.
    """
    found = []
    for part in _alternatives(pattern.removeprefix("(?i)")):
        if part.startswith("(?:") and _group_end(part, 0) == len(part) - 1:
            inner = needed(part[3:-1])
            if inner is None:
                return None
            found += inner
            continue
        runs, run, at = [], "", 0
        while at < len(part):
            ch = part[at]
            if ch in "([":
                end = _group_end(part, at) if ch == "(" else _class_end(part, at)
                runs, run, at = [*runs, run], "", end + 1
            elif ch == "\\":
                literal = part[at + 1 : at + 2]
                run, runs = (run + literal, runs) if not literal.isalnum() else ("", [*runs, run])
                if literal in ("p", "P", "x"):
                    return None
                at += 2
            elif ch in "?*{":
                # the character before may be missing
                runs, run = [*runs, run[:-1]], ""
                at = part.index("}", at) + 1 if ch == "{" and "}" in part[at:] else at + 1
            elif ch in "+.^$|" or not ch.isascii() or ch.lower() in FOLDS:
                runs, run, at = [*runs, run], "", at + 1
            else:
                run, at = run + ch, at + 1
        best = max([*runs, run], key=len)
        if not best:
            return None
        found.append(best.lower())
    return sorted(set(found))


def _group_end(pattern: str, at: int) -> int:
    depth = 0
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "[":
            at = _class_end(pattern, at)
        elif pattern[at] in "()":
            depth += 1 if pattern[at] == "(" else -1
            if not depth:
                return at
        at += 1
    return len(pattern) - 1


def _class_end(pattern: str, at: int) -> int:
    at += 2 if pattern[at + 1 : at + 2] == "^" else 1
    at += pattern[at : at + 1] == "]"
    while at < len(pattern) and pattern[at] != "]":
        at += 2 if pattern[at] == "\\" else 1
    return at


def _alternatives(pattern: str) -> list[str]:
    """The pattern cut at bars outside groups and classes."""
    out, begin, at = [], 0, 0
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "(":
            at = _group_end(pattern, at)
        elif pattern[at] == "[":
            at = _class_end(pattern, at)
        elif pattern[at] == "|":
            out.append(pattern[begin:at])
            begin = at + 1
        at += 1
    return [*out, pattern[begin:]]


def loosen(pattern: str) -> str:
    """A pattern whose matches in a text as it is include all of this one's in the normalised text.

    Word boundaries are dropped, as composing characters may move them, and white
    space takes in every space that normalising makes a plain one.
    """
    out, at, inside = [], 0, False
    while at < len(pattern):
        two = pattern[at : at + 2]
        if two == r"\b" and not inside:
            at += 2
        elif two in (r"\s",) or two[0] == " ":
            out.append(SPACES if inside else f"[{SPACES}]")
            at += 1 if two[0] == " " else 2
        elif two[0] == "\\":
            out.append(two)
            at += 2
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            at += 1
    return "".join(out)


def _escape(ch: str, inside: bool, ignore_case: bool) -> str:
    if ch in "wW" and ignore_case:
        if ch == "W" and inside:
            raise UnsupportedPattern(r"\W in a class")
        return FOLDED if inside else f"[{'^' * (ch == 'W')}{FOLDED}]"
    if ch == "s":
        return BLANKS if inside else f"[{BLANKS}]"
    if ch == "S":
        if inside:
            raise UnsupportedPattern(r"\S in a class")
        return f"[^{BLANKS}]"
    if ch in "bB":
        if inside:
            raise UnsupportedPattern(r"\b in a class")
        return INSIDE
    if ch in "CQEZGRXkKNhHvV123456789":
        raise UnsupportedPattern(f"\\{ch}")
    return "\\" + ch
