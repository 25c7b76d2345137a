"""Regex dialects.

Rule patterns are kept in the dialect they were written in: PostgreSQL advanced
regular expressions (``\\m``/``\\M`` word start/end) for the warehouse rules and
Python ``re`` (``\\b``, Unicode ``\\s``/``\\d``/``\\w``) for the text-extraction
rules.  They are translated for two engines:

* ``to_java``: Spark's ``rlike``/``regexp_extract`` (java.util.regex).  Word
  boundaries become look-arounds over an explicit word class, so the result
  does not depend on the JDK's version-specific ``\\b`` rules.
* ``to_re2``: DuckDB (RE2, the oracle).  RE2 has no look-arounds; a boundary
  becomes a consumed ``(^|non-word)`` / ``(non-word|$)`` group, which gives the
  same *existence* answer and the same capture groups for our patterns.

Word characters are letters, digits and underscore; whitespace is the set
Python's ``str.isspace`` accepts.
"""

from __future__ import annotations

WORD = r"\p{L}\p{N}_"
SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}"
DIGIT = r"\p{Nd}"

_JAVA_START = rf"(?<![{WORD}])"
_JAVA_END = rf"(?![{WORD}])"
_JAVA_BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_RE2_START = rf"(?:^|[^{WORD}])"
_RE2_END = rf"(?:$|[^{WORD}])"


def _translate(pattern: str, engine: str, dialect: str, fold: bool = False) -> str:
    out: list[str] = []
    i, n = 0, len(pattern)
    in_class = False
    if fold:
        pattern = _fold_literals(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "\\" and i + 1 < n:
            nxt = pattern[i + 1]
            i += 2
            if nxt == "s":
                out.append(SPACE if in_class else f"[{SPACE}]")
            elif nxt == "d":
                out.append(DIGIT)
            elif nxt == "w":
                out.append(WORD if in_class else f"[{WORD}]")
            elif nxt == "b" and dialect == "pg":
                out.append(r"\x08")  # PostgreSQL ARE: \b is a backspace
            elif nxt in "mMb" and not in_class:
                lead = _literal_after(pattern, i)
                starts = nxt == "m" or (nxt == "b" and _at_start(out))
                if engine == "java" and starts and lead:
                    # word start before a literal word: match the literal first,
                    # then look back one character — fails fast elsewhere
                    out.append(f"{lead}(?<![{WORD}]{lead})")
                    i += len(lead)
                else:
                    out.append(_boundary(nxt, out, engine))
            else:
                out.append("\\" + nxt)
            continue
        if ch == "[" and not in_class:
            in_class = True
            out.append(ch)
            # a leading ']' or '^]' is literal inside a class
            if pattern[i + 1:i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1:i + 2] == "]":
                out.append("\\]")
                i += 1
        elif ch == "]" and in_class:
            in_class = False
            out.append(ch)
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def _at_start(out: list[str]) -> bool:
    """A ``\\b`` with nothing (or an opening group / alternation) before it
    starts a word; otherwise it ends one."""
    prev = "".join(out)
    return prev == "" or prev.endswith(("(", "|", "(?:"))


def _literal_after(pattern: str, pos: int) -> str:
    """The run of plain ASCII letters/digits starting at ``pos`` (a character
    followed by a quantifier is left out)."""
    end = pos
    while end < len(pattern) and pattern[end].isascii() and pattern[end].isalnum():
        end += 1
    if end < len(pattern) and pattern[end] in "?*+{":
        end -= 1
    return pattern[pos:end]


def _fold_literals(pattern: str) -> str:
    """Lower-case literal characters (outside escapes), for matching against
    ``fold_lower(text)`` without the case-insensitive flag."""
    out, i = [], 0
    while i < len(pattern):
        if pattern[i] == "\\":
            out.append(pattern[i:i + 2])
            i += 2
        else:
            out.append(pattern[i].lower())
            i += 1
    return "".join(out)


def _boundary(kind: str, out: list[str], engine: str) -> str:
    if kind == "b":
        kind = "m" if _at_start(out) else "M"
        if engine == "java":
            return _JAVA_BOUNDARY
    if engine == "java":
        return _JAVA_START if kind == "m" else _JAVA_END
    return _RE2_START if kind == "m" else _RE2_END


def to_java(pattern: str, ignore_case: bool = False, dialect: str = "py") -> str:
    """Pattern for Spark ``rlike`` / ``regexp_extract``.

    ``dialect`` is ``"py"`` (Python ``re``) or ``"pg"`` (PostgreSQL ARE).
    """
    body = _translate(pattern, "java", dialect)
    return ("(?iu)" if ignore_case else "") + body


def to_java_folded(pattern: str, dialect: str = "py") -> str:
    """Case-insensitive ``pattern`` as a case-sensitive Java pattern over
    ``fold_lower(text)``: literals are lower-cased, no ``(?i)`` flag.  Folding
    maps every character that ``(?iu)`` would match to an ASCII letter onto
    that letter and keeps string length, so hits, positions and captured
    groups are those of ``(?iu)`` on the original text."""
    return _translate(pattern, "java", dialect, fold=True)


def to_re2(pattern: str, ignore_case: bool = False, dialect: str = "py") -> str:
    """Pattern for DuckDB ``regexp_matches`` / ``regexp_extract``."""
    body = _translate(pattern, "re2", dialect)
    return ("(?i)" if ignore_case else "") + body


def sql_quote(text: str) -> str:
    """ANSI single-quoted literal."""
    return "'" + text.replace("'", "''") + "'"


# ---------------------------------------------------------------- prefilter
# Characters that Java's case-insensitive (UNICODE_CASE) matching folds onto
# an ASCII letter other than their own lower case: dotless i, long s, dotted
# capital I, Kelvin sign — plus capital I itself, so the fold never depends on
# the JVM's default locale (a Turkish locale lower-cases I to dotless i).
_FOLD_FROM = "I\u0131\u017f\u0130\u212a"
_FOLD_TO = "iisik"


def fold_lower(c):
    """Lower-cased text in which every character a case-insensitive regex could
    match to an ASCII letter *is* that letter — the haystack for prefilters.

    Only a text that holds one of the rare characters (or any, where the JVM's
    locale does not lower-case I to i) is translated character by character.
    """
    from pyspark.sql import functions as F
    rare = F.lower(F.lit("I")) != F.lit("i")
    for ch in _FOLD_FROM[1:]:
        rare = rare | c.contains(ch)
    return F.lower(F.when(rare, F.translate(c, _FOLD_FROM, _FOLD_TO)).otherwise(c))


def _split_top(pattern: str, sep: str = "|") -> list[str]:
    parts, depth, in_class, cur, i = [], 0, False, [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            cur.append(pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == sep and depth == 0:
            parts.append("".join(cur))
            cur = []
            i += 1
            continue
        cur.append(ch)
        i += 1
    parts.append("".join(cur))
    return parts


def split_alternatives(pattern: str) -> list[str]:
    """Top-level alternatives of a pattern (``a|b(c|d)`` -> ``a``, ``b(c|d)``)."""
    return _split_top(pattern)


def _atoms(alt: str) -> list[tuple[str, str]]:
    """(kind, text) atoms of one alternative: 'lit' ASCII alnum char or 'other'."""
    out, i = [], 0
    while i < len(alt):
        ch = alt[i]
        if ch == "\\":
            out.append(("other", alt[i:i + 2]))
            i += 2
        elif ch == "[":
            j = alt.index("]", i + 2 if alt[i + 1:i + 2] in ("]", "^") else i + 1)
            out.append(("other", alt[i:j + 1]))
            i = j + 1
        elif ch == "(":
            depth, j = 0, i
            while True:
                if alt[j] == "\\":
                    j += 2
                    continue
                depth += alt[j] == "("
                depth -= alt[j] == ")"
                if depth == 0:
                    break
                j += 1
            out.append(("group", alt[i:j + 1]))
            i = j + 1
        elif ch in "?*+{":
            if ch == "{":
                j = alt.index("}", i)
                q = alt[i:j + 1]
                i = j + 1
            else:
                q = ch
                i += 1
                if i < len(alt) and alt[i] in "?+":
                    i += 1  # lazy / possessive suffix
            optional = q in ("?", "*") or q.startswith("{0")
            if optional and out:
                out[-1] = ("other", "")
            elif out:
                out.append(("other", ""))  # a repeated atom ends the literal run
        elif ch.isascii() and ch.isalnum():
            out.append(("lit", ch.lower()))
            i += 1
        else:
            out.append(("other", ch))
            i += 1
    return out


def _alt_requirement(alt: str) -> list[str] | None:
    """Literals one of which every match of this alternative contains: the
    longest literal run, or a mandatory group's alternatives' literals."""
    options: list[list[str]] = []
    run = ""
    for kind, text in _atoms(alt) + [("other", "")]:
        if kind == "lit":
            run += text
            continue
        if run:
            options.append([run])
        run = ""
        if kind == "group":
            inner = text[1:-1]
            if inner.startswith("?:"):
                inner = inner[2:]
            elif inner.startswith("?"):  # look-arounds and flags require nothing
                continue
            sub = required_literals(inner)
            if sub:
                options.append(sub)
    if not options:
        return None
    return max(options, key=lambda lits: min(len(x) for x in lits))


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case ASCII literals such that every match contains one of them;
    ``None`` when some alternative requires none.

    ``text ~* pattern`` implies ``fold_lower(text)`` contains one of them, so
    the literals make an exact, cheap prefilter for case-insensitive search.
    """
    found: list[str] = []
    for alt in _split_top(pattern):
        req = _alt_requirement(alt)
        if not req:
            return None
        found.extend(x for x in req if x not in found)
    return found


# ---------------------------------------------------------------- whole words
NON_WORD = rf"[^{WORD}]+"
_EDGE = "\x00"  # a word boundary in a pattern's spelled-out text
_SPELLINGS = 64


def _class_members(body: str) -> list[str] | None:
    """Single characters of a bracket class of plain characters; None for others."""
    if body.startswith("^") or "\\" in body or "-" in body[1:-1]:
        return None
    return list(body.lower())


def _spell(pattern: str, dialect: str) -> list[str] | None:
    """Every text that the (finite) pattern stands for, white space as one
    space and boundaries as ``_EDGE``; None where it stands for too many."""
    whole: list[str] = []
    for alt in _split_top(pattern):
        texts, i = [""], 0
        while i < len(alt):
            ch = alt[i]
            if ch == "\\":
                code = alt[i + 1:i + 2]
                i += 2
                if code == "s":
                    options = [" "]
                elif code in "mM" or (code == "b" and dialect == "py"):
                    options = [_EDGE]
                elif code == "b":
                    options = ["\x08"]
                elif code.isalnum():
                    return None
                else:
                    options = [code]
            elif ch == "[":
                j = alt.index("]", i + 2)
                options = _class_members(alt[i + 1:j])
                i = j + 1
            elif ch == "(":
                depth, j = 0, i
                while True:
                    if alt[j] == "\\":
                        j += 2
                        continue
                    depth += (alt[j] == "(") - (alt[j] == ")")
                    if depth == 0:
                        break
                    j += 1
                inner = alt[i + 1:j]
                if inner.startswith("?") and not inner.startswith("?:"):
                    return None
                options = _spell(inner.removeprefix("?:"), dialect)
                i = j + 1
            elif ch in "?*+{.^$":
                return None
            else:
                options, i = [ch.lower()], i + 1
            if options is None:
                return None
            quantifier = alt[i:i + 1]
            if quantifier == "?":
                options, i = ["", *options], i + 1
            elif quantifier and quantifier in "*+" and options == [" "]:
                options, i = (["", " "] if quantifier == "*" else [" "]), i + 1
            elif quantifier and quantifier in "*+{":
                return None
            texts = [a + b for a in texts for b in options]
            if len(texts) > _SPELLINGS:
                return None
        whole += texts
    return whole if len(whole) <= _SPELLINGS else None


def whole_words(alternative: str, dialect: str = "py") -> tuple[list[str], list[list[str]]] | None:
    """What words a folded text must hold for ``alternative`` to match.

    ``(alone, together)``: each word of ``alone`` is a match by itself; a
    match that is none of those holds all the words of one list of
    ``together`` (and still has to be tested).  None where the pattern's words
    aren't known, or one of its texts has no word that is whole.
    """
    texts = _spell(alternative, dialect)
    if not texts:
        return None
    alone, together = [], []
    for text in texts:
        words, run, whole = [], "", False
        for ch in text + " ":
            if ch.isalnum() or ch == "_":
                run += ch
                continue
            if run and whole:
                # the run ends here: by a boundary or another character, unless the pattern just stops
                words.append(run)
            whole, run = True, ""
        if not text.endswith(_EDGE) and words and (text[-1].isalnum() or text[-1] == "_"):
            words.pop()  # the last word may go on in the text
        if not words:
            return None
        if text == f"{_EDGE}{words[0]}{_EDGE}":
            alone.append(words[0])
        else:
            together.append(words)
    together = [w for w in together if not set(w) & set(alone)]
    return sorted(set(alone)), sorted(set(map(tuple, together)))
