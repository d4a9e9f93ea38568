"""Licence evidence in texts: identifier tags with expressions, and notice phrases.

One Aho-Corasick automaton reads the lower-cased text for identifier tags, another the text's words for phrases. What
follows a tag is parsed by the shunting-yard method, ``with`` binding tighter than ``and``, and that tighter than ``or``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import ahocorasick
from pyspark.sql import DataFrame

from fleetworks.llm.frames import append
from fleetworks.llm.words import lettered_words

# The phrases every scan counts and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices. They add labels but are not counted as base places.
MORE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu general public license": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "2 clause bsd": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "3 clause bsd": "bsd-3-clause",
    "under the bsd license": "bsd",
    "under the isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Identifiers an expression may name, with label and whether reuse is permissive. Of others that is not known.
IDENTIFIERS = {
    "mit": ("mit", True), "apache-2.0": ("apache-2", True), "bsd-2-clause": ("bsd-2-clause", True),
    "bsd-3-clause": ("bsd-3-clause", True), "isc": ("isc", True), "zlib": ("zlib", True), "0bsd": ("0bsd", True),
    "unlicense": ("unlicense", True), "cc0-1.0": ("cc0", True), "cc-by-4.0": ("cc-by", True),
    "cc-by-sa-4.0": ("cc-by-sa", False), "cc-by-nc-4.0": ("cc-by-nc", False), "cc-by-nd-4.0": ("cc-by-nd", False),
    "gpl-2.0": ("gpl-2", False), "gpl-2.0-only": ("gpl-2", False), "gpl-2.0-or-later": ("gpl-2", False),
    "gpl-3.0": ("gpl-3", False), "gpl-3.0-only": ("gpl-3", False), "gpl-3.0-or-later": ("gpl-3", False),
    "lgpl-2.1": ("lgpl", False), "lgpl-2.1-only": ("lgpl", False), "lgpl-2.1-or-later": ("lgpl", False),
    "lgpl-3.0": ("lgpl", False), "lgpl-3.0-only": ("lgpl", False), "lgpl-3.0-or-later": ("lgpl", False),
    "agpl-3.0": ("agpl", False), "agpl-3.0-only": ("agpl", False), "agpl-3.0-or-later": ("agpl", False),
    "mpl-2.0": ("mpl", False), "epl-2.0": ("epl", False),
}
EXCEPTIONS = {"classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note",
              "bison-exception-2.2", "autoconf-exception-3.0"}
#: Confidence by the best evidence found.
TAG_SCORE, PHRASE_SCORE, WEAK_SCORE = 1.0, 0.9, 0.6

_BINDS = {"or": 1, "and": 2, "with": 3}
#: A name that goes on an expression behind an operator in small letters, though it is no identifier.
_NAME = re.compile(r"[^\S\n\r]*\(*[A-Z]")
_TOKEN = re.compile(r"[^\S\n\r]*([()]|/(?=[A-Za-z0-9(])|(?:DocumentRef-[A-Za-z0-9.-]+:)?[A-Za-z0-9][A-Za-z0-9.+-]*)", re.I)
#: What may stand between an expression and the line's end: the end of a comment, a quote, a stop.
_LINE_END = re.compile(r"[^\S\n\r]*(?:\*+/|-->|[\"'`,;.#*)\]}>])*[^\S\n\r]*(?=[\n\r]|\Z)")
#: Public identifiers of small letters alone, which nothing else tells from prose.
_SMALL = set("blessing checkmk curl diffmark dtoa dvipdfm fwlw gnuplot hdparm jove libpng libtiff lsof magaz mailprio metamail"
             " mpich2 mplus pnmstitch psfrag psutil snprintf swrule threeparttable ulem w3m wwl xinetd xlock xpp zlib".split())
#: Values that say that there is no expression.
_NOTHING = {"none", "noassertion"}

RESULT = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string,"
          " score double, expressions array<string>, permissive boolean")


def _plain(token: str) -> str:
    """An identifier without the plus for later versions, or the stop of a sentence."""
    return token if token in IDENTIFIERS else token.rstrip("+.")


def _known(plain: str) -> bool:
    return plain in IDENTIFIERS or plain in _SMALL or plain.startswith(("licenseref-", "documentref-"))


def read_expression(text: str, at: int) -> tuple[list[str], int]:
    """The tokens, lowered, of the expression that starts at ``at`` and stays on its line; none if it can't be read.

    Any identifier is an operand and any an exception. What tells them from prose: an operator in capitals always is one
    and needs its operand, one in small letters only counts before an identifier of the table or with a digit, and an
    expression with other names and no operator in capitals ends with its line. Before any other name in capitals an
    ``or`` or ``and`` in small letters leaves the expression unread. A slash between names is the old way to write ``or``.
    """
    tokens: list[str] = []
    depth, capitals, foreign, wants = 0, False, False, "operand"
    while match := _TOKEN.match(text, at):
        shown, token = match[1], match[1].lower()
        plain = _plain(token)
        if wants == "operand" and token == "(":
            depth += 1
        elif wants == "operand" and token not in _BINDS and token not in _NOTHING and (
                _known(plain) or re.search(r"[A-Z0-9-]", shown) and re.search(r"[a-z]", plain)):
            foreign = foreign or not _known(plain)
            token, wants = token.rstrip("."), "operator"
        elif wants == "exception" and re.search(r"[a-z]", plain) and token not in _BINDS:
            token, wants = plain, "operator"
        elif wants == "operator" and token == ")" and depth:
            depth -= 1
        elif wants == "operator" and token == "/":
            token, capitals, wants = "or", True, "operand"
        elif wants == "operator" and token in _BINDS and (shown.isupper() or _follows(text, match.end(), token)):
            capitals = capitals or shown.isupper()
            wants = "exception" if token == "with" else "operand"
        elif wants == "operator" and token in ("or", "and") and _NAME.match(text, match.end()):
            return [], at
        else:
            break
        tokens.append(token)
        at = match.end()
    if wants != "operator" or depth or (foreign and not capitals and not _LINE_END.match(text, at)):
        return [], at
    return tokens, at


def _follows(text: str, at: int, operator: str) -> bool:
    """Whether an identifier follows an operator in small letters."""
    match = _TOKEN.match(text, at)
    while match and match[1] == "(":
        match = _TOKEN.match(text, match.end())
    plain = match[1].lower().rstrip("+.") if match else ""
    if operator == "with":
        return plain in EXCEPTIONS or bool(re.search(r"-exception|\d", plain))
    return _known(plain) or bool(re.search(r"\d", plain))


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands go out at once, operators wait for those that bind tighter."""
    out, waiting = [], []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def _all_hold(flags: Iterable[bool | None]) -> bool | None:
    """False if one is, else None if one is not known."""
    flags = set(flags)
    return False if False in flags else None if None in flags else True


def evaluate(tokens: list[str]) -> tuple[str, bool | None]:
    """The expression fully bracketed, and whether some choice it offers is permissive throughout: None if not known."""
    stack: list[tuple[str, bool | None]] = []
    for token in postfix(tokens):
        if token in _BINDS:
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "or":
                holds = True if a or b else None if a is None or b is None else False
            else:
                holds = _all_hold((a, b)) if token == "and" else a
            stack.append((f"({left} {token} {right})", holds))
        else:
            stack.append((token, IDENTIFIERS.get(_plain(token), (token, None))[1]))
    return stack[0]


def _label(identifier: str) -> str:
    plain = _plain(identifier)
    return IDENTIFIERS.get(plain, (plain, None))[0]


class Scanner:
    """Both automata, built once in a task."""

    def __init__(self, base: Mapping[str, str], more: Mapping[str, str]):
        self.base, self.labels = dict(base), {**more, **base}
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase in self.labels:
            self.phrases.add_word(f" {phrase} ", phrase)
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: str | None) -> tuple:
        words = lettered_words(text)
        line = f" {b' '.join(words).decode()} "
        n_base, first, last, base_labels, labels, score = 0, None, None, set(), set(), 0.0
        for end, phrase in self.phrases.iter(line):
            labels.add(self.labels[phrase])
            score = max(score, WEAK_SCORE)
            if phrase in self.base:
                start = end - len(phrase) - 1
                n_base += 1
                first = start if first is None else min(first, start)
                last = start if last is None else max(last, start)
                base_labels.add(self.base[phrase])
                score = max(score, PHRASE_SCORE)
        expressions, flags = [], []
        lowered = text.encode().lower().decode() if text else ""
        for end, _ in self.tags.iter(lowered):
            tokens, _ = read_expression(text, end + 1)
            if tokens:
                shown, holds = evaluate(tokens)
                expressions.append(shown)
                flags.append(holds)
                labels.update(_label(t) for before, t in zip(["", *tokens], tokens)
                              if t not in _BINDS and t not in "()" and before != "with")
                score = TAG_SCORE
        at = [None if s is None else line.count(" ", 0, s) for s in (first, last)]
        return (len(words), n_base, *at, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expressions,
                _all_hold(flags) if flags else None)


def scan_licenses(docs: DataFrame, text: str = "text", keep=None, base: Mapping[str, str] | None = None,
                  more: Mapping[str, str] | None = None) -> DataFrame:
    """Licence evidence of every whole text, in the columns of ``RESULT``.

    ``n_base`` counts all places of base phrases, overlapping ones too; ``first_word`` and ``last_word`` are null
    without any. ``expressions`` lists the bracketed expressions behind tags in order; one that cannot be read to its end
    is left out, not cut. An identifier beyond ``IDENTIFIERS`` is its own label. ``permissive`` says whether all
    expressions allow permissive reuse; it is null without any, and where that hangs on an identifier beyond the table.
    Null and empty texts have no words, empty labels and score 0. Repeated rows stay; clashing columns are replaced.
    """
    base = BASE_PHRASES if base is None else base
    more = MORE_PHRASES if more is None else more

    def make():
        scanner = Scanner(base, more)
        return lambda texts: list(zip(*map(scanner.scan, texts)))

    return append(docs, text, RESULT, make, keep)
