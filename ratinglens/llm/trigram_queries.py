"""Boolean trigram queries of regular expressions: what a text must contain for the expression to match."""

from itertools import product
from re import _constants as sre
from re import _parser as parser

MAX_STRINGS = 64        # more strings than this for one stretch of an expression are not told apart
MAX_CLASS = 8           # larger character classes stand for any character

Query = list[frozenset[str]]    # an OR of ANDs of trigrams; one empty AND is true of every text
ANY: Query = [frozenset()]


def _simple(query: Query) -> Query:
    """Without the alternatives that another one implies."""
    return [a for a in dict.fromkeys(query) if not any(b < a for b in query)]


def _both(a: Query, b: Query) -> Query:
    return _simple([x | y for x, y in product(a, b)])


def _of_strings(strings: set[str]) -> Query:
    return _simple([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]) if strings else ANY


def _class(items) -> set[str] | None:
    letters = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            letters.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < MAX_CLASS:
            letters.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return letters if len(letters) <= MAX_CLASS else None


def _item(kind, value) -> tuple[set[str] | None, Query]:
    """The strings that one part of an expression matches, if they are few, or else what a match must contain."""
    if kind is sre.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is sre.IN:
        return _class(value), ANY
    if kind is sre.AT:
        return {""}, ANY
    if kind is sre.SUBPATTERN:
        return _sequence(value[-1])
    if kind is sre.BRANCH:
        branches = [_sequence(b) for b in value[1]]
        if all(strings is not None for strings, _ in branches) and sum(len(s) for s, _ in branches) <= MAX_STRINGS:
            return set().union(*(s for s, _ in branches)), ANY
        return None, _simple([a for s, q in branches for a in (q if s is None else _of_strings(s))])
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = value
        strings, query = _sequence(body)
        if strings is not None and most <= 4 and len(strings) ** most <= MAX_STRINGS:
            return {"".join(p) for n in range(least, most + 1) for p in product(strings, repeat=n)}, ANY
        return None, ANY if least == 0 else query if strings is None else _of_strings(strings)
    return None, ANY


def _sequence(parts) -> tuple[set[str] | None, Query]:
    run, query, whole = {""}, ANY, True
    for kind, value in parts:
        strings, needs = _item(kind, value)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        query, whole = _both(_both(query, _of_strings(run)), needs), False
        run = {""} if strings is None else strings
    return (run, ANY) if whole else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams of the lower-cased text; [frozenset()] if the pattern demands none."""
    strings, query = _sequence(parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def rarest(query: Query, count: int = 4) -> Query:
    """The query with at most ``count`` trigrams an alternative, those with the fewest frequent letters.

    Leaving trigrams out of an AND only adds candidates, never loses one, and keeps the index small.
    """
    frequent = lambda trigram: (sum(c in "etaoinshrl " for c in trigram), trigram)
    return _simple([frozenset(sorted(a, key=frequent)[:count]) for a in query])
