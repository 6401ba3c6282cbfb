"""Pre-tokens of byte-level BPE vocabularies, found without a regular expression engine.

The boundaries are those of ``public_tokenizers.PATTERN``: contractions, letters, numbers and other
characters with an optional space before them, and white space without the last character before a word.
Every character, seen with up to two characters after it, is a function from state to state. Functions
compose associatively, so a blocked prefix scan over function numbers gives the state at every character
of many texts at once, and state and character say whether a token begins.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

# classes of code points
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE = range(6)
# symbols: classes with what follows; LAST is the last white space before something else
S_OTHER, S_LETTER, S_NUMBER, S_LAST_SPACE, S_LAST_BLANK, S_INNER, S_SHORT, S_LONG, S_END, S_NONE = range(10)
# states: what the token of the last character is
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, JOINS, ONE_LEFT, TWO_LEFT = range(8)

# What may follow an apostrophe in a contraction.
SHORT_TAILS, LONG_TAILS = "stmd", ("re", "ve", "ll")

_PACKED = 8  # characters in a word
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(_PACKED + 1)], dtype=np.uint64)


@cache
def code_point_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    out[0x1C:0x20] = OTHER  # separators that count as white space in Python only
    out[ord(" ")], out[ord("'")] = SPACE, QUOTE
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins at this character."""
    if symbol == S_NONE:
        return state, False
    if symbol == S_LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (FRESH if state == ONE_LEFT else ONE_LEFT), False
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}.get(symbol)
    if run is not None:
        return run, state not in (run, JOINS)
    if symbol in (S_SHORT, S_LONG):
        if state in (IN_OTHERS, JOINS):
            return IN_OTHERS, False
        return (ONE_LEFT if symbol == S_SHORT else TWO_LEFT), True
    if symbol == S_INNER:
        return IN_BLANKS, state != IN_BLANKS
    return (JOINS if symbol == S_LAST_SPACE else FRESH), True


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each symbol's function, composition table, state each function leads to from FRESH, begins[state, symbol]."""
    states, symbols = range(8), range(10)
    of = {s: tuple(_step(q, s)[0] for q in states) for s in symbols}
    known = {f: i for i, f in enumerate(dict.fromkeys(of.values()))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in of.values():
            both = tuple(g[q] for q in f)
            if both not in known:
                known[both] = len(known)
                todo.append(both)
    table = np.array([[known[tuple(g[q] for q in f)] for g in known] for f in known], dtype=np.uint8)
    start = np.array([f[FRESH] for f in known], dtype=np.uint8)
    begins = np.array([[_step(q, s)[1] for s in symbols] for q in states])
    return np.array([known[of[s]] for s in symbols], dtype=np.uint8), table, start, begins


def compose_scan(functions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """All prefix compositions: rows of a square are scanned side by side, then given what precedes them."""
    n = len(functions)
    if n < 2:
        return functions.copy()
    width = int(np.ceil(np.sqrt(n)))
    rows = -(-n // width)
    none = _functions()[0][S_NONE]
    square = np.full(rows * width, none, dtype=np.uint8)
    square[:n] = functions
    square = np.ascontiguousarray(square.reshape(rows, width).T)
    flat, m = table.ravel(), len(table)
    for j in range(1, width):
        square[j] = flat[square[j - 1].astype(np.intp) * m + square[j]]
    if rows > 1:
        before = np.concatenate(([none], compose_scan(square[-1], table)[:-1]))
        square = flat[before.astype(np.intp)[None, :] * m + square]
    return square.T.reshape(-1)[:n]


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kinds = code_point_classes()[points]
    symbols = np.array([S_OTHER, S_LETTER, S_NUMBER, S_INNER, S_INNER, S_OTHER], dtype=np.uint8)[kinds]
    blank = (kinds == SPACE) | (kinds == BLANK)
    blank[ends] = True  # the end of a text is not a word
    last = np.zeros(len(points), dtype=bool)
    last[:-1] = ~blank[1:]
    symbols[last & (kinds == SPACE)] = S_LAST_SPACE
    symbols[last & (kinds == BLANK)] = S_LAST_BLANK
    quotes = np.flatnonzero(kinds == QUOTE)
    if len(quotes):
        is_end = np.zeros(len(points) + 2, dtype=bool)
        is_end[ends] = True
        padded = np.concatenate((points, np.zeros(2, dtype=points.dtype)))
        first = np.where(is_end[quotes + 1], 0, padded[quotes + 1])
        second = np.where(is_end[quotes + 1] | is_end[quotes + 2], 0, padded[quotes + 2])
        symbols[quotes[np.isin(first, [ord(c) for c in SHORT_TAILS])]] = S_SHORT
        for a, b in LONG_TAILS:
            symbols[quotes[(first == ord(a)) & (second == ord(b))]] = S_LONG
    symbols[ends] = S_END
    return symbols


def _begins(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts, their code points, where pre-tokens and ends begin, where texts end, pre-tokens of each text."""
    joined = "\0".join(texts) + "\0"  # where a text ends is known by place, not by this character
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols = _symbols(points, ends)
    number, table, start, begins = _functions()
    states = start[compose_scan(number[symbols], table)]
    before = np.concatenate((np.array([FRESH], dtype=np.uint8), states[:-1]))
    begin = begins[before, symbols]
    starts = np.flatnonzero(begin)
    end = symbols == S_END
    counts = np.diff(np.searchsorted(starts[~end[starts]], np.concatenate(([0], ends))))
    return joined, points, begin, end, counts


def distinct_pretokens(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pre-tokens, the number of the one at each place, and how many places each text has.

    Equal ones of up to 16 code points below 256 are told by their packed characters and come once; all others come as
    often as they occur. So few strings are made.
    """
    if not texts:
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    joined, points, begin, end, counts = _begins(texts)
    at = np.flatnonzero(begin)
    real = ~end[at]
    starts, stops = at[real], np.append(at[1:], len(points))[real]
    sizes = stops - starts
    # a zero would be taken for the padding behind a piece
    wide = np.flatnonzero((points == 0) & ~end | (points > 255))
    packed = sizes <= 2 * _PACKED
    if len(wide):
        packed &= np.searchsorted(wide, starts) == np.searchsorted(wide, stops)
    letters = np.append(points.astype(np.uint8), np.zeros(2 * _PACKED, dtype=np.uint8))
    words = np.ndarray((len(points) + _PACKED,), dtype="<u8", buffer=letters, strides=(1,))
    kinds, first, known = np.empty(len(starts), dtype=np.int64), [], 0
    for of in (np.flatnonzero(packed & (sizes <= _PACKED)), np.flatnonzero(packed & (sizes > _PACKED))):
        if not len(of):
            continue
        size = np.minimum(sizes[of], _PACKED)
        kind, places = _numbered(words[starts[of]] & _MASKS[size])
        if sizes[of[0]] > _PACKED:
            rest, more = _numbered(words[starts[of] + _PACKED] & _MASKS[sizes[of] - _PACKED])
            kind, places = _numbered((kind * len(more) + rest).astype(np.uint64))
        kinds[of] = kind + known
        first.append(of[places])
        known += len(places)
    others = np.flatnonzero(~packed)
    kinds[others] = np.arange(known, known + len(others))
    chosen = np.concatenate((*first, others)).astype(np.int64)
    pieces = [joined[a:b] for a, b in zip(starts[chosen].tolist(), stops[chosen].tolist())]
    return pieces, kinds, counts


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys, and a place of each."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out, order[new]
