"""Induced sorting of all suffixes of a shard, with common-prefix values.

The suffixes that start a rising stretch (the left-most smaller ones) are sorted by their pieces'
names, recursively on the string of names; from their order the order of all others is induced in
one scan forward (suffixes larger than their successor) and one backward (smaller ones). The queue
of a scan is one array with a section per first symbol: a tuple that comes off its front puts its
predecessor into the next free place of its symbol's section, always behind the front. Work goes
in windows: the longest stretch of the queue into which no tuple of the same stretch puts another
is taken off at once. With each tuple goes the prefix it has in common with the one before it; two
predecessors in a section have one symbol more in common than the least value between their
origins. Values are cut off at ``most``, as only the question "that much or less" is asked.

The queue and the common prefixes lie in unnamed scratch files that are mapped into memory when
they are beyond MEMORY bytes each; the symbols and their directions are in memory always, so the
caller bounds the size of a shard.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 256 << 20
WINDOW = 1 << 15


def _array(n: int, dtype, fill: int) -> np.ndarray:
    kind = np.dtype(dtype)
    if n * kind.itemsize <= MEMORY:
        return np.full(n, fill, kind)
    # The file has no name: it goes with the task, and a repeated task makes its own.
    out = np.memmap(tempfile.TemporaryFile(), kind, "w+", shape=(n,))
    out[:] = fill
    return out


def _rising(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last (the end mark) counts as so."""
    n = len(t)
    rises, level = np.ones(n, bool), np.zeros(n, bool)
    np.greater(t[1:], t[:-1], out=rises[:-1])
    np.equal(t[1:], t[:-1], out=level[:-1])
    # Equal symbols take the direction of the next step that is not level.
    steps = np.flatnonzero(~level)
    at = np.flatnonzero(level)
    rises[at] = rises[steps[np.searchsorted(steps, at)]]
    return rises


class _Least:
    """Least values of stretches of a short array, by doubling."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least of values[start..end], both included."""
        level = np.log2(end - start + 1).astype(np.int64)
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            own = self.levels[k]
            out[some] = np.minimum(own[start[some]], own[end[some] - (1 << int(k)) + 1])
        return out


_COUNT = np.arange(WINDOW + 1)


def _begins(symbol: np.ndarray) -> np.ndarray:
    """Where stretches of equal symbols begin."""
    new = np.empty(len(symbol), bool)
    new[:1] = True
    np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
    return new.nonzero()[0]


def _lengths(begin: np.ndarray, n: int) -> np.ndarray:
    out = np.empty_like(begin)
    np.subtract(begin[1:], begin[:-1], out=out[:-1])
    out[-1:] = n - begin[-1:]
    return out


def _scan(t, sa, common, rising, want, first, stops, seam, most) -> None:
    """One scan in the order of ``sa``; ``want``: put predecessors that rise, or that don't.

    ``first``: each section's first place; ``common``: prefix in common with the entry before in
    scan order (None: not asked for); ``stops``: places before which ``seam`` is called, in order.
    """
    n = len(sa)
    head = first.copy()
    since = None if common is None else np.full(len(first), most, common.dtype)
    a, width, turn = 0, 256, 0
    while a < n:
        while turn < len(stops) and stops[turn] <= a:
            seam(stops[turn])
            turn += 1
        b = min(n, a + width, stops[turn] if turn < len(stops) else n)
        window = sa[a:b]
        at = (window > 0).nonzero()[0]
        before = window[at] - 1
        fits = (rising[before] == want).nonzero()[0]
        at, before = at[fits], before[fits]
        symbol = t[before]
        if len(at):
            order = np.argsort(symbol, kind="stable")
            symbol, at, before = symbol[order], at[order], before[order]
            begin = _begins(symbol)
            # Places in a section follow each other from its head.
            shift = head[symbol[begin]] - begin
            place = np.repeat(shift, _lengths(begin, len(symbol))) + _COUNT[: len(symbol)]
            nearest = int(place.min())
            if nearest < b:
                # The window ends where its own tuples begin to fall.
                b = nearest
                stay = np.flatnonzero(at < b - a)
                symbol, at, before, place = symbol[stay], at[stay], before[stay], place[stay]
                begin = _begins(symbol)
                width = min(WINDOW, max(64, 2 * (b - a)))
            else:
                width = min(WINDOW, 2 * width)
            last = begin + _lengths(begin, len(symbol)) - 1
            sa[place] = before
            head[symbol[begin]] = place[last] + 1
        else:
            width = min(WINDOW, 2 * width)
        if common is not None:
            values = np.ascontiguousarray(common[a:b])
            least = _Least(values)
            if len(at):
                start = np.empty(len(at), np.int64)
                start[1:] = at[:-1] + 1
                start[begin] = 0
                got = least.of(start, at)
                got[begin] = np.minimum(got[begin], since[symbol[begin]])
                got = np.minimum(got, most - 1) + 1
                got[place == first[symbol]] = 0
                common[place] = got.astype(common.dtype)
            everywhere = values.min()
            np.minimum(since, everywhere, out=since)
            if len(at):
                rest = at[last] + 1
                inside = rest < len(values)
                tail = np.full(len(rest), most, common.dtype)
                if inside.any():
                    tail[inside] = least.of(rest[inside], np.full(inside.sum(), len(values) - 1))
                since[symbol[begin]] = tail
        a = b
    while turn < len(stops):
        seam(stops[turn])
        turn += 1


def prefix_in_common(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Symbols that the suffixes at a and b have in common, cut off at ``most``; word by word."""
    per = 8 // t.itemsize
    padded = np.concatenate([t, np.zeros(most + 2 * per, t.dtype)])
    words = np.ndarray((len(padded) - per + 1,), "<u8", padded, strides=(t.itemsize,))
    out = np.full(len(a), most, np.int64)
    active = np.arange(len(a))
    for at in range(0, most, per):
        x = words[a[active] + at] ^ words[b[active] + at]
        differ = np.flatnonzero(x)
        if len(differ):
            low = x[differ] & (~x[differ] + np.uint64(1))
            equal = np.bitwise_count(low - np.uint64(1)) // (8 * t.itemsize)
            out[active[differ]] = np.minimum(most, at + equal)
            active = active[x == 0]
        if not len(active):
            break
    # Beyond the end mark there is nothing to have in common.
    return np.minimum(out, len(t) - np.maximum(a, b))


def _named(t: np.ndarray, starts: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names, equal for equal pieces, of pieces in sorted order; a piece goes from one start to
    the next, both included."""
    end = np.empty(len(t), np.int64)
    end[starts] = np.append(starts[1:], len(t) - 1)
    size = end[ordered] - ordered + 1
    differ = np.ones(len(ordered), bool)
    differ[1:] = size[1:] != size[:-1]
    active = np.flatnonzero(~differ)
    at = 0
    while len(active):
        x, y = t[ordered[active] + at], t[ordered[active - 1] + at]
        differ[active[x != y]] = True
        at += 1
        active = active[(x == y) & (size[active] > at)]
    return np.cumsum(differ) - 1


def _names_by_symbol(t: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names in order of pieces with many different symbols: by two symbols at a time, as long as
    pieces tie. A piece that has ended comes after those that go on."""
    n, top = len(starts), int(t.max()) + 1
    length = np.empty(n, np.int64)
    length[:-1] = starts[1:] - starts[:-1] + 1
    length[-1:] = len(t) - starts[-1:]

    def symbol(of: np.ndarray, at: int) -> np.ndarray:
        ended = at >= length[of]
        place = np.where(ended, 0, starts[of] + at)
        return np.where(ended, top, t[place].astype(np.int64))

    name = np.zeros(n, np.int64)
    tied, at = np.arange(n), 0
    while len(tied):
        key = symbol(tied, at) * (top + 1) + symbol(tied, at + 1)
        order = np.lexsort((key, name[tied]))
        tied, key = tied[order], key[order]
        group = name[tied]
        first = np.ones(len(tied), bool)
        first[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        whole = np.ones(len(tied), bool)
        whole[1:] = group[1:] != group[:-1]
        # A name is the number of pieces that are smaller.
        count = np.arange(len(tied))
        inside = np.maximum.accumulate(np.where(first, count, 0))
        name[tied] = group + inside - np.maximum.accumulate(np.where(whole, count, 0))
        size = np.diff(np.append(np.flatnonzero(first), len(tied)))
        at += 2
        tied = tied[np.repeat(size > 1, size)]
        # Pieces that tie beyond their ends are equal.
        tied = tied[length[tied] >= at]
    return np.unique(name, return_inverse=True)[1]


def sort_suffixes(t: np.ndarray, most: int | None = None, levels: int = 64) -> tuple[np.ndarray, np.ndarray | None]:
    """Suffixes of ``t`` in order, and with ``most`` the prefix each has in common with the one
    before, cut off there. t ends with its smallest symbol, 0, which occurs there alone.

    ``levels``: of names that are still equal after so many levels of names of names, any order
    will do. Each level's names stand for at least twice as many symbols as the last's."""
    n = len(t)
    rising = _rising(t)
    kind = np.int32 if n < 1 << 31 else np.int64
    star = np.flatnonzero(rising[1:] & ~rising[:-1]).astype(kind) + 1
    if n == 1:
        return np.zeros(1, kind), None if most is None else np.zeros(1, np.uint8)
    counts = np.bincount(t)
    starts = np.cumsum(counts) - counts
    ends = starts + counts
    falls_end = starts + np.bincount(t[~rising], minlength=len(counts))

    def placed(ordered: np.ndarray) -> np.ndarray:
        """An empty queue with the star suffixes, in this order, at the ends of their sections."""
        sa = _array(n, kind, -1)
        symbol = t[ordered]
        own = np.bincount(symbol, minlength=len(counts))
        shift = ends - np.cumsum(own)
        sa[np.arange(len(ordered)) + shift[symbol]] = ordered
        return sa

    def forward(sa, common=None, stops=(), seam=None):
        _scan(t, sa, common, rising, False, starts, stops, seam, most or 0)

    def backward(sa, common=None, stops=(), seam=None):
        _scan(t, sa[::-1], common, rising, True, n - ends, stops, seam, most or 0)

    def clear_rising(sa):
        # Where nothing stands, the index -1 is that of the end mark, which rises too.
        for at in range(0, n, WINDOW):
            part = sa[at : at + WINDOW]
            part[rising[part]] = -1
        sa[0] = n - 1

    if t.itemsize < 4:
        # Pieces in order: the star suffixes by first symbol alone, then induced.
        sa = placed(star[np.argsort(t[star], kind="stable")])
        forward(sa)
        clear_rising(sa)
        backward(sa)
        is_star = np.zeros(n, bool)
        is_star[star] = True
        ordered = sa[is_star[sa]]
        names = np.empty(n, kind)
        names[ordered] = _named(t, star, ordered)
        names = names[star]
        del sa, is_star
    else:
        names = _names_by_symbol(t, star).astype(kind)
        ordered = star[np.argsort(names, kind="stable")]
    if levels > 0 and len(names) and int(names.max()) + 1 < len(names):
        ordered = star[sort_suffixes(names, None, levels - 1)[0]]
    sa = placed(ordered)
    if most is None:
        forward(sa)
        clear_rising(sa)
        backward(sa)
        return sa, None

    common = _array(n + 1, np.uint8, most)
    if len(ordered) > 1:
        where = np.flatnonzero(sa >= 0)
        value = prefix_in_common(t, sa[where[:-1]], sa[where[1:]], most)
        common[where[1:]] = value
    common[starts] = 0
    common[n] = 0

    def meet(left: int, right: int) -> int:
        return int(prefix_in_common(t, np.array([left]), np.array([right]), most)[0])

    first_star = {}
    symbols = t[ordered]
    fresh = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])) if len(ordered) else []
    own = np.bincount(symbols, minlength=len(counts))
    for s in symbols[fresh].tolist():
        first_star[int(falls_end[s])] = int(ends[s] - own[s])
    both = np.flatnonzero((falls_end > starts) & (falls_end < ends))

    def seam_forward(stop: int) -> None:
        # The last that falls and the first star of a section; nothing else stands between them.
        if stop in first_star:
            to = first_star[stop]
            common[to] = meet(int(sa[stop - 1]), int(sa[to]))

    forward(sa, common[:n], falls_end[both].tolist(), seam_forward)
    clear_rising(sa)
    for s in np.flatnonzero(falls_end < ends):
        common[falls_end[s] : ends[s]] = most
    common[starts] = 0

    def seam_backward(stop: int) -> None:
        at = n - stop
        common[at] = meet(int(sa[at - 1]), int(sa[at]))

    backward(sa, common[1:][::-1], (n - falls_end[both][::-1]).tolist(), seam_backward)
    return sa, common[:n]
