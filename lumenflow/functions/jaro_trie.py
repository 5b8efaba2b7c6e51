"""Best Jaro-Winkler matches of many strings among many, by a search down their trie.

Jaro matching takes the characters of the row ``a`` in order, each the first free equal
character of the member ``b`` inside the window.  Seen from ``b``: its characters in order,
each is taken by the first free equal character of ``a`` inside the window, as earlier
characters of ``b`` are preferred and later ones can't change what was taken.  So the matching
is built from the front of ``b``, and members that share a prefix share the work on it.

The trie's nodes at a depth are runs of the members in order.  All (row, node) pairs of a depth
go on together, one character a step, as numpy arrays.  The state of a pair is a bit mask of
``a``'s taken places, one of ``b``'s, and ``a``'s free characters in unary (of each character
a run of bits, as many as are free).  No member below a node has more in common than what is
taken, and of each character the smaller of what ``a`` has free and the most that a rest below
the node has: bits set in both unary numbers.  A pair goes on only if that many reach the best
score found so far for the row (or the floor that the caller has from elsewhere).  Before
nodes are many, transpositions are counted too: the taken places of ``a`` up to the first
open one, that a rest could still take, are final, and so are as many of ``b``'s; where
the two differ is out of order.  At every ``LOOK``-th character also as if that place were
taken, or never were.

Rows without a floor get one first from a beam: at each depth the few nodes of the highest
bounds.  The window depends on the longer of the two strings, so members of different
lengths share no node.
"""

from __future__ import annotations

import numpy as np

from lumenflow.functions.jaro_winkler import BOOST_THRESHOLD, PREFIX_MAX, PREFIX_WEIGHT, SCORE_DIGITS, WORD, _codes

SLACK = 1e-9
BEAM = 8                    # nodes of a row that a beam keeps at a depth
GUESS = 0.004               # what a beam takes off a bound for a place that is not settled
LOOK = 4
PAIRS = 1 << 16             # (row, node) pairs that go on together
_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _words(n: int) -> int:
    return max(-(-n // WORD), 1)


def _unary(counts: np.ndarray) -> np.ndarray:
    """As many low bits as counted, at most 64."""
    low = (_ONE << np.minimum(counts, WORD - 1).astype(np.uint64)) - _ONE
    return np.where(counts >= WORD, _ALL, low)


class Trie:
    """Members, each string once, sorted by length and characters; no empty ones."""

    def __init__(self, strings) -> None:
        self.strings = sorted({s for s in strings if s}, key=lambda s: (len(s), s))
        codes, self.length = _codes(self.strings, -1)
        n, self.width = len(self.strings), int(self.length.max(initial=0))
        self.alphabet = np.unique(codes[codes >= 0])
        self.ids = np.searchsorted(self.alphabet, codes).astype(np.int32)
        self.lengths, self.kind = np.unique(self.length, return_inverse=True)
        common = np.full(n, -1)             # characters shared with the member before
        common[1:] = np.where(self.length[1:] == self.length[:-1], (codes[1:] != codes[:-1]).argmax(axis=1), -1)
        # by depth: the first member of each node, how many nodes are at their end, the first
        # child of each other node, and the character that leads to a node
        self.starts = [np.flatnonzero((common < d) & (self.length >= d)) for d in range(self.width + 1)]
        self.ended = [int(np.count_nonzero(self.length[s] == d)) for d, s in enumerate(self.starts)]
        self.begin = [np.append(np.searchsorted(below, s[e:]), len(below))
                      for s, e, below in zip(self.starts, self.ended, self.starts[1:])]
        self.char = [None] + [self.ids[s, d] for d, s in enumerate(self.starts[1:])]
        self._layout(codes)
        self._rests()

    def _layout(self, codes: np.ndarray) -> None:
        """A run of bits for each character, as long as the most of it in a member."""
        size, inside = len(self.alphabet), codes >= 0
        self.most = np.zeros(size, dtype=np.int64)
        for c in range(size):
            self.most[c] = ((self.ids == c) & inside).sum(axis=1).max()
        self.word, self.shift = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.uint64)
        used: list[int] = []
        # (a character that is in a member more than 64 times has no run: then nothing is known of a rest)
        for c in np.argsort(-self.most) if self.most.max(initial=0) <= WORD else ():
            w = next((i for i, u in enumerate(used) if u + self.most[c] <= WORD), len(used))
            if w == len(used):
                used.append(0)
            self.word[c], self.shift[c] = w, used[w]
            used[w] += int(self.most[c])
        self.unary = len(used)
        run = _unary(self.most) << self.shift
        # (the last entry is for characters that no member has)
        self.run = [np.append(np.where(self.word == w, run, np.uint64(0)), np.uint64(0)) for w in range(self.unary)]
        self.first = [np.where(self.word == w, _ONE << self.shift, np.uint64(0)) for w in range(self.unary)]

    def _rests(self) -> None:
        """Of each node and character the most that one member has behind the node, in unary."""
        self.rest = [[np.zeros(len(s), dtype=np.uint64) for _ in range(self.unary)] for s in self.starts]
        for d in range(self.width - 1, -1, -1):
            for w in range(self.unary if len(self.starts[d + 1]) else 0):
                below, run = self.rest[d + 1][w], self.run[w][self.char[d + 1]]
                grown = below & ~run | ((below & run) << _ONE | self.first[w][self.char[d + 1]]) & run
                self.rest[d][w][self.ended[d]:] = np.bitwise_or.reduceat(grown, self.begin[d][:-1])

    def counts(self, ids: np.ndarray) -> list[np.ndarray]:
        """The characters of strings, given as ids, in the runs of bits."""
        out = [np.zeros(len(ids), dtype=np.uint64) for _ in range(self.unary)]
        for c in range(len(self.alphabet) if self.unary else 0):
            n = np.minimum((ids == c).sum(axis=1), self.most[c])
            out[self.word[c]] |= _unary(n) << self.shift[c]
        return out


def _score(la, lb, m, t, prefix):
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - t) / np.maximum(m, 1)) / 3.0, 0.0)
    return np.where(jaro > BOOST_THRESHOLD, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


class Batch:
    """Rows against the members of a trie.

    The state of (row, node) pairs is a dict of arrays: the node, the pair of row and length, what
    is taken (``m``), the common prefix (``p``), places out of order among those that are
    settled (``wrong``), and masks in lists of words: ``a`` taken places, ``open`` places that a
    rest might take, ``ua`` and ``ub`` taken places of row and member that are not settled yet,
    ``free`` the row's free characters in unary."""

    def __init__(self, rows: list[str], trie: Trie, floors=None) -> None:
        self.trie, n = trie, len(rows)
        self.floor = np.zeros(n) if floors is None else np.array(floors, dtype=float)
        codes, self.la = _codes(rows, -1)
        self.wide, self.wide_b = _words(codes.shape[1]), _words(trie.width)
        size = self.size = len(trie.alphabet)
        at = np.minimum(np.searchsorted(trie.alphabet, codes), max(size - 1, 0))
        known = trie.alphabet[at] == codes if size else np.zeros(codes.shape, dtype=bool)
        self.a = np.full((n, self.wide * WORD + 1), size, dtype=np.int32)       # ``size``: not in a member
        self.a[:, :codes.shape[1]] = np.where(known, at, size)
        self.places = np.zeros((self.wide, n, size + 1), dtype=np.uint64)
        for i in range(codes.shape[1]):
            self.places[i // WORD, np.arange(n), self.a[:, i]] |= _ONE << np.uint64(i % WORD)
        self.known = [np.bitwise_or.reduce(x[:, :size], axis=1) for x in self.places]
        self.places = self.places.reshape(self.wide, -1)
        self.kinds = len(trie.lengths)
        self.row = np.repeat(np.arange(n, dtype=np.int32), self.kinds)
        self.lb = np.tile(trie.lengths, n).astype(np.int32)
        self.window = np.maximum(np.maximum(self.la[self.row], self.lb) // 2 - 1, 0)
        self.scored = np.zeros(n, dtype=np.int64)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._masks: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

    # -- the score that is needed ----------------------------------------------------------

    def _needed(self, rows: np.ndarray) -> np.ndarray:
        """The fewest equal characters with which a row reaches its floor, by length of the
        member and common prefix: (rows, lengths, prefix)."""
        p = np.arange(PREFIX_MAX + 1) * PREFIX_WEIGHT
        f = self.floor[rows][:, None, None] - SLACK
        jaro = np.maximum((f - p) / (1.0 - p), np.minimum(f, BOOST_THRESHOLD))
        la = np.maximum(self.la[rows], 1)[:, None, None]
        m = (3.0 * jaro - 1.0) / (1.0 / la + 1.0 / self.trie.lengths[None, :, None])
        return np.maximum(np.ceil(m - 1e-6), 1).astype(np.int32)

    def _more(self, d: int, pair: np.ndarray, node: np.ndarray, free: list[np.ndarray]) -> np.ndarray:
        """No member below has more characters in common with what the row has free."""
        rest = self.lb.take(pair) - d
        if not self.trie.unary:
            return rest
        more = sum(np.bitwise_count(u & r.take(node)).astype(np.int32) for u, r in zip(free, self.trie.rest[d]))
        return np.minimum(more, rest)

    @staticmethod
    def _prefix(d: int, p: np.ndarray) -> np.ndarray:
        """The most that the common prefix can become."""
        return p if d >= PREFIX_MAX else np.where(p == d, PREFIX_MAX, p)

    def _bound(self, d: int, s: dict, look: bool = False) -> np.ndarray:
        """The score that no member below exceeds, with what is settled.  With ``look``
        also with what is settled once the first open place is taken, or never is."""
        self._settle(d, s)
        score = self._of(d, s)
        if look:
            row = self.row.take(s["pair"])
            place, low = self._lowest(s["open"])
            at = np.flatnonzero((place < self.wide * WORD) & (score + SLACK >= self.floor.take(row))
                                & np.logical_or.reduce([x != 0 for x in s["ua"]]))
            low, char, some = [x[at] for x in low], self.a[row[at], place[at]], self._pick(s, at)
            some["open"] = [x ^ bit for x, bit in zip(some["open"], low)]
            taken = some | {"ua": [x | bit for x, bit in zip(some["ua"], low)], "wrong": some["wrong"].copy(),
                            "open": [x.copy() for x in some["open"]]}
            self._settle(d, taken, guess=True)
            # one free character less, where the unary number isn't cut at the most of a member
            spot = row[at].astype(np.int64) * (self.size + 1) + char
            left = sum(np.bitwise_count(x.take(spot) & ~a).astype(np.int32) for x, a in zip(self.places, some["a"]))
            for x, run in zip(some["free"], self.trie.run):
                run = x & run.take(char)
                x ^= run & ~(run >> _ONE) & np.where(np.bitwise_count(run) == left, _ALL, np.uint64(0))
            self._settle(d, some, guess=True)
            score[at] = np.maximum(self._of(d, taken | {"free": self._pick(s, at)["free"]}), self._of(d, some))
        return score

    def _of(self, d: int, s: dict) -> np.ndarray:
        m = s["m"] + self._more(d, s["pair"], s["node"], s["free"])
        return _score(self.la.take(self.row.take(s["pair"])), self.lb.take(s["pair"]), m, s["wrong"] // 2, self._prefix(d, s["p"]))

    # -- states ------------------------------------------------------------------------------

    @staticmethod
    def _pick(s: dict, at) -> dict:
        if isinstance(at, np.ndarray) and at.dtype == bool:
            at = np.flatnonzero(at)
        return {k: [x[at] for x in v] if isinstance(v, list) else v[at] for k, v in s.items()}

    def _roots(self, rows: np.ndarray, free: list[np.ndarray]) -> dict:
        row, node = np.repeat(rows, self.kinds), np.tile(np.arange(self.kinds, dtype=np.int32), len(rows))
        n = len(row)
        s = {"node": node, "pair": row * self.kinds + node, "free": [x[row] for x in free]}
        s |= {k: np.zeros(n, dtype=np.int32) for k in ("m", "p", "wrong")}
        s["open"] = [x[row] for x in self.known]
        return s | {k: [np.zeros(n, dtype=np.uint64) for _ in range(self.wide_b if k == "ub" else self.wide)]
                    for k in ("a", "ua", "ub")}

    def _mask(self, d: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The places from the first that the character at ``d`` reaches, and up to the
        last, by window."""
        if d not in self._masks:
            v = np.arange(int(self.window.max()) + 1)
            low, high = ([_unary(np.clip(x - w * WORD, 0, WORD)) for w in range(self.wide)] for x in (d - v, d + v + 1))
            self._masks[d] = [~x for x in low], high
        return self._masks[d]

    def _sons(self, d: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first child, number of children) of nodes that are not at their end."""
        k = node - self.trie.ended[d]
        first = self.trie.begin[d].take(k)
        return first, self.trie.begin[d].take(k + 1) - first

    def _step(self, d: int, s: dict, need: np.ndarray | None = None) -> dict:
        """From nodes at depth ``d`` (none at their end) to their children, those with as many
        equal characters as needed."""
        trie = self.trie
        node, sons = self._sons(d, s["node"])
        at = None
        if len(sons) and sons.max() > 1:
            at = np.repeat(np.arange(len(sons)), sons)
            node = node[at] + np.arange(len(at)) - (np.cumsum(sons) - sons)[at]
        of = (lambda x: x) if at is None else (lambda x: x[at])
        char, pair = trie.char[d + 1].take(node), of(s["pair"])
        row, window = self.row.take(pair), self.window.take(pair)
        spot = row.astype(np.int64) * (self.size + 1) + char
        hit, taken = np.zeros(len(node), dtype=bool), []
        for w, (low, high) in enumerate(zip(*self._mask(d))):
            free = self.places[w].take(spot) & ~of(s["a"][w]) & low.take(window) & high.take(window)
            free &= ~free + _ONE
            if w:
                free[hit] = 0
            taken.append(free)
            hit |= free != 0
        free = []
        for u, run in zip(s["free"], trie.run):
            u, run = of(u), run.take(char)
            x = u & run
            free.append(u ^ (x & ~(x >> _ONE & run)) * hit)     # the top bit of the run
        m, p = of(s["m"]) + hit, of(s["p"])
        if d < PREFIX_MAX:
            p = p + ((p == d) & (self.a[row, d] == char))
        if need is not None and at is not None:
            keep = np.flatnonzero(m + self._more(d + 1, pair, node, free) >= need[pair, self._prefix(d + 1, p)])
            at, node, pair, m, p, hit = at[keep], node[keep], pair[keep], m[keep], p[keep], hit[keep]
            taken, free = [x[keep] for x in taken], [x[keep] for x in free]
        ub = [of(x) for x in s["ub"]]
        ub[d // WORD] = ub[d // WORD] | hit.astype(np.uint64) << np.uint64(d % WORD)
        return {"node": node, "pair": pair, "m": m, "p": p, "wrong": of(s["wrong"]), "free": free,
                "a": [of(x) | t for x, t in zip(s["a"], taken)], "open": [of(x) & ~t for x, t in zip(s["open"], taken)],
                "ua": [of(x) | t for x, t in zip(s["ua"], taken)], "ub": ub}

    @staticmethod
    def _lowest(words: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(lowest place in masks, that bit)."""
        low = [x & (~x + _ONE) for x in words]
        place = np.bitwise_count(low[0] - _ONE).astype(np.int32)        # (64 where there is none)
        for w in range(1, len(low)):
            low[w] = np.where(place == w * WORD, low[w], np.uint64(0))
            place += np.where(place == w * WORD, np.bitwise_count(low[w] - _ONE), 0).astype(np.int32)
        return place, low

    def _settle(self, d: int, s: dict, end: bool = False, guess: bool = False) -> None:
        """Taken places before the first that a rest can still take are final, and so are as
        many of the member's: count those out of order.  With ``guess`` the state is not
        gone on with, and the row may have a place more than the member."""
        trie, row, node = self.trie, self.row.take(s["pair"]), s["node"]
        if not end:
            window = self.window.take(s["pair"])
            for x, low in zip(s["open"], self._mask(d)[0]):
                x &= low.take(window)
            todo = np.arange(len(row) if trie.unary else 0)
            while len(todo):
                place, low = self._lowest([x[todo] for x in s["open"]])
                char, gone = self.a[row[todo], place], place < self.wide * WORD
                for rest, run in zip(trie.rest[d], trie.run):
                    gone &= (rest.take(node[todo]) & run.take(char)) == 0
                todo = todo[gone]
                for x, bit in zip(s["open"], low):
                    x[todo] ^= bit[gone]
            below, before = [], np.ones(len(row), dtype=bool)
            for x, bit in zip(s["open"], self._lowest(s["open"])[1]):
                below.append(np.where(before, bit - _ONE, 0))          # (all, where no bit is set)
                before &= x == 0
            final = [x & y for x, y in zip(s["ua"], below)]
        else:
            final = s["ua"]
        count = sum(np.bitwise_count(x).astype(np.int64) for x in final)
        at = np.flatnonzero(count)
        if not len(at):
            return
        # character by character: the final ones of the row, and as many of the member
        count, held = count[at], sum(np.bitwise_count(x[at]).astype(np.int64) for x in s["ub"])
        in_a, in_b = self._places([x[at] for x in final]), self._places([x[at] for x in s["ub"]])
        first_a, count = np.cumsum(count) - count, np.minimum(count, held)
        nth, before = np.arange(count.sum()), np.cumsum(count) - count
        owner = np.repeat(at, count)
        in_a, in_b = in_a[nth + np.repeat(first_a - before, count)], in_b[nth + np.repeat(np.cumsum(held) - held - before, count)]
        differ = self.a[row[owner], in_a] != trie.ids[trie.starts[d].take(node)[owner], in_b]
        s["wrong"][at] += np.bincount(np.repeat(np.arange(len(at)), count), differ, len(at)).astype(np.int32)
        if guess:
            return
        for x, f in zip(s["ua"], final):
            x ^= f
        last = in_b[np.cumsum(count) - 1]
        for w, x in enumerate(s["ub"]):
            x[at] &= ~_unary(np.clip(last + 1 - w * WORD, 0, WORD))

    @staticmethod
    def _places(words: list[np.ndarray]) -> np.ndarray:
        """The places of the bits set, mask by mask."""
        bits = np.unpackbits(np.stack(words, axis=1).view(np.uint8), bitorder="little")
        return np.flatnonzero(bits.view(bool)) % (len(words) * WORD)

    def _score_members(self, d: int, s: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, member, score) of nodes at their end."""
        member, row = self.trie.starts[d].take(s["node"]), self.row.take(s["pair"])
        self._settle(d, s, True)
        return row, member, np.round(_score(self.la[row], d, s["m"], s["wrong"] // 2, s["p"]), SCORE_DIGITS)

    # -- the search --------------------------------------------------------------------------

    def _beam(self, rows: np.ndarray, free: list[np.ndarray]) -> None:
        """A floor for rows: members at the end of the best ways down."""
        s = self._roots(rows, free)
        for d in range(self.trie.width + 1):
            if d:
                s = self._step(d - 1, s)
            if len(s["node"]) > BEAM * len(rows):
                row = self.row.take(s["pair"]).astype(np.int64)
                # (a guess beside the bound: places that are not settled are often out of order)
                rank = self._bound(d, s) - GUESS * sum(np.bitwise_count(x) for x in s["ua"])
                order = np.argsort((row << 32) + ((1.0 - rank) * (1 << 30)).astype(np.int64))
                of = row[order]
                nth = np.arange(len(of)) - np.searchsorted(of, of)
                s = self._pick(s, np.sort(order[nth < BEAM]))
            end = s["node"] < self.trie.ended[d]
            if end.any():
                row, _, score = self._score_members(d, self._pick(s, end))
                np.maximum.at(self.floor, row, score)
                s = self._pick(s, ~end)

    def _all(self, rows: np.ndarray, free: list[np.ndarray]) -> None:
        """Every member that reaches the floor."""
        need = self._needed(np.arange(len(self.la))).reshape(-1, PREFIX_MAX + 1)
        s = self._roots(rows, free)
        keep = self._more(0, s["pair"], s["node"], s["free"]) >= need[s["pair"], PREFIX_MAX]
        todo = [(0, self._pick(s, keep))]
        while todo:
            d, s = todo.pop()
            n = len(s["node"])
            if n > PAIRS:
                todo += [(d, self._pick(s, slice(i, i + PAIRS))) for i in range(0, n, PAIRS)]
                continue
            end = s["node"] < self.trie.ended[d]
            if end.any():
                done = self._pick(s, end)
                row, member, score = self._score_members(d, self._pick(done, done["m"] >= need[done["pair"], done["p"]]))
                self.scored += np.bincount(row, minlength=len(self.la))
                good = (score >= self.floor[row]) & (score > 0)
                row, member, score = row[good], member[good], score[good]
                was = self.floor.copy()
                np.maximum.at(self.floor, row, score)
                self.found.append((row, member, score))
                better = np.flatnonzero(self.floor > was)
                if len(better):
                    need.reshape(-1, self.kinds, PREFIX_MAX + 1)[better] = self._needed(better)
                s = self._pick(s, ~end)
            # before they are many: the sons begin with what is settled
            if len(s["node"]) and (d % LOOK == LOOK - 1 or self._sons(d, s["node"])[1].max() > 1):
                s = self._pick(s, self._bound(d, s, d % LOOK == LOOK - 1) + SLACK >= self.floor.take(self.row.take(s["pair"])))
            if len(s["node"]):
                todo.append((d + 1, self._step(d, s, need)))

    def _parts(self, rows: np.ndarray, size: int) -> list[np.ndarray]:
        return [rows[i:i + max(size, 1)] for i in range(0, len(rows) if self.kinds else 0, max(size, 1))]

    def floors(self) -> np.ndarray:
        """Of each row the score of some member, a high one; 0 where none was found."""
        free = self.trie.counts(self.a)
        for part in self._parts(np.flatnonzero((self.floor <= 0) & (self.la > 0)), PAIRS // (4 * BEAM)):
            self._beam(part, free)
        return self.floor

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, member, score) of all members that have the highest score of their row, if
        it reaches the row's floor and is more than 0."""
        self.floors()
        free = self.trie.counts(self.a)
        for part in self._parts(np.flatnonzero(self.la > 0), PAIRS // max(self.kinds, 1)):
            self._all(part, free)
        row, member, score = (np.concatenate(x) for x in zip(*self.found)) if self.found else (np.zeros(0, int),) * 3
        top = score == self.floor[row]
        return row[top], member[top], score[top]

    def bound(self) -> np.ndarray:
        """Of each row the score that no member exceeds."""
        s = self._roots(np.arange(len(self.la)), self.trie.counts(self.a))
        m = self._more(0, s["pair"], s["node"], s["free"])
        score = _score(np.maximum(self.la, 1)[self.row], self.lb, m, 0, PREFIX_MAX)
        return score.reshape(len(self.la), -1).max(axis=1, initial=0.0)


class Search:
    """One row against tries."""

    def __init__(self, a: str) -> None:
        self.a, self.scored = a, 0

    def bound(self, trie: Trie) -> float:
        """No member of the trie scores more."""
        return float(Batch([self.a], trie).bound()[0])

    def best(self, tries: list[Trie], floor: float = 0.0) -> tuple[float, list[str]]:
        """(highest score, the members that have it) among those that reach ``floor``;
        no members if none does."""
        found: list[str] = []
        for trie in tries:
            batch = Batch([self.a], trie, [floor])
            _, member, score = batch.run()
            self.scored += int(batch.scored[0])
            if len(score):
                found = (found if score[0] == floor else []) + [trie.strings[i] for i in member]
                floor = float(score[0])
        return floor, found


def tries_of(strings) -> list[Trie]:
    return [Trie(strings)]
