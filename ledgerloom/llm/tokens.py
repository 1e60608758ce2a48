"""Whole-text encoding shared by the token operators.

Both public vocabularies split a text into pre-tokens (a word, a number, a run of
marks, white space) and merge inside each pre-token only.  Words repeat, so the
expensive part is done once for each distinct pre-token a worker meets:

* ``spans`` cuts a whole batch of texts into pre-tokens with a few numpy passes
  over code points (no per-character Python);
* ``TokenCache`` maps a 64-bit hash of each pre-token to its code points and ids, held in flat
  arrays with an open-addressing table.  Every hit is compared by its code points, so texts made
  to collide get right ids all the same.  It is emptied when it reaches its
  documented bound, so memory doesn't grow with the corpus;
* pre-tokens that the cache lacks go to an encoder: the tokenizers library for
  ``ByteEncoder``, batched numpy merges for the operator in ``bpe.py``.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np

LETTER, NUMBER, MARK, SPACE = 0, 1, 2, 3
#: White space as the tokenizers' patterns see it.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Bound on the distinct pre-tokens a worker keeps.
CACHE_ENTRIES = 1_000_000


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file; ``folder`` or $LEDGERLOOM_TOKENIZERS override the installed ones."""
    folder = folder or os.environ.get("LEDGERLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def char_classes() -> np.ndarray:
    """Class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], MARK) for c in range(0x110000)), np.uint8, 0x110000)
    out[_SPACES] = SPACE
    # Characters younger than Python's tables: as the library's patterns class them.
    from tokenizers import Regex, normalizers

    young = "".join(map(chr, unassigned()[unassigned() < 0x40000]))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        shown = normalizers.Replace(Regex(pattern), "x").normalize_str(young)
        out[[ord(a) for a, b in zip(young, shown) if a != b]] = kind
    return out


@functools.cache
def unassigned() -> np.ndarray:
    """Code points that Python's tables don't know."""
    return np.array([c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"], np.int64)


@functools.cache
def _young() -> np.ndarray:
    """Of each code point: Python's tables don't know it."""
    out = np.zeros(0x110000, bool)
    out[unassigned()] = True
    return out


def young_texts(cp: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which of the texts (as ``flatten`` lays them) hold a code point that Python's tables don't know."""
    seen = np.concatenate([[0], np.cumsum(_young()[cp])])
    return seen[docs[1:]] > seen[docs[:-1]]


@functools.cache
def _mixers() -> tuple[np.ndarray, int, int]:
    """A random odd number for each code point, the base of the polynomial and its inverse mod 2**64."""
    rng = np.random.default_rng(20240611)
    table = rng.integers(0, 2**63, 0x110000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    return table, base, pow(base, -1, 2**64)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    _, base, inverse = _mixers()
    up, down = (np.full(n + 1, x, np.uint64) for x in (base, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def flatten(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the offset of each text (one more than texts)."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(joined, np.uint32), np.concatenate([[0], np.cumsum(lens)])


def spans(cp: np.ndarray, docs: np.ndarray, keep_spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each pre-token.

    keep_spaces: a space joins the pre-token after it and other white space makes
    pre-tokens of its own (byte-level vocabularies); else white space is dropped
    and each digit stands alone (word-end vocabularies).
    """
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cls = char_classes()[cp]
    first = np.zeros(n + 1, bool)  # of a text
    first[docs] = True
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start |= first[:n]
    is_space = cls == SPACE
    if keep_spaces:
        # The last white space before something else stands apart; if it is U+0020, it joins what follows.
        last = np.flatnonzero(is_space[:-1] & ~is_space[1:] & ~first[1:n])
        start[last] = True
        start[last + 1] = cp[last] != 0x20
    else:
        start |= cls == NUMBER
    quotes = np.flatnonzero((cp == 0x27) & start)
    if len(quotes):
        ends = docs[np.searchsorted(docs, quotes, side="right")]
        pad = np.concatenate([cp, np.zeros(2, cp.dtype)])
        a = np.where(quotes + 1 < ends, pad[quotes + 1], 0)
        b = np.where(quotes + 2 < ends, pad[quotes + 2], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        start[quotes[one | two] + 1] = False
        start[quotes[two] + 2] = False
        after = np.concatenate([quotes[one] + 2, quotes[two] + 3])
        start[after[after < n]] = True
    s = np.flatnonzero(start)
    e = np.append(s[1:], n)
    if not keep_spaces:
        word = cls[s] != SPACE
        s, e = s[word], e[word]
    return s, e


def hashes(cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, never zero."""
    table, _, _ = _mixers()
    size = 1 << max(12, int(len(cp)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(table[cp] * up[: len(cp)], out=sums[1:])
    h = (sums[e] - sums[s]) * down[s]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h | np.uint64(1)


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions of many ranges, one after the other."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
    return shift + np.arange(total, dtype=np.int64)


class TokenCache:
    """Ids of pre-tokens by hash, at most ``entries`` at a time."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self._clear()

    def _clear(self) -> None:
        self.mask = (1 << max(10, (2 * self.entries).bit_length())) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.vals = np.zeros(self.mask + 1, np.int32)
        self.ids, self.cps = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.uint32)
        self.offs, self.ends = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)  # of ids and of code points
        self.n = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash; -1: not there."""
        out = np.full(len(h), -1, np.int32)
        todo, at = np.arange(len(h)), (h >> np.uint64(7)).astype(np.int64) & self.mask
        while len(todo):
            key = self.keys[at]
            hit = key == h[todo]
            out[todo[hit]] = self.vals[at[hit]]
            on = ~hit & (key != 0)
            todo, at = todo[on], (at[on] + 1) & self.mask
        return out

    @staticmethod
    def _put(flat: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
        """flat with more from its place used on, grown by doubling."""
        size = len(flat)
        while used + len(more) > size:
            size *= 2
        if size > len(flat):
            flat = np.concatenate([flat, np.zeros(size - len(flat), flat.dtype)])
        flat[used : used + len(more)] = more
        return flat

    def add(self, h: np.ndarray, ids: np.ndarray, lens: np.ndarray, cps: np.ndarray | None = None, sizes: np.ndarray | None = None) -> None:
        """h: distinct, and none of them there; ids and code points (none by default) of all of them, and how many each has."""
        cps, sizes = (np.zeros(0, np.uint32), np.zeros(len(h), np.int64)) if cps is None else (cps, sizes)
        m, n = len(h), self.n
        ids_used, cps_used = int(self.offs[n]), int(self.ends[n])
        self.ids, self.cps = self._put(self.ids, ids_used, ids), self._put(self.cps, cps_used, cps)
        self.offs, self.ends = self._put(self.offs, n + 1, ids_used + np.cumsum(lens)), self._put(self.ends, n + 1, cps_used + np.cumsum(sizes))
        vals = np.arange(n, n + m, dtype=np.int32)
        todo, at = np.arange(m), (h >> np.uint64(7)).astype(np.int64) & self.mask
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[todo[free]]
            won = self.keys[at] == h[todo]
            self.vals[at[won]] = vals[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.mask
        self.n += m

    def differing(self, entry: np.ndarray, cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Indices of the spans whose code points aren't those of their entry."""
        sizes, begin = e - s, self.ends[entry]
        wrong = self.ends[entry + 1] - begin != sizes
        same = np.flatnonzero(~wrong)
        n = sizes[same]
        odd = np.flatnonzero(cp[gather(s[same], n)] != self.cps[gather(begin[same], n)])
        if len(odd):
            wrong[same[np.searchsorted(np.cumsum(n), odd, side="right")]] = True
        return np.flatnonzero(wrong)

    def encode(self, cp: np.ndarray, s: np.ndarray, e: np.ndarray, miss: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in order, and how many each has. miss(starts, ends) -> ids, counts."""
        h = hashes(cp, s, e)
        entry = self.find(h)
        lost = np.flatnonzero(entry < 0)
        if len(lost):
            new, at = np.unique(h[lost], return_index=True)
            if self.n + len(new) > self.entries and self.n:
                self._clear()
                return self.encode(cp, s, e, miss)
            if len(new) > self.entries:  # one batch of more distinct pre-tokens than the bound: without the cache
                return miss(s, e)
            a, b = s[lost[at]], e[lost[at]]
            ids, lens = miss(a, b)
            self.add(new, ids, lens, cp[gather(a, b - a)], b - a)
            entry[lost] = self.find(h[lost])
        lens = (self.offs[entry + 1] - self.offs[entry]).astype(np.int64)
        out, wrong = self.ids[gather(self.offs[entry], lens)], self.differing(entry, cp, s, e)
        if not len(wrong):
            return out, lens
        ids, n = miss(s[wrong], e[wrong])  # other pre-tokens of the same hash: without the cache
        pieces, own = np.split(out, np.cumsum(lens)[:-1]), np.split(ids, np.cumsum(n)[:-1])
        lens[wrong] = n
        for i, piece in zip(wrong.tolist(), own):
            pieces[i] = piece
        return np.concatenate(pieces), lens


def batches(texts: Sequence[str], chars: int = 1 << 19):
    """Slices of texts of about so many characters, one text at least."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


class ByteEncoder:
    """A byte-level vocabulary of the tokenizers library; equal to its encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [x.content for x in self.tok.get_added_tokens_decoder().values()]
        self.cache = TokenCache(entries)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offset of each text."""
        ids, lens = [], []
        for a, b in batches(texts):
            part, n = self._batch(texts[a:b])
            ids.append(part)
            lens.append(n)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        counts = np.concatenate(lens) if lens else np.zeros(0, np.int64)
        return flat, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def _batch(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if any(x in t for x in self.special)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        cp, docs = flatten(plain)
        s, e = spans(cp, docs, keep_spaces=True)
        ids, lens = self.cache.encode(cp, s, e, lambda a, b: self._miss(cp, a, b))
        ends = np.concatenate([[0], np.cumsum(lens)])[np.searchsorted(s, docs)]
        counts = np.diff(ends)
        if odd:  # special strings inside a text: the library itself
            pieces = np.split(ids, ends[1:-1])
            for i in odd:
                pieces[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, np.int32)
            ids, counts = np.concatenate(pieces), np.array([len(x) for x in pieces], np.int64)
        return ids, counts

    def _miss(self, cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = [w.tobytes().decode("utf-32-le", "surrogatepass") for w in (cp[a:b] for a, b in zip(s.tolist(), e.tolist()))]
        ids, lens = [], np.zeros(len(words), np.int64)
        for at in range(0, len(words), 2000):
            enc = self.tok.encode(words[at : at + 2000], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(enc.ids, np.int32))
            np.add.at(lens, at + np.array(enc.word_ids, np.int64), 1)
        return np.concatenate(ids), lens


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One for each worker, with its cache."""
    return ByteEncoder(path)
