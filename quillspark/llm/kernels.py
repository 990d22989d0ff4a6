"""Array kernels shared by the Arrow-batched operators: words and their hashes for many texts at once."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MARKS = re.compile("[\u0300-\u036f]+")
_TAGS = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|&(?:[a-zA-Z]{2,8}|#\d{2,6}|#x[0-9a-fA-F]{2,6});")
_HYPHEN = re.compile("-[ \t]*\r?\n[ \t]*|\u00ad")

#: Odd multiplier of the rolling hash and its inverse modulo 2**64 (fixed values).
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def folded(text: str) -> str:
    """Lower case without accents; markup and soft breaks of lines inside words removed."""
    if "<" in text or "&" in text:
        text = _TAGS.sub(" ", text)
    if "\u00ad" in text or "-" in text:
        text = _HYPHEN.sub("", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return text.lower()


class Words:
    """Words of a batch of folded texts.

    ``start``/``end`` are byte places in ``data``, ``doc`` the text of each word, ``hash`` a
    64-bit hash of its bytes; ``first[i]`` is the first word of text i.
    """

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "replace") for t in texts]
        self.data = b"\n".join(parts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[:-1] = _WORD[raw]
        edge = np.diff(inside, prepend=np.int8(0))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        n = len(raw) + 1
        power = np.full(n, _P, np.uint64)
        power[0] = 1
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(power)
            total = np.zeros(n, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
            inverse = np.full(n, _PINV, np.uint64)
            inverse[0] = 1
            inverse = np.multiply.accumulate(inverse)
            self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> str:
        return self.data[self.start[i]: self.end[i]].decode("utf-8", "replace")

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; grams that leave their text are 0."""
        if len(self) < n:
            return np.zeros(0, np.uint64)
        return grams(self.hash, self.doc, n)


def grams(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out * np.uint64(_P) + h[k: k + m])
    out[doc[:m] != doc[n - 1: n - 1 + m]] = 0
    return out


def _codes(texts: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each list of texts the code points of all of them, numbered as small as they allow, and the length of each text."""
    points = [np.frombuffer("".join(x).encode("utf-32-le", "surrogatepass"), np.uint32) for x in texts]
    seen = np.zeros(1 + max([0, *(int(p.max()) for p in points if len(p))]), bool)
    for p in points:
        seen[p] = True
    number = np.cumsum(seen)
    number = number.astype(np.uint8 if number[-1] < 256 else np.uint32)
    return [number[p] for p in points], [np.fromiter(map(len, x), np.int64, len(x)) for x in texts]


def edit_distances(a: list[str], b: list[str], cells: int = 1 << 17) -> np.ndarray:
    """The Levenshtein distance of each pair of texts in code points. Pairs of like lengths are worked off together, the
    table of distances by its diagonals: about ``cells`` cells of all their tables at once."""
    (ca, cb), (na, nb) = _codes([a, b])
    fa, fb = np.cumsum(na) - na, np.cumsum(nb) - nb
    long, short, out = np.maximum(na, nb), np.minimum(na, nb), np.zeros(len(a), np.int32)
    order, at = np.lexsort((short, long))[::-1], 0

    def padded(take, rows, backwards):
        n, who = (short if not backwards else long)[take], (na <= nb)[take] != backwards
        x = np.zeros((rows, len(take)), ca.dtype)
        for codes, first, use in ((ca, fa, who), (cb, fb, ~who)):
            pair = np.flatnonzero(use)
            column = np.repeat(pair, n[pair])
            place = np.arange(len(column)) - np.repeat(np.cumsum(n[pair]) - n[pair], n[pair])
            x[rows - 1 - place if backwards else place, column] = codes[first[take][column] + place]
        return x

    while at < len(order):
        most = int(long[order[at]])
        take = order[at: at + max(1, cells // (most + 1))]
        at += len(take)
        least = int(short[take].max())
        x, y = padded(take, least, False), padded(take, most, True)
        kind = np.uint8 if most < 255 else np.uint16 if most < 65_535 else np.uint32
        before, last, now, step = (np.zeros((least + 1, len(take)), kind) for _ in range(4))
        other = np.zeros((least + 1, len(take)), bool)
        ends = (short + long)[take]
        ending = np.argsort(ends, kind="stable")
        bound = np.searchsorted(ends[ending], np.arange(least + most + 2))
        for k in range(least + most + 1):
            # row i of a diagonal is the distance of the first i and k - i characters
            i, j = max(1, k - most), min(k - 1, least) + 1
            if i < j:
                np.not_equal(x[i - 1: j - 1], y[most - k + i: most - k + j], out=other[i:j])
                np.add(before[i - 1: j - 1], other[i:j].view(np.uint8), out=step[i:j])
                np.minimum(last[i - 1: j - 1], last[i:j], out=now[i:j])
                now[i:j] += kind(1)
                np.minimum(now[i:j], step[i:j], out=now[i:j])
            if k <= most:
                now[0] = k
            if k <= least:
                now[k] = k
            done = ending[bound[k]: bound[k + 1]]
            if len(done):
                out[take[done]] = now[short[take[done]], done]
            before, last, now = last, now, before
    return out


def slices(batches, text: str, chars: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of Arrow batches whose texts have about ``chars`` characters together, with the texts."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= chars:
                yield batch.slice(at, i + 1 - at), texts[at: i + 1]
                at, size = i + 1, 0
        if at < len(texts):
            yield batch.slice(at), texts[at:]


def groups(batches, key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows of each key from batches that arrive sorted by it."""
    held, now = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != now:
                yield now, held
                held = []
            now = row[key]
            held.append(row)
    if held:
        yield now, held
