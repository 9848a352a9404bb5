"""Periodic run detection by online dyadic square catching.

A run is a stretch of words with period q that no neighbouring word extends,
at least ``min_exponent`` periods and ``min_length`` words long; q is its
smallest period.

Method. Words are appended to a ``Catcher``. When a block of B words is
complete, B a power of two and the block's start a multiple of B, it becomes a
catcher of level B: it waits for its own words to come again at a distance that
is a period of its level. A run of period q repeats more than 2B - 1 words at
distance q, if B is the level of q, so that one of its blocks must catch it.
Each appended word is checked against the one or two catchers of each level
whose distance fits, and expired catchers go. A catch starts a suffix
comparison: it is extended to the left, and to the right as words arrive, until
two words differ. Squares caught at one period along one stretch merge into one
run; of runs over the same words the one with the smallest period stays.

Comparisons use running 64-bit polynomial fingerprints of all words so far, so
a comparison of any length takes a step for each power of two. Every run is
checked word by word before it is returned.

Distribution. One pass over the rows, without a shuffle; a text needs memory in
proportion to its own length. Appending many words at once gives the same runs
as appending them one by one and lets numpy do the work.

Cases. Null or empty text has no words and no runs. Rows that repeat an id are
judged one by one. A null id stays null. Other columns are not read. Texts of
any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words appended at a time.
CHUNK = 1 << 16
#: Rows returned at a time.
ROWS = 256
_BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of the fingerprint's base and of its inverse, as far as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n >= len(self.up):
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))


def _spread(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Level:
    """The catchers of one block size: names of complete blocks, and the
    periods ``least`` to ``most`` that they watch for."""

    def __init__(self, block: int, least: int, most: int):
        self.block, self.least, self.most = block, least, most
        self.first, self.names = 0, np.zeros(0, np.uint64)

    def advance(self, begin: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Catches among new windows, the first of which starts at ``begin``:
        starts of the catching blocks and of the windows."""
        b = self.block
        new = windows[-begin % b::b]
        self.names = np.concatenate([self.names, new])
        at = np.arange(begin, begin + len(windows))
        near = (at - self.least) // b
        blocks, starts = [], []
        for back in range((self.most - self.least) // b + 1):
            k = near - back
            fits = np.flatnonzero((k >= self.first) & (at - k * b <= self.most))
            fits = fits[self.names[k[fits] - self.first] == windows[fits]]
            if len(fits):
                blocks.append(k[fits] * b)
                starts.append(at[fits])
        # later windows start at begin + len(windows) at the least
        gone = max(0, -((self.most - begin - len(windows)) // b)) - self.first
        if gone > 0:
            self.first, self.names = self.first + gone, self.names[gone:]
        if not blocks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(blocks), np.concatenate(starts)


class Catcher:
    """Runs of one sequence of word numbers, which arrives by ``append``."""

    def __init__(self, min_exponent: int | Fraction = 2, min_length: int = 2, powers: Powers | None = None):
        if min_exponent < 2:
            raise ValueError("a run has at least two periods")
        self.e, self.m = Fraction(min_exponent), min_length
        self.powers = powers or Powers()
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)
        self.levels: list[Level] = []
        none = np.zeros(0, np.int64)
        self.live = (none, none)  # left end and period of what still goes on
        self.closed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # words that a run repeats at its distance: at least this many
        least = min(max(ceil(self.e * q), self.m) - q for q in range(1, ceil(self.m / self.e) + 2))
        self.block = 1
        while 4 * self.block - 1 <= least:
            self.block *= 2

    def _periods(self, block: int) -> tuple[int, int]:
        """Periods of a level: those whose runs repeat 2 * block - 1 words, as
        far as the next level doesn't have them."""
        least = 1 if block == self.block else ceil((2 * block - 1) / (self.e - 1))
        return least, ceil((4 * block - 1) / (self.e - 1)) - 1

    def _same(self, x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
        s = self.sums
        return (s[x + n] - s[x]) * self.powers.up[y - x] == s[y + n] - s[y]

    def _right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on."""
        n, end = np.zeros(len(x), np.int64), len(self.words)
        step = 1 << max(0, int((end - y).max(initial=0))).bit_length()
        while step:
            fits = np.flatnonzero(y + n + step <= end)
            n[fits] += step * self._same(x[fits] + n[fits], y[fits] + n[fits], step)
            step >>= 1
        return n

    def _left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y."""
        n = np.zeros(len(x), np.int64)
        step = 1 << max(0, int(x.max(initial=0))).bit_length()
        while step:
            fits = np.flatnonzero(x - n - step >= 0)
            n[fits] += step * self._same(x[fits] - n[fits] - step, y[fits] - n[fits] - step, step)
            step >>= 1
        return n

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        old, now = len(self.words), len(self.words) + len(words)
        self.powers.grow(now + 1)
        self.words = np.concatenate([self.words, words])
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(_spread(words) * self.powers.up[old:now])])
        # running comparisons go on
        left, period = self.live
        ends = old + self._right(old - period, np.full(len(left), old))
        found = [(left, ends, period)]
        while not self.levels or self.e * self._periods(self.levels[-1].block)[0] <= now:
            block = 2 * self.levels[-1].block if self.levels else self.block
            self.levels.append(Level(block, *self._periods(block)))
            self.levels[-1].started = False
        for level in self.levels:
            b = level.block
            # a level that begins late is shown all windows from the start
            begin = max(0, old - b + 1) if level.started else 0
            if now - b < begin:
                continue
            level.started = True
            at = slice(begin, now - b + 1)
            windows = (self.sums[begin + b:now + 1] - self.sums[at]) * self.powers.down[at]
            block, start = level.advance(begin, windows)
            if not len(block):
                continue
            q = start - block
            order = np.lexsort((block, q))
            block, q = block[order], q[order]
            # a catch by the next block at the same period is the same stretch
            head = np.r_[True, (q[1:] != q[:-1]) | (block[1:] != block[:-1] + b)]
            block, q = block[head], q[head]
            found.append((block - self._left(block, block + q), block + q + self._right(block, block + q), q))
        left, ends, period = (np.concatenate(x) for x in zip(*found))
        open_ = ends == now
        self._close(left[~open_], ends[~open_], period[~open_])
        left, ends, period = self._smallest(left[open_], ends[open_], period[open_])
        self.live = (left, period)

    def _long(self, left: np.ndarray, ends: np.ndarray, period: np.ndarray) -> np.ndarray:
        n = ends - left
        return (n >= self.m) & (n * self.e.denominator >= self.e.numerator * period)

    @staticmethod
    def _smallest(left, ends, period):
        """One of each stretch that has two periods or more of each: that with
        the smallest. What is shorter stays, but once."""
        order = np.lexsort((period, ends, left))
        left, ends, period = left[order], ends[order], period[order]
        same = np.r_[False, (left[1:] == left[:-1]) & (ends[1:] == ends[:-1])]
        again = same & np.r_[False, period[1:] == period[:-1]]
        stay = ~(same & (ends - left >= 2 * period)) & ~again
        return left[stay], ends[stay], period[stay]

    def _close(self, left, ends, period) -> None:
        ok = self._long(left, ends, period)
        if ok.any():
            self.closed.append(self._smallest(left[ok], ends[ok], period[ok]))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start and period."""
        left, period = self.live
        ends = np.full(len(left), len(self.words))
        ok = self._long(left, ends, period)
        parts = [*self.closed, (left[ok], ends[ok], period[ok])]
        left, ends, period = self._smallest(*(np.concatenate(x) for x in zip(*parts)))
        out = set()
        for a, z, q in zip(left.tolist(), ends.tolist(), period.tolist()):
            equal = self.words[a:z - q] == self.words[a + q:z]
            if equal.all():
                out.add((a, z - a, q))
                continue
            # fingerprints that agree by chance: the stretches of equal words
            cuts = np.flatnonzero(np.diff(np.r_[False, equal, False].astype(np.int8)))
            for x, y in zip((cuts[::2] + a).tolist(), (cuts[1::2] + a + q).tolist()):
                if self._long(np.array([x]), np.array([y]), np.array([q]))[0]:
                    out.add((x, y - x, q))
        best: dict[tuple[int, int], int] = {}
        for a, n, q in out:
            best[a, n] = min(q, best.get((a, n), q))
        return sorted((a, n, q) for (a, n), q in best.items())


def word_runs(words: list, min_exponent: int | Fraction, min_length: int, powers: Powers | None = None, chunk: int = CHUNK) -> list[tuple[int, int, int]]:
    """Runs of a list of words."""
    if len(words) < max(min_length, 2):
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    catcher = Catcher(min_exponent, min_length, powers)
    for i in range(0, len(ids), chunk):
        catcher.append(ids[i:i + chunk])
    return catcher.runs()


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_exponent: int | Fraction = 2, min_length: int = 2,
         rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed): the runs by start and period, and
    the text of which each run keeps its first period only, words joined by one
    space. Words are those between ASCII white space; ``rewrite`` may put
    others in their place, by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        powers = Powers()
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                sizes, runs, texts = [], [], []
                for key, value in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    words = (value.as_py() or "").encode("utf-8").split()
                    if rewrite:
                        words = rewrite(key, words)
                    found = word_runs(words, min_exponent, min_length, powers)
                    sizes.append(len(words))
                    runs.append(found)
                    if found:
                        stay = np.ones(len(words), bool)
                        for a, n, q in found:
                            stay[a + q:a + n] = False
                        words = [words[k] for k in np.flatnonzero(stay).tolist()]
                    texts.append(b" ".join(words).decode("utf-8"))
                flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
                struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
                offsets = np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), struct), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Of ``find``: the number of runs, the run with the greatest exponent
    (ties: smallest start, then period) and digests of runs and text."""
    longer = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), longer)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
