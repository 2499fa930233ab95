"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are lower-cased and runs of white space become one space. An item of m characters is found
where a substring of the text is within k = floor(``edit_rate`` * m) edits of it. Such a place shares at least
m - q + 1 - k q of the item's character q-grams, on diagonals (text offset - item offset) that differ by at most k, so
it lies whole in one of the overlapping bands of 2 (k + 1) diagonals. Bands with that many shared q-grams are kept and
verified by alignment inside the band; no place within the budget is lost, and none beyond it is reported. Short items
take a smaller q, so that the lemma asks for one q-gram at least; under 10 characters there is no edit to allow at 10 %,
and an item shorter than q is its own q-gram.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatwatch.llm.common import map_slices, table, texts

MULTIPLIER = 0x9E3779B97F4A7C15
BITMAP_BITS = 22


def normalize(text: str) -> str:
    return " ".join(text.lower().split())


def offsets(text: str) -> np.ndarray:
    """For each character of ``normalize(text)`` the offset of its source in ``text``, and last the text's end."""
    at, gap, where = [], -1, 0
    for i, ch in enumerate(text):
        low = ch.lower()
        if low.isspace():
            gap = i if at else -1
            continue
        if gap >= 0:
            at.append(gap)
            gap = -1
        at.extend([i] * len(low))
        where = i + 1
    return np.array([*at, where], np.int64)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram of a code array (a polynomial, built by doubling, then mixed)."""
    count = len(x) - q + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, done, width, power, cur = None, 0, 1, MULTIPLIER, x.astype(np.uint64)
    left = q
    while left:
        if left & 1:
            part = cur[done:done + count]
            total = part.copy() if total is None else total * np.uint64(power) + part
            done += width
        left >>= 1
        if left:
            cur = cur[:-width] * np.uint64(power) + cur[width:] if len(cur) > width else cur[:0]
            power = power * power % (1 << 64)
            width *= 2
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def budget(m: int, edit_rate: float) -> int:
    """Edits allowed for an item of ``m`` characters."""
    return int(edit_rate * m + 1e-9)


def gram_size(m: int, q: int, edit_rate: float) -> int:
    """The largest q-gram up to ``q`` of which the lemma still asks for one: m - q + 1 - k q >= 1."""
    return max(1, min(q, m // (budget(m, edit_rate) + 1)))


def aligned(item: np.ndarray, window: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """Best (edits, start, end) of ``item`` in ``window`` on diagonals ``low - k`` to ``high + k``; None beyond ``k``.

    Both ends in the window are free. Ties go to the least start, then the least end.
    """
    a, b = low - k, high + k
    width, far = b - a + 1, len(item) + len(window) + 1
    diag = np.arange(a, b + 1)
    fill = lambda at: (at >= 0) & (at <= len(window))
    step = np.arange(width)
    scale = len(window) + 1                       # cost and start in one number: cost first, then the least start
    key = np.where(fill(diag), diag, far * scale)
    padded = np.concatenate((window, [0])).astype(np.int64)
    for j in range(1, len(item) + 1):
        at = diag + j
        same = (padded[np.clip(at - 1, 0, len(window))] == item[j - 1]) & (at >= 1) & (at <= len(window))
        best = key + np.where(same, 0, scale)
        best[:-1] = np.minimum(best[:-1], key[1:] + scale)         # a character of the item is missing in the text
        best = np.where(fill(at), best, far * scale)
        key = np.minimum.accumulate(best - step * scale) + step * scale    # a character of the text is extra
        key = np.where(fill(at), key, far * scale)
    end = diag + len(item)
    least = key.min()
    if least // scale > k:
        return None
    at = int(np.flatnonzero(key == least)[0])
    return int(least // scale), int(least % scale), int(end[at])


class Grams:
    """q-grams of items that take the same q, and the regions of a text that share enough of them."""

    def __init__(self, items: list[np.ndarray], q: int, edit_rate: float):
        self.q, self.items = q, items
        self.k = [budget(len(x), edit_rate) for x in items]
        self.need = [len(x) - q + 1 - k * q for x, k in zip(items, self.k)]
        grams = [gram_hashes(x, q) for x in self.items]
        hashes = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else owner
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.unique, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[self.slot(self.unique)] = True
        self.need, self.k = np.array(self.need, np.int64), np.array(self.k, np.int64)

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)

    def bands(self, x: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the regions that meet the lemma's bound, overlapping ones merged."""
        hashes = gram_hashes(x, self.q)
        at = np.flatnonzero(self.bitmap[self.slot(hashes)])
        if not len(at) or not len(self.unique):
            return []
        found = np.searchsorted(self.unique, hashes[at])
        found[found == len(self.unique)] = 0
        same = self.unique[found] == hashes[at]
        at, found = at[same], found[same]
        reps = self.count[found]
        if not len(at):
            return []
        row = np.repeat(self.first[found] - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
        item, diagonal = self.owner[row], np.repeat(at, reps) - self.place[row]
        common = np.bincount(item, minlength=len(self.need)) >= self.need      # too few in the whole text: no band can do
        keep = common[item]
        item, diagonal, place = item[keep], diagonal[keep], self.place[row][keep]
        if not len(item):
            return []
        half = self.k[item] + 1
        lead = diagonal // half                        # band b: diagonals [b * half, (b + 2) * half)
        shift = int(len(x)) + 2
        base = np.int64(2 * shift + int(max(map(len, self.items))) + 4)
        key = np.concatenate((item * base + lead, item * base + lead - 1))
        place = np.concatenate((place, place))
        code = key * np.int64(1 << 20) + place if max(map(len, self.items)) < 1 << 20 else None
        if code is not None and abs(int(key.max())) < 1 << 42 and abs(int(key.min())) < 1 << 42:
            key = np.unique(code) >> 20                # each of the item's q-grams counts once in a band
        bands, n = np.unique(key, return_counts=True)
        owner = np.floor_divide(bands + base // 2, base)
        at_band = bands - owner * base
        good = n >= self.need[owner]
        out: list[tuple[int, int, int]] = []
        for o, b in zip(owner[good].tolist(), at_band[good].tolist()):
            low, high = b * int(self.k[o] + 1), (b + 2) * int(self.k[o] + 1) - 1
            if out and out[-1][0] == o and low <= out[-1][2] + 1:
                out[-1] = (o, out[-1][1], high)
            else:
                out.append((o, low, high))
        return out


class Index:
    """A bounded list of (id, text) items, and the search of one text. Null and empty items are left out."""

    def __init__(self, items: list[tuple], q: int, edit_rate: float):
        kept = [(i, n) for i, n in ((i, normalize(t or "")) for i, t in items) if n]
        self.ids, self.strings = [i for i, _ in kept], [n for _, n in kept]
        self.items = [codes(n) for n in self.strings]
        sizes = [gram_size(len(x), q, edit_rate) for x in self.items]
        self.parts = []                              # (numbers of the items, their q-grams), the longest q first
        for size in sorted(set(sizes), reverse=True):
            of = [n for n, s in enumerate(sizes) if s == size]
            self.parts.append((of, Grams([self.items[n] for n in of], size, edit_rate)))

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) in characters of the normalised text; the best place of each kept region."""
        norm = normalize(text)
        x = codes(norm)
        out = []
        for of, grams in self.parts:
            for n, low, high in grams.bands(x):
                item, k, m = of[n], int(grams.k[n]), len(grams.items[n])
                exact = norm.find(self.strings[item], max(0, low), max(0, high + m))
                if exact >= 0:
                    out.append((item, exact, exact + m, 0))
                    continue
                start = max(0, low - k)
                window = x[start:high + k + m]
                hit = aligned(self.items[item], window, low - start, high - start, k)
                if hit:
                    out.append((item, start + hit[1], start + hit[2], hit[0]))
        return out


def item_blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> list[list[tuple]]:
    """The benchmark in blocks of about ``block_chars`` characters: each is small enough to send to every task."""
    used = items.select(item_id, text).filter(F.col(text).isNotNull())
    total = used.agg(F.sum(F.char_length(text))).first()[0] or 0
    n = -(-total // block_chars)
    block = F.pmod(F.xxhash64(item_id, text), F.lit(max(n, 1)))
    return [[tuple(r) for r in used.filter(block == b).collect()] for b in range(n)]


def contaminated(docs: DataFrame, items: DataFrame, q: int = 8, edit_rate: float = 0.1, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 block_chars: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, start, end, edits): where a benchmark item stands in a text, in characters of that text.

    One row for each region of a text that holds an item within its edit budget (regions closer than the budget are
    one). Null texts and null or empty items hold nothing; an item of any other length is searched, short ones with a
    smaller q, so leave out answers of a few characters that would stand in every text. Repeated rows and repeated items
    report each. Empty tables give no rows. Each block of items reads the texts once.
    """
    kind, item_kind = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, start int, end int, edits int"
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def search(block: list[tuple]) -> DataFrame:
        def setup():
            index = Index(block, q, edit_rate)

            def one(batch: pa.RecordBatch) -> pa.RecordBatch:
                row, out = [], []
                for i, t in enumerate(texts(batch.column("text"))):
                    hits = index.search(t)
                    if hits:
                        at = offsets(t)
                        row += [i] * len(hits)
                        out += [(index.ids[o], int(at[s]), int(at[e - 1]) + 1, c) for o, s, e, c in hits]
                cols = list(zip(*out)) if out else [[], [], [], []]
                ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [ids, pa.array(cols[0], id_type(item_kind)), *(pa.array(c, pa.int32()) for c in cols[1:])],
                    names=["doc_id", "item_id", "start", "end", "edits"])
            return one

        return map_slices(source, None, schema, setup)

    found = [search(b) for b in item_blocks(items, item_id, item_text, block_chars)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def id_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def decontaminate(docs: DataFrame, items: DataFrame, q: int = 8, edit_rate: float = 0.1, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_chars: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; nothing is shuffled. Null texts stay."""
    for block in item_blocks(items, item_id, item_text, block_chars):
        def setup(block=block):
            index = Index(block, q, edit_rate)
            return lambda batch: batch.filter(pa.array([not index.search(t) for t in texts(batch.column(text))], pa.bool_()))

        docs = map_slices(docs, None, docs.schema, setup)
    return docs


def op8_qgram_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: one row per place found."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
