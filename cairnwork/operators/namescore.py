"""Sort and set ratios of pairs of whole texts, exactly, with few copies of the texts and many pairs at once.

Both ratios follow from the sorted tokens alone. Documents are dealt by a hash into blocks, pairs into a task for each pair of blocks, and a task gets
each text that its pairs name once. Longest common subsequences are found for many pairs together, a bit for each character of one text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnwork.functions import text as X
from cairnwork.plans.storage import apart, bounded_batches, cut

#: Bytes of sorted texts in a block, pairs in a task, about; and the blocks of small tables, so that there are tasks enough.
BLOCK_BYTES, TASK_PAIRS, FEWEST = 24 << 20, 60_000, 8
#: Characters in a word of bits; the bit above them is the carry.
BITS = 63
#: Words of bits handled by one numpy call, about, words of all texts of a batch at most (each has 40 masks), and characters of its rows.
WORDS, HELD, ROWS = 6144, 1 << 15, 1 << 22
#: Characters of split texts and bytes of what pairs do not share that a task keeps, and partners of a text that are compared with it at once.
KEPT_CHARS, KEPT_BYTES, PARTNERS = 16 << 20, 64 << 20, 256

_MASK = np.uint64((1 << BITS) - 1)
_CODE = np.full(256, 37, np.uint8)
_CODE[[*range(97, 123), *range(48, 58), 32]] = np.arange(37)


def _in_band(a: list[bytes], b: list[bytes], down: int, right: int) -> np.ndarray:
    """Longest common subsequence of each a and b [a-z0-9 ]* over the alignments that never have over `down` more characters of a behind them than of b, nor `right` more of b; never too long.

    The bits of a word that are 0 are the columns where the length grows. At each turn every word of the band takes the next row, one row behind the word to its left.
    """
    n, rows, words = len(a), max(map(len, a)), max(1, -(-max(map(len, b)) // BITS))
    # a text that stands in several pairs has its masks once
    own = {x: k for k, x in enumerate(dict.fromkeys(b))}
    code = _CODE[np.frombuffer(b"".join(x.ljust(words * BITS, b"\0") for x in own), np.uint8)].reshape(len(own), words, BITS)
    column = np.arange(words)[:, None] * (39 * len(own))
    masks, slot = np.zeros(words * 39 * len(own), np.uint64), column + np.arange(len(own))
    for k in range(BITS):
        masks[slot + code[:, :, k].T.astype(np.int64) * len(own)] |= np.uint64(1 << k)
    base = column + np.array([own[x] for x in b])
    # past their ends texts of b have character 37 and texts of a 38, which meets nothing
    code = _CODE[np.frombuffer(b"".join(x.ljust(rows, b"\0") for x in a), np.uint8)].reshape(n, rows)
    code[code == 37] = 38
    back = np.ascontiguousarray(code[:, ::-1].T).astype(np.int64)
    back *= len(own)
    at = np.arange(words)
    begin, end = np.maximum(1, at * BITS + 1 - right) + at, np.minimum(rows, at * BITS + BITS + down) + at
    turns = np.arange(rows + words)
    first, after = np.searchsorted(end, turns).tolist(), np.searchsorted(begin, turns, "right").tolist()
    v, carry = np.full((words, n), _MASK), np.zeros((words + 1, n), np.uint64)
    place, m, x = np.empty((words, n), np.int64), np.empty((words, n), np.uint64), np.empty((words, n), np.uint64)
    for t in range(1, rows + words):
        i, j = first[t], after[t]
        if i >= j:
            continue
        own, u, s, p = v[i:j], m[: j - i], x[: j - i], place[: j - i]
        np.add(base[i:j], back[rows - t + i : rows - t + j], out=p)
        masks.take(p, out=u, mode="clip")
        np.bitwise_and(u, own, out=u)
        np.add(own, u, out=s)
        np.add(s, carry[i:j], out=s)
        np.right_shift(s, BITS, out=carry[i + 1 : j + 1])
        np.subtract(own, u, out=own)
        np.bitwise_or(own, s, out=own)
        np.bitwise_and(own, _MASK, out=own)
        carry[i] = 0  # of a word that has left the band
    return words * BITS - np.bitwise_count(v).sum(0, dtype=np.int64)


def _alone(a: bytes, b: bytes, down: int, right: int) -> int:
    """The same of one pair, its band a Python integer that moves on every so many rows."""
    data = np.frombuffer(b, np.uint8)
    masks = [0] * 256
    for c in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
        masks[c] = int.from_bytes(np.packbits(data == c, bitorder="little").tobytes(), "little")
    low = high = v = found = 0
    step = max(128, (down + right) // 3)
    for i in range(0, len(a), step):
        if (past := min(max(0, i - down), high) - low) > 0:
            found += past - (v & (1 << past) - 1).bit_count()
            v >>= past
            low += past
        to = min(len(b), i + step + right)
        if to > high:
            v |= ((1 << to - high) - 1) << high - low
            high = to
        full = (1 << high - low) - 1
        own = [x >> low & full if x else 0 for x in masks]
        for c in a[i : i + step]:
            u = v & own[c]
            v = (v + u) | (v - u)
        v &= full
    return found + high - low - v.bit_count()


def _active(size: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """Words of each pair that a turn handles."""
    return np.minimum(size[:, 1] // BITS + 1, 2 + aside.sum(1) // BITS)


def _batches(todo: np.ndarray, size: np.ndarray, aside: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Pairs of like lengths, both of them, and bands, and whether they are better met together."""
    active, i = _active(size, aside), 0
    while i < len(todo):
        # the first pair says how many there are; one that differs much ends the batch
        rows, words, wide = int(size[todo[i], 0]), int(size[todo[i], 1]) // BITS + 1, int(active[todo[i]])
        same = todo[i : i + max(1, min(WORDS // wide, HELD // words, ROWS // rows))]
        far = (active[same] > wide * 1.3 + 2) | (active[same] < wide * 0.7 - 2) | (size[same, 0] > rows * 1.3 + 16) | (size[same, 0] < rows * 0.7 - 16) | (size[same, 1] > size[same[0], 1] * 1.4 + BITS)
        if far.any():
            same = same[: int(far.argmax())]
        i += len(same)
        rows, words = (int(x) for x in size[same].max(0))
        wide = min(words // BITS + 1, 2 + int(aside[same].max(0).sum()) // BITS)
        # microseconds of a turn and of a word, and of a row and of a mask's character, as measured once
        together = (rows + words // BITS) * (13 + 0.0045 * wide * len(same)) + 0.01 * len(same) * words
        yield same, together < len(same) * (rows * (0.85 + 0.004 * wide) + 0.15 * words)


def lcs_lengths(pairs: list[tuple[bytes, bytes]], guess: np.ndarray) -> np.ndarray:
    """Longest common subsequence of each pair of texts [a-z0-9 ]*.

    A common subsequence of some length leaves so many characters of either text aside at most, which bounds the band. A guess sets the
    first band; if what is found is shorter, that sets the second, which is wide enough as it stands.
    """
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in pairs]
    size = np.array([(len(x), len(y)) for x, y in pairs], np.int64).reshape(-1, 2)
    bound, out = np.clip(guess, 0, size[:, 0]).astype(np.int64), np.zeros(len(pairs), np.int64)
    todo = np.flatnonzero(size[:, 0] > 0)
    while len(todo):
        aside = size - bound[:, None]
        kind = np.floor(3 * np.log2(np.column_stack([_active(size, aside) + 2, size[:, 0] + 32]))).astype(np.int64)
        todo = todo[np.lexsort((size[todo, 1], kind[todo, 1], kind[todo, 0]))]
        again = []
        for same, together in _batches(todo, size, aside):
            if together:
                down, right = (int(k) for k in np.maximum(1, aside[same].max(0)))
                got = _in_band([pairs[k][0] for k in same], [pairs[k][1] for k in same], down, right)
            else:
                got = np.array([_alone(*pairs[k], *np.maximum(1, aside[k]).tolist()) for k in same], np.int64)
            out[same] = got
            short = got < bound[same]
            bound[same[short]] = got[short]
            again.append(same[short])
        todo = np.concatenate(again)
    return out


def ratios(pairs: list[tuple[bytes, bytes, list[bytes], list[bytes], int]]) -> tuple[np.ndarray, np.ndarray]:
    """(sort ratio, set ratio) of (sorted text, sorted text, tokens of its own, of the other's own, length of the shared tokens)."""
    own = [tuple(b" ".join(sorted(o)) for o in p[2:4]) for p in pairs]
    size = np.array([(len(o[0]), len(o[1]), p[4]) for o, p in zip(own, pairs)], np.int64).reshape(-1, 3)
    least = [sum(n * (len(t) + 1) for t, n in (Counter(p[0].split()) & Counter(p[1].split())).items()) for p in pairs]
    some = np.flatnonzero((size[:, :2] > 0).all(1))
    return _ratios([p[:2] for p in pairs], np.array(least, np.int64), *size.T, some, [own[k] for k in some])


def _ratios(texts: list[tuple[bytes, bytes]], least: np.ndarray, one: np.ndarray, two: np.ndarray, base: np.ndarray, some: np.ndarray, own: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The same of sorted texts, of which so many characters are common at least, about, of the lengths of either's own tokens and the shared ones, and of the own tokens of some pairs, all that have them on both sides."""
    size = np.array([(len(x), len(y)) for x, y in texts], np.int64).reshape(-1, 2)
    # tokens that are common, each as often as in both, and little of the rest: a second band costs more than a wider first one
    common = lcs_lengths(texts, least + 0.1 * (size.min(1) - least))
    by_sort = np.where(size.sum(1) > 0, 200.0 * common / np.maximum(1, size.sum(1)), 100.0)
    common = np.zeros(len(texts), np.int64)
    common[some] = lcs_lengths(own, 0.5 * np.minimum(one, two)[some])
    # shared tokens stand first, so they are common, and so is the space behind them
    one, two = one + base + (base > 0), two + base + (base > 0)
    by_set = 200.0 * (common + base + (base > 0)) / np.maximum(1, one + two)
    for x in (one, two):
        by_set = np.maximum(by_set, 200.0 * base / np.maximum(1, base + x))
    whole = (base > 0) & ((one == base + 1) | (two == base + 1))
    return by_sort, np.where(whole, 100.0, np.where((one == 0) | (two == 0), 0.0, by_set))


def _sorted_texts(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(id, size, packed): the sorted tokens of each text, and their length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [b" ".join(sorted((x or "").encode().split())) for x in b.column(1).to_pylist()]
            made = [pa.array([len(x) for x in texts], pa.int64()), pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *made], names=["id", "size", "packed"])

    return bounded_batches(docs.select(F.col(id_col).cast("long").alias("id"), X.plain(text).alias("s")), 1 << 20).mapInArrow(pack, "id long, size long, packed binary")


class _Tokens:
    """Texts of a task as numbers of their distinct tokens, in order, with how often each stands there."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.name: list[bytes] = []
        self.texts: dict[int, tuple[bytes, np.ndarray, np.ndarray]] = {}
        self.width = self.times = self.place = np.zeros(0, np.int64)
        self.filled = 0

    def add(self, k: int, whole: bytes) -> None:
        count = Counter(whole.split())
        for t in count:
            if t not in self.number:
                self.number[t] = len(self.name)
                self.name.append(t)
        self.texts[k] = whole, np.array([self.number[t] for t in count], np.int64), np.array(list(count.values()), np.int64)

    def compare(self, a: int, others: list[int]) -> tuple:
        """Of a and each other: common characters at least, lengths of either's own and of the shared tokens; which have own tokens on both sides, and these."""
        if len(self.width) <= len(self.name):  # the last number is no token's
            self.width, self.times, self.place = (np.concatenate([x, np.zeros(1 + len(self.name), np.int64)]) for x in (self.width, self.times, self.place))
        self.width[self.filled : len(self.name)] = [len(t) + 1 for t in self.name[self.filled :]]
        self.filled = len(self.name)
        n, (_, mine, often) = len(others), self.texts[a]
        self.times[mine], self.place[mine] = often, np.arange(len(mine))
        size = np.array([len(self.texts[b][1]) for b in others])
        ids, counts = (np.concatenate([*(self.texts[b][k] for b in others), [last]]) for k, last in ((1, len(self.width) - 1), (2, 0)))
        pair, first = np.repeat(np.arange(n), size), np.cumsum(size) - size
        each = lambda x: np.where(size > 0, np.add.reduceat(x, first), 0)
        width, times = self.width[ids], self.times[ids]
        least, base, whole = each(np.minimum(times, counts) * width), each((times > 0) * width), each(width)
        one, two = self.width[mine].sum() - base, whole - base
        some = np.flatnonzero((one > 0) & (two > 0))
        # what is not shared, on either side
        hit = times[:-1] > 0
        apart = np.ones((n, len(mine)), bool)
        apart[pair[hit], self.place[ids[:-1][hit]]] = False
        left, right = (pair[~hit], ids[:-1][~hit]), np.nonzero(apart)
        right = right[0], mine[right[1]]
        self.times[mine] = 0
        own = []
        for k, x in (right, left):
            at, x = np.searchsorted(k, np.arange(n + 1)).tolist(), x.tolist()
            own.append([b" ".join([self.name[t] for t in x[at[m] : at[m + 1]]]) for m in some.tolist()])
        # each token was taken with a space behind it
        return least, *(np.maximum(0, x - 1) for x in (one, two, base)), some, list(zip(*own))


def _score(texts: pd.DataFrame, pairs: pd.DataFrame) -> Iterator[pd.DataFrame]:
    packed = {k: (n, x) for k, n, x in zip(texts["id"].tolist(), texts["size"].tolist(), texts["packed"])}
    tokens, rows, own = _Tokens(), [], []
    chars = held = n = 0

    def out() -> pd.DataFrame:
        a, b = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
        whole = {k: x[0] for k, x in tokens.texts.items()}
        numbers = [np.concatenate([r[k] for r in rows]) for k in range(2, 7)]
        by_sort, by_set = _ratios([(whole[x], whole[y]) for x, y in zip(a.tolist(), b.tolist())], *numbers, own)
        return pd.DataFrame({"a": a, "b": b, "strict": np.minimum(by_sort, by_set), "loose": np.maximum(by_sort, by_set)})

    pairs = pairs.sort_values(["a", "b"])
    a, b = pairs["a"].to_numpy(np.int64), pairs["b"].to_numpy(np.int64)
    turns = np.flatnonzero(np.diff(a, prepend=a[:1] - 1))
    for i, end in zip(turns.tolist(), [*turns[1:].tolist(), len(a)]):
        for j in range(i, end, PARTNERS):
            part = b[j : min(end, j + PARTNERS)]
            for k in (int(a[i]), *part.tolist()):
                if k not in tokens.texts:
                    size, x = packed[k]
                    chars += size
                    tokens.add(k, pa.decompress(x, decompressed_size=size, codec="zstd", asbytes=True))
            least, one, two, base, some, made = tokens.compare(int(a[i]), part.tolist())
            rows.append((np.full(len(part), a[i]), part, least, one, two, base, some + n))
            own += made
            n += len(part)
            held += 512 * len(part) + int((one + two)[some].sum())
            if held > KEPT_BYTES or chars > KEPT_CHARS:
                yield out()
                tokens, rows, own = _Tokens(), [], []
                chars = held = n = 0
    if rows:
        yield out()


def name_scores(docs: DataFrame, id_col: str, text: Column, pairs: DataFrame) -> DataFrame:
    """(a, b, strict, loose) of the pairs of ids a, b: the lesser and the greater of the sort and the set ratio of both whole texts in plain form.

    pairs are read several times. The driver sees their number and the size of the texts that they name.
    """
    each = pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    named = each.select("a").union(each.select("b")).distinct().withColumnRenamed("a", "id")
    texts = cut(_sorted_texts(docs.join(named.withColumnRenamed("id", id_col), id_col, "left_semi"), id_col, text), "sorted")
    size, n = texts.select(F.coalesce(F.sum("size"), F.lit(0))).first()[0], each.count()
    blocks = max(FEWEST, -(-size // BLOCK_BYTES), int((2 * n / TASK_PAIRS) ** 0.5) + 1)
    block = {c: F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("a", "b")}
    parts = blocks * (blocks + 1) // 2
    low, high = F.least(*block.values()), F.greatest(*block.values())
    task = (low * (2 * blocks - low - 1) / 2 + high).cast("int")  # from 0 to parts - 1
    dealt = each.select("a", "b", F.get(F.lit(apart(docs.sparkSession, parts)), task).cast("int").alias("task"))
    needs = dealt.select(F.explode(F.array("a", "b")).alias("id"), "task").groupBy("id").agg(F.collect_set("task").alias("tasks"))
    sent = texts.join(needs, "id").select(F.explode("tasks").alias("task"), "id", "size", "packed")

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(_score(left, right)) if len(right) else pd.DataFrame({"a": [], "b": [], "strict": [], "loose": []})

    grouped = [x.repartition(parts, "task").groupBy("task") for x in (sent, dealt)]
    return grouped[0].cogroup(grouped[1]).applyInPandas(score, "a long, b long, strict double, loose double")
