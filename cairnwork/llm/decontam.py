"""Benchmark decontamination with a document-sharded positional inverted index.

A block of documents is an index shard: for every term in it, the sorted positions at which it stands. The index knows nothing of a
benchmark: it is built and stored once and answers any number of them. Counts of a benchmark's terms over all shards say which of
them are rare. A phrase is looked up from its rarest term: its postings, moved by the term's offset, are candidate starts, and the
other terms' postings are intersected with them in order of rarity. Proximity search takes, around each posting of the rarest
term, the nearest postings of the others.

The benchmark's windows go to all executors. Their size is checked first (MAX_WINDOWS); a larger benchmark is
searched in several passes over the same stored shards, so that no pass sends more than that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.llm.textscan import ALNUM, LOWER, blocks, prefix, raw, span_hash, spans
from cairnwork.plans.storage import bounded_batches, cut

WINDOW = 10
#: Windows that one pass sends to the executors: 10 terms and an item list each, some hundred MB at most.
MAX_WINDOWS = 500_000
#: Positions left free between documents, so that no phrase or proximity match crosses them.
GAP = 1 << 12


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the first word of each row)."""
    low = LOWER[data]
    starts, ends, first = spans(ALNUM[low], offsets)
    return span_hash(prefix(low), starts, ends), first


@dataclass
class Windows:
    """Distinct phrases of the benchmark (rows of term numbers, padded with -1) and the items that hold each."""

    vocab: np.ndarray  # sorted hashes; a term's number is its place
    terms: np.ndarray
    sizes: np.ndarray
    items: list[np.ndarray]  # of each window
    names: list[str]  # item ids as text


def windows_of(items: list[tuple[object, str | None]], width: int = WINDOW) -> Windows:
    """All runs of width words of an item; one run of all its words if it has fewer; none without words."""
    seen: dict[tuple[int, ...], set[int]] = {}
    names = [str(i) for i, _ in items]
    data, offsets = raw(pa.array([t for _, t in items], pa.large_string()))
    h, first = words_of(data, offsets)
    vocab = np.unique(h)
    number = np.searchsorted(vocab, h)
    for row in range(len(items)):
        own = tuple(number[first[row] : first[row + 1]].tolist())
        for at in range(max(1, len(own) - width + 1)) if own else ():
            seen.setdefault(own[at : at + width], set()).add(row)
    terms = np.full((len(seen), width), -1, np.int64)
    for i, w in enumerate(seen):
        terms[i, : len(w)] = w
    return Windows(vocab, terms, (terms >= 0).sum(1), [np.array(sorted(s)) for s in seen.values()], names)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per shard: its number, keys (of any type) and word counts of its documents, and its terms (hashes, sorted) with the count and the positions of each."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for a, b, data, offsets in blocks(batch[text]):
                h, first = words_of(data, offsets)
                position = np.arange(len(h)) + GAP * np.repeat(np.arange(b - a), np.diff(first))
                order = np.argsort(h, kind="stable")
                terms, counts = np.unique(h[order], return_counts=True)
                cells = {"n_words": np.diff(first).astype(np.int64), "terms": terms, "counts": counts.astype(np.int32), "postings": position[order].astype(np.int32)}
                yield pa.RecordBatch.from_pydict({"shard": pa.array([next(numbers)], pa.int64()), "keys": pa.array([batch[key][a:b].to_pylist()], pa.list_(batch[key].type)), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in cells.items()}})

    kind = docs.select(key).schema[0].dataType.simpleString()
    return bounded_batches(docs).select(key, text).mapInArrow(shard, f"shard long, keys array<{kind}>, n_words binary, terms binary, counts binary, postings binary")


def term_counts(index: DataFrame, vocab: np.ndarray) -> np.ndarray:
    """How often each term of vocab (sorted hashes) stands in all shards; the sum of one vector per task reaches the driver, a term a row."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                at, there = _places(np.frombuffer(batch["terms"][r].as_buffer(), np.uint64), vocab)
                total[there] += np.frombuffer(batch["counts"][r].as_buffer(), np.int32)[at[there]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held), "n": pa.array(total[held])})

    out = np.zeros(len(vocab), np.int64)
    for r in index.select("terms", "counts").mapInArrow(summed, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def _places(terms: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each term of vocab in terms, whether it is there); both sorted."""
    at = np.searchsorted(terms, vocab)
    at[at == len(terms)] = 0
    return at, terms[at] == vocab if len(terms) else np.zeros(len(vocab), bool)


class Shard:
    """The postings of a stored shard, its terms numbered by a vocabulary."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, n_words: np.ndarray, vocab: np.ndarray) -> None:
        at, there = _places(terms, vocab)
        ends = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
        number = np.flatnonzero(there)
        n = np.zeros(len(vocab), np.int64)
        n[number] = counts[at[number]]
        # the vocabulary's postings alone, in its order
        self.ends = np.concatenate([[0], np.cumsum(n)])
        own = np.arange(self.ends[-1]) - np.repeat(self.ends[:-1], n) + np.repeat(np.where(there, ends[:-1][at] if len(terms) else 0, 0), n)
        self.postings = postings[own].astype(np.int64)
        # documents' first positions
        self.first = np.concatenate([[0], np.cumsum(n_words)]) + GAP * np.arange(len(n_words) + 1)
        # one sorted array of (term, position): any list can be intersected with it at once
        self.span = int(self.first[-1]) + 1
        self.keyed = np.repeat(np.arange(len(vocab)), n) * self.span + self.postings

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of the postings of each term; an empty range without any."""
        return self.ends[terms], self.ends[terms + 1]

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        want = terms * self.span + positions
        at = np.searchsorted(self.keyed, want)
        return (self.keyed[np.minimum(at, len(self.keyed) - 1)] == want) & (positions >= 0) if len(self.keyed) else np.zeros(len(want), bool)

    def phrases(self, terms: np.ndarray, by_rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all exact matches. by_rarity: places of each window's terms, the rarest first."""
        rows = np.arange(len(terms))
        lo, hi = self.lists(terms[rows, by_rarity[:, 0]])
        n = hi - lo
        window = np.repeat(rows, n)
        start = self.postings[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)] - by_rarity[window, 0] if n.sum() else np.zeros(0, np.int64)
        for k in range(1, terms.shape[1]):
            place = by_rarity[window, k]
            term = terms[window, place]
            kept = (term < 0) | self.has(term, start + place)
            window, start = window[kept], start[kept]
        return window, start

    def near(self, terms: list[int], slop: int) -> np.ndarray:
        """Positions of the first (rarest) term that have each other term within slop words, in the same document."""
        spots = [self.postings[slice(*map(int, (a[0], b[0])))] for t in terms for a, b in [self.lists(np.array([t]))]]
        out = spots[0]
        for other in spots[1:]:
            padded = np.concatenate([[-(1 << 40)], other, [1 << 40]])
            at = np.searchsorted(padded, out)
            out = out[(np.minimum(padded[at] - out, out - padded[at - 1])) <= min(slop, GAP - 1)]
        return out


def _shards(batch: pa.RecordBatch, vocab: np.ndarray) -> Iterator[tuple[int, list, np.ndarray, Shard]]:
    for r in range(batch.num_rows):
        n_words, terms, counts, postings = (np.frombuffer(batch[c][r].as_buffer(), kind) for c, kind in (("n_words", np.int64), ("terms", np.uint64), ("counts", np.int32), ("postings", np.int32)))
        yield batch["shard"][r].as_py(), batch["keys"][r].as_py(), n_words, Shard(terms, counts, postings, n_words, vocab)


def _rarity(terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of each window's terms, by their counts; what pads a shorter window comes last."""
    weight = np.where(terms >= 0, counts[np.maximum(terms, 0)], np.iinfo(np.int64).max)
    return np.argsort(weight, axis=1, kind="stable")


def match(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """A row per document: key, n_words, n_hit (words inside any occurrence of a window), n_items, items_sha256, contaminated.

    Null texts have no words; null item ids and item texts give no window. An empty benchmark hits nothing, an empty table of documents gives
    an empty one. Repeated rows and rows that share a key are each judged; texts are read whole, and columns of other names are not read.
    Words are told apart by 64-bit hashes.
    """
    return match_index(cut(build_index(docs, key, text), "index"), benchmark, key, item, item_text, width)


def _passes(benchmark: DataFrame, item: str, item_text: str) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in parts of at most MAX_WINDOWS windows, or one item."""
    part, held = [], 0
    for r in benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(item, item_text).toLocalIterator():
        most = len(r[1]) // 2 + 1
        if part and held + most > MAX_WINDOWS:
            yield part
            part, held = [], 0
        part.append((r[0], r[1]))
        held += most
    yield part


def match_index(index: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """match over a stored index. The driver holds one pass of the benchmark at a time."""
    hits, last, kind = [], None, _kind(index)
    schema = f"shard long, {key} {kind}, place long, n_words long, hit array<long>, items array<string>"
    for part in _passes(benchmark, item, item_text):
        if last is not None:
            hits.append(cut(index.mapInArrow(last, schema), "hits"))
        windows = windows_of(part, width)
        last = _match_pass(windows, term_counts(index, windows.vocab), key)
    counted = _counted(key)
    if not hits:
        # one operator: two would have a Python process each in every task, and those stay
        return index.mapInArrow(lambda batches: counted(last(batches)), FACTS.format(key=key, kind=kind))
    both = index.mapInArrow(last, schema)
    for more in hits:
        both = both.unionByName(more)
    # the same row of a stored shard has one row a pass, whatever its key is
    merged = both.groupBy("shard", "place").agg(F.first(key).alias(key), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hit")).alias("hit"), F.flatten(F.collect_list("items")).alias("items"))
    return merged.mapInArrow(counted, FACTS.format(key=key, kind=kind))


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
FACTS = "{key} {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _match_pass(windows: Windows, counts: np.ndarray, key: str) -> Batches:
    """shard, place, key, n_words, hit (ranges of words as from, to, from, to ..), items."""
    order = _rarity(windows.terms, counts)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at_shard, keys, n_words, shard in _shards(batch, windows.vocab):
                window, start = shard.phrases(windows.terms, order)
                doc = np.searchsorted(shard.first, start, "right") - 1
                by_doc = np.argsort(doc, kind="stable")
                ends = np.searchsorted(doc[by_doc], np.arange(len(keys) + 1))
                hit, items = [], []
                for d in range(len(keys)):
                    own = by_doc[ends[d] : ends[d + 1]]
                    at = start[own] - shard.first[d]
                    hit.append(np.stack([at, at + windows.sizes[window[own]]], 1).ravel())
                    items.append([windows.names[i] for i in np.unique(np.concatenate([windows.items[w] for w in np.unique(window[own])]))] if len(own) else [])
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([at_shard] * len(keys), pa.int64()), key: pa.array(keys, batch.schema.field("keys").type.value_type), "place": pa.array(np.arange(len(keys))), "n_words": pa.array(n_words),
                    "hit": pa.array(hit, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string())),
                })

    return found


def _kind(index: DataFrame) -> str:
    """Type of the keys of an index."""
    return index.schema["keys"].dataType.elementType.simpleString()


def _counted(key: str) -> Batches:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, digest = [], [], []
            for hit, items in zip(batch["hit"], batch["items"].to_pylist()):
                ends = np.asarray(hit.values).astype(np.int64).reshape(-1, 2)
                ends = ends[np.argsort(ends[:, 0], kind="stable")]
                reach = np.maximum.accumulate(ends[:, 1]) if len(ends) else ends[:, 1]
                n_hit.append(int((reach - np.maximum(ends[:, 0], np.concatenate([[0], reach[:-1]]) if len(ends) else ends[:, 0])).clip(0).sum()))
                unique = sorted(set(items))
                n_items.append(len(unique))
                digest.append(hashlib.sha256(",".join(unique).encode()).hexdigest())
            yield pa.RecordBatch.from_pydict({key: batch[key], "n_words": batch["n_words"], "n_hit": pa.array(n_hit, pa.int64()), "n_items": pa.array(n_items, pa.int64()), "items_sha256": pa.array(digest, pa.string()), "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_())})

    return counted


def proximity(docs: DataFrame, phrase: str, slop: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, position): words of docs where the phrase's rarest term stands with all its other terms at most slop words away."""
    return proximity_index(cut(build_index(docs, key, text), "index"), phrase, slop, key)


def proximity_index(index: DataFrame, phrase: str, slop: int, key: str = "doc_id") -> DataFrame:
    """proximity over a stored index."""
    data, offsets = raw(pa.array([phrase], pa.large_string()))
    vocab = np.unique(words_of(data, offsets)[0])
    terms = np.argsort(term_counts(index, vocab), kind="stable").tolist()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, keys, _, shard in _shards(batch, vocab):
                at = shard.near(terms, slop) if terms else np.zeros(0, np.int64)
                doc = np.searchsorted(shard.first, at, "right") - 1
                yield pa.RecordBatch.from_pydict({key: pa.array([keys[d] for d in doc], batch.schema.field("keys").type.value_type), "position": pa.array(at - shard.first[doc])})

    return index.mapInArrow(found, f"{key} {_kind(index)}, position long")
