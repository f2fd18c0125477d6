"""Exact substring dedup by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every string of the wanted length (400 bytes) is placed by its anchor: the 288-byte gram of least hash in
it, which equal strings place alike. The strings of one anchor make one segment. Round one asks which anchors occur
elsewhere, and whether always in the same segment: then all its strings are repeated. The
segments of other repeated anchors meet in round two. There an anchor's gram, which all its segments share,
stands as one symbol, so a string of 400 bytes is one of 113 symbols, and for a bucket of segments

* the suffix array (prefix doubling) gives the Burrows-Wheeler transform;
* intervals are extended backward breadth first; the end of an interval first seen at depth l has a
  common prefix of l with what follows. Depths rise by one until 113;
* where no value was found, neighbours share 113 symbols or more: their strings are repeated.

An anchor with very many different segments is not gathered in one place: its strings go out one by one, each as one
symbol (depth 1), spread over all buckets.

Shorter repeats are reported, not removed: round one also asks which anchors of REPORT bytes (their 172-byte grams) occur
elsewhere. Any string of REPORT bytes that stands twice holds such an anchor, so a document has one if it shares a passage of that length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.llm import packed
from cairnwork.llm.textscan import prefix, span_hash, window_argmin
from cairnwork.plans.storage import cut

LENGTH = 400
#: Strings of this length that stand elsewhere too are reported: about fifty short words.
REPORT = 240
#: Different segments of an anchor (summed over blocks) beyond which its strings go out one by one.
HOT = 2000
#: Symbols of one transform, about.
BATCH = 1 << 19
CHUNK = 1 << 16
#: Working arrays take some hundred bytes for each byte of a block.
BLOCK_BYTES = 1 << 19


def gram_length(length: int) -> int:
    return max(1, length * 18 // 25)


def bounded_repeats(text: np.ndarray, depth: int) -> np.ndarray:
    """Which places of text start a string of depth symbols, without a negative symbol, that starts elsewhere too.

    Negative symbols are ends: each differs from all others, so no common prefix crosses one. The last must be one.
    """
    n = len(text)
    if n < 2:
        return np.zeros(n, bool)
    symbols, plain = np.unique(text, return_inverse=True)
    ends = np.flatnonzero(text < 0)
    symbol = plain.astype(np.int64) - np.searchsorted(symbols, 0)
    alphabet = len(symbols) - np.searchsorted(symbols, 0)
    symbol[ends] = alphabet + np.arange(len(ends))
    # suffix order by prefix doubling, up to at least depth symbols
    rank, reach = symbol, 1
    while reach < depth:
        after = np.zeros(n, np.int64)
        after[:-reach] = rank[reach:] + 1
        values, rank = np.unique(rank * (n + alphabet + 2) + after, return_inverse=True)
        reach *= 2
        if len(values) == n:
            break
    order = np.argsort(rank, kind="stable")
    before = symbol[order - 1]  # the transform; the first suffix is preceded by the last symbol
    by_symbol = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int64)
    forward[by_symbol] = np.arange(n)  # where each suffix lies after its preceding symbol is put before it
    real = before < alphabet
    common = np.full(n + 1, -1, np.int32)
    edges = np.searchsorted(symbol[order], np.arange(alphabet + 1))
    common[edges] = common[np.arange(edges[-1], n + 1)] = common[0] = 0
    tail = np.arange(edges[-1], n)  # every end is an interval of its own
    lo, hi = np.concatenate([edges[:-1], tail]), np.concatenate([edges[1:], tail + 1])
    for level in range(1, depth):
        size = hi - lo
        if not len(size):
            break
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
        kept = real[at]
        owner, at = owner[kept], at[kept]
        if len(owner) > len(lo):
            landed = np.lexsort((forward[at], owner))
            owner, at = owner[landed], at[landed]
        new, char = forward[at], before[at]
        first = np.ones(len(new), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (char[1:] != char[:-1])
        start = np.flatnonzero(first)
        stop = np.append(start[1:], len(new))
        lo, hi = new[start], new[stop - 1] + 1
        fresh = common[hi] < 0
        lo, hi = lo[fresh], hi[fresh]
        common[hi] = level
    shared = np.flatnonzero(common[1:n] < 0) + 1
    out = np.zeros(n, bool)
    out[order[shared]] = out[order[shared - 1]] = True
    return out


def _anchored(sums: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, place of its anchor) of every string of a block that lies in one document."""
    n, gram = len(sums) - 1, gram_length(length)
    width = length - gram + 1
    kind = np.int32 if n < 1 << 31 else np.int64
    ends = np.repeat(offsets[1:].astype(kind), np.diff(offsets))
    strings, anchors = [np.zeros(0, kind)], [np.zeros(0, kind)]
    for at in range(0, n - length + 1, CHUNK):
        upto = min(at + CHUNK, n - length + 1)
        place = np.arange(at, upto + width - 1)
        anchor = (at + window_argmin(span_hash(sums, place, place + gram), width)).astype(kind)
        start = np.arange(at, upto, dtype=kind)
        inside = start + length <= ends[at:upto]
        strings.append(start[inside])
        anchors.append(anchor[inside])
    return np.concatenate(strings), np.concatenate(anchors)


def units(sums: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of a block (its prefix sums): each anchor's place, first string, number of strings, gram hash, segment hash."""
    gram = gram_length(length)
    start, anchor = _anchored(sums, offsets, length)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(start)))
    p, s = anchor[at].astype(np.int64), start[at].astype(np.int64)
    return p, s, count, span_hash(sums, p, p + gram), span_hash(sums, s, s + count - 1 + length)


def short_anchors(sums: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, gram hash) of the different anchors of strings of length bytes."""
    anchor = _anchored(sums, offsets, length)[1]
    p = np.unique(anchor).astype(np.int64)
    return p, span_hash(sums, p, p + gram_length(length))


ANCHOR = np.dtype([("h", "<u8"), ("segment", "<u8"), ("kinds", "u1"), ("many", "u1")])
STRING = np.dtype([("h", "<u8"), ("s", "<u8"), ("many", "u1")])
ONCE, SAME, MIXED, CROWDED = range(4)


def _anchor_entries(h: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an entry for each distinct anchor, place of each unit's anchor among them)."""
    order = np.lexsort((segment, h))
    a, s = h[order], segment[order]
    new_a = np.ones(len(a), bool)
    new_a[1:] = a[1:] != a[:-1]
    new_s = new_a.copy()
    new_s[1:] |= s[1:] != s[:-1]
    which = np.cumsum(new_a) - 1
    entries = np.zeros(int(new_a.sum()), ANCHOR)
    entries["h"], entries["segment"] = a[new_a], s[new_a]
    entries["kinds"] = np.minimum(np.bincount(which, new_s, len(entries)), 255)
    entries["many"] = np.bincount(which, minlength=len(entries)) > 1
    place = np.empty(len(h), np.int64)
    place[order] = which
    return entries, place


def _judge_anchors(entries: np.ndarray, block: np.ndarray) -> np.ndarray:
    _, first, which, count = np.unique(entries["h"], return_index=True, return_inverse=True, return_counts=True)
    kinds = np.bincount(which, entries["kinds"])
    many = np.bincount(which, entries["many"]) > 0
    same = np.bincount(which, entries["segment"] != entries["segment"][first][which]) == 0
    code = np.where(same & (kinds == count), SAME, np.where(kinds > HOT, CROWDED, MIXED))
    return np.where((count > 1) | many, code, ONCE)[which]


def _write_segment(h: int, left: bytes, right: bytes, many: int) -> bytes:
    return b"%b%b%b%b%b" % (h.to_bytes(8, "little"), len(left).to_bytes(4, "little"), len(right).to_bytes(4, "little"), bytes([many]), left + right)


def _read_segments(sent: bytes) -> list[tuple[int, bytes, bytes, int]]:
    out, at = [], 0
    while at < len(sent):
        n, m = int.from_bytes(sent[at + 8 : at + 12], "little"), int.from_bytes(sent[at + 12 : at + 16], "little")
        body = at + 17
        out.append((int.from_bytes(sent[at : at + 8], "little"), sent[body : body + n], sent[body + n : body + n + m], sent[at + 16]))
        at = body + n + m
    return out


def judge_segments(entries: list[tuple[int, bytes, bytes, int]], width: int) -> list[np.ndarray]:
    """For each segment (anchor, bytes before and after its gram, held more than once): which of its strings are repeated."""
    held: dict[tuple[int, bytes, bytes], list[int]] = {}
    for i, (h, left, right, many) in enumerate(entries):
        got = held.setdefault((h, left, right), [0])
        got[0] += 1 + many
        got.append(i)
    out: list[np.ndarray | None] = [None] * len(entries)

    def settle(batch: list[tuple[int, bytes, bytes]]) -> None:
        symbols, parts, at = {}, [], []
        size = 0
        for h, left, right in batch:
            mark = symbols.setdefault(h, 256 + len(symbols))
            parts += [np.frombuffer(left, np.uint8).astype(np.int32), np.array([mark], np.int32), np.frombuffer(right, np.uint8).astype(np.int32), np.array([-1], np.int32)]
            at.append(size)
            size += len(left) + len(right) + 2
        found = bounded_repeats(np.concatenate(parts), width)
        for (h, left, right), start in zip(batch, at):
            count, *places = held[h, left, right]
            n = len(left) + len(right) + 2 - width
            flags = np.ones(n, bool) if count > 1 else found[start : start + n]
            for i in places:
                out[i] = flags

    batch, size, last = [], 0, None
    for key in sorted(held):
        if size > BATCH and key[0] != last:
            settle(batch)
            batch, size = [], 0
        batch.append(key)
        size += len(key[1]) + len(key[2]) + 2
        last = key[0]
    if batch:
        settle(batch)
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, report: int = REPORT) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, n_shared, kept (binary), one row per document.

    A byte goes if a string of length bytes over it also starts elsewhere, in this document or another; overlaps and
    repeated rows count, and strings are judged on the input. A null text is empty; a text shorter than length keeps all; an empty table gives an
    empty one, and columns of other names are not read. What is left may end in the middle of a character, so it is binary. Anchors and segments
    are told apart by 64-bit hashes, both of which must agree; segments that meet are compared byte by byte.

    n_shared counts the bytes under an anchor's gram (18/25 of `report` bytes) that stands elsewhere too. It is above 0 wherever a string of `report` bytes
    stands elsewhere too; a shorter one, down to the gram's length, may count.
    """
    table = packed.block_table(docs, key, text, BLOCK_BYTES)
    gram, width = gram_length(length), length - gram_length(length) + 1
    # a segment as Python objects takes some times its bytes, hence the many buckets of the second round
    n1 = packed.bucket_count(table, 18 * 2 / (width + 1))
    n2 = packed.bucket_count(table, 1.0)
    n3 = packed.bucket_count(table, 9 * 2 / (report - gram_length(report) + 2))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets = packed.opened(batch, r)
                sums = prefix(data)
                *_, h, segment = units(sums, offsets, length)
                entries, _ = _anchor_entries(h, segment)
                rows = [(b, entries[at].tobytes(), b"") for b, at in packed.packs((entries["h"] % np.uint64(n1)).astype(np.int64), entries)]
                grams = short_anchors(sums, offsets, report)[1]
                entries, bucket, _ = packed.send_keys(grams, grams, n3)
                yield _sent(batch["block"][r].as_py(), rows + [(n1 + b, entries[at].tobytes(), b"") for b, at in packed.packs(bucket, entries)])

    def judge(bucket: int):
        return (_judge_anchors, ANCHOR) if bucket < n1 else (packed.repeated, packed.KEY)

    asked = table.mapInArrow(first, SENT).select("block", "bucket", "sent")
    anchors = packed.answered(asked, judge)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets = packed.opened(batch, r)
                sums = prefix(data)
                p, s, count, h, segment = units(sums, offsets, length)
                entries, of = _anchor_entries(h, segment)
                got = packed.answers(batch, r)
                code = packed.spread(got, (entries["h"] % np.uint64(n1)).astype(np.int64))[of]
                place, grams = short_anchors(sums, offsets, report)
                _, bucket, of = packed.send_keys(grams, grams, n3)
                again = place[packed.spread(got, bucket + n1)[of] > 0].astype(np.int32)
                shared = [(SHARED, b"", again.tobytes())] if len(again) else []
                yield _sent(batch["block"][r].as_py(), _asked_segments(data, sums, p, s, count, h, segment, code, length, n2) + shared)

    asked = cut(packed.joined(table, anchors).mapInArrow(second, SENT), "segments")

    def reply(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        t = t.combine_chunks().sort_by("block")
        sent, got = t["sent"].to_pylist(), []
        if bucket >= n2:  # strings that go out one by one
            each = [np.frombuffer(x, STRING) for x in sent]
            both = np.concatenate(each)
            _, which, count = np.unique(both[["h", "s"]], return_inverse=True, return_counts=True)
            twice = (count > 1) | (np.bincount(which, both["many"]) > 0)
            flags = twice[which].astype(np.uint8)
            ends = np.cumsum([0, *map(len, each)])
            got = [flags[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        else:
            each = [_read_segments(x) for x in sent]
            flags = judge_segments([e for x in each for e in x], width)
            ends = np.cumsum([0, *map(len, each)])
            got = [np.packbits(np.concatenate(flags[a:b])).tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"block": t["block"], "bucket": t["bucket"], "got": pa.array(got, pa.binary())})

    # the transform is the heaviest step: its tasks are as many as there are partitions, not as few as its small input would make them
    parts = min(2 * n2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    replies = asked.where("bucket >= 0").select("block", "bucket", "sent").repartition(parts, "bucket").groupBy("bucket").applyInArrow(reply, "block long, bucket long, got binary")
    replies = cut(replies, "replies").withColumnRenamed("got", "blob").withColumn("kind", F.lit(1))
    local = asked.select("block", "bucket", F.col("local").alias("blob"), F.lit(0).alias("kind"))
    facts = local.unionByName(replies).select("block", "bucket", "kind", "blob")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets = packed.opened(batch, r)
                facts = batch["answers"][r].as_py() or []
                again = [np.frombuffer(f["blob"], np.int32).astype(np.int64) for f in facts if f["kind"] == 0 and f["bucket"] == SHARED]
                shared = packed.covered(again[0], gram_length(report), len(data)) if again else np.zeros(len(data), bool)
                gone = _gone(len(data), [f for f in facts if f["bucket"] != SHARED], length, n2)
                rows = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = gone[a:b]
                    kept = data[a:b][~own].tobytes()
                    rows.append((b - a, int(own.sum()), int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()), hashlib.sha256(kept).hexdigest(), int(shared[a:b].sum()), kept))
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([batch["keys"][r].values, *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())))], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", "kept"])

    return packed.joined(table, facts).mapInArrow(finish, f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long, kept binary")


SENT = "block long, bucket long, sent binary, local binary"
#: Buckets below 0 are never sent: strings always in one segment (-1), places of the shorter anchors that stand elsewhere too.
SHARED = -2


def _sent(number: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["block", "bucket", "sent", "local"])


def _asked_segments(data: np.ndarray, sums: np.ndarray, p: np.ndarray, s: np.ndarray, count: np.ndarray, h: np.ndarray, segment: np.ndarray, code: np.ndarray, length: int, n2: int) -> list[tuple[int, bytes, bytes]]:
    """Rows of the second round. `local` keeps what each entry stands for: (entry, first string, strings) of each occurrence."""
    gram = gram_length(length)
    rows = []
    same = code == SAME
    if same.any():
        rows.append((-1, b"", np.stack([np.zeros(same.sum(), np.int64), s[same], count[same]], 1).astype(np.int32).tobytes()))
    mixed = np.flatnonzero(code == MIXED)
    if len(mixed):
        # one entry for each different (anchor, segment)
        pair = np.empty(len(mixed), np.dtype([("h", "<u8"), ("s", "<u8")]))
        pair["h"], pair["s"] = h[mixed], segment[mixed]
        _, first, which, many = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        body = data.tobytes()
        for b, at in packed.packs(((pair["h"][first] >> np.uint64(7)) % np.uint64(n2)).astype(np.int64), first):
            number = np.full(len(first), -1)
            number[at] = np.arange(len(at))
            own = np.flatnonzero(number[which] >= 0)
            sent = []
            for u, m in zip(mixed[first[at]].tolist(), many[at].tolist()):
                sent.append(_write_segment(int(h[u]), body[s[u] : p[u]], body[p[u] + gram : s[u] + count[u] - 1 + length], int(m > 1)))
            rows.append((b, b"".join(sent), np.stack([number[which[own]], s[mixed[own]], count[mixed[own]]], 1).astype(np.int32).tobytes()))
    crowded = np.flatnonzero(code == CROWDED)
    if len(crowded):
        n = count[crowded]
        start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s[crowded], n)
        pair = np.empty(len(start), np.dtype([("h", "<u8"), ("s", "<u8")]))
        pair["h"], pair["s"] = np.repeat(h[crowded], n), span_hash(sums, start, start + length)
        uniq, which, many = np.unique(pair, return_inverse=True, return_counts=True)
        entries = np.zeros(len(uniq), STRING)
        entries["h"], entries["s"], entries["many"] = uniq["h"], uniq["s"], many > 1
        for b, at in packed.packs(((uniq["s"] >> np.uint64(7)) % np.uint64(n2)).astype(np.int64), uniq):
            number = np.full(len(uniq), -1)
            number[at] = np.arange(len(at))
            own = np.flatnonzero(number[which] >= 0)
            rows.append((n2 + b, entries[at].tobytes(), np.stack([number[which[own]], start[own], np.ones(len(own), np.int64)], 1).astype(np.int32).tobytes()))
    return rows


def _gone(n: int, facts: list[dict], length: int, n2: int) -> np.ndarray:
    """Which of the n bytes of a block go."""
    edge = np.zeros(n + 1, np.int64)
    told = {f["bucket"]: f["blob"] for f in facts if f["kind"] == 1}
    for f in facts:
        if f["kind"]:
            continue
        entry, start, count = np.frombuffer(f["blob"], np.int32).reshape(-1, 3).T.astype(np.int64)
        if f["bucket"] == -1:
            np.add.at(edge, start, 1)
            np.add.at(edge, start + count - 1 + length, -1)
            continue
        if f["bucket"] >= n2:
            starts = start[np.frombuffer(told[f["bucket"]], np.uint8)[entry] > 0]
        else:
            flags = np.unpackbits(np.frombuffer(told[f["bucket"]], np.uint8)).astype(bool)
            sizes = np.zeros(entry.max() + 1, np.int64)
            sizes[entry] = count
            base = np.cumsum(sizes) - sizes
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            starts = (np.repeat(start, count) + step)[flags[np.repeat(base[entry], count) + step]]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:n]) > 0
