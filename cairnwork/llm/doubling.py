"""Substring dedup by level-wise doubling over words.

Windows grow from a short length, at most doubling, to the wanted one (9, 18, 35 words). A round asks which windows of its
length stand in two places. Only the full windows whose part was repeated at one length are extended to the
next, and what does not repeat is never looked at again; the rounds end when no candidate survives or the wanted
length is reached, whose repeated windows cover the words to remove. Below the wanted length only one part of every full
window is asked for, that of least hash, which equal full windows place alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.llm import packed
from cairnwork.llm.textscan import SPACE, prefix, span_hash, spans, window_argmin
from cairnwork.plans.storage import cut

WINDOW = 35
#: The first level has this many words at least, and less than twice as many.
LEAST = 8


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = spans(~SPACE[data], offsets)
    return starts, ends, first, span_hash(prefix(data), starts, ends)


def levels(width: int, least: int = LEAST) -> list[int]:
    """Window lengths up to width, each at most twice the one before, the first below 2 * least."""
    out = [width]
    while out[0] >= 2 * least:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _full_windows(first: np.ndarray, n: int, width: int) -> np.ndarray:
    """Starts of the windows of width words that lie in one document."""
    start = np.arange(max(0, n - width + 1))
    return start[start + width <= np.repeat(first[1:], np.diff(first))[: len(start)]]


def _survivors(data: np.ndarray, offsets: np.ndarray, width: int, told: list[dict[int, np.ndarray]], buckets: list[int]) -> tuple[np.ndarray, tuple | None]:
    """Of a block: starts of the full windows that are repeated at all levels told so far, and the keys of the next level (None after the last)."""
    _, _, first, words = _words(data, offsets)
    sums, lengths = prefix(words), levels(width)
    start, gram = _full_windows(first, len(words), width), None
    for k, length in enumerate(lengths):
        if length < width:
            place = np.arange(max(0, len(words) - length + 1))
            grams = span_hash(sums, place, place + length)
            # a part that many windows choose at one place is one key; it is held more than once only if it stands at several
            picked, which = np.unique(window_argmin(grams, width - length + 1)[start], return_inverse=True)
            entries, bucket, of = packed.send_keys(grams[picked], grams[picked], buckets[k])
            sent, gram = (entries, bucket, of[which]), grams[picked][which]
        else:
            whole = span_hash(sums, start, start + width)
            # a part's hash chooses the bucket, the window's tells it apart there
            sent = packed.send_keys(whole, whole if gram is None else gram, buckets[k])
        if k == len(told):
            return start, sent
        _, bucket, of = sent
        alive = packed.spread(told[k], bucket)[of] > 0
        start, gram = start[alive], None if gram is None else gram[alive]
    return start, None


def _sent(number: int, entries: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    rows = [(number, b, entries[at].tobytes()) for b, at in packed.packs(bucket, entries)]
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["block", "bucket", "sent"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """key, n_words, n_removed, kept_sha256, kept (the words left, joined by a space), one row per document.

    A word goes if a window of width words over it also starts elsewhere, in this document or another; repeated
    rows and overlapping places count. Windows are judged on the input. Null and empty texts have no words, texts of fewer than
    width words no window. Windows are told apart by 64-bit hashes within buckets chosen by another hash.
    """
    table = packed.block_table(docs, key, text)
    lengths = levels(width)
    # the longer the first windows are, the fewer of them are asked for: about two in width - length + 2 words
    buckets = [packed.bucket_count(table, 0.2 if length < width else 0.5) for length in lengths]

    def told(batch: pa.RecordBatch, r: int, upto: int) -> list[dict[int, np.ndarray]]:
        return [packed.answers(batch, r, f"level{k}") for k in range(upto)]

    def asking(level: int):
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    _, (entries, bucket, _) = _survivors(*packed.opened(batch, r), width, told(batch, r, level), buckets)
                    yield _sent(batch["block"][r].as_py(), entries, bucket)

        return ask

    held = table
    for level in range(len(lengths)):
        got = cut(packed.answered(held.mapInArrow(asking(level), packed.PACK), lambda bucket: (packed.repeated, packed.KEY)), "level")
        held = packed.joined(held, got, f"level{level}")
        if not got.select(F.sum("hits")).first()[0]:
            break
    rounds = level + 1

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets = packed.opened(batch, r)
                # without candidates at a level there are none at the last
                start = _survivors(data, offsets, width, told(batch, r, rounds), buckets)[0] if rounds == len(lengths) else np.zeros(0, np.int64)
                starts, ends, doc, _ = _words(data, offsets)
                gone = packed.covered(start, width, len(starts))
                body, out = data.tobytes(), []
                for d, (a, b) in enumerate(zip(doc[:-1].tolist(), doc[1:].tolist())):
                    if gone[a:b].any():
                        left = a + np.flatnonzero(~gone[a:b])
                        kept = b" ".join([body[x:y] for x, y in zip(starts[left].tolist(), ends[left].tolist())])
                    else:
                        kept = b" ".join(body[offsets[d] : offsets[d + 1]].split())
                    out.append((b - a, int(gone[a:b].sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
                cols = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([batch["keys"][r].values, *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string())))], names=[key, "n_words", "n_removed", "kept_sha256", "kept"])

    return held.mapInArrow(finish, f"{key} long, n_words long, n_removed long, kept_sha256 string, kept string")
