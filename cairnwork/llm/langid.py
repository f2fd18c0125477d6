"""Language ID with error-correcting output codes.

Each language has a codeword; a binary classifier over hashed byte trigrams predicts each bit. The
losses of the bits, each weighted by how well its classifier did on labelled rows that it was not fitted on, are summed for every
codeword and the nearest codeword names the language. Little distance between the best two flags a text as ambiguous.

Reading a text is one pass: every letter's byte with its two neighbours (digits, punctuation and white
space count as one mark) picks a row of weights, and a text's margins are the mean of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnwork.llm.textscan import LOWER, blocks
from cairnwork.plans.storage import bounded_batches, local_table

BUCKETS = 1 << 12
#: Labelled rows that the classifiers are fitted on, about, for each language. This bounds what the driver gathers.
ROWS_PER_LANG = 500
#: Share of the loss range by which the best two codewords must differ.
MARGIN = 0.02
UNKNOWN = "und"
#: Text scored at once: a letter takes some hundred bytes of working memory.
BLOCK_BYTES = 1 << 18

#: Letters' bytes in lower case, all else as one mark.
_FOLD = LOWER.copy()
_FOLD[:0x61] = np.where((_FOLD[:0x61] >= 0x61), _FOLD[:0x61], 0x20)
_FOLD[0x7B:0x80] = 0x20


def codewords(n: int) -> np.ndarray:
    """n distinct codewords of +1 and -1: all splits of up to five languages, else well separated random ones."""
    if n <= 2:
        return np.array([[1.0], [-1.0]])[:n]
    if n <= 5:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[1.0 if i == 0 or not s >> (i - 1) & 1 else -1.0 for s in splits] for i in range(n)])
    bits = max(15, int(np.ceil(10 * np.log2(n))))
    best, apart = None, -1
    for seed in range(40):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        gap = min((code[i + 1 :] != code[i]).sum(1).min() for i in range(n - 1))
        if gap > apart and (np.abs(code.sum(0)) < n).all():
            best, apart = code, gap
    return best


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram around each byte, whether the byte is a letter's); a text's ends count as marks."""
    folded = _FOLD[data]
    before, after = np.full(len(data), 0x20, np.uint32), np.full(len(data), 0x20, np.uint32)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    inner = offsets[1:-1]
    before[inner[inner < len(data)]] = 0x20
    after[inner[inner > 0] - 1] = 0x20
    h = (before << np.uint32(16)) | (folded.astype(np.uint32) << np.uint32(8)) | after
    h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return h, folded != 0x20


def _has_letter(column: pa.Array, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Whether a text has a letter: surely if a byte a-z was seen; the texts whose only candidates are other scripts are looked at."""
    for i in rows:
        text = column[int(i)].as_py()
        found[i] = any(map(str.isalpha, text))
    return found


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # (buckets + 1) x bits; the last row is zero
    bias: np.ndarray
    trust: np.ndarray  # a weight for each bit

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score from 0 to 1, ambiguous) for rows of margins."""
        loss = np.maximum(0, 1 - margins[:, None, :] * self.code[None]) @ self.trust
        order = np.argsort(loss, axis=1, kind="stable")
        odds = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
        score = 1 / odds.sum(1)
        if len(self.langs) == 1:
            return order[:, 0], score, np.zeros(len(loss), bool)
        rows = np.arange(len(loss))
        return order[:, 0], score, loss[rows, order[:, 1]] - loss[rows, order[:, 0]] < 2 * MARGIN


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, _, data, offsets in blocks(batch["text"], BLOCK_BYTES):
            h, letter = trigrams(data, offsets)
            for a, b in zip(offsets[:-1], offsets[1:]):
                counts = np.bincount(h[a:b][letter[a:b]], minlength=BUCKETS)
                rows.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_pydict({"lang": batch["lang"].cast(pa.string()), "v": pa.array(rows, pa.binary())})


def _stacked(got: list[tuple[str, bytes]], chosen: np.ndarray) -> np.ndarray:
    out = np.empty((int(chosen.sum()), BUCKETS))
    for i, row in enumerate(np.flatnonzero(chosen)):
        out[i] = np.frombuffer(got[row][1], np.float32)
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_lang: int = ROWS_PER_LANG) -> Model | None:
    """Classifiers from the labelled rows: about rows_per_lang of each language, chosen by a hash of the key. None without rows.

    Only hashed trigram shares of the chosen rows reach the driver: 16 KB a row. A quarter of them is kept from fitting and weighs the bits.
    Null texts and languages are left out, empty texts count, repeated rows count each, texts are read whole; other columns are not read.
    """
    rows = bounded_batches(labelled).where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)).alias("draw"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    share = local_table(labelled.sparkSession, {"lang": pa.string(), "below": pa.int64()}, [(x, int(min(1.0, rows_per_lang / n) * (1 << 30))) for x, n in sizes.items()])
    # batches of whole texts are turned into vectors on the executors
    chosen = rows.join(F.broadcast(share), "lang").where("draw < below").select("lang", "text")
    got = sorted(tuple(r) for r in chosen.mapInArrow(_counts, "lang string, v binary").collect())
    langs = sorted({x for x, _ in got})
    code = codewords(len(langs))
    y = code[[langs.index(name) for name, _ in got]]
    if len(langs) == 1:
        return Model(langs, code, np.zeros((BUCKETS + 1, 1), np.float32), np.ones(1), np.ones(1))
    # every fourth row of a language judges the classifiers, the others fit them
    rank = np.concatenate([np.arange(sum(1 for x_, _ in got if x_ == name)) for name in langs])
    apart = rank % 4 == 3
    if not apart.any():
        apart[:] = True
    fitted = ~apart | apart.all()
    # the gathered vectors are copied once, into the halves, and go; the rest is done in place, as the driver has little room
    judged_x, judged_y = _stacked(got, apart), y[apart]
    x, y = _stacked(got, fitted), y[fitted]
    del got
    mean, bias = x.mean(0), y.mean(0)
    x -= mean
    kernel = x @ x.T
    kernel[np.diag_indices_from(kernel)] += 1e-2 * np.trace(kernel) / len(kernel) + 1e-12
    weights = x.T @ np.linalg.solve(kernel, y - bias)
    bias = bias - mean @ weights
    # log-odds of being right, from counts that never reach 0 or all
    right = ((np.sign(judged_x @ weights + bias) == judged_y).sum(0) + 0.5) / (len(judged_y) + 1)
    trust = np.maximum(np.log(right / (1 - right)), 1e-3)
    return Model(langs, code, np.vstack([weights, np.zeros((1, weights.shape[1]))]).astype(np.float32), bias, trust / trust.sum())


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with `lang_pred` (a learned language, or `und` for a null text and one without letters), `score`, `ambiguous`.

    Columns of these names are replaced. Without a model every text is `und` with score 0. Whole texts are read,
    of any length; repeated rows are judged alike; an empty table stays empty.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, n = batch[text], batch.num_rows
            sums, seen, letters = np.zeros((n, model.weights.shape[1] if model else 1)), np.zeros(n), np.zeros(n, bool)
            for first, after, data, offsets in blocks(column, BLOCK_BYTES):
                h, letter = trigrams(data, offsets)
                place = np.repeat(np.arange(after - first), np.diff(offsets))[letter]
                seen[first:after] = np.bincount(place, minlength=after - first)
                plain = letter & (data < 0x80)
                letters[first:after] = np.bincount(np.repeat(np.arange(after - first), np.diff(offsets))[plain], minlength=after - first) > 0
                if model:
                    rows = model.weights[h[letter]]
                    ends = np.searchsorted(np.flatnonzero(letter), offsets)
                    total = np.vstack([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
                    sums[first:after] = total[ends[1:]] - total[ends[:-1]]
            letters = _has_letter(column, np.flatnonzero(~letters & (seen > 0)), letters)
            out, score, vague = np.full(n, UNKNOWN, object), np.zeros(n), ~letters
            if model and letters.any():
                best, s, v = model.decode(sums[letters] / seen[letters][:, None] + model.bias)
                out[letters], score[letters], vague[letters] = np.array(model.langs, object)[best], s, v
            made = [pa.array(out, pa.string()), pa.array(score), pa.array(vague)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "lang_pred", "score", "ambiguous"])

    return bounded_batches(docs).mapInArrow(judged, schema)


def held_out(key: str = "doc_id"):
    """The rows that are never learned from: crc32 of the key as text, mod 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
