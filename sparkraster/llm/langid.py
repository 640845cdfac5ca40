"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit, linear over hashed
byte n-grams of the whole text, predicts that bit; decoding adds up the losses of
all bits against each codeword and takes the nearest, flagging texts whose two
nearest codewords lie close together.

The classifiers are fitted by ridge regression on a bounded sample: ``SAMPLE``
labelled rows at most in expectation, the same number of each language, chosen by
a hash of the id. Counting rows per language and predicting cover every row.

Cases: null text, or text without a letter, is ``und`` with score 0 and not
ambiguous; null labels and labelled texts without letters aren't learned from;
without any labelled row all is ``und``, with one language every text is that one
with score 1; ties go to the first language by code point; null ids count as
training rows with the hash of nothing; an empty table gives an empty result; input
columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, random_words, slices, text_bytes, tidy

#: Hashed features, rows to fit on, rows of one language to fit on at most.
FEATURES, SAMPLE, PER_LANGUAGE = 2048, 4000, 400
#: Weight of the ridge penalty.
PENALTY = 0.05
#: Mean loss per bit by which the second codeword must lie farther off than the nearest.
CLOSE = 0.02
BLOCK = 2_000_000
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass
class Model:
    """Languages, their codewords (languages x bits), and the bits' weights (features + 1 x bits)."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """Codewords of +1 and -1: every split of few languages, else the most distant of some random codes."""
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 7:
        bits = [[1] + [1 if split >> i & 1 else -1 for i in range(n - 1)] for split in range(2 ** (n - 1) - 1)]
        return np.array(bits, np.float32).T
    rng, width, best, apart = np.random.default_rng(seed), int(np.ceil(15 * np.log2(n))), None, -1
    for _ in range(50):
        codes = rng.choice([-1.0, 1.0], (n, width)).astype(np.float32)
        distance = (width - codes @ codes.T) / 2 + np.eye(n) * width
        if distance.min() > apart:
            best, apart = codes, distance.min()
    return best


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the n-gram shares of each text: byte pairs and triples, hashed."""
    texts = len(offsets) - 1
    if not len(raw):
        return np.zeros((texts, FEATURES), np.float32)
    folded = _FOLD[raw].astype(np.uint32)
    owner = np.repeat(np.arange(texts, dtype=np.int64) * FEATURES, np.diff(offsets))
    counts = np.zeros(texts * FEATURES, np.int64)
    factors = (random_words(51, 3) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    for n in (2, 3):
        if len(raw) < n:
            continue
        size = len(raw) - n + 1
        mixed = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            mixed = (mixed ^ folded[i : i + size]) * factors[i]
            mixed ^= mixed >> np.uint32(15)
        inside = owner[:size] == owner[n - 1 :]
        counts += np.bincount((owner[:size] + (mixed >> shift))[inside], minlength=len(counts))
    out = counts.reshape(texts, FEATURES).astype(np.float32)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        for a, b in slices(np.diff(offsets) + 8000, BLOCK):
            x = features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([v.tobytes() for v in x], pa.binary())], ["lang", "vector"])


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on labelled rows of ``df``."""
    rows = df.where(F.col(lang).isNotNull() & has_letter(text))
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}  # a row per language
    languages = sorted(counts)
    codes = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((FEATURES + 1, 0), np.float32))
    wanted = max(1, min(PER_LANGUAGE, SAMPLE // len(languages)))
    share = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(wanted / n))])[F.col(lang)]
    chosen = rows.where((F.pmod(F.xxhash64(F.col(key), F.lit("fit")), F.lit(1 << 30)) + 0.5) / float(1 << 30) < share)
    found = chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(tidy(_vectors), "lang string, vector binary").collect()
    if not found:
        return Model([], codewords(0), np.zeros((FEATURES + 1, 0), np.float32))
    found.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    x = np.stack([np.frombuffer(r["vector"], np.float16) for r in found]).astype(np.float32)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    y = codes[[languages.index(r["lang"]) for r in found]]
    weights = x.T @ np.linalg.solve(x @ x.T + PENALTY * np.eye(len(x), dtype=np.float32), y)
    return Model(languages, codes, weights.astype(np.float32))


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, score and ambiguity of every row of margins."""
    losses = np.maximum(0, 1 - margins[:, None, :] * model.codes[None]).mean(axis=2)
    nearest = losses.argmin(axis=1)
    ranked = np.sort(losses, axis=1)
    weight = np.exp(-8 * (losses - ranked[:, :1]))
    return nearest, 1 / weight.sum(axis=1), ranked[:, 1] - ranked[:, 0] < CLOSE


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and ambiguous."""
    rows, own, given = aside(df, ("lang_pred", "score", "ambiguous"))
    names = rows.columns
    place = names.index(own[text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.asarray(batch.column(len(names)).to_numpy(zero_copy_only=False), bool)
            raw, offsets = text_bytes(batch.column(place))
            for a, b in slices(np.diff(offsets) + 8000, BLOCK):
                known = letters[a:b] & bool(model.languages)
                if len(model.languages) > 1:
                    x = features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    best, score, close = decode(x @ model.weights[:-1] + model.weights[-1], model)
                else:
                    best, score, close = np.zeros(b - a, int), np.ones(b - a), np.zeros(b - a, bool)
                said = [model.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(names))), pa.array(said), pa.array(np.where(known, score, 0.0).astype(np.float64)), pa.array(close & known)],
                    [*names, "lang_pred", "score", "ambiguous"],
                )

    kinds = rows.limit(0).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False)}).schema
    out = rows.withColumn("letters", has_letter(own[text])).mapInArrow(tidy(run), kinds)
    return out.select(*given, "lang_pred", "score", "ambiguous")
