"""Language identification by nearest centroid.

A text becomes a vector of hashed byte 1-, 2- and 3-gram counts, damped, weighted by
inverse document frequency and normalised. Each language has a few centroids, found
by spherical k-means; a text takes the language of the most similar one.

Texts much less similar than nearly all training texts of their language and length are
rejected. All training rows are compared with the centroids once; of each language
and power of two of the length, the similarity that `LOW` of them stay below, less a
margin, is the limit. A shorter text is never held to a stricter limit than a longer one;
lengths with fewer than `LEAST_ROWS` training texts take the limit of the next longer one,
eased, and those longer than all such lengths that of the longest.

Document frequencies are counted over all training rows. Centroids are fitted on at
most `SAMPLE_PER_LANGUAGE` rows a language (fewer with many languages, `SAMPLE_ROWS`
in all), chosen by a hash of the text, so what the driver holds is bounded. Distinct
texts are counted before, so copies neither flood a language's sample nor empty it.

Defined results: a null text, or one without a letter, is `und` with score 0 and
rejected; repeated rows get the same answer; without training rows all is `und`; very
long texts are read whole; an empty table gives no rows.
Languages that tie take the first by name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textarrays import LOWER, chunks, mix, text_bytes

SIZE = 4096
CENTROIDS = 4
ROUNDS = 12
SAMPLE_PER_LANGUAGE = 600
SAMPLE_ROWS = 6000
SPOT_BITS = 40
#: A text is rejected below this share of the similarity that so small a part of the training texts stays below.
SLACK = 0.6
LOW = 0.005
LEAST_ROWS = 20
EASED = 0.85  # how much less similar texts of half the length may be
_SCALE = 1000  # similarities are counted in steps of a thousandth
LENGTH_BINS = 24
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    idf: np.ndarray
    centroids: np.ndarray  # rows of length 1
    floor: np.ndarray  # least similarity that is not rejected, by language and length bin


_LETTERS = LOWER.copy()
_LETTERS[:0x80][~np.isin(LOWER[:0x80], np.arange(0x61, 0x7B))] = 0x20


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of each text, one row a text.

    ASCII letters count in lower case; runs of other ASCII bytes count as one space.
    """
    rows = len(offsets) - 1
    low = _LETTERS[data]
    text = np.repeat(np.arange(rows), np.diff(offsets))
    blank = low == 0x20
    again = np.zeros(len(low), dtype=bool)
    again[1:] = blank[1:] & blank[:-1] & (text[1:] == text[:-1])
    low, text = low[~again].astype(np.uint64), text[~again]
    n = len(low)
    counts = np.zeros(rows * SIZE)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(1, 4):
        key = (key[: n - k + 1] << np.uint64(8)) | low[k - 1 :] if n >= k else key[:0]
        if not len(key):
            break
        whole = text[: len(key)] == text[k - 1 :]
        slot = (mix(key + np.uint64(k << 32)) % np.uint64(SIZE)).astype(np.int64)
        at = text[: len(key)] * SIZE + slot
        counts += np.bincount(at[whole], minlength=rows * SIZE)
    return counts.reshape(rows, SIZE)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def length_bin(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), LENGTH_BINS - 1)


def _small(part, limit: int = 200) -> Iterator:
    """At most `limit` rows at a time, as the count matrix is dense."""
    for piece in chunks(part, "text"):
        for a in range(0, piece.num_rows, limit):
            yield piece.slice(a, limit)


def _frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and, for each feature, how many training texts have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            for part in _small(batch):
                seen += (gram_counts(*text_bytes(part.column("text"))) > 0).sum(axis=0)
                rows += part.num_rows
        at = np.append(np.arange(SIZE), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(seen, rows))], names=["feature", "n"])

    sums = train.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = {r.feature: r.n for r in sums.collect()}  # SIZE + 1 rows
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(SIZE)])


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts are spread out, empty clusters go."""
    chosen = [0]
    for _ in range(1, min(k, len(x))):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centres = x[sorted(set(chosen))]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[near == j].sum(axis=0) for j in range(len(centres)) if (near == j).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def fit(train: DataFrame) -> Model:
    """Learn from the columns `text` and `lang` of rows with both."""
    train = train.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    train = train.where(F.col("text").rlike(r"\p{L}"))
    rows, seen = _frequencies(train)
    idf = np.log((1 + rows) / (1 + seen)) + 0.2
    spotted = train.withColumn("spot", F.pmod(F.xxhash64("text"), F.lit(1 << SPOT_BITS)))
    # Distinct texts of each language by the bits of their spot: at most SPOT_BITS rows a language.
    bits = F.length(F.bin("spot")).alias("bits")
    per: dict[str, np.ndarray] = {}
    for r in spotted.select("lang", "spot").distinct().groupBy("lang", bits).count().orderBy("lang").collect():
        per.setdefault(r.lang, np.zeros(SPOT_BITS + 1, np.int64))[r.bits] = r["count"]
    languages = list(per)
    if not languages:
        return Model([], np.zeros(0, np.int64), idf, np.zeros((0, SIZE), np.float32), np.zeros((0, LENGTH_BINS)))
    take = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // len(languages)))
    # The least power of two below which a language has as many distinct texts as wanted, or all it has; copies
    # meet before they are sent.
    below = {lang: int((np.cumsum(n) >= min(take, n.sum())).argmax()) for lang, n in per.items()}
    share = F.create_map(*[F.lit(v) for lang in languages for v in (lang, 1 << below[lang])])
    drawn = spotted.where(F.col("spot") < share[F.col("lang")])
    drawn = drawn.groupBy("lang", "spot").agg(F.first("text").alias("text"))
    counted = drawn.mapInArrow(_sparse, "lang string, spot long, n long, feature binary, times binary")
    sample: dict[str, list] = {lang: [] for lang in languages}
    for r in counted.collect():  # about 2 * SAMPLE_ROWS at most
        sample[r.lang].append((r.spot, r.n, np.frombuffer(r.feature, np.int16), np.frombuffer(r.times, np.float32)))
    owner, centroids = [], []
    for number, lang in enumerate(languages):
        kept = sorted(sample[lang], key=lambda v: v[0])[:take]
        counts = np.zeros((len(kept), SIZE))
        for i, (_, _, feature, times) in enumerate(kept):
            counts[i, feature] = times
        x = vectors(counts, idf)
        centres = _clusters(x, CENTROIDS)
        centroids.append(centres)
        owner += [number] * len(centres)
    model = Model(
        languages, np.array(owner), idf, np.concatenate(centroids).astype(np.float32), np.zeros((len(languages), LENGTH_BINS))
    )
    return replace(model, floor=_floors(train, model))


def _floors(train: DataFrame, model: Model) -> np.ndarray:
    """Limits of rejection by language and length bin, from the similarities of all training rows."""
    bin_ = F.least(F.length(F.bin(F.octet_length("doc.text"))) - 1, F.lit(LENGTH_BINS - 1)).alias("bin")
    step = F.floor(F.col("score") * _SCALE).cast("int").alias("step")
    counted = predict(train, model).groupBy("lang_pred", bin_, step).count().collect()  # at most languages x bins x steps
    seen = np.zeros((len(model.languages), LENGTH_BINS, _SCALE + 1), np.int64)
    number = {lang: i for i, lang in enumerate(model.languages)}
    for r in counted:
        seen[number[r.lang_pred], r.bin, r.step] = r["count"]
    upto, total = np.cumsum(seen, axis=2), seen.sum(axis=2)
    low = (upto > np.floor(total * LOW)[:, :, None]).argmax(axis=2) / _SCALE * SLACK
    floors = np.zeros((len(model.languages), LENGTH_BINS))
    for i in range(len(floors)):
        known = np.flatnonzero(total[i] >= LEAST_ROWS)
        if not len(known):  # too few rows at every length: the least similarity of all
            floors[i] = low[i, total[i] > 0].min(initial=1.0) if total[i].any() else 0.0
            continue
        limit = np.inf
        for b in range(LENGTH_BINS - 1, -1, -1):
            if b > known[-1]:
                floors[i, b] = low[i, known[-1]]
                continue
            limit = min(limit, low[i, b]) if total[i, b] >= LEAST_ROWS else limit * EASED
            floors[i, b] = limit
    return floors


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse n-gram counts of each text."""
    for batch in batches:
        for part in _small(batch):
            data, offsets = text_bytes(part.column("text"))
            counts = gram_counts(data, offsets)
            at = [np.flatnonzero(row) for row in counts]
            yield pa.RecordBatch.from_arrays([
                part.column("lang"), part.column("spot"), pa.array(np.diff(offsets)),
                pa.array([i.astype(np.int16).tobytes() for i in at], type=pa.binary()),
                pa.array([row[i].astype(np.float32).tobytes() for row, i in zip(counts, at, strict=True)], type=pa.binary()),
            ], names=["lang", "spot", "n", "feature", "times"])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`doc` (all input columns), `lang_pred`, `score` and `rejected` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE x centroids floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in _small(batch):
                column = part.column("text")
                data, offsets = text_bytes(column)
                lettered = np.array([has_letter(t) for t in column.to_pylist()], dtype=bool) & (len(m.languages) > 0)
                pred, score, rejected = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows), ~lettered
                if lettered.any():
                    sims = vectors(gram_counts(data, offsets), m.idf) @ m.centroids.T
                    best = sims.argmax(axis=1)
                    score = np.where(lettered, np.clip(sims[np.arange(len(best)), best].astype(np.float64), 0, 1), 0)
                    lang = m.owner[best]
                    pred = [m.languages[lang[i]] if lettered[i] else UNDETERMINED for i in range(part.num_rows)]
                    rejected = ~lettered | (score < m.floor[lang, length_bin(np.diff(offsets))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(pred, type=pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([
        rows.schema["doc"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves 1 modulo 3; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def crc_of_id(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())
