"""Language identification with hyperdimensional letter profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import gather, map_slices, text_or_empty

UNKNOWN = "und"
#: Length of all vectors.
SIZE = 4096
SEED = 20
#: Words and trigrams that a task keeps; a full cache starts anew.
CACHE = 200_000
#: Documents counted, and trigram vectors built, at a time.
BLOCK, BUILT = 128, 512
#: Prototypes are sums of unit profiles in these steps; whole numbers add up alike in any order.
STEP = 1 << 20
#: Share of the held-out texts that may fall below a limit.
FALSE_RATE = 0.001
#: Texts of 2 ** LONGEST letters or more are held to the same limit.
LONGEST = 12
#: Texts of a length that a limit needs.
LEAST = 30


@lru_cache(maxsize=8192)
def letter_vector(letter: str) -> np.ndarray:
    """The letter's random vector of +1 and -1, the same in every task."""
    rng = np.random.default_rng([SEED, ord(letter)])
    return rng.integers(0, 2, SIZE, np.int8) * np.int8(2) - np.int8(1)


def trigram_vectors(trigrams: list[str]) -> np.ndarray:
    """Bind three letters: each is permuted by its distance from the end, then multiplied."""
    letters, place = np.unique(np.array([list(t) for t in trigrams]), return_inverse=True)
    place = place.reshape(-1, 3)
    own = np.stack([letter_vector(x) for x in letters.tolist()])
    out = np.roll(own, 2, 1)[place[:, 0]]
    out *= np.roll(own, 1, 1)[place[:, 1]]
    out *= own[place[:, 2]]
    return out


class Profiler:
    """Counts the trigrams of texts; trigrams run over single words with a space on both sides.

    A text's profile is the sum of its trigrams' vectors, which is never built: its product
    with another vector is the sum of the trigrams' products, and its length is taken as that
    of the counts, times the length of a trigram's vector, as those are as good as orthogonal.
    So a vector's size costs work per distinct trigram and not per document.
    """

    def __init__(self, cache: int = CACHE):
        self.cache = cache
        self.words: dict[str, bytes] = {}
        self.numbers: dict[str, int] = {}

    def full(self) -> bool:
        return len(self.words) > self.cache or len(self.numbers) > self.cache

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        letters = lower if lower.isalpha() else "".join(x if x.isalpha() else " " for x in lower)
        numbers = [
            self.numbers.setdefault(padded[k : k + 3], len(self.numbers))
            for padded in (f" {part} " for part in letters.split())
            for k in range(len(padded) - 2)
        ]
        return np.array(numbers, "<u4").tobytes()

    def counts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For blocks of texts: trigrams, counts (texts by trigrams) and lengths of the counts."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        values = []
        for word in coded.dictionary.to_pylist():
            value = self.words.get(word)
            if value is None:
                value = self.words[word] = self._word(word)
            values.append(value)
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        found = list(gather(values, coded.indices.to_numpy(), ends))
        for start in range(0, len(found), BLOCK):
            block = found[start : start + BLOCK]
            used, place = np.unique(np.concatenate(block), return_inverse=True)
            row = np.repeat(np.arange(len(block)), [len(x) for x in block])
            width = max(1, len(used))
            counts = np.bincount(row * width + place, minlength=len(block) * width)
            counts = counts.reshape(len(block), width)[:, : len(used)].astype(float)
            yield used, counts, np.sqrt((counts * counts).sum(1))

    def vectors(self, start: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """First number and vectors, a few at a time, of the trigrams from number ``start`` on."""
        trigrams = list(self.numbers)
        for first in range(start, len(trigrams), BUILT):
            yield first, trigram_vectors(trigrams[first : first + BUILT])


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def held_out(key: str) -> Column:
    """True for the quarter of all keys that is never learned from; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def learn_prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages in order and one unit vector for each.

    A prototype bundles the unit profiles of all documents with that label. Tasks weigh
    trigrams, bundle their vectors at their end or when a cache is full, and send one
    vector per label, which are added up by Spark; the driver receives ``SIZE`` numbers
    per label, so labels are meant to be languages, not free text. Documents with a null
    label or no letters add nothing.
    """
    rows = docs.where(F.col(lang).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        weights: dict[str, np.ndarray] = {}
        profiler = Profiler()

        def bundle() -> None:
            for first, vectors in profiler.vectors():
                wide = vectors.astype(float)
                for label, own in weights.items():
                    own = own[first : first + len(wide)]  # whole numbers below 2 ** 53
                    part = np.rint(own @ wide[: len(own)]).astype(np.int64)
                    sums[label] = sums.get(label, 0) + part

        for batch in batches:
            if profiler.full():
                bundle()
                profiler, weights = Profiler(), {}
            labels = np.array(batch["lang"].to_pylist(), object)
            done = 0
            for used, counts, norms in profiler.counts(batch["text"]):
                steps = np.rint(counts / np.where(norms > 0, norms, 1)[:, None] * STEP)
                own = labels[done : done + len(norms)]
                done += len(norms)
                for label in set(own.tolist()):
                    held = weights.get(label, np.zeros(0))
                    if len(held) < len(profiler.numbers):
                        held = np.append(held, np.zeros(len(profiler.numbers) - len(held)))
                    held[used] += steps[own == label].sum(0)
                    weights[label] = held
        bundle()
        if sums:
            flat = pa.array(np.concatenate(list(sums.values())))
            lists = pa.ListArray.from_arrays(np.arange(len(sums) + 1, dtype="i4") * SIZE, flat)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), lists], names=["lang", "vector"])

    parts = map_slices(rows, run, "lang string, vector array<long>")
    cells = parts.select("lang", F.posexplode("vector").alias("at", "value"))
    sums = cells.groupBy("lang", "at").agg(F.sum("value").alias("value")).toPandas()
    wide = sums.pivot(index="lang", columns="at", values="value").sort_index()
    return wide.index.tolist(), unit(wide.to_numpy(float).reshape(len(wide), SIZE))


def predict_languages(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray, text: str = "text"
) -> DataFrame:
    """Add lang_pred and score to ``docs``: the nearest prototype and its cosine, 0 at least.

    Null texts and texts without letters are ``und`` with score 0, and so is everything if no
    language was learned. Of equally near languages the first in order is taken. The
    prediction sees the text only. There is no shuffle; repeated rows are predicted alike.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*names).alias("row") if names else F.struct(F.lit(1)).alias("row"),
        text_or_empty(text).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast((languages, prototypes.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vectors = shared.value
        profiler, near = Profiler(), np.zeros((0, max(1, len(known))), np.float32)
        for batch in batches:
            if profiler.full():
                profiler, near = Profiler(), near[:0]
            labels, scores = [], []
            for used, counts, norms in profiler.counts(batch["text"]):
                if len(near) < len(profiler.numbers):
                    new = [near]
                    for _, built in profiler.vectors(len(near)):
                        new.append(built.astype(np.float32) @ vectors.T if known else np.zeros((len(built), 1)))
                    near = np.concatenate(new)
                cosines = counts @ near[used] / (np.where(norms > 0, norms, 1) * SIZE**0.5)[:, None]
                best = cosines.argmax(1)
                real = (norms > 0) & bool(known)
                labels += [known[k] if r else UNKNOWN for k, r in zip(best, real, strict=True)]
                top = cosines[np.arange(len(best)), best]
                scores.append(np.where(real, np.clip(top, 0, 1), 0).astype(float))
            score = pa.array(np.concatenate(scores))
            columns = [batch["row"], pa.array(labels, pa.string()), score]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    out = map_slices(rows, run, f"row {kind}, lang_pred string, score double")
    kept = [F.col(f"row.`{c}`").alias(c) for c in names if c not in ("lang_pred", "score")]
    return out.select(*kept, "lang_pred", "score")


def magnitude(text: str) -> Column:
    """Whole binary logarithm of the number of letters, LONGEST at most; null without letters."""
    letters = F.length(F.regexp_replace(text_or_empty(text), r"\P{L}+", ""))
    return F.least(F.floor(F.log2(F.nullif(letters, F.lit(0)))), F.lit(LONGEST)).cast("int")


def limits(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray,
    key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> list[float]:
    """For each magnitude, the score below which a text is in no learned language.

    It comes from all documents that were held out and have a learned label, whole
    and cut after 1, 2, 4 and so on characters: no more than FALSE_RATE of those of a
    magnitude lie below, nor what is within four deviations of their mean. With fewer
    than LEAST texts the limit of the next smaller magnitude with more holds, at first 0.
    """
    rows = docs.where(held_out(key) & F.col(lang).cast("string").isin(languages))
    sizes = [1 << k for k in range(LONGEST + 2)]
    cuts = rows.select(text_or_empty(text).alias("text"), F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    cuts = cuts.where(F.length("text") * 2 > F.col("size")).select(F.expr("left(text, size)").alias("text"))
    scored = predict_languages(cuts.withColumn("magnitude", magnitude("text")), languages, prototypes)
    low = F.percentile_approx("score", FALSE_RATE, 10_000)
    spread = F.avg("score") - 4 * F.stddev_pop("score")
    found = scored.where("magnitude is not null").groupBy("magnitude")
    found = found.agg(F.count("*").alias("n"), F.greatest(F.lit(0.0), F.least(low, spread)).alias("limit"))
    by_size = {r["magnitude"]: r["limit"] for r in found.collect() if r["n"] >= LEAST}
    out: list[float] = []
    for k in range(LONGEST + 1):
        out.append(by_size.get(k, out[-1] if out else 0.0))
    return out


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Learn from the documents that are not held out, then predict all.

    Returns key, held_out, lang_pred, score; one row per document, null and repeated keys
    included. A null key is not held out and not learned from.
    """
    learned = learn_prototypes(docs.where(~held_out(key) & F.col(key).isNotNull()), text, lang)
    rows = docs.select(
        F.col(key).alias("key"), held_out(key).alias("held_out"), text_or_empty(text).alias("text")
    )
    out = predict_languages(rows, *learned)
    return out.select(F.col("key").alias(key), "held_out", "lang_pred", "score")
