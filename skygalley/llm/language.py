"""Language identification with language-bitmask n-gram filters.

Method: one Bloom filter per language over character 3-grams, stored bit-sliced: a slot holds one bit per language, so the
and of an n-gram's slots gives all languages whose filter contains it. A text's 3-grams are looked up; each
language's count of hits, less the hits that its filter's fill makes by chance, decides.

Training counts 3-grams over a bounded sample of labelled rows (``SAMPLE_DOCS`` expected per language, those whose hash
of the id is small enough); prediction is a map over documents with a table of at most 2^``MAX_BITS`` slots.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygalley.llm.words import mix, slices

SAMPLE_DOCS = 1500
# A 3-gram belongs to the languages in which it is at least this share as frequent as where it is most frequent.
MIN_SHARE = 0.5
# And if it occurs there once for every so many 3-grams of the language's sample, MIN_COUNT times at most: a small sample
# gives all that it has.
GRAMS_PER_COUNT = 20_000
MIN_COUNT = 3
HASHES = 3
# Slots per 3-gram, and most slots.
SLOTS_PER_GRAM = 16
MAX_BITS = 22
UNKNOWN = "und"
SLICE = 1 << 19


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in lower case: 3-grams around a letter, text of each, and the letters per text.

    What is not a letter is a space.
    """
    lowered = [t.lower() for t in texts]
    code = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.array([len(t) + 1 for t in lowered], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    letter = _letters()[code]
    code = np.where(letter, code, 0x20).astype(np.uint64)
    middle = np.flatnonzero(letter)
    gram = (code[middle - 1] << np.uint64(42)) | (code[middle] << np.uint64(21)) | code[middle + 1]
    owner = owner[middle - 1]
    return gram, owner, np.bincount(owner, minlength=len(texts))


@dataclass
class LanguageModel:
    """Languages in order, the sliced filter (slots x words of 64 languages), and the language to fall back on."""

    languages: list[str]
    table: np.ndarray
    fallback: int

    def _slots(self, gram: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(gram)
        mask = np.uint64(len(self.table) - 1)
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield (h + step * np.uint64(i)) & mask

    def add(self, gram: np.ndarray, language: int) -> None:
        bit = np.uint64(1) << np.uint64(language % 64)
        for slot in self._slots(gram):
            np.bitwise_or.at(self.table[:, language // 64], slot.astype(np.int64), bit)

    def false_positives(self) -> np.ndarray:
        return np.array(
            [
                ((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() ** HASHES
                for i in range(len(self.languages))
            ]
        )

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        gram, owner, letters = _grams([t or "" for t in texts])
        shares = np.zeros((len(texts), len(self.languages)))
        false = self.false_positives()
        for word in range(self.table.shape[1]):
            column = np.ascontiguousarray(self.table[:, word])
            mask = functools.reduce(np.bitwise_and, (column[s] for s in self._slots(gram)))
            for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                hit = (mask >> np.uint64(i % 64)) & np.uint64(1)
                hits = np.bincount(owner, weights=hit, minlength=len(texts))
                share = (hits - letters * false[i]) / max(1 - false[i], 1e-9) / np.maximum(letters, 1)
                shares[:, i] = np.clip(share, 0, 1)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        best = shares.argmax(axis=1)
        score = shares[np.arange(len(texts)), best]
        best = np.where(score > 0, best, self.fallback)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters)]
        return names, np.where(letters > 0, score, 0.0).tolist()


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the checksum of the id, is never learned from."""
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2
    return F.coalesce(rest, F.lit(False))


def learn(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> LanguageModel:
    """A model of the languages of rows that are not held out and have a label and a text.

    Labels are a closed set: one number per label, and the selected 3-grams of the bounded sample, come to the driver.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    counted = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counted:
        return LanguageModel([], np.zeros((2, 1), np.uint64), 0)
    languages = sorted(counted)
    # The share of all 64-bit hashes that gives the sample's size.
    upto = {k: min(2**63 - 1, int(2**64 * sample_docs / n) - 2**63) for k, n in counted.items()}
    limit = F.create_map(*[F.lit(x).cast("long") if isinstance(x, int) else F.lit(x) for pair in upto.items() for x in pair])[
        F.col("lang")
    ]
    sample = rows.where(F.col("h") <= limit).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                names = part.column(0).to_pylist()
                gram, owner, _ = _grams(part.column(1).to_pylist())
                number = {name: i for i, name in enumerate(sorted(set(names)))}
                named = np.array([number[n] for n in names], np.uint64)[owner]
                for name, i in number.items():
                    own, n = np.unique(gram[named == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own)), pa.array(own.astype(np.int64)), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    counts = sample.mapInArrow(count, "lang string, gram long, n long")
    per_gram = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # What few occurrences say of a frequency is little: as the largest counts what it is less one standard error, so
    # that a language of a few rows does not take 3-grams from the others.
    surely = F.max((F.col("n") - F.sqrt("n")) / F.col("total")).over(Window.partitionBy("gram"))
    least = F.least(F.lit(MIN_COUNT), F.ceil(F.col("total") / GRAMS_PER_COUNT))
    chosen = (
        per_gram.withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
        .withColumn("most", surely)
        .where((F.col("n") >= least) & (F.col("n") / F.col("total") >= MIN_SHARE * F.col("most")))
        .select("lang", "gram")
        .collect()
    )
    slots = 1 << min(MAX_BITS, max(12, (SLOTS_PER_GRAM * len({r["gram"] for r in chosen})).bit_length()))
    sizes = {name: 0 for name in languages}
    model = LanguageModel(languages, np.zeros((slots, -(-len(languages) // 64)), np.uint64), 0)
    for i, name in enumerate(languages):
        own = np.array([r["gram"] for r in chosen if r["lang"] == name], np.int64).astype(np.uint64)
        sizes[name] = len(own)
        model.add(own, i)
    model.fallback = max(range(len(languages)), key=lambda i: sizes[languages[i]])
    return model


def identify(
    docs: DataFrame,
    model: LanguageModel,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] = (),
) -> DataFrame:
    """Per row: doc_id, lang_pred, score (share of the text's 3-grams that the language holds, corrected), ``carry``.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. A text none of whose 3-grams is known
    gets the language with most 3-grams and score 0. Of equal scores the first language by name wins. Only the text is looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                names, scores = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names), pa.array(scores, pa.float64()), *part.columns[2:]],
                    names=["doc_id", "lang_pred", "score", *[f"c{i}" for i in range(len(carry))]],
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    kinds = [f", c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)]
    out = rows.mapInArrow(run, "doc_id long, lang_pred string, score double" + "".join(kinds))
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})
