"""Language identification by a bit-sliced Bloom filter of character n-grams.

One filter serves all languages: every slot holds a mask with one bit for each
language, so the masks of an n-gram's slots, combined by AND, name all languages
that contain it. The bits are counted per language over a whole text, the counts
are corrected for the filter's false positives, and the largest share decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import map_texts, shared_folder, slices, stored
from postlens.sources.scratch import delete_folder

GRAM = 4
SLOTS = 1 << 20
HASHES = 3
SAMPLE_DOCS = 5000
LEAST_RATE = 2e-7
MIN_SHARE = 0.1
UNKNOWN = "und"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter; made once in a process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> np.ndarray:
    """Hashes of all n-grams of the lower-cased letters, with one blank between words.

    Empty for a text without a letter.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[codes]
    if not known.any():
        return np.empty(0, np.uint64)
    inside = known.copy()
    inside[1:] |= known[:-1]  # of a run of other characters the first stays, as a blank
    line = np.where(known, codes, 32)[inside]
    line = line[:-1] if line[-1] == 32 else line
    line = np.pad(line, (1, max(1, GRAM - 1 - len(line))), constant_values=32).astype(np.uint64)
    n = len(line) - GRAM + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(GRAM):
        hashes = hashes * np.uint64(1_000_003) + line[k : k + n]
    hashes = (hashes ^ hashes >> np.uint64(30)) * _MIX1
    hashes = (hashes ^ hashes >> np.uint64(27)) * _MIX2
    return hashes ^ hashes >> np.uint64(31)


def slots_of(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slots of each hash, by double hashing."""
    step = hashes >> np.uint64(32) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]


class LanguageFilter:
    """The filter and what is needed to decide by it."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks  # masks: slots x words of 64 languages
        filled = np.array([self._bits(masks, k).mean() for k in range(len(languages))])
        self.false_rate = np.minimum(filled**HASHES, 0.999)

    @staticmethod
    def _bits(masks: np.ndarray, language: int) -> np.ndarray:
        return masks[:, language // 64] >> np.uint64(language % 64) & np.uint64(1)

    def shares(self, text: str | None) -> np.ndarray | None:
        """Share of the text's n-grams that each language contains; None without letters."""
        hashes = grams(text)
        if not len(hashes) or not self.languages:
            return None
        first, *others = slots_of(hashes, len(self.masks))
        found = self.masks[first]
        for slot in others:
            found &= self.masks[slot]
        counts = np.array([self._bits(found, k).sum() for k in range(len(self.languages))])
        return np.maximum(counts / len(hashes) - self.false_rate, 0) / (1 - self.false_rate)

    def predict(self, text: str | None) -> tuple[str, float]:
        shares = self.shares(text)
        if shares is None:
            return UNKNOWN, 0.0
        best = int(shares.argmax())
        return self.languages[best], float(shares[best] / shares.sum()) if shares[best] else 0.0


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, slots: int = SLOTS) -> LanguageFilter:
    """Learn a filter from labelled texts; rows with NULL language are left out.

    Fitted on a sample of about ``sample_docs`` different texts of each language, chosen by text
    hash; copies count once, and a language with fewer different texts is taken whole. A language
    contains an n-gram whose rate among all of its sample's is at least ``LEAST_RATE``, and at least ``MIN_SHARE`` of
    the highest rate of any language; so the more was sampled, the more often an n-gram has to occur,
    without a step at any size. The driver gets the filled slots, so ``slots`` bounds what it holds.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text")).filter("lang IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64(F.lit(7), "text"))
    different = rows.select("lang", "hash").distinct()
    sizes = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    words = max(1, -(-len(languages) // 64))
    masks = np.zeros((slots, words), np.uint64)
    if not languages:
        return LanguageFilter(languages, masks)
    rates = [(k, min(1.0, sample_docs / sizes[name]), name) for k, name in enumerate(languages)]
    chosen = spark.createDataFrame(rates, "language bigint, part double, lang string")
    draw = F.pmod("hash", F.lit(1_000_000)) / 1_000_000
    drawn = rows.join(F.broadcast(chosen), "lang").filter(draw < F.col("part"))
    sample = drawn.groupBy("language", "hash").agg(F.first("text").alias("text")).select("language", "text")

    def count(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in slices(batches):
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(language, []).append(grams(body))
            if sum(len(x) for parts in held.values() for x in parts) > 4_000_000:
                yield from counted(held)
                held = {}
        yield from counted(held)

    def counted(held):
        for language, parts in held.items():
            values, n = np.unique(np.concatenate(parts), return_counts=True)
            arrays = [pa.array(np.full(len(n), language)), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["language", "gram", "n"])

    counts = sample.mapInArrow(count, "language bigint, gram bigint, n bigint")
    folder = shared_folder(spark, "grams")
    counts = stored(counts.groupBy("language", "gram").agg(F.sum("n").alias("n")), path=folder)
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    rated = counts.join(F.broadcast(totals), "language").withColumn("rate", F.col("n") / F.col("total"))
    top = F.max("rate").over(Window.partitionBy("gram"))
    members = rated.withColumn("top", top).filter(F.col("rate") >= F.greatest(F.lit(LEAST_RATE), MIN_SHARE * F.col("top")))

    def place(batches):
        for batch in batches:
            hashes = batch.column(1).to_numpy().view(np.uint64)
            language = batch.column(0).to_numpy()
            bit = (np.uint64(1) << (language % 64).astype(np.uint64)).view(np.int64)
            for slot in slots_of(hashes, slots):
                yield pa.RecordBatch.from_arrays([pa.array(slot * words + language // 64), pa.array(bit)], ["slot", "mask"])

    filled = members.select("language", "gram").mapInArrow(place, "slot bigint, mask bigint")
    table = filled.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    delete_folder(spark, folder)
    masks.reshape(-1)[table["slot"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, masks)


def held_out(id: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text, by ``folds``, leaves ``fold``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(F.col(quoted(id)).cast("string"), F.lit(""))) % folds == fold


def identify_languages(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """Replace the text by ``lang_pred`` and ``score``, the winner's part of all shares.

    ``und`` and 0 for a NULL text or one without letters, and for all texts if no
    language was learned. Of languages with equal shares the first by name counts, so a text with none of
    the known n-grams gets the first of all, and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks))

    def make():
        own = LanguageFilter(*shared.value)

        def work(texts):
            names, scores = zip(*map(own.predict, texts))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return work

    return map_texts(docs, text, make, "lang_pred string, score double")


def language_id(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """Learn from the rows that are not held out and predict all: id, ``held_out``,
    ``lang_pred``, ``score``. Repeated rows come back as often as they occur, an empty
    table gives an empty result, and other columns are ignored."""
    model = fit(docs.filter(~held_out(id)), text, lang, **options)
    return identify_languages(docs.select(F.col(quoted(id)), held_out(id).alias("held_out"), F.col(quoted(text))), model, text)
