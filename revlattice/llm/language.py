"""Language identification by compression.

Every language owns a raw-content zstandard dictionary made of passages of labelled documents. A text's letters are cut into
pieces, each piece is compressed with each dictionary, and the language with the fewest bytes in total wins. A narrow margin
between the two best is reported as a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm.common import below_cutoff, hash_cutoffs, small_batches

PASSAGES, PASSAGE_CHARS = 400, 256
PIECE_BYTES = 2048
LEVEL = 3
TEMPERATURE_BYTES = 6.0
NARROW = 0.02
SCHEMA = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def letters_only(text: Column | str) -> Column:
    """Lower-case letters with one blank for all else between them: neither case nor marks tell a language here."""
    return F.lower(F.regexp_replace(text, r"\P{L}+", " "))


def train_dictionaries(labelled: DataFrame, passages: int = PASSAGES, chars: int = PASSAGE_CHARS) -> dict[str, bytes]:
    """A dictionary per language from ``labelled`` (doc_id, text, lang).

    The fit is a bounded sample: ``passages`` documents per language with the smallest id hash give one passage of
    ``chars`` characters each, so at most passages x chars characters per language reach the driver. Rows are counted by
    language first, and only those below a hash that leaves about twice as many are ranked. Rows with a null language or
    without a letter teach nothing.
    """
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    factor = 2
    while True:
        found = _passages(labelled, hash_cutoffs(counts, lambda _: passages, factor), passages, chars)
        # With a cutoff that left too few the next ones in order are missing: look further.
        if all(len(found.get(lang, ())) >= min(passages, n) for lang, n in counts.items()):
            return {lang: "\n".join(some).encode() for lang, some in sorted(found.items())}
        factor *= 4


def _passages(labelled: DataFrame, cutoffs: dict[str, int], passages: int, chars: int) -> dict[str, list[str]]:
    """The first passages of every language in the order of the ids' hashes, among the rows up to its cutoff."""
    some = labelled.filter(below_cutoff("lang", F.xxhash64("doc_id"), cutoffs)).select("doc_id", "lang", letters_only("text").alias("text"))
    at = F.lit(1) + F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.length("text") - chars, F.lit(1)))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "passage")
    rows = (
        some.select("lang", "doc_id", F.substring("text", at.cast("int"), F.lit(chars)).alias("passage"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= passages)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "passage"))).alias("passages"))
        .collect()
    )
    return {r["lang"]: [p["passage"] for p in r["passages"]] for r in rows}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): language, score in 0..1, margin and rejection.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. Ties go to the
    language first in name order. ``margin`` is the share of bytes by which the best beats the second; below ``narrow``
    the row is ``rejected``, but its language is still named. A single learned language always wins with margin 1.
    """
    small_batches(docs.sparkSession)
    names = list(dictionaries)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressors = []
        for content in shared.value.values():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            compressors.append(
                zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
            )
        for batch in batches:
            langs, scores, margins = [], [], []
            for text, letters in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not letters or not names:
                    langs.append("und")
                    scores.append(0.0)
                    margins.append(0.0)
                    continue
                data = text.encode("utf-8", "surrogatepass")
                pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
                sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors], dtype=float)
                best = int(sizes.argmin())
                weights = np.exp((sizes[best] - sizes) / TEMPERATURE_BYTES)
                second = np.delete(sizes, best).min() if len(names) > 1 else np.inf
                langs.append(names[best])
                scores.append(float(1 / weights.sum()))
                margins.append(float(1 - sizes[best] / second))
            rejected = [m < narrow for m in margins]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), letters_only("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(predict, SCHEMA)
