"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product (binding) of its letters' vectors,
each rotated (permuted) by its place; a text is the sum (bundle) of its trigrams, a language the sum of its texts.
A text has the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_results
from tidemark.llm.tokens import mixed, pieces

DIMENSIONS = 1024
UNKNOWN = "und"
SIGNAL = 0.07  # of a language at most: copies raise it, not the cosines of other texts
_BITS = 21  # of a code point
_GAP = np.int64(32)  # any run of other characters between letters, and the ends of a text
_letters: list[np.ndarray] = []
_BLOCK_BYTES = 1 << 18
_BLOCK_TRIGRAMS = 2_048  # distinct trigrams whose vectors are made at once
_CELLS = 1 << 21  # counts of trigrams held at once


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once per Python worker."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)]))
    return _letters[0]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 per code point, the same everywhere: bits of scrambled numbers."""
    words = np.arange(1, DIMENSIONS // 64 + 1, dtype=np.uint64)
    numbers = mixed(mixed(points.astype(np.uint64))[:, None] + mixed(words)[None, :])
    bits = np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits.astype(np.int8) * 2 - 1


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """First letter rotated twice, second once, third as it is, multiplied."""
    mask = (1 << _BITS) - 1
    points, place = np.unique(np.stack([codes >> 2 * _BITS, codes >> _BITS & mask, codes & mask]), return_inverse=True)
    place = place.reshape(3, -1)
    letters = letter_vectors(points)
    twice, once = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return twice[place[0]] * once[place[1]] * letters[place[2]]


def trigrams(text: str) -> np.ndarray:
    """Codes of the trigrams of a whole text: letters in lower case, other characters as one gap."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _is_letter()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    points = np.where(letter, points, _GAP)
    keep = np.append(True, letter[1:] | letter[:-1])
    points = np.concatenate(([_GAP], points[keep], [_GAP]))
    points = points[np.append(True, (points[1:] != _GAP) | (points[:-1] != _GAP))]
    return points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:]


def blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches of about ``_BLOCK_BYTES`` of text each, and their texts; a longer text is alone."""
    for part, _ in pieces(batches, text, _BLOCK_BYTES):
        yield part, part.column(text).to_pylist()


def bundled(texts: list[str | None], row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the trigram vectors of the texts of each row, and how many trigrams it has.

    Trigrams are taken in blocks, so memory does not grow with their variety. Sums are whole numbers, up to 2^53.
    """
    parts = [trigrams(text or "") for text in texts]
    owner, codes = np.repeat(row, [len(p) for p in parts]), np.concatenate(parts)
    exact = np.float32 if len(codes) < 1 << 24 else np.float64  # for the sums of a block
    order = np.argsort(codes)
    owner, codes = owner[order], codes[order]
    new = np.append(True, codes[1:] != codes[:-1])[: len(codes)]
    distinct, place = codes[new], np.cumsum(new) - 1
    sums = np.zeros((rows, DIMENSIONS))
    width = min(max(_CELLS // rows, 64), _BLOCK_TRIGRAMS)
    for low in range(0, len(distinct), width):
        vectors = trigram_vectors(distinct[low : low + width]).astype(exact)
        first, end = np.searchsorted(place, [low, low + width])
        cells = owner[first:end] * len(vectors) + place[first:end] - low
        counts = np.bincount(cells, minlength=rows * len(vectors)).reshape(rows, len(vectors))
        sums += counts.astype(exact) @ vectors
    return sums, np.bincount(owner, minlength=rows)


def bundle_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of trigram vectors per language, then its number of trigrams, of (text, lang) batches; one row per language and partition."""
    bundles: dict[str, np.ndarray] = {}
    for batch, texts in blocks(batches, 0):
        langs, row = np.unique(np.array(batch.column(1).to_pylist(), object), return_inverse=True)
        sums, sizes = bundled(texts, row, len(langs))
        for lang, total, size in zip(langs.tolist(), sums, sizes, strict=True):
            if size:
                bundles[lang] = bundles.get(lang, 0) + np.append(total, size).astype(np.int64)
    columns = [pa.array(list(bundles), pa.string()), pa.array([b.tolist() for b in bundles.values()], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["lang", "bundle"])


def prototypes(labelled: DataFrame, text: str, lang: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages by name, their unit prototypes and signals: one vector per language is all the driver gets.

    A signal is the root of the chance that two trigrams of the language are equal, ``SIGNAL`` at most: a clean text
    of n trigrams, few beside the language, has a cosine near the signal times the root of n.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text), F.col(lang))
    bundles = rows.mapInArrow(bundle_partition, "lang STRING, bundle ARRAY<BIGINT>")
    summed = bundles.select("lang", F.posexplode("bundle").alias("place", "value")).groupBy("lang", "place").agg(
        F.sum("value").alias("value")
    )
    listed = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("bundle"))
    found = {row["lang"]: np.array([v["value"] for v in row["bundle"]], float) for row in listed.collect()}
    names = sorted(name for name, bundle in found.items() if bundle[:-1].any())
    norms = [np.linalg.norm(found[name][:-1]) for name in names]
    units = [found[name][:-1] / norm for name, norm in zip(names, norms, strict=True)]
    signals = [min(SIGNAL, norm / DIMENSIONS**0.5 / found[name][-1]) for name, norm in zip(names, norms, strict=True)]
    return names, np.array(units).reshape(len(names), DIMENSIONS), np.array(signals)


def predictor(
    names: list[str], units: np.ndarray, signals: np.ndarray | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Language and cosine, after the other columns, of batches whose last column is the text.

    With ``signals``, the cosine to expect of a clean text with so many trigrams is one more column.
    """
    turned = np.ascontiguousarray(units.T, np.float32)
    added = [] if signals is None else ["expected"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for part, texts in blocks(iter([batch]), last):
                langs, scores, expected = judged(texts)
                columns = [part.column(i) for i in range(last)]
                columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                if signals is not None:
                    columns.append(pa.array(expected, pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "lang_pred", "score", *added])

    def judged(texts: list[str | None]) -> tuple[list[str], list[float], np.ndarray]:
        if not names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), np.zeros(len(texts))
        sums, numbers = bundled(texts, np.arange(len(texts)), len(texts))
        bundles = sums.astype(np.float32)
        sizes = np.linalg.norm(bundles, axis=1)
        cosines = (bundles @ turned) / np.where(sizes > 0, sizes, 1)[:, None]
        best = cosines.argmax(axis=1)
        empty = numbers == 0
        top = np.clip(cosines[np.arange(len(best)), best], 0, 1)
        langs = [UNKNOWN if none else names[i] for i, none in zip(best, empty, strict=True)]
        expected = np.sqrt(numbers) * (0 if signals is None else signals[best])
        return langs, np.where(empty, 0, top).astype(float).tolist(), np.minimum(expected, 1)

    return predict


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Rows that stay out of learning, by the checksum of the id; a null id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def predict_language(
    docs: DataFrame,
    learn: DataFrame,
    text: str = "text",
    lang: str = "lang",
    keep: list[str] | None = None,
    expected: str | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all, if not named) with ``lang_pred`` and ``score`` (cosine, 0 to 1).

    ``expected`` names a further column: the cosine near which a clean text with so many trigrams is.

    Prototypes are learned from texts and non-null languages of ``learn``; prediction reads the text alone,
    whole. A null text, or one without letters, is ``und`` with score 0, and so is every text when nothing
    could be learned. Equal cosines go to the first language by name. Repeated rows are judged
    alike and train as often as they stand there; an empty table stays empty. Input columns named like a
    result give way.
    """
    names, units, signals = prototypes(learn, text, lang)
    model = predictor(names, units, None if expected is None else signals)
    results = ["lang_pred", "score"] + ([] if expected is None else [expected])
    keep = docs.columns if keep is None else keep
    kept = [c for c in keep if c.lower() not in [r.lower() for r in results]]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text).alias("text"))
    fields = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    kinds = ["lang_pred STRING", "score DOUBLE", "expected DOUBLE"][: len(results)]
    judged = rows.mapInArrow(model, ", ".join([*fields, *kinds]))
    if expected is not None:
        judged = judged.withColumnRenamed("expected", expected)
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *results)


def held_out_languages(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id``, ``held_out`` and the prediction per document; learned from the rows that are not held out."""
    marked = with_results(docs.select("doc_id", "text", "lang"), {"held_out": held_out("doc_id", folds, fold)})
    return predict_language(marked, marked.filter(~F.col("held_out")), keep=["doc_id", "held_out"])
