"""Line dedup: lines that many documents share stay in one document only.

Lines are exploded, normalised and hashed; documents are counted per hash; lines over the
threshold are dropped, and each text is put together again by the places of its other lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, let, packed, staged, strip, unpacked


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """One row per line that is long enough: hash of its key (128 bits), document, version, place.

    ``version`` tells apart rows that repeat an id with another text.
    """
    folded = _lines(ascii_lower(F.col(text)))
    rows = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.col(text)).alias("version"),
        F.posexplode_outer(folded).alias("place", "line"),
    )
    keyed = rows.select("doc", "version", "place", strip(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("low"),
        F.xxhash64(F.lit("line"), "key").alias("high"),
        "doc", "version", "place",
    )


def dropped_places(lines: DataFrame, min_docs: int) -> DataFrame:
    """Places to drop per document and version.

    Documents are counted in two steps, so a line that a third of all documents hold is
    counted by all tasks; its rows in the join are split by adaptive execution.
    """
    shared = (
        lines.groupBy("low", "high")
        .agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("low", "high", "keeper")
    )
    return (
        lines.join(shared, ["low", "high"])
        .filter(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "version")
        .agg(F.collect_set("place").alias("places"))
    )


def drop_shared_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents hold.

    The key of a line is the line without white space at its ends, A-Z lower-cased; shorter keys
    than ``min_chars`` code points never count. The document with the largest id that
    holds a key keeps all its lines. Adds ``n_lines`` (before dropping) and ``n_dropped``.

    A null or empty text is one empty line; a null text stays null. Rows with a null id have
    no identity: they are not counted and keep all lines. Rows that repeat an id count
    as one document; each row loses its own lines. Other columns pass through, whatever their names;
    ``n_lines`` and ``n_dropped`` of the input give way. Empty tables give empty tables.
    """
    places = dropped_places(staged(line_hashes(docs, text, doc_id, min_chars), "lines"), min_docs)
    places = places.withColumnsRenamed({"doc": "of_doc", "version": "of_version"})
    given = F.col(f"`{text}`")
    read = packed(docs, doc=F.col(f"`{doc_id}`"), version=F.xxhash64(given), text=given)
    whole = read.join(places, (F.col("doc") == F.col("of_doc")) & (F.col("version") == F.col("of_version")), "left")

    def without(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("places"))
        return F.array_join(F.transform(F.sort_array(left), lambda i: F.get(lines, i)), "\n")

    lines = _lines(F.col("text"))
    results = {
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size("places"), F.lit(0)).cast("long"),
        text: F.when(F.col("places").isNull(), F.col("text")).otherwise(let(lines, without)),
    }
    return unpacked(whole, docs.columns, results)
