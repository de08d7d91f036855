"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles gives two values, its least and its greatest, so a signature
of 2k values costs k hash evaluations. Values are banded; documents that share a band are candidates;
candidates are confirmed on their whole shingle sets. Copies with equal sets are one node.

Within a bucket not all pairs are compared: members are compared with one hub, the one that shares buckets with most others, then,
where a bucket still holds several components, with another hub. What is left then is joined across components by an exact
prefix filter and by an exact bound on the tokens in which two sets differ. A pair that was never compared lies in one component
already, or cannot reach the threshold, so no link between different components is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, staged, unpacked
from tidemark.llm.components import stars
from tidemark.llm.tokens import mixed, pieces, shingles, words_of

ROWS = 4  # values per band: least and greatest of two permutations
MISSED = 1e-7  # chance that a pair exactly at the threshold shares no band

MARKS = [f"mark_{i}" for i in range(16)]  # a set as 1,024 parities
_SIGNATURE = "doc BIGINT, version BIGINT, node BINARY, n BIGINT, bands ARRAY<BIGINT>"


def n_bands(percent: int) -> int:
    """Bands needed for a pair at the threshold to be missed with a chance of ``MISSED`` at most."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS))


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7_919)
    factors = random.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    return factors[:, None], random.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]


def min_max(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray, block: int = 1 << 14) -> tuple:
    """Least and greatest value of a set under every permutation, in blocks of bounded memory."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    most = np.zeros(len(factors), np.uint32)
    for start in range(0, len(short), block):
        permuted = factors * short[None, start : start + block] + shifts
        np.minimum(least, permuted.min(axis=1), out=least)
        np.maximum(most, permuted.max(axis=1), out=most)
    return least, most


def band_hashes(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """One hash per band of two permutations, over its number and its four values."""
    low = least.astype(np.uint64) << np.uint64(32) | most.astype(np.uint64)
    pairs = mixed(low).reshape(-1, 2)
    number = mixed(np.arange(1, len(pairs) + 1, dtype=np.uint64))
    return mixed(mixed(pairs[:, 0] + number) + pairs[:, 1])


def node_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signer(width: int, bands: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Signature rows of (doc, version, text) batches."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = permutations(2 * bands)
        for batch, texts in pieces(batches, 2):
            nodes, sizes, hashes = [], [], []
            for values in shingles(words_of(texts), width):
                nodes.append(node_of(values))
                sizes.append(len(values))
                if len(values):
                    hashes.append(band_hashes(*min_max(values, factors, shifts)).view(np.int64))
            counts = np.where(np.array(sizes) > 0, bands, 0)
            bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)
            columns = [
                batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "version", "node", "n", "bands"])

    return sign


def set_reader(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Node and whole shingle set of (doc, version, text) batches."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches, 2):
            sets = list(shingles(words_of(texts), width))
            columns = [pa.array([node_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "members"])

    return read


def confirmer(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``u, v, linked`` of (u, v, set of u, set of v) batches."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                a = np.frombuffer(one.as_buffer(), np.uint64)
                b = np.frombuffer(other.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * common >= percent * (len(a) + len(b) - common))
            columns = [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "linked"])

    return confirm


def _alike_in_size(percent: int) -> Column:
    """Sets of very different sizes cannot reach the threshold."""
    return 100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")


def _ordered_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.filter(_alike_in_size(percent)).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _divided(members: DataFrame, by: Column) -> DataFrame:
    """Buckets that hold several components, each with a hub: the member that ``by`` puts first."""
    return (
        members.groupBy("bucket")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min(F.struct(by.alias("by"), F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("label").alias("label_v"))).alias("hub"),
        )
        .filter(F.col("low") != F.col("high"))
        .select("bucket", "hub.v", "hub.n_v", "hub.label_v")
    )


def _with_hub(members: DataFrame, by: Column, percent: int) -> DataFrame:
    joined = members.join(_divided(members, by), "bucket").filter(F.col("label") != F.col("label_v"))
    return _ordered_pairs(joined.withColumnsRenamed({"node": "u", "n": "n_u"}), percent)


def token_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of (place, label, n, set) batches, the set last."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            sets = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column(3)]
            rows = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            columns = [part.column(i).take(rows) for i in range(3)] + [pa.array(np.concatenate(sets))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "label", "n", "token"])


def marker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, set) batches as ``place`` and its marks: per bit, whether the set has an odd number of tokens that fall on it.

    A token that two sets share changes the same bit in both. So every bit in which their marks differ stands for at least one
    token that only one of them has.
    """
    for batch in batches:
        bits = np.zeros((batch.num_rows, 64 * len(MARKS)), np.uint8)
        for i, one in enumerate(batch.column(1)):
            places = mixed(np.frombuffer(one.as_buffer(), np.uint64)) % np.uint64(bits.shape[1])
            bits[i] = np.bincount(places.astype(np.int64), minlength=bits.shape[1]) & 1
        marks = np.packbits(bits, axis=1).view(np.int64)
        columns = [pa.array(np.ascontiguousarray(marks[:, i])) for i in range(len(MARKS))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["place", *MARKS])


def _meeting(begin: DataFrame, percent: int, marks: Sequence[str] = ()) -> DataFrame:
    """``place_u, place_v`` of sets of different components that share a token and can still reach the threshold.

    What follows the token in a set bounds the size of the other set (``most``). Two sets that both allow only smaller ones than
    themselves cannot meet, so one of a pair is always *wide*: it allows its own size. A token that all sets of a large group hold
    after a few of their own joins no wide set, and so makes no pair, if the group's sets are less alike than the threshold.

    With the ``marks`` of the sets (:func:`marker`), two sets whose marks differ in more bits than linked sets can
    differ in tokens make no pair either: sets that differ from what a large group shares each in another place.
    """
    most = F.floor((F.col("n") - F.col("at") + 1) * (100 + percent) / percent) - F.col("n")
    begin = begin.withColumn("most", most).withColumn("wide", F.col("most") >= F.col("n"))
    left = begin.filter("wide").select("token", *[F.col(c).alias(f"{c}_u") for c in ("place", "label", "n", "most", *marks)])
    right = begin.select("token", *[F.col(c).alias(f"{c}_v") for c in ("place", "label", "n", "most", "wide", *marks)])
    fits = (F.col("n_v") <= F.col("most_u")) & (F.col("n_u") <= F.col("most_v")) & _alike_in_size(percent)
    if marks:
        apart = sum((F.bit_count(F.col(f"{c}_u").bitwiseXOR(F.col(f"{c}_v"))) for c in marks), F.lit(0))
        fits = fits & ((100 + percent) * apart <= (100 - percent) * (F.col("n_u") + F.col("n_v")))
    once = F.when(F.col("wide_v"), F.col("label_u") < F.col("label_v")).otherwise(F.col("label_u") != F.col("label_v"))
    return left.join(right, "token").filter(fits & once).select("place_u", "place_v")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components, among the members of divided buckets, that can still be linked.

    Shingles that only one component holds can be in no such pair and stand first in every set; the others follow
    from rare to frequent. Two sets that reach the threshold share a shingle so early in both that enough
    shingles follow it. So only shingles near the beginning are joined, and frequent ones are
    hardly ever there: a large group of documents that are not alike enough makes few pairs.
    """
    divided = members.join(_divided(members, F.col("node")).select("bucket"), "bucket", "left_semi")
    nodes = divided.select("node", "n", F.xxhash64("label").alias("label")).distinct()
    nodes = staged(nodes.join(sets, "node").withColumn("place", F.monotonically_increasing_id()), "divided")
    kinds = "place BIGINT, label BIGINT, n BIGINT, token BIGINT"
    tokens = nodes.select("place", "label", "n", "members").mapInArrow(token_reader, kinds)
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.min("label").alias("low"), F.max("label").alias("high"))
    spread = tokens.join(held.filter(F.col("low") < F.col("high")).select("token", "holders"), "token")
    own = Window.partitionBy("place")
    rank = F.row_number().over(own.orderBy("holders", "token"))
    placed = spread.withColumn("at", F.col("n") - F.count(F.lit(1)).over(own) + rank)
    begin = placed.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    marked = nodes.select("place", "members").mapInArrow(marker, ", ".join(["place BIGINT", *[f"{c} BIGINT" for c in MARKS]]))
    begin = staged(begin.join(marked, "place").select("token", "place", "label", "n", "at", *MARKS), "beginnings")
    found = _meeting(begin, percent, MARKS).distinct()
    named = nodes.select("place", "node")
    pairs = (
        found.join(named.select(F.col("place").alias("place_u"), F.col("node").alias("one")), "place_u")
        .join(named.select(F.col("place").alias("place_v"), F.col("node").alias("other")), "place_v")
    )
    return pairs.select(F.greatest("one", "other").alias("u"), F.least("one", "other").alias("v"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    first = sets.select(F.col("node").alias("u"), F.col("members").alias("set_u"))
    second = sets.select(F.col("node").alias("v"), F.col("members").alias("set_v"))
    both = pairs.join(first, "u").join(second, "v").select("u", "v", "set_u", "set_v")
    return staged(both.mapInArrow(confirmer(percent), "u BINARY, v BINARY, linked BOOLEAN"), "confirmed")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the least node of their component as label."""
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    joined = members.drop("label").join(named, "node", "left")
    return joined.select("bucket", "node", "n", F.coalesce("root", "node").alias("label"), "central")


def roots_of(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Components among the nodes that share buckets (``u`` with its least node ``v``); ``None`` without links.

    The first hub is the member with the most others in its buckets (``central``): the one that a group of edited copies stands
    around reaches those that were edited as much as a link allows, which otherwise are linked only with a few of the group.
    """
    steps = (
        lambda m: _with_hub(m, -F.col("central"), percent),
        lambda m: _with_hub(m, F.xxhash64("bucket", "node"), percent),
        lambda m: _across(m, sets, percent),
    )
    known, roots = None, None
    for step in steps:
        labelled = members if roots is None else staged(_labelled(members, roots), "labelled")
        pairs = step(labelled)
        if known is not None:
            pairs = pairs.join(known, ["u", "v"], "left_anti")
        judged = _confirmed(pairs, sets, percent)
        known = judged if known is None else known.unionByName(judged)
        if not judged.filter("linked").isEmpty():
            links = known.filter("linked").select("u", "v")
            roots = stars(links)
    return roots


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``version`` (hash of the text), ``n_shingles``, ``component_id``, ``kept``.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct runs of ``width`` words, a
    shorter text is one run. Documents are linked if their sets share ``percent`` of their union; a component is what links
    reach, named by its smallest id; ``kept`` marks that document.

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows with a null id
    link with nothing, have no component and are kept. Rows that repeat id and text are
    judged alike; rows that repeat an id with another text are documents of their own under that id.
    Columns other than id and text are not read. An empty table gives an empty table.
    """
    read = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    )
    signatures = staged(read.mapInArrow(signer(width, n_bands(percent)), _SIGNATURE), "signatures")
    known = signatures.filter((F.col("n") > 0) & F.col("doc").isNotNull())
    nodes = staged(
        known.groupBy("node").agg(
            F.min("doc").alias("first"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
        ),
        "nodes",
    )
    spread = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    central = F.sum("size").over(Window.partitionBy("node")).alias("central")
    members = staged(spread.join(shared, "bucket").select("bucket", "node", "n", F.col("node").alias("label"), central), "members")
    involved = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc"))
    texts = read.join(involved.distinct(), "doc", "left_semi").select("doc", "version", "text")
    sets = staged(
        texts.mapInArrow(set_reader(width), "node BINARY, members BINARY").dropDuplicates(["node"]), "sets"
    )
    roots = roots_of(members, sets, percent)
    if roots is None:
        components = nodes.select("node", F.col("first").alias("component_id"))
    else:
        named = nodes.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
        named = named.select("node", "first", F.coalesce("root", "node").alias("root"))
        least = named.groupBy("root").agg(F.min("first").alias("component_id"))
        components = named.join(least, "root").select("node", "component_id")
    linked = signatures.drop("bands").join(components, "node", "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc").isNotNull(), F.col("component_id"))).otherwise(F.col("doc"))
    return linked.select(
        F.col("doc").alias(doc_id),
        "version",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns kept.

    Rows with a null id stay; rows that repeat id and text become one row.
    """
    judged = near_duplicates(docs, text, doc_id, width, percent).filter(F.col("kept") & F.col(doc_id).isNotNull())
    chosen = judged.select(F.col(doc_id).alias("doc"), "version")
    keyed = packed(docs, doc=F.col(f"`{doc_id}`").cast("long"), version=F.xxhash64(F.col(f"`{text}`")))
    stayed = keyed.join(chosen.distinct(), ["doc", "version"], "left_semi").dropDuplicates(["doc", "version"])
    return unpacked(stayed, docs.columns, {}).unionByName(docs.filter(F.col(doc_id).isNull()))
