"""Language-model scores by a hidden Markov model over the words of a corpus.

Words fall into classes by their hash, and the end of a text is a class of its own. A text is a walk through latent
states; a state gives out a class, and a word has a fixed chance within its class, from the counts of the whole corpus. So the
states' tables have a fixed size, while the counts of words grow with the corpus and stay distributed.

Baum-Welch: tasks compute expected counts of starts, steps and classes; their sums over all partitions give the
next states. The forward recursion, scaled as it goes, gives the exact chance of a text. Many texts run side by side, one
array step per place. A text longer than ``BLOCK`` tokens is cut into blocks whose transfer matrices (states before to states
after) are computed side by side as well and then multiplied in order; that is exact, for training and for scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.tokens import pieces, words_of

STATES = 6
CLASSES = 1 << 14  # of words
ROUNDS = 4
STAY = 0.97  # of the first model's steps, more than by chance: states become languages and kinds of text, not places
PRIOR = 500.0  # tokens of the whole corpus that every state is taken to have given out
BLOCK = 1024  # tokens
SEED = 23
CHUNK_BYTES = 4 << 20  # text that shares one list of distinct tokens
END = 0x5BD1E9955BD1E995  # fixed value: stands for the end of a text among the hashes of words
_RESCALED = 8  # steps between two scalings
_GROUP_TOKENS = 1 << 19  # worked on at once
_UNIT = 1 << 16  # expected counts travel in whole parts, so their sums do not depend on their order


class Model(NamedTuple):
    start: np.ndarray  # chance of the first state
    step: np.ndarray  # from state (row) to state
    emit: np.ndarray  # class (row) by state; a row of zeros ends it

    @property
    def entering(self) -> np.ndarray:
        """Rows of chances of the first state, once per state."""
        return np.broadcast_to(self.start, self.step.shape)


class Blocks(NamedTuple):
    begin: np.ndarray  # first token
    length: np.ndarray
    text: np.ndarray
    number: np.ndarray  # in its text


class Counts(NamedTuple):
    """Expected counts."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def blocks_of(sizes: np.ndarray, block: int) -> Blocks:
    many = -(-sizes // block)
    text = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.repeat(np.cumsum(sizes) - sizes, many) + number * block
    return Blocks(begin, np.minimum(block, sizes[text] - number * block), text, number)


def groups_of(length: np.ndarray, width: int = 1) -> Iterator[np.ndarray]:
    """Numbers of blocks, longest first, in groups of bounded work."""
    order = np.argsort(-length, kind="stable")
    while len(order):
        many = max(1, _GROUP_TOKENS // (int(length[order[0]]) * width))
        yield order[:many]
        order = order[many:]


def padded(classes: np.ndarray, begin: np.ndarray, length: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Classes by step and block (the row of zeros after a block's end), and the blocks that each step has."""
    step = np.arange(int(length[0]) if len(length) else 0)[:, None]
    where = np.minimum(begin + step, max(0, len(classes) - 1))
    seen = np.where(step < length, classes[where], len(model.emit) - 1)
    return seen, np.append((step < length).sum(axis=1), 0)


def forward(given: np.ndarray, active: np.ndarray, model: Model, entry: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of blocks (longest first) with chances ``entry`` of the first state, and chances ``given`` of what is seen.

    By step the chances of states before it is seen what they give out, and the scale taken out before the step; by
    block the chances of states after the last step, and the logarithm of what was taken out of them.
    """
    steps, rows, states = given.shape
    before, taken = np.zeros(given.shape), np.ones((steps + 1, rows))
    last, logs = np.zeros((rows, states)), np.zeros(rows)
    if steps:
        before[0] = entry
    for i in range(steps):
        n, more = active[i], active[i + 1]
        after = before[i, :n] * given[i, :n]
        if i % _RESCALED == _RESCALED - 1:
            scale = after.sum(axis=1)
            after /= scale[:, None]
            taken[i + 1, :n] = scale
            logs[:n] += np.log(scale)
        last[more:n] = after[more:]
        if more:
            np.matmul(after[:more], model.step, out=before[i + 1, :more])
    return before, taken, last, logs


def backward(given: np.ndarray, active: np.ndarray, model: Model, leave: np.ndarray) -> np.ndarray:
    """By step the weights of states: what they give out, and all that follows; ``leave`` follows a block."""
    weights, follows = np.zeros(given.shape), leave.copy()
    for i in range(len(given) - 1, -1, -1):
        n = active[i]
        np.multiply(given[i, :n], follows[:n], out=weights[i, :n])
        follows[:n] = weights[i, :n] @ model.step.T
        if i % _RESCALED == 0:
            follows[:n] /= follows[:n].sum(axis=1, keepdims=True)
    return weights


def transfers(classes: np.ndarray, begin: np.ndarray, length: np.ndarray, first: np.ndarray, model: Model) -> tuple:
    """Matrix of every block from the states before to those after it, and the logarithm taken out of it."""
    states = len(model.start)
    matrices, logs = np.zeros((len(begin), states, states)), np.zeros(len(begin))
    for group in groups_of(length, states):
        seen, active = padded(classes, begin[group], length[group], model)
        now = np.where(first[group][:, None, None], model.entering, model.step)
        taken = np.zeros(len(group))
        for i in range(len(seen)):
            n = active[i]
            if i:
                now[:n] = (now[:n].reshape(-1, states) @ model.step).reshape(-1, states, states)
            now[:n] *= model.emit[seen[i, :n]][:, None, :]
            if i % _RESCALED == _RESCALED - 1:
                scale = now[:n].sum(axis=(1, 2))
                now[:n] /= scale[:, None, None]
                taken[:n] += np.log(scale)
        matrices[group], logs[group] = now, taken
    return matrices, logs


def edges(classes: np.ndarray, blocks: Blocks, texts: int, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per block the chances of the state before it and the weights of its last state; per text of several blocks its chance's logarithm."""
    states = len(model.start)
    enter, leave = np.zeros((len(blocks.begin), states)), np.ones((len(blocks.begin), states))
    likely = np.zeros(texts)
    many = np.bincount(blocks.text, minlength=texts)
    cut = np.flatnonzero(many[blocks.text] > 1)
    if not len(cut):
        return enter, leave, likely
    number, text = blocks.number[cut], blocks.text[cut]
    matrices, logs = transfers(classes, blocks.begin[cut], blocks.length[cut], number == 0, model)
    order = np.argsort(number, kind="stable")
    turns = np.split(order, np.cumsum(np.bincount(number))[:-1])
    now = np.full((texts, states), 1.0 / states)  # the first block's rows are equal
    for turn in turns:
        of = text[turn]
        enter[cut[turn]] = now[of]
        after = np.einsum("ri,rij->rj", now[of], matrices[turn])
        scale = after.sum(axis=1)
        now[of] = after / scale[:, None]
        likely[of] += np.log(scale) + logs[turn]
    follows = np.ones((texts, states))
    for turn in reversed(turns):
        of = text[turn]
        leave[cut[turn]] = follows[of]
        before = np.einsum("rij,rj->ri", matrices[turn], follows[of])
        follows[of] = before / before.sum(axis=1, keepdims=True)
    return enter, leave, likely


def log_chances(classes: np.ndarray, sizes: np.ndarray, model: Model, block: int = BLOCK) -> np.ndarray:
    """Natural logarithm of the chance of every sequence of classes."""
    blocks = blocks_of(sizes, block)
    _, _, likely = edges(classes, blocks, len(sizes), model)
    alone = np.flatnonzero(sizes[blocks.text] <= block)
    for some in groups_of(blocks.length[alone]):
        group = alone[some]
        seen, active = padded(classes, blocks.begin[group], blocks.length[group], model)
        _, _, last, logs = forward(model.emit[seen], active, model, model.start)
        likely[blocks.text[group]] = logs + np.log(last.sum(axis=1))
    return likely


def expected(classes: np.ndarray, sizes: np.ndarray, model: Model, block: int = BLOCK) -> Counts:
    """Expected counts of starts, steps and classes by state, over all sequences."""
    states = len(model.start)
    found = Counts(np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape))
    blocks = blocks_of(sizes, block)
    enter, leave, _ = edges(classes, blocks, len(sizes), model)
    for group in groups_of(blocks.length):
        seen, active = padded(classes, blocks.begin[group], blocks.length[group], model)
        given, first = model.emit[seen], blocks.number[group] == 0
        before, taken, _, _ = forward(given, active, model, np.where(first[:, None], model.start, enter[group] @ model.step))
        weights = backward(given, active, model, leave[group])
        belief = before * weights
        total = belief.sum(axis=2)
        total[total == 0] = 1  # after a block's end
        belief /= total[:, :, None]
        for state in range(states):
            found.emit[:, state] += np.bincount(seen.ravel(), belief[:, :, state].ravel(), len(model.emit))
        found.start[:] += belief[0, first].sum(axis=0)
        came = enter[group][~first] / total[0, ~first, None]
        found.step[:] += came.T @ weights[0, ~first]
        came = before[:-1] * given[:-1] / (taken[1:-1] * total[1:])[:, :, None]
        found.step[:] += came.reshape(-1, states).T @ weights[1:].reshape(-1, states)
    return found._replace(step=found.step * model.step)


def first_model(shares: np.ndarray, states: int, seed: int) -> Model:
    """States that differ by seeded noise around the classes' shares, and that tend to stay."""
    random = np.random.default_rng(seed)
    emit = shares[:, None] * random.gamma(1.0, size=(len(shares), states))
    step = STAY * np.eye(states) + (1 - STAY) / states
    return Model(np.full(states, 1 / states), step, np.vstack([emit / emit.sum(axis=0), np.zeros(states)]))


def next_model(counts: Counts, shares: np.ndarray, prior: float) -> Model:
    """The model of expected counts; every state is taken to have given out ``prior`` tokens of the corpus besides."""
    start, step = counts.start + 1, counts.step + 1
    emit = counts.emit[:-1] + prior * shares[:, None]
    return Model(
        start / start.sum(), step / step.sum(axis=1, keepdims=True), np.vstack([emit / emit.sum(axis=0), np.zeros(len(start))])
    )


def classes_of(tokens: np.ndarray, classes: int) -> np.ndarray:
    """Class of every token; ``classes`` is that of the end."""
    return np.where(tokens == END, classes, (tokens.view(np.uint64) % np.uint64(classes)).view(np.int64))


def packed_codes(codes: np.ndarray) -> bytes:
    """Numbers by their bytes, the low ones of all first: a few numbers are frequent, so this packs well."""
    planes = np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zlib.compress(planes.tobytes(), 1)


def codes_of(column: pa.Array, row: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(column[row].as_buffer()), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def encoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of (id, learned from, text) batches: their texts as numbers of the chunk's distinct tokens."""
    for batch, texts in pieces(batches, 2, CHUNK_BYTES):
        words = words_of(texts)
        sizes = words.counts + 1
        hashes = np.full(int(sizes.sum()), END, np.int64)
        inner = np.ones(len(hashes), bool)
        inner[np.cumsum(sizes) - 1] = False
        hashes[inner] = words.hashes.view(np.int64)
        tokens, codes, uses = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-uses, kind="stable")  # frequent tokens get small numbers, which compress
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        codes, tokens = place[codes], tokens[order]
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(codes[np.repeat(train, sizes)], minlength=len(tokens))

        def one(values: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = [one(batch.column(0)), one(batch.column(1)), one(pa.array(sizes)), pa.array([packed_codes(codes)], pa.binary())]
        columns += [one(pa.array(tokens)), one(pa.array(counts))]
        yield pa.RecordBatch.from_arrays(columns, names=["ids", "train", "sizes", "codes", "tokens", "counts"])


def _values(column: pa.Array, row: int) -> np.ndarray:
    return column.slice(row, 1).flatten().to_numpy(zero_copy_only=False)


def trainer(model: Model, classes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Expected counts, in whole parts, of (train, sizes, codes, tokens) batches, once per task.

    ``row`` is a class, or below 0 a state that steps are from, and last the start.
    """
    states = len(model.start)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counts(np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape))
        for batch in batches:
            for row in range(batch.num_rows):
                learned, sizes = _values(batch.column(0), row).astype(bool), _values(batch.column(1), row)
                codes = codes_of(batch.column(2), row)
                kinds = classes_of(_values(batch.column(3), row), classes)
                found = expected(kinds[codes[np.repeat(learned, sizes)]], sizes[learned], model)
                for sums, more in zip(total, found, strict=True):
                    sums += more
        rows = np.concatenate([total.emit[:-1], total.step, total.start[None, :]])
        number = np.concatenate([np.arange(classes + 1), -1 - np.arange(states + 1)])
        parts = np.rint(rows * _UNIT).astype(np.int64)
        held = np.flatnonzero(parts.any(axis=1))
        columns = [pa.array(number[held].astype(np.int32)), *[pa.array(parts[held, k]) for k in range(states)]]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *[f"s{k}" for k in range(states)]])

    return train


def expected_counts(chunks: DataFrame, model: Model, classes: int) -> Counts:
    """Expected counts over all partitions; their size is that of the model."""
    states = len(model.start)
    named = [f"s{k}" for k in range(states)]
    kinds = "row INT, " + ", ".join(f"{name} BIGINT" for name in named)
    parts = chunks.select("train", "sizes", "codes", "tokens").mapInArrow(trainer(model, classes), kinds)
    sums = parts.groupBy("row").agg(*[F.sum(name).alias(name) for name in named])
    found = Counts(np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape))
    for row, *values in sums.collect():  # classes + states + 2 rows at most
        target = found.emit[row] if row >= 0 else found.step[-1 - row] if row >= -states else found.start
        target[:] = np.array(values, np.float64) / _UNIT
    return found


class Words(NamedTuple):
    """What the counts of words say: totals, and the mass of every class (with half a count for words unseen in it)."""

    tokens: int
    kinds: int
    mass: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        return self.mass / self.mass.sum()


def class_column(token: Column, classes: int) -> Column:
    return F.when(token == END, classes).otherwise(F.pmod(token, F.lit(classes)).cast("int"))


def words_in(vocabulary: DataFrame, classes: int) -> Words:
    found = vocabulary.groupBy(class_column(F.col("token"), classes).alias("class")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")
    )
    rows = found.collect()  # one per class
    mass = np.full(classes + 1, 0.5)
    for row in rows:
        mass[row["class"]] = row["n"] + 0.5 * (row["kinds"] + (row["class"] < classes))
    return Words(sum(row["n"] for row in rows), sum(row["kinds"] for row in rows), mass)


def scorer(model: Model, words: Words) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scores of the texts of (ids, train, sizes, codes, kinds, known) batches."""
    classes = len(words.mass) - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sizes, kinds = _values(batch.column(2), row), _values(batch.column(4), row)
                codes, counts = codes_of(batch.column(3), row), _values(batch.column(5), row)
                of = np.repeat(np.arange(len(sizes)), sizes)
                base = np.log10((counts + 0.5) / (words.tokens + 0.5 * (words.kinds + 1)))
                within = np.where(kinds == classes, 0.0, np.log10((counts + 0.5) / words.mass[kinds]))
                own = np.bincount(of, within[codes], len(sizes))
                likely = log_chances(kinds[codes], sizes, model) / np.log(10)
                columns = [batch.column(0).slice(row, 1).flatten(), pa.array(~_values(batch.column(1), row).astype(bool)), pa.array(sizes)]
                columns += [pa.array(np.bincount(of[counts[codes] > 0], minlength=len(sizes)))]
                columns += [pa.array(np.bincount(of, base[codes], len(sizes))), pa.array(own + likely)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return score


def with_known(chunks: DataFrame, vocabulary: DataFrame, classes: int) -> DataFrame:
    """``ids, train, sizes, codes`` of the chunks with ``kinds`` (class) and ``known`` of their tokens: how often the texts
    that are learned from hold it.

    Only the distinct tokens of a chunk are shuffled, and only their classes and counts meet its texts. A token has a row per
    chunk, so none has a large share of them.
    """
    asked = chunks.select("chunk", F.posexplode("tokens").alias("at", "token"))
    n, kind = F.coalesce("n", F.lit(0)).alias("n"), class_column(F.col("token"), classes).alias("kind")
    met = asked.join(vocabulary, "token", "left").select("chunk", F.struct("at", n, kind).alias("count"))
    known = met.groupBy("chunk").agg(F.sort_array(F.collect_list("count")).alias("counts"))
    known = known.select("chunk", F.col("counts").getField("kind").alias("kinds"), F.col("counts").getField("n").alias("known"))
    return chunks.select("chunk", "ids", "train", "sizes", "codes").join(known, "chunk").drop("chunk")


def score_texts(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    states: int = STATES,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    prior: float = PRIOR,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of a text (runs without white space, A-Z lower-cased) and one end. ``learn`` says which rows the model
    learns from; the others (and those where it is null) are held out. ``score`` is the logarithm, base 10, of the chance that the model gives to the
    text; ``base_score`` the same for independent words, each with half a count added. ``n_known`` counts tokens that the
    model has learned from. Words are told apart by 64-bit hashes.

    Null, empty and blank texts are an end alone. Rows that repeat an id or a text are texts of their own, in learning
    too. Null ids stay null. Other columns are not read. Without any row to learn from, the states are those of the start and no token is known. An empty
    table gives an empty table.
    """
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    read = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.coalesce(learn, F.lit(False)).alias("train"), F.col(f"`{text}`").alias("text")
    )
    schema = f"ids ARRAY<{kind}>, train ARRAY<BOOLEAN>, sizes ARRAY<BIGINT>, codes BINARY, tokens ARRAY<BIGINT>, counts ARRAY<BIGINT>"
    chunks = staged(read.mapInArrow(encoder, schema).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    held = chunks.select(F.explode(F.arrays_zip("tokens", "counts")).alias("held")).select("held.tokens", "held.counts").filter("counts > 0")
    vocabulary = staged(held.groupBy(F.col("tokens").alias("token")).agg(F.sum("counts").alias("n")), "vocabulary")
    words = words_in(vocabulary, classes)
    model = first_model(words.shares, states, seed)
    for _ in range(rounds):
        model = next_model(expected_counts(chunks, model, classes), words.shares, prior)
    scored = with_known(chunks, vocabulary, classes).mapInArrow(
        scorer(model, words), f"id {kind}, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"
    )
    return scored.select(
        F.col("id").alias(doc_id), "held_out", "n_tokens", "n_known", F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
