"""Hidden Markov language model (free style: Arrow batches, joins and sums).

Tokens: the text with A-Z in lower case, cut at ASCII white space, then one end token. A document
is a chain of latent states; each state emits a class of tokens, and a class emits the token. The
most frequent tokens are classes of their own, all others share hashed classes, in which a token
has its smoothed share of the class's count. So the model's size is bounded by parameters,
whatever the vocabulary, and its probabilities over all possible tokens of a class sum to one.

Training: token counts of all training documents; then Baum-Welch rounds. In a round every task
runs the scaled forward-backward recursion over its documents, many of them side by side, and
emits expected counts per class; Spark sums them across partitions. Documents are gone through in
segments of ``SEGMENT`` tokens, which bounds a task's memory; the recursion runs across them.
Scoring: the scaled forward recursion over whole documents, in log10.

Counts of tokens beyond the ``DICTIONARY`` most frequent are never sent to the tasks as a whole:
such tokens are joined to their counts by token. None of them is frequent, so no key is hot.

Results: a null text is empty and has only the end token. Without training tokens every class is
equally likely. Each row is scored by itself, repeated ones too; extra columns do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import release, stored

STATES = 8
ROUNDS = 5
# Tokens with a class of their own, hashed classes, tokens whose counts every task knows.
OWN_CLASSES = 16_384
SHARED_CLASSES = 2_048
DICTIONARY = 262_144
LONGEST = 64  # bytes of a token of the dictionary; longer ones are joined
SEGMENT = 512
SIDE_BY_SIDE = 256
# Tokens gathered (two bytes each) before chains are dealt to groups.
POOL = 1 << 23
SMOOTHING = 0.1
PRIOR_TOKENS = 2000
_FLUSH = 400_000


def tokens_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def token_totals(docs: DataFrame) -> DataFrame:
    """``token`` and its count ``c`` over all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(tokens_of(text))
                if len(counts) > _FLUSH:
                    yield _pairs(counts)
                    counts = Counter()
        yield _pairs(counts)

    def _pairs(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.record_batch(columns, names=["token", "c"])

    pairs = docs.select(F.col("text").cast("string")).mapInArrow(work, "token binary, c bigint")
    return pairs.groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What the tasks know of the token counts; bounded by the parameters above."""

    tokens: list[bytes]  # the dictionary, most frequent first
    counts: np.ndarray
    n_own: int
    n_shared: int
    total: int  # all training tokens with ends
    distinct: int
    ends: int
    shared_total: np.ndarray  # of the hashed classes: tokens, distinct tokens
    shared_distinct: np.ndarray

    @property
    def end_class(self) -> int:
        return self.n_own

    @property
    def n_classes(self) -> int:
        return self.n_own + 1 + self.n_shared

    def base(self, c):
        return np.log10((c + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))

    def share(self, c, bucket):
        within = self.shared_total[bucket] + SMOOTHING * (self.shared_distinct[bucket] + 1)
        return np.log10((c + SMOOTHING) / within)

    def tables(self):
        """Token → number; class, base and share of each number. For use inside tasks."""
        number = {t: i for i, t in enumerate(self.tokens)}
        buckets = np.fromiter((zlib.crc32(t) % self.n_shared for t in self.tokens), np.int64, len(self.tokens))
        classes = self.n_own + 1 + buckets
        classes[: self.n_own] = np.arange(min(self.n_own, len(self.tokens)))
        share = self.share(self.counts, buckets)
        share[: self.n_own] = 0.0
        return number, classes, self.base(self.counts), share


def learn_vocabulary(
    totals: DataFrame, n_docs: int, own: int, shared: int, dictionary: int
) -> Vocabulary:
    """``totals``: a stored table of token counts."""
    level = F.floor(F.log2("c") * 8).cast("int")
    short = F.length("token") <= LONGEST
    levels = totals.groupBy(level.alias("level")).agg(
        F.count_if(short).alias("n"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    ).collect()
    room, least = dictionary, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        if row["n"] > room:
            break
        room, least = room - row["n"], row["level"]
    known = [] if least is None else totals.where(short & (level >= least)).collect()
    known.sort(key=lambda r: (-r["c"], bytes(r["token"])))
    n_own = min(own, len(known))
    own_tokens = [bytes(r["token"]) for r in known[:n_own]]
    own_totals = Counter(zlib.crc32(t) % shared for t in own_tokens)
    bucket = (F.crc32("token") % shared).cast("int")
    sums = totals.groupBy(bucket.alias("b")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    shared_total, shared_distinct = np.zeros(shared), np.zeros(shared)
    for row in sums:
        shared_total[row["b"]], shared_distinct[row["b"]] = row["c"], row["v"]
    for row in known[:n_own]:
        shared_total[zlib.crc32(bytes(row["token"])) % shared] -= row["c"]
    for b, v in own_totals.items():
        shared_distinct[b] -= v
    return Vocabulary(
        [bytes(r["token"]) for r in known],
        np.array([r["c"] for r in known], np.float64),
        n_own,
        shared,
        sum(r["c"] for r in levels) + n_docs,
        sum(r["v"] for r in levels) + (n_docs > 0),
        n_docs,
        shared_total,
        shared_distinct,
    )


class _Shared:
    """A broadcast vocabulary; each Python worker builds its tables once."""

    def __init__(self, broadcast):
        self.broadcast = broadcast

    def tables(self):
        return _tables(self.broadcast)


_TABLES: dict[int, tuple] = {}


def _tables(broadcast):
    key = id(broadcast.value)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = (broadcast.value, broadcast.value.tables())
    return _TABLES[key][1]


def encode(docs: DataFrame, held_out: Column, vocabulary: Vocabulary) -> DataFrame:
    """One row per document: classes of its tokens (16-bit), sums over the tokens of the
    dictionary, and its other tokens with their numbers."""
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.broadcast.value
        number, classes_of, base_of, share_of = shared.tables()
        n_own, n_shared, end = words.n_own, words.n_shared, words.end_class
        end_base = float(words.base(words.ends))
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows, lengths, known, base, share, classes = [], [], [], [], [], []
                names, numbers, ends = [], [], [0]  # of the other tokens, text after text
                for text in part.column("text").to_pylist():
                    tokens = tokens_of(text)
                    ids = np.fromiter((number.get(t, -1) for t in tokens), np.int64, len(tokens))
                    out = np.empty(len(tokens) + 1, "<u2")
                    out[-1] = end
                    seen = ids >= 0
                    tail: Counter = Counter()
                    if seen.all():
                        out[:-1] = classes_of[ids]
                    else:
                        out[:-1][seen] = classes_of[ids[seen]]
                        other = np.flatnonzero(~seen)
                        unknown = [tokens[i] for i in other]
                        out[:-1][other] = [n_own + 1 + zlib.crc32(t) % n_shared for t in unknown]
                        tail = Counter(unknown)
                        ids = ids[seen]
                    rows.append(row)
                    row += 1
                    lengths.append(len(tokens) + 1)
                    known.append(len(ids) + (words.ends > 0))
                    base.append(float(base_of[ids].sum()) + end_base)
                    share.append(float(share_of[ids].sum()))
                    classes.append(out.tobytes())
                    names += tail.keys()
                    numbers += tail.values()
                    ends.append(len(names))
                pairs = pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(numbers, pa.int64())], ["token", "n"])
                tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                yield pa.record_batch(
                    [
                        pa.array(rows, pa.int64()), part.column("doc_id"), part.column("held_out"),
                        pa.array(lengths, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                        pa.array(share, pa.float64()), pa.array(classes, pa.binary()), tails,
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "share", "classes", "tail"],
                )

    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double,"
        " share double, classes binary, tail array<struct<token:binary,n:bigint>>"
    )
    columns = [F.col("doc_id").cast("bigint"), held_out.alias("held_out"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(work, schema)


@dataclass
class Model:
    start: np.ndarray  # [states]
    move: np.ndarray  # [states, states]
    emit: np.ndarray  # [classes, states]; each column sums to one


def first_model(vocabulary: Vocabulary, states: int, seed: int) -> Model:
    """Class frequencies, shaken differently for each state; states tend to stay."""
    rng = np.random.default_rng(seed)
    weight = np.zeros(vocabulary.n_classes)
    weight[: vocabulary.n_own] = vocabulary.counts[: vocabulary.n_own]
    weight[vocabulary.end_class] = vocabulary.ends
    weight[vocabulary.end_class + 1 :] = vocabulary.shared_total
    weight += SMOOTHING
    emit = weight[:, None] * rng.gamma(1.0, 1.0, (len(weight), states)).clip(0.02)
    emit /= emit.sum(axis=0)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1.0 / states), move, emit)


def _side_by_side(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Chains of falling length as a matrix [step, chain], and how many are active at each step."""
    lengths = np.array([len(c) for c in chains])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    steps = np.zeros((lengths[0], len(chains)), np.int64)
    for i, c in enumerate(chains):
        steps[: len(c), i] = c
    return steps, active


def forward(model: Model, chains: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each chain; memory is that of one step."""
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    lengths = np.array([len(chains[i]) for i in order])
    out = np.zeros(len(chains))
    longest, one = int(lengths[0]), np.ones(len(model.start))
    state = None
    for at in range(0, longest, SEGMENT):  # steps are laid out a segment at a time
        n = int(np.searchsorted(-lengths, -at, side="left"))
        steps, active = _side_by_side([chains[i][at : at + SEGMENT] for i in order[:n]])
        for t, k in enumerate(active):
            seen = model.emit[steps[t, :k]]
            state = model.start * seen if state is None else (state[:k] @ model.move) * seen
            scale = state @ one
            state /= scale[:, None]
            out[:k] += np.log10(scale)
    result = np.empty(len(chains))
    result[order] = out
    return result


class Expectations:
    """Expected counts of one task."""

    def __init__(self, model: Model):
        self.model = model
        states = len(model.start)
        self.start, self.move = np.zeros(states), np.zeros((states, states))
        self.emit = np.zeros_like(model.emit)
        self.likelihood = 0.0

    def _forward(self, chains: list[np.ndarray], at: int, before: np.ndarray | None):
        """Scaled forward states of the segment at ``at``, after those of the step before it."""
        model = self.model
        steps, active = _side_by_side([c[at : at + SEGMENT] for c in chains if len(c) > at])
        seen = model.emit[steps]  # [step, chain, state]
        alpha, scale, one = np.zeros(seen.shape), np.ones(steps.shape), np.ones(len(model.start))
        for t, k in enumerate(active):
            prior, now = alpha[t - 1] if t else before, alpha[t, :k]
            if prior is None:
                now[:] = model.start
            else:
                np.matmul(prior[:k], model.move, out=now)
            now *= seen[t, :k]
            total = now @ one
            now /= total[:, None]
            scale[t, :k] = total
        return steps, active, seen, alpha, scale

    def add(self, chains: list[np.ndarray]) -> None:
        """``chains``: of falling length. Of long ones only the states at the borders of segments
        are kept on the way forward; a segment's are computed again on the way back."""
        model, states = self.model, len(self.model.start)
        places = range(0, len(chains[0]), SEGMENT)
        befores, part = [None], None
        for at in places:
            part = self._forward(chains, at, befores[-1])
            self.likelihood += float(np.log(part[4]).sum())
            befores.append(part[3][-1].copy())
        beta, turned = np.ones((len(chains), states)), np.ascontiguousarray(model.move.T)
        for place in range(len(places) - 1, -1, -1):
            before = befores[place]
            if place < len(places) - 1:
                part = self._forward(chains, places[place], before)
            steps, active, seen, alpha, scale = part
            weights = np.zeros(alpha.shape)
            # From here on, of every step: what it passes back to the one before it.
            back = np.divide(seen, scale[:, :, None], out=seen)
            for t in range(len(active) - 1, -1, -1):
                k = active[t]
                np.multiply(alpha[t, :k], beta[:k], out=weights[t, :k])
                back[t, :k] *= beta[:k]
                back[t, k:] = 0
                if t or before is not None:
                    # A chain whose last step is earlier still has the ones it began with.
                    beta[:k] = back[t, :k] @ turned
            moves = alpha[:-1].reshape(-1, states).T @ back[1:].reshape(-1, states)
            if before is not None:
                moves += before[: active[0]].T @ back[0, : active[0]]
            self.move += moves * model.move
            if before is None:
                self.start += weights[0].sum(axis=0)
            flat, used = steps.ravel(), weights.reshape(-1, states)
            for s in range(states):
                self.emit[:, s] += np.bincount(flat, used[:, s], minlength=len(self.emit))


def groups_of_like_length(chains: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Groups of ``SIDE_BY_SIDE`` chains, of falling length. ``POOL`` tokens are gathered before they are
    dealt, so that few groups run on for the sake of one long chain. A chain counts as 128 more, for
    what an array takes by itself."""

    def dealt():
        waiting.sort(key=len, reverse=True)
        for at in range(0, len(waiting), SIDE_BY_SIDE):
            yield waiting[at : at + SIDE_BY_SIDE]

    waiting: list[np.ndarray] = []
    tokens = 0
    for chain in chains:
        waiting.append(chain)
        tokens += len(chain) + 128
        if tokens >= POOL:
            yield from dealt()
            waiting, tokens = [], 0
    yield from dealt()


def expected_counts(encoded: DataFrame, model: Model) -> DataFrame:
    """Summed over all partitions: a row per class; then rows for moves, start and likelihood."""
    states = len(model.start)
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    names = [f"s{s}" for s in range(states)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Expectations(shared.value)
        for chains in groups_of_like_length(np.frombuffer(d, "<u2") for b in batches for d in b.column("classes").to_pylist()):
            sums.add(chains)
        used = np.flatnonzero(sums.emit.any(axis=1))
        rest = np.vstack([sums.move, sums.start, np.full(states, sums.likelihood)])
        keys = np.concatenate([used, -1 - np.arange(len(rest))])
        values = np.vstack([sums.emit[used], rest])
        yield pa.record_batch(
            [pa.array(keys, pa.int64()), *[pa.array(values[:, s]) for s in range(states)]], names=["key", *names]
        )

    schema = ", ".join(["key bigint", *[f"{n} double" for n in names]])
    rows = encoded.select("classes").mapInArrow(work, schema)
    return rows.groupBy("key").agg(*[F.sum(n).alias(n) for n in names])


def train(
    encoded: DataFrame, vocabulary: Vocabulary, states: int, rounds: int, seed: int = 3
) -> tuple[Model, list[float]]:
    """The model after ``rounds`` of Baum-Welch, and the log-likelihood before each of them."""
    model, seen = first_model(vocabulary, states, seed), []
    for _ in range(rounds):
        table = expected_counts(encoded, model).toArrow()
        keys = table.column("key").to_numpy()
        values = np.column_stack([table.column(f"s{s}").to_numpy() for s in range(states)])
        move, start, emit = np.zeros((states, states)), np.zeros(states), np.zeros_like(model.emit)
        emit[keys[keys >= 0]] = values[keys >= 0]
        for key, value in zip(keys[keys < 0], values[keys < 0]):
            place = -1 - int(key)
            if place < states:
                move[place] = value
            elif place == states:
                start = value
            else:
                seen.append(float(value[0]))
        # As if every state had also emitted PRIOR_TOKENS in the overall proportions.
        overall = emit.sum(axis=1) + SMOOTHING
        emit = emit + PRIOR_TOKENS * overall[:, None] / overall.sum()
        model = Model(
            (start + SMOOTHING) / (start + SMOOTHING).sum(),
            (move + SMOOTHING) / (move + SMOOTHING).sum(axis=1, keepdims=True),
            emit / emit.sum(axis=0),
        )
    return model, seen


def _tail_sums(encoded: DataFrame, totals: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: what the tokens outside the dictionary add."""
    spark = encoded.sparkSession
    within = vocabulary.shared_total + SMOOTHING * (vocabulary.shared_distinct + 1)
    # One row per hashed class, so its size is bounded.
    buckets = F.broadcast(
        spark.createDataFrame([(i, float(w)) for i, w in enumerate(within)], "bucket bigint, within double")
    )
    below = float(vocabulary.total + SMOOTHING * (vocabulary.distinct + 1))
    c, n = F.coalesce("c", F.lit(0)), F.col("n")
    return (
        encoded.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n")
        .join(totals, "token", "left")
        .withColumn("bucket", F.crc32("token") % vocabulary.n_shared)
        .join(buckets, "bucket")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, n).otherwise(0)).alias("tail_known"),
            F.sum(n * F.log10((c + SMOOTHING) / below)).alias("tail_base"),
            F.sum(n * F.log10((c + SMOOTHING) / F.col("within"))).alias("tail_share"),
        )
    )


def score(encoded: DataFrame, totals: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chains = [np.frombuffer(c, "<u2") for c in batch.column("classes").to_pylist()]
            found = np.empty(len(chains))
            # Chains of like length together.
            order = np.argsort([-len(c) for c in chains], kind="stable")
            for at in range(0, len(chains), 4 * SIDE_BY_SIDE):
                part = order[at : at + 4 * SIDE_BY_SIDE]
                found[part] = forward(shared.value, [chains[i] for i in part])
            names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "share"]
            yield pa.record_batch([*map(batch.column, names), pa.array(found, pa.float64())], names=[*names, "chain"])

    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double,"
        " share double, chain double"
    )
    scored = encoded.drop("tail").mapInArrow(work, schema)
    none = F.lit(0.0)
    return scored.join(_tail_sums(encoded, totals, vocabulary), "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", none)).alias("base_score"),
        (F.col("chain") + F.col("share") + F.coalesce("tail_share", none)).alias("score"),
    )


def score_documents(
    docs: DataFrame,
    held_out: Column,
    states: int = STATES,
    rounds: int = ROUNDS,
    own: int = OWN_CLASSES,
    shared: int = SHARED_CLASSES,
    dictionary: int = DICTIONARY,
) -> DataFrame:
    """Train on the rows that are not held out and score all rows."""
    training = docs.where(~held_out)
    totals = stored(token_totals(training), "token-totals")
    vocabulary = learn_vocabulary(totals, training.count(), own, shared, dictionary)
    encoded = stored(encode(docs, held_out, vocabulary), "encoded")
    release(docs.sparkSession)
    model, _ = train(encoded.where("not held_out"), vocabulary, states, rounds)
    return score(encoded, totals, vocabulary, model)
