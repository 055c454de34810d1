"""Language-model scores by logistic mixing of hashed-context bit predictors.

A token is a word in lower case, or the end of a text. Its hash gives it a class of some bits, and
its probability is that of its class in the context, times its share of the class's training
tokens. The class is predicted bit by bit: each of several contexts (none, the last token, the one
before it, both) finds by hashing how often the bit has been zero and one there. The predictors'
logits are added by weights from a gate that knows the bit and how much two of the contexts have
seen, and the mixed probability is refined by what came of such predictions before.

Learning is distributed. Counts of words, and counts of bits by context, are summed over all
training texts. Then every bundle of training texts is gone through once more: each bit is predicted
from the counts without the bit itself, and the weights follow the error; the bundles' weights are
averaged and their refinements' counts summed. The bit counts, weights and refinements have a
fixed size; the words' counts stay distributed and meet the texts by blocks (see ``windows``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.arrow import slices
from tableflow.llm.windows import BUNDLE_BYTES, BUNDLES_A_SHARD, U, Texts, _blocks, as_words, \
    equal_groups, gathered, in_order, mixed, shard_of, squeezed, unsqueezed, word_hashes, word_heads
from tableflow.scratch import ship_package, unique, written

#: Bits of a class, bits of a table's index, tables by hashed context.
CLASS_BITS = 8
SLOT_BITS = 19
TABLES = 3
CLASSES = 1 << CLASS_BITS
#: Classes of what a context has seen, by which the gate chooses weights.
SEEN = np.digitize(np.arange(64), [1, 2, 4, 8, 32])
LEVELS = 6
#: Steps of a logit in the refinement, and the logit's range.
STEPS, RANGE = 33, 8.0
INPUTS = TABLES + 2
CHUNK = 1 << 14
#: Tokens whose bits are counted at once.
COUNTED = 1 << 17
RATE = 0.02
#: Text that a task looks at at once (a document at least).
SLICE_BYTES = 2 << 20
#: The bundles' mixers are joined in so many tasks before the driver joins the rest.
JOINED = 16
#: The bit counts are summed up in so many blocks.
PARTS = 64

END = U(0x2545F4914F6CDD1D)
_START, _BEFORE, _STEP, _SPREAD = U(0x632BE59BD9B4E019), U(0x8CB92BA72F3D8DD7), \
    U(0x9E6C63D0876A9A35), U(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def lower_words(column: pa.Array) -> Texts:
    split = as_words(column)
    return Texts(_LOWER[split.data], split.documents, split.words)


@dataclass
class Tokens:
    """The tokens of texts, each followed by its end."""

    hashes: np.ndarray
    offsets: np.ndarray  # each text's first token, and the end
    texts: Texts
    words: np.ndarray  # the words' hashes, without the ends

    @property
    def classes(self) -> np.ndarray:
        return (self.hashes >> U(64 - CLASS_BITS)).astype(np.int64)

    def contexts(self) -> list[np.ndarray]:
        last = np.concatenate([[_START], self.hashes[:-1]]).astype(np.uint64)
        before = np.concatenate([[_BEFORE, _BEFORE], self.hashes[:-2]]).astype(np.uint64)
        before = before[:len(last)]
        starts = self.offsets[:-1]
        before[starts[starts + 1 < len(last)] + 1] = _BEFORE
        last[starts] = _START
        before[starts] = _BEFORE
        return [mixed(last), mixed(before ^ _STEP), mixed(last * _STEP + before)]


def tokens(column: pa.Array) -> Tokens:
    texts = lower_words(column)
    first, last = texts.words
    words = word_hashes(texts.data, first, last)
    hashes = np.insert(words, texts.documents[1:], END)
    return Tokens(hashes, texts.documents + np.arange(len(texts.documents)), texts, words)


#: Told apart by these, a context's slots for the nodes lie all over a table.
_NODE = (mixed(np.arange(1, CLASSES + 1, dtype=np.uint64)) >> U(64 - SLOT_BITS)).astype(np.int64)


def places(context: np.ndarray) -> np.ndarray:
    """Where the slots of a context lie in a table, up to the node."""
    return (context >> U(64 - SLOT_BITS)).astype(np.int64)


def paths(classes: np.ndarray, contexts: list[np.ndarray]
          ) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each level: the node of the tree of classes, the bit taken there, and the slots."""
    for level in range(CLASS_BITS):
        left = CLASS_BITS - level
        node = (1 << level) | classes >> left
        spread = np.take(_NODE, node, mode="clip")
        yield level, node, classes >> (left - 1) & 1, [one ^ spread for one in contexts]


def no_counts() -> list[np.ndarray]:
    """Zeros and ones by node, and by slot of each table."""
    return [np.zeros((CLASSES, 2), np.uint32)] + \
        [np.zeros((1 << SLOT_BITS, 2), np.uint32) for _ in range(TABLES)]


def count(counts: list[np.ndarray], own: Tokens) -> None:
    """Add the tokens' bits to the counts."""
    classes, contexts = own.classes, [places(context) for context in own.contexts()]
    for low in range(0, len(classes), COUNTED):
        part = slice(low, low + COUNTED)
        cells: list[list[np.ndarray]] = [[] for _ in counts]
        for _, node, bit, slots in paths(classes[part], [one[part] for one in contexts]):
            for held, at in zip(cells, [node, *slots]):
                held.append(2 * at + bit)
        for table, held in zip(counts, cells):
            more = np.bincount(np.concatenate(held), minlength=table.size)
            table += more.astype(np.uint32).reshape(-1, 2)


class Predictors:
    """The counts as logits, and how much their contexts have seen, ready to be looked up."""

    def __init__(self, counts: list[np.ndarray]):
        self.logits, self.without, self.seen, self.seen_without = [], [], [], []
        for table in counts:
            zeros, ones = table[:, 0].astype(np.float32), table[:, 1].astype(np.float32)
            self.logits.append(np.log((ones + 0.4) / (zeros + 0.4)))
            self.without.append(np.stack([  # without an occurrence of a zero, or of a one
                np.log((ones + 0.4) / (np.maximum(zeros - 1, 0) + 0.4)),
                np.log((np.maximum(ones - 1, 0) + 0.4) / (zeros + 0.4))], axis=1).reshape(-1))
            total = table.sum(axis=1)
            self.seen.append(SEEN[np.minimum(total, 63)].astype(np.uint8))
            self.seen_without.append(SEEN[np.clip(total.astype(np.int64) - 1, 0, 63)]
                                     .astype(np.uint8))

    def look_up(self, level: int, node: np.ndarray, slots: list[np.ndarray],
                bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The inputs (one row for each) and the gate; with ``bit``, without that occurrence.

        All indexes are within their tables; ``mode`` spares the lookups a check and a copy.
        """
        inputs = np.empty((INPUTS, len(node)), np.float32)
        seen = []
        for i, at in enumerate([node, *slots]):
            if bit is None:
                np.take(self.logits[i], at, out=inputs[i], mode="clip")
            else:
                np.take(self.without[i], at + at + bit, out=inputs[i], mode="clip")
            if i in (1, TABLES):
                held = self.seen if bit is None else self.seen_without
                seen.append(np.take(held[i], at, mode="clip"))
        inputs[-1] = 1
        gate = (seen[0] * np.uint8(LEVELS) + seen[1]).astype(np.int64)
        gate += level * LEVELS * LEVELS
        return inputs, gate


@dataclass
class Mixer:
    """Weights by input and gate, and the refinement's predictions and ones by node and step."""

    weights: np.ndarray
    squares: np.ndarray
    seen: np.ndarray
    ones: np.ndarray
    learnt: int = 0

    @staticmethod
    def new() -> "Mixer":
        gates = CLASS_BITS * LEVELS * LEVELS
        weights = np.full((INPUTS, gates), 0.35, np.float32)
        weights[-1] = 0
        steps = np.linspace(-RANGE, RANGE, STEPS)
        prior = np.tile(1 / (1 + np.exp(-steps)), (CLASSES, 1))
        return Mixer(weights, np.zeros((INPUTS, gates), np.float32), np.full(prior.shape, 16.0),
                     16.0 * prior)

    def logit(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        found = np.take(self.weights[0], gate, mode="clip")
        found *= inputs[0]
        for i in range(1, INPUTS):
            part = np.take(self.weights[i], gate, mode="clip")
            part *= inputs[i]
            found += part
        return found

    @staticmethod
    def _steps(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The step below a logit, and how far it is to the next one."""
        at = logit * np.float32((STEPS - 1) / (2 * RANGE))
        at += np.float32((STEPS - 1) / 2)
        np.clip(at, 0, np.float32(STEPS - 1.001), out=at)
        low = np.floor(at)
        at -= low
        return low.astype(np.int64), at

    @staticmethod
    def _chance(logit: np.ndarray) -> np.ndarray:
        found = np.negative(logit)
        np.exp(found, out=found)
        found += np.float32(1)
        return np.reciprocal(found, out=found)

    def learn(self, predictors: Predictors, own: Tokens) -> None:
        """Follow the errors of the predictions, some tokens at a time."""
        classes, contexts = own.classes, [places(context) for context in own.contexts()]
        gates, size = LEVELS * LEVELS, CLASSES * STEPS
        for low in range(0, len(classes), CHUNK):
            part = slice(low, low + CHUNK)
            cells, taken = [], []
            for level, node, bit, slots in paths(classes[part], [one[part] for one in contexts]):
                inputs, gate = predictors.look_up(level, node, slots, bit)
                logit = self.logit(inputs, gate)
                error = bit - self._chance(logit)
                own = slice(level * LEVELS * LEVELS, (level + 1) * LEVELS * LEVELS)
                gate -= own.start
                many = np.maximum(np.bincount(gate, minlength=gates), 1)
                steps = np.stack([np.bincount(gate, error * inputs[i], gates) / many
                                  for i in range(INPUTS)]).astype(np.float32)
                self.squares[:, own] += steps * steps
                self.weights[:, own] += RATE * steps / np.sqrt(self.squares[:, own] + 1e-6)
                at, above = self._steps(logit)
                at += above > 0.5
                at += node * STEPS
                cells.append(at)
                taken.append(bit)
            cells = np.concatenate(cells)
            self.seen += np.bincount(cells, minlength=size).reshape(CLASSES, STEPS)
            self.ones += np.bincount(cells, np.concatenate(taken), size).reshape(CLASSES, STEPS)
        self.learnt += len(classes)

    def scores(self, predictors: Predictors, own: Tokens) -> np.ndarray:
        """The log2 probability of each token's class."""
        classes, contexts = own.classes, [places(context) for context in own.contexts()]
        found = np.ones(len(classes))
        refined = (self.ones / self.seen).reshape(-1)
        rises = np.append(np.diff(refined), 0).astype(np.float32)
        refined = refined.astype(np.float32)
        for low in range(0, len(classes), CHUNK):
            part = slice(low, low + CHUNK)
            for level, node, bit, slots in paths(classes[part], [one[part] for one in contexts]):
                inputs, gate = predictors.look_up(level, node, slots, None)
                logit = self.logit(inputs, gate)
                at, above = self._steps(logit)
                at += node * STEPS
                chance = np.take(refined, at, mode="clip")
                above *= np.take(rises, at, mode="clip")
                chance += above
                chance += self._chance(logit)
                chance *= np.float32(0.5)
                np.clip(chance, np.float32(1e-6), np.float32(1 - 1e-6), out=chance)
                found[part] *= np.abs(1 - bit - chance)
        return np.log2(found)


# --- words' counts, by blocks ---------------------------------------------------------------


def _distinct(own: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Each word's group and each group's first word."""
    first, last = own.texts.words
    return equal_groups(own.words, word_heads(own.texts.data, first, last))


def _by_shard(own: Tokens, example: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """The groups of each shard, in their order."""
    shard = shard_of(own.words[example], shards)
    order = np.argsort(shard, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
    return [(int(shard[part[0]]), part) for part in parts if len(part)]


def _sent_words(table: pa.Table, shards: int) -> pa.Table:
    at = table.column("bundle")[0].as_py()
    table = in_order(table)
    own = tokens(table.column("text"))
    group, example = _distinct(own)
    sizes = np.diff(own.texts.documents)
    train = np.repeat(np.asarray(table.column("train")), sizes)
    counts = np.bincount(group[train], minlength=len(example))
    first, last = own.texts.words
    return _blocks(at, {shard: squeezed(
        (last - first)[example[part]].astype(np.uint32), counts[part].astype(np.uint32),
        gathered(own.texts.data, first[example[part]], last[example[part]]))
        for shard, part in _by_shard(own, example, shards)})


def _summed_words(table: pa.Table) -> pa.Table:
    """Each word's count over all bundles, to each bundle; the first row has the classes' sums."""
    blocks = [unsqueezed(block.as_py()) for block in table.column("block")]
    sizes = np.concatenate([block[0] for block in blocks]).astype(np.int64)
    counts = np.concatenate([block[1] for block in blocks]).astype(np.int64)
    data, ends = np.concatenate([block[2] for block in blocks]), np.cumsum(sizes)
    first = word_hashes(data, ends - sizes, ends)
    group, example = equal_groups(first, word_heads(data, ends - sizes, ends))
    total = np.zeros(len(example), np.int64)
    np.add.at(total, group, counts)
    classes = (first[example] >> U(64 - CLASS_BITS)).astype(np.int64)
    known = total > 0
    sums = [np.bincount(classes, total, CLASSES).astype(np.int64),
            np.bincount(classes[known], minlength=CLASSES)]
    found = total[group]
    starts = np.cumsum([0] + [len(block[0]) for block in blocks])
    none = [None] * (len(blocks) - 1)
    return pa.table({
        "bundle": table.column("bundle"), "shard": table.column("shard"),
        "block": pa.array([squeezed(found[a:b]) for a, b in zip(starts[:-1], starts[1:])],
                          pa.binary()),
        "tokens": pa.array([sums[0].tolist(), *none], pa.list_(pa.int64())),
        "kinds": pa.array([sums[1].tolist(), *none], pa.list_(pa.int64()))})


# --- the fixed-size model -------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, some = no_counts(), False
    for batch in batches:
        for piece in slices(batch, "text", SLICE_BYTES) if batch.num_rows else ():
            count(counts, tokens(piece.column("text")))
            some = True
    if some:
        for part, block in enumerate(np.array_split(np.concatenate(counts).reshape(-1), PARTS)):
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()),
                "block": pa.array([squeezed(block)], pa.binary())})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, block in zip(batch.column("part").to_pylist(), batch.column("block")):
            own = unsqueezed(block.as_py())[0].astype(np.int64)
            sums[part] = sums[part] + own if part in sums else own
    for part, block in sums.items():
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                          "block": pa.array([squeezed(block)], pa.binary())})


def bit_counts(train: DataFrame) -> list[np.ndarray]:
    """The bit counts over all training texts: an array of fixed size from every task, summed."""
    rows = train.select("text").mapInArrow(_counted, "part int, block binary") \
        .repartition(PARTS, "part").mapInArrow(_summed, "part int, block binary").collect()
    if not rows:
        return no_counts()
    flat = np.concatenate([unsqueezed(row["block"])[0] for row in sorted(rows)])
    bounds = np.cumsum([table.size for table in no_counts()])[:-1]
    return [part.reshape(-1, 2) for part in np.split(fitted(flat.reshape(-1, 2)).reshape(-1),
                                                     bounds)]


def fitted(pairs: np.ndarray) -> np.ndarray:
    """Zeros and ones in 32 bits: a pair with a larger count is halved until it fits."""
    most = pairs.max(axis=1, keepdims=True)
    halved = pairs.copy()
    while (over := most >= 1 << 32).any():
        halved = np.where(over, halved >> 1, halved)
        most = np.where(over, most >> 1, most)
    return halved.astype(np.uint32)


_ready: dict[str, Predictors] = {}


def _predictors(counts, name: str) -> Predictors:
    """The predictors of a broadcast of counts, made once in each worker."""
    if name not in _ready:
        _ready.clear()
        _ready[name] = Predictors(counts.value)
    return _ready[name]


def _joined(mixers: Iterator[Mixer]) -> Mixer | None:
    """One mixer of many: weights by the tokens learnt from, the refinements' counts added."""
    found = None
    start = Mixer.new()
    for mixer in mixers:
        if found is None:
            found = mixer
            continue
        both = found.learnt + mixer.learnt
        share = np.float32(mixer.learnt / max(both, 1))
        found.weights = found.weights * (1 - share) + mixer.weights * share
        found.seen += mixer.seen - start.seen
        found.ones += mixer.ones - start.ones
        found.learnt = both
    return found


def _joined_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = _joined(pickle.loads(one.as_py()) for batch in batches
                    for one in batch.column("mixer"))
    if found is not None:
        yield pa.RecordBatch.from_pydict({
            "salt": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "bundle": pa.array([0], pa.int64()),
            "mixer": pa.array([pickle.dumps(found)], pa.binary())})


def mixing_weights(train: DataFrame, counts, name: str) -> Mixer:
    """The mixer learnt from all training texts by their bundles, with a broadcast of their counts.

    Bundles learn on their own and are joined in their order, so the result doesn't depend on how
    the table was split into tasks.
    """
    def learn(table: pa.Table) -> pa.Table:
        mixer, predictors = Mixer.new(), _predictors(counts, name)
        bundle, table = table.column("bundle")[0].as_py(), in_order(table)
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for piece in slices(batch, "text", SLICE_BYTES):
                mixer.learn(predictors, tokens(piece.column("text")))
        mixer.squares = mixer.squares[:0]
        return pa.table({"salt": pa.array([bundle % JOINED], pa.int32()),
                         "bundle": pa.array([bundle], pa.int64()),
                         "mixer": pa.array([pickle.dumps(mixer)], pa.binary())})

    schema = "salt int, bundle long, mixer binary"
    rows = train.select("bundle", "doc_id", "text").groupBy("bundle").applyInArrow(learn, schema) \
        .repartition(JOINED, "salt").sortWithinPartitions("salt", "bundle") \
        .mapInArrow(_joined_batches, schema).collect()  # JOINED at the most
    ordered = sorted(rows, key=lambda row: row["salt"])
    return _joined(pickle.loads(row["mixer"]) for row in ordered) or Mixer.new()


# --- scores ---------------------------------------------------------------------------------

FIELDS = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, bits_per_byte double")


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Every text's score by the unigram base and by the model (log10), learnt from the other folds.

    Training texts are those whose ``crc32(doc_id as text) mod 5`` isn't 1. A null id counts as
    empty text (so it trains); a null text is empty and has its end alone. Without any training
    token all tokens are unknown. Repeated rows are rows of their own. ``bits_per_byte`` is the
    model's, over the text's bytes (null for an empty text).
    """
    spark = docs.sparkSession
    ship_package(spark)
    number = docs[f"`{doc_id}`"].cast("long")
    rows = docs.select(number.alias("doc_id"), docs[f"`{text}`"].alias("text"),
                       (F.crc32(F.coalesce(number.cast("string"), F.lit("")).cast("binary")) % 5
                        != 1).alias("train"))
    size, texts_learnt = rows.agg(F.sum(F.octet_length("text")),
                                  F.sum(F.col("train").cast("long"))).first()
    bundles = max(1, -(-(size or 0) // bundle_bytes))
    shards = -(-bundles // BUNDLES_A_SHARD)
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "text"), F.lit(bundles)))
    by_bundle = rows.groupBy("bundle")
    schema = "bundle long, shard long, block binary"
    words = written(by_bundle.applyInArrow(lambda table: _sent_words(table, shards), schema)
                    .groupBy("shard").applyInArrow(
                        _summed_words, schema + ", tokens array<long>, kinds array<long>"), "words")
    sums = words.where("tokens is not null") \
        .select(F.posexplode(F.arrays_zip("tokens", "kinds")).alias("class", "n")) \
        .groupBy("class").agg(F.sum("n.tokens"), F.sum("n.kinds")).collect()  # a row for each class
    class_tokens, class_kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for at, n_tokens, n_kinds in sums:
        class_tokens[at], class_kinds[at] = n_tokens, n_kinds
    ends = texts_learnt or 0
    class_tokens[int(END >> U(64 - CLASS_BITS))] += ends
    class_kinds[int(END >> U(64 - CLASS_BITS))] += bool(ends)
    train_tokens, kinds = int(class_tokens.sum()), int(class_kinds.sum())

    train = rows.where("train")
    counts, name = spark.sparkContext.broadcast(bit_counts(train)), unique("counts")
    mixer = spark.sparkContext.broadcast(mixing_weights(train, counts, name))

    def score(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        table = in_order(table)
        own = tokens(table.column("text"))
        group, example = _distinct(own)
        answers = dict(zip(told.column("shard").to_pylist(), told.column("block")))
        known = np.zeros(len(example), np.int64)
        for shard, part in _by_shard(own, example, shards):
            known[part] = unsqueezed(answers[shard].as_py())[0]
        offsets = own.offsets
        c = np.insert(known[group], own.texts.documents[1:], ends)
        base = np.log10((c + 0.5) / (train_tokens + 0.5 * (kinds + 1)))
        classes = own.classes
        within = np.log2((c + 0.5) / (class_tokens[classes] + 0.5 * (class_kinds[classes] + 1)))
        bits = mixer.value.scores(_predictors(counts, name), own) + within
        total = np.add.reduceat(bits, offsets[:-1])
        sizes = np.asarray(pc.binary_length(
            table.column("text").cast(pa.large_string()).fill_null(""))).astype(np.int64)
        return pa.table({
            "doc_id": table.column("doc_id"),
            "held_out": pa.array(~np.asarray(table.column("train"))),
            "n_tokens": pa.array(np.diff(offsets)),
            "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), offsets[:-1])),
            "train_tokens": pa.array(np.full(len(table), train_tokens)),
            "base_score": pa.array(np.add.reduceat(base, offsets[:-1])),
            "score": pa.array(total * np.log10(2.0)),
            "bits_per_byte": pa.array(-total / np.maximum(sizes, 1), mask=sizes == 0)})

    return by_bundle.cogroup(words.select("bundle", "shard", "block").groupBy("bundle")) \
        .applyInArrow(score, FIELDS)
