"""Language-model scores of whole texts, beside a unigram base score.

One pass reads every document. A task keeps its documents in blocks, gives each word of a block its subword
ids once, and stores each document's ids and its words as numbers within the block; the block's words lie in
``CELLS`` rows, by a hash of the word. All else works on these stored rows.

Everything counted covers all training documents: words, subword ids, and pairs of a subword's class and the next
id. The counts give the id classes, the shares of ids within classes, and the first logits of
the attention model (``attention.py``).

Its other weights are trained in numpy. A first model learns from ``WARM`` documents; then
trainers, one for each ``TRAINER_WORDS`` tokens of the corpus, go on from it, each over its own share of the
training documents, and their weights are averaged in a tree. Every training document is learned from.

The base score moves no word as a row of its own: a task counts the words of whole cells over all blocks and
gives each block its words' counts, and these meet the numbered words of the block's documents. A frequent word
is one entry in a row for each block.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm import attention
from quotelake.llm.attention import Classes, Weights
from quotelake.llm.common import LOWER, id_remainder, stored, text_of
from quotelake.llm.subwords import ByteWords, tokenizer_path

FOLDS, HELD_OUT = 7, 2
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Bytes of text and documents of a block, about.
BLOCK_BYTES = 8_000_000
BLOCK_DOCS = 16_384

#: Rows that a block's words are dealt to, by their hash.
CELLS = 4096

WARM = 800
WARM_ROUNDS = 3
TRAINER_WORDS = 1_000_000
RATE = 0.02

#: Ids whose counts after each class are kept; the others follow their share of the class.
PAIRED = 4096

#: Weight of an id's share of its class against its counts after the class before it.
BACKOFF = 5.0

#: Subword ids scored at a time, about.
SCORED_IDS = 1_000_000

#: Rows of documents, with their subword ids and the numbers of their words; and rows of words, each followed by
#: a blank, with their counts in the block's training documents. Numbers follow the rows of words in order of cell.
BLOCKS = (
    "block long, doc int, doc_id long, held_out boolean, n_tokens long, ids binary, numbers binary, cell int, words binary, n binary"
)

#: Lower-cases A-Z and turns the white space that ``bytes.split`` knows into blanks.
_PLAIN = LOWER.translate(bytes.maketrans(b"\t\n\v\f\r", b"     "))


def _sliced(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary array of runs of ``values``."""
    ends = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def _words(joined: np.ndarray) -> pa.DictionaryArray:
    """The words of bytes in which each word is followed by one blank; numbers in order of first appearance."""
    ends = np.append(0, np.flatnonzero(joined == 32) + 1).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(joined)])
    return found.dictionary_encode()


def _spelled(words: pa.BinaryArray) -> tuple[bytes, np.ndarray]:
    """All words in one, and where each begins."""
    if not len(words):
        return b"", np.zeros(0, np.int32)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
    return words.buffers()[2][ends[0] : ends[-1]].to_pybytes(), ends[:-1] - ends[0]


def _split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased words of all texts, each followed by a blank, and how many each text has."""
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_PLAIN), np.uint8)
    space = data == 32
    end = space.copy()
    end[:1] = False
    end[1:] &= ~space[:-1]
    of_texts = np.cumsum([len(t) + 1 for t in texts]) - 1
    before = np.searchsorted(np.flatnonzero(end), of_texts, side="right")
    return data[end | ~space], np.diff(before, prepend=0)


def _ragged(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of an array of sequences, and the length of each."""
    parts = column.to_pylist()
    return (
        np.frombuffer(b"".join(parts), kind).astype(np.int64),
        np.array([len(p) for p in parts], dtype=np.int64) // np.dtype(kind).itemsize,
    )


def _summed(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums of partial (key, n); the keys are bounded by the vocabulary."""
    rows = frame.groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    rows = rows.sort_values("key")
    return rows["key"].to_numpy(np.int64), rows["n"].to_numpy(np.float64)


def _totals(sequences: DataFrame, size: int, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """How often each key below ``size`` comes up in the id sequences. A task counts its own; Spark adds them up."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(keys(*_ragged(batch.column(0), "<u2")), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["key", "n"])

    at, n = _summed(sequences.select("ids").mapInArrow(counted, "key long, n long"))
    found = np.zeros(size)
    found[at] = n
    return found


class Pairs:
    """Counts of ids after fine classes, class 0 standing for the begin of a text. Of the rarer ids only their
    class is counted."""

    def __init__(self, counts: np.ndarray, places: np.ndarray, classes: Classes):
        m, n = classes.sizes
        self.places, self.classes = places, classes
        #: by class before and id: the paired ids, then the coarse classes of all others
        self.counts = counts.reshape(m, PAIRED + n)

    @staticmethod
    def places_of(id_counts: np.ndarray, classes: Classes) -> np.ndarray:
        """Column of each id in the counts."""
        order = np.lexsort((np.arange(len(id_counts)), -id_counts))[:PAIRED]
        found = PAIRED + classes.coarse.astype(np.int64)
        found[order] = np.arange(len(order))
        return found

    def log_shares(self) -> np.ndarray:
        """log10 probability of an id within its coarse class, by the class before it and the id's column; for
        the columns of classes only the factor on the id's share."""
        m, n = self.classes.sizes
        paired = self.places < PAIRED
        coarse, share = np.zeros(PAIRED, np.int64), np.ones(PAIRED)
        coarse[self.places[paired]] = self.classes.coarse[paired]
        share[self.places[paired]] = self.classes.share[paired]
        of_class = self.of_class()
        found = np.zeros((m, PAIRED + n))
        found[:, :PAIRED] = (self.counts[:, :PAIRED] + BACKOFF * share) / (of_class[:, coarse] + BACKOFF)
        # the rest of a class is spread over the other ids by their shares
        own = np.bincount(self.classes.coarse[~paired], self.classes.share[~paired], n)
        rest = (self.counts[:, PAIRED:] + BACKOFF * own) / (of_class + BACKOFF)
        found[:, PAIRED:] = rest / np.where(own > 0, own, 1)
        return np.log10(np.maximum(found, 1e-30)).astype(np.float32)

    def of_class(self) -> np.ndarray:
        n = self.classes.sizes[1]
        paired = self.places < PAIRED
        member = np.zeros((PAIRED, n))
        member[self.places[paired], self.classes.coarse[paired]] = 1
        return self.counts[:, :PAIRED] @ member + self.counts[:, PAIRED:]

    def first_logits(self, texts: int) -> np.ndarray:
        """log probability of the next coarse class after each fine one, by the counts."""
        after = self.of_class()
        overall = after.sum(axis=0) + 1
        after = after + overall / overall.sum() + 1e-3
        # texts end about as often after any class
        after[:, 0] = (texts + 1) / (after.sum() + texts + 1) * after.sum(axis=1)
        return np.log(after / after.sum(axis=1, keepdims=True)).astype(np.float32)


def _before(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The value before each one in its sequence; 0 before the first."""
    found = np.zeros(len(values), dtype=np.int64)
    found[1:] = values[:-1]
    found[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return found


def count_pairs(sequences: DataFrame, id_counts: np.ndarray, classes: Classes) -> Pairs:
    fine, places = classes.fine.astype(np.int64), Pairs.places_of(id_counts, classes)
    m, width = classes.sizes[0], PAIRED + classes.sizes[1]

    def keys(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return _before(fine[ids], lengths) * width + places[ids]

    return Pairs(_totals(sequences, m * width, keys), places, classes)


def train_model(
    training: DataFrame, texts: int, tokens: int, first: Weights, classes: Classes
) -> Weights:
    """Warm start on a bounded sample, then averaged trainers whose number grows with the tokens."""
    sizes, fine, coarse_of = classes.sizes, classes.fine, classes.coarse_of

    def learned(w: Weights, sequences: list[bytes], rounds: int, rate: float, seed: int) -> Weights:
        own = [fine[np.frombuffer(ids, "<u2")] for ids in sorted(map(bytes, sequences))]
        return attention.train(w, own, coarse_of, rounds, rate, seed)[0]

    # a hash range that holds about twice as many texts as are wanted, so that no task hands on many
    range_size = 1 << 31
    near = training.withColumn("at", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(range_size))).filter(
        F.col("at") < min(range_size, -(-2 * WARM * range_size // max(1, texts)))
    )
    sample = near.orderBy("at", "ids").limit(WARM).select("ids").collect()
    warm = learned(first, [r.ids for r in sample], WARM_ROUNDS, RATE, 0)
    data = warm.dump()
    trainers = max(1, -(-tokens // TRAINER_WORDS))

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = [ids for batch in batches for ids in batch.column(0).to_pylist()]
        if sequences:
            number = TaskContext.get().partitionId() % trainers
            own = learned(Weights.load(data, sizes), sequences, 1, RATE / 2, number)
            yield pa.RecordBatch.from_pydict(
                {"trainer": [number], "weight": [float(len(sequences))], "model": [own.dump()]}
            )

    def averaged(models: pa.Table) -> pa.Table:
        weight = np.array(models.column("weight").to_pylist())
        sums = sum(w * np.frombuffer(m, "<f4").astype(np.float64)
                   for w, m in zip(weight, models.column("model").to_pylist(), strict=True))
        mean = (sums / weight.sum()).astype("<f4").tobytes()
        group = models.column("trainer")[0].as_py()
        return pa.table({"trainer": [group], "weight": [float(weight.sum())], "model": [mean]})

    schema = "trainer long, weight double, model binary"
    # the row's place takes part, so null or repeated ids and texts spread over all trainers
    share = F.xxhash64("doc_id", "ids", "block", "doc", F.lit("trainer"))
    models = training.repartition(trainers, share).select("ids").mapInArrow(trained, schema)
    while trainers > 1:
        models = stored(models, "trained").withColumn("trainer", F.floor(F.col("trainer") / 64))
        models = models.groupBy("trainer").applyInArrow(averaged, schema)
        trainers = -(-trainers // 64)
    last = models.collect()
    return Weights.load(bytes(last[0].model), sizes) if last else warm


def _in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows (doc_id, held_out, text) of about ``BLOCK_BYTES`` together, at least one."""
    pending, size, rows = [], 0, 0
    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)), 0
        while at < len(batch):
            before = int(ends[at - 1]) if at else 0
            stop = int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1
            stop = min(stop, len(batch), at + BLOCK_DOCS - rows)
            pending.append(batch.slice(at, stop - at))
            size, rows, at = size + int(ends[stop - 1]) - before, rows + stop - at, stop
            if size >= BLOCK_BYTES or rows >= BLOCK_DOCS:
                yield pa.Table.from_batches(pending)
                pending, size, rows = [], 0, 0
    if pending:
        yield pa.Table.from_batches(pending)


def _block_rows(number: int, docs: pa.Table, coder: ByteWords) -> Iterator[pa.RecordBatch]:
    """Rows of ``BLOCKS``."""
    joined, n_words = _split([t or b"" for t in docs.column("text").cast(pa.large_binary()).to_pylist()])
    words = _words(joined)
    vocabulary, words = words.dictionary, words.indices.to_numpy()
    cells = np.fromiter(map(zlib.crc32, _spelled(vocabulary)[0].split(b" ")[:-1]), np.uint32, len(vocabulary)) % CELLS
    order = np.argsort(cells.astype(np.uint16), kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    vocabulary, words = vocabulary.take(pa.array(order)), place[words]
    spelled, begin = _spelled(vocabulary)

    ids, size = coder.ids(spelled)
    start, sizes = np.cumsum(size) - size, size[words]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = np.repeat(start[words] - ends[:-1], sizes) + np.arange(ends[-1])
    last, held = np.cumsum(n_words), docs.column("held_out").to_numpy()
    yield _rows(
        number, len(docs), doc=pa.array(np.arange(len(docs), dtype=np.int32)), doc_id=docs.column("doc_id").combine_chunks(),
        held_out=pa.array(held), n_tokens=pa.array(n_words + 1),
        ids=_sliced(ids.astype("<u2")[at], ends[last - n_words]), numbers=_sliced(words.astype("<u4"), last - n_words),
    )
    if not len(words):
        return
    cells = cells[order]
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    n = np.bincount(words[np.repeat(~held, n_words)], minlength=len(order))
    yield _rows(
        number, len(first), cell=pa.array(cells[first].astype(np.int32)),
        words=_sliced(np.frombuffer(spelled, np.uint8), begin[first]), n=_sliced(n.astype("<u4"), first),
    )


def _rows(number: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"doc": pa.int32(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "ids": pa.binary(),
             "numbers": pa.binary(), "cell": pa.int32(), "words": pa.binary(), "n": pa.binary()}
    arrays = [columns.get(c, pa.nulls(size, t)) for c, t in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, number)), *arrays], names=["block", *kinds])


def document_blocks(docs: DataFrame, path: str) -> DataFrame:
    """Rows of ``BLOCKS``."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, first = ByteWords(path), TaskContext.get().partitionId() << 24
        for number, block in enumerate(_in_blocks(batches), first):
            yield from _block_rows(number, block, coder)

    return docs.select("doc_id", "held_out", "text").mapInArrow(blocks, BLOCKS)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(block, cell, counts, kinds): how often each word of a row of words comes up in all training documents, in the
    row's order. The ``kinds`` add up to the number of words that do."""

    def counted(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, cell, words, n = pa.Table.from_batches(rows).combine_chunks().columns
        n, lengths = _ragged(n.combine_chunks(), "<u4")
        words = _words(np.frombuffer(b"".join(words.to_pylist()), np.uint8))
        of_word = words.indices.to_numpy()
        total = np.bincount(of_word, n, len(words.dictionary)).astype("<u8")
        kinds = np.zeros(len(lengths), np.int64)
        kinds[0] = np.count_nonzero(total)
        return pa.RecordBatch.from_arrays(
            [block.combine_chunks(), cell.combine_chunks(), _sliced(total[of_word], np.cumsum(lengths) - lengths), pa.array(kinds)],
            names=["block", "cell", "counts", "kinds"],
        )

    def whole_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in filter(len, batches):
            cells = batch.column(1).to_numpy()
            begun = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on in the next batch
            if begun or cells[-1] != last:
                held.append(batch.slice(0, begun))
                if sum(map(len, held)):
                    yield counted(held)
                held = []
            held.append(batch.slice(begun))
            last = cells[-1]
        if held:
            yield counted(held)

    cells = blocks.filter(F.col("cell").isNotNull()).select("block", "cell", "words", "n")
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        whole_cells, "block long, cell int, counts binary, kinds long"
    )


def model_scores(rows: DataFrame, weights: Weights, pairs: Pairs) -> DataFrame:
    """``rows`` (block, doc, doc_id, held_out, n_tokens, ids) with the log10 probability of each text, without ids."""
    classes = pairs.classes
    shared = rows.sparkSession.sparkContext.broadcast(
        (weights.dump(), pairs.log_shares(), pairs.places, classes.fine, classes.coarse_of, classes.share)
    )

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, shares, places, *of_ids = shared.value
        classes = Classes(*of_ids)
        weights, width = Weights.load(data, classes.sizes), shares.shape[1]
        shares = shares.ravel()
        # rarer ids: the factor of their class times their own share
        own = np.where(places >= PAIRED, np.log10(classes.share), 0).astype(np.float32)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]) // 2
            parts = np.flatnonzero(np.diff(np.cumsum(sizes) // SCORED_IDS, prepend=0)) if len(sizes) else []
            for begin, end in zip([0, *parts], [*parts, len(batch)], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                ids, lengths = _ragged(column.slice(begin, end - begin), "<u2")
                fine = classes.fine[ids]
                score = attention.text_scores(weights, fine, lengths, classes.coarse_of)
                within = shares.take(_before(fine, lengths) * width + places[ids]) + own[ids]
                sums = np.concatenate(([0.0], np.cumsum(within, dtype=np.float64)))
                last = np.cumsum(lengths)
                score += sums[last] - sums[last - lengths]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(score)], names=[*part.schema.names[:5], "score"])

    return rows.select("block", "doc", "doc_id", "held_out", "n_tokens", "ids").mapInArrow(
        scored, "block long, doc int, doc_id long, held_out boolean, n_tokens long, score double"
    )


def base_sums(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, doc, base, known): sum of log10(count + 1) over the words of each document, and how many are counted."""

    def summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
        count = _ragged(counts.sort_by("cell").column("counts").combine_chunks(), "<u8")[0]
        numbers, lengths = _ragged(docs.column("numbers").combine_chunks(), "<u4")
        of_doc = np.repeat(np.arange(len(lengths)), lengths)
        # without any word the sums are whole numbers
        base = np.bincount(of_doc, np.log10(count + 1.0).take(numbers), len(lengths)).astype(np.float64)
        known = np.bincount(of_doc, (count > 0).take(numbers), len(lengths)).astype(np.int64)
        return pa.table({"block": docs.column("block"), "doc": docs.column("doc"), "base": base, "known": known})

    docs = rows.select("block", "doc", "numbers").groupBy("block")
    return docs.cogroup(counts.select("block", "cell", "counts").groupBy("block")).applyInArrow(
        summed, "block long, doc int, base double, known long"
    )


def score_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null or empty text has one token, its end. A null id counts as the empty text and so belongs to the
    training rows. Without training rows every count is zero and the model is the untrained one.
    """
    path = path or tokenizer_path(VOCABULARY)
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (id_remainder(FOLDS) == HELD_OUT).alias("held_out"),
        text_of().alias("text"),
    )
    blocks = stored(document_blocks(plain, path), "blocks", compression="zstd")
    rows = blocks.filter(F.col("ids").isNotNull())
    training = rows.filter(~F.col("held_out")).select("block", "doc", "doc_id", "ids", "n_tokens")
    counts = stored(word_counts(blocks), "word-counts", compression="zstd")
    kinds = counts.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    texts, words = training.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n_tokens") - 1), F.lit(0))).first()

    coder = ByteWords(path)
    id_counts = _totals(training, coder.size, lambda ids, _: ids)
    classes = attention.make_classes(id_counts, coder.begins_word)
    pairs = count_pairs(training, id_counts, classes)
    first = Weights.start(classes.sizes)
    first.after[:] = pairs.first_logits(texts)
    weights = train_model(training, texts, words, first, classes)
    scores = model_scores(rows, weights, pairs)
    sums = base_sums(rows, counts).withColumnsRenamed({"block": "__block", "doc": "__doc"})
    # the end is a token of every text: counted once for each training text
    tokens, distinct = words + texts, kinds + (texts > 0)
    per_token = float(np.log10(tokens + 1 * (distinct + 1)))
    return scores.join(sums, (F.col("block") == F.col("__block")) & (F.col("doc") == F.col("__doc")), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.coalesce("known", F.lit(0)) + (1 if texts else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.coalesce("base", F.lit(0.0)) + float(np.log10(texts + 1)) - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )
