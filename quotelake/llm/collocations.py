"""Phrase collocations mined over a prefix-free parse of the corpus.

Texts are lower-cased in A-Z, cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. Everything is counted per language (null: ``und``).

**Prefix-free parsing.** Within a piece, a word place ``i > 0`` is a trigger when the hash of the
``WINDOW`` words from ``i`` is 0 modulo ``MODULUS``. Triggers cut the piece into chunks; a chunk owns
the words from its trigger to the next one and also holds the ``WINDOW`` words of the next trigger,
so consecutive chunks overlap. Since triggers depend on content only, repeated passages, lines and
copies of documents parse into the same chunks; the dictionary holds each distinct (chunk, owned
words) once with its parse frequency (a map-side combined count). Phrases of up to ``WINDOW + 1``
words are counted inside distinct chunks from the words a chunk owns, weighted by the frequency:
every occurrence starts in exactly one owned stretch and lies wholly inside that chunk, so
overlaps are assigned once and counts are exact.

**Counting by levels.** The dictionary is stored in blocks of chunks with their words numbered. A
phrase occurring ``MIN_COUNT`` times has every part at least as often, so level m counts only m-word
phrases whose first and last m - 1 words pass a filter of the level before: a bit set of the
frequent 64-bit hashes, at most ``2 ** FILTER_BITS`` bits. A task adds up the hashes of a block, Spark
those of all blocks. A hash's count is at least that of every phrase behind it, and a filter may let
others pass but loses none, so the last pass, which counts phrases by their words, is exact.

**Scores.** A candidate has 2 to 5 words and a = f(phrase) >= 100. Cutting after its first k words
gives l and r, the counts of both parts, and score floor(1000 a n / (l r)) in exact decimal
arithmetic, n being the language's word count; the lowest-scoring cut counts, ties to the smallest
k. Candidates lying contiguously inside a longer candidate with as many occurrences are dropped.
Each language's first ``TOP`` by score descending, a descending, phrase ascending (UTF-8 bytes)
are returned with their rank.

Defined cases: a null text is empty; empty texts, empty pieces and an empty table add nothing;
repeated rows count as often as they occur; ids are not read; a language without candidates has
no rows; extra input columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import LOWER, stored

# Fixed values of the dealt contract.
PIECE = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_GAP = b"\x20\x09"
MIN_COUNT = 100
SHORTEST, LONGEST = 2, 5
TOP = 2000
NO_LANG = "und"

#: Trigger window in words (longest phrase - 1, so that owned phrases end inside their chunk),
#: and the modulus that sets the mean owned length of a chunk.
WINDOW = LONGEST - 1
MODULUS = 16
#: Counts up to this planned size are broadcast into the joins of the scores.
BROADCAST_BYTES = 64 << 20

#: Bytes of text parsed at a time, and of chunks in a block, about.
PART_BYTES = 3 << 19
BLOCK_BYTES = 5 << 19
#: Size of a level's filter at most, and the slices it is built in, as powers of two.
FILTER_BITS, SLICE_BITS = 27, 6

#: 0: byte of a word, 1: gap between words, 2: end of a piece.
KINDS = np.zeros(256, np.uint8)
KINDS[list(WORD_GAP)], KINDS[list(PIECE)] = 1, 2

#: Odd factors of the words of a phrase by place, in its hash.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)

BLOCKS = (
    "langs array<string>, words binary, hashes binary, numbers binary, size binary, own binary, freq binary, lang binary"
)


class Tokens(NamedTuple):
    """Words: where each begins in the text, its piece, and where it begins in ``plain``, which has each
    word and a blank (and where the last ends)."""

    starts: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    plain: bytes


def _tokens(raw: bytes) -> Tokens:
    """Words of lower-cased text that begins and ends with a separator."""
    data = np.frombuffer(raw, np.uint8)
    kind = KINDS[data]
    word = kind == 0
    after = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    starts = np.flatnonzero(~word[:-1] & word[1:]) + 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    word[after] = True  # each word keeps one separator, which becomes its blank
    plain = data.copy()
    plain[after] = 32
    plain = plain[word].tobytes()
    at = np.concatenate(([0], np.cumsum(after - starts + 1)))
    return Tokens(starts, piece, at, plain)


def _dictionary(tokens: Tokens) -> tuple[np.ndarray, pa.Array]:
    """Number of each word, equal for equal words only, and the words by number, each with its blank."""
    column = pa.Array.from_buffers(
        pa.large_binary(), len(tokens.starts), [None, pa.py_buffer(tokens.at), pa.py_buffer(tokens.plain)]
    ).dictionary_encode()
    return column.indices.to_numpy(), column.dictionary


def _hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of each value of an array of binaries, none of them empty."""
    if not len(values):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    starts, size = ends[:-1] - ends[0], np.diff(ends)
    power = np.cumprod(np.full(size.max(), FACTORS[0]))
    at = np.arange(len(data)) - np.repeat(starts, size)
    return _mixed(np.add.reduceat((data + np.uint64(1)) * power[at], starts))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(32))


def _joined(word_hashes: np.ndarray, m: int) -> np.ndarray:
    """Hash of the m words from each place; words past the end of the array count as zero."""
    found = np.zeros(len(word_hashes), np.uint64)
    for k in range(min(m, len(found))):
        found[: len(found) - k] += word_hashes[k:] * FACTORS[k]
    return found


def _parts(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of about ``most`` bytes in the binary column, within batches."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // most, prepend=0)).tolist() if len(sizes) else []
        for begin, end in itertools.pairwise([0, *cuts, len(batch)]):
            if begin < end:
                yield batch.slice(begin, end - begin)


def _chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, body, own, freq) of distinct chunks; the words of ``body`` are joined by blanks."""
    plain = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8").alias("text"),
    )

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1, PART_BYTES):
            texts = part.column(1).to_pylist()
            tokens = _tokens(b"\n" + b"\n".join(texts).translate(LOWER) + b"\n")
            starts, piece, at, n = tokens.starts, tokens.piece, tokens.at, len(tokens.starts)
            if not n:
                continue
            number, words = _dictionary(tokens)
            of_word = _hashes(words)[number]
            # words of the window that lie beyond the piece count as zero
            window = of_word * FACTORS[0]
            for k in range(1, min(WINDOW, n)):
                window[:-k] += np.where(piece[k:] == piece[:-k], of_word[k:] * FACTORS[k], np.uint64(0))
            first = np.append(True, piece[1:] != piece[:-1])
            begin = np.flatnonzero(first | (_mixed(window) % np.uint64(MODULUS) == 0))
            end = np.append(begin[1:], n)
            ends = np.append(np.flatnonzero(first)[1:], n)[np.cumsum(first)[begin] - 1]
            stop = np.minimum(end + WINDOW, ends)
            doc = np.searchsorted(1 + np.cumsum([len(t) + 1 for t in texts]), starts[begin], "right")
            plain, cut = tokens.plain, zip(at[begin].tolist(), (at[stop] - 1).tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array([plain[a:b] for a, b in cut], pa.binary()),
                 pa.array((end - begin).astype(np.int32))],
                names=["lang", "body", "own"],
            )

    return (
        plain.mapInArrow(parsed, "lang string, body binary, own int")
        .groupBy("lang", "body", "own").agg(F.count(F.lit(1)).alias("freq"))
    )


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Distinct chunks: (lang, words, own, freq); the first ``own`` words are the chunk's own."""
    return _chunks(docs, text, lang).select("lang", F.split(F.col("body").cast("string"), " ").alias("words"), "own", "freq")


def _packed(chunks: DataFrame) -> DataFrame:
    """Rows of ``BLOCKS``: distinct chunks of about ``BLOCK_BYTES`` together, their words numbered."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _parts(batches, 1, PART_BYTES):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(1))).as_py()
            if size >= BLOCK_BYTES:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        tokens = _tokens(b"\n" + b"\n".join(rows.column("body").to_pylist()) + b"\n")
        number, words = _dictionary(tokens)
        langs = pc.unique(rows.column("lang"))
        of_lang = pc.index_in(rows.column("lang"), langs).to_numpy()
        values = {
            "words": b"".join(words.to_pylist()), "hashes": _hashes(words).tobytes(), "numbers": number.astype("<i4").tobytes(),
            "size": np.bincount(tokens.piece - 1, minlength=len(rows)).astype("<i4").tobytes(),
            "own": rows.column("own").to_numpy().astype("<i4").tobytes(),
            "freq": rows.column("freq").to_numpy().astype("<i8").tobytes(), "lang": of_lang.astype("<i4").tobytes(),
        }
        return pa.RecordBatch.from_arrays(
            [pa.array([langs.to_pylist()], pa.list_(pa.string())), *(pa.array([v], pa.binary()) for v in values.values())],
            names=["langs", *values],
        )

    return chunks.select("lang", "body", "own", "freq").mapInArrow(packed, BLOCKS)


Row = dict[str, Any]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[Row]:
    """Rows one at a time, binary values as views of the batch."""
    for batch in batches:
        for at in range(len(batch)):
            values = {n: batch.column(c)[at] for c, n in enumerate(batch.schema.names)}
            yield {n: v.as_buffer() if pa.types.is_binary(v.type) else v.as_py() for n, v in values.items()}


class _Block:
    """A stored block: for each word place its number, hash, chunk and place in the chunk."""

    def __init__(self, row: Row):
        self.langs, self.lang = row["langs"], np.frombuffer(row["lang"], "<i4")
        self.number = np.frombuffer(row["numbers"], "<i4")
        size, own = (np.frombuffer(row[c], "<i4") for c in ("size", "own"))
        self.chunk = np.repeat(np.arange(len(size), dtype=np.int32), size)
        end = np.cumsum(size, dtype=np.int32)
        #: words from the place to the end of the chunk, and whether the chunk owns the place
        self.left = np.repeat(end, size) - np.arange(len(self.chunk), dtype=np.int32)
        self.owned = self.left > np.repeat(size - own, size)
        self.freq = np.frombuffer(row["freq"], "<i8")
        self.of_word = np.frombuffer(row["hashes"], "<u8")[self.number]
        self.seed = _hashes(pa.array([f"{x} ".encode() for x in self.langs], pa.large_binary()))[self.lang]

    def keys(self, m: int) -> np.ndarray:
        """Hash of language and m words at each place; not of use where fewer are left."""
        return _mixed(_joined(self.of_word, m) + self.seed[self.chunk])

    def known(self, m: int, passes: np.ndarray) -> np.ndarray:
        """Whether the m words from each place may be frequent."""
        slot = self.keys(m) >> np.uint64(64 - (len(passes) * 8).bit_length() + 1)
        return (passes[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool) & (self.left >= m)


def _filter(frequent: DataFrame) -> np.ndarray:
    """Bit set with a bit for each frequent hash's leading bits. It may let others pass, and none is lost.

    Its size follows the number of hashes up to ``FILTER_BITS``; slices are built in tasks.
    """
    bits = min(FILTER_BITS, max(12, (frequent.count() * 16).bit_length()))
    width = bits - SLICE_BITS

    def sliced(rows: pa.Table) -> pa.Table:
        keys = rows.column("h").to_numpy().view(np.uint64)
        own = np.zeros(1 << width, np.uint8)
        own[(keys >> np.uint64(64 - bits)) & np.uint64((1 << width) - 1)] = 1
        found = np.packbits(own, bitorder="little").tobytes()
        return pa.table({"slice": pa.array([int(keys[0] >> np.uint64(64 - SLICE_BITS))], pa.int32()), "bits": [found]})

    slices = frequent.groupBy(F.shiftrightunsigned("h", 64 - SLICE_BITS)).applyInArrow(sliced, "slice int, bits binary")
    passes = np.zeros((1 << SLICE_BITS, 1 << width >> 3), np.uint8)
    for row in slices.collect():
        passes[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return passes.ravel()


def _hash_level(blocks: DataFrame, m: int, before: Broadcast | None) -> DataFrame:
    """Hashes ``h`` of m-word phrases counted at least ``MIN_COUNT`` times, counting only phrases whose
    first and last m - 1 words pass the filter ``before``. A hash count is at least the count of each
    phrase behind it, so no phrase that reaches ``MIN_COUNT`` is lost."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _Block(row)
            valid = block.owned & (block.left >= m)
            if before is not None:
                known = block.known(m - 1, before.value)
                valid &= known
                valid[:-1] &= known[1:]
            at = np.flatnonzero(valid)
            if not len(at):
                continue
            keys = block.keys(m)[at]
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            n = np.add.reduceat(block.freq[block.chunk[at[order]]], first)
            yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(n)], names=["h", "n"])

    columns = [f for f in blocks.columns if f != "words"]
    grams = blocks.select(*columns).mapInArrow(counted, "h long, n long")
    return grams.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT).select("h")


def phrase_counts(blocks: DataFrame) -> DataFrame:
    """(lang, phrase, m, f) of every phrase of 1 to ``LONGEST`` words with f >= ``MIN_COUNT``.

    Levels count 64-bit hashes; a final pass builds the phrases whose hashes pass every filter and
    counts them by their words, so a hash shared by two phrases never merges their counts.
    """
    share = blocks.sparkSession.sparkContext.broadcast
    filters: list[Broadcast] = []
    for m in range(1, LONGEST + 1):
        frequent = stored(_hash_level(blocks, m, filters[-1] if filters else None), f"collocations-hashes-{m}")
        filters.append(share(_filter(frequent)))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, words = _Block(row), row["words"].to_pybytes().split(b" ")
            ids = known = None
            for m, passes in enumerate(filters, 1):
                before, known = known, block.known(m, passes.value)
                if before is not None:  # both shorter parts as well
                    known &= before
                    known[:-1] &= before[1:]
                at = np.flatnonzero(known)
                if not len(at):
                    break
                if m == 1:
                    keys = block.lang[block.chunk[at]].astype(np.int64) << 32 | block.number[at]
                else:  # phrases are equal when their first m - 1 words and their last word are
                    keys = ids[at] << 32 | block.number[at + m - 1]
                distinct, first, number = np.unique(keys, return_index=True, return_inverse=True)
                ids = np.zeros(len(known), np.int64)
                ids[at] = number
                n = np.zeros(len(distinct), np.int64)
                own = block.owned[at]
                np.add.at(n, number[own], block.freq[block.chunk[at[own]]])
                kept = np.flatnonzero(n)
                places = at[first[kept]]
                columns = [block.number[places + k].tolist() for k in range(m)]
                phrases = [b" ".join([words[i] for i in p]) for p in zip(*columns, strict=True)]
                langs = pa.array(block.langs, pa.string()).take(pa.array(block.lang[block.chunk[places]]))
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(phrases, pa.binary()), pa.array(np.full(len(kept), m, np.int32)), pa.array(n[kept])],
                    names=["lang", "phrase", "m", "n"],
                )

    exact = blocks.mapInArrow(counted, "lang string, phrase binary, m int, n long")
    return (
        exact.groupBy("lang", "phrase", "m").agg(F.sum("n").alias("f")).where(F.col("f") >= MIN_COUNT)
        .withColumn("phrase", F.col("phrase").cast("string"))
    )


def _totals(blocks: DataFrame) -> DataFrame:
    """(lang, n): how many words each language has."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = np.zeros(len(row["langs"]), np.int64)
            np.add.at(n, np.frombuffer(row["lang"], "<i4"), np.frombuffer(row["own"], "<i4") * np.frombuffer(row["freq"], "<i8"))
            yield pa.RecordBatch.from_arrays([pa.array(row["langs"], pa.string()), pa.array(n)], names=["lang", "n"])

    rows = blocks.select("langs", "lang", "own", "freq").mapInArrow(counted, "lang string, n long")
    return rows.groupBy("lang").agg(F.sum("n").alias("n"))


def _maybe_broadcast(df: DataFrame, width: int = 48) -> DataFrame:
    planned = df.count() * width
    return F.broadcast(df) if planned <= BROADCAST_BYTES else df


def with_exact_score(df: DataFrame, a: str = "a", n: str = "n", l: str = "l", r: str = "r") -> DataFrame:
    """Adds ``score`` = floor(1000 a n / (l r)) by integral division of 38-digit decimals.

    No rounding and no overflow: 1000 a n stays below 10^38 for counts below 10^17.
    """
    dec = "decimal(38,0)"
    top = ((F.col(a).cast(dec) * F.col(n).cast(dec)).cast(dec) * F.lit(1000).cast(dec)).cast(dec)
    bottom = (F.col(l).cast(dec) * F.col(r).cast(dec)).cast(dec)
    return (
        df.withColumn("__top", top).withColumn("__bottom", bottom)
        .withColumn("score", F.expr("__top div __bottom").cast("long"))
        .drop("__top", "__bottom")
    )


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, k) of each language's best ``top`` candidates."""
    blocks = stored(_packed(_chunks(docs, text, lang)), "collocations-dictionary")
    totals = _totals(blocks)
    counts = stored(phrase_counts(blocks), "collocations-counts")
    cands = counts.where(F.col("m").between(SHORTEST, LONGEST)).withColumn("ws", F.split("phrase", " "))
    parts = _maybe_broadcast(counts.select("lang", "phrase", "f"), 96)
    cuts = cands.select(
        "lang", "phrase", "m", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"), "ws"
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("ws", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("ws", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("right"),
    )
    lefts = parts.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("l_phrase"), F.col("f").alias("l"))
    rights = parts.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("f").alias("r"))
    scored = (
        cuts.join(lefts, (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_phrase")))
        .join(rights, (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_phrase")))
        .join(F.broadcast(totals), "lang")
    )
    scored = with_exact_score(scored)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b")
    )
    inside = cands.where(F.col("m") > SHORTEST).select(
        "lang", F.col("f").alias("outer"), "ws", F.explode(_subphrases()).alias("sub")
    ).groupBy(F.col("lang").alias("s_lang"), F.col("sub")).agg(F.max("outer").alias("outer"))
    alive = best.join(
        inside, (F.col("lang") == F.col("s_lang")) & (F.col("phrase") == F.col("sub")), "left"
    ).where(F.col("outer").isNull() | (F.col("outer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return (
        alive.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select(
            "lang", "rank", "phrase", F.col("a").cast("long").alias("a"), F.col("b.l").cast("long").alias("l"),
            F.col("b.r").cast("long").alias("r"), F.col("n").cast("long").alias("n"),
            F.col("b.score").alias("score"), F.col("b.k").cast("long").alias("k"),
        )
    )


def _subphrases() -> Column:
    """Contiguous parts of 2 to m - 1 words of a candidate's words ``ws``."""
    ws = F.col("ws")
    m = F.size(ws)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(SHORTEST), m - 1),
            lambda length: F.transform(
                F.sequence(F.lit(0), m - length), lambda i: F.array_join(F.slice(ws, i + 1, length), " ")
            ),
        )
    )
