"""Best-fit packing of tokenised documents, planned on the histogram of their lengths.

The planner sees how many pieces there are of each length, not the pieces: best fit, longest
first, runs over counts. Its plan says which ranks of a length go to which sequences; pieces take
their slots by joining on their rank within their length. The plan depends on the limit, not on
the number of documents.

Defined results: null and empty texts are one piece of the end id alone; texts longer than the limit are cut
into full pieces and one shorter rest; repeated rows and null ids are packed like any others; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotseries.sources.stored import stored

from .common import map_batches, texts_of

LIMIT = 4096
END_ID = 1
# Words kept with their ids by a Python worker, beside those of one run of texts; about 150 bytes each.
CACHED_WORDS = 1_000_000
# Pieces of one length ranked together in one window group.
RANK_GROUP = 5_000


def _byte_letters() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordIds:
    """Token ids of a text as little-endian bytes, for a tokenizer that drops white space.

    Such a tokenizer treats what stands between blanks on its own, so ids are kept by word. A word of
    letters goes straight to the tokenizer's model in lower case, which is what the tokenizer's normalizer
    and splitter make of it; a mark behind it is a token run of its own.
    Probe words decide whether that holds for the given file.
    """

    MARKS = ",.;:!?"
    PROBES = ["the", "Thing,", "straße", "Été.", "naïve!", "ñandú", "a", "Überung:", "слово;", "κόσμος"]

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.direct = True
        self.marks = {mark: self.whole([mark])[0] for mark in self.MARKS}
        self.direct = all(self.of_word(word) == self.whole([word])[0] for word in self.PROBES)
        self.known.clear()

    def whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def of_word(self, word: str) -> bytes | None:
        """Ids of letters with at most one mark behind them, else nothing."""
        stem, tail = (word[:-1], self.marks[word[-1]]) if word[-1:] in self.marks else (word, b"")
        if not self.direct or not stem.isalpha():
            return None
        low = stem.lower()
        if not stem.isascii():
            if not unicodedata.is_normalized("NFC", stem) or "".join(map(str.lower, stem)) != low or len(low) != len(stem):
                return None
        ids = self.known.get(low)
        if ids is None:
            text = low if low.isascii() else "".join([self.letters[b] for b in low.encode()])
            ids = self.known[low] = array("I", [token.id for token in self.model.tokenize(text)]).tobytes()
        return ids + tail

    def learn(self, words: set[str]) -> None:
        rest = []
        for word in words:
            ids = self.of_word(word)
            if ids is None:
                rest.append(word)
            else:
                self.known[word] = ids
        for first in range(0, len(rest), 10_000):
            part = rest[first : first + 10_000]
            self.known.update(zip(part, self.whole(part)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        asked = set().union(*split)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self.learn(asked - self.known.keys())
        known = self.known
        for words in split:
            yield b"".join([known[word] for word in words])


_encoders: dict[str, WordIds] = {}


def _encoder(file: str) -> WordIds:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if file not in _encoders:
        _encoders[file] = WordIds(file)
    return _encoders[file]


def pieces_of(
    docs: DataFrame, tokenizer_file: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document's ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], [], []]
        owners = batch.column(0)
        for i, ids in enumerate(_encoder(tokenizer_file).encode(texts_of(batch.column(1)))):
            ids += end
            for piece, first in enumerate(range(0, len(ids), 4 * limit)):
                part = ids[first : first + 4 * limit]
                for into, value in zip(rows, (i, piece, first // 4, len(part) // 4, zlib.crc32(part), part)):
                    into.append(value)
        columns = [owners.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in rows[2:5]]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            flat = np.frombuffer(b"".join(rows[5]), "<u4").astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(rows[3])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(edges, flat))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_batches(docs.select("doc_id", "text"), cut, schema + (", ids array<bigint>" if with_ids else ""))


def plan_best_fit(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts.

    Rows ``(length, first_rank, last_rank, sequence, each, offset)``: ranks of that length fill the
    sequences from ``sequence`` on, ``each`` pieces to a sequence, the first at ``offset``.
    Sequences that look alike are handled as one group, so the work follows the number of
    different lengths, not that of pieces.
    """
    room: list[int] = []  # free places for which there are groups, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # free places: (first sequence, how many)
    plan, made = [], 0

    def put(free: int, first: int, many: int) -> None:
        if free and many:
            if free not in groups:
                groups[free] = []
                bisect.insort(room, free)
            groups[free].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(room, length)
            if at < len(room):
                free = room[at]
                first, many = groups[free].pop()
                if not groups[free]:
                    del groups[free], room[at]
            else:
                free, first, many = limit, made, -(-left // (limit // length))
                made += many
            each = free // length
            full = min(many, left // each)
            if full:
                plan.append((length, rank, rank + full * each - 1, first, each, limit - free))
                put(free - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < many:
                plan.append((length, rank, rank + left - 1, first + full, left, limit - free))
                put(free - left * length, first + full, 1)
                put(free, first + full + 1, many - full - 1)
                left = 0
            else:
                put(free, first + full, many - full)
    return plan


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; they must be stored, as they are read twice."""
    spark = pieces.sparkSession
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_best_fit(counts, limit),
        "length bigint, first_rank bigint, last_rank bigint, sequence bigint, each bigint, base bigint",
    )
    # A length may own any share of the rows: ranks run within (length, part), and the parts
    # of a length follow each other.
    parts = -(-sum(counts.values()) // RANK_GROUP) or 1
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)))
    before = (
        dealt.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"))
        .select("length", "part", "before")
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (
        dealt.withColumn("within", within)
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
    )
    step = F.col("rank") - F.col("first_rank")
    return (
        # The plan has a few rows per length, so its size is bounded by the limit.
        ranked.join(F.broadcast(plan), "length")
        .where((F.col("rank") >= F.col("first_rank")) & (F.col("rank") <= F.col("last_rank")))
        .select(
            *pieces.columns,
            (F.col("sequence") + (step / F.col("each")).cast("bigint")).alias("sequence_id"),
            (F.col("base") + step % F.col("each") * F.col("length")).alias("offset"),
        )
    )


def pack(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return place(stored(pieces_of(docs, tokenizer_file, limit, with_ids=with_ids)), limit)
