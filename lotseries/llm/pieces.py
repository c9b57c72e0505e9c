"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into units no piece can cross (a run of blanks with the letters, the digit or the marks behind
it). The distinct units of all documents are exploded into substrings of bounded length, which an equi-join to the piece
table turns into the edges of a lattice; edges are grouped by unit, and a fold over the sorted edges (``aggregate``)
finds the segmentation with the largest sum of scores, the longer last piece at ties. A character
that is no piece becomes its bytes. Units then replace their occurrences: the frequent ones from a broadcast
table of bounded size, the rest by joins on the unit and the document.

That is the segmentation of a unigram file. Scores of a BPE file are merge ranks, of which the best sum is not what
its tokenizer gives, so for such a file the fold over a unit's edges merges neighbours by rank instead.
Decoding gives the text back exactly.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows and null ids are
kept; the blank mark U+2581 in a text counts as a blank and decodes as one. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotseries.sources.stored import stored

from .common import map_batches, texts_of

BLANK = "▁"
# Units in the broadcast table; with units of at most LONGEST_SHIPPED characters its size is bounded.
MAX_SHIPPED = 150_000
LONGEST_SHIPPED = 32
# Words a worker remembers; an executor has up to two workers a core, and each remembers its own.
MOST_KEPT = 50_000
# Added to the least score for a character that is no piece.
UNKNOWN_PENALTY = 10.0

_UNITS = regex.compile(r"▁*(?:[\p{L}\p{M}]+|\p{Nd}|[^\p{L}\p{M}\p{Nd}▁]+)|▁+")
_WORDS = re.compile(r"▁*[^▁]+|▁+")

NORMAL, UNKNOWN, BYTE = 1, 2, 6


class Vocabulary:
    """The pieces of a model file and the pattern of its units."""

    def __init__(self, file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(file, "rb") as f:
            model.ParseFromString(f.read())
        self.merges = model.trainer_spec.model_type == model.trainer_spec.BPE
        self.normal = [(p.piece, i, float(p.score)) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), 0)
        self.longest = max(len(p) for p, _, _ in self.normal)
        self.unknown_score = min(s for _, _, s in self.normal) - UNKNOWN_PENALTY
        self.raw = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.encode() if p.type == NORMAL else b""
            for p in model.pieces
        ]
        fits = all(_UNITS.fullmatch(p) for p, _, _ in self.normal)
        self.pattern = _UNITS if fits else _WORDS
        if not fits and not all(_WORDS.fullmatch(p) for p, _, _ in self.normal):
            self.pattern = re.compile(r"(?s).+")
        self._split: dict[str, list[str]] = {}

    def unknown_ids(self, text: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, if the file has those."""
        return [self.bytes.get(b, self.unknown) for b in text.encode()] if self.bytes else [self.unknown]

    def words(self, text: str) -> list[str]:
        """Blanks with what follows them up to the next; no unit crosses from one to another."""
        if not text:
            return []
        return (self.pattern if self.pattern is not _UNITS else _WORDS).findall(BLANK + text.replace(" ", BLANK))

    def split(self, word: str) -> list[str]:
        """The units of a word."""
        found = self._split.get(word)
        if found is None:
            found = self.pattern.findall(word)
            if len(word) <= LONGEST_SHIPPED:
                if len(self._split) >= MOST_KEPT:
                    self._split.clear()
                self._split[word] = found
        return found

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:]


@functools.cache
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def lattice(units: DataFrame, words: Vocabulary) -> DataFrame:
    """Edges ``unit, end, size, ids, score`` of distinct ``unit``s; rows stay where their unit is."""
    spark = units.sparkSession
    table = spark.createDataFrame(words.normal, "piece string, id int, score double")
    n = F.char_length("unit")
    # The vocabulary is a fixed table of some tens of thousands of rows.
    cut = (
        units.withColumn("end", F.explode(F.sequence(F.lit(1), n)))
        .withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.col("end"), F.lit(words.longest)))))
        .withColumn("piece", F.substring(F.col("unit"), F.col("end") - F.col("size") + 1, F.col("size")))
        .join(F.broadcast(table), "piece", "left")
        .where(F.col("id").isNotNull() | (F.col("size") == 1))
    )
    code = F.hex(F.encode("piece", "UTF-8"))
    if words.bytes:
        of_byte = F.array(*[F.lit(words.bytes.get(b, words.unknown)) for b in range(256)])
        unknown = F.transform(
            F.sequence(F.lit(1), F.length(code), F.lit(2)),
            lambda i: F.element_at(of_byte, F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + 1),
        )
    else:
        unknown = F.array(F.lit(words.unknown))
    return cut.select(
        *units.columns,
        "end",
        "size",
        *([F.col("id")] if words.merges else []),
        F.when(F.col("id").isNotNull(), F.array("id")).otherwise(unknown).alias("ids"),
        F.coalesce("score", F.lit(words.unknown_score)).alias("score"),
    )


def viterbi(edges: Column, longest: int) -> Column:
    """Ids along the best path through ``edges`` (``end, size, score, ids``)."""
    best_type = "struct<score:double,size:int,ids:array<int>>"
    state_type = f"struct<end:int,best:{best_type},recent:array<double>,back:array<{best_type}>>"

    def step(state: Column, x: Column) -> Column:
        on = x["end"] == state["end"]
        # ``recent`` has the best scores of the positions before, the nearest first.
        recent = F.when(on, state["recent"]).otherwise(
            F.slice(F.concat(F.array(state["best"]["score"]), state["recent"]), 1, longest)
        )
        back = F.when(on | (state["end"] == 0), state["back"]).otherwise(
            F.concat(state["back"], F.array(state["best"]))
        )

        def put(r: Column) -> Column:
            own = F.struct(
                (F.element_at(r, x["size"]) + x["score"]).alias("score"), x["size"].alias("size"), x["ids"].alias("ids")
            )
            return F.struct(
                x["end"].alias("end"),
                _let(own, lambda o: F.when(on & (state["best"] > o), state["best"]).otherwise(o)).alias("best"),
                r.alias("recent"),
                back.alias("back"),
            )

        return _let(recent, put)

    none = F.array().cast("array<int>")
    start = F.struct(
        F.lit(0).alias("end"),
        F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("size"), none.alias("ids")).alias("best"),
        F.array().cast("array<double>").alias("recent"),
        F.array().cast(f"array<{best_type}>").alias("back"),
    ).cast(state_type)
    # Edges sort by end, then size.
    path = F.aggregate(
        F.array_sort(edges), start, step, lambda s: F.concat(s["back"], F.array(s["best"]))
    )

    def walk(best: Column) -> Column:
        begin = F.struct(F.size(best).alias("at"), F.array().cast("array<array<int>>").alias("ids"))
        moved = lambda s: F.struct(
            (s["at"] - F.element_at(best, s["at"])["size"]).alias("at"),
            F.concat(s["ids"], F.array(F.element_at(best, s["at"])["ids"])).alias("ids"),
        )
        return F.aggregate(
            best, begin, lambda s, _: F.when(s["at"] > 0, moved(s)).otherwise(s), lambda s: F.flatten(F.reverse(s["ids"]))
        )

    return _let(path, walk)


def merged(n: int, scores: dict[int, float], longest: int) -> list[tuple[int, int]]:
    """Segments ``(end, size)`` of ``n`` characters after all merges, best score first, then leftmost.

    ``scores`` has the pieces in the unit by ``end * (longest + 1) + size``.
    """
    after = list(range(1, n + 1)) + [n]
    before = list(range(-1, n))
    heap: list[tuple[float, int, int, int]] = []

    def offer(left: int) -> None:
        if left >= 0 and after[left] < n:
            right = after[left]
            end = after[right]
            score = scores.get(end * (longest + 1) + end - left) if end - left <= longest else None
            if score is not None:
                heapq.heappush(heap, (-score, left, right, end))

    for left in range(n - 1):
        offer(left)
    gone = set()
    while heap:
        _, left, right, end = heapq.heappop(heap)
        if left in gone or after[left] != right or right in gone or after[right] != end:
            continue
        gone.add(right)
        after[left] = end
        if end < n:
            before[end] = left
        offer(before[left])
        offer(left)
    found, left = [], 0
    while left < n:
        found.append((after[left], after[left] - left))
        left = after[left]
    return found


def _merge_fold(grouped: DataFrame, file: str) -> DataFrame:
    """``unit, amount, ids`` of units with their edges, by merges."""

    def fold(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file)
        width = words.longest + 1
        edges = batch.column(2)
        flat = edges.flatten()
        key = flat.field(0).to_numpy() * width + flat.field(1).to_numpy()
        keys, scores = key.tolist(), flat.field(2).to_numpy().tolist()
        numbers = flat.field(3).fill_null(-1).to_numpy().tolist()
        at = (edges.offsets.to_numpy() - edges.offsets[0].as_py()).tolist()
        ids = []
        for i, unit in enumerate(batch.column(0).to_pylist()):
            part = slice(at[i], at[i + 1])
            number = dict(zip(keys[part], numbers[part]))
            found = []
            for end, size in merged(len(unit), dict(zip(keys[part], scores[part])), words.longest):
                n = number[end * width + size]
                found += [n] if n >= 0 else words.unknown_ids(unit[end - size : end])
            ids.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["unit", "amount", "ids"]
        )

    return map_batches(grouped, fold, "unit string, amount bigint, ids array<int>")


def encoded_units(units: DataFrame, file: str) -> DataFrame:
    """``unit, amount, ids`` of the distinct units."""
    words = vocabulary(file)
    edges = lattice(units, words)
    last = "id" if words.merges else "ids"
    grouped = edges.groupBy("unit", "amount").agg(F.collect_list(F.struct("end", "size", "score", last)).alias("edges"))
    if words.merges:
        return _merge_fold(grouped, file)
    return grouped.select("unit", "amount", viterbi(F.col("edges"), words.longest).alias("ids"))


def _amounts(docs: DataFrame, file: str) -> DataFrame:
    """``unit, amount``: how often every unit occurs in all texts."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pattern = vocabulary(file)
        words: Counter = Counter()
        for text in texts_of(batch.column(0)):
            words.update(pattern.words(text))
        found: Counter = Counter()
        for word, amount in words.items():
            for unit in pattern.split(word):
                found[unit] += amount
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["unit", "amount"]
        )

    found = map_batches(docs.select("text"), count, "unit string, amount bigint")
    return found.groupBy("unit").agg(F.sum("amount").alias("amount"))


def _frequent(table: DataFrame) -> DataFrame:
    """The units of largest amounts, at most ``MAX_SHIPPED``, by a bound on the amount."""
    short = table.where(F.char_length("unit") <= LONGEST_SHIPPED)
    sizes = short.groupBy(F.floor(F.log2("amount") * 4).alias("step")).count().orderBy(F.desc("step")).collect()
    kept, bound = 0, None
    for row in sizes:
        if kept + row["count"] > MAX_SHIPPED:
            break
        kept, bound = kept + row["count"], row.step
    return short.where(F.floor(F.log2("amount") * 4) >= bound) if bound is not None else short.limit(0)


def _joined(units: list[str], frequent: dict[str, bytes]) -> bytes | None:
    """Ids of a word whose units are all frequent, else None."""
    return b"".join([frequent[u] for u in units]) if all(u in frequent for u in units) else None


def encode(docs: DataFrame, file: str) -> DataFrame:
    """``doc_id, ids`` of every row."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    table = stored(encoded_units(_amounts(docs, file), file))
    rows = _frequent(table).select("unit", "ids").collect()  # at most MAX_SHIPPED
    shipped = spark.sparkContext.broadcast({row.unit: np.array(row.ids, np.int32).tobytes() for row in rows})

    def first(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Documents of frequent units are done; of the others the rare units are asked for."""
        frequent, pattern = shipped.value, vocabulary(file)
        pack = zstandard.ZstdCompressor(level=3)
        ids, texts, rare = [], [], []
        known: dict[str, bytes | None] = {}
        for text in texts_of(batch.column(2)):
            parts, asked = [], set()
            for word in pattern.words(text):
                part = known[word] if word in known else known.setdefault(word, _joined(pattern.split(word), frequent))
                if part is None:
                    asked.update(u for u in pattern.split(word) if u not in frequent)
                else:
                    parts.append(part)
            rare.append(list(asked))
            ids.append(None if asked else np.frombuffer(b"".join(parts), np.int32))
            texts.append(pack.compress(text.encode()) if asked else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(texts, pa.binary()),
                pa.array(rare, pa.list_(pa.string())),
            ],
            ["doc_id", "who", "ids", "packed", "rare"],
        )

    who = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    source = docs.select("doc_id", who.alias("who"), "text")
    schema = f"doc_id {kind}, who binary, ids array<int>, packed binary, rare array<string>"
    surveyed = map_batches(source, first, schema)
    done = surveyed.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    asked = (
        surveyed.where(F.col("ids").isNull())
        .select("who", F.explode("rare").alias("unit"))
        .distinct()
        .join(table.select("unit", F.col("ids").alias("found")), "unit")
        .groupBy("who")
        .agg(F.collect_list(F.struct("unit", "found")).alias("found"))
    )
    waiting = surveyed.where(F.col("ids").isNull()).select("doc_id", "who", "packed").join(asked, "who")

    def second(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        frequent, pattern = shipped.value, vocabulary(file)
        unpack = zstandard.ZstdDecompressor()
        ids = []
        known: dict[str, bytes | None] = {}
        for packed, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = {x["unit"]: np.array(x["found"], np.int32).tobytes() for x in found}
            parts = []
            for word in pattern.words(unpack.decompress(packed).decode()):
                part = known[word] if word in known else known.setdefault(word, _joined(pattern.split(word), frequent))
                if part is None:
                    part = b"".join([frequent[u] if u in frequent else own[u] for u in pattern.split(word)])
                parts.append(part)
            ids.append(np.frombuffer(b"".join(parts), np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rest = map_batches(waiting.select("doc_id", "packed", "found"), second, f"doc_id {kind}, ids array<int>")
    return done.union(rest)


def decode(encoded: DataFrame, file: str) -> DataFrame:
    """``doc_id, ids, text`` of rows ``doc_id, ids``; null ids decode to the empty text."""
    kind = dict(encoded.dtypes)["doc_id"]

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file)
        ids = batch.column(1)
        texts = []
        for i in range(len(ids)):
            own = ids[i].values
            texts.append(words.decode(own.to_numpy().tolist()) if own is not None and len(own) else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return map_batches(encoded.select("doc_id", "ids"), over, f"doc_id {kind}, ids array<int>, text string")
