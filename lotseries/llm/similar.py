"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of five-word shingles; two link when their Jaccard similarity reaches the
threshold. Shingles are ordered from rare to frequent. If two sets share ``T`` shingles, the first
``l`` shared ones lie in both ``l``-prefixes, of length ``n - T + l``. Each document picks its ``l``: a longer
prefix costs more list entries but demands ``l`` matches before a pair is verified, which pays where its
prefix holds frequent shingles. A pair needs the smaller of its two ``l``.

Exact copies (equal sets) are one node. Groups of near copies are linked first as stars around
their most typical member; afterwards only pairs of different components are candidates, so a group of
any size costs no pairs within. Lists of very frequent shingles are cut into blocks which meet block by
block. Every candidate is verified on whole sets, so the components are those of all links.

Defined results: null, empty and blank texts have no shingle, link with nothing and are their own
component; repeated rows are copies of each other; rows with one id and different texts are separate
documents; a null id never names a component unless all its members have none (then it is null); an empty table gives an
empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import release, stored

from .common import give_back, map_batches, texts_of
from .shingles import components, mixed, shingle_hashes, word_hashes

PERCENT = 80
# Counters of shingle frequency: a shingle counts in the one its leading bits name.
COUNTER_BITS = 20
STAR_KEYS = 4
MOST_MATCHES = 4
# List entries of one shingle that meet in one group.
LIST_BLOCK = 20_000
MOST_BLOCKS = 32_768
# Candidate nodes whose keys are shipped to the readers of the texts (16 bytes each); beyond, they meet in a join.
MAX_SHIPPED = 4_000_000

ENTRY = ["token", "cell", "id", "component", "n", "place", "flags"]


def set_of(text: str) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text)))


def _node(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else b""


def needed(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least intersection of sets of ``n`` and ``m`` that link: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: ``doc_id, n, node``; of kind 1: ``bucket, amount`` of the shingle counters."""
    kind = dict(docs.dtypes)["doc_id"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        names = ["kind", "doc_id", "n", "node", "bucket", "amount"]
        owner_type = None
        for batch in batches:
            owner_type = batch.schema.field(0).type
            texts = texts_of(batch.column(1))
            sizes, nodes, held, size = [], [], [], 0
            for text in texts:
                s = set_of(text)
                sizes.append(len(s))
                nodes.append(_node(s))
                held.append(s >> np.uint64(64 - COUNTER_BITS))
                size += len(s)
                if size > 1_000_000:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total))
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total))
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(n, np.int32)),
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.int64()),
                ],
                names,
            )
        used = np.flatnonzero(total)
        for first in range(0, len(used), 200_000):
            part = used[first : first + 200_000]
            k = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(k, np.int32)),
                    pa.nulls(k, owner_type),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.binary()),
                    pa.array(part.astype(np.int32)),
                    pa.array(total[part]),
                ],
                names,
            )
        del total
        give_back()

    schema = f"kind int, doc_id {kind}, n bigint, node binary, bucket int, amount bigint"
    return docs.select("doc_id", "text").mapInArrow(over, schema)


class Frequencies:
    """Counters of all shingles; estimates and the rare-to-frequent order follow from them."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        mean = float(counts.mean()) if len(counts) else 0.0
        self.noise = mean + 8 * np.sqrt(mean)  # what shingles that merely share a counter add up to

    def of(self, shingles: np.ndarray) -> np.ndarray:
        return self.counts[(shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]

    def lists(self, shingles: np.ndarray) -> np.ndarray:
        """Estimated list lengths above the noise."""
        return np.maximum(self.of(shingles) - self.noise, 0.0)


def matches_wanted(counts: np.ndarray, n: int, percent: int = PERCENT) -> int:
    """The ``l`` with the least estimated cost for a set with ascending ``counts``.

    Entries scanned plus candidates verified: a candidate has ``l`` matches, so the entries of the
    ``l``-prefix hold at most a ``l``-th as many candidates; verifying one reads its whole set.
    """
    least = -(-percent * n // 100)
    sums = np.cumsum(counts[: n - least + MOST_MATCHES])
    best = 1, np.inf
    for wanted in range(1, min(MOST_MATCHES, least) + 1):
        entries = sums[n - least + wanted - 1]
        cost = entries + entries / wanted * n
        if cost < best[1]:
            best = wanted, cost
    return best[0]


def _packed(docs: DataFrame, frequencies, percent: int) -> DataFrame:
    """Per distinct set: its prefix in order, its star keys, and how typical its shingles are."""

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        f: Frequencies = frequencies.value
        rows: list[list] = [[], [], [], [], [], []]
        seen = set()
        for text in texts_of(batch.column(0)):
            s = set_of(text)
            node = _node(s)
            if not node or node in seen:
                continue
            seen.add(node)
            counts = f.of(s)
            order = np.lexsort((s, counts))
            n = len(s)
            wanted = matches_wanted(counts[order], n, percent)
            prefix = s[order[: n - (-(-percent * n // 100)) + wanted]]
            keys = [int(mixed(s ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)).min().view(np.int64)) for i in range(STAR_KEYS)]
            typical = float(np.log2(counts + 1.0).mean())
            for into, value in zip(rows, (node, n, wanted, prefix.tobytes(), keys, typical)):
                into.append(value)
        kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(r, k) for r, k in zip(rows, kinds)], ["node", "n", "wanted", "prefix", "keys", "typical"]
        )

    found = map_batches(
        docs.select("text"), pack, "node binary, n bigint, wanted int, prefix binary, keys array<bigint>, typical double"
    )
    return found.groupBy("node").agg(F.first(F.struct("n", "wanted", "prefix", "keys", "typical")).alias("p")).select(
        "node", "p.*"
    )


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` for the given nodes, computed from the texts again."""
    shipped = None
    if nodes.count() <= MAX_SHIPPED:
        keys = np.sort(np.array([int.from_bytes(bytes(r.node[:8]), "little") for r in nodes.collect()], np.uint64))
        shipped = docs.sparkSession.sparkContext.broadcast(keys)

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, sets, seen = [], [], set()
        for text in texts_of(batch.column(0)):
            s = set_of(text)
            node = _node(s)
            if not node or node in seen:
                continue
            if shipped is not None:
                key = np.uint64(int.from_bytes(node[:8], "little"))
                at = np.searchsorted(shipped.value, key)
                if at == len(shipped.value) or shipped.value[at] != key:
                    continue
            seen.add(node)
            found.append(node)
            sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])

    sets = map_batches(docs.select("text"), whole, "node binary, shingles binary")
    if shipped is None:
        sets = sets.join(nodes, "node", "left_semi")
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of stored ``pairs`` whose whole sets link."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(_sets(docs, nodes))
    both = (
        pairs.select("a", "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    )

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    links = stored(map_batches(both.select("a", "b", "sa", "sb"), check, "a binary, b binary"))
    release(sets)
    return links


def _stars(packed: DataFrame) -> DataFrame:
    """Each node with the most typical node that has one of its smallest mixed shingles."""
    keyed = packed.select("node", "n", "typical", F.posexplode("keys").alias("i", "key"))
    heads = keyed.groupBy("i", "key").agg(
        F.max(F.struct("typical", "node")).alias("head"), F.count("*").alias("members")
    )
    heads = heads.where(F.col("members") > 1).select("i", "key", F.col("head.node").alias("b"))
    pairs = keyed.select("i", "key", F.col("node").alias("a")).join(heads, ["i", "key"])
    return pairs.where(F.col("a") != F.col("b")).select("a", "b").distinct()


def _entries(packed: DataFrame, labels: DataFrame, frequencies, percent: int) -> DataFrame:
    """List entries: one per prefix shingle, or one per pair of blocks where a list is long.

    Nodes and components are named by their first 8 bytes here. ``cell`` has the two blocks that meet,
    ``flags`` twice the matches wanted, plus one if the entry is of the higher block.
    """
    name = lambda c: F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("bigint")
    rows = packed.join(labels, "node", "left").select(
        name(F.col("node")).alias("id"),
        name(F.coalesce("component", "node")).alias("component"),
        F.col("n").cast("int").alias("n"),
        "wanted",
        "prefix",
    )

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        f: Frequencies = frequencies.value
        ids, labels, n, wanted = (batch.column(i).to_numpy() for i in range(4))
        tokens = [np.frombuffer(x, np.uint64) for x in batch.column(4).to_pylist()]
        if not tokens:
            return
        sizes = [len(t) for t in tokens]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        token = np.concatenate(tokens)
        blocks = np.ceil(f.lists(token) / LIST_BLOCK).astype(np.int64).clip(1, MOST_BLOCKS)
        own = mixed(ids.view(np.uint64))[owner] % blocks.astype(np.uint64)
        again = np.repeat(np.arange(len(token)), blocks)
        other = np.arange(len(again)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        own = own.astype(np.int64)[again]
        cell = np.minimum(own, other) * MOST_BLOCKS + np.maximum(own, other)
        owner, place, token = owner[again], place[again], token[again]
        flags = 2 * wanted[owner] + (own > other)
        for first in range(0, len(owner), 200_000):
            part = slice(first, first + 200_000)
            o = owner[part]
            columns = [token[part].view(np.int64), cell[part], ids[o], labels[o], n[o], place[part], flags[part]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)], ENTRY
            )

    schema = "token bigint, cell int, id bigint, component bigint, n int, place int, flags int"
    return map_batches(rows, spread, schema)


def _meet(group: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one list, or of two blocks of it, that pass the length, prefix and position bounds.

    Of a linking pair the first ``l`` shared shingles lie in both ``l``-prefixes, and the ``i``-th leaves at most
    as many behind it as the shorter rest holds, so none of them leaves fewer than needed less ``l - 1``.
    """
    order = np.argsort(group["n"], kind="stable")
    g = {k: v[order] for k, v in group.items()}
    n = g["n"].astype(np.int64)
    place = g["place"].astype(np.int64)
    wanted, high = g["flags"] // 2, g["flags"] % 2
    level = np.maximum(1, place + 1 - (n - (-(-percent * n // 100))))
    ends = np.searchsorted(n, 100 * n // percent, side="right")
    across = g["cell"][0] // MOST_BLOCKS != g["cell"][0] % MOST_BLOCKS
    found: list[tuple] = []
    for i in range(len(n) - 1):
        j = slice(i + 1, ends[i])
        both = np.minimum(wanted[i], wanted[j])
        good = (g["component"][j] != g["component"][i]) & (np.maximum(level[i], level[j]) <= both)
        if across:
            good &= high[j] != high[i]
        after = np.minimum(n[i] - place[i], n[j] - place[j])
        good &= after >= needed(n[i], n[j], percent) - both + 1
        k = np.flatnonzero(good)
        if len(k):
            found.append((np.full(len(k), g["id"][i]), g["id"][j][k], both[k]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(map(np.concatenate, zip(*found)))


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components with as many shared prefix shingles as both ask for."""
    dealt = entries.repartition("token", "cell").sortWithinPartitions("token", "cell")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def made(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            token, cell, label = columns["token"], columns["cell"], columns["component"]
            starts = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])])
            sizes = np.diff(np.r_[starts, len(token)])
            # Lists of one component hold no pair to be looked for.
            mixed_up = np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts)
            pairs = []
            for first, size in zip(starts[mixed_up].tolist(), sizes[mixed_up].tolist()):
                pairs.append(_meet({c: v[first : first + size] for c, v in columns.items()}, percent))
            if pairs:
                a, b, wanted = map(np.concatenate, zip(*pairs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(wanted.astype(np.int32))], ["a", "b", "wanted"]
                )

        def joined() -> dict[str, np.ndarray]:
            return {c: np.concatenate([h[c] for h in held]) for c in ENTRY}

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append({c: batch.column(i).to_numpy() for i, c in enumerate(ENTRY)})
            last = held[-1]
            same = (last["token"] == last["token"][-1]) & (last["cell"] == last["cell"][-1])
            if same.all():
                continue  # the list may go on
            tail = int(np.flatnonzero(~same)[-1]) + 1
            held[-1] = {c: v[:tail] for c, v in last.items()}
            yield from made(joined())
            held = [{c: v[tail:] for c, v in last.items()}]
        if held:
            yield from made(joined())
        give_back()

    pairs = dealt.mapInArrow(over, "a bigint, b bigint, wanted int")
    return (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "wanted")
        .groupBy("a", "b")
        .agg(F.count("*").alias("matches"), F.max("wanted").alias("wanted"))
        .where(F.col("matches") >= F.col("wanted"))
        .select("a", "b")
    )


def similarity_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, node, component, component_id`` for every row of ``docs``.

    ``node`` is equal for equal sets, ``component`` in all of a component; ``component_id`` is the smallest id reachable by links.
    """
    spark = docs.sparkSession
    surveyed = stored(_survey(docs), "kind")
    counters = surveyed.where("kind = 1").groupBy("bucket").agg(F.sum("amount").alias("amount")).toArrow()
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    counts[counters.column("bucket").to_numpy()] = counters.column("amount").to_numpy()
    frequencies = spark.sparkContext.broadcast(Frequencies(counts))
    nodes = surveyed.where("kind = 0").select("doc_id", "n", "node")

    packed = stored(_packed(docs, frequencies, percent))
    near = stored(_stars(packed))
    links = _verified(docs, near, percent)
    release(near)
    labels = stored(components(links))
    candidates = _candidates(_entries(packed, labels, frequencies, percent), percent)
    named = packed.select("node", F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("bigint").alias("id"))
    candidates = stored(
        candidates.join(named.select(F.col("id").alias("a"), F.col("node").alias("x")), "a")
        .join(named.select(F.col("id").alias("b"), F.col("node").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    release(packed, labels)
    more = _verified(docs, candidates, percent)
    release(candidates)
    labels = components(links.union(more))

    known = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = stored(known.select("doc_id", F.col("n").alias("n_shingles"), "node", "component"))
    release(links, more, surveyed)
    least = known.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    linked = known.where("n_shingles > 0").join(least, "component")
    columns = ["doc_id", "n_shingles", "node", "component"]
    return linked.select(*columns, F.col("least").alias("component_id")).union(
        known.where("n_shingles = 0").select(*columns, F.col("doc_id").alias("component_id"))
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of its rows that of the smallest text.

    Rows without shingles all stay. A component whose ids are all null keeps its smallest text.
    """
    classes = similarity_classes(docs, percent).where("n_shingles > 0").select("doc_id", "node", "component", "component_id")
    ids = stored(
        classes.groupBy("doc_id").agg(
            F.count("*").alias("rows"), F.max((F.col("doc_id") != F.col("component_id")).cast("int")).alias("away")
        )
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    blank = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Rows whose id is theirs alone are decided by the id.
    decided = stored(ids.where("doc_id IS NOT NULL AND (away = 1 OR rows > 1)").select("doc_id"))
    kept = docs.where(F.col("doc_id").isNotNull() & ~blank).join(decided, "doc_id", "left_anti").select(*names)
    kept = kept.union(docs.where(blank).select(*names))
    repeated = ids.where("doc_id IS NULL OR rows > 1").select(F.col("doc_id").alias("known"))
    if repeated.limit(1).count():
        row = docs.where(~blank).select(F.struct(*names).alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("text"))
        spoken = row.join(repeated, F.col("id").eqNullSafe(F.col("known")), "left_semi")

        def node(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nodes = [_node(set_of(t)) for t in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary())], ["text", "node"])

        nodes = map_batches(spoken.select("text").distinct(), node, "text string, node binary")
        labels = classes.select("node", "component", "component_id").distinct()
        chosen = (
            spoken.join(nodes, "text")
            .join(labels, "node")
            .where(F.col("id").eqNullSafe(F.col("component_id")))
        )
        # Components can share their smallest id, or have none.
        first = chosen.groupBy("id", "component").agg(F.min_by("row", "text").alias("row"))
        kept = kept.union(first.select("row.*").select(*names))
    return kept
