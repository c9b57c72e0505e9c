"""URL filter: rules in a sorted array of 64-bit digests, memory-mapped on the executors.

A rule ``(host, path, verdict)`` fits a url if its host is the url's or a parent domain of it and
the url's path starts with the rule's path. The digests of all rules lie in one sorted array; the
candidates of a url (host suffix + path prefix) are looked up by vectorised binary search, and a
hit counts only if the stored full string is equal, so colliding digests do no harm.

Defined results: a null url, or one without ``://``, has empty host and path and fits no rule that
names a host; repeated rows are judged one by one; null ids are kept; with an empty rule table the
default verdict holds. Rules with a null field take no part; of equal rules with different
verdicts ``block`` holds. Of fitting rules the longest string wins, at a tie the longer host.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from functools import cache

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Up to this many rules the array is shipped to the executors (about 100 bytes a rule);
# beyond it, rules and urls meet in a join.
MAX_MAPPED_RULES = 5_000_000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Columns ``host, path, rule, verdict`` for each row, behind the other columns of ``pages``.

    Columns of ``pages`` with one of these names are replaced.
    """
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    parsed = pages.drop("rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if rules.count() <= MAX_MAPPED_RULES:
        return _probe(parsed, rules, default)
    return _join(parsed, rules, default)


# -- sorted digest array ---------------------------------------------------------------------


def _sorted(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Sorted digests, the order of the texts, and the texts themselves as offsets and bytes."""
    raw = [text.encode() for text in texts]
    keys = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
    order = np.argsort(keys, kind="stable")
    ends = np.cumsum([0] + [len(raw[i]) for i in order])
    return keys[order], order, ends.astype(np.int64), np.frombuffer(b"".join(raw[i] for i in order), np.uint8)


@cache
def _folder() -> str:
    return os.path.realpath(tempfile.mkdtemp(prefix="rules-"))


def _build(rules: list[tuple[str, str, str]], folder: str) -> str:
    """Write the index as one file of arrays; its name is the digest of the rules."""
    rules = sorted(rules)
    hosts = sorted({host for host, _, _ in rules})
    lengths: dict[str, set[int]] = {host: set() for host in hosts}
    for host, path, _ in rules:
        lengths[host].add(len(path))
    keys, order, ends, text = _sorted([host + path for host, path, _ in rules])
    host_keys, host_order, host_ends, host_text = _sorted(hosts)
    verdicts = sorted({verdict for _, _, verdict in rules})
    by_host = [sorted(lengths[hosts[i]]) for i in host_order]
    arrays = {
        "keys": keys,
        "ends": ends,
        "text": text,
        "verdict": np.array([verdicts.index(rules[i][2]) for i in order], np.uint16),
        "names": np.frombuffer("\n".join(verdicts).encode(), np.uint8),
        "host_keys": host_keys,
        "host_ends": host_ends,
        "host_text": host_text,
        "length_ends": np.cumsum([0] + [len(x) for x in by_host]).astype(np.int64),
        "lengths": np.array([n for x in by_host for n in x], np.int32),
    }
    name = f"rules-{hashlib.sha256(repr(rules).encode()).hexdigest()[:24]}.bin"
    if os.path.exists(os.path.join(folder, name)):
        return os.path.join(folder, name)
    with open(os.path.join(folder, name), "wb") as out:
        head = repr([(k, a.dtype.str, len(a)) for k, a in arrays.items()]).encode()
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(b"\0" * (-out.tell() % 8) + a.tobytes())
    return os.path.join(folder, name)


@cache
def _mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of an index file as views of one memory map; processes share its pages."""
    import ast

    whole = np.memmap(path, np.uint8, mode="r")
    size = int.from_bytes(whole[:8].tobytes(), "little")
    at, arrays = 8 + size, {}
    for name, kind, n in ast.literal_eval(whole[8:at].tobytes().decode()):
        at += -at % 8
        width = np.dtype(kind).itemsize * n
        arrays[name] = whole[at : at + width].view(kind)
        at += width
    return arrays


def _lookup(keys: np.ndarray, ends: np.ndarray, text: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Place of each wanted string, or -1; equal digests are told apart by the stored strings."""
    digests = np.fromiter(map(xxhash.xxh64_intdigest, wanted), np.uint64, len(wanted))
    at = np.searchsorted(keys, digests)
    found = np.full(len(wanted), -1, np.int64)
    for i in np.flatnonzero(np.append(keys, np.uint64(0))[at] == digests):
        for j in range(at[i], len(keys)):
            if keys[j] != digests[i]:
                break
            if text[ends[j] : ends[j + 1]].tobytes() == wanted[i]:
                found[i] = j
                break
    return found


def _suffixes(host: str) -> list[str]:
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def _rules_for(index: dict[str, np.ndarray], hosts: list[str], paths: list[str]) -> tuple[list, list]:
    names = index["names"].tobytes().decode().split("\n")
    known: dict[str, int] = dict.fromkeys(s for host in set(hosts) for s in _suffixes(host))
    places = _lookup(index["host_keys"], index["host_ends"], index["host_text"], [h.encode() for h in known])
    known = dict(zip(known, places.tolist()))
    asked: dict[bytes, int] = {}
    tries: list[list[tuple[int, int, bytes]]] = []
    ends, lengths = index["length_ends"], index["lengths"]
    for host, path in zip(hosts, paths):
        tries.append([])
        for suffix in _suffixes(host):
            if (k := known[suffix]) >= 0:
                for n in lengths[ends[k] : ends[k + 1]].tolist():
                    if n <= len(path):
                        text = (suffix + path[:n]).encode()
                        asked[text] = 0
                        tries[-1].append((len(suffix) + n, len(suffix), text))
    asked = dict(zip(asked, _lookup(index["keys"], index["ends"], index["text"], list(asked)).tolist()))
    rules, verdicts = [], []
    for candidates in tries:
        best = max((c for c in candidates if asked[c[2]] >= 0), default=None)
        rules.append(best and best[2].decode())
        verdicts.append(best and names[index["verdict"][asked[best[2]]]])
    return rules, verdicts


def _probe(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    context = parsed.sparkSession.sparkContext
    rows = [tuple(row) for row in rules.collect()]  # at most MAX_MAPPED_RULES
    path = _build(rows, _folder())
    context.addFile(path)  # the driver serves the file for as long as it runs
    name = os.path.basename(path)

    @F.pandas_udf("struct<rule string, verdict string>")
    def probe(hosts, paths):
        import pandas as pd

        index = _mapped(SparkFiles.get(name))
        rule, verdict = _rules_for(index, hosts.tolist(), paths.tolist())
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    hit = probe(F.col("host"), F.col("path"))
    kept = [F.col(f"`{c}`") for c in parsed.columns]
    return parsed.select(*kept, hit.alias("__hit")).select(
        *kept, F.col("__hit.rule").alias("rule"), F.coalesce("__hit.verdict", F.lit(default)).alias("verdict")
    )


# -- beyond the bound ------------------------------------------------------------------------


def _join(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts by a join on the rule's host, for rule tables too large to ship.

    Only distinct (host, path) pairs are judged; a hot parent domain is split by the skew join.
    """
    urls = parsed.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    r = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    best = (
        urls.withColumn("rule_host", F.explode(suffixes))
        .join(r, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.char_length("rule_host") + F.char_length("rule_path")).alias("size"),
                    F.char_length("rule_host").alias("host_size"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    "verdict",
                )
            ).alias("__hit")
        )
    )
    kept = [F.col(f"`{c}`") for c in parsed.columns]
    return parsed.join(best, ["host", "path"], "left").select(
        *kept, F.col("__hit.rule").alias("rule"), F.coalesce("__hit.verdict", F.lit(default)).alias("verdict")
    )
