"""URL rules by Bloom filter cascades: exact membership without a join.

A rule is a host and a path prefix. Every URL stands for a set of keys, one for each
domain above its host and each of the rules' path lengths; the keys of all URLs
are the universe. Level 1 of a cascade is a Bloom filter of the listed keys. The
keys of the universe that pass it without being listed go into level 2, the listed
ones that pass level 2 into level 3, and so on until a level has no false
positive. A key of the universe is listed if the first level that turns it away is an
even one, or if all levels let it pass and their number is odd.

Keys are dealt to shards, each with a cascade of its own, so a filter stays small
whatever the number of rules. The filters are measured before they are sent out
and sent in parts of a bounded size, one pass over the rows each.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe
from tallybook.functions.storage import store

SHARD_KEYS = 200_000  # listed keys aimed at for each shard
PART_BYTES = 16 << 20  # filters sent to each task at once
FALSE_RATE = 0.01


class Bloom:
    """Bits of keys; the places of a key depend on the level too."""

    def __init__(self, level: int, bits: bytes, hashes: int):
        self.level, self.hashes, self.bits = level, hashes, np.frombuffer(bits, np.uint8)

    @classmethod
    def of(cls, level: int, keys: Sequence[bytes]) -> Bloom:
        size = max(64, math.ceil(len(keys) * -math.log(FALSE_RATE) / math.log(2) ** 2 / 8) * 8)
        self = cls(level, bytes(size // 8), max(1, round(size / max(1, len(keys)) * math.log(2))) if len(keys) > 5 else 7)
        bits = np.zeros(size, np.uint8)
        for key in keys:
            bits[self._places(key, size)] = 1
        self.bits = np.packbits(bits)
        return self

    def _places(self, key: bytes, size: int) -> list[int]:
        first = xxhash.xxh3_128_intdigest(key, self.level)
        step, first = first >> 64 | 1, first & (1 << 64) - 1
        return [(first + i * step) % size for i in range(self.hashes)]

    def __contains__(self, key: bytes) -> bool:
        bits = self.bits
        return all(bits[p >> 3] >> (7 - (p & 7)) & 1 for p in self._places(key, 8 * len(bits)))


def listed(levels: Sequence[Bloom], key: bytes) -> bool:
    """Whether a key of the universe is listed in the cascade."""
    for i, level in enumerate(levels):
        if key not in level:
            return i % 2 == 1
    return len(levels) % 2 == 1


def later_levels(members: list[bytes], passing: list[bytes]) -> list[Bloom]:
    """Levels from 2 on, for listed keys and the others that pass level 1."""
    levels: list[Bloom] = []
    inside, outside = passing, members  # of the level to build next
    while inside:
        level = Bloom.of(len(levels) + 2, inside)
        levels.append(level)
        inside, outside = [k for k in outside if k in level], inside
    return levels


def _shard(key: bytes, shards: int) -> int:
    return xxhash.xxh64_intdigest(key, 7) % shards


def keys_of(host: str, path: str, lengths: Iterable[int]) -> list[str]:
    """Keys of a URL, longest first: its host and the domains above, with the path's heads of the given lengths."""
    names, at = [host], host.find(".")
    while at >= 0:
        names.append(host[at + 1 :])
        at = host.find(".", at + 1)
    heads = [path[:n] for n in lengths if n <= len(path)]
    return sorted((name + head for name in names for head in heads), key=lambda k: (-len(k), k))


def url_parts(url: str = "url"):
    """host and path columns; both empty for a null or a URL without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), upper, lower)
    return host.alias("host"), F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path")


Sent = dict[str, dict[int, list[Bloom]]]  # filters by action and shard


class Cascades:
    """Cascades of the rules for the keys of a table's URLs. ``rules``: host, path, action; hosts in lower case."""

    def __init__(self, urls: DataFrame, rules: DataFrame):
        spark = urls.sparkSession
        # A rule that is both allowed and blocked is allowed.
        keyed = rules.groupBy(F.col("host"), F.col("path")).agg(F.min("action").alias("action"))
        keyed = store(keyed.select(F.concat("host", "path").alias("key"), F.char_length("path").alias("n"), "action"), "rules")
        keyed = keyed.filter("key IS NOT NULL")
        self.lengths = sorted(r.n for r in keyed.select("n").distinct().toLocalIterator())
        self.shards = shards = max(1, -(-keyed.count() // SHARD_KEYS))
        self.urls = urls.select(*url_parts()).distinct()

        def first_level(key: tuple, table: pa.Table) -> pa.Table:
            level = Bloom.of(1, [k.encode() for k in table.column("key").to_pylist()])
            return _filter_rows(key[0].as_py(), key[1].as_py(), [level])

        def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                shard = [_shard(k.encode(), shards) for k in b.column("key").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("action"), pa.array(shard, pa.int32()), b.column("key")], names=["action", "shard", "key"])

        keyed = store(keyed.select("key", "action").distinct().mapInArrow(shard_of, "action string, shard int, key string"), "keys")
        first = store(keyed.groupBy("action", "shard").applyInArrow(first_level, FILTERS), "filters")
        passing = None
        for sent in parts(first):
            found = self._passing(spark.sparkContext.broadcast(sent))
            passing = found if passing is None else passing.union(found)
        if passing is None:
            self.filters = first
            return
        passing = join_null_safe(passing.distinct(), keyed, ["action", "shard", "key"], "left_anti")

        def rest(key: tuple, members: pa.Table, others: pa.Table) -> pa.Table:
            lists = [[k.encode() for k in t.column("key").to_pylist()] for t in (members, others)]
            return _filter_rows(key[0].as_py(), key[1].as_py(), later_levels(*lists))

        later = keyed.groupBy("action", "shard").cogroup(passing.groupBy("action", "shard")).applyInArrow(rest, FILTERS)
        self.filters = store(first.union(later), "filters")

    def _passing(self, sent) -> DataFrame:
        """action, shard, key: keys of the universe that pass the first levels sent out."""
        lengths, shards = self.lengths, self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found: set[tuple[str, int, str]] = set()
                for host, path in zip(b.column("host").to_pylist(), b.column("path").to_pylist()):
                    for key in keys_of(host, path, lengths):
                        raw = key.encode()
                        shard = _shard(raw, shards)
                        for action, by_shard in sent.value.items():
                            if shard in by_shard and raw in by_shard[shard][0]:
                                found.add((action, shard, key))
                columns = list(zip(*found)) or [(), (), ()]
                kinds = (pa.string(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["action", "shard", "key"])

        return self.urls.mapInArrow(run, "action string, shard int, key string")


FILTERS = "action string, shard int, level int, hashes int, bits binary"


def _filter_rows(action: str, shard: int, levels: list[Bloom]) -> pa.Table:
    rows = {
        "action": pa.array([action] * len(levels), pa.string()),
        "shard": pa.array([shard] * len(levels), pa.int32()),
        "level": pa.array([x.level for x in levels], pa.int32()),
        "hashes": pa.array([x.hashes for x in levels], pa.int32()),
        "bits": pa.array([x.bits.tobytes() for x in levels], pa.binary()),
    }
    return pa.table(rows)


def parts(filters: DataFrame) -> Iterator[Sent]:
    """The filters, whole shards together, in parts of at most PART_BYTES (or one shard)."""
    sizes = filters.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).orderBy("shard")
    part, filled = [], 0
    for row in [*sizes.toLocalIterator(), None]:
        if part and (row is None or filled + row.n > PART_BYTES):
            sent: Sent = {}
            for x in filters.filter(F.col("shard").between(part[0], part[-1])).orderBy("level").toLocalIterator():
                sent.setdefault(x.action, {}).setdefault(x.shard, []).append(Bloom(x.level, bytes(x.bits), x.hashes))
            yield sent
            part, filled = [], 0
        if row is not None:
            part.append(row.shard)
            filled += row.n


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages``.

    A rule (host, path, action) fits its host and all subdomains if the URL's path
    starts with the rule's; the longest rule that fits decides (of equal ones, the first by text), and where none
    does, ``default``: the URL is in no list. Null and malformed URLs have an
    empty host and path. A rule with a null part is left out; one given with two
    actions takes the first of them by name. No rules: every row gets the default. Repeated rows
    repeat. Other columns are not looked at.
    """
    plain = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    cascades = Cascades(plain.select("url"), rules)
    judged = plain.select("page_id", *url_parts(), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    for sent in parts(cascades.filters):
        judged = _judge_part(judged, cascades, judged.sparkSession.sparkContext.broadcast(sent))
    return judged


def _judge_part(pages: DataFrame, cascades: Cascades, sent) -> DataFrame:
    lengths, shards = cascades.lengths, cascades.shards

    def best(host: str, path: str, rule: str | None, verdict: str) -> tuple[str | None, str]:
        for key in keys_of(host, path, lengths):
            if rule is not None and (-len(rule), rule) <= (-len(key), key):
                break
            raw = key.encode()
            shard = _shard(raw, shards)
            for action in sorted(sent.value):
                levels = sent.value[action].get(shard)
                if levels and listed(levels, raw):
                    return key, action
        return rule, verdict

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [best(*x) for x in zip(*[b.column(c).to_pylist() for c in ("host", "path", "rule", "verdict")])]
            rule, verdict = ([x[i] for x in found] for i in (0, 1))
            columns = [*(b.column(c) for c in ("page_id", "host", "path")), pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return pages.mapInArrow(run, pages.schema)
