"""Near duplicates by SimHash with a Gray-order hierarchical index.

Distinct fingerprints within ``bits`` differing bits agree on one of ``bits + 1`` blocks
of bits, so they meet under a key of block and value. Inside a key they are sorted by Gray
rank, and runs of neighbours are factored into nodes that hold the bits all of them share.
A search goes down from the key; what a node's shared bits add in differences accumulates,
and the whole group below is dropped as soon as that exceeds the bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import row_key
from millrace.llm.components import components
from millrace.session import materialise

SHINGLE = 3  # words
BITS = 2
SEED = 42
FAN = 8  # entries under a node
KEY_ROWS = 4096  # a key with more fingerprints is cut by further bits
TASK_ROWS = 1 << 16
FRONTIER = 1 << 17  # pairs of query and node looked at together


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, A-Z lower-cased, repeats included."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(r, seed) for r in runs], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each set if over half of the hashes have it; zero without hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big") if len(hashes) else 0


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint as a signed long."""
    found = np.array([fingerprint(shingle_hashes(t)) for t in texts], dtype=np.uint64)
    return pd.Series(found.view(np.int64))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a code word in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Fingerprints of several keys, as one tree per key.

    ``levels[0]`` are the fingerprints in the order of key and Gray rank; a level above
    holds, for each run of up to ``FAN`` entries below, the bits they share.
    """

    def __init__(self, codes: np.ndarray, keys: np.ndarray):
        order = np.lexsort([gray_rank(codes), keys])
        self.codes, group = codes[order], keys[order]
        self.levels = [(self.codes, np.full(len(codes), ~np.uint64(0)), np.arange(len(codes) + 1))]
        while True:
            pattern, mask, _ = self.levels[-1]
            new_key = np.r_[True, group[1:] != group[:-1]]
            start = np.maximum.accumulate(np.where(new_key, np.arange(len(group)), 0))
            heads = np.flatnonzero((np.arange(len(group)) - start) % FAN == 0)
            lead = np.repeat(pattern[heads], np.diff(np.r_[heads, len(group)]))
            apart = np.bitwise_or.reduceat((pattern ^ lead) | ~mask, heads)
            self.levels.append((pattern[heads], ~apart, np.r_[heads, len(group)]))
            group = group[heads]
            if len(group) == len(np.unique(group)):
                break
        # the tree above each fingerprint
        self.root = np.searchsorted(group, keys[order])

    def pairs(self, most: int):
        """Arrays of places (a, b), a < b, of fingerprints of one key within ``most`` bits."""
        if not len(self.codes):
            return
        top = len(self.levels) - 1
        step = max(1, FRONTIER // (FAN * FAN))
        for first in range(0, len(self.codes), step):
            query = np.arange(first, min(first + step, len(self.codes)))
            yield from self._descend(query, self.root[query], np.zeros(len(query), np.uint8), np.zeros(len(query), np.uint64), top, most)

    def _descend(self, query, node, apart, known, level, most):
        pattern, mask, bounds = self.levels[level]
        more = mask[node] & ~known  # bits that were not yet compared
        apart = apart + np.bitwise_count((self.codes[query] ^ pattern[node]) & more)
        live = apart <= most
        query, node, apart, known = query[live], node[live], apart[live], mask[node][live]
        if level == 0:
            yield query, node
            return
        for part in range(0, len(query), FRONTIER // FAN):
            q, n, a, k = (x[part : part + FRONTIER // FAN] for x in (query, node, apart, known))
            count = bounds[n + 1] - bounds[n]
            at = np.repeat(np.arange(len(q)), count)
            child = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[n], count)
            if level == 1:  # each pair once
                later = child > q[at]
                at, child = at[later], child[later]
            yield from self._descend(q[at], child, a[at], k[at], level - 1, most)


def _forest(n: int, pairs) -> np.ndarray:
    """The least place that each place is linked to, directly or through others."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _cuts(mask: int, parts: int) -> list[int]:
    """Masks that add one of ``parts`` even shares of the free bits, from the left."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    shares = [free[len(free) * i // parts : len(free) * (i + 1) // parts] for i in range(parts)]
    return [mask | sum(1 << b for b in share) for share in shares]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(codes: DataFrame, bits: int = BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Edges (a, b) that connect the distinct longs ``code`` within ``bits`` differing bits.

    Not all pairs: a task returns a forest that connects what it found connected. A key
    with more than ``key_rows`` codes is replaced by ``bits + 1`` keys with more bits, on
    which the same holds, until keys are small or nearly all bits are in the key.
    """
    masks = [0]
    waiting, ready = codes.select("code", F.lit(0).cast("long").alias("mask")), []
    while masks:
        finer = [x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in _cuts(m, bits + 1)]))]
        keyed = waiting.select("code", F.explode(F.element_at(F.create_map(*finer), F.col("mask"))).alias("mask"))
        keyed = materialise(keyed.withColumn("value", F.col("code").bitwiseAND(F.col("mask"))), "keys")
        counted = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        busy = counted.filter(F.col("n") > key_rows).select("mask", "value", F.lit(True).alias("busy"))
        # a code that is alone under its key has no partner there
        placed = keyed.join(counted.select("mask", "value"), ["mask", "value"], "left_semi")
        placed = materialise(placed.join(busy, ["mask", "value"], "left"), "placed")
        masks = [r.mask & (1 << 64) - 1 for r in placed.filter("busy").select("mask").distinct().collect()]  # of a few
        masks = [m for m in masks if 64 - m.bit_count() > bits + 1]
        split = F.col("busy") & F.col("mask").isin([_signed(m) for m in masks]) if masks else F.lit(False)
        split = F.coalesce(split, F.lit(False))
        ready.append(placed.filter(~split))
        waiting = placed.filter(split).select("code", "mask")
    keyed = ready[0]
    for more in ready[1:]:
        keyed = keyed.unionByName(more)
    total = keyed.count()
    tasks = max(1, -(-total // TASK_ROWS))
    # whole keys go to a task; a key number inside it tells them apart
    task = F.pmod(F.xxhash64("mask", "value"), F.lit(tasks))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        code = rows["code"].to_numpy()
        key = rows.groupby(["mask", "value"], sort=False).ngroup().to_numpy()
        index = GrayIndex(code.view(np.uint64), key)
        label = _forest(len(code), index.pairs(bits))
        held = np.flatnonzero(label != np.arange(len(code)))
        found = index.codes.view(np.int64)
        return pd.DataFrame({"a": found[held], "b": found[label[held]]})

    keyed = keyed.select("code", "mask", "value", task.alias("task"))
    return keyed.groupBy("task").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """row_key, doc_id, code (the fingerprint as a signed long), root (the least code of the
    component, as such) and component_id, the smallest doc_id of the component.

    A null or empty text has fingerprint zero and is linked like any other. A null doc_id
    is never the smallest; a component without any other has component_id NULL. Repeated
    rows are rows of one component; other columns are left out.
    """
    made = docs.select("doc_id", row_key().alias("row_key"), fingerprint_of("text").alias("code"))
    made = materialise(made, "fingerprints", few_files=True)
    codes = materialise(made.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    roots = materialise(components(links(codes.select("code"), bits)), "roots")
    joined = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    joined = materialise(joined, "rooted")
    groups = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    rooted = joined.select("code", "root").join(groups, "root")
    return made.join(rooted, "code").select("row_key", "doc_id", "code", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    hexadecimal = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The keys (``row_key``) of one document per component: that of the smallest doc_id,
    and of several texts or rows with that doc_id the one with the least key."""
    found = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return found.groupBy("root").agg(F.min("row_key").alias("row_key")).select("row_key")
