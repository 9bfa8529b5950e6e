"""SimHash near-duplicates: fingerprints, and a self-join of them over binary tries.

Fingerprint.  A-Z is lower-cased; words are runs of bytes other than space and 0x09-0x0D; shingles are 4 consecutive words
joined by one space, repeats included (fewer words: the whole sequence).  Each shingle is hashed by XXH64 with seed 42.  A
bit is 1 if over half of the hashes have it.  A text without words, and a null one, has fingerprint zero.

Join.  Two documents are linked if their fingerprints differ in at most ``BUDGET`` bits.  Documents with one fingerprint
are linked at once, so the join runs over distinct fingerprints, each standing for its smallest doc_id.  Of BUDGET + 1
blocks of bits, two linked fingerprints agree in one at least; each fingerprint goes to one trie for each block, made of the
other bits.  A trie is the sorted array of its fingerprints; a node is a range of it.  The join goes down
pairs of nodes together, level by level, adds up the bits in which their paths differ and drops a pair over the budget.
Pairs of nodes whose remaining bits cannot exceed the budget, and pairs already in one component, are not opened.

Each trie reports a spanning forest of the links in it, never all pairs; components of the whole graph follow from those.
A trie that would hold more than ``TRIE_ROWS`` fingerprints is split again, up to ``LEVELS`` times: members agree in their
block, so the budget applies to the other bits, which are cut into BUDGET + 1 blocks in turn.

Null doc_ids: such rows are fingerprinted; their component_id is the smallest other doc_id reachable, null if none.  Equal rows
give equal rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import numbered, renamed
from .components import components, saved
from .kernel import LOWER, PLAIN_WORD, Chunk, batches

SHINGLE = 4
SEED = 42
BUDGET = 4
BITS = 64
#: Fingerprints in one trie before it is split again.
TRIE_ROWS = 1 << 15
#: How often the bits are cut into blocks.
LEVELS = 4
#: Rows of fingerprints in one task, about.
TASK_ROWS = 1 << 19
_LANES = np.uint64(0x0101010101010101)


def fingerprints(texts: list[bytes], width: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text, as uint64."""
    joined = [b" ".join(t.translate(LOWER).split()) for t in texts]
    start, end, first = Chunk(joined).words(PLAIN_WORD)
    raw = b"\n".join(joined) + b"\n"
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    upto = np.concatenate([[0], np.cumsum(n_shingles)])
    total = int(upto[-1])
    out = np.zeros(len(texts), np.uint64)
    if not total:
        return out
    doc = np.repeat(np.arange(len(texts)), n_shingles)
    word = np.arange(total) - upto[doc] + first[doc]
    last = np.minimum(word + width, first[doc + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(start[word].tolist(), end[last].tolist(), strict=True)), np.uint64, total)
    # Eight bits at a time, as eight one-byte counters in a word; runs of at most 255 cannot overflow a counter.
    some = np.flatnonzero(n_shingles)
    runs = np.concatenate([np.arange(a, b, 255) for a, b in zip(upto[some].tolist(), upto[some + 1].tolist(), strict=True)])
    doc_of_run = np.searchsorted(runs, upto[some])
    for k in range(8):
        counts = np.add.reduceat((hashed >> np.uint64(k)) & _LANES, runs)
        per_doc = np.add.reduceat(counts.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_of_run, axis=0)
        for byte in range(8):
            out[some[2 * per_doc[:, byte] > n_shingles[some]]] |= np.uint64(1) << np.uint64(8 * byte + k)
    return out


class Forest:
    """Union-find over positions of an array."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


#: Pairs of nodes that are opened at once, and pairs of values that are compared at once.
NODE_PAIRS, VALUE_PAIRS = 1 << 14, 1 << 18


def trie_links(values: np.ndarray, root_bits: int, budget: int = BUDGET, bits: int = BITS, most_pairs: int = NODE_PAIRS) -> np.ndarray:
    """A spanning forest, as pairs of positions, of the links among sorted distinct values with equal leading bits.

    Values with different leading ``root_bits`` bits are never compared.  The pairs of nodes that wait are at most four times
    ``most_pairs`` for each level of the trie, and values are compared ``VALUE_PAIRS`` at a time, however many there are.
    """
    n = len(values)
    forest, found = Forest(n), []
    if n < 2:
        return np.zeros((0, 2), np.int64)
    roots = values >> np.uint64(bits - root_bits) if root_bits else np.zeros(n, np.uint64)
    heads = np.flatnonzero(np.concatenate([[True], roots[1:] != roots[:-1]]))
    tails = np.append(heads[1:], n)
    some = tails - heads > 1
    zero = np.zeros(int(some.sum()), np.int64)
    # Components as they were when ``known`` links had been found; they only grow.
    label, change, known = None, None, 0
    # A pair of nodes: two ranges, the depth is common to all of a stack entry, the bits that differ so far.
    stack = [(root_bits, heads[some], tails[some], heads[some], tails[some], zero)]
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if not len(a0):
            continue
        if len(a0) > most_pairs:  # depth first where the frontier is wide, which bounds memory
            half = len(a0) // 2
            for part in (slice(half, None), slice(None, half)):
                stack.append((depth, a0[part], a1[part], b0[part], b1[part], diff[part]))
            continue
        # Small pairs of nodes are compared value by value, as are those that must fit.
        size = (a1 - a0) * (b1 - b0)
        small = (size <= 64) | (diff + bits - depth <= budget)
        some, upto = np.flatnonzero(small), np.cumsum(size[small])
        cuts = np.searchsorted(upto, np.arange(VALUE_PAIRS, int(upto[-1]) if len(upto) else 0, VALUE_PAIRS))
        for part in np.split(some, np.unique(cuts)):
            i, j = _products(a0[part], a1[part], b0[part], b1[part])
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            near &= i < j
            for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
                if forest.join(x, y):
                    found.append((x, y))
        a0, a1, b0, b1, diff = (x[~small] for x in (a0, a1, b0, b1, diff))
        if not len(a0) or depth >= bits:
            continue
        # Where one bit splits the ranges.
        am, bm = _split(values, a0, a1, depth, bits), _split(values, b0, b1, depth, bits)
        same = a0 == b0
        children = [(a0, am, b0, bm, diff, None), (am, a1, bm, b1, diff, None), (a0, am, bm, b1, diff + 1, None), (am, a1, b0, bm, diff + 1, ~same)]
        parts = []
        for c0, c1, d0, d1, e, only in children:
            ok = (c1 > c0) & (d1 > d0) & (e <= budget)
            if only is not None:
                ok &= only
            ok &= ~((c0 == d0) & (c1 - c0 < 2))
            parts.append([x[ok] for x in (c0, c1, d0, d1, e)])
        c0, c1, d0, d1, e = (np.concatenate(x) for x in zip(*parts, strict=True))
        if len(c0):
            # Nodes that lie wholly in one component already need no look.
            if len(found) - known > n // 16 + 1:
                known = len(found)
                label = np.fromiter((forest.root(k) for k in range(n)), np.int64, n)
                change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
            if label is not None:
                whole = (change[c1 - 1] == change[c0]) & (change[d1 - 1] == change[d0]) & (label[c0] == label[d0])
                c0, c1, d0, d1, e = (x[~whole] for x in (c0, c1, d0, d1, e))
            stack.append((depth + 1, c0, c1, d0, d1, e))
    return np.array(found, np.int64).reshape(-1, 2)


def _products(a0, a1, b0, b1):
    """All pairs of positions of each pair of (small) ranges."""
    na, nb = a1 - a0, b1 - b0
    count = na * nb
    total = int(count.sum())
    which = np.repeat(np.arange(len(count)), count)
    inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    return a0[which] + inside // nb[which], b0[which] + inside % nb[which]


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """In each range, the first value that has the bit at this depth."""
    shift = np.uint64(bits - 1 - depth)
    base = (values[lo] >> shift) | np.uint64(1)
    return np.clip(np.searchsorted(values, base << shift), lo, hi)


def _split_by_blocks(rows: DataFrame, budget: int) -> DataFrame:
    """Each row once for each block of its remaining bits: key grows by the block's number and value, rest loses the block.

    ``rest`` has the remaining bits in front; ``bits`` tells how many there are.
    """
    wide = rows.select("*", F.explode(F.array(*(F.lit(j) for j in range(budget + 1)))).alias("j"))
    wide = wide.withColumn("at", F.expr(f"cast(floor(bits * j / {budget + 1}) as int)"))
    wide = wide.withColumn("size", F.expr(f"cast(floor(bits * (j + 1) / {budget + 1}) as int) - at"))
    value = "shiftrightunsigned(shiftleft(rest, at), 64 - size)"
    before = "case when at = 0 then 0L else shiftleft(shiftrightunsigned(rest, 64 - at), 64 - at) end"
    behind = "case when at + size >= 64 then 0L else shiftrightunsigned(shiftleft(rest, at + size), at) end"
    width = max(1, -(-BITS // (budget + 1)))
    key = f"shiftleft(key, {_key_bits(budget)}) | shiftleft(cast(j as bigint), {width}) | {value}"
    return wide.select("fp", F.expr(key).alias("key"), F.expr(f"{before} | {behind}").alias("rest"), (F.col("bits") - F.col("size")).alias("bits"))


def _key_bits(budget: int) -> int:
    return -(-BITS // (budget + 1)) + budget.bit_length()


def links(fps: DataFrame, budget: int = BUDGET, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """Columns a and b (long): fingerprints that are linked, enough of them to connect all that are.

    ``fps`` has distinct fingerprints in the column fp (long).
    """
    spark = fps.sparkSession
    keyed = _split_by_blocks(fps.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"), F.lit(BITS).alias("bits")), budget)
    done = []
    for level in range(1, LEVELS + 1):
        if level == LEVELS or level * _key_bits(budget) > BITS - _key_bits(budget):
            break
        hot = saved(keyed.groupBy("key").count().where(F.col("count") > trie_rows).select("key"), "hot")
        if hot.isEmpty():
            break
        # Spark knows the size of the written table and broadcasts it only if it is small.
        done.append(keyed.join(hot, "key", "left_anti").select("fp", "key", "rest", F.lit(level).alias("level")))
        keyed = _split_by_blocks(keyed.join(hot, "key", "left_semi"), budget)
    parts = [*done, keyed.select("fp", "key", "rest", F.lit(len(done) + 1).alias("level"))]
    rows = reduce(DataFrame.unionByName, parts)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(budget + 1) * fps.count() // TASK_ROWS))
    dealt = rows.repartition(n, "level", "key").sortWithinPartitions("level", "key", "rest")

    def join(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp, rest in _tries(stream):
            pairs = trie_links(rest.view(np.uint64), 0, budget)
            if len(pairs):
                got = fp[pairs]
                yield pa.record_batch([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], names=["a", "b"])

    return dealt.mapInArrow(join, "a long, b long").distinct()


def _tries(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The fingerprints and remaining bits of each trie of two or more, from rows sorted by level and key."""
    held: list[list[np.ndarray]] = []

    def whole() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if held:
            fp, rest = (np.concatenate([x[k] for x in held]) for k in (0, 1))
            if len(fp) > 1:
                by = np.argsort(rest.view(np.uint64))
                yield fp[by], rest[by]
            held.clear()

    last = None
    for batch in stream:
        fp, key, rest, level = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("fp", "key", "rest", "level"))
        if not len(fp):
            continue
        cut = np.flatnonzero((key[1:] != key[:-1]) | (level[1:] != level[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)], strict=True):
            if last != (level[a], key[a]):
                yield from whole()
                last = (level[a], key[a])
            held.append([fp[a:b], rest[a:b]])
    yield from whole()


def simhash(docs: DataFrame, width: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns doc_id, those in ``keep`` and fp (long). A column of ``keep`` may have the name of another; both are in the table."""
    base = numbered(docs, keep, "doc_id", "text")
    names = ["doc_id", *(f"__keep{k}" for k in range(len(keep)))]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*names).schema) + ", fp long"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, 1 << 20):
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fingerprints(texts, width).view(np.int64))], names=[*names, "fp"])

    return renamed(base.mapInArrow(run, schema), keep)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row for each document: doc_id, fp (long), component_id (the smallest doc_id reachable, itself included).

    Extra columns of ``docs`` are not read. An empty table gives an empty result.
    """
    marked = saved(simhash(docs.select("doc_id", "text"), width), "simhash")
    fps = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    edges = links(fps.select("fp"), budget)
    placed = components(edges)
    # The smallest doc_id of a component, then of each fingerprint.
    least = fps.join(placed.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # Read back, so that the join below deals its sides itself and adaptive execution can split a component of very many
    # fingerprints; the sums of the aggregation would tie it to their own partitions.
    of_component = saved(least.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    of_fp = least.select("fp", "component").join(of_component, "component").select("fp", "component_id")
    # A fingerprint that very many documents share is a skewed key of this join, which adaptive execution splits.
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id")
