"""Near-duplicates by shingle sets: all pairs of documents whose sets have a Jaccard similarity of ``LEAST`` or more.

Words and shingles are those of ``simhash``, here of 5 words; a document has the set of its shingles, under 64-bit hashes.
Documents are linked if their sets are equal, or if the size of the intersection is at least 4/5 of the size of the union.

Method.  Two sets of similarity 0.8 have fingerprints that differ in about ten bits, more than a join of fingerprints can afford,
so the search is by prefixes, which miss none.  Shingles are ordered by hash.  A set of n shares at least ``need(n)`` with any set
it is linked to; so the first t common shingles of two linked sets are among the first n - need(n) + t of either.

1. With t an eighth of n, prefixes meet by shingle.  A set stays in the search if enough of its prefix is in other sets' prefixes;
   a passage or line that is common in the corpus does not suffice.
2. The sets that stay are ordered anew, shingles of few sets first, and their prefixes with t = 1 tie those that can be linked
   into candidate components.  A shingle that is common does not come into a prefix unless a set has little else.
3. In the candidate components SimHash, the binary-trie join of ``simhash`` over the fingerprints of the 5-word shingles, names the
   pairs within its budget of bits, and their sets are compared: sets so linked share a label.
4. The sets of a component are compared, rarest shingles first; a pair under one label is not compared again.  A component of up to
   ``BLOCK`` shingles is one task.  A larger one, a large group of close copies, is dealt in blocks: those of its most
   common label, and those of all other sets.  Each pair of blocks with sets to compare is a task, so none holds more than two.

Null and empty texts have the empty set and are linked with each other. Equal rows get equal groups; texts of any length are read
whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import numbered, renamed
from .components import components, saved
from .kernel import LOWER, PLAIN_WORD, Chunk, batches
from .simhash import BUDGET, fingerprints, links

WIDTH = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Bits of the filter for the sets that stay in the search.
FILTER_BITS = 1 << 23
#: Shingles in one block of a large candidate component.
BLOCK = 1 << 17


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text in one array, and where each text's begin (one more entry than texts)."""
    chunk = Chunk([b" ".join(t.translate(LOWER).split()) for t in texts])
    upto = np.zeros(len(texts) + 1, np.int64)
    if not texts:
        return np.zeros(0, np.uint64), upto
    start, end, first = chunk.words(PLAIN_WORD)
    n_words = np.diff(first)
    n = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    at = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(texts)), n)
    word = np.arange(len(doc)) - at[doc] + first[doc]
    hashed = chunk.word_hashes(start[word], end[np.minimum(word + width, first[doc + 1]) - 1])[0]
    order = np.lexsort((hashed, doc))
    hashed = hashed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])
    np.cumsum(np.bincount(doc[new], minlength=len(texts)), out=upto[1:])
    return hashed[new], upto


def need(n):
    """How many shingles a set of n shares at least with any that it is linked to."""
    return -(-n * LEAST[0] // LEAST[1])


def _eighth(n):
    return np.maximum(n // 8, 1)


def _heads(upto: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first ``size`` entries of each set, and the set of each."""
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - (np.cumsum(size) - size)[which] + upto[:-1][which], which


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(one) + len(other) - both)


def link_sets(values: np.ndarray, upto: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets, enough to connect all that are linked and have not one label. No two sets are equal."""
    n = np.diff(upto)
    owner = np.repeat(np.arange(len(n)), n)
    distinct, token, count = np.unique(values, return_inverse=True, return_counts=True)
    by_count = np.empty(len(distinct), np.int64)
    by_count[np.argsort(count, kind="stable")] = np.arange(len(distinct))
    token = by_count[token]
    token = token[np.lexsort((token, owner))]
    # Of each shingle, the sets with it in their prefix.
    at, which = _heads(upto, np.where(n > 0, n - need(n) + 1, 0))
    order = np.argsort(token[at], kind="stable")
    holder = which[order]
    heads = np.searchsorted(token[at][order], np.arange(len(distinct) + 1))
    label = np.unique(label, return_inverse=True)[1]
    members = dict(enumerate(np.split(np.argsort(label, kind="stable"), np.cumsum(np.bincount(label))[:-1])))
    found, seen = [], np.full(len(n), -1)
    for x in range(len(n)):
        mine = token[upto[x] : upto[x + 1]]
        for t in mine[: len(mine) - need(len(mine)) + 1].tolist():
            near = holder[heads[t] : heads[t + 1]]
            near = near[(label[near] != label[x]) & (near < x) & (seen[near] < x)]
            near = near[(need(n[near]) <= n[x]) & (need(n[x]) <= n[near])]
            seen[near] = x
            for y in near.tolist():
                if label[y] != label[x] and alike(mine, token[upto[y] : upto[y + 1]]):
                    found.append((x, y))
                    small, large = sorted((int(label[x]), int(label[y])), key=lambda k: len(members[k]))
                    label[members[small]] = large
                    members[large] = np.concatenate([members[large], members.pop(small)])
    return found


def _columns(stream: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in stream if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def _sets_of(column) -> tuple[np.ndarray, np.ndarray]:
    raw = column.to_pylist()
    upto = np.concatenate([[0], np.cumsum([len(x) // 8 for x in raw], dtype=np.int64)])
    return np.frombuffer(b"".join(raw), np.uint64), upto


def _packed(values: np.ndarray, upto: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Each set as bytes, and its 64-bit digest."""
    raw = [values[a:b].tobytes() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    return raw, np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw)).view(np.int64)


def _prefix_rows(sig: np.ndarray, values: np.ndarray, upto: np.ndarray, extra) -> pa.RecordBatch:
    """Columns key and sig: each set's prefix with ``extra(n)`` as t; of equal sets only one's."""
    size = np.zeros(len(sig), np.int64)
    first = np.unique(sig, return_index=True)[1]
    n = np.diff(upto)[first]
    size[first] = np.where(n > 0, n - need(n) + extra(n), 0)
    at, which = _heads(upto, size)
    return pa.record_batch([pa.array(values[at].view(np.int64)), pa.array(sig[which])], names=["key", "sig"])


def _levels(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From half-hashes and sigs, by half-hash: the number of doublings of its sets, where there are two or more."""
    table = _columns(stream)
    if table is not None:
        half, sig = (table.column(c).to_numpy() for c in ("half", "sig"))
        _, which, count = np.unique(half, return_inverse=True, return_counts=True)
        level = np.ceil(np.log2(count)).astype(np.int32)[which]
        some = np.flatnonzero(level)
        yield pa.record_batch([pa.array(sig[some]), pa.array(half[some]), pa.array(level[some])], names=["sig", "half", "level"])


def _half(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _met(stream: Iterator[pa.RecordBatch]):
    """Distinct pairs of key and sig whose key more than one sig has, by key: the sigs, and the smallest sig of each one's key."""
    table = _columns(stream)
    if table is None:
        return None
    key, sig = (table.column(c).to_numpy() for c in ("key", "sig"))
    order = np.lexsort((sig, key))
    key, sig = key[order], sig[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
    key, sig = key[new], sig[new]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    group = np.cumsum(head) - 1
    several = np.bincount(group)[group] > 1
    return sig[several], sig[head][group][several]


def _counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if (got := _met(stream)) is not None:
        sig, n = np.unique(got[0], return_counts=True)
        yield pa.record_batch([pa.array(sig), pa.array(n)], names=["sig", "shared"])


def _tied(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if (got := _met(stream)) is not None:
        pairs = np.unique(np.stack(got, axis=1)[got[0] != got[1]], axis=0)
        yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def _verified(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs of sigs with their sets, those that are linked."""
    for batch in stream:
        one, other = ([np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3))
        keep = pa.array([alike(x, y) for x, y in zip(one, other, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _linked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links in each task's sets, from rows sorted by task: component, i, j, sig, label, shingles."""

    def compared(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        sig, label = table.column("sig").to_numpy(), table.column("label").to_numpy()
        pairs = np.array(link_sets(*_sets_of(table.column("shingles")), label), np.int64).reshape(-1, 2)
        if len(pairs):
            yield pa.record_batch([pa.array(sig[pairs[:, 0]]), pa.array(sig[pairs[:, 1]])], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    last = None
    for batch in stream:
        tasks = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
        cut = [k for k in range(len(tasks)) if not k or tasks[k] != tasks[k - 1]]
        for a, b in zip(cut, [*cut[1:], len(tasks)], strict=True):
            if tasks[a] != last:
                if held:
                    yield from compared(held)
                held, last = [], tasks[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield from compared(held)


def _in_tasks(sets: DataFrame, block: int) -> DataFrame:
    """Component, i, j, sig, label, shingles: each set once for each task that compares it, from component, label, sig, shingles."""
    size = F.octet_length("shingles") / 8 + 1
    labels = sets.groupBy("component", "label").agg(F.sum(size).alias("size"))
    most = labels.groupBy("component").agg(F.sum("size").alias("all"), F.max(F.struct("size", "label")).alias("top"))
    most = most.select("component", "all", F.col("top.label").alias("main"), F.col("top.size").alias("main_size"))
    # Components under one label have nothing to compare.
    most = saved(most.where("all > main_size"), "components")
    rows = sets.join(most, "component")
    small = F.col("all") <= block
    n_main, n_rest = F.ceil(F.col("main_size") / block), F.ceil((F.col("all") - F.col("main_size")) / block)
    is_main = F.col("label") == F.col("main")
    # Blocks 0 .. n_rest - 1 hold the other sets, the following ones those of the main label.
    place = F.pmod(F.xxhash64("sig"), F.when(is_main, n_main).otherwise(n_rest))
    rest = F.sequence(F.lit(0).cast("long"), n_rest - 1)
    with_main = F.sequence(n_rest, n_rest + n_main - 1)

    def pairs(others: Column) -> Column:
        return F.transform(others, lambda k: F.struct(F.least(F.col("place"), k).alias("i"), F.greatest(F.col("place"), k).alias("j")))

    rows = rows.withColumn("place", F.when(is_main, place + n_rest).otherwise(place))
    tasks = F.when(small, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))).otherwise(pairs(F.when(is_main, rest).otherwise(F.concat(rest, with_main))))
    return rows.withColumn("task", F.explode(tasks)).select("component", "task.i", "task.j", "sig", "label", "shingles")


def _close(sets: DataFrame, stay: DataFrame, budget: int) -> DataFrame:
    """Linked pairs among those that SimHash names: sets of one fingerprint with one of them, and one set for each of two linked ones."""
    fps = saved(sets.groupBy("fp").agg(F.min("sig").alias("lead")), "fingerprints")
    same = sets.join(fps, "fp").where("sig <> lead").select(F.col("sig").alias("a"), F.col("lead").alias("b"))
    leads = [fps.select(F.col("fp").alias(x), F.col("lead").alias(f"lead_{x}")) for x in "ab"]
    near = links(fps.select("fp"), budget).join(leads[0], "a").join(leads[1], "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    ends = [stay.select(F.col("sig").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab"]
    named = same.unionByName(near).join(ends[0], "a").join(ends[1], "b").select("a", "b", "set_a", "set_b")
    return named.mapInArrow(_verified, "a long, b long")


def similar_documents(docs: DataFrame, width: int = WIDTH, keep: tuple[str, ...] = (), budget: int = BUDGET, block: int = BLOCK) -> DataFrame:
    """One row for each document: doc_id, those in ``keep`` and ``group`` (long), which linked documents have in common.

    A column of ``keep`` may have the name of another; both are then in the table.
    """
    spark = docs.sparkSession
    names = ["doc_id", *(f"__keep{k}" for k in range(len(keep)))]
    base = numbered(docs, keep, "doc_id", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*names).schema) + ", sig long, n long, fp long"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, 1 << 20):
            values, upto = shingle_sets(texts, width)
            own = [pa.array(_packed(values, upto)[1]), pa.array(np.diff(upto)), pa.array(fingerprints(texts, width).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *own], names=[*names, "sig", "n", "fp"])

    def prefixes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batches(stream, 1 << 20):
            values, upto = shingle_sets(texts, width)
            yield _prefix_rows(_packed(values, upto)[1], values, upto, _eighth)

    def halves(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values, upto = _sets_of(batch.column(1))
            yield pa.record_batch([pa.array(_half(values)), pa.array(np.repeat(batch.column(0).to_numpy(), np.diff(upto)))], names=["half", "sig"])

    def short_prefixes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values, upto = _sets_of(batch.column(1))
            # The level of a shingle is that of its half-hash, so that all sets have one order.
            own, level = (np.frombuffer(b"".join(x or b"" for x in batch.column(k).to_pylist()), np.int32) for k in (2, 3))
            count = np.array([len(x or b"") // 4 for x in batch.column(2).to_pylist()], np.int64)
            owner, known = np.repeat(np.arange(len(upto) - 1), np.diff(upto)), np.repeat(np.arange(len(count)), count)
            at = np.searchsorted(known << np.int64(32) | own.view(np.uint32), owner << np.int64(32) | _half(values).view(np.uint32))
            at = np.minimum(at, max(0, len(own) - 1))
            found = (known[at] == owner) & (own[at] == _half(values)) if len(own) else np.zeros(len(values), bool)
            order = np.lexsort((values, np.where(found, level[at], 0) if len(own) else np.zeros(len(values)), owner))
            yield _prefix_rows(batch.column(0).to_numpy(), values[order], upto, np.ones_like)

    def packed_levels(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each sig: its half-hashes in order, and their levels."""
        table = _columns(stream)
        if table is not None:
            sig, half, level = (table.column(c).to_numpy() for c in ("sig", "half", "level"))
            order = np.lexsort((half.view(np.uint32), sig))
            sig, half, level = sig[order], half[order], level[order]
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (half[1:] != half[:-1])])
            sig, half, level = sig[new], half[new], level[new]
            heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])).tolist()
            cut = list(zip(heads, [*heads[1:], len(sig)], strict=True))
            yield pa.record_batch([pa.array(sig[heads]), pa.array([half[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([level[a:b].tobytes() for a, b in cut], pa.binary())], names=["sig", "halves", "levels"])

    # Sets take more room than texts, so they are made anew where they are needed, not saved.
    marked = saved(base.mapInArrow(run, schema), "shingles")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = saved(marked.groupBy("sig").agg(F.max("n").alias("n"), F.min("fp").alias("fp")), "sizes")
    posted = base.select("text").mapInArrow(prefixes, "key long, sig long").repartition(n, "key")
    shared = posted.mapInArrow(_counted, "sig long, shared long").groupBy("sig").agg(F.sum("shared").alias("shared"))
    # A linked set has need(n) shingles at least, which gives its own t.
    least = F.expr(f"greatest((n * {LEAST[0]} + {LEAST[1] - 1}) div {LEAST[1]} div 8, 1)")
    wanted = saved(sizes.join(shared, "sig").where(F.col("shared") >= least).select("sig"), "wanted")
    # A bitmap of fixed size keeps nearly all other sets out of the join that finds the wanted ones.
    place = F.pmod("sig", F.lit(FILTER_BITS))
    words = wanted.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(sig, {FILTER_BITS}) % 64 as int))")).alias("bits")).collect()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    for at, bits in words:
        bitmap[at] = bits
    passes = spark.sparkContext.broadcast(bitmap)

    def sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(passes.value.view(np.uint8), bitorder="little")
        for _, texts in batches(stream, 1 << 20):
            raw, sig = _packed(*shingle_sets(texts, width))
            first = np.unique(sig, return_index=True)[1]
            some = first[bits[sig[first] % FILTER_BITS] > 0]
            yield pa.record_batch([pa.array(sig[some]), pa.array([raw[k] for k in some.tolist()], pa.binary())], names=["sig", "shingles"])

    found = base.select("text").mapInArrow(sets, "sig long, shingles binary").join(wanted, "sig", "left_semi")
    stay = saved(found.groupBy("sig").agg(F.first("shingles").alias("shingles")), "candidates")
    levels = stay.select("sig", "shingles").mapInArrow(halves, "half int, sig long").repartition(n, "half").mapInArrow(_levels, "sig long, half int, level int")
    levels = levels.repartition(n, "sig").mapInArrow(packed_levels, "sig long, halves binary, levels binary")
    ranked = stay.join(levels, "sig", "left").select("sig", "shingles", "halves", "levels")
    ties = ranked.mapInArrow(short_prefixes, "key long, sig long").repartition(n, "key").mapInArrow(_tied, "a long, b long").distinct()
    placed = components(ties).withColumnRenamed("id", "sig")
    close = saved(_close(placed.join(sizes, "sig"), stay, budget), "close")
    named = components(close).withColumnsRenamed({"id": "sig", "component": "label"})
    placed, label = placed.join(named, "sig", "left"), F.coalesce("label", "sig")
    compared = placed.join(stay, "sig").select("component", label.alias("label"), "sig", "shingles")
    tasks = _in_tasks(compared, block).repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    edges = saved(tasks.mapInArrow(_linked, "a long, b long"), "linked")
    groups = components(edges.unionByName(close)).withColumnsRenamed({"id": "sig", "component": "group"})
    out = marked.select(*names, "sig").join(groups, "sig", "left").select(*names, F.coalesce("group", "sig").alias("group"))
    return renamed(out, keep)
