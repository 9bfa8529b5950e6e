"""Vector codes: each vector as the nearest entries of small codebooks, which Lloyd's rounds fit to all vectors.

A vector is cut into equal parts, each with a codebook of its own.  Components are integers, so distances, sums and means
are exact and a run gives the same codes however rows are dealt.

The rounds are Yinyang's.  The entries of a codebook are clustered into groups once.  Every part of every vector keeps an
upper bound of the distance to its entry and one lower bound for each group, of the distance to the group's other
entries.  When entries have moved, the upper bound grows by the drift of its entry and a group's bound shrinks by the
largest drift in the group.  A part whose upper bound stays below all bounds keeps its entry unseen; else its own distance is
computed, and then only groups whose bound does not exceed the best distance so far are scanned.  Bounds are rounded
outwards, and a tie of bounds is scanned, so integers decide every case that is not strictly ordered.

A round reads the table of the last one and writes the next: codes and bounds change, rows stay in their files, nothing is
shuffled.  The first row of every batch carries the batch's sums, so one narrow column gives the new entries.  Only entries come
to the driver, never vectors; each round's table is in the shared folder, so a lost executor costs one round's share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import delete, recording, saved
from .embeddings import floored, largest, matrix, usable, width_of

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
GROUPS = 4
#: Numbers of a batch that are handled at once.
BLOCK = 1 << 19
#: Of n rows, a label with more than n / 2**HEAVY_BITS is heavy; there are fewer than 2**HEAVY_BITS of those.
HEAVY_BITS = 16

_UP, _DOWN = np.float32(np.inf), np.float32(-np.inf)


def _up(values: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(values, np.float64).astype(np.float32), _UP)


def _down(values: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(values, np.float64).astype(np.float32), _DOWN)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _squares(differences: np.ndarray) -> np.ndarray:
    return (differences * differences).sum(-1)


def groups_of(entries: np.ndarray, n_groups: int = GROUPS) -> list[np.ndarray]:
    """Clusters the entries of one codebook: five plain rounds from evenly spread ones; groups without entries are left out."""
    points = entries.astype(np.float64)
    n_groups = min(n_groups, len(points))
    centres = points[np.arange(n_groups) * len(points) // max(1, n_groups)]
    of = np.zeros(len(points), np.int64)
    for _ in range(5):
        of = _squares(points[:, None] - centres).argmin(1)
        centres = np.array([points[of == g].mean(0) if (of == g).any() else centres[g] for g in range(n_groups)])
    return [np.flatnonzero(of == g) for g in range(n_groups) if (of == g).any()]


class Codebook:
    """The entries of one part position, their groups, and how far the last update has moved them."""

    def __init__(self, entries: np.ndarray, groups: list[np.ndarray] | None = None, before: np.ndarray | None = None):
        self.entries = entries
        self.groups = groups_of(entries) if groups is None else groups
        self.group_of = np.zeros(len(entries), np.int64)
        for g, members in enumerate(self.groups):
            self.group_of[members] = g
        moved = np.zeros(len(entries)) if before is None else np.nextafter(_root(_squares((entries - before).astype(object))), np.inf)
        self.drift = np.where(moved > 0, moved, 0.0)
        self.group_drift = np.array([self.drift[m].max() for m in self.groups])

    def moved_to(self, entries: np.ndarray) -> Codebook:
        return Codebook(entries, self.groups, self.entries)

    def assign(self, x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Brings codes and bounds up to date with the entries, in place; returns how many distances were computed."""
        entries = self.entries.astype(x.dtype)
        upper[:] = _up(upper.astype(np.float64) + self.drift[code])
        lower[:] = _down(lower.astype(np.float64) - self.group_drift)
        rows = np.flatnonzero(upper >= lower.min(1))
        own = _squares(x[rows] - entries[code[rows]])
        seen = len(rows)
        upper[rows] = _up(_root(own))
        open_ = upper[rows] >= lower[rows].min(1)
        rows, own = rows[open_], own[open_]
        left, best, best_code = code[rows], own.copy(), code[rows].copy()
        scanned = []
        for g, members in enumerate(self.groups):
            hit = np.flatnonzero(lower[rows, g] <= _up(_root(best)))
            if not len(hit):
                continue
            found = _squares(x[rows[hit], None, :] - entries[members])
            seen += found.size
            nearest = found.argmin(1)
            distance, name = found[np.arange(len(hit)), nearest], members[nearest]
            better = (distance < best[hit]) | ((distance == best[hit]) & (name < best_code[hit]))
            best[hit[better]], best_code[hit[better]] = distance[better], name[better]
            scanned.append((g, members, hit, _down(_root(found))))
        for g, members, hit, found in scanned:
            lower[rows[hit], g] = np.where(members == best_code[hit, None], _UP, found).min(1)
        # An entry that was left is one of the others of its group from now on.
        moved = np.flatnonzero(best_code != left)
        at = rows[moved], self.group_of[left[moved]]
        lower[at] = np.minimum(lower[at], _down(_root(own[moved])))
        code[rows], upper[rows] = best_code, _up(_root(best))
        return seen


def _padded(width: int) -> int:
    return -(-width // PARTS) * PARTS


def _ints(values: np.ndarray, codebooks: list[Codebook]) -> np.ndarray:
    """Scaled components: machine integers where no square or sum can overflow, else Python's."""
    x = floored(values, SCALE)
    most = max([largest(x), *(largest(c.entries) for c in codebooks)])
    return x if max(1, x.shape[1]) * (2 * most + 2) ** 2 < 2**62 else x.astype(object)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(16, BLOCK // max(1, width))
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)


def _fixed(column: pa.Array, n: int, dtype, shape: tuple[int, ...]) -> np.ndarray:
    """A copy of a binary column whose values have one length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, *shape).copy()


def _binary(values: np.ndarray) -> pa.Array:
    size = values[:1].nbytes
    raw = np.ascontiguousarray(values).tobytes()
    return pa.array([raw[k * size : (k + 1) * size] for k in range(len(values))], pa.binary())


def _codes(x: np.ndarray, batch: pa.RecordBatch | None, codebooks: list[Codebook]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes, upper and lower bounds of a block under the codebooks, and how many distances that took. Without a batch all are new."""
    n, most = len(x), max(len(c.groups) for c in codebooks)
    if batch is None:
        code, upper, lower = np.zeros((n, PARTS), np.uint8), np.full((n, PARTS), _UP, np.float32), np.zeros((n, PARTS, most), np.float32)
    else:
        code, upper, lower = (_fixed(batch.column(k), n, d, s) for k, d, s in (("codes", np.uint8, (PARTS,)), ("upper", np.float32, (PARTS,)), ("lower", np.float32, (PARTS, most))))
    d, seen = x.shape[1] // PARTS, 0
    for p, book in enumerate(codebooks):
        g = len(book.groups)
        seen += book.assign(x[:, p * d : (p + 1) * d], code[:, p], upper[:, p], lower[:, p, :g])
    return code, upper, lower, seen


def _sums(x: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """For each part and entry the number of parts and the sums of their components, as Python integers."""
    d = x.shape[1] // PARTS
    out = np.zeros((PARTS, k, d + 1), object)
    for p in range(PARTS):
        out[p, :, 0] = np.bincount(code[:, p], minlength=k)
        for e in np.unique(code[:, p]).tolist():
            out[p, e, 1:] = x[code[:, p] == e, p * d : (p + 1) * d].sum(0)
    return out


def _round(vectors: DataFrame, codebooks: list[Codebook], width: int, first: bool) -> DataFrame:
    """One assignment: vectors with new codes and bounds, and in the first row of each batch the batch's sums."""
    kind, k = vectors.schema, len(codebooks[0].entries)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in _blocks(whole, width):
                x = _ints(matrix(batch.column("vector"), width), codebooks)
                code, upper, lower, seen = _codes(x, None if first else batch, codebooks)
                sums = [Decimal(int(v)) for v in _sums(x, code, k).ravel()]
                columns = {c: batch.column(c) for c in ("vec_id", "label", "vector")}
                columns |= {"codes": _binary(code), "upper": _binary(upper), "lower": _binary(lower)}
                columns["sums"] = pa.array([sums] + [None] * (len(x) - 1), pa.list_(pa.decimal128(38, 0)))
                columns["seen"] = pa.array([seen] + [None] * (len(x) - 1), pa.int64())
                yield pa.record_batch(columns)

    schema = T.StructType([kind["vec_id"], kind["label"], kind["vector"], *T._parse_datatype_string("codes binary, upper binary, lower binary, sums array<decimal(38,0)>, seen long").fields])
    return vectors.mapInArrow(run, schema)


def _updated(codebooks: list[Codebook], state: DataFrame) -> list[Codebook]:
    """Every entry as the floor of its parts' mean; one without parts stays."""
    rows = state.where("sums is not null").select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    k, d = codebooks[0].entries.shape
    total = np.zeros(PARTS * k * (d + 1), object)
    for r in rows:
        total[r["at"]] = int(r["v"])
    total = total.reshape(PARTS, k, d + 1)
    out = []
    for p, book in enumerate(codebooks):
        entries = book.entries.copy()
        for e in range(k):
            if total[p, e, 0]:
                entries[e] = [int(s) // int(total[p, e, 0]) for s in total[p, e, 1:]]
        out.append(book.moved_to(entries))
    return out


def digest(codebooks: list[Codebook]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for c in codebooks for v in c.entries.ravel()).encode()).hexdigest()


def _coded(state: DataFrame, codebooks: list[Codebook], width: int) -> DataFrame:
    label = state.schema["label"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in _blocks(whole, width):
                x = _ints(matrix(batch.column("vector"), width), codebooks)
                code, _, _, seen = _codes(x, batch, codebooks)
                d = x.shape[1] // PARTS
                error = sum(_squares(x[:, p * d : (p + 1) * d] - book.entries.astype(x.dtype)[code[:, p]]) for p, book in enumerate(codebooks))
                text = code.tobytes().hex()
                yield pa.record_batch(
                    {
                        "vec_id": batch.column("vec_id"),
                        "label": batch.column("label"),
                        "code": pa.array([text[k : k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)], pa.string()),
                        "error": pa.array([Decimal(int(e)) for e in error], pa.decimal128(38, 0)),
                        "seen": pa.array([seen] + [None] * (len(x) - 1), pa.int64()),
                    }
                )

    schema = T.StructType([state.schema["vec_id"], label, *T._parse_datatype_string("code string, error decimal(38,0), seen long").fields])
    return state.mapInArrow(run, schema)


def fit(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> tuple[list[Codebook], DataFrame]:
    """Codebooks fitted to all vectors (vec_id, label, vector), and the coded rows: vec_id, label, code, error, seen.

    ``seen`` is set in one row of each batch: the number of distances of the last assignment of that batch.
    """
    # At most ENTRIES rows.
    starts = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector", "label").limit(ENTRIES).select("vector").toArrow().column("vector")
    first = floored(matrix(starts.combine_chunks(), width), SCALE)
    d = width // PARTS
    codebooks = [Codebook(first[:, p * d : (p + 1) * d]) for p in range(PARTS)]
    state, made = vectors, []
    for k in range(rounds):
        with recording() as folders:
            state = saved(_round(state, codebooks, width, k == 0), "codes")
        codebooks = _updated(codebooks, state)
        delete(state.sparkSession, made)
        made = folders
    coded = saved(_coded(state, codebooks, width), "coded")
    delete(state.sparkSession, made)
    return codebooks, coded


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the errors summed over equal labels, nulls together.

    Totals of heavy labels are broadcast: with n rows there are fewer than 2**16 labels of more than n / 2**16 rows each.
    Rows of the other labels meet their totals in a join whose largest key has n / 2**16 rows.
    """
    n = coded.count()
    totals = coded.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    same = F.col("label").eqNullSafe(F.col("of"))
    many = F.col("rows") > (n >> HEAVY_BITS)
    marked = coded.join(F.broadcast(totals.where(many)), same, "left")
    heavy = marked.where("rows is not null").select("vec_id", "code", "error", "label_error")
    light = marked.where("rows is null").select("vec_id", "label", "code", "error").join(totals.where(~many), same).select("vec_id", "code", "error", "label_error")
    return heavy.unionByName(light)


def vector_codes(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for each row whose vector is there and all finite.

    Other rows have no code and are left out.  ``code`` has two hex digits for each of the 8 parts.  A null vec_id comes after all
    others when the first entries are taken; of equal ids the smaller vector comes first.  With fewer than 16 vectors codebooks
    are smaller.  Vectors of unequal length count as if zeros followed, up to a multiple of 8.  Scaled components beyond 2**52
    count as that; an error beyond a long is null.  A null label is a label.  Repeated rows count each time; an empty table
    gives no rows.  Other columns are not read.
    """
    vectors = usable(rows, vector, F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"))
    width = _padded(width_of(vectors))
    if not width:
        # No vectors, or only empty ones, which are all alike.
        none = hashlib.sha256(b"").hexdigest()
        return vectors.select("vec_id", F.lit("00" * PARTS).alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit(none).alias("codebooks_sha256"))
    codebooks, coded = fit(vectors, width)
    out = with_label_error(coded)
    return out.select("vec_id", "code", F.col("error").try_cast("long").alias("error"), F.col("label_error").try_cast("long").alias("label_error"), F.lit(digest(codebooks)).alias("codebooks_sha256"))
