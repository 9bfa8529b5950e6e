"""The stored tables, cut into parts, so that a batch reads and writes the parts it touches.

Documents are cut by the day (or month) they were processed and by a bucket of their id, items like their documents, logs and
duplicates by their time.  A commit writes rows into a folder of its own, partitioned like the table, and then one row that says
which parts it added to and which it replaced.  What counts of a part are the folders since the last that replaced it.  So
readers see all changes of a batch or none, a batch that runs twice counts once, a merge of ten documents writes at most ten
parts, and a window over days reads the folders of those days.

Two narrow tables follow every change of documents.  ``document_keys`` has a row for each name and hash, cut by the first digits
of its digest; a row that no longer holds is followed by one that says so.  Looking for the names and hashes of a batch reads the
parts with their digits only (dynamic partition pruning).  ``document_cells`` has counts and sums by day, status and
currency as differences between a part before and after a merge, so that figures of any window never read documents.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from . import merge, search

#: Folders of a part before they are written together as one.
FOLDERS = 64
#: The kinds of keys, and the column of documents that each is of.
KINDS = (("name", "file_name"), ("hash", "file_hash"))
#: Tables that a commit writes at a time.
WRITERS = 4

COMMIT = "commit long, batch string, changes array<struct<table:string,version:string,part:string,replaces:boolean,present:boolean>>, tops map<string,long>, period string, buckets int, digits int, any_case boolean, at timestamp"


def day_of(time: Column) -> Column:
    """The UTC day of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))


def period_of(time: Column, unit: str) -> Column:
    return day_of(time) if unit == "day" else F.trunc(day_of(time), unit).cast("date")


def digest_prefix(kind: Column, key: Column, digits: int) -> Column:
    """A hash is a digest already; a name gets one."""
    return F.left(F.when(kind == "hash", key).otherwise(F.md5(key.cast("binary"))), F.lit(digits))


def _names(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.replace("(10,2)", "").replace("(18,4)", "").replace("(38,2)", "").split(",") if c.strip()]


class Store:
    """Tables below one folder. ``period`` (day, month or year), ``buckets``, ``digits`` and ``any_case`` (names that differ in
    case only are one) are those of the first commit."""

    def __init__(self, spark: SparkSession, root: str, period: str = "day", buckets: int = 16, digits: int = 2, any_case: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.period, self.buckets, self.digits, self.any_case = period, buckets, digits, any_case
        self._known: dict[int, dict] = {}
        for row in list(self._commits().values())[:1]:
            self.period, self.buckets, self.digits, self.any_case = row["period"], row["buckets"], row["digits"], bool(row["any_case"])

    def _commits(self) -> dict[int, dict]:
        """All commits by number. They never change, so only those not seen yet are read; each has a row for a folder at most."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
        fresh = [str(p) for p in there if int(p.getName()) not in self._known and files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        if fresh:
            for row in sorted(self.spark.read.schema(COMMIT).json(fresh).collect(), key=lambda r: r["commit"]):
                self._known[row["commit"]] = row.asDict()
        return self._known

    def head(self) -> tuple[int, dict[str, int]]:
        """The number of the last commit, and the largest id that each table has had."""
        commits = self._commits()
        return (last := max(commits), dict(commits[last]["tops"] or {})) if commits else (0, {})

    def has_batch(self, batch: str) -> bool:
        return any(c["batch"] == batch for c in self._commits().values())

    def top(self, name: str) -> int:
        return self.head()[1].get(name, 0)

    def live(self, name: str) -> list[tuple[str, str]]:
        """(version, part) of every folder that counts; as many as the table has folders, whatever its rows."""
        out: dict[str, list[str]] = {}
        for commit in self._commits().values():
            for c in commit["changes"]:
                if c["table"] == name:
                    kept = [] if c["replaces"] else out.get(c["part"], [])
                    out[c["part"]] = [*kept, c["version"]] if c["present"] else kept
        return sorted((v, part) for part, versions in out.items() for v in versions)

    def _schema(self, name: str) -> str:
        return {**schemas.TABLES, **schemas.DERIVED}[name]

    def _cut(self, name: str) -> list[str]:
        return _names(schemas.LAYOUT.get(name, ""))

    def read(self, name: str, parts: set[str] | None = None) -> DataFrame:
        """The table with the columns it is cut by, and the version each row was written in; only the given parts if any are."""
        extra = [c for c in self._cut(name) if c not in _names(self._schema(name))]
        layout = schemas.LAYOUT.get(name, "")
        schema = ", ".join([self._schema(name), *(c.strip() for c in layout.split(",") if c.strip().split(" ")[0] in extra), "v string"])
        paths = [f"{self.root}/{name}/v={v}/{part}".rstrip("/") for v, part in self.live(name) if parts is None or part in parts]
        if not paths:
            # A frame that the optimizer knows to be empty, so that joins with it go.
            return self.spark.createDataFrame([], schema).limit(0)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def table(self, name: str, parts: set[str] | None = None) -> DataFrame:
        return self.read(name, parts).select(*_names(self._schema(name)))

    def window(self, name: str, since: Column, until: Column) -> DataFrame:
        """Rows whose time lies in the window, both ends included. Only folders of its periods are read."""
        periods = F.col("period").between(period_of(since, self.period), period_of(until, self.period))
        rows = self.read(name).where(periods)
        if name in schemas.TIMES:
            rows = rows.where(F.col(schemas.TIMES[name]).between(since, until))
        return rows.select(*_names(self._schema(name)))

    def window_items(self, since: Column, until: Column) -> DataFrame:
        """Items of the window's documents; items lie in the folders of their documents' periods."""
        documents = self.window("invoice_documents", since, until).select("document_id")
        return self.window("invoice_line_items", since, until).join(documents, "document_id", "left_semi")

    def part(self, period: Column, document_id: Column) -> list[Column]:
        return [period.alias("period"), F.pmod(F.xxhash64(document_id), F.lit(self.buckets)).cast("int").alias("bucket")]

    def _parted(self, name: str, rows: DataFrame) -> DataFrame:
        """Adds the columns a table is cut by. Items come with the period of their document."""
        cut = self._cut(name)
        if "slot" in cut:
            return rows.withColumn("slot", search.slot(F.col("trigram")))
        if "prefix" in cut:
            return rows.withColumn("prefix", digest_prefix(F.col("kind"), F.col("key"), self.digits))
        if "period" in cut and name in schemas.TIMES:
            rows = rows.withColumn("period", period_of(F.col(schemas.TIMES[name]), self.period))
        return rows.select(*(c for c in rows.columns if c != "bucket"), self.part(F.col("period"), F.col("document_id"))[1]) if "bucket" in cut else rows

    def parts_of(self, rows: DataFrame) -> set[str]:
        """The parts of documents that rows (document_id, period) lie in; as many as there are folders at most."""
        found = rows.select(*self.part(F.col("period"), F.col("document_id"))).distinct().collect()
        return {f"period={r['period'] if r['period'] is not None else '__HIVE_DEFAULT_PARTITION__'}/bucket={r['bucket']}" for r in found}

    def _write(self, name: str, rows: DataFrame, version: str) -> tuple[set[str], int]:
        """Writes rows into a folder of their own; returns the parts they lie in and their largest id."""
        path, cut = f"{self.root}/{name}/v={version}", self._cut(name)
        kept = self._parted(name, rows).select(*dict.fromkeys([*_names(self._schema(name)), *cut]))
        # Rows of a part come together; what is too much for one task is split, what is little is joined.
        rows = merge.carried(kept, lambda rows: rows.hint("rebalance", *cut)) if cut else kept
        if name in schemas.SOUGHT:
            rows = rows.sortWithinPartitions(*cut, schemas.SOUGHT[name])
        (rows.write.partitionBy(*cut) if cut else rows.write).mode("overwrite").option("compression", "zstd").parquet(path)
        written = self.spark.read.schema(self._schema(name)).option("recursiveFileLookup", True).parquet(path)
        top = written.agg(F.max(schemas.IDS[name])).head()[0] if name in schemas.IDS else None
        return self._folders(path, len(cut)), top or 0

    def _folders(self, path: str, depth: int) -> set[str]:
        """The folders of partitions below a version, which are as many as the version's parts; a version without cuts is one."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *["*=*"] * depth, "part-*"]))
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(at)
        return {"/".join(str(f.getPath().getParent()).split("/")[-depth:]) if depth else "" for f in found}

    def commit(
        self,
        batch: str,
        add: dict[str, DataFrame] | None = None,
        replace: dict[str, tuple[DataFrame, set[str]]] | None = None,
        then: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
        **tables: DataFrame,
    ) -> bool:
        """Writes rows beside those there (``add``), rows in place of some parts and beside others (``replace``), and whole
        tables; false, and nothing changes, if the batch is there already. ``then`` makes more rows to add from what has been written.

        Parts of ``FOLDERS`` folders that a table is added to are written anew as one.  The commit's row has a name of its own
        number and folders have names nobody else has, so of two writers at once the second fails and undoes nothing.
        """
        if self.has_batch(batch):
            return False
        number, tops = self.head()
        number += 1
        version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        changes: list[tuple] = []

        def write(name: str, rows: DataFrame, gone: set[str]) -> DataFrame:
            found, top = self._write(name, rows, version)
            tops[name] = max(tops.get(name, 0), top)
            changes.extend((name, version, p, p in gone, p in found) for p in sorted(found | gone))
            return self.spark.read.schema(self._schema(name)).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}/v={version}")

        def write_beside(item: tuple[str, DataFrame]) -> None:
            name, frame = item
            crowded = {p for p, n in Counter(p for _, p in self.live(name)).items() if n + 1 >= FOLDERS}
            write(name, self._joined(name, crowded, frame, version) if crowded else frame, crowded)

        def write_added(rows: dict[str, DataFrame]) -> None:
            """Tables do not depend on each other, so their jobs run side by side."""
            with ThreadPoolExecutor(WRITERS) as pool:
                list(pool.map(write_beside, rows.items()))

        whole = {n: (rows, {p for _, p in self.live(n)}) for n, rows in tables.items()}
        written = {n: write(n, rows, gone) for n, (rows, gone) in (whole | dict(replace or {})).items()}
        write_added({**(add or {}), **(then(written) if then else {})})
        row = self.spark.createDataFrame([(number, batch, sorted(changes), tops, self.period, self.buckets, self.digits, self.any_case, None)], COMMIT).withColumn("at", F.current_timestamp())
        row.coalesce(1).write.mode("error").json(f"{self.root}/_commits/{number:08d}")
        return True

    def _joined(self, name: str, crowded: set[str], rows: DataFrame, version: str) -> DataFrame:
        """The rows of crowded parts with those that are added. Of a key only the last row is kept, of a cell only its sum."""
        there = self.read(name, crowded)
        both = there.unionByName(self._parted(name, rows).withColumn("v", F.lit(version)).select(*there.columns))
        if name == "document_keys":
            last = both.groupBy("kind", "key", "document_id").agg(F.max_by(F.struct(*both.columns), "v").alias("r"))
            # A row that says a key is gone may go only where all older rows are at hand.
            both = last.select("r.*").where(F.col("alive") | ~F.concat(F.lit("prefix="), F.col("prefix")).isin(*crowded))
        elif name == "document_cells":
            both = both.groupBy("day", "status", "currency").agg(F.sum("n").alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"), F.max("v").alias("v"))
        return both.drop("v")

    # Names, hashes and figures of documents

    @property
    def collation(self) -> str | None:
        return merge.ANY_CASE if self.any_case else None

    def _name(self, name: Column) -> Column:
        """The form in which names are looked up."""
        return F.lower(name) if self.any_case else name

    def candidates(self, wanted: DataFrame) -> DataFrame:
        """document_id, file_name, file_hash, status, period of every document that has a wanted file_name or file_hash."""
        asked = [wanted.select(F.lit(kind).alias("kind"), c.alias("key")) for kind, c in (("name", self._name(F.col("file_name"))), ("hash", F.col("file_hash")))]
        asked = asked[0].unionByName(asked[1]).where("key > ''").distinct()
        # At most 16**digits prefixes.
        prefixes = asked.select(digest_prefix(F.col("kind"), F.col("key"), self.digits).alias("prefix")).distinct()
        near = self.read("document_keys").join(F.broadcast(prefixes), "prefix", "left_semi").join(asked, ["kind", "key"], "left_semi")
        near = near.withColumns({c: F.coalesce(c, F.when(F.col("kind") == kind, F.col("key"))) for kind, c in KINDS})
        last = near.groupBy("kind", "key", "document_id").agg(F.max_by(F.struct("file_name", "file_hash", "status", "period", "alive"), "v").alias("r"))
        return last.where("r.alive").select("document_id", "r.file_name", "r.file_hash", "r.status", "r.period").distinct()

    def document_changes(self, before: DataFrame, after: DataFrame) -> dict[str, DataFrame]:
        """Rows to add to ``document_keys`` and ``document_cells`` when documents, or some parts of them, change."""
        narrow = ["file_name", "file_hash", "status"]
        rows = [d.select("document_id", F.struct(*narrow, *self.part(period_of(F.col("processed_at"), self.period), F.col("document_id"))).alias(n)) for d, n in ((before, "o"), (after, "n"))]
        both = rows[0].join(rows[1], "document_id", "full_outer").where(~F.col("o").eqNullSafe(F.col("n")))

        def key(side: str, kind: str, column: str, alive: bool) -> Column:
            fields = F.struct(F.lit(kind).alias("kind"), (self._name(F.col(f"{side}.{column}")) if kind == "name" else F.col(f"{side}.{column}")).alias("key"), F.lit(alive).alias("alive"), F.col(side).alias("d"))
            # What is still so needs no row that says it has gone.
            return F.when(F.col(side).isNotNull() if alive else F.col("o").isNotNull() & ~F.col(f"o.{column}").eqNullSafe(F.col(f"n.{column}")), fields)

        made = F.array_compact(F.array(*(key(side, *k, alive) for side, alive in (("n", True), ("o", False)) for k in KINDS)))
        keys = both.select("document_id", F.explode(made).alias("k")).select("document_id", "k.kind", "k.key", "k.alive", "k.d.*").where("key > ''")
        # What the key says already is not written a second time.
        keys = keys.withColumns({c: F.when(~((F.col("kind") == kind) & F.col(c).eqNullSafe(F.col("key"))), F.col(c)) for kind, c in KINDS})
        cells = [
            d.select(day_of(F.col("processed_at")).alias("day"), "status", "currency", F.lit(sign).cast("long").alias("n"), (F.coalesce("total_amount", F.lit(0)) * sign).cast("decimal(38,2)").alias("total_amount"))
            for d, sign in ((before, -1), (after, 1))
        ]
        sums = cells[0].unionByName(cells[1]).groupBy("day", "status", "currency").agg(F.sum("n").alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"))
        # Postings that hold no longer stay: what they name is looked at before it counts.
        texts = [d.select("document_id", *search.COLUMNS, *self.part(period_of(F.col("processed_at"), self.period), F.col("document_id"))) for d in (before, after)]
        unlike = texts[1].alias("n").join(texts[0].alias("o"), [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("document_id", *search.COLUMNS)], "left_anti")
        return {"document_keys": keys, "document_trigrams": search.postings(unlike, "period", "bucket"), "document_cells": sums.where("n <> 0 or total_amount <> 0")}

    def cells(self) -> DataFrame:
        """day, status, currency, n, total_amount of all documents, from the differences of all commits."""
        rows = self.table("document_cells").groupBy("day", "status", "currency")
        return rows.agg(F.sum("n").alias("n"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount")).where("n <> 0")

    def merged(self, new: DataFrame | None, failed: DataFrame | None, now: Column, once: Callable[[DataFrame, str], DataFrame] | None = None, distinct: bool = False) -> tuple[DataFrame, DataFrame, set[str]]:
        """What successes (``new``) and failures make of the documents they meet: those documents' parts before and after, and
        which parts these are. New documents are in ``after`` too, which is to be used once. ``once`` may write a table that is used several
        times; ``distinct``: each success is known to have a hash of its own."""
        both = [rows.select("file_name", "file_hash") for rows in (new, failed) if rows is not None]
        touched = self.parts_of(self.candidates(both[0].unionByName(both[-1])))
        before, top = self.table("invoice_documents", touched), self.top("invoice_documents")
        after = before
        if new is not None:
            hits = (lambda rows: once(rows, "succeeding")) if once and touched else None
            after = merge.upsert_success(after, new, now, top, self.collation, hits, distinct)
            after = once(after, "succeeded") if once and failed is not None else after
        if failed is not None:
            after = merge.upsert_failed(after, failed, now, top, self.collation, (lambda rows: once(rows, "failing")) if once else None)
        return before, after, touched

    def search(self, term: str) -> DataFrame:
        """Documents that hold the term in a searched column, in any case; terms of three characters and more through their postings."""
        columns = _names(self._schema("invoice_documents"))
        return search.find(self.read("invoice_documents"), self.read("document_trigrams"), term).select(*columns)

    def put_documents(
        self, batch: str, before: DataFrame, after: DataFrame, touched: set[str], add: dict[str, DataFrame] | None = None, then: Callable[[DataFrame], dict[str, DataFrame]] | None = None
    ) -> bool:
        """Commits documents whose ``touched`` parts held ``before`` and now are, with new rows, ``after``; and what follows from
        that. ``then`` makes more rows to add from those documents, read back."""

        def follow(written: dict[str, DataFrame]) -> dict[str, DataFrame]:
            documents = written["invoice_documents"]
            return {**self.document_changes(before, documents), **(then(documents) if then else {})}

        return self.commit(batch, add, {"invoice_documents": (after, touched)}, follow)

    def migrate(self, steps=None) -> int:
        """Brings the store to the current version; each step is a function of the store. Runs of it change nothing more."""
        version = merge.current_version(self.table("schema_version")).head()[0]
        done = self.table("schema_version")
        for k in range(version + 1, schemas.SCHEMA_VERSION + 1):
            done = done.unionByName(self.spark.range(1).select(F.lit(k).alias("version"), F.current_timestamp().alias("applied_at")))
            changed = (steps or MIGRATIONS)[k](self)
            # Steps that change no rows are committed with the next that does.
            if changed or k == schemas.SCHEMA_VERSION:
                self.commit(f"migration-{k}", schema_version=done, **changed)
                done = self.table("schema_version")
        return schemas.SCHEMA_VERSION


def _nothing(store: Store) -> dict[str, DataFrame]:
    """Tables begin with their first rows, and new columns come from the schema: rows that are there have nulls in them."""
    return {}


def _legacy(store: Store) -> dict[str, DataFrame]:
    """Documents that were duplicates become duplicate files; keys, postings and figures are those of the documents that stay."""
    if not store.live("invoice_documents"):
        return {}
    documents, moved = merge.move_legacy_duplicates(store.table("invoice_documents"))
    there = store.table("duplicate_files")
    added = merge.numbered(moved, there, "duplicate_id", "file_name", top=store.top("duplicate_files")).select(there.columns)
    return {"invoice_documents": documents, "duplicate_files": there.unionByName(added), **store.document_changes(documents.where(F.lit(False)), documents)}


MIGRATIONS = {1: _nothing, 2: _nothing, 3: _nothing, 4: _legacy}
