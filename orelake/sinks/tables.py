"""Parquet tables without a table format: layers, partition replace, and tables under one commit log."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orelake.operators import latest_by_key
from orelake.session import hadoop_path, scratch_path

BUCKET = "bucket__"
VERSION = "v__"


class CommitConflict(RuntimeError):
    """Another writer committed what this one's result depends on."""


class ConstraintViolation(ValueError):
    """Rows with a null or repeated key, or a null in a required column; nothing was committed."""


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole chain) and lets several consumers share one computation; the
    read keeps column pruning and filter push-down, unlike an RDD checkpoint.
    The copy goes with the application's scratch folder.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


@contextmanager
def scratch_copy(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`materialize`, for the length of a ``with`` block: the copy is deleted at its end."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> None:
    """Snappy Parquet, optionally ``partitionBy`` (bronze / silver layers)."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def replace_partition(df: DataFrame, path: str, part_col: str | Sequence[str], values: Sequence = ()) -> None:
    """Delete-then-insert of the partitions present in ``df`` and of those named in ``values``.

    Present partitions are swapped by a dynamic overwrite; a named one (value
    of a single ``part_col``) without rows in ``df`` is cleared, so a re-run
    that is empty now leaves nothing behind.  Other partitions stay untouched.
    Rows per named value are counted during the write, not by a second pass.
    """
    cols = [part_col] if isinstance(part_col, str) else list(part_col)
    if values and len(cols) != 1:
        raise ValueError("values name partitions of a single column")
    seen = Observation()
    if values:
        df = df.observe(seen, *[F.count(F.when(F.col(cols[0]) == F.lit(v), 1)).alias(f"n{i}") for i, v in enumerate(values)])
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "snappy").partitionBy(*cols).parquet(path))
    for i, v in enumerate(values):
        if seen.get[f"n{i}"] == 0:
            fs, p = hadoop_path(df.sparkSession, f"{path.rstrip('/')}/{cols[0]}={v}")
            fs.delete(p, True)


# ------------------------------------------------------------------ commit log
def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Names of the pointers, oldest first; none only where there is no pointer folder at all."""
    fs, p = hadoop_path(spark, f"{root.rstrip('/')}/_pointers")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n.isdigit())


def _manifest(spark: SparkSession, root: str, name: str) -> dict:
    fs, p = hadoop_path(spark, f"{root.rstrip('/')}/_pointers/{name}/part-00000")
    stream = fs.open(p)
    try:
        manifest = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        manifest["tables"]
        return manifest
    except (ValueError, KeyError, TypeError) as e:
        raise ValueError(f"unreadable table pointer {root}/_pointers/{name}") from e
    finally:
        stream.close()


def _current(spark: SparkSession, root: str) -> tuple[int, dict] | None:
    """(number, manifest) of the newest pointer; ``None`` only where none was ever committed.  An unreadable one raises."""
    names = _pointers(spark, root)
    return (int(names[-1]), _manifest(spark, root, names[-1])) if names else None


def _move_new(spark: SparkSession, src: str, dst: str, local: bool | None = None) -> bool:
    """Rename a folder that has files to ``dst``; ``False``, with nothing changed, where ``dst`` exists.

    Atomic either way: a POSIX rename refuses a folder that is not empty, and
    the file contexts of remote stores refuse an existing target.
    """
    fs, p = hadoop_path(spark, src)
    _, q = hadoop_path(spark, dst)
    if fs.getUri().getScheme() == "file" if local is None else local:
        try:
            os.rename(fs.makeQualified(p).toUri().getPath(), fs.makeQualified(q).toUri().getPath())
            return True
        except OSError:
            if fs.exists(q):
                return False
            raise
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), fs.getConf())
    kind = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = jvm.java.lang.reflect.Array.newInstance(kind, 0)
    try:
        context.rename(fs.makeQualified(p), fs.makeQualified(q), options)
        return True
    except Py4JJavaError:
        if fs.exists(q):
            return False
        raise


def _point(spark: SparkSession, root: str, manifest: dict) -> bool:
    """Compare and swap: make ``manifest`` the pointer of its number, whole, unless that number is taken (``False``)."""
    base = f"{root.rstrip('/')}/_pointers"
    own = f"{base}/_new-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, f"{own}/part-00000")
    out = fs.create(p)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    won = False
    try:
        won = _move_new(spark, own, f"{base}/{manifest['number']:012d}")
    finally:
        if not won:
            _delete(spark, own)
    return won


def _read_entry(spark: SparkSession, root: str, entry: dict, schema=None, parts: Sequence | None = None) -> DataFrame:
    own = schema or StructType.fromJson(entry["schema"])
    keys = entry["parts"] if parts is None else [str(k) for k in parts if str(k) in entry["parts"]]
    paths = sorted({f"{root}/{entry['parts'][k]}" for k in keys})
    if not paths:
        return spark.createDataFrame([], own)
    reader = spark.read.schema(own)
    if entry.get("by"):
        reader = reader.option("basePath", f"{root}/{entry['folder']}".rstrip("/"))
    return reader.parquet(*paths).select(*[f.name for f in own])


def read_current(spark: SparkSession, root: str, schema=None, table: str = "", parts: Sequence | None = None) -> DataFrame | None:
    """The current version of a table, or ``None`` if it has none yet.

    ``parts`` names partitions (or buckets): the others' files are not even
    listed.  Only a missing pointer means "none yet"; an unreadable pointer
    or version raises.
    """
    found = _current(spark, root)
    if found is None or table not in found[1]["tables"]:
        return None
    return _read_entry(spark, root.rstrip("/"), found[1]["tables"][table], schema, parts)


def read_tables(spark: SparkSession, root: str, schemas: dict | None = None) -> dict[str, DataFrame]:
    """All tables below ``root`` as one commit left them: a reader sees all of a commit's changes or none."""
    found = _current(spark, root)
    tables = found[1]["tables"] if found else {}
    return {n: _read_entry(spark, root.rstrip("/"), e, (schemas or {}).get(n)) for n, e in tables.items()}


def partitions(spark: SparkSession, root: str, table: str = "") -> list[str]:
    """The partition values (or bucket numbers) of a table, from the newest pointer alone."""
    found = _current(spark, root)
    return sorted(found[1]["tables"].get(table, {"parts": {}})["parts"]) if found else []


class Commit:
    """Changes to the tables below ``root`` that become visible together, by one new pointer.

    ``with Commit(spark, root) as c`` publishes at the end of the block; an
    exception inside leaves everything as it was.  Files are written first,
    under names of their own; the pointer, numbered one above the version the
    changes were made on, is created only if that number is free.  If another
    writer was faster, the changes are moved onto its version: an upsert is
    redone for just those buckets that the other writer changed as well,
    everything else is kept.  A table written with ``exclusive`` must not have
    changed at all (``CommitConflict``).

    The last ``keep`` pointers and those replaced less than ``keep_s`` seconds
    ago keep their files; older pointers go, and the files that only they name.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 2, keep_s: float = 0):
        self.spark, self.root, self.keep, self.keep_s = spark, root.rstrip("/"), keep, keep_s
        found = _current(spark, root)
        self.number, self.tables = (found[0], found[1]["tables"]) if found else (0, {})
        self.staged: dict[str, dict] = {}
        self.redo: dict[str, tuple] = {}
        self.scratch: list[str] = []
        self.written: set[str] = set()

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, kind, value, trace) -> None:
        try:
            if kind is None:
                self.publish()
            else:
                for path in self.written:
                    _delete(self.spark, path)
        finally:
            for path in self.scratch:
                _delete(self.spark, path)

    def _entry(self, table: str) -> dict | None:
        """The table as it is with the changes so far."""
        base, own = self.tables.get(table), self.staged.get(table)
        if own is None:
            return base
        parts = {} if own["whole"] or base is None else dict(base["parts"])
        for k, path in own["parts"].items():
            if path is None:
                parts.pop(k, None)
            else:
                parts[k] = path
        if len(parts) > 1:
            parts.pop("-", None)  # the empty first version
        return {k: v for k, v in own.items() if k not in ("whole", "exclusive")} | {"parts": parts}

    def read(self, table: str = "", schema=None, parts: Sequence | None = None) -> DataFrame | None:
        """A table with this commit's own changes, or ``None``."""
        entry = self._entry(table)
        return None if entry is None else _read_entry(self.spark, self.root, entry, schema, parts)

    def _version(self) -> str:
        return f"v-{self.number + 1:012d}-{uuid.uuid4().hex}"

    def _path(self, table: str, name: str) -> str:
        path = f"{table}/{name}" if table else name
        self.written.add(f"{self.root}/{path}")
        return path

    def _stage(self, table: str, df: DataFrame, parts: dict, whole: bool = False, **more) -> None:
        before = self.staged.get(table)
        if before and not whole:
            parts, whole = before["parts"] | parts, before["whole"]
        self.staged[table] = {"parts": parts, "schema": df.schema.jsonValue(), "folder": table, "whole": whole} | more

    def overwrite(self, df: DataFrame, table: str = "", exclusive: bool = False) -> None:
        """The whole table anew."""
        path = self._path(table, self._version())
        df.write.option("compression", "snappy").parquet(f"{self.root}/{path}")
        self._stage(table, df, {"all": path}, whole=True, exclusive=exclusive)

    def replace(self, df: DataFrame, column: str, values: Sequence, table: str = "", keys: Sequence[str] = (),
                required: Sequence[str] = (), exclusive: bool = False) -> None:
        """Delete-then-insert of the partitions ``values`` of ``column``; those without rows are cleared.

        Rows per partition and nulls in ``required`` and key columns are
        counted during the write.  Rows of other partitions raise.
        """
        entry = self._entry(table)
        if entry and entry.get("by") != column:
            raise ValueError(f"table {table or self.root} is not partitioned by {column}")
        version, seen = self._version(), Observation()
        c = F.col(column)
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                             *[F.count(F.when(c == F.lit(v), 1)).alias(f"n{i}") for i, v in enumerate(values)], *_nulls([*keys, *required]))
        for v in values:
            self._path(table, f"{column}={v}/{VERSION}={version}")
        (counted.withColumn(VERSION, F.lit(version)).write.mode("append").option("compression", "snappy")
         .partitionBy(column, VERSION).parquet(f"{self.root}/{table}".rstrip("/")))
        n = [seen.get[f"n{i}"] for i in range(len(values))]
        if sum(n) != seen.get["rows"]:
            raise ValueError(f"{table or self.root}: rows outside of the partitions {list(values)}")
        parts = {str(v): f"{table}/{column}={v}/{VERSION}={version}".lstrip("/") if n[i] else None for i, v in enumerate(values)}
        self._stage(table, df, parts, by=column, exclusive=exclusive)
        _check(table or self.root, self.read(table, parts=values) if keys else None, keys, seen.get)

    def upsert(self, updates: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (), buckets: int = 32,
               table: str = "", required: Sequence[str] = (), newest: Sequence[str] = (), exclusive: bool = False) -> None:
        """Keyed upsert into a table split into ``buckets`` by the hash of its keys.

        Only buckets with an update are read and rewritten.  The touched
        buckets (at most ``buckets`` numbers) are all that the driver sees.
        No updates leave the table as it is, or make an empty first version.
        Null keys and, without an ``order``, repeated keys raise.

        With ``newest`` (columns of the table) a stored row is replaced only
        by one that is greater in that order, so updates may come late, twice
        or from several writers; those that change nothing rewrite nothing.
        """
        order = order or newest
        upd = latest_by_key(updates, list(keys), list(order)) if order else updates
        entry = self._entry(table)
        if entry and entry.get("buckets") != buckets:
            raise ValueError(f"table {table or self.root} is not split into {buckets} buckets")
        seen, path = Observation(), scratch_path(self.spark, "updates")
        self.scratch.append(path)
        split = upd.withColumn(BUCKET, _bucket(keys, buckets))
        split.observe(seen, F.count(F.lit(1)).alias("rows"), *_nulls([*keys, *required])).write.parquet(path)
        upd = self.spark.read.schema(split.schema).parquet(path)
        _check(table or self.root, None if order else upd, keys, seen.get)
        if newest and entry:
            upd = self._winners(entry, upd, keys, newest)
        touched = sorted(r[0] for r in upd.select(BUCKET).distinct().collect())
        if entry and not touched:
            return
        parts = self._merge(table, entry, upd, keys, touched, buckets)
        self._stage(table, upd.drop(BUCKET), parts, buckets=buckets, exclusive=exclusive)
        self.redo[table] = (upd, keys, touched, buckets, newest)

    def _winners(self, entry: dict, upd: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
        """The updates that are newer than the stored row of their key, or have none."""
        touched = [r[0] for r in upd.select(BUCKET).distinct().collect()]
        paths = [f"{self.root}/{entry['parts'][str(b)]}" for b in touched if str(b) in entry["parts"]]
        if not paths:
            return upd
        old = self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(*paths).select(*keys, *[c for c in newest if c not in keys])
        old = old.join(upd.select(*keys), list(keys), "left_semi")
        both = upd.withColumn("new__", F.lit(1)).unionByName(old.withColumn("new__", F.lit(0)), allowMissingColumns=True)
        best = latest_by_key(both, list(keys), [*newest, F.col("new__").asc()]).filter("new__ = 1").drop("new__")
        path = scratch_path(self.spark, "newer")
        self.scratch.append(path)
        best.write.parquet(path)
        return self.spark.read.schema(upd.schema).parquet(path)

    def _merge(self, table: str, entry: dict | None, upd: DataFrame, keys: Sequence[str], touched: Sequence[int], buckets: int,
               newest: Sequence[str] = ()) -> dict:
        """Write the touched buckets of ``entry`` with the updates; their new parts."""
        path, out = self._path(table, self._version()), upd.filter(F.col(BUCKET).isin(list(touched)))
        old = [f"{self.root}/{entry['parts'][str(b)]}" for b in touched if str(b) in entry["parts"]] if entry else []
        if old:
            kept = self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(*old).withColumn(BUCKET, _bucket(keys, buckets))
            if newest:
                out = latest_by_key(kept.select(*upd.columns).unionByName(out), list(keys), list(newest))
            else:
                out = kept.join(out.select(*keys), list(keys), "left_anti").select(*upd.columns).unionByName(out)
        if not touched:
            out.drop(BUCKET).write.parquet(f"{self.root}/{path}")
            return {"-": path}
        out.repartition(BUCKET).write.option("compression", "snappy").partitionBy(BUCKET).parquet(f"{self.root}/{path}")
        return {str(b): f"{path}/{BUCKET}={b}" for b in touched}

    def publish(self, attempts: int = 100) -> int | None:
        """Point to the changes; returns the commit's number (``None`` if there are none)."""
        if not self.staged:
            return None
        for _ in range(attempts):
            now = {t: self._entry(t) for t in [*self.tables, *[t for t in self.staged if t not in self.tables]]}
            if _point(self.spark, self.root, {"number": self.number + 1, "tables": now}):
                self.number, self.tables, self.staged, self.redo, self.written = self.number + 1, now, {}, {}, set()
                vacuum(self.spark, self.root, self.keep, self.keep_s)
                return self.number
            self._rebase()
        raise CommitConflict(f"{self.root}: {attempts} other commits in a row")

    def _rebase(self) -> None:
        """Move the changes onto the newest version."""
        number, found = _current(self.spark, self.root)
        theirs = found["tables"]
        for table, own in self.staged.items():
            before, after = self.tables.get(table), theirs.get(table)
            if own.get("exclusive") and before != after:
                raise CommitConflict(f"{self.root}: {table or 'the table'} was changed by commit {number}")
            if after is None or own["whole"]:
                continue
            if any(after.get(k) != own.get(k) for k in ("buckets", "by")):
                raise CommitConflict(f"{self.root}: {table or 'the table'} has another layout since commit {number}")
            if table in self.redo:
                upd, keys, touched, buckets, newest = self.redo[table]
                old = before["parts"] if before else {}
                changed = [b for b in touched if after["parts"].get(str(b)) != old.get(str(b))]
                if after["schema"] != own["schema"]:
                    raise CommitConflict(f"{self.root}: {table or 'the table'} has another schema since commit {number}")
                if changed:
                    lost = [own["parts"][str(b)] for b in changed]
                    own["parts"] |= self._merge(table, after, upd, keys, changed, buckets, newest)
                    for path in lost:
                        _delete(self.spark, f"{self.root}/{path}")
        self.number, self.tables = number, theirs


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _nulls(columns: Sequence[str]) -> list[Column]:
    return [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in dict.fromkeys(columns)]


def _check(name: str, rows: DataFrame | None, keys: Sequence[str], seen: dict) -> None:
    """Raise where the write counted nulls, or where ``rows`` repeat a key (five of them are named)."""
    bad = [k.removeprefix("null_") for k, n in seen.items() if k.startswith("null_") and n]
    if bad:
        raise ConstraintViolation(f"{name}: null in {', '.join(bad)}")
    if rows is not None and keys:
        twice = rows.groupBy(*keys).count().filter("count > 1").limit(5).collect()
        if twice:
            raise ConstraintViolation(f"{name}: repeated key " + "; ".join(str(tuple(r)[:-1]) for r in twice))


def vacuum(spark: SparkSession, root: str, keep: int = 2, keep_s: float = 0) -> None:
    """Delete pointers that are neither among the last ``keep`` nor replaced within ``keep_s`` seconds, and what only they name."""
    root = root.rstrip("/")
    names = _pointers(spark, root)
    fs, _ = hadoop_path(spark, root)

    def age(name: str) -> float:
        _, q = hadoop_path(spark, f"{root}/_pointers/{name}")
        return time.time() - fs.getFileStatus(q).getModificationTime() / 1000
    last = max(1, len(names) - keep + 1)  # pointers before this one may go; the one after a pointer tells when it was replaced
    gone = 0
    while gone < last - 1 and (keep_s <= 0 or age(names[gone + 1]) > keep_s):
        gone += 1
    if not gone:
        return
    parts = lambda n: {p for e in _manifest(spark, root, n)["tables"].values() for p in e["parts"].values()}
    used = parts(names[gone])  # a part named by any later pointer, but not by this one, is newer than all that goes
    folder = lambda p: p.rsplit("/", 1)[0] if f"/{BUCKET}=" in p else p
    kept = {folder(p) for p in used}
    for n in names[:gone]:
        for p in parts(n) - used:
            _delete(spark, f"{root}/{folder(p) if folder(p) not in kept else p}")
        _delete(spark, f"{root}/_pointers/{n}")


def write_version(df: DataFrame, root: str, exclusive: bool = False, keep_s: float = 0) -> int:
    """Write ``df`` as the whole new version of a table; the commit's number.

    A crash at any moment leaves the version before it current; readers see
    the old or the new one.  Of two writers at once the later one stays, or,
    with ``exclusive``, raises ``CommitConflict``.
    """
    with Commit(df.sparkSession, root, keep_s=keep_s) as c:
        c.overwrite(df, exclusive=exclusive)
    return c.number


def upsert(spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str],
           order: Sequence[Column | str] = (), buckets: int = 32, keep_s: float = 0, newest: Sequence[str] = ()) -> DataFrame:
    """Keyed upsert (see :meth:`Commit.upsert`) as a commit of its own; the table after it.

    Concurrent upserts all take effect, in the order of their commits.
    """
    with Commit(spark, root, keep_s=keep_s) as c:
        c.upsert(updates, keys, order, buckets, newest=newest)
    return read_current(spark, root)


def remove_orphans(spark: SparkSession, root: str, older_than_s: float = 86_400) -> int:
    """Delete version folders that no pointer names and that are older than any running write may be; their number.

    Such folders are left by writers that were killed; nobody reads them.
    """
    base = root.rstrip("/")
    fs, p = hadoop_path(spark, base)
    own = fs.makeQualified(p).toUri().getPath()  # a listing gives paths without the scheme that ``root`` may have
    used = {f"{own}/{x}" for n in _pointers(spark, base) for e in _manifest(spark, base, n)["tables"].values() for x in e["parts"].values()}
    found, gone = [p], 0
    for _ in range(3):  # table, partition, version
        inner = [s for q in found for s in fs.listStatus(q) if s.isDirectory() and s.getPath().getName() != "_pointers"]
        found = []
        for s in inner:
            name, path = s.getPath().getName(), s.getPath().toUri().getPath()
            if not name.startswith(("v-", f"{VERSION}=")):
                found.append(s.getPath())
            elif not any(u == path or u.startswith(f"{path}/") for u in used) and time.time() - s.getModificationTime() / 1000 > older_than_s:
                gone += fs.delete(s.getPath(), True)
    return gone


def merge_upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str] = ()) -> DataFrame:
    """``INSERT OR REPLACE`` by key, as a plan: target rows whose key is updated are replaced.

    Updates are first reduced to one row per key (``order``, newest first;
    without an order the updates must already be unique).  ``left_anti``
    join + ``unionByName``: both sides are shuffled once on the key.
    """
    upd = latest_by_key(updates, list(keys), list(order)) if order else updates
    if target is None:
        return upd
    kept = target.join(upd.select(*keys), list(keys), "left_anti")
    return kept.unionByName(upd.select(*target.columns))


def write_json_record(df: DataFrame, path: str) -> None:
    """A one-row metrics / side-car DataFrame as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
