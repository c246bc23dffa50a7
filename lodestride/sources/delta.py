"""Tables with a transaction log (the open Delta protocol): snapshot reads and atomic writes, in DataFrame jobs.

A snapshot is what the log says: its JSON commits, and the newest Parquet checkpoint below them, are read as one table of
actions and reduced by Spark to the last action of each path; paths whose last action is an add are live. Filters on
partition values and on the statistics of the log leave out files that can't hold a row before any data is read.

A write stages its files in a folder that the log doesn't name, moves them to their partitions under new names, and
ends with one rename of a commit file, which fails where that version is taken. A job that dies
before it leaves the table as it was. Deletes and merges rewrite only files that hold a matching row.

Readers of protocol 1 to 3 are served as far as the table uses no feature that changes what rows a file has: deletion
vectors, column mapping, checkpoints of the second kind and unknown features raise UnsupportedTable. An empty folder, or one whose
log has a gap, raises too.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the open protocol.
LOG = "_delta_log"
KNOWN_FEATURES = {"timestampNtz", "vacuumProtocolCheck"}
ACTIONS = (
    "add struct<path:string,partitionValues:map<string,string>,size:bigint,modificationTime:bigint,dataChange:boolean,stats:string,deletionVector:struct<storageType:string>>, "
    "remove struct<path:string,deletionTimestamp:bigint,dataChange:boolean>, "
    "metaData struct<id:string,schemaString:string,partitionColumns:array<string>,configuration:map<string,string>>, "
    "protocol struct<minReaderVersion:int,minWriterVersion:int,readerFeatures:array<string>,writerFeatures:array<string>>"
)
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
STATISTICS = (T.NumericType, T.StringType, T.DateType)

Condition = tuple[str, str, object]  # column, one of = < <= > >=, value


class UnsupportedTable(ValueError):
    """The log asks for something that would give wrong rows here."""


class ConcurrentWrite(RuntimeError):
    """Another writer took the version; read the table again and repeat the write."""


class _Files:
    """The file system of a path, on the driver; names only."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.fs.exists(self.path(folder)) else []

    def files_below(self, folder: str) -> list[tuple[str, int, int]]:
        """(path relative to ``folder``, bytes, time) of all files."""
        found, out = self.fs.listFiles(self.path(folder), True), []
        base = self.fs.makeQualified(self.path(folder)).toUri().getPath()
        while found.hasNext():
            s = found.next()
            out.append((s.getPath().toUri().getPath()[len(base) + 1 :], s.getLen(), s.getModificationTime()))
        return out

    def move_new(self, source: str, target: str) -> bool:
        """Renames a file unless ``target`` is there."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        flags = self.gateway.new_array(kind, 1)
        flags[0] = kind.NONE
        try:
            context.rename(self.path(source), self.path(target), flags)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def write(self, target: str, text: str) -> None:
        out = self.fs.create(self.path(target), True)
        out.write(bytearray(text.encode()))
        out.close()

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} can't be moved to {target}")

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


@dataclass
class Snapshot:
    """One version of a table; ``files`` has its live files: path, partition (a map of texts), size, stats (JSON)."""

    path: str
    version: int
    schema: T.StructType
    partition_columns: list[str]
    files: DataFrame
    meta: dict


def _log_files(files: _Files, path: str, version: int | None) -> tuple[int, int, list[str]]:
    """The version to read, that of the checkpoint below it (-1: none), and the files of the log that make it up."""
    names = files.names(f"{path}/{LOG}")
    commits = sorted(int(n[:20]) for n in names if n.endswith(".json") and n[:20].isdigit() and len(n) == 25)
    points: dict[int, list[str]] = {}
    for n in names:
        if n[:20].isdigit() and ".checkpoint." in n:
            middle = n[21:].split(".")
            if middle[0] != "checkpoint" or n.endswith(".json") or (len(middle) > 2 and not middle[1].isdigit()):
                raise UnsupportedTable(f"checkpoint {n}")
            points.setdefault(int(n[:20]), []).append(n)
    whole = {v: ns for v, ns in points.items() if all(len(n[21:].split(".")) == 2 or len(ns) == int(n[21:].split(".")[2]) for n in ns)}
    newest = max([*commits, *whole], default=-1)
    if newest < 0:
        raise FileNotFoundError(f"{path} has no log")
    wanted = newest if version is None else version
    if wanted > newest or wanted < 0:
        raise ValueError(f"version {wanted}: the newest is {newest}")
    base = max((v for v in whole if v <= wanted), default=-1)
    needed = list(range(base + 1, wanted + 1))
    if missing := sorted(set(needed) - set(commits)):
        raise UnsupportedTable(f"versions {missing[:5]} are missing from the log")
    return wanted, base, [f"{path}/{LOG}/{v:020d}.json" for v in needed] + [f"{path}/{LOG}/{n}" for n in whole.get(base, ())]


def _actions(spark: SparkSession, paths: list[str], base: int) -> DataFrame:
    """All actions with their version."""
    schema = T.StructType.fromDDL(ACTIONS)
    version = F.substring(F.col("_metadata.file_name"), 1, 20).cast("long").alias("version")
    commits, points = [p for p in paths if p.endswith(".json")], [p for p in paths if p.endswith(".parquet")]
    parts = [spark.read.schema(schema).json(commits).select("*", version)] if commits else []
    parts += [spark.read.schema(schema).parquet(*points).select("*", F.lit(base).cast("long").alias("version"))] if points else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The table at ``version``, or at its newest."""
    path = path.rstrip("/")
    wanted, base, log = _log_files(_Files(spark, path), path, version)
    actions = _actions(spark, log, base)
    head = actions.agg(
        F.expr("max_by(metaData, version) FILTER (WHERE metaData IS NOT NULL)").alias("meta"),
        F.expr("max_by(protocol, version) FILTER (WHERE protocol IS NOT NULL)").alias("protocol"),
    ).head()  # one row
    if head["meta"] is None or head["protocol"] is None:
        raise UnsupportedTable("the log has no metadata or no protocol")
    meta, protocol = head["meta"].asDict(True), head["protocol"].asDict()
    features = set(protocol["readerFeatures"] or ())
    mapped = (meta["configuration"] or {}).get("delta.columnMapping.mode", "none") != "none"
    if protocol["minReaderVersion"] > 3 or features - KNOWN_FEATURES or mapped:
        raise UnsupportedTable(f"reader version {protocol['minReaderVersion']}, features {sorted(features - KNOWN_FEATURES)}, column mapping {mapped}")
    paths = actions.where("add IS NOT NULL OR remove IS NOT NULL").select(
        # Writers escape names each in their own way, so the names themselves are compared; a plus sign is no blank here.
        F.url_decode(F.replace(F.coalesce("add.path", "remove.path"), F.lit("+"), F.lit("%2B"))).alias("path"), F.struct("version", F.col("add").isNotNull().alias("live")).alias("at"), F.struct("add.partitionValues", "add.size", "add.stats", "add.deletionVector").alias("file")
    )
    # A path that one version removes and adds again is live.
    files = paths.groupBy("path").agg(F.max("at").alias("at"), F.max_by("file", "at").alias("file")).where("at.live")
    files = files.select("path", F.coalesce("file.partitionValues", F.create_map().cast("map<string,string>")).alias("partition"), "file.size", "file.stats", F.col("file.deletionVector").isNotNull().alias("vector"))
    return Snapshot(path, wanted, _nullable(T.StructType.fromJson(json.loads(meta["schemaString"]))), list(meta["partitionColumns"] or ()), files, meta)


def _compare(low: Column, high: Column, op: str, value: Column) -> Column:
    """Whether a value from ``low`` to ``high`` may stand in ``op`` to ``value``."""
    return {"=": (low <= value) & (high >= value), "<": low < value, "<=": low <= value, ">": high > value, ">=": high >= value}[op]


def _all(where: list[Condition]) -> Column:
    """All of ``where``; a null meets none."""
    out = F.lit(True)
    for name, op, value in where:
        out = out & F.coalesce(_compare(F.col(f"`{name}`"), F.col(f"`{name}`"), op, F.lit(value)), F.lit(False))
    return out


def _may_hold(state: Snapshot, where: list[Condition]) -> Column:
    """Whether a file may hold a row for which all of ``where`` is true; what the log doesn't tell is a yes."""
    out = F.lit(True)
    for name, op, value in where:
        kind = state.schema[name].dataType
        v = F.lit(value).cast(kind)
        if name in state.partition_columns:
            own = F.col("partition")[name].cast(kind)
            low = high = own
        elif isinstance(kind, STATISTICS):
            bounds = F.from_json("stats", T.StructType([T.StructField(b, T.StructType([T.StructField(name, kind)])) for b in ("minValues", "maxValues")]))
            low, high = bounds["minValues"][name], bounds["maxValues"][name]
        else:
            continue
        # A null partition meets no condition; a file without statistics may hold anything.
        out = out & F.coalesce(_compare(low, high, op, v), F.lit(name not in state.partition_columns))
    return out


def live_files(state: Snapshot, where: list[Condition] = ()) -> list[str]:
    """Paths, below the table's folder, of the files that may hold rows of ``where``. A list of file names, as Spark's own listing of a folder is."""
    rows = state.files.where(_may_hold(state, list(where))).select("path", "vector").collect()
    if any(r["vector"] for r in rows):
        raise UnsupportedTable("deletion vectors")
    names, n = [r["path"] for r in rows], len(state.partition_columns)
    for name in names:
        folders = name.split("/")[:-1]
        if ":/" in name or name.startswith("/") or (n and [unquote(f.split("=")[0]) for f in folders[-n:]] != state.partition_columns):
            raise UnsupportedTable(f"file {name} isn't in a folder of its partition")
    return names


def _escaped(path: str) -> str:
    """Spark takes these characters for patterns."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def _rows_of(spark: SparkSession, state: Snapshot, names: list[str], with_file: bool = False) -> DataFrame:
    if not names:
        empty = spark.createDataFrame([], state.schema)
        return empty.withColumn("__file", F.lit("")) if with_file else empty
    read = spark.read.schema(state.schema).option("basePath", state.path).parquet(*[_escaped(f"{state.path}/{n}") for n in names])
    return read.select(*state.schema.names, F.col("_metadata.file_path").alias("__file")) if with_file else read.select(*state.schema.names)


def read_delta(spark: SparkSession, path: str, version: int | None = None, where: list[Condition] = ()) -> DataFrame:
    """Rows of the table at ``version`` (or its newest) for which all of ``where`` is true."""
    state = snapshot(spark, path, version)
    rows = _rows_of(spark, state, live_files(state, where))
    return rows.where(_all(where))


# Writing --------------------------------------------------------------------------------------


def _statistics(spark: SparkSession, path: str, names: list[str], schema: T.StructType, partition_columns: list[str]) -> dict[str, str]:
    """Row counts, minima, maxima and null counts of the files below ``path``, as the log has them, by their place there."""
    columns = [f.name for f in schema.fields if isinstance(f.dataType, STATISTICS) and f.name not in partition_columns]
    plain = T.StructType([f for f in schema.fields if f.name not in partition_columns])
    rows = spark.read.schema(plain).option("recursiveFileLookup", True).parquet(path)
    each = lambda f: F.struct(*[f(F.col(f"`{c}`")).alias(c) for c in columns])
    picked = {"minValues": each(F.min), "maxValues": each(F.max), "nullCount": each(lambda c: F.count_if(c.isNull()))} if columns else {}
    found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("numRecords"), *[c.alias(n) for n, c in picked.items()])).alias("stats"))
    folder = f"/{path.rsplit('/', 1)[-1]}/"
    return {unquote(r["file"]).split(folder, 1)[1]: r["stats"] for r in found.collect()}  # one row a new file


def _staged(df: DataFrame, path: str, schema: T.StructType, partition_columns: list[str]) -> list[dict]:
    """Writes ``df`` as files that no commit names yet, and returns their adds."""
    spark, files = df.sparkSession, _Files(df.sparkSession, path)
    stage = f"{path}/_staged_{uuid.uuid4().hex}"
    writer = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]).write
    (writer.partitionBy(*partition_columns) if partition_columns else writer).parquet(stage)
    new = [x for x in files.files_below(stage) if x[0].endswith(".parquet")]
    stats = _statistics(spark, stage, [n for n, _, _ in new], schema, partition_columns) if new else {}
    adds = []
    for name, size, modified in new:
        if name in stats:  # Spark writes a file without rows for an empty partition
            values = {k: None if v == NULL_FOLDER else unquote(v) for k, v in (f.split("=", 1) for f in name.split("/")[:-1])}
            files.move(f"{stage}/{name}", f"{path}/{name}")
            adds.append({"add": {"path": quote(name, safe="/=-_.~"), "partitionValues": values, "size": size, "modificationTime": modified, "dataChange": True, "stats": stats[name]}})
    files.delete(stage)
    return adds


def _commit(spark: SparkSession, path: str, version: int, operation: str, actions: list[dict]) -> int:
    """Makes ``actions`` the version: one new file, or ConcurrentWrite."""
    files = _Files(spark, path)
    lines = [{"commitInfo": {"timestamp": int(time.time() * 1000), "operation": operation}}, *actions]
    files.fs.mkdirs(files.path(f"{path}/{LOG}"))
    draft = f"{path}/{LOG}/.draft_{uuid.uuid4().hex}"
    files.write(draft, "\n".join(map(json.dumps, lines)) + "\n")
    if not files.move_new(draft, f"{path}/{LOG}/{version:020d}.json"):
        files.delete(draft)
        raise ConcurrentWrite(f"version {version} of {path}")
    return version


def _remove(name: str) -> dict:
    return {"remove": {"path": quote(name, safe="/=-_.~"), "deletionTimestamp": int(time.time() * 1000), "dataChange": True}}


def write_delta(df: DataFrame, path: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> int:
    """append or overwrite as a new version; the first write creates the table. Returns the version.

    Columns that the table doesn't have are added to its schema; ones that ``df`` doesn't have are null in its rows.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if not _Files(spark, path).names(f"{path}/{LOG}"):
        head = [
            {"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}},
            {"metaData": {"id": str(uuid.uuid4()), "format": {"provider": "parquet", "options": {}}, "schemaString": _nullable(df.schema).json(), "partitionColumns": list(partition_by), "configuration": {}, "createdTime": int(time.time() * 1000)}},
        ]
        return _commit(spark, path, 0, "WRITE", head + _staged(df, path, _nullable(df.schema), list(partition_by)))
    state = snapshot(spark, path)
    fresh = [f for f in df.schema.fields if f.name not in state.schema.names]
    schema = _nullable(T.StructType([*state.schema.fields, *fresh]))
    head = [{"metaData": state.meta | {"schemaString": _nullable(schema).json(), "format": {"provider": "parquet", "options": {}}}}] if fresh else []
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in state.schema.fields if f.name not in df.columns}
    gone = [_remove(n) for n in live_files(state)] if mode == "overwrite" else []
    return _commit(spark, path, state.version + 1, "WRITE", head + gone + _staged(df.withColumns(lacking) if lacking else df, path, schema, state.partition_columns))


def _nullable(kind: T.DataType) -> T.DataType:
    """``kind`` with nulls allowed at every depth, as rows of later writes may have them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _touched(spark: SparkSession, state: Snapshot, rows: DataFrame) -> list[str]:
    """Names of the files that ``rows`` (with __file) come from."""
    files = _Files(spark, state.path)
    base = files.fs.makeQualified(files.path(state.path)).toUri().getPath()
    found = [unquote(r["__file"]) for r in rows.select("__file").distinct().collect()]  # file names
    return [f[f.index(f"{base}/") + len(base) + 1 :] for f in found]


def delete_rows(spark: SparkSession, path: str, where: list[Condition]) -> int:
    """Deletes the rows for which all of ``where`` is true; files without one stay as they are. Returns the version."""
    path = path.rstrip("/")
    state = snapshot(spark, path)
    hit = _all(where)
    touched = _touched(spark, state, _rows_of(spark, state, live_files(state, where), True).where(hit))
    if not touched:
        return state.version
    rest = _rows_of(spark, state, touched).where(~hit)
    return _commit(spark, path, state.version + 1, "DELETE", [_remove(n) for n in touched] + _staged(rest, path, state.schema, state.partition_columns))


def replace_rows(df: DataFrame, path: str, where: list[Condition]) -> int:
    """The rows for which all of ``where`` is true become those of ``df``, in one version; rows of ``df`` outside it are an error. Returns the version.

    Files without such a row stay as they are, so a day of a table partitioned by days costs that day.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    state, hit = snapshot(spark, path), _all(where)
    if df.where(~hit).head() is not None:
        raise ValueError(f"rows outside {where}")
    touched = _touched(spark, state, _rows_of(spark, state, live_files(state, where), True).where(hit))
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in state.schema.fields if f.name not in df.columns}
    rows = (df.withColumns(lacking) if lacking else df).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in state.schema.fields])
    rows = rows.unionByName(_rows_of(spark, state, touched).where(~hit)) if touched else rows
    return _commit(spark, path, state.version + 1, "REPLACE", [_remove(n) for n in touched] + _staged(rows, path, state.schema, state.partition_columns))


def merge_rows(updates: DataFrame, path: str, keys: list[str], columns: list[str] | None = None, insert: bool = True) -> int:
    """Rows of the table with the keys of a row of ``updates`` take its ``columns`` (all that both have, but keys); ``insert`` adds the rows with new keys.

    Null keys match nothing. Two updates of one key are an error, as either could win. Only files with a matching row are rewritten;
    the range of each key in ``updates`` leaves out files by their statistics first. Returns the version.
    """
    spark, path = updates.sparkSession, path.rstrip("/")
    state = snapshot(spark, path)
    columns = [c for c in state.schema.names if c in updates.columns and c not in keys] if columns is None else columns
    stats = updates.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{k}`")).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max))]).head()  # one row
    if not stats["n"]:
        return state.version
    if updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).dropna(subset=keys).head() is not None:
        raise ValueError(f"updates have two rows of one {', '.join(keys)}")
    span = [(k, op, stats[f"{n}_{i}"]) for i, k in enumerate(keys) for op, n in ((">=", "low"), ("<=", "high")) if stats[f"{n}_{i}"] is not None]
    candidates = live_files(state, span)
    fresh = updates.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in updates.columns]).alias("__new"))
    same = lambda rows: [rows[f"`{k}`"] == fresh[f"__k{i}"] for i, k in enumerate(keys)]
    stored = _rows_of(spark, state, candidates, True)
    touched = _touched(spark, state, stored.join(fresh, same(stored), "left_semi"))
    parts = []
    if touched:
        old = _rows_of(spark, state, touched)
        joined = old.join(fresh, same(old), "left")
        parts.append(joined.select(*[F.when(F.col("__new").isNotNull(), F.col(f"__new.`{c}`")).otherwise(F.col(f"`{c}`")).cast(state.schema[c].dataType).alias(c) if c in columns else F.col(f"`{c}`") for c in state.schema.names]))
    if insert:
        had = stored.select(*[F.col(f"`{k}`").alias(f"__h{i}") for i, k in enumerate(keys)])
        new = fresh.join(had, [fresh[f"__k{i}"] == had[f"__h{i}"] for i in range(len(keys))], "left_anti").select("__new.*")
        parts.append(new.select(*[(F.col(f"`{c}`") if c in new.columns else F.lit(None)).cast(state.schema[c].dataType).alias(c) for c in state.schema.names]))
    if not parts:
        return state.version
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    adds = _staged(rows, path, state.schema, state.partition_columns)
    if not adds and not touched:
        return state.version
    return _commit(spark, path, state.version + 1, "MERGE", [_remove(n) for n in touched] + adds)


def _encoded(path: Column) -> Column:
    """A name as the log has it: escaped but for what folders and partitions are made of."""
    return F.replace(F.replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("%3D"), F.lit("="))


def write_log_checkpoint(spark: SparkSession, path: str) -> int:
    """The live files of the newest version as one Parquet file, so that readers needn't replay older commits. Returns the version."""
    path = path.rstrip("/")
    state, files = snapshot(spark, path), _Files(spark, path)
    schema = T.StructType.fromDDL(ACTIONS)
    none = lambda name: F.lit(None).cast(schema[name].dataType).alias(name)
    add = F.struct(_encoded(F.col("path")).alias("path"), F.col("partition").alias("partitionValues"), "size", F.lit(0).cast("long").alias("modificationTime"), F.lit(False).alias("dataChange"), "stats", F.lit(None).cast("struct<storageType:string>").alias("deletionVector"))
    adds = state.files.select(add.alias("add"), none("remove"), none("metaData"), none("protocol"))
    meta = spark.createDataFrame([(None, None, {k: state.meta[k] for k in ("id", "schemaString", "partitionColumns", "configuration")}, {"minReaderVersion": 1, "minWriterVersion": 2})], schema)
    stage = f"{path}/{LOG}/.stage_{uuid.uuid4().hex}"
    adds.unionByName(meta).coalesce(1).write.parquet(stage)
    (part,) = [n for n in files.names(stage) if n.startswith("part-")]
    files.move_new(f"{stage}/{part}", f"{path}/{LOG}/{state.version:020d}.checkpoint.parquet")
    files.delete(stage)
    files.write(f"{path}/{LOG}/_last_checkpoint", json.dumps({"version": state.version}))
    return state.version
