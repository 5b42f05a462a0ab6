"""Tables of immutable files under numbered manifests: merged when read, committed optimistically.

* A table is a set of folders ``data/__att=<attempt>/__part=<part>``. Every writer works in an attempt of its own,
  named at random, so writers never touch each other's files and a crash leaves nothing that a manifest names.
* A load adds folders with its new rows, and a *delete set*: the keys that no longer count in which older
  folders. So it writes in proportion to the load, whatever the table holds. Readers leave out the rows named by delete sets; folders
  without any are scanned plainly.
* Every attempt has a *key index*: for each file its least and greatest rank key and a Bloom filter, built by partial
  aggregates as bitmaps of 32,768 bits (some ten bits a key; a key sets four bits of one bitmap). A load finds the
  rows it may replace by reading two columns of those files alone whose index does not rule its keys out.
* A commit puts the next manifest if it is absent (rename without overwrite; the store must refuse to replace a file). Who comes
  second looks at what was committed meanwhile: if it cannot hold keys of the load, and the folders of the load's deletes
  are still there, the commit is put on top; otherwise ``CommitConflict`` is raised and the load is merged again.
* ``compact`` rewrites folders of a part once ``fan`` of them are of about one size (powers of ``fan``), or a
  third of a folder's rows are dead, so a row is rewritten a logarithmic number of times and a part has few folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.sources.types import common_type, readable

RANK_KEY, RANK_ORDER, PART = "__rk", "__ro", "__part"
HIDDEN = (RANK_KEY, RANK_ORDER, PART)
ATT = "__att"
_BITS, _HASHES, _BITS_A_KEY = 32_768, 4, 10


class CommitConflict(RuntimeError):
    """Another writer has committed what this load should have been merged with."""


@dataclass(frozen=True)
class Folder:
    """The rows of one part written by one attempt; ``deletes`` are the attempts whose delete sets name rows of it."""

    attempt: str
    part: str
    rows: int
    bytes: int
    dead: int = 0
    deletes: tuple = ()

    @property
    def path(self) -> str:
        return f"data/{ATT}={self.attempt}/{PART}={self.part}"

    @property
    def name(self) -> tuple[str, str]:
        return self.attempt, self.part


@dataclass(frozen=True)
class Manifest:
    """One version of a table. ``keys`` are the columns of its delete sets; ``watermarks`` the newest batch of each relation;
    ``schema`` (JSON) has the columns of all its folders, so that no file is opened to learn them; ``grain`` is that of parts by time."""

    version: int
    n_parts: int
    folders: tuple = ()
    epoch: int | None = None
    keys: tuple = (RANK_KEY,)
    watermarks: dict = field(default_factory=dict)
    schema: str = ""
    grain: str = "day"

    def parts(self) -> dict[str, list[Folder]]:
        out: dict[str, list[Folder]] = {}
        for f in self.folders:
            out.setdefault(f.part, []).append(f)
        return out


# --- files (through the session's Hadoop file systems, so any store Spark writes to) ----------------------

def _path(spark: SparkSession, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(name)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, names: Iterable[str]) -> None:
    for n in names:
        p, fs = _path(spark, n)
        fs.delete(p, True)


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file; False, and nothing changed, if there is one already."""
    jvm = spark._jvm
    tmp, fs = _path(spark, f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    target, _ = _path(spark, path)
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_option = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), no_option)
        return True
    except Py4JJavaError as e:
        fs.delete(tmp, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


# --- manifests --------------------------------------------------------------------------------------------

def _manifest_path(base: str, version: int) -> str:
    return f"{base}/_versions/{version:012d}.json"


def _versions(spark: SparkSession, base: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{base}/_versions") if n.endswith(".json") and n[:-5].isdigit()]


def load_manifest(spark: SparkSession, base: str, version: int) -> Manifest:
    doc = json.loads(spark.read.text(_manifest_path(base, version), wholetext=True).first()[0])
    folders = tuple(Folder(**{**f, "deletes": tuple(f["deletes"])}) for f in doc.pop("folders"))
    return Manifest(**{**doc, "folders": folders, "keys": tuple(doc["keys"])})


def read_manifest(spark: SparkSession, base: str) -> Manifest | None:
    """The newest manifest; None only if there is none. Any failure to read is raised."""
    versions = _versions(spark, base)
    return load_manifest(spark, base, versions[-1]) if versions else None


def put_manifest(spark: SparkSession, base: str, m: Manifest) -> bool:
    return _put_if_absent(spark, _manifest_path(base, m.version), json.dumps(asdict(m)))


# --- reading ----------------------------------------------------------------------------------------------

def _parquet(spark: SparkSession, m: Manifest, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(m.schema))).parquet(*paths)


def _schema_of(old: Manifest | None, df: DataFrame) -> str:
    """The columns of both; a column that changes its type must be readable as the new one, so only new fields and wider numbers
    are allowed."""
    have = df.drop(PART, ATT).schema
    if old is None or not old.schema:
        return json.dumps(have.jsonValue())
    before = T.StructType.fromJson(json.loads(old.schema))
    both = common_type([before, have])
    for f in both.fields:
        for side in (before, have):
            if f.name in side.names and not readable(side[f.name].dataType, f.dataType):
                raise TypeError(f"column {f.name} was {before[f.name].dataType.simpleString()} and is {have[f.name].dataType.simpleString()}:"
                                " rebuild the table with full_refresh")
    return json.dumps(both.jsonValue())


def _placed(df: DataFrame) -> DataFrame:
    """With the attempt and part of each row, from the path of its file."""
    path = F.col("_metadata.file_path")
    return df.withColumns({ATT: F.regexp_extract(path, f"/{ATT}=([^/]*)/", 1), PART: F.regexp_extract(path, f"/{PART}=([^/]*)/", 1)})


def _same_keys(df: DataFrame, dead: DataFrame, keys: Sequence[str]) -> Column:
    cond = (df[ATT] == dead["__da"]) & (df[PART] == dead["__dp"])
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(dead[f"__d{i}"])
    return cond


def _deletes(spark: SparkSession, base: str, m: Manifest, attempts: Iterable[str]) -> DataFrame:
    fields = T.StructType.fromJson(json.loads(m.schema))
    schema = T.StructType([T.StructField(ATT, T.StringType()), T.StructField(PART, T.StringType()), *[fields[k] for k in m.keys]])
    d = spark.read.schema(schema).parquet(*[f"{base}/deletes/{a}" for a in sorted(set(attempts))])
    return d.select(F.col(ATT).alias("__da"), F.col(PART).alias("__dp"), *[F.col(k).alias(f"__d{i}") for i, k in enumerate(m.keys)])


def _alive(spark: SparkSession, base: str, m: Manifest, placed: DataFrame, folders: Sequence[Folder]) -> DataFrame:
    """Without the rows that delete sets of these folders name."""
    attempts = [a for f in folders for a in f.deletes]
    if not attempts:
        return placed
    dead = _deletes(spark, base, m, attempts)
    return placed.join(dead, _same_keys(placed, dead, m.keys), "left_anti")


def read_folders(spark: SparkSession, base: str, m: Manifest, folders: Sequence[Folder], *, placed: bool = False) -> DataFrame | None:
    """Live rows of some folders; ``placed`` keeps their attempt and part."""
    clean, dirty = [f for f in folders if not f.deletes], [f for f in folders if f.deletes]
    arms = []
    if clean:
        df = _parquet(spark, m, [f"{base}/{f.path}" for f in clean])
        arms.append(_placed(df) if placed else df)
    if dirty:
        df = _alive(spark, base, m, _placed(_parquet(spark, m, [f"{base}/{f.path}" for f in dirty])), dirty)
        arms.append(df if placed else df.drop(ATT, PART))
    if not arms:
        return None
    return arms[0] if len(arms) == 1 else arms[0].unionByName(arms[1], allowMissingColumns=True)


def read_current(spark: SparkSession, base: str, *, hidden: bool = False) -> DataFrame | None:
    """The current version, or None; ``hidden`` keeps the rank columns."""
    m = read_manifest(spark, base)
    df = read_folders(spark, base, m, m.folders) if m else None
    return df if df is None or hidden else df.drop(*HIDDEN)


def read_parts(spark: SparkSession, base: str, m: Manifest, parts: Iterable[str], *, placed: bool = False) -> DataFrame | None:
    wanted = set(parts)
    return read_folders(spark, base, m, [f for f in m.folders if f.part in wanted], placed=placed)


# --- the key index ----------------------------------------------------------------------------------------

_INDEX = {"files": f"{PART} string, file string, rows long, lo string, hi string, blocks long",
          "bloom": f"{PART} string, file string, block long, bits binary"}


def _positions(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(_BITS)) for i in range(1, _HASHES + 1)]


def _write_index(spark: SparkSession, base: str, attempt: str) -> dict[str, int]:
    """Index the files of an attempt; rows by part."""
    root = f"{base}/data/{ATT}={attempt}"
    df = spark.read.schema(f"{RANK_KEY} string").parquet(root)
    rows = df.select(RANK_KEY, F.col("_metadata.file_name").alias("file"),
                     F.regexp_extract(F.col("_metadata.file_path"), f"/{PART}=([^/]*)/", 1).alias(PART))
    files = rows.groupBy(PART, "file").agg(F.count(F.lit(1)).alias("rows"), F.min(RANK_KEY).alias("lo"), F.max(RANK_KEY).alias("hi"))
    files = files.withColumn("blocks", F.ceil(F.col("rows") * _BITS_A_KEY / _BITS).cast("long"))
    files.write.parquet(f"{base}/index/{attempt}/files")
    files = spark.read.schema(_INDEX["files"]).parquet(f"{base}/index/{attempt}/files")
    keyed = rows.join(files.select(PART, "file", "blocks"), [PART, "file"])
    keyed = keyed.select(PART, "file", F.pmod(F.xxhash64(RANK_KEY), "blocks").alias("block"),
                         F.explode(F.array(*_positions(RANK_KEY))).alias("bit"))
    bloom = keyed.groupBy(PART, "file", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bloom.write.parquet(f"{base}/index/{attempt}/bloom")
    return {r[PART]: r["n"] for r in files.groupBy(PART).agg(F.sum("rows").alias("n")).collect()}  # one row a part


def _bit(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1


def candidate_files(spark: SparkSession, base: str, folders: Sequence[Folder], keys: DataFrame) -> list[tuple[str, str, str]]:
    """(attempt, part, file) of every file of these folders that may hold one of the keys: ``keys`` has the rank key and,
    in ``__part``, the part it must be in (null: any). False positives only."""
    if not folders:
        return []
    attempts = sorted({f.attempt for f in folders})
    live = spark.createDataFrame([f.name for f in folders], f"{ATT} string, {PART} string")  # of the manifest: one row a folder
    read = lambda kind: _from_index(spark, base, attempts, kind)
    files = read("files").join(live, [ATT, PART]).withColumnRenamed(PART, "p")
    keys = keys.select(RANK_KEY, F.col(PART).cast("string").alias("__kp")).distinct()
    near = _in_range(keys, files)
    near = near.select(ATT, "p", "file", F.pmod(F.xxhash64(RANK_KEY), "blocks").alias("block"), RANK_KEY)
    hit = near.join(read("bloom").withColumnRenamed(PART, "p"), [ATT, "p", "file", "block"])
    for position in _positions(RANK_KEY):
        hit = hit.filter(_bit("bits", position))
    return sorted(tuple(r) for r in hit.select(ATT, "p", "file").distinct().collect())  # at most one row a file


def _in_range(keys: DataFrame, files: DataFrame) -> DataFrame:
    """Keys with every file of their part (``__kp``; null: any) whose least and greatest key they lie between. Keys of a known part meet its
    files by an equal join, not those of all parts; the files of a table, one row each, are few."""
    files, within = F.broadcast(files), F.col(RANK_KEY).between(F.col("lo"), F.col("hi"))
    known = keys.filter(F.col("__kp").isNotNull()).join(files, (F.col("__kp") == F.col("p")) & within)
    return known.unionByName(keys.filter(F.col("__kp").isNull()).join(files, within))


def _from_index(spark: SparkSession, base: str, attempts: Sequence[str], kind: str) -> DataFrame:
    df = spark.read.schema(_INDEX[kind]).parquet(*[f"{base}/index/{a}/{kind}" for a in attempts])
    return df.withColumn(ATT, F.regexp_extract(F.col("_metadata.file_path"), f"/index/([^/]*)/{kind}/", 1))


def read_candidates(spark: SparkSession, base: str, m: Manifest, keys: DataFrame) -> DataFrame | None:
    """Live rows (placed) of the files that may hold one of the keys; other files are not opened."""
    found = candidate_files(spark, base, m.folders, keys)
    if not found:
        return None
    paths = [f"{base}/data/{ATT}={a}/{PART}={p}/{f}" for a, p, f in found]
    df = _placed(_parquet(spark, m, paths))
    names = {(a, p) for a, p, _ in found}
    return _alive(spark, base, m, df, [f for f in m.folders if f.name in names])


# --- writing ----------------------------------------------------------------------------------------------

def new_attempt() -> str:
    return "a" + uuid.uuid4().hex[:15]


def write_attempt(spark: SparkSession, base: str, attempt: str, df: DataFrame, *, part: Column, cluster_by: Sequence[str] = ()) -> tuple[Folder, ...]:
    """Write rows as folders of a new attempt, with their key index if they carry a rank key."""
    from rawfold.sources.incremental import write_table
    root = f"{base}/data/{ATT}={attempt}"
    indexed = RANK_KEY in df.columns
    write_table(df.withColumn(PART, part.cast("string")), root, partition_by=PART, cluster_by=cluster_by)
    parts = [n.split("=", 1)[1] for n in _names(spark, root) if n.startswith(f"{PART}=")]
    if not parts:
        _delete(spark, [root])
        return ()
    rows = _write_index(spark, base, attempt) if indexed else {}
    size = lambda p: (lambda x: x[1].getContentSummary(x[0]).getLength())(_path(spark, f"{root}/{PART}={p}"))
    return tuple(Folder(attempt, p, rows.get(p, 0), size(p)) for p in parts)


def write_deletes(spark: SparkSession, base: str, attempt: str, dead: DataFrame, keys: Sequence[str]) -> dict[tuple[str, str], int]:
    """Write the delete set of an attempt from placed dead rows; dead rows by folder."""
    path = f"{base}/deletes/{attempt}"
    dead.groupBy(ATT, PART, *keys).agg(F.count(F.lit(1)).alias("rows")).write.parquet(path)
    counts = spark.read.schema(f"{ATT} string, {PART} string, rows long").parquet(path).groupBy(ATT, PART).agg(F.sum("rows").alias("n")).collect()  # one row a folder
    if not counts:
        _delete(spark, [path])
    return {(r[ATT], r[PART]): r["n"] for r in counts}


def drop_attempt(spark: SparkSession, base: str, attempt: str) -> None:
    _delete(spark, [f"{base}/data/{ATT}={attempt}", f"{base}/index/{attempt}", f"{base}/deletes/{attempt}"])


def _marked(folders: Iterable[Folder], attempt: str, dead: dict[tuple[str, str], int]) -> tuple[Folder, ...]:
    return tuple(replace(f, dead=f.dead + dead[f.name], deletes=(*f.deletes, attempt)) if f.name in dead else f for f in folders)


def commit_load(spark: SparkSession, base: str, old: Manifest, attempt: str, df: DataFrame, new: Sequence[Folder],
                dead: dict[tuple[str, str], int], *, keys: DataFrame, epoch: int | None = None, watermarks: dict | None = None, whole_parts: Iterable[str] = (),
                retain: int = 2, before_switch: Callable[[], None] | None = None) -> Manifest:
    """Commit a load (``df``, written as ``new``) merged with ``old``: on top of what was committed meanwhile if that does not concern its keys (with
    their parts, as for ``candidate_files``) or the parts it has read as a whole; else ``CommitConflict``."""
    if before_switch:
        before_switch()
    now = old
    while True:
        m = replace(now, version=now.version + 1, folders=(*_marked(now.folders, attempt, dead), *new), schema=_schema_of(now, df),
                    epoch=now.epoch if epoch is None else epoch,
                    watermarks={**now.watermarks, **{k: max(v, now.watermarks.get(k, v)) for k, v in (watermarks or {}).items()}})
        if put_manifest(spark, base, m):
            retire(spark, base, m, retain)
            return m
        now = read_manifest(spark, base)
        before, after = {f.name: f for f in old.folders}, {f.name: f for f in now.folders}
        added = [f for name, f in after.items() if name not in before]
        changed = {name for name, f in before.items() if after.get(name) != f}
        if (now.n_parts != old.n_parts or now.grain != old.grain or (epoch is not None and now.epoch is not None and now.epoch >= epoch)
                or set(dead) - set(after) or {f.part for f in added} & set(whole_parts)
                or {p for _, p in changed} & set(whole_parts) or candidate_files(spark, base, added, keys)):
            raise CommitConflict(f"version {now.version} of {base} holds keys of this load")


def commit_parts(spark: SparkSession, base: str, df: DataFrame, old: Manifest | None, touched: Sequence[str] | None, *,
                 part: Column, n_parts: int, cluster_by: Sequence[str] = (), epoch: int | None = None, keys: Sequence[str] = (RANK_KEY,),
                 watermarks: dict | None = None, grain: str = "day", retain: int = 2,
                 before_switch: Callable[[], None] | None = None) -> Manifest:
    """Write ``df`` (all rows of the touched parts; None: of all) as new folders in place of those parts' folders."""
    attempt = new_attempt()
    new = write_attempt(spark, base, attempt, df, part=part, cluster_by=cluster_by)
    if before_switch:
        before_switch()
    kept = () if old is None or touched is None else tuple(f for f in old.folders if f.part not in set(touched))
    m = Manifest((old.version if old else 0) + 1, n_parts, (*kept, *new), epoch, tuple(keys), watermarks or {},
                 _schema_of(old if kept else None, df), grain)
    if not put_manifest(spark, base, m):
        drop_attempt(spark, base, attempt)
        raise CommitConflict(f"version {m.version} of {base} was committed by another writer")
    retire(spark, base, m, retain)
    return m


def commit_version(spark: SparkSession, base: str, df: DataFrame, *, partition_by: str | None = None,
                   cluster_by: Sequence[str] = ()) -> Manifest:
    """Write ``df`` as a new version of ``base`` as a whole: one part, or one by value of ``partition_by``."""
    part = F.coalesce(F.col(partition_by).cast("string"), F.lit("null")) if partition_by else F.lit("0")
    return commit_parts(spark, base, df, read_manifest(spark, base), None, part=part, n_parts=1, cluster_by=cluster_by)


def retire(spark: SparkSession, base: str, m: Manifest, retain: int) -> None:
    """Remove manifests older than the newest ``retain``, and folders, indexes and delete sets that no remaining one names."""
    versions = [v for v in _versions(spark, base) if v <= m.version]
    gone, kept = [v for v in versions if v <= m.version - retain], [v for v in versions if v > m.version - retain]
    if not gone:
        return
    old, left = [load_manifest(spark, base, v) for v in gone], [load_manifest(spark, base, v) for v in kept]
    folders = lambda ms: {f.path for x in ms for f in x.folders}
    data = lambda ms: {f.attempt for x in ms for f in x.folders}
    deletes = lambda ms: {a for x in ms for f in x.folders for a in f.deletes}
    _delete(spark, [_manifest_path(base, v) for v in gone])
    _delete(spark, [f"{base}/{p}" for p in sorted(folders(old) - folders(left))])
    empty = sorted(data(old) - data(left))
    _delete(spark, [f"{base}/{kind}{a}" for a in empty for kind in (f"data/{ATT}=", "index/")])
    _delete(spark, [f"{base}/deletes/{a}" for a in sorted(deletes(old) - deletes(left))])


# --- compaction -------------------------------------------------------------------------------------------

def _tier(size: int, fan: int, smallest: int) -> int:
    t = 0
    while size > smallest * fan ** t:
        t += 1
    return t


def to_compact(m: Manifest, *, fan: int = 4, smallest: int = 1 << 20) -> list[Folder]:
    """Folders due: of each part all up to the largest size tier that holds ``fan`` folders, and those a third dead."""
    due = []
    for folders in m.parts().values():
        tiers = {f.name: _tier(f.bytes, fan, smallest) for f in folders}
        full = [t for t in set(tiers.values()) if list(tiers.values()).count(t) >= fan]
        due += [f for f in folders if (full and tiers[f.name] <= max(full)) or 3 * f.dead > max(f.rows, 1)]
    return due


def compact(spark: SparkSession, base: str, *, fan: int = 4, smallest: int = 1 << 20, cluster_by: Sequence[str] = (), retain: int = 2,
            before_switch: Callable[[], None] | None = None) -> Manifest | None:
    """Rewrite the live rows of folders that are due; None if there are none, or if another writer was faster (nothing is lost then:
    the folders stay due)."""
    m = read_manifest(spark, base)
    due = to_compact(m, fan=fan, smallest=smallest) if m else []
    if not due:
        return None
    attempt = new_attempt()
    df = read_folders(spark, base, m, due, placed=True).drop(ATT)
    new = write_attempt(spark, base, attempt, df, part=F.col(PART), cluster_by=cluster_by)
    if before_switch:
        before_switch()
    now, gone = m, {f.name: f for f in due}
    while True:
        done = replace(now, version=now.version + 1, folders=(*[f for f in now.folders if f.name not in gone], *new))
        if put_manifest(spark, base, done):
            retire(spark, base, done, retain)
            return done
        now = read_manifest(spark, base)
        there = {f.name: f for f in now.folders}
        if any(there.get(name) != f for name, f in gone.items()):
            drop_attempt(spark, base, attempt)
            return None
